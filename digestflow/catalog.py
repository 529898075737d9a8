"""Registered queries of the core and their SQL counterparts; each query is a function of (spark, data directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestflow.functions import text, urls
from digestflow.functions import timestamps as ts
from digestflow.operators import evidence, items, linkage, ranking, series, timestamps
from digestflow.plans import digest
from digestflow.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
HEADLINE = ("p5_found", "similar_pairs", "story_events", "fresh_items", "probe_report", "told_before", "ranked_digest", "quote_support", "url_groups")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator: adds a query, and its SQL where SQL can express it."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            SQL[name] = sql
        return query

    return add


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.typed_items(table(spark, sf_dir, "raw_items"))


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.with_run_time(_typed(spark, sf_dir))


@register("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = timestamps.timestamp_records(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "source_refs"))
    return timestamps.normalize_timestamps(records, table(spark, sf_dir, "sources"))


@register("p5_zones")
def p5_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "sources")
    records = timestamps.timestamp_records(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "source_refs"))
    return timestamps.zone_agreement(timestamps.parse_instants(records, sources), sources)


@register("url_canonical", f"SELECT ordinal, {urls.canonical_url_sql('url')} AS page FROM raw_items")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_items").select("ordinal", urls.canonical_url(F.col("url")).alias("page"))


@register("url_groups", f"SELECT {urls.canonical_url_sql('url')} AS page, min(ordinal) AS first_ordinal, count(*) AS members, count(DISTINCT source) AS sources FROM raw_items GROUP BY 1")
def url_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "raw_items").select("ordinal", "source", urls.canonical_url(F.col("url")).alias("page"))
    return keyed.groupBy("page").agg(F.min("ordinal").alias("first_ordinal"), F.count("*").alias("members"), F.count_distinct("source").alias("sources"))


@register("registrable_domains", f"SELECT {urls.registrable_domain_sql('url')} AS domain, count(*) AS n FROM raw_items GROUP BY 1")
def registrable_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_items").groupBy(urls.registrable_domain(F.col("url")).alias("domain")).agg(F.count("*").alias("n"))


@register("own_host", f"SELECT r.ordinal, coalesce(lower(trim(r.url)) LIKE 'https://%' AND {urls.url_host_sql('r.url')} = {urls.url_host_sql('s.url')}, false) AS allowed FROM raw_items r LEFT JOIN sources s USING (source)")
def own_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.own_host(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "sources"))


@register(
    "allowed_fetches",
    f"""SELECT ordinal, lower(trim(url)) LIKE 'https://%' AND NOT regexp_matches(trim(url), '^[^/]*//[^/?#]*@') AND {urls.url_host_sql("url")} <> ''
      AND NOT regexp_full_match({urls.url_host_sql("url")}, 'localhost|.*\\.localhost|.*\\.local|(0|10|127)\\..*|169\\.254\\..*|192\\.168\\..*|172\\.(1[6-9]|2[0-9]|3[01])\\..*|100\\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\\..*|(22[4-9]|2[3-5][0-9])\\..*') AS allowed FROM raw_items WHERE url IS NOT NULL""",
)
def allowed_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_items").where("url is not null").select("ordinal", urls.allowed_fetch(F.col("url")).alias("allowed"))


@register("feed_times", f"SELECT ordinal, {ts.feed_micros_sql('published_at')} AS published_us FROM raw_items")
def feed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select("ordinal", "published_us")


@register("relevant_items", f"SELECT r.ordinal, {text.is_relevant_sql('r')} AS relevant FROM raw_items r")
def relevant_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select("ordinal", "relevant")


@register("fresh_items", items.admission_sql() + " SELECT * FROM a")
def fresh_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.admission(_run(spark, sf_dir))


@register("fresh_audit", items.admission_sql() + " SELECT reason, count(*) AS n, count(DISTINCT source) AS sources FROM a GROUP BY reason")
def fresh_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.admission(_run(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


@register(
    "probe_report",
    items.admission_sql(per_source=True)
    + """, j AS (SELECT w.source, w.relevant, w.published_us, a.reason FROM w JOIN a USING (ordinal)),
      c AS (SELECT source, count(*) AS fetched, count_if(relevant) AS related, count_if(relevant AND published_us IS NOT NULL) AS dated, count_if(reason IN ('accepted', 'corroborated')) AS in_window,
        count_if(reason = 'not_related') AS not_related, count_if(reason = 'undated') AS undated, count_if(reason = 'outside_window') AS outside_window FROM j GROUP BY source)
      SELECT s.source, s.source_tier, s.enabled, coalesce(fetched, 0)::BIGINT AS fetched, coalesce(related, 0)::BIGINT AS related, coalesce(dated, 0)::BIGINT AS dated, coalesce(in_window, 0)::BIGINT AS in_window,
        coalesce(not_related, 0)::BIGINT AS not_related, coalesce(undated, 0)::BIGINT AS undated, coalesce(outside_window, 0)::BIGINT AS outside_window,
        CASE WHEN greatest(not_related, undated, outside_window) = 0 OR fetched IS NULL THEN NULL WHEN not_related = greatest(not_related, undated, outside_window) THEN 'not_related'
          WHEN undated = greatest(not_related, undated, outside_window) THEN 'undated' ELSE 'outside_window' END AS top_rejection
      FROM sources s LEFT JOIN c USING (source)""",
)
def probe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = items.probe_report(_run(spark, sf_dir), table(spark, sf_dir, "sources"))
    return report.withColumn("top_rejection", F.when(F.col("fetched") > 0, F.col("top_rejection")))


@register(
    "source_limits",
    """SELECT ordinal, source, place, label FROM (SELECT r.ordinal, r.source, row_number() OVER (PARTITION BY r.source ORDER BY r.ordinal)::INT AS place, s.item_limit,
      CASE WHEN trim(r.source_label) <> '' THEN r.source_label ELSE s.display_name END AS label FROM raw_items r JOIN sources s ON s.source = r.source AND s.enabled) WHERE place <= item_limit""",
)
def source_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.limited(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "sources"))


@register("source_coverage", "SELECT count(*) AS sources, count_if(seen) AS delivering, round(avg(seen::INT), 6) AS coverage FROM (SELECT source IN (SELECT source FROM raw_items) AS seen FROM sources WHERE source_tier = 'A')")
def source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.source_coverage(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "sources"))


@register(
    "title_tokens",
    f"""SELECT ordinal, array_to_string(list_sort({text.title_tokens_sql("title")}), ' ') AS tokens, array_to_string({text.product_ids_sql("title")}, ' ') AS products FROM raw_items WHERE title IS NOT NULL""",
)
def title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "raw_items").where("title is not null")
    return named.select("ordinal", F.array_join(F.array_sort(text.title_tokens(F.col("title"))), " ").alias("tokens"), F.array_join(text.product_ids(F.col("title")), " ").alias("products"))


@register("short_summaries", f"SELECT ordinal, {text.shortened_sql('summary')} AS line FROM raw_items WHERE summary IS NOT NULL")
def short_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_items").where("summary is not null").select("ordinal", text.shortened(F.col("summary")).alias("line"))


@register("similar_pairs", linkage.similar_pairs_sql() + " SELECT a, b, common, jaccard FROM pairs")
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.similar_pairs(_typed(spark, sf_dir)).select("a", "b", F.col("common").cast("long").alias("common"), "jaccard")


@register("story_groups", linkage.story_groups_sql() + " SELECT ordinal, story FROM g")
def story_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.story_groups(_typed(spark, sf_dir))


_RANKS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in linkage.CHANNEL_RANK.items())


@register(
    "story_events",
    linkage.story_groups_sql()
    + f""", m AS (SELECT g.story, t.*, row_number() OVER (PARTITION BY story ORDER BY source_tier, coalesce(CASE source_channel {_RANKS} END, 9), -length(coalesce(summary, '')), ordinal) AS p,
        row_number() OVER (PARTITION BY story ORDER BY published_us DESC NULLS LAST, ordinal) AS d FROM g JOIN t USING (ordinal))
      SELECT story, substr(sha256(min(page) FILTER (p = 1)), 1, 16) AS event_id, min(ordinal) FILTER (p = 1) AS primary_ordinal, min(page) FILTER (p = 1) AS canonical_url, min(title) FILTER (p = 1) AS title,
        max(published_us) AS published_us, coalesce(min(source_time_kind) FILTER (d = 1 AND published_us IS NOT NULL), min(source_time_kind) FILTER (p = 1)) AS source_time_kind,
        count(*) AS members, count(DISTINCT source) AS sources FROM m GROUP BY story""",
)
def story_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _typed(spark, sf_dir)
    return linkage.events(typed, linkage.story_groups(typed))


@register("event_scores", ranking.event_scores_sql())
def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.event_scores(table(spark, sf_dir, "news_events"))


@register("told_before", ranking.told_before_sql())
def told_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.told_before(table(spark, sf_dir, "news_events"), table(spark, sf_dir, "history_urls"), table(spark, sf_dir, "history_titles"))


_SCORED = f"WITH s AS ({ranking.event_scores_sql()}), "
_NEW = f"WITH told AS ({ranking.told_before_sql()}), s AS (SELECT * FROM ({ranking.event_scores_sql()}) WHERE event_id NOT IN (SELECT event_id FROM told)), "


@register("candidate_pool", _NEW + ranking.candidate_pool_sql() + " SELECT * FROM pool")
def candidate_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.candidate_pool(event_scores(spark, sf_dir).join(told_before(spark, sf_dir), "event_id", "left_anti"))


@register("candidate_batches", _NEW + ranking.candidate_pool_sql() + " SELECT place, event_id, ((place - 1) // 10)::BIGINT AS batch FROM pool")
def candidate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.batches_of(candidate_pool(spark, sf_dir))


@register(
    "ranked_digest",
    _NEW
    + ranking.candidate_pool_sql()
    + """, u AS (SELECT p.place, e.event_id, e.title, e.summary, epoch_us(e.published_at) AS published_us FROM pool p JOIN news_events e USING (event_id)
        WHERE e.published_at IS NOT NULL AND e.source_time_kind <> 'community_submitted' ORDER BY p.place LIMIT 12)
      SELECT row_number() OVER (ORDER BY published_us DESC, place)::INT AS pos, event_id, substr(title, 1, 100) AS headline, substr(CASE WHEN trim(summary) <> '' THEN summary ELSE title END, 1, 240) AS brief, published_us FROM u""",
)
def ranked_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked_digest(table(spark, sf_dir, "news_events"), candidate_pool(spark, sf_dir))


_EVIDENCE = """SELECT event_id || '-' || pos AS evidence_id, event_id, pos::INT AS pos, i.source AS source, i.url AS url, i.title AS title,
    CASE WHEN trim(coalesce(i.summary, '')) <> '' THEN i.summary ELSE i.title END AS said FROM (SELECT event_id, unnest(items) AS i, generate_subscripts(items, 1) AS pos FROM news_events)"""


@register("evidence_bundles", f"SELECT evidence_id, event_id, pos, source, url, title, substr(said, 1, 1600) AS excerpt FROM ({_EVIDENCE}) WHERE pos <= 3")
def evidence_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.evidence(table(spark, sf_dir, "news_events"))


@register(
    "quote_support",
    f"""SELECT c.ordinal, CASE WHEN e.evidence_id IS NULL THEN 'unknown' WHEN length({text.normalize_quote_sql("coalesce(c.quote, '')")}) < {text.QUOTE_MINIMUM} THEN 'short'
      WHEN contains({text.normalize_quote_sql("substr(e.said, 1, 6000)")}, {text.normalize_quote_sql("coalesce(c.quote, '')")}) THEN 'supported' ELSE 'absent' END AS verdict
      FROM claims c LEFT JOIN ({_EVIDENCE}) e USING (evidence_id)""",
)
def quote_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.quote_support(table(spark, sf_dir, "claims"), table(spark, sf_dir, "news_events"))


@register(
    "claim_coverage",
    """WITH c AS (SELECT event_id, count(*) AS n FROM claims GROUP BY event_id)
      SELECT coalesce(c.event_id, e.event_id) AS event_id, CASE WHEN e.event_id IS NULL THEN 'unexpected' ELSE 'missing' END AS problem, coalesce(n, 0)::BIGINT AS n FROM c FULL JOIN news_events e ON e.event_id = c.event_id
      WHERE e.event_id IS NULL OR c.event_id IS NULL
      UNION ALL SELECT event_id, 'repeated', sum(k)::BIGINT FROM (SELECT event_id, count(*) AS k FROM claims GROUP BY event_id, pos, evidence_id, quote HAVING count(*) > 1) GROUP BY event_id""",
)
def claim_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.claim_coverage(table(spark, sf_dir, "claims"), table(spark, sf_dir, "news_events"))


@register(
    "corroboration",
    f"""SELECT event_id, first_party, top_tier, publishers, first_party OR top_tier OR publishers >= 2 AS corroborated FROM (SELECT event_id,
      len(list_filter(items, lambda i: i.source_channel IN ('official', 'release'))) > 0 AS first_party, len(list_filter(items, lambda i: i.source_tier = 'A')) > 0 AS top_tier,
      len(list_distinct(list_transform(items, lambda i: {urls.registrable_domain_sql("i.url")})))::INT AS publishers FROM news_events)""",
)
def corroboration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.corroboration(table(spark, sf_dir, "news_events"))


@register(
    "evidence_audit",
    """SELECT event_id, array_to_string(l, ',') AS lengths, list_sum(l)::INT AS total, list_max(l)::INT AS longest, list_max(l) >= 800 AS passed
      FROM (SELECT event_id, list_transform(items[1:3], lambda i: length(coalesce(i.summary, ''))) AS l FROM news_events)""",
)
def evidence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.evidence_audit(table(spark, sf_dir, "news_events"))


@register(
    "link_labels",
    """WITH f AS (SELECT target_date, event_id, source, title, url, min(ordinal) AS first FROM source_refs GROUP BY ALL),
      n AS (SELECT *, row_number() OVER (PARTITION BY target_date, event_id ORDER BY first)::INT AS place, row_number() OVER (PARTITION BY target_date, event_id, source ORDER BY first) AS i, count(*) OVER (PARTITION BY target_date, event_id, source) AS n FROM f)
      SELECT target_date, event_id, source, title, url, place, CASE WHEN n = 1 THEN source ELSE source || ' ' || i || '/' || n END AS label FROM n""",
)
def link_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.link_labels(table(spark, sf_dir, "source_refs"))


@register(
    "link_calendar",
    """WITH d AS (SELECT unnest(generate_series((SELECT min(target_date) FROM source_refs)::TIMESTAMP, (SELECT max(target_date) FROM source_refs)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS target_date),
      s AS (SELECT target_date, count(DISTINCT event_id) AS stories, count(*) AS links FROM source_refs GROUP BY 1)
      SELECT d.target_date, coalesce(stories, 0)::BIGINT AS stories, coalesce(links, 0)::BIGINT AS links, links IS NOT NULL AS published FROM d LEFT JOIN s USING (target_date)""",
)
def link_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.calendar(table(spark, sf_dir, "source_refs"))


@register(
    "richer_copies",
    f"""WITH t AS (SELECT ordinal, {urls.canonical_url_sql("url")} AS page, length(coalesce(summary, '')) AS own FROM raw_items), b AS (SELECT page, max(own) AS best, count(*) AS n FROM t GROUP BY page),
      s AS (SELECT ordinal, own, best, CASE WHEN own >= 2000 THEN 'complete' WHEN n = 1 THEN 'alone' WHEN best < 500 THEN 'too_short' WHEN best > own THEN 'enriched' ELSE 'complete' END AS status FROM t JOIN b USING (page))
      SELECT ordinal, status, (CASE WHEN status = 'enriched' THEN best ELSE own END)::INT AS size FROM s""",
)
def richer_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "raw_items").select("ordinal", "summary", urls.canonical_url(F.col("url")).alias("page"))
    return evidence.richer_copies(keyed)


@register(
    "event_windows",
    "SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
)
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.windows(table(spark, sf_dir, "events"))


@register(
    "event_sessions",
    """WITH g AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w >= 1800000000 THEN 1 ELSE 0 END AS cut FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT user_id, t, sum(cut) OVER (PARTITION BY user_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS k FROM g)
      SELECT user_id, min(t) AS start_us, max(t) + 1800000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, k""",
)
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.sessions(table(spark, sf_dir, "events"))


@register(
    "running_totals",
    """WITH d AS (SELECT ts::DATE AS day, event_type, count(*) AS n, sum(value::DECIMAL(28, 6)) AS total FROM events GROUP BY 1, 2)
      SELECT day, event_type, n, round(total::DOUBLE, 4) AS total, round((sum(total) OVER (PARTITION BY event_type ORDER BY day))::DOUBLE, 4) AS total_so_far FROM d""",
)
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.running_totals(table(spark, sf_dir, "events"))


@register("metric_totals", f"SELECT source, m.key AS metric, count(x) AS n, round(sum(x), 4) AS total FROM (SELECT source, m, {text.numeric_sql('m.value')} AS x FROM (SELECT source, unnest(map_entries(metrics)) AS m FROM raw_items)) GROUP BY 1, 2")
def metric_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.metric_totals(table(spark, sf_dir, "raw_items"), text.numeric(F.col("v")))


@register(
    "best_links",
    "SELECT target_date, event_id, ordinal, pos, url FROM (SELECT *, row_number() OVER (PARTITION BY target_date, event_id ORDER BY pos, ordinal) AS r FROM source_refs) WHERE r = 1",
)
def best_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "source_refs").select("target_date", "event_id", "ordinal", "pos", "url")
    return series.best_rows(refs, ["target_date", "event_id"], F.col("pos"), "ordinal")


@register("newest_days", "SELECT target_date, count(DISTINCT event_id) AS stories FROM source_refs GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def newest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "source_refs").groupBy("target_date").agg(F.count_distinct("event_id").alias("stories")).orderBy(F.col("target_date").desc()).limit(30)


@register("daily_digest")
def daily_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.daily_digest(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "history_urls"), table(spark, sf_dir, "history_titles"))


@register("guesses_removed", f"SELECT ordinal, {text.without_guesses_sql('text')} AS kept, regexp_matches(text, '{text.GUESSING}') AS guessed FROM claims WHERE text IS NOT NULL")
def guesses_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "claims").where("text is not null")
    return told.select("ordinal", text.without_guesses(F.col("text")).alias("kept"), F.col("text").rlike(text.GUESSING).alias("guessed"))


@register("escaped_titles", f"SELECT ordinal, {text.escaped_sql('title')} AS title FROM raw_items")
def escaped_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_items").select("ordinal", text.escaped(F.col("title")).alias("title"))


@register("event_fingerprints", "SELECT event_id, sha256(coalesce(event_id, '') || chr(31) || coalesce(canonical_url, '') || chr(31) || coalesce(title, '') || chr(31) || coalesce(summary, '')) AS fingerprint FROM news_events")
def event_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col(c) for c in ("event_id", "canonical_url", "title", "summary")]
    return table(spark, sf_dir, "news_events").select("event_id", text.fingerprint(*parts).alias("fingerprint"))


@register("event_days", "SELECT strftime(make_timestamp(epoch_us(published_at)) + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, count(*) AS events, sum(len(items))::BIGINT AS items FROM news_events WHERE published_at IS NOT NULL GROUP BY 1")
def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by calendar day in China, whose clock stands eight hours before UTC all year."""
    local = F.date_format(F.from_utc_timestamp("published_at", "Asia/Shanghai"), "yyyy-MM-dd")
    return table(spark, sf_dir, "news_events").where("published_at is not null").groupBy(local.alias("day")).agg(F.count("*").alias("events"), F.sum(F.size("items")).alias("items"))


@register(
    "written_dates",
    r"""SELECT ordinal, try_strptime(regexp_extract(summary, '\b(20[0-9]{2}-[0-9]{2}-[0-9]{2})\b', 1), '%Y-%m-%d')::DATE AS written FROM raw_items WHERE regexp_matches(summary, '\b20[0-9]{2}-[0-9]{2}-[0-9]{2}\b')
      UNION ALL SELECT ordinal, try_strptime(regexp_extract(published_at, '^([A-Z][a-z]+ [0-9]{1,2}, [0-9]{4})', 1), '%B %d, %Y')::DATE FROM raw_items WHERE regexp_matches(published_at, '^[A-Z][a-z]{3,} [0-9]{1,2}, [0-9]{4}')""",
)
def written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in running text: ISO dates of summaries, long English dates of publication texts."""
    items_ = table(spark, sf_dir, "raw_items").select("ordinal", "summary", "published_at")
    iso, long = r"\b(20[0-9]{2}-[0-9]{2}-[0-9]{2})\b", r"^([A-Z][a-z]{3,} [0-9]{1,2}, [0-9]{4})"
    in_text = items_.where(F.col("summary").rlike(iso)).select("ordinal", F.try_to_timestamp(F.regexp_extract("summary", iso, 1), F.lit("yyyy-MM-dd")).cast("date").alias("written"))
    published = items_.where(F.col("published_at").rlike(long)).select("ordinal", F.try_to_timestamp(F.regexp_extract("published_at", long, 1), F.lit("MMMM d, yyyy")).cast("date").alias("written"))
    return in_text.unionByName(published)
