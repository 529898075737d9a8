"""Registered queries on plans, audits, ledgers, readers and formats, with their SQL counterparts.

Decisions, drafts and failures are derived from the tables by plain rules that stand in for a judge, a writer and a run of the sources.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestflow import catalog
from digestflow.functions import text, urls
from digestflow.operators import evidence, plan, ranking
from digestflow.session import table
from digestflow.sources import feeds

QUERIES: dict[str, catalog.Query] = {}
SQL: dict[str, str] = {}
SIZES = {"lead": 5, "follow": 7, "brief": 12}
QUOTAS = {"lead": (4, 5), "follow": (8, 9), "brief": (8, 12)}
CEILINGS = {"silent": "L2A", "undated": "L1", "disabled": "L0"}
SHARES, DAY_LIMIT = {"click": 0.4, "view": 0.1, "purchase": 0.5}, 90


def register(name: str, sql: str | None = None):  # noqa: ANN201
    def add(query: catalog.Query) -> catalog.Query:
        QUERIES[name] = query
        if sql:
            SQL[name] = sql
        return query

    return add


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "news_events")


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for a judge: relevance is the score, and a few events stay unjudged as after a failed batch."""
    scored = ranking.event_scores(_events(spark, sf_dir)).where(F.ascii(F.substring("event_id", -1, 1)) % 11 != 0)
    return scored.select("event_id", F.floor("score").cast("int").alias("relevance"), (F.col("score") >= 40).alias("selected"), F.col("channel").alias("category"))


_DECISIONS = f"""d AS (SELECT event_id, floor(score)::INT AS relevance, score >= 40 AS selected, channel AS category FROM ({ranking.event_scores_sql()}) WHERE ascii(right(event_id, 1)) % 11 <> 0)"""
_SELECTIONS = f"""{_DECISIONS}, p AS (SELECT pos, event_id, CASE WHEN pos <= 5 THEN 'lead' WHEN pos <= 12 THEN 'follow' ELSE 'brief' END AS tier, category, relevance AS importance
  FROM (SELECT *, row_number() OVER (ORDER BY relevance DESC, event_id)::INT AS pos FROM d WHERE selected) WHERE pos <= 24)"""
_RANK = "CASE tier WHEN 'lead' THEN 0 WHEN 'follow' THEN 1 WHEN 'brief' THEN 2 END"


def _selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.planned(_decisions(spark, sf_dir), SIZES)


def _drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "claims").where("text is not null")
    return claims.groupBy("event_id").agg(F.min_by("text", F.struct("pos", "ordinal")).alias("tldr"))


@register("judged_events", f"WITH {_DECISIONS} SELECT event_id, relevance, selected, category, len(items)::INT AS members FROM news_events JOIN d USING (event_id)")
def judged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.judged(_events(spark, sf_dir), _decisions(spark, sf_dir)).select("event_id", "relevance", "selected", "category", F.size("items").alias("members"))


@register("unjudged_events", f"WITH {_DECISIONS} SELECT event_id FROM news_events WHERE event_id NOT IN (SELECT event_id FROM d)")
def unjudged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.unjudged(_events(spark, sf_dir), _decisions(spark, sf_dir))


@register("plan_selections", f"WITH {_SELECTIONS} SELECT * FROM p")
def plan_selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selections(spark, sf_dir)


@register(
    "composed_cards",
    f"""WITH {_SELECTIONS}, w AS (SELECT event_id, arg_min(text, (pos, ordinal)) AS tldr FROM claims WHERE text IS NOT NULL GROUP BY event_id)
      SELECT p.pos, p.event_id, CASE WHEN tldr IS NULL THEN 'brief' ELSE tier END AS tier, substr(title, 1, 100) AS headline,
        substr(coalesce(tldr, CASE WHEN trim(coalesce(summary, '')) <> '' THEN summary ELSE title END), 1, 240) AS brief FROM p JOIN news_events USING (event_id) LEFT JOIN w USING (event_id)""",
)
def composed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.composed(_selections(spark, sf_dir), _events(spark, sf_dir), _drafts(spark, sf_dir))


@register("plan_counts", f"WITH {_SELECTIONS} SELECT tier, count(*) AS n, count(DISTINCT category) AS categories, min(importance) AS least, max(importance) AS most FROM p GROUP BY tier")
def plan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.plan_counts(_selections(spark, sf_dir))


def _shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan in the order of event ids, so that there is something to find."""
    from pyspark.sql import Window as W

    return _selections(spark, sf_dir).withColumn("pos", F.row_number().over(W.orderBy("event_id")))


@register(
    "order_violations",
    f"""WITH {_SELECTIONS}, q AS (SELECT row_number() OVER (ORDER BY event_id)::INT AS pos, event_id, importance, {_RANK} AS r FROM p),
      l AS (SELECT *, lag(r) OVER (ORDER BY pos) AS pr, lag(importance) OVER (ORDER BY pos) AS pi FROM q)
      SELECT pos, event_id, CASE WHEN r < pr THEN 'tier' ELSE 'importance' END AS rule FROM l WHERE r < pr OR (r = pr AND importance > pi)""",
)
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.order_violations(_shuffled(spark, sf_dir))


@register(
    "quota_violations",
    f"""WITH {_SELECTIONS}, a(tier, least, most) AS (VALUES ('lead', 4, 5), ('follow', 8, 9), ('brief', 8, 12))
      SELECT tier, n, least, most FROM (SELECT tier, (SELECT count(*) FROM p WHERE p.tier = a.tier) AS n, least, most FROM a) WHERE n < least OR n > most""",
)
def quota_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.quota_violations(_selections(spark, sf_dir), QUOTAS)


_OWNED = "SELECT event_id || '-' || pos AS evidence_id, event_id AS owner FROM (SELECT event_id, unnest(generate_series(1, len(items))) AS pos FROM news_events)"


@register(
    "evidence_violations",
    f"""WITH o AS ({_OWNED}), j AS (SELECT c.event_id, CASE WHEN c.event_id NOT IN (SELECT event_id FROM news_events) THEN 'unknown event' WHEN o.owner IS NULL OR o.owner <> c.event_id THEN 'foreign evidence' END AS rule FROM claims c LEFT JOIN o USING (evidence_id))
      SELECT rule, event_id, count(*) AS n FROM j WHERE rule IS NOT NULL GROUP BY ALL
      UNION ALL SELECT 'place taken', event_id, sum(n)::BIGINT FROM (SELECT event_id, count(*) AS n FROM claims GROUP BY event_id, pos HAVING count(*) > 1) GROUP BY event_id""",
)
def evidence_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.evidence_violations(table(spark, sf_dir, "claims"), evidence.evidence(_events(spark, sf_dir), members=None))


_QUALIFIED = f"""SELECT event_id, len(list_filter(items, lambda i: i.source_channel IN ('official', 'release'))) > 0 OR len(list_filter(items, lambda i: i.source_tier = 'A')) > 1
    OR len(list_distinct(list_transform(items, lambda i: {urls.registrable_domain_sql("i.url")}))) >= 3 AS qualified FROM news_events"""


def _qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.col("items")
    domains = F.array_distinct(F.transform(items, lambda i: urls.registrable_domain(i["url"])))
    ok = F.exists(items, lambda i: i["source_channel"].isin("official", "release")) | (F.size(F.filter(items, lambda i: i["source_tier"] == "A")) > 1) | (F.size(domains) >= 3)
    return _events(spark, sf_dir).select("event_id", ok.alias("qualified"))


@register(
    "swapped_leads",
    f"""WITH {_SELECTIONS}, k AS ({_QUALIFIED}), m AS (SELECT p.*, CASE WHEN tier = 'lead' AND NOT qualified THEN 'out' WHEN tier = 'follow' AND qualified THEN 'in' END AS turn FROM p JOIN k USING (event_id)),
      n AS (SELECT *, row_number() OVER (PARTITION BY turn ORDER BY pos) AS i, count_if(turn = 'out') OVER () AS outs FROM m),
      t AS (SELECT event_id, CASE WHEN turn = 'out' THEN 'follow' WHEN turn = 'in' AND i <= outs THEN 'lead' ELSE tier END AS new, tier, importance FROM n)
      SELECT row_number() OVER (ORDER BY CASE new WHEN 'lead' THEN 0 WHEN 'follow' THEN 1 ELSE 2 END, importance DESC, event_id)::INT AS pos, event_id, new AS tier, importance, new <> tier AS moved FROM t""",
)
def swapped_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.swapped_leads(_selections(spark, sf_dir), _qualified(spark, sf_dir))


@register("repaired_details")
def repaired_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.repaired_details(_selections(spark, sf_dir), evidence.evidence_audit(_events(spark, sf_dir)).select("event_id", "passed"))


@register(
    "plan_highlight",
    f"""WITH {_SELECTIONS}, h AS (SELECT list(substr(title, 1, 100) ORDER BY pos) AS hs FROM p JOIN news_events USING (event_id) WHERE tier = 'lead')
      SELECT CASE WHEN length(array_to_string(hs[1:4], '；')) <= 300 THEN array_to_string(hs[1:4], '；') ELSE trim(substr(array_to_string(hs[1:3], '；'), 1, 300)) END AS highlight FROM h""",
)
def plan_highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.highlight(_selections(spark, sf_dir), _events(spark, sf_dir).select("event_id", "title"))


@register(
    "judged_digest",
    f"""WITH {_DECISIONS}, b AS (SELECT event_id, relevance FROM d WHERE selected ORDER BY relevance DESC, event_id LIMIT 12)
      SELECT event_id, relevance, epoch_us(published_at) AS published_us FROM b JOIN news_events USING (event_id) WHERE published_at IS NOT NULL AND source_time_kind <> 'community_submitted'""",
)
def judged_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First limited, then filtered: fewer rows than the limit may remain."""
    best = _decisions(spark, sf_dir).where("selected").orderBy(F.col("relevance").desc(), "event_id").limit(12)
    dated = _events(spark, sf_dir).where("published_at is not null and source_time_kind <> 'community_submitted'")
    return best.join(dated, "event_id").select("event_id", "relevance", F.unix_micros("published_at").alias("published_us"))


@register("longest_items", "SELECT event_id, pos, size FROM (SELECT event_id, pos, length(coalesce(items[pos].summary, ''))::INT AS size, row_number() OVER (PARTITION BY event_id ORDER BY length(coalesce(items[pos].summary, '')) DESC, pos) AS r FROM (SELECT event_id, items, unnest(generate_series(1, len(items)))::INT AS pos FROM news_events)) WHERE r = 1")
def longest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("event_id", F.posexplode("items").alias("p", "i")).select("event_id", (F.col("p") + 1).alias("pos"), F.col("i.summary").alias("summary"))
    return plan.longest(rows, "event_id", "summary", "pos")


@register("recent_days", "SELECT DISTINCT target_date FROM source_refs WHERE target_date <> (SELECT max(target_date) FROM source_refs) ORDER BY 1 DESC LIMIT 10")
def recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "source_refs").select("target_date").distinct()
    current = days.agg(F.max("target_date").alias("_c"))
    return days.join(F.broadcast(current), F.col("target_date") != F.col("_c")).select("target_date").orderBy(F.col("target_date").desc()).limit(10)


@register(
    "retained_releases",
    "WITH n AS (SELECT DISTINCT target_date::VARCHAR AS name FROM history_titles WHERE target_date IS NOT NULL) SELECT name, name IN (SELECT name FROM n ORDER BY name DESC LIMIT 30) OR name = (SELECT min(name) FROM n) AS kept FROM n",
)
def retained_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "history_titles").where("target_date is not null").select(F.col("target_date").cast("string").alias("name")).distinct()
    active = names.agg(F.min("name")).first()[0] or ""
    return plan.retained(names, active)


@register(
    "merged_calendar",
    """WITH h AS (SELECT target_date, count(*) AS entries FROM history_titles WHERE target_date IS NOT NULL GROUP BY 1), c AS (SELECT target_date, count(*) AS entries FROM source_refs GROUP BY 1)
      SELECT target_date, entries FROM h WHERE target_date NOT IN (SELECT target_date FROM c) UNION ALL SELECT target_date, entries FROM c""",
)
def merged_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda name: table(spark, sf_dir, name).where("target_date is not null").groupBy("target_date").agg(F.count("*").alias("entries"))
    return plan.replaced(count("history_titles"), count("source_refs"), "target_date")


def _spends(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.to_date("ts").alias("day"), F.col("event_type").alias("stage"), F.col("event_id").alias("seq"), F.col("value").cast("decimal(18,6)").alias("amount"))


_SPENDS = "s AS (SELECT ts::DATE AS day, event_type AS stage, event_id AS seq, value::DECIMAL(18, 6) AS amount FROM events)"


@register(
    "spend_ledger",
    f"""WITH {_SPENDS}, r AS (SELECT *, sum(amount) OVER (PARTITION BY day ORDER BY seq ROWS UNBOUNDED PRECEDING) AS d, sum(amount) OVER (PARTITION BY day, stage ORDER BY seq ROWS UNBOUNDED PRECEDING) AS g FROM s)
      SELECT day, stage, seq, round(d::DOUBLE, 4) AS day_total, round(g::DOUBLE, 4) AS stage_total, d > 1000 AND d - amount <= 1000 AS over FROM r""",
)
def spend_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = plan.ledger(_spends(spark, sf_dir), 1000)
    return run.select("day", "stage", "seq", F.round(F.col("day_total").cast("double"), 4).alias("day_total"), F.round(F.col("stage_total").cast("double"), 4).alias("stage_total"), "over")


@register(
    "stage_allowances",
    f"""WITH {_SPENDS}, a(stage, part) AS (VALUES ('click', 36), ('view', 9), ('purchase', 45)), u AS (SELECT day, stage, count(*) AS used FROM s GROUP BY ALL), t AS (SELECT day, count(*) AS n FROM s GROUP BY day)
      SELECT t.day, a.stage, coalesce(used, 0)::BIGINT AS used, greatest(0, least(part - coalesce(used, 0), {DAY_LIMIT} - n))::BIGINT AS allowance FROM t CROSS JOIN a LEFT JOIN u ON u.day = t.day AND u.stage = a.stage""",
)
def stage_allowances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.allowances(_spends(spark, sf_dir), SHARES, DAY_LIMIT)


@register("run_costs", "SELECT lang, source, count(*) AS calls, sum(coalesce(n_chars, 0))::BIGINT AS units, round(sum(coalesce(n_chars, 0) * 2.0 + 800 * 8.0) / 1e6, 6) AS cost FROM documents GROUP BY ALL")
def run_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of reading every document and writing a fixed answer, by units and rates."""
    units = F.coalesce("n_chars", F.lit(0))
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("calls"), F.sum(units).alias("units"), F.round(F.sum(units * 2.0 + 800 * 8.0) / 1e6, 6).alias("cost"))


_SCORES = f"""v AS ({catalog.SQL["quote_support"]}), j AS (SELECT c.ordinal, c.event_id, v.verdict, e.event_id IS NOT NULL AS known, length(c.text) <= 500 AS short FROM claims c JOIN v USING (ordinal) LEFT JOIN news_events e USING (event_id)),
  r AS (SELECT coalesce(x.channel, 'none') AS profile, count(*) AS n, avg((verdict = 'supported')::INT) AS supported, avg(known::INT) AS known, avg(short::INT) AS short FROM j LEFT JOIN ({ranking.event_scores_sql()}) x USING (event_id) GROUP BY 1),
  g AS (SELECT profile, n, round(100 * (0.5 * supported + 0.3 * known + 0.2 * short), 4) AS score, n >= 20 AS eligible FROM r)"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "claims").select("ordinal", "event_id", (F.length("text") <= 500).alias("short"))
    channels = ranking.event_scores(_events(spark, sf_dir)).select("event_id", "channel")
    joined = claims.join(catalog.QUERIES["quote_support"](spark, sf_dir), "ordinal").join(channels, "event_id", "left")
    rate = lambda c: F.avg(c.cast("int"))
    score = F.lit(100) * (F.lit(0.5) * rate(F.col("verdict") == "supported") + F.lit(0.3) * rate(F.col("channel").isNotNull()) + F.lit(0.2) * rate(F.col("short")))
    return joined.groupBy(F.coalesce("channel", F.lit("none")).alias("profile")).agg(F.count("*").alias("n"), F.round(score, 4).alias("score")).withColumn("eligible", F.col("n") >= 20)


@register("evaluation_scores", f"WITH {_SCORES} SELECT * FROM g")
def evaluation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)


@register(
    "evaluation_ranking",
    f"WITH {_SCORES}, l AS (SELECT profile, score, row_number() OVER w::INT AS place, round(score - lead(score) OVER w, 6) AS ahead FROM g WHERE eligible WINDOW w AS (ORDER BY score DESC, profile)) SELECT *, place = 1 AND coalesce(ahead, 5) >= 5 AS recommended FROM l",
)
def evaluation_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.recommended(_scores(spark, sf_dir), 5.0)


_FAILURES = """f AS (SELECT s.source_tier AS scope, s.source AS seq, CASE WHEN NOT s.enabled THEN 'disabled' WHEN coalesce(n, 0) = 0 THEN 'silent' WHEN dated * 10 < n * 9 THEN 'undated' END AS failure, s.source AS detail
  FROM sources s LEFT JOIN (SELECT source, count(*) AS n, count(nullif(trim(published_at), '')) AS dated FROM raw_items GROUP BY 1) r USING (source))"""


@register(
    "level_ladder",
    f"""WITH {_FAILURES}, o AS (SELECT scope, failure, min(seq) AS seq, CASE failure WHEN 'silent' THEN 2 WHEN 'undated' THEN 1 ELSE 0 END AS r FROM f WHERE failure IS NOT NULL GROUP BY scope, failure)
      SELECT scope, ['L0', 'L1', 'L2A', 'L2B', 'L3'][max(r) + 1] AS level, max(r) = 4 AS blocked, string_agg(failure || ': ' || seq, ' | ' ORDER BY seq) AS reasons FROM o GROUP BY scope""",
)
def level_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "raw_items").groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("n"), F.count(F.nullif(F.trim("published_at"), F.lit(""))).alias("dated"))
    joined = table(spark, sf_dir, "sources").join(counted, F.col("source") == F.col("_s"), "left")
    failure = F.when(~F.col("enabled"), "disabled").when(F.coalesce("n", F.lit(0)) == 0, "silent").when(F.col("dated") * 10 < F.col("n") * 9, "undated")
    return plan.ladder(joined.select(F.col("source_tier").alias("scope"), F.col("source").alias("seq"), failure.alias("failure"), F.col("source").alias("detail")).where("failure is not null"), CEILINGS)


@register("candidate_level", "SELECT count(*) AS n, CASE WHEN count(*) < 5 THEN 'L3' WHEN count(*) < 17 THEN 'L2B' ELSE 'L0' END AS level FROM (SELECT event_id FROM news_events WHERE published_at IS NOT NULL)")
def candidate_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count("*")
    return _events(spark, sf_dir).where("published_at is not null").agg(n.alias("n"), F.when(n < 5, "L3").when(n < 17, "L2B").otherwise("L0").alias("level"))


_LEVEL = "['L0', 'L1', 'L2A', 'L2B', 'L3'][(ordinal % 5) + 1]"


@register(
    "accepted_upgrades",
    f"""WITH v AS (SELECT event_id AS key, ordinal AS seq, {_LEVEL} AS level, ordinal % 5 AS r FROM source_refs), b AS (SELECT *, min(r) OVER (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM v)
      SELECT key, seq, level FROM b WHERE best IS NULL OR r < best""",
)
def accepted_upgrades(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.element_at(F.array(*[F.lit(x) for x in plan.LEVELS]), (F.col("ordinal") % 5 + 1).cast("int"))
    return plan.upgrades(table(spark, sf_dir, "source_refs").select(F.col("event_id").alias("key"), F.col("ordinal").alias("seq"), level.alias("level")))


@register(
    "event_markers",
    """SELECT event_id, sha256('{"canonical_url":' || to_json(canonical_url)::VARCHAR || ',"event_id":' || to_json(event_id)::VARCHAR || ',"score":' || printf('%.4f', score) || ',"title":' || to_json(title)::VARCHAR || '}') AS marker FROM news_events WHERE title IS NOT NULL AND canonical_url IS NOT NULL AND score IS NOT NULL""",
)
def event_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of the canonical JSON of an event: sorted keys, no spaces, other scripts kept as they are."""
    told = _events(spark, sf_dir).where("title is not null and canonical_url is not null and score is not null")
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r'^\{"v":(.*)\}$', 1)
    payload = F.concat(F.lit('{"canonical_url":'), quoted("canonical_url"), F.lit(',"event_id":'), quoted("event_id"), F.lit(',"score":'), F.format_string("%.4f", "score"), F.lit(',"title":'), quoted("title"), F.lit("}"))
    return told.select("event_id", F.sha2(payload, 256).alias("marker"))


# Wording about the making of a text, not about its matter.
META = "原文|摘要|证据|资料显示|据提供的"
REACH = "意味着|标志着|有望|将会|势必"


@register(
    "copy_lint",
    f"""SELECT ordinal, CASE WHEN trim(coalesce(text, '')) = '' THEN 'blank' WHEN regexp_matches(text, '{text.GUESSING}') THEN 'guess' WHEN regexp_matches(text, '{META}') THEN 'meta' WHEN regexp_matches(text, '{REACH}') THEN 'reach' WHEN length(text) > 500 THEN 'long' END AS rule
      FROM claims WHERE trim(coalesce(text, '')) = '' OR regexp_matches(text, '{text.GUESSING}') OR regexp_matches(text, '{META}') OR regexp_matches(text, '{REACH}') OR length(text) > 500""",
)
def copy_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.col("text")
    rule = F.when(F.trim(F.coalesce(told, F.lit(""))) == "", "blank").when(told.rlike(text.GUESSING), "guess").when(told.rlike(META), "meta").when(told.rlike(REACH), "reach").when(F.length(told) > 500, "long")
    return table(spark, sf_dir, "claims").select("ordinal", rule.alias("rule")).where("rule is not null")


@register(
    "claim_links",
    "WITH e AS (SELECT event_id || '-' || pos AS evidence_id, i.source AS source, i.title AS title, i.url AS url FROM (SELECT event_id, unnest(items) AS i, generate_subscripts(items, 1) AS pos FROM news_events)) SELECT c.ordinal, e.source, e.title, e.url FROM claims c JOIN e USING (evidence_id)",
)
def claim_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = evidence.evidence(_events(spark, sf_dir), members=None).select("evidence_id", "source", "title", "url")
    return table(spark, sf_dir, "claims").select("ordinal", "evidence_id").join(cited, "evidence_id").select("ordinal", "source", "title", "url")


@register(
    "cited_sets",
    f"""WITH o AS ({_OWNED}), c AS (SELECT event_id, list_sort(list_distinct(list(evidence_id))) AS cited FROM claims WHERE evidence_id IS NOT NULL GROUP BY 1), b AS (SELECT owner AS event_id, list(evidence_id) AS held FROM o GROUP BY 1)
      SELECT event_id, array_to_string(cited, ',') AS cited, len(list_filter(cited, lambda x: NOT list_contains(coalesce(held, []), x))) = 0 AS inside FROM c LEFT JOIN b USING (event_id)""",
)
def cited_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence each event's claims cite, and whether all of it is the event's own: both sides are a few items."""
    held = _events(spark, sf_dir).select("event_id", F.transform(F.sequence(F.lit(1), F.size("items")), lambda i: F.concat_ws("-", "event_id", i.cast("string"))).alias("held"))
    cited = table(spark, sf_dir, "claims").where("evidence_id is not null").groupBy("event_id").agg(F.array_sort(F.collect_set("evidence_id")).alias("cited"))
    inside = F.size(F.array_except("cited", F.coalesce("held", F.array().cast("array<string>")))) == 0
    return cited.join(held, "event_id", "left").select("event_id", F.array_join("cited", ",").alias("cited"), inside.alias("inside"))


@register(
    "source_violations",
    """SELECT source, rule FROM (SELECT source, unnest([CASE WHEN url NOT LIKE 'https://%' THEN 'scheme' END, CASE WHEN source_tier NOT IN ('A', 'B', 'C') THEN 'tier' END, CASE WHEN item_limit NOT BETWEEN 1 AND 30 THEN 'limit' END, CASE WHEN timeout_seconds <= 0 OR timeout_seconds > 10 THEN 'timeout' END, CASE WHEN trim(display_name) = '' THEN 'name' END]) AS rule FROM sources) WHERE rule IS NOT NULL""",
)
def source_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"scheme": ~F.col("url").startswith("https://"), "tier": ~F.col("source_tier").isin("A", "B", "C"), "limit": ~F.col("item_limit").between(1, 30), "timeout": (F.col("timeout_seconds") <= 0) | (F.col("timeout_seconds") > 10), "name": F.trim("display_name") == ""}
    return violations(table(spark, sf_dir, "sources"), "source", rules)


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule): every rule a row breaks; a condition that is null is not broken."""
    broken = F.array(*[F.when(condition, name) for name, condition in rules.items()])
    return rows.select(key, F.explode(F.filter(broken, lambda r: r.isNotNull())).alias("rule"))


@register(
    "item_violations",
    """SELECT ordinal, rule FROM (SELECT ordinal, unnest([CASE WHEN title IS NULL OR trim(title) = '' OR length(title) > 120 THEN 'title' END, CASE WHEN length(summary) > 2000 THEN 'summary' END, CASE WHEN url IS NULL OR NOT regexp_matches(trim(url), '^[A-Za-z]+://') THEN 'url' END, CASE WHEN source_channel NOT IN ('official', 'release', 'news', 'community', 'research') THEN 'channel' END, CASE WHEN source_time_kind NOT IN ('published', 'repository_updated', 'community_submitted') THEN 'kind' END]) AS rule FROM raw_items) WHERE rule IS NOT NULL""",
)
def item_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    rules = {
        "title": title.isNull() | (F.trim(title) == "") | (F.length(title) > 120), "summary": F.length("summary") > 2000, "url": F.col("url").isNull() | ~F.trim("url").rlike("^[A-Za-z]+://"),
        "channel": ~F.col("source_channel").isin("official", "release", "news", "community", "research"), "kind": ~F.col("source_time_kind").isin("published", "repository_updated", "community_submitted"),
    }
    return violations(table(spark, sf_dir, "raw_items"), "ordinal", rules)


@register(
    "url_origins",
    """WITH u AS (SELECT ordinal, lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS s, lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#@:]+)', 1)) AS h, regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?[^/?#@:]+:([0-9]+)', 1) AS p FROM raw_items)
      SELECT ordinal, CASE WHEN s <> '' AND h <> '' THEN s || '|' || h || '|' || CASE WHEN p <> '' THEN p WHEN s = 'https' THEN '443' WHEN s = 'http' THEN '80' ELSE '' END END AS origin FROM u""",
)
def url_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_items").select("ordinal", urls.origin(F.col("url")).alias("origin"))


@register(
    "time_formats",
    """SELECT event_id, strftime(t + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS clock, strftime(t, '%a, %d %b %Y %H:%M:%S') || ' +0000' AS rfc, ['周日', '周一', '周二', '周三', '周四', '周五', '周六'][dayofweek(t + INTERVAL 8 HOUR) + 1] AS weekday, strftime(t, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso
      FROM (SELECT event_id, make_timestamp(epoch_us(published_at)) AS t FROM news_events WHERE published_at IS NOT NULL)""",
)
def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.timestamp_micros(F.unix_micros("published_at"))
    local = F.from_utc_timestamp(at, "Asia/Shanghai")
    day = F.element_at(F.array(*[F.lit(f"周{d}") for d in "日一二三四五六"]), F.dayofweek(local))
    told = _events(spark, sf_dir).where("published_at is not null")
    return told.select("event_id", F.date_format(local, "yyyy-MM-dd HH:mm").alias("clock"), F.concat(F.date_format(at, "E, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("rfc"), day.alias("weekday"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))


_SPECIAL = r"([\\\\`*_{}\[\]<>#+!|])"


@register("markdown_titles", r"SELECT ordinal, regexp_replace(trim(regexp_replace(title, '[ \t\r\n]+', ' ', 'g')), '([\\`*_{}\[\]<>#+!|])', '\\\1', 'g') AS title FROM raw_items WHERE title IS NOT NULL")
def markdown_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.trim(F.regexp_replace("title", r"[ \t\r\n]+", " "))
    return table(spark, sf_dir, "raw_items").where("title is not null").select("ordinal", F.regexp_replace(line, r"([\\`*_{}\[\]<>#+!|])", r"\\$1").alias("title"))


@register("first_dated_items", "SELECT event_id, min(pos)::INT AS pos FROM (SELECT event_id, unnest(generate_series(1, len(items))) AS pos, items FROM news_events) WHERE trim(coalesce(items[pos].published_at, '')) <> '' GROUP BY 1")
def first_dated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = F.filter(F.transform("items", lambda i, p: F.when(F.trim(F.coalesce(i["published_at"], F.lit(""))) != "", p + 1)), lambda p: p.isNotNull())
    return _events(spark, sf_dir).select("event_id", F.get(dated, F.lit(0)).alias("pos")).where("pos is not null")


@register("publishable_events", "SELECT event_id, CASE WHEN published_at IS NULL THEN 'undated' WHEN source_time_kind = 'community_submitted' THEN 'submitted' WHEN source_time_kind = 'repository_updated' THEN 'updated' ELSE 'published' END AS label FROM news_events")
def publishable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("source_time_kind")
    label = F.when(F.col("published_at").isNull(), "undated").when(kind == "community_submitted", "submitted").when(kind == "repository_updated", "updated").otherwise("published")
    return _events(spark, sf_dir).select("event_id", label.alias("label"))


@register("feed_texts", "SELECT target_date, string_agg(title, chr(10) ORDER BY pos, ordinal) AS body, count(*) AS n FROM (SELECT * FROM source_refs WHERE pos <= 3 AND title IS NOT NULL) GROUP BY 1")
def feed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "source_refs").where("pos <= 3 and title is not null")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("pos", "ordinal", "title"))), lambda x: x["title"])  # one issue of a feed
    return rows.groupBy("target_date").agg(F.array_join(lines, "\n").alias("body"), F.count("*").alias("n"))


@register("status_report", "SELECT max(target_date) AS latest, count(DISTINCT target_date) AS issues, count(DISTINCT event_id) AS stories, count(*) AS links FROM source_refs")
def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "source_refs").agg(F.max("target_date").alias("latest"), F.count_distinct("target_date").alias("issues"), F.count_distinct("event_id").alias("stories"), F.count("*").alias("links"))


_WINDOW = "(SELECT *, max(target_date) OVER () + 1 AS run FROM {name})"


@register(
    "told_recently",
    f"""WITH run AS (SELECT max(target_date) + 1 AS run FROM history_urls), history_urls_ AS (SELECT h.* FROM history_urls h, run WHERE target_date >= run - 45 AND target_date < run), history_titles_ AS (SELECT h.* FROM history_titles h, run WHERE target_date >= run - 45 AND target_date < run)
      SELECT * FROM ({ranking.told_before_sql().replace("FROM history_urls", "FROM history_urls_").replace("FROM history_titles", "FROM history_titles_")})""",
)
def told_recently(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events told within the 45 days before the day after the last entry; older entries do not count."""
    pages, titles = table(spark, sf_dir, "history_urls"), table(spark, sf_dir, "history_titles")
    run = pages.agg(F.date_add(F.max("target_date"), 1)).first()[0]
    return ranking.told_before(_events(spark, sf_dir), ranking.recent(pages, run), ranking.recent(titles, run))


def _feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One RSS payload for each source, written from the items of its first 20 rows, so that reading it back can be compared."""
    raw = table(spark, sf_dir, "raw_items").where("title is not null and trim(title) <> '' and url is not null")
    from pyspark.sql import Window as W

    first = raw.withColumn("r", F.row_number().over(W.partitionBy("source").orderBy("ordinal"))).where("r <= 20")
    item = F.concat(F.lit("<item><title><![CDATA["), F.replace("title", F.lit("]]>"), F.lit("")), F.lit("]]></title><link>"), text.escaped(F.trim("url")), F.lit("</link><guid>"), F.col("ordinal").cast("string"), F.lit("</guid></item>"))
    bodies = first.groupBy("source").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", item.alias("x")))), lambda s: s["x"]), "").alias("items"))  # at most 20
    return bodies.select("source", F.lit("rss").alias("kind"), F.lit("https://feed.example/").alias("url"), F.concat(F.lit("<rss><channel>"), F.col("items"), F.lit("</channel></rss>")).alias("body"))


@register(
    "read_feeds",
    """SELECT source, ordinal::VARCHAR AS source_item_id, (row_number() OVER (PARTITION BY source ORDER BY ordinal))::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ordinal) AS r FROM raw_items WHERE title IS NOT NULL AND trim(title) <> '' AND url IS NOT NULL)
      JOIN sources USING (source) WHERE r <= least(20, item_limit)""",
)
def read_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = feeds.read_payloads(_feed_payloads(spark, sf_dir), table(spark, sf_dir, "sources"))
    return read.where("error is null").select("source", "source_item_id", "place")


@register(
    "feed_health",
    """WITH n AS (SELECT source, count(*) AS items FROM raw_items WHERE title IS NOT NULL AND trim(title) <> '' AND url IS NOT NULL GROUP BY 1)
      SELECT source, CASE WHEN n.items IS NULL THEN 'disabled' WHEN source_channel <> 'community' THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n.items IS NULL THEN 0 ELSE least(n.items, 20, item_limit) END::BIGINT AS items FROM sources LEFT JOIN n USING (source)""",
)
def feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads hold no dates, so all sources outside the community have failed."""
    sources = table(spark, sf_dir, "sources")
    return feeds.health(feeds.read_payloads(_feed_payloads(spark, sf_dir), sources), sources)


PAGES = [
    ("https://p.example/1", "<html><head><meta property='og:title' content='One &amp; only'><meta property='og:description' content='Short'><meta property='article:published_time' content='2025-09-15T10:00:00+02:00'></head><body><nav>Menu</nav><article><p>Main text</p></article></body></html>"),
    ("https://p.example/2", "<title>Two</title><script type='application/ld+json'>{\"@graph\": [{\"@type\": \"NewsArticle\", \"datePublished\": \"2025-01-02T03:04:05Z\", \"articleBody\": \"Structured body wins by length\"}]}</script><main>Short</main>"),
    ("https://p.example/3", "<div class='entry'>Kept <aside>not</aside> text</div><span class='date'>2026-08-13</span><span class='time'>13:10:50</span>"),
    ("https://p.example/4", "<main><time datetime='2024-02-03'>x</time><h1>Head</h1></main>"),
    ("https://p.example/5", "<article>Posted on March 5, 2024 by nobody</article><footer>May 6, 2023</footer>"),
    ("https://p.example/6", "no markup < here & there"),
]
_PAGES = [("https://p.example/1", "One & only", "Short", "Main text", 1757923200), ("https://p.example/2", "Two", "", "Structured body wins by length", 1735787045), ("https://p.example/3", "", "", "Kept text", 1786626650), ("https://p.example/4", "", "", "x Head", 1706918400), ("https://p.example/5", "", "", "Posted on March 5, 2024 by nobody", 1709596800), ("https://p.example/6", "", "", "", None)]


@register("page_summaries", "SELECT * FROM (VALUES " + ", ".join(f"('{u}', '{t}', '{d}', '{x}', {'NULL' if s is None else s * 1_000_000}::BIGINT)" for u, t, d, x, s in _PAGES) + ") AS v(url, title, description, text, published_us)")
def page_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What small pages of every kind tell; the expected rows are written out in the SQL."""
    from digestflow.functions import html

    pages = spark.createDataFrame(PAGES, "url string, body string")
    return pages.select("url", html.page_summary(F.col("body"), F.lit("UTC")).alias("p")).select("url", "p.*")


_JSON = {
    "stories": ("hackernews", json.dumps([{"id": 7, "type": "story", "title": "S", "score": 120, "url": "https://s.example/7"}, {"id": 8, "type": "job", "title": "J"}])),
    "releases": ("github_releases", json.dumps([{"id": 1, "html_url": "https://r.example/1", "tag_name": "v1", "draft": False}, {"id": 2, "draft": True}])),
    "papers": ("huggingface", json.dumps([{"paper": {"paperId": "24.1", "title": " A  b ", "abstract": "c"}}, {"id": "x"}])),
    "models": ("huggingface_models", json.dumps([{"id": "n/k", "lastModified": "2025-09-01T00:00:00Z", "sha": "s"}, {"id": "o/k", "lastModified": "2025-09-01T00:00:00Z"}, {"id": "n/q", "lastModified": "2025-09-01T00:00:00Z", "tags": ["base_model:quantized:x"]}])),
    "index": ("html_index", '<a href="/x1">First</a><a href="/y">no</a><a href="/x1">again</a><a href="mailto:z">m</a>'),
    "broken": ("rss", "not xml"),
}


@register(
    "read_json_feeds",
    """SELECT * FROM (VALUES ('stories', 'https://s.example/7', 'S', NULL), ('releases', 'https://r.example/1', 'R: v1', NULL), ('papers', 'https://f.example/24.1', 'A b', NULL), ('models', 'https://f.example/n/k', 'M: k repository update', NULL),
      ('index', 'https://f.example/x1', 'First', NULL), ('broken', NULL, NULL, 'ParseError')) AS v(source, url, title, error)""",
)
def read_json_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = spark.createDataFrame([(s, k, "https://f.example/", b) for s, (k, b) in _JSON.items()], "source string, kind string, url string, body string")
    traits = [("releases", "R", None, None), ("models", "M", "n", None), ("index", None, None, "/x")]
    sources = spark.createDataFrame(traits, "source string, display_name string, namespace string, link_pattern string")
    return feeds.read_payloads(payloads, sources).select("source", "url", "title", "error")
