"""Registered queries of the llm operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestflow.llm import batches, graphindex, historyindex, lines, lookalikes, mixing, mojibake, nearcopies, pages, tokens, truncation
from digestflow.llm.base import all_records
from digestflow.session import cut, fresh_folder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
HEADLINE = ("p1_found", "p2_found", "p3_found", "p4_found", "p6_found", "p7_found", "p8_ids", "p9_mix", "p10_found")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            SQL[name] = sql
        return query

    return add


@register(
    "p2_found",
    r"""
WITH l AS (
  SELECT ordinal, source, u.line_no, lower(regexp_replace(u.line, '[^\p{L}]+', '', 'g')) AS letters
  FROM (SELECT ordinal, source, string_split(coalesce(summary, ''), chr(10)) AS parts FROM raw_items) r,
       LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no) u),
f AS (
  SELECT source, letters FROM l WHERE letters <> '' GROUP BY source, letters
  HAVING count(DISTINCT ordinal) >= 6 AND count(DISTINCT ordinal) >= 0.05 * (SELECT count(*) FROM raw_items r WHERE r.source = l.source))
SELECT l.ordinal, l.line_no::BIGINT AS line_no FROM l JOIN f USING (source, letters)
""",
)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(table(spark, sf_dir, "raw_items"))


@register("p2_sequences")
def p2_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.prefix_span(table(spark, sf_dir, "raw_items"))


@register("p2_cleaned")
def p2_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_repeated_lines(table(spark, sf_dir, "raw_items")).select("ordinal", "cleaned")


@register("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.removed_lines(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "sources"))


@register("p3_bodies")
def p3_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_bodies(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "sources")).select("ordinal", "body")


def _digested(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = pages.main_bodies(all_records(spark, sf_dir), table(spark, sf_dir, "sources"), F.col("counted"), then=nearcopies._digest, schema=nearcopies.DIGESTS)
    return cut(bodies, "runs")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.grouped(_digested(spark, sf_dir))


@register("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.group_pairs(_groups(spark, sf_dir))


@register("p1_groups")
def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir)


@register("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = batches.site_names(table(spark, sf_dir, "sources"))
    items = table(spark, sf_dir, "raw_items").select("ordinal", "url", "title", "discovered_at")
    return batches.known_rows(items, table(spark, sf_dir, "history_urls"), table(spark, sf_dir, "history_titles"), names)


@register("p1_recall")
def p1_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    digested = _digested(spark, sf_dir)
    return nearcopies.link_recall(digested, nearcopies.links(digested))


def _appended(spark: SparkSession, sf_dir: str, last: int = 2) -> tuple[DataFrame, list[tuple[str, dict]]]:
    """Known rows where the last batches are appended one by one to a stored index of all before; and what each append read."""
    items = table(spark, sf_dir, "raw_items").select("ordinal", "url", "title", "discovered_at")
    day = F.col("discovered_at").cast("date")
    days = [r[0] for r in items.select(day.alias("d")).where("d is not null").distinct().orderBy(F.col("d").desc()).limit(last).collect()]
    index = historyindex.HistoryIndex(spark, fresh_folder(spark, "index"), batches.site_names(table(spark, sf_dir, "sources")))
    base = items.where(~day.isin(days)) if days else items
    known, reports = index.create(base, table(spark, sf_dir, "history_urls"), table(spark, sf_dir, "history_titles")), []
    for d in sorted(days):
        found, revised, report = index.append(items.where(day == F.lit(d)))
        known = known.unionByName(found).unionByName(revised)
        reports.append((str(d), report))
    return known.distinct(), reports


@register("p4_appended")
def p4_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, sf_dir)[0]


@register("p4_append_reads")
def p4_append_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(d, *[r[k] for k in ("rows", "known", "revised", "titles_new", "titles_opened", "titles_stored")]) for d, r in _appended(spark, sf_dir)[1]]
    return spark.createDataFrame(rows, "batch string, rows long, known long, revised long, titles_new long, titles_opened long, titles_stored long")


@register("p8_ids")
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(table(spark, sf_dir, "documents"))


@register("p8_round_trip")
def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return cut(documents.select("doc_id", "source").join(tokens.count_tokens(documents), "doc_id"), "sized")


@register("p9_mix")
def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


@register("p9_shares")
def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "mix_targets")
    return mixing.shares(mixing.mix(_sized(spark, sf_dir), targets), targets)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.canonical_texts(lookalikes.text_records(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "claims")))


@register("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir).where("canonical <> text").select("rec_table", "ordinal").distinct()


@register("p6_canonical")
def p6_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir)


@register("p6_decisions")
def p6_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.decisions(lookalikes.text_records(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "claims")))


def _bodies_and_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = pages.main_bodies(table(spark, sf_dir, "raw_items"), table(spark, sf_dir, "sources"))
    quotes = truncation.claim_sources(table(spark, sf_dir, "claims"), table(spark, sf_dir, "news_events"))
    whole = bodies.select(F.lit("raw_items").alias("rec_table"), "ordinal", "source", F.col("body").alias("text"))
    return whole.unionByName(quotes.select(F.lit("claims").alias("rec_table"), "ordinal", "source", F.col("quote").alias("text")))


def _rows(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "raw_items").count() + table(spark, sf_dir, "claims").count()  # from the files' footers


@register("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.score(_bodies_and_quotes(spark, sf_dir), rows=_rows(spark, sf_dir)).where("truncated").select("rec_table", "ordinal")


@register("p7_rates")
def p7_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = cut(_bodies_and_quotes(spark, sf_dir), "texts")
    return truncation.rates(truncation.score(texts, rows=_rows(spark, sf_dir)), texts)


@register("p7_agreement")
def p7_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.agreement(truncation.score(_bodies_and_quotes(spark, sf_dir), rows=_rows(spark, sf_dir)))


@register("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled_documents(table(spark, sf_dir, "documents"))


@register("p10_repaired")
def p10_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.repaired_documents(table(spark, sf_dir, "documents"))


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Titles of all rows and entries, their points, and the shards; history has negative ids and a segment of its own."""
    items = table(spark, sf_dir, "raw_items")
    day = F.datediff(F.col("discovered_at").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    days = [r[0] for r in items.select(day.alias("d")).where("d is not null").distinct().orderBy("d").collect()]  # one value for each day
    segment_of = F.create_map(*[F.lit(x) for pair in graphindex.compaction(days).items() for x in pair]) if days else F.create_map().cast("map<bigint,bigint>")
    rows = items.select(F.col("ordinal").alias("id"), F.try_element_at(segment_of, day).cast("long").alias("segment"), "title")
    past = table(spark, sf_dir, "history_titles").select((-F.monotonically_increasing_id() - 1).alias("id"), F.lit(-1).cast("long").alias("segment"), "title")
    titles = cut(rows.unionByName(past), "titles")
    points = cut(graphindex.sketched(titles), "points")
    return titles, points, graphindex.build_index(points)


@register("p4_index")
def p4_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles, points, shards = _indexed(spark, sf_dir)
    return graphindex.rerank(graphindex.search(shards, points.where("id >= 0 and id % 20 = 0")), titles)


@register("p4_index_recall")
def p4_index_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, points, shards = _indexed(spark, sf_dir)
    asked = cut(points.where("id >= 0 and id % 20 = 0"), "asked")
    return graphindex.recall(graphindex.search(shards, asked), graphindex.search(shards, asked, exhaustive=True))


@register("p4_graph_recall")
def p4_graph_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph against the title relation of p4_found: distinct normalised titles as nodes, all matches of the titles first seen in a row divisible by 20."""
    items = table(spark, sf_dir, "raw_items").select("ordinal", "url", "title", "discovered_at")
    past = table(spark, sf_dir, "history_titles").select(F.lit(-1).cast("long").alias("ordinal"), F.lit(-1).cast("long").alias("day"), F.lit(0).cast("long").alias("url_node"), "title")
    rows = batches.normalised(batches.rows_of(items).unionByName(past), batches.site_names(table(spark, sf_dir, "sources"))).where("title_node is not null")
    titles = cut(rows.groupBy("title_node").agg(F.min("units").alias("units"), F.min("plain").alias("plain"), F.min("ordinal").alias("first"), F.min("day").alias("day")), "titles")
    days = [r[0] for r in titles.select("day").distinct().orderBy("day").collect()]  # one value for each day
    segment = F.try_element_at(F.create_map(*[F.lit(x) for pair in graphindex.compaction(days).items() for x in pair]), F.col("day")) if days else F.col("day")
    points = cut(graphindex.sketched(titles.select(F.col("title_node").alias("id"), segment.cast("long").alias("segment"), F.col("units").alias("title"))), "points")
    asked = titles.where("first >= 0 and first % 20 = 0").select("title_node")
    due = cut(batches.matching_titles(titles.select("title_node", "units", "plain"), asked), "due")
    queries = cut(points.join(due.select("id").distinct(), "id", "left_semi"), "queries")
    return graphindex.pair_recall(graphindex.search(graphindex.build_index(points), queries, k=64, radius=48), due)
