"""Every problem's queries over tables with nulls in any column, columns of clashing names, repeated rows, and over empty tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

NAMES = [n for n in contract.queries() if re.match(r"p\d", n)]
TABLES = ("raw_items", "news_events", "claims", "source_refs", "sources", "history_urls", "history_titles", "documents", "mix_targets")
CLASHES = ("key", "line", "pos", "w", "_s", "_o", "token", "body", "page", "counted", "band", "segment", "text_key", "tokens", "passage", "_site", "ids", "zone", "tail")


@pytest.fixture(scope="module")
def odd(spark, data_dir, tmp_path_factory):
    """Small tables: in each row one column in turn is null, and rows stand twice."""
    root = tmp_path_factory.mktemp("odd")
    for name in TABLES:
        df = spark.read.parquet(f"{data_dir}/{name}.parquet").limit(120)
        n = len(df.columns)
        turn = df.withColumn("_turn", F.pmod(F.monotonically_increasing_id(), F.lit(2 * n)))
        out = turn.select(*[F.when(F.col("_turn") != i, F.col(c)).alias(c) for i, c in enumerate(df.columns)])
        for clash in CLASHES:
            if clash not in df.columns:
                out = out.withColumn(clash, F.lit("clash"))
        out.unionByName(out.limit(10)).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(scope="module")
def empty(spark, data_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        spark.read.parquet(f"{data_dir}/{name}.parquet").limit(0).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", NAMES)
def test_nulls_clashes_and_repeats(spark, odd, name):
    rows = contract.queries()[name](spark, odd).collect()
    keys = [c for c in ("ordinal", "ordinal_a", "ordinal_b") if rows and c in rows[0].asDict()]
    assert all(r[k] is not None for r in rows for k in keys) or name == "p2_cleaned"


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    expected = 1 if name == "p4_index_recall" else 0
    assert contract.queries()[name](spark, empty).count() == expected
