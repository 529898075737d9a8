"""Records shared by the text operators and joins whose broadcast side is size-checked."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestflow.session import table

MAX_LITERAL_KEYS = 20_000
HAN = r"\x{2E80}-\x{2FDF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, source, title, summary, counted) of raw_items (counted) and of the items inside news_events."""
    raw = table(spark, sf_dir, "raw_items").select("ordinal", "source", "title", "summary", F.lit(True).alias("counted"))
    items = table(spark, sf_dir, "news_events").select(F.explode("items").alias("i")).select("i.ordinal", "i.source", "i.title", "i.summary", F.lit(False).alias("counted"))
    return raw.unionByName(items)


def bounded_keys(keys: DataFrame, limit: int = MAX_LITERAL_KEYS) -> list | None:
    """The single column of a frame as a list if it holds at most `limit` rows, else None: the caller then joins instead."""
    rows = keys.limit(limit + 1).collect()
    return [r[0] for r in rows] if len(rows) <= limit else None


def skeleton(line: Column) -> Column:
    """The letters of a line in lower case: lines with the same letters are the same line."""
    return F.lower(F.regexp_replace(line, r"[^\p{L}]+", ""))


def skip_empty(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A batch function that yields no frames without rows: those have no column types."""

    @wraps(run)
    def only_full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (frame for frame in run(batches) if len(frame))

    return only_full
