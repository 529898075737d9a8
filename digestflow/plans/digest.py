"""The main dataflow as one lazily built plan: items, admission, linkage, events, history, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.operators import items, linkage, ranking


def daily_digest(raw_items: DataFrame, history_urls: DataFrame, history_titles: DataFrame, limit: int = 80) -> DataFrame:
    """(event_id, title, canonical_url, published_us, sources, members): the best new stories among the admitted items."""
    typed = items.with_run_time(items.typed_items(raw_items))
    admitted = items.admission(typed).where(F.col("reason").isin("accepted", "corroborated")).select("ordinal")
    fresh = typed.join(admitted, "ordinal", "left_semi")
    stories = linkage.events(fresh, linkage.story_groups(fresh))
    old = ranking.told_before(stories.select("event_id", "canonical_url", "title"), history_urls, history_titles)
    new = stories.join(old.select("event_id"), "event_id", "left_anti")
    return new.orderBy(F.col("sources").desc(), F.col("published_us").desc_nulls_last(), "event_id").limit(limit).select("event_id", "title", "canonical_url", "published_us", "sources", "members")
