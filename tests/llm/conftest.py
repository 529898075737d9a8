import pytest

ITEM = "ordinal long, source string, title string, summary string, url string, discovered_at timestamp, extra string"


@pytest.fixture
def items(spark):
    """Builder of small raw_items: (ordinal, source, title, summary[, url[, discovered_at]])."""
    import datetime as dt

    def build(rows):
        full = [(*r, *[None, dt.datetime(2025, 9, 15)][len(r) - 4 :], "x") if len(r) < 6 else (*r, "x") for r in rows]
        return spark.createDataFrame(full, ITEM)

    return build
