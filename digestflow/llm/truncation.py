"""Texts cut off by field limits: hashed logistic regression trained on artificially cut values.

The closing line of each main body (of each quote) is described by its last and first characters and words, its punctuation, open quotes and brackets, its
length, and the text's length against the lengths its source piles up at. None of these features tells whether a line is complete: the
model learns that. In a bounded sample every value as it stands is a negative, and cut at a random place of its last line, now and then with an
ellipsis or a broken character behind, a positive; values that were cut before are so few that they only blur the negatives. A cut is
taken with the share of its line in the whole text, as a cut at any place of the text would be. The model then scores every
record. An exact check follows: list items, closing lines (tags, link, desk signature, part number) and texts that end a sentence are complete.

Null, empty and blank texts and rows without ordinal are no case. The sample (SAMPLE rows in the order of a hash of their key) only fits the model; lengths
are counted over all rows, every row is scored, and whole closing lines are looked at, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from digestflow.llm import pages
from digestflow.llm.base import skip_empty
from digestflow.session import cut

SAMPLE = 20_000
WIDTH, SEEN = 4_096, 30
THRESHOLD = 0.05  # low, as the negatives hold the true cases, and the exact check follows
_CLOSED = re.compile(r"[.!?。！？][\"'”’」』)）»*]*\Z")
_TRAIL = re.compile(r"\s*(?:…+|\.{3,}|[\[(（]\s*(?:…|\.{3})\s*[\])）]|�+)\s*\Z")
_ENDINGS = ("", "", "", "…", "...", " [...]", " […]", "�")


def _kind(ch: str) -> str:
    if ch in ".!?。！？":
        return "stop"
    if ch in "…":
        return "dots"
    if ch == "�":
        return "broken"
    if ch in "\"'”’」』)）»]":
        return "close"
    if ch in ",，、;；:：-—–":
        return "pause"
    if "一" <= ch <= "鿿":
        return "han"
    return "digit" if ch.isdigit() else "upper" if ch.isupper() else "lower" if ch.isalpha() else "other"


def closing_features(line: str) -> list[str]:
    """Features of a closing line, from its first and last characters and words, its punctuation and its length."""
    line = line.rstrip()
    words = line[:80].split() or [""]
    last = line[-80:].split() or [""]
    kinds = [_kind(c) for c in line[-4:]]
    before = line.rstrip("….�[]() ")
    stops = min(sum(line.count(c) for c in "。！？") + line.count(". ") + line.count("! ") + line.count("? "), 3)
    colon = min((line.find(c) for c in ":：" if c in line[:16]), default=-1) // 3
    return [
        "bias", "last:" + line[-1:], "kind1:" + kinds[-1], "kind2:" + "/".join(kinds[-2:]), "kind3:" + "/".join(kinds[-3:]), "kind4:" + "/".join(kinds),
        f"before:{_kind(before[-1]) if before else ''}:{len(line) - len(before)}", "start:" + words[0][:12].lower(), "starts:" + _kind(line.lstrip()[:1] or " "),
        "word:" + last[-1][-12:].lower(), f"words:{min(len(words), 9)}", f"size:{min(len(line) // 16, 12)}", f"address:{'://' in last[-1]}",
        f"quote:{line.count('“') - line.count('”') > 0}", f"bracket:{line.count('(') + line.count('（') - line.count(')') - line.count('）') > 0}",
        f"start-kind:{words[0][:12].lower()}:{kinds[-1]}", "head2:" + line[:2].lower(), "head3:" + line[:3].lower(), f"colon:{colon}", f"colon-kind:{colon}:{kinds[-1]}", f"stops-kind:{stops}:{kinds[-1]}", f"stops-colon-kind:{stops}:{colon >= 0}:{kinds[-1]}", f"parts:{min(line.count('、') + line.count(','), 4)}:{'。' in line or '. ' in line}", f"size-kind:{min(len(line) // 48, 4)}:{kinds[-1]}",
    ]


def _slots(features: list[str]) -> list[int]:
    return [xxhash.xxh32_intdigest(f) % WIDTH for f in features]


def limit_slots(near_limit: int, kind: str) -> list[int]:
    """Slots of the length: near_limit tells how far it is from one the source piles up at (0: just there, 9: far)."""
    return _slots([f"limit:{near_limit}", f"limit-kind:{near_limit}:{kind}"])


def is_open(line: str) -> bool:
    """The exact check: neither an item nor a closing line nor the end of a sentence."""
    line = line.rstrip()
    return not (pages.is_item(line) or pages.is_closing(line) or (_CLOSED.search(line) is not None and not _TRAIL.search(line)))


def artificial_cut(line: str, size: int, seed: int) -> str | None:
    """The line cut inside, or None: short lines cannot be cut, and a line is cut with its share in the text of `size` characters."""
    rng = np.random.default_rng(seed)
    line = line.rstrip()
    if len(line) < 12 or rng.random() * size > len(line):
        return None
    broken = line[: int(rng.integers(6, len(line) - 1))].rstrip()
    if _kind(broken[-1:] or " ") == "stop":
        return None
    return broken + _ENDINGS[int(rng.integers(len(_ENDINGS)))]


def fit(rows: list[list[int]], labels: list[float], steps: int = 500) -> np.ndarray:
    """Weights of the logistic regression over slots; both labels weigh the same in all."""
    weights = np.zeros(WIDTH + 1, dtype=np.float64)
    share = np.mean(labels) if labels else 0.0
    if not 0.0 < share < 1.0:
        return weights[:WIDTH]
    # equal rows are fitted once, by their number and share of positives
    tally: dict[tuple[int, ...], list[float]] = {}
    for slots, label in zip(rows, labels, strict=True):
        entry = tally.setdefault(tuple(sorted(set(slots))), [0.0, 0.0])
        w = 0.5 / share if label else 0.5 / (1.0 - share)
        entry[0] += w
        entry[1] += w * label
    width = max(map(len, tally))
    x = np.full((len(tally), width), WIDTH, dtype=np.int32)  # the slot behind the last stays zero
    for i, slots in enumerate(tally):
        x[i, : len(slots)] = slots
    n, positive = np.array(list(tally.values())).T
    common = np.bincount(x.ravel(), minlength=WIDTH + 1) >= SEEN  # a rare word would only learn its own rows by heart
    common[WIDTH] = False
    speed = np.full(WIDTH + 1, 1e-12)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-weights[x].sum(axis=1)))
        g = np.bincount(x.ravel(), np.repeat((n * p - positive) / n.sum(), width), WIDTH + 1) + 1e-5 * weights
        g[~common] = 0.0
        speed += g * g
        weights -= 0.3 * g / np.sqrt(speed)
    return weights[:WIDTH]


def _closings(bound: int):
    """Slots of each whole closing line; rows whose key hashes below `bound` (of 2^20) also get the slots of an artificial cut."""

    @skip_empty
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for table, ordinal, line, size in zip(batch["rec_table"], batch["ordinal"], batch["line"], batch["size"], strict=True):
                line = line.rstrip()
                place = xxhash.xxh64_intdigest(f"{table}/{ordinal}")
                sampled = place % (1 << 20) < bound
                broken = artificial_cut(line, int(size), place) if sampled else None
                out.append((_slots(closing_features(line)), _kind(line[-1:] or " "), is_open(line), sampled, place >> 1, _slots(closing_features(broken)) if broken else None, _kind(broken[-1]) if broken else None))
            done = pd.DataFrame(out, columns=["slots", "kind", "open", "sampled", "place", "cut_slots", "cut_kind"])
            yield pd.concat([batch[["rec_table", "ordinal", "source", "size"]].astype(object).reset_index(drop=True), done], axis=1)

    return run


def closings(texts: DataFrame, rows: int, sample: int = SAMPLE) -> DataFrame:
    """texts(rec_table, ordinal, source, text) to the slots of the texts that are not blank, with near_limit. rows: how many texts there are about, so that the hash bound holds somewhat more than the sample."""
    bound = int(min(1.0, 1.5 * sample / max(1, rows)) * (1 << 20)) + 1
    last = F.try_element_at(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S")), F.lit(-1))
    told = texts.where(F.col("text").rlike(r"\S") & F.col("ordinal").isNotNull()).select("rec_table", "ordinal", "source", last.alias("line"), F.length("text").alias("size"))
    schema = "rec_table string, ordinal long, source string, size int, slots array<int>, kind string, open boolean, sampled boolean, place long, cut_slots array<int>, cut_kind string"
    told = cut(told.mapInPandas(_closings(bound), schema), "closings")
    # lengths a source piles up at: many more texts than in the neighbourhood
    counts = told.groupBy("rec_table", "source", "size").agg(F.count("*").alias("n"))
    around = F.avg("n").over(W.partitionBy("rec_table", "source").orderBy("size").rangeBetween(-40, 40))
    piles = counts.withColumn("around", around).where((F.col("n") >= 4) & (F.col("n") >= 3 * F.col("around"))).select(F.col("rec_table").alias("_t"), F.col("source").alias("_s"), F.explode(F.sequence(F.col("size"), F.col("size") + 6)).alias("_n")).distinct()
    joined = told.join(piles, (F.col("rec_table") == F.col("_t")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n")), "left")
    return joined.select(*told.columns, F.when(F.col("_n").isNotNull(), 0).otherwise(9).alias("near_limit"))


def trained(told: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights fitted on at most `sample` rows and their artificial cuts."""
    chosen = told.where("sampled").orderBy("place", "rec_table", "ordinal").limit(sample).select("place", "slots", "kind", "near_limit", "cut_slots", "cut_kind").toPandas()
    rows, labels = [], []
    for r in chosen.itertuples():
        rows.append([*r.slots, *limit_slots(r.near_limit, r.kind)])
        labels.append(0.0)
        if r.cut_slots is not None:
            rows.append([*r.cut_slots, *limit_slots(0 if r.place % 10 < 6 else 9, r.cut_kind)])
            labels.append(1.0)
    return fit(rows, labels)


def _score(weights: object):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = weights.value
        for batch in batches:
            margin = [float(w[[*slots, *limit_slots(near, kind)]].sum()) for slots, near, kind in zip(batch["slots"], batch["near_limit"], batch["kind"], strict=True)]
            probability = 1.0 / (1.0 + np.exp(-np.array(margin)))
            yield pd.DataFrame({"rec_table": batch["rec_table"].astype(object), "ordinal": batch["ordinal"], "source": batch["source"].astype(object), "probability": probability, "open": batch["open"], "truncated": (probability > THRESHOLD) & batch["open"].to_numpy(dtype=bool)})

    return run


def score(texts: DataFrame, sample: int = SAMPLE, rows: int | None = None) -> DataFrame:
    """(rec_table, ordinal, source, probability, open, truncated) of every text that is not blank: what the model says, the exact check, and both."""
    told = closings(texts, texts.count() if rows is None else rows, sample)
    weights = told.sparkSession.sparkContext.broadcast(trained(told, sample))
    return told.select("rec_table", "ordinal", "source", "slots", "kind", "near_limit", "open").mapInPandas(_score(weights), "rec_table string, ordinal long, source string, probability double, open boolean, truncated boolean")


def agreement(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(rec_table, by_model, by_check, rows): what the model alone finds against the exact check alone."""
    return scored.groupBy("rec_table", (F.col("probability") > threshold).alias("by_model"), F.col("open").alias("by_check")).agg(F.count("*").alias("rows"))


def rates(scored: DataFrame, all_texts: DataFrame) -> DataFrame:
    """(rec_table, source, records, truncated, rate): how often each source truncates; blank texts count as records."""
    records = all_texts.groupBy("rec_table", "source").agg(F.count("*").alias("records"))
    hit = scored.where("truncated").groupBy("rec_table", "source").agg(F.count("*").alias("truncated")).withColumnsRenamed({"rec_table": "_t", "source": "_s"})
    joined = records.join(hit, (F.col("rec_table") == F.col("_t")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    return joined.select("rec_table", "source", "records", F.coalesce("truncated", F.lit(0)).alias("truncated"), F.round(F.coalesce("truncated", F.lit(0)) / F.col("records"), 6).alias("rate"))


def claim_sources(claims: DataFrame, news_events: DataFrame) -> DataFrame:
    """claims with `source`: that of the evidence item the claim cites, null for unknown events or places."""
    items = news_events.select(F.col("event_id").alias("_e"), F.posexplode("items").alias("_p", "_i")).select(F.concat_ws("-", "_e", (F.col("_p") + 1).cast("string")).alias("_id"), F.col("_i.source").alias("source")).dropDuplicates(["_id"])
    return claims.join(items, F.col("evidence_id") == F.col("_id"), "left").select("ordinal", "source", "quote")
