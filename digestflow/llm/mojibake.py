"""Text decoded with the wrong encoding: found by expectation-maximisation over latent encoding chains, repaired by posterior.

A chain says which decoder was wrongly used and which one was right; taking it back means encoding with the first and decoding with
the second. For every passage and chain that can be taken back, the evidence is the log-likelihood ratio of the repaired against
the given characters under the character frequencies of the whole corpus. Each source (and field) holds a mixing weight for
every chain and for clean text: the E-step gives each passage's posterior over chains, the M-step averages posteriors within the source, so
weak evidence of single passages is pooled. Passages are repaired by the chain of greatest posterior, again until nothing is gained.

Replacement characters are evidence of a chain that lost its bytes: found, not restorable. Null, empty and ASCII texts and rows without doc_id are no case.
Correct accents, symbols and other scripts lose likelihood under every chain and stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestflow.llm.base import skip_empty
from digestflow.session import cut, discard

# Fixed values: (decoder wrongly used, right decoder).
CHAINS = (
    ("cp1252", "utf-8"), ("mac_roman", "utf-8"), ("cp437", "utf-8"), ("cp850", "utf-8"), ("cp1251", "utf-8"), ("koi8_r", "utf-8"),
    ("cp1250", "utf-8"), ("gbk", "utf-8"), ("big5", "utf-8"), ("cp932", "utf-8"), ("euc_kr", "utf-8"), ("cp850", "cp1252"), ("cp437", "cp1252"),
    ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "gbk"), ("cp1252", "big5"), ("cp1252", "cp932"), ("cp1252", "euc_jp"),
    ("cp1252", "euc_kr"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp866", "cp1251"),
    ("cp1251", "cp866"), ("big5", "gbk"), ("gbk", "big5"), ("gbk", "cp932"), ("cp932", "gbk"),
)
LOST = len(CHAINS)
MULTI_BYTE = {"gbk", "big5", "cp932", "euc_jp", "euc_kr"}
LOST_EVIDENCE = 20.0
PRIOR = 0.01
_PASSAGE = re.compile(r"[^\n]+?(?:[.!?。！？]+[\"”’»]*(?=\s)|(?=\n)|\Z)", re.S)
_RUN = re.compile(r"[^\x00-\x7f]+")
_EAST = re.compile(r"[　-ヿ㐀-䶿一-鿿＀-｠“”‘’…—·]+")
_WESTERN_BYTES = re.compile(r"[\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")


def _to_bytes(text: str, decoder: str) -> bytes:
    """The bytes that the decoder read as this text; undefined bytes of cp1252 and cp1250 stand as control characters."""
    if decoder in ("cp1252", "cp1250"):
        try:
            return text.encode(decoder)
        except UnicodeEncodeError:
            return b"".join(bytes([ord(c)]) if "\x80" <= c <= "\x9f" else c.encode(decoder) for c in text)
    return text.encode(decoder)


def take_back(text: str, chain: int) -> str | None:
    """The text before the wrong decoding, or None where the chain cannot have made it."""
    wrong, right = CHAINS[chain]
    try:
        out = _to_bytes(text, wrong).decode(right)
    except (UnicodeError, ValueError):
        return None
    return out if out and out != text else None


class Evidence:
    """Log-likelihood ratios of chains under character frequencies."""

    def __init__(self, counts: dict[str, int]) -> None:
        total = sum(counts.values()) + 0.5 * len(counts) + 1.0
        self.log = {c: math.log((n + 0.5) / total) for c, n in counts.items()}
        self.floor = math.log(0.5 / total)
        self.memo: dict[str, list[tuple[int, float]]] = {}

    def value(self, text: str) -> float:
        log, floor = self.log, self.floor
        return sum(log.get(c, floor) + (-3.0 if "\x80" <= c <= "\x9f" else 0.0) for c in text if c > "\x7f")

    def of_run(self, run: str) -> list[tuple[int, float]]:
        """(chain, ratio) of the chains that a run of characters beyond ASCII can be taken back by."""
        if _EAST.fullmatch(run) and self.value(run) > -8.5 * len(run):
            return []
        known = self.memo.get(run)
        if known is None:
            given = self.value(run)
            known = []
            for chain in range(len(CHAINS)):
                back = take_back(run, chain)
                if back is not None:
                    known.append((chain, self.value(back) - given))
            if len(self.memo) < 100_000:
                self.memo[run] = known
        return known

    def of_passage(self, passage: str) -> list[tuple[int, float, bool]]:
        """(chain, ratio, whole): positive evidence; whole if the passage was taken back as one, else run by run."""
        sums: dict[int, float] = {}
        for run in _RUN.findall(passage):
            for chain, ratio in self.of_run(run):
                if CHAINS[chain][1] == "utf-8" and ratio <= 0:
                    continue
                sums[chain] = sums.get(chain, 0.0) + ratio
        out = [(c, r, False) for c, r in sums.items() if r > 0]
        if len(_WESTERN_BYTES.findall(passage)) >= 4:
            given = self.value(passage)
            for chain, (wrong, right) in enumerate(CHAINS):
                if wrong == "cp1252" and right in MULTI_BYTE:
                    back = take_back(passage, chain)
                    if back is not None and self.value(back) - given > max(0.0, sums.get(chain, 0.0)):
                        out = [x for x in out if x[0] != chain] + [(chain, self.value(back) - given, True)]
        if "�" in passage:
            out.append((LOST, LOST_EVIDENCE, True))
        return out


def apply_chain(passage: str, chain: int, whole: bool, evidence: Evidence) -> str:
    """A passage with a chain taken back, as a whole or in the runs that gain by it."""
    if chain == LOST:
        return passage
    if whole:
        return take_back(passage, chain) or passage
    utf8 = CHAINS[chain][1] == "utf-8"

    def run(m: re.Match[str]) -> str:
        gain = dict(evidence.of_run(m[0])).get(chain)
        return take_back(m[0], chain) or m[0] if gain is not None and (gain > 0 or not utf8) else m[0]

    return _RUN.sub(run, passage)


@skip_empty
def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: dict[str, int] = {}
        for text in batch["text"]:
            if text and not text.isascii():
                for run in _RUN.findall(text):
                    for c in run:
                        counts[c] = counts.get(c, 0) + 1
        yield pd.DataFrame({"code": [ord(c) for c in counts], "n": list(counts.values())}).astype({"code": "int64", "n": "int64"})


def character_counts(documents: DataFrame) -> dict[str, int]:
    """Counts of the characters beyond ASCII over all documents; at most one entry for each code point of Unicode."""
    rows = documents.select("text").mapInPandas(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    return {chr(c): int(n) for c, n in zip(rows["code"], rows["n"], strict=True)}


def _gather(shared: object):
    @skip_empty
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        evidence = Evidence(shared.value)
        for batch in batches:
            rows = []
            for doc_id, source, text in zip(batch["doc_id"], batch["source"], batch["text"], strict=True):
                if not text or text.isascii():
                    continue
                for number, m in enumerate(_PASSAGE.finditer(text)):
                    if not m[0].isascii() and (found := evidence.of_passage(m[0])):
                        rows.append((doc_id, source or "", number, [{"chain": c, "ratio": r, "whole": w} for c, r, w in found]))
            yield pd.DataFrame(rows, columns=["doc_id", "source", "passage", "found"]).astype({"doc_id": "int64", "passage": "int32"})

    return run


def _expected(weighed: DataFrame, weights: DataFrame | None) -> DataFrame:
    """weighed with `posterior`, one number for each chain of `found`. All evidence of a passage lies in its row, so the E-step moves no passage."""
    prior = F.lit(math.log(PRIOR / len(CHAINS)))
    if weights is None:
        scores = F.transform("found", lambda f: prior + F.least(f["ratio"], F.lit(300.0)))
        joined = weighed
    else:
        joined = weighed.join(weights.select("source", "logs"), "source", "left")
        scores = F.transform("found", lambda f: F.coalesce(F.try_element_at("logs", f["chain"]), prior) + F.least(f["ratio"], F.lit(300.0)))
    joined = joined.withColumn("scores", scores).withColumn("top", F.greatest(F.array_max("scores"), F.lit(0.0)))
    weight = F.transform("scores", lambda x: F.exp(x - F.col("top")))
    joined = joined.withColumn("ws", weight).withColumn("whole_sum", F.exp(-F.col("top")) + F.aggregate("ws", F.lit(0.0), lambda t, x: t + x))
    return joined.withColumn("posterior", F.transform("ws", lambda x: x / F.col("whole_sum"))).select("doc_id", "source", "passage", "found", "posterior")


def posteriors(documents: DataFrame, counts: dict[str, int], rounds: int = 12, settled: float = 1e-3) -> DataFrame:
    """(doc_id, source, passage, found, posterior) of every passage with evidence, after EM over the sources until no weight moves by more than `settled`, or `rounds` are over."""
    shared = documents.sparkSession.sparkContext.broadcast(counts)  # bounded by the code points of Unicode
    schema = "doc_id long, source string, passage int, found array<struct<chain:int,ratio:double,whole:boolean>>"
    weighed = cut(documents.where("doc_id is not null").select("doc_id", "source", "text").mapInPandas(_gather(shared), schema), "evidence")
    sizes = documents.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("texts"))
    weights = None
    for _ in range(rounds):
        # a source's weight of a chain: expected passages among its texts, with a pinch of the prior
        hits = _expected(weighed, weights).select("source", F.explode(F.arrays_zip("found.chain", "posterior")).alias("z")).groupBy("source", F.col("z")["chain"].alias("chain")).agg(F.sum(F.col("z")["posterior"]).alias("hits"))
        weight = (F.col("hits") + F.lit(PRIOR)) / (F.col("hits") + F.col("texts") * F.lit(4) + F.lit(1.0))
        logs = hits.join(sizes, "source").groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("chain", F.log(weight)))).alias("logs"))  # as many entries as chains
        following = cut(logs, "weights")
        if weights is not None:
            both = following.join(weights.select("source", F.col("logs").alias("was")), "source", "left")
            moves = F.transform(F.map_entries("logs"), lambda e: F.abs(F.exp(e["value"]) - F.coalesce(F.exp(F.try_element_at("was", e["key"])), F.lit(0.0))))
            moved = both.agg(F.max(F.array_max(moves))).first()[0]
            discard(weights)
            if moved is None or moved <= settled:
                weights = following
                break
        weights = following
    return cut(_expected(weighed, weights), "posteriors")


def _sure(threshold: float) -> Column:
    return F.aggregate("posterior", F.lit(0.0), lambda t, x: t + x) > threshold


def garbled_documents(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id) of the documents of which a passage was decoded wrongly, restorable or not."""
    return posteriors(documents, character_counts(documents)).where(_sure(threshold)).select("doc_id").distinct()


def _repair(shared: object, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        evidence = Evidence(shared.value)
        for batch in batches:
            out, whole_again = [], []
            for text, found in zip(batch["text"], batch["found"], strict=True):
                best = {}
                for f in found:
                    chance, chain, whole = max((p, x["chain"], x["whole"]) for p, x in zip(f["posterior"], f["found"], strict=True))
                    if chance > threshold / 2:
                        best[f["passage"]] = (chain, whole)
                pieces, at = [], 0
                for number, m in enumerate(_PASSAGE.finditer(text)):
                    pieces.append(text[at : m.start()])
                    piece, at = m[0], m.end()
                    if number in best:
                        piece = apply_chain(piece, *best[number], evidence)
                        for _ in range(2):  # decoded wrongly more than once
                            more = [x for x in evidence.of_passage(piece) if x[0] != LOST and x[1] > 12.0]
                            if not more:
                                break
                            chain, _, whole = max(more, key=lambda x: x[1])
                            piece = apply_chain(piece, chain, whole, evidence)
                    pieces.append(piece)
                out.append("".join([*pieces, text[at:]]))
                whole_again.append("�" not in out[-1])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "repaired": out, "restored": whole_again})

    return run


def repaired_documents(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, repaired, restored) of the garbled documents; restored is false where bytes were lost."""
    counts = character_counts(documents)
    found = posteriors(documents, counts).groupBy("doc_id").agg(F.collect_list(F.struct("passage", "found", "posterior")).alias("found"), F.max(_sure(threshold)).alias("bad"))
    shared = documents.sparkSession.sparkContext.broadcast(counts)
    return documents.select("doc_id", "text").join(found.where("bad"), "doc_id").mapInPandas(_repair(shared, threshold), "doc_id long, repaired string, restored boolean")
