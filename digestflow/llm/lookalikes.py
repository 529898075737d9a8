"""One consistent form of text whose characters only look alike: tries of the corpus vocabulary and a weighted edit automaton.

A token that may hold odd characters (other widths and styles, joined or compatibility forms, split accents, letters of another script inside a
word, invisible characters) walks a trie of the clean words of the corpus. The automaton reads look-alikes and ignorable
characters at no cost, letters that are alike only loosely at LOOSE and a dropped accent at DROPPED; any other edit exceeds the BUDGET. It ends
at every spelling the token may stand for; the cheapest and then most used one is canonical, written in the token's own case. A row is
found if a token ends at another spelling than its own. Only tokens that end nowhere, and what stands between tokens, are normalised by table.

The tries are sharded by the first letters and the length a word has once look-alikes are folded: no path at a cost within the budget leaves its shard.

Left as they are: Chinese punctuation, typographic quotes, dashes and ellipses, emoji sequences, Greek symbols, and words wholly in
another script. Null texts and rows without ordinal give no row; texts without odd characters are not touched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestflow.llm.base import skip_empty
from digestflow.session import cut

# Cyrillic and Greek letters that look like a Latin letter.
LATIN_TWINS = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХЗаеѕіјорсухԁһԛԝѵ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονικρυτ",
        "ABESIJKMHOPCTYX3aesijopcyxdhqwv" "ABEZHIKMNOPTYXovikput",
        strict=True,
    )
)
LATIN_TWINS |= {"ӏ": "l", "Ӏ": "I", "ı": "i", "ɡ": "g", "ɑ": "a", "к": "k", "т": "t", "м": "m", "н": "h", "в": "b", "г": "r", "п": "n"}
_LOWER_ONLY = set("ктмнвгп")  # alike in shape only loosely: a twin inside a word that also holds Latin letters
STRICT_TWINS = {twin: latin for twin, latin in LATIN_TWINS.items() if twin not in _LOWER_ONLY}
CYRILLIC_TWINS = {latin: twin for twin, latin in LATIN_TWINS.items() if "Ѐ" <= twin <= "ӿ" and twin not in _LOWER_ONLY}
CYRILLIC_TWINS |= {"k": "к"}
GREEK_TWINS = {latin: twin for twin, latin in LATIN_TWINS.items() if "Ͱ" <= twin <= "Ͽ"}

INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff"
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
# letters and digits of other widths and styles, ligatures, radicals and compatibility ideographs
STYLED = (
    "⺀-⻳⼀-⿕ㄱ-ㆎ㌀-㏿豈-\ufaffﬀ-ﬆﬓ-ﬗ０-９Ａ-Ｚａ-ｚｦ-ﾝ"
    "℀℁ℂ℅-ℇℊ-ℓℕℙ-ℝℤℨK-ℭℯ-ℴℹℼ-ℿⅅ-ⅉⅠ-ⅿ①-⑳Ⓐ-ⓩ"
    "Ǆ-ǌǱ-ǳĲĳŉ\U0001d400-\U0001d7ff\U0001f110-\U0001f12f\U0001f130-\U0001f149\U0001f150-\U0001f169\U0001f170-\U0001f189\U0002f800-\U0002fa1f"
)
MARKS = "\u0300-\u0345\u0347-\u034e\u0350-\u036f"
LATIN_ODD = "ıɡɑ"  # Latin letters that look like another; the table leaves them, as some languages write them
_HINT = re.compile(rf"[{INVISIBLE}{SPACES}{STYLED}{MARKS}]|[Ͱ-ϿЀ-ԯ]")
_STYLED = re.compile(rf"[{STYLED}]+")
_SPLIT = re.compile(rf"[^\W\d_][{MARKS}]+")
_MARKS = re.compile(rf"[{MARKS}]")
_SPACE = re.compile(rf"[{SPACES}]")
_HIDDEN = re.compile(rf"[{INVISIBLE}]+")
_PICTURE = re.compile("[←-⯿〰〽㊗㊙\U0001f000-\U0001faff\u20e3#*0-9©®]")
_JOINING = re.compile("[\u0600-\u08ff\u0900-\u0dff\u0e00-\u0effက-႟ក-\u17ff᠀-\u18af㐀-鿿\U00020000-\U0003ffff]")
_WORD = re.compile(rf"[^\W_㐀-鿿豈-\ufaff⺀-\u2fdf](?:[^\W_㐀-鿿豈-\ufaff⺀-\u2fdf]|[{MARKS}]|[{INVISIBLE}])*")
_CLEAN_WORD = re.compile("[A-Za-z\u00c0-\u024f]{2,40}|[\u0400-\u04ff]{2,40}|[\u0370-\u03ff]{2,40}")
# Costs of the automaton; what looks the same costs nothing.
LOOSE, DROPPED, BUDGET = 0.25, 0.5, 0.75
SHARD_LETTERS, SHARD_TOKENS = 4, 20_000
_HAN = re.compile(r"[㐀-鿿]")


def _script(ch: str) -> str:
    if "Ѐ" <= ch <= "ԯ":
        return "c"
    if "Ͱ" <= ch <= "Ͽ" or "ἀ" <= ch <= "\u1fff":
        return "g"
    return "l" if ch.isalpha() and ch < "ɰ" else ""


def _hidden(match: re.Match[str]) -> str:
    """Invisible characters go, but for joiners and selectors inside emoji sequences and in scripts that need them."""
    text, start, end = match.string, match.start(), match.end()
    before, after = text[start - 1 : start], text[end : end + 1]
    run = match[0]
    if all(c in "\u200d\ufe0f\ufe0e" for c in run) and before and _PICTURE.match(before):
        return run if run[-1] != "\u200d" or (after and _PICTURE.match(after)) else ""
    if all(c in "\u200c\u200d\ufe00\ufe01\ufe02" for c in run) and before and _JOINING.match(before) and not _HAN.match(before):
        return run
    if all("\U000e0020" <= c <= "\U000e007f" for c in run) and before and _PICTURE.match(before):
        return run
    return ""


def _one_script(word: str) -> str:
    """A word of mixed scripts in one script in which all other letters have a twin: Latin first, then the most frequent."""
    counts = {"l": 0, "c": 0, "g": 0}
    for ch in word:
        s = _script(ch)
        if s:
            counts[s] += 1
    if sum(n > 0 for n in counts.values()) < 2:
        return word
    for script in sorted(counts, key=lambda s: (s != "l", -counts[s])):
        twins = {"l": STRICT_TWINS, "c": CYRILLIC_TWINS, "g": GREEK_TWINS}[script]
        out = [ch if _script(ch) in ("", script) else twins.get(ch) for ch in word]
        if counts[script] and None not in out:
            return "".join(out)
    return word


def by_table(text: str) -> str:
    """Table normalisation of a text; equal to the text unless it holds odd characters."""
    if text.isascii() or not _HINT.search(text):
        return text
    text = _HIDDEN.sub(_hidden, text)
    text = _STYLED.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    text = _SPLIT.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
    text = _SPACE.sub(" ", text)
    return _WORD.sub(lambda m: _one_script(m[0]), text)


def _walks(word: str) -> bool:
    """A word for the automaton: it holds an ignorable, a split accent, a styled letter or letters of two scripts, or a Latin letter that looks like another."""
    if word.isascii():
        return False
    if _HINT.search(word) is None:
        return any(c in LATIN_ODD for c in word)
    return _HIDDEN.search(word) is not None or _MARKS.search(word) is not None or _STYLED.search(word) is not None or len({_script(c) for c in word} - {""}) > 1


def odd_tokens(text: str) -> list[str]:
    """The words of a text that walk the tries."""
    return [w for w in _WORD.findall(text) if _walks(w)]


class Trie:
    """Vocabulary trie walked by a weighted edit automaton for which look-alikes and ignorable characters cost nothing."""

    def __init__(self, words: dict[str, int]) -> None:
        self.root: dict = {}
        for word, uses in words.items():
            node = self.root
            for ch in word.lower():
                node = node.setdefault(ch, {})
            ends = node.setdefault("", {})
            ends[word] = ends.get(word, 0) + uses

    @staticmethod
    def readings(token: str) -> Iterator[dict[str, float]]:
        """For each position of the token the strings it may be read as, with their cost; an ignorable is read as nothing."""
        styles = [unicodedata.normalize("NFKC", ch) for ch in token]
        scripts = [_script(s[:1]) for s in styles]
        latin = scripts.count("l")
        letters = len(scripts) - scripts.count("")
        loose = latin * 2 >= letters  # a loose twin is believed only in a mostly Latin word
        for ch, style in zip(token, styles, strict=True):
            options: dict[str, float] = {}

            def offer(text: str, cost: float, options: dict[str, float] = options) -> None:
                options[text] = min(cost, options.get(text, cost))

            if _HIDDEN.fullmatch(ch):
                offer("", 0.0)
            elif unicodedata.combining(ch):
                offer(ch, 0.0)
                offer("", DROPPED)
            else:
                low = ch.lower()
                offer(low, 0.0)
                offer(style.lower(), 0.0)
                if latin:  # a word wholly in another script stays there
                    for c in (ch, low):
                        if c in STRICT_TWINS:
                            offer(STRICT_TWINS[c].lower(), 0.0)
                        elif c in LATIN_TWINS and loose:
                            offer(LATIN_TWINS[c], LOOSE)
                    for twins in (CYRILLIC_TWINS, GREEK_TWINS):
                        if latin < letters and style in twins:
                            offer(twins[style].lower(), 0.0)
                bare = "".join(c for c in unicodedata.normalize("NFD", style.lower()) if not unicodedata.combining(c))
                if bare != style.lower():
                    offer(bare, DROPPED)
                options.pop("", None)
            yield options  # a walk that has ended asks for no more

    def ends(self, token: str) -> dict[str, tuple[float, int]]:
        """Vocabulary words within the budget from a token, with their cost and uses."""
        states: dict[int, tuple[float, dict]] = {id(self.root): (0.0, self.root)}
        for options in self.readings(unicodedata.normalize("NFC", token)):
            following: dict[int, tuple[float, dict]] = {}
            for cost, node in states.values():
                for option, step in options.items():
                    at: dict | None = node
                    for ch in option:
                        at = at.get(ch)
                        if at is None:
                            break
                    if at is not None and cost + step <= BUDGET and cost + step < following.get(id(at), (2 * BUDGET, at))[0]:
                        following[id(at)] = (cost + step, at)
            states = following
            if not states:
                return {}
        return {word: (cost, uses) for cost, node in states.values() for word, uses in node.get("", {}).items()}

    def spelling(self, token: str) -> tuple[str, float | None]:
        """The canonical spelling of a token and its cost; the table's form and no cost where the token ends nowhere."""
        plain = by_table(token)
        found = self.ends(token)
        if not found:
            return plain, None
        uses: dict[str, int] = {}
        for w, (_, n) in found.items():
            uses[w.lower()] = uses.get(w.lower(), 0) + n
        best = min(found, key=lambda w: (found[w][0], -uses[w.lower()], w != plain, -found[w][1], w))
        cost = found[best][0]
        if len(best) != len(plain):
            return best, cost
        return "".join(b.upper() if p.isupper() else b.lower() for b, p in zip(best, plain, strict=True)), cost


def _key(word: str) -> str:
    """Shard of a word: its first letters and its length once look-alikes are folded and ignorables dropped."""
    folded = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", _HIDDEN.sub("", word)).lower())
    folded = "".join(LATIN_TWINS.get(c, c) for c in folded if not unicodedata.combining(c)).lower()
    return f"{folded[:SHARD_LETTERS]}{len(folded)}"


@skip_empty
def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen = {w for text in batch["text"] for w in odd_tokens(text)}
        yield pd.DataFrame({"key": [_key(w) for w in seen], "token": list(seen)})


@skip_empty
def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        uses: dict[str, int] = {}
        for text in batch["text"]:
            for w in _CLEAN_WORD.findall(text):
                uses[w] = uses.get(w, 0) + 1
        yield pd.DataFrame({"key": [f"{w[:SHARD_LETTERS].lower()}{len(w)}" if w.isascii() else _key(w) for w in uses], "word": list(uses), "uses": list(uses.values())})


def _match(_: tuple, tokens: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    trie = Trie(dict(zip(words["word"], words["uses"], strict=True)))
    found = [trie.spelling(t) for t in tokens["token"]]
    return pd.DataFrame({"token": tokens["token"].astype(object), "spelling": [s for s, _ in found], "cost": pd.array([c for _, c in found], dtype="Float64")})


def spellings(odd: DataFrame, texts: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(token, spelling, cost) of every odd token, cost being null where the table decided. odd(text): texts with odd characters; texts(text): the corpus whose clean words are the vocabulary."""
    tokens = cut(odd.select("text").mapInPandas(_gather, "key string, token string").distinct(), "tokens")
    words = texts.where("text is not null").select("text").mapInPandas(_words, "key string, word string, uses long")
    needed = words.join(tokens.select("key").distinct(), "key", "left_semi").groupBy("key", "word").agg(F.sum("uses").alias("uses"))
    part = F.pmod(F.xxhash64("key"), F.lit(8 + tokens.count() // shard_tokens))
    return tokens.withColumn("part", part).groupBy("part").cogroup(needed.withColumn("part", part).groupBy("part")).applyInPandas(_match, "token string, spelling string, cost double")


def _between(text: str, start: int, end: int) -> str:
    """What stands between two words, by table."""
    piece, at = [], start
    for m in _HIDDEN.finditer(text, start, end):
        piece += [text[at : m.start()], _hidden(m)]
        at = m.end()
    out = "".join([*piece, text[at:end]])
    return out if out.isascii() else _SPACE.sub(" ", _STYLED.sub(lambda m: unicodedata.normalize("NFKC", m[0]), out))


def rewrite(text: str, known: dict[str, str]) -> str:
    """A text with its odd words in their canonical spelling and the rest by table."""
    out, at = [], 0
    for m in _WORD.finditer(text):
        if m.start() > at:
            out.append(_between(text, at, m.start()))
        word = m[0]
        out.append(known.get(word, word) if not word.isascii() else word)
        at = m.end()
    return "".join([*out, _between(text, at, len(text))])


def _rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [rewrite(text, {p["token"]: p["spelling"] for p in pairs} if pairs is not None else {}) for text, pairs in zip(batch["text"], batch["pairs"], strict=True)]
        yield batch[["rec_table", "ordinal", "text"]].astype(object).assign(canonical=out)


@skip_empty
def _row_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(t, o, w) for t, o, text in zip(batch["rec_table"], batch["ordinal"], batch["text"], strict=True) for w in set(odd_tokens(text))]
        yield pd.DataFrame(rows, columns=["rec_table", "ordinal", "token"]).astype({"ordinal": "int64"})


@skip_empty
def _odd_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with a word for the automaton or an odd character between words."""
    for batch in batches:
        yield batch.astype(object)[np.array([_HINT.search(t) is not None and (bool(odd_tokens(t)) or rewrite(t, {}) != t) or any(c in t for c in LATIN_ODD) for t in batch["text"]], dtype=bool)]


def _odd(texts: DataFrame) -> DataFrame:
    # the byte length tells plain ASCII apart, which needs no further look
    return cut(texts.where(F.octet_length("text") != F.char_length("text")).mapInPandas(_odd_rows, texts.schema), "odd")


def canonical_texts(texts: DataFrame) -> DataFrame:
    """texts(rec_table, ordinal, text) to (rec_table, ordinal, text, canonical) of the texts whose canonical form is another: a word ends at another spelling, or the table changes what ends nowhere."""
    texts = texts.where("ordinal is not null").select("rec_table", "ordinal", "text")
    odd = _odd(texts)
    chosen = spellings(odd, texts)
    pairs = odd.mapInPandas(_row_tokens, "rec_table string, ordinal long, token string").join(chosen, "token").groupBy("rec_table", "ordinal").agg(F.collect_list(F.struct("token", "spelling")).alias("pairs"))
    return odd.join(pairs, ["rec_table", "ordinal"], "left").mapInPandas(_rewrite, "rec_table string, ordinal long, text string, canonical string").where("canonical <> text")


def decisions(texts: DataFrame) -> DataFrame:
    """(decided_by, cost, tokens, respelled): how many odd words the automaton decided at which cost, and how many were left to the table."""
    texts = texts.where("ordinal is not null").select("rec_table", "ordinal", "text")
    chosen = spellings(_odd(texts), texts)
    by = F.when(F.col("cost").isNull(), "table").otherwise("automaton")
    return chosen.groupBy(by.alias("decided_by"), "cost").agg(F.count("*").alias("tokens"), F.count_if(F.col("spelling") != F.col("token")).alias("respelled"))


def text_records(raw_items: DataFrame, claims: DataFrame) -> DataFrame:
    """(rec_table, ordinal, text): the summaries and quotes."""
    raw = raw_items.select(F.lit("raw_items").alias("rec_table"), "ordinal", F.col("summary").alias("text"))
    return raw.unionByName(claims.select(F.lit("claims").alias("rec_table"), "ordinal", F.col("quote").alias("text")))
