"""Tokens, identifiers and quote normalisation as column expressions, with the same rules in SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that do not tell titles apart.
STOPWORDS = ("about", "after", "announcing", "introducing", "launches", "new", "release", "released", "the", "with", "发布", "推出", "正式")
# Tokens and phrases of relevant items.
TOPIC_TOKENS = (
    "agent", "agents", "ai", "anthropic", "chatgpt", "claude", "copilot", "cuda", "deepseek", "diffusion", "gemini", "gpt", "grok",
    "inference", "jax", "llama", "llm", "llms", "manus", "mcp", "multimodal", "nemotron", "openai", "pytorch", "qwen", "rag", "robotics",
    "tensorflow", "transformer", "vllm", "worldclaw",
)
TOPIC_PHRASES = (
    "artificial intelligence", "foundation model", "large language model", "machine learning", "neural network", "model context protocol",
    "vibe coding", "人工智能", "大模型", "多模态", "具身智能", "智能体", "机器学习", "模型推理", "生成式",
)
# Full-width punctuation and its half-width twin, character by character.
FULL_WIDTH = "，、。．：；！？（）［］【】｛｝〈〉《》「」『』“”‘’－—–～％＃＆＠＋＝／＼｜＊＄＿"
HALF_WIDTH = ",,..:;!?()[][]{}<><>" + '""""""' + "''" + "---~%#&@+=/\\|*$_"
# White space that a quote may be wrapped by.
QUOTE_SPACE = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
QUOTE_MINIMUM = 12

_LATIN = "[a-z0-9][a-z0-9.+-]{1,}"
_HAN_RUN = r"[\x{4e00}-\x{9fff}]{2,}"


def latin_tokens(text: Column) -> Column:
    """Tokens of letters and digits in lower case, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_LATIN})"), F.lit(1))


def title_tokens(text: Column) -> Column:
    """Set of latin tokens and of the bigrams of Chinese runs, without stopwords."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(f"({_HAN_RUN})"), F.lit(1)), lambda r: ~r.isin(*STOPWORDS))
    bigrams = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))))
    return F.array_except(F.array_distinct(F.concat(latin_tokens(text), bigrams)), F.array(*[F.lit(s) for s in STOPWORDS]))


def title_tokens_sql(text: str) -> str:
    stop = ", ".join(f"'{s}'" for s in STOPWORDS)
    runs = f"list_filter(regexp_extract_all({text}, '{_HAN_RUN}'), lambda r: r NOT IN ({stop}))"
    bigrams = f"flatten(list_transform({runs}, lambda r: list_transform(range(1, length(r)), lambda i: substr(r, i, 2))))"
    return f"list_filter(list_distinct(list_concat(regexp_extract_all(lower({text}), '{_LATIN}'), {bigrams})), lambda k: k NOT IN ({stop}))"


def product_ids(text: Column) -> Column:
    """Sorted set of latin tokens with both a letter and a digit."""
    return F.array_sort(F.array_distinct(F.filter(latin_tokens(text), lambda k: k.rlike("[a-z]") & k.rlike("[0-9]"))))


def product_ids_sql(text: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_extract_all(lower({text}), '{_LATIN}'), lambda k: regexp_matches(k, '[a-z]') AND regexp_matches(k, '[0-9]'))))"


def story_ids(text: Column) -> Column:
    """Sorted set of CVE and GHSA identifiers in lower case; one glued to a letter, digit or underscore does not count."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)(?:^|[^\p{L}\p{N}_])((?:CVE-\d{4}-\d+|GHSA-[a-z0-9-]+))(?![\p{L}\p{N}_])"), F.lit(1)), F.lower)))


def story_ids_sql(text: str) -> str:
    """The same without lookahead: the character behind may not be a letter, digit or underscore."""
    found = f"regexp_extract_all({text} || ' ', '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])((?:CVE-[0-9]{{4}}-[0-9]+|GHSA-[a-z0-9-]+))[^\\p{{L}}\\p{{N}}_]', 1)"
    return f"list_sort(list_distinct(list_transform({found}, lambda i: lower(i))))"


def normalize_quote(text: Column) -> Column:
    """No white space, full-width punctuation as half-width."""
    return F.translate(F.regexp_replace(text, f"[{QUOTE_SPACE}]+", ""), FULL_WIDTH, HALF_WIDTH)


def normalize_quote_sql(text: str) -> str:
    half = HALF_WIDTH.replace("'", "''")
    return f"translate(regexp_replace({text}, '[{QUOTE_SPACE}]+', '', 'g'), '{FULL_WIDTH}', '{half}')"


def shortened(text: Column, limit: int = 160) -> Column:
    """White space collapsed, cut at `limit` characters with an ellipsis."""
    line = F.trim(F.regexp_replace(text, f"[{QUOTE_SPACE}]+", " "))
    return F.when(F.length(line) > limit, F.concat(F.substring(line, 1, limit), F.lit("…"))).otherwise(line)


def shortened_sql(text: str, limit: int = 160) -> str:
    line = f"trim(regexp_replace({text}, '[{QUOTE_SPACE}]+', ' ', 'g'))"
    return f"CASE WHEN length({line}) > {limit} THEN substr({line}, 1, {limit}) || '…' ELSE {line} END"


def is_relevant(ai_focused: Column, channel: Column, title: Column, summary: Column, metrics: Column) -> Column:
    """An item of a focused source, with a topic token or phrase, or a much-liked community item."""
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(F.coalesce(summary, F.lit("")), 1, 1500)))
    phrase = F.lit(False)
    for p in TOPIC_PHRASES:
        phrase = phrase | text.contains(p)
    liked = (channel == "community") & (numeric(F.try_element_at(metrics, F.lit("score"))) >= 100)
    return F.coalesce(ai_focused, F.lit(False)) | F.arrays_overlap(latin_tokens(text), F.array(*[F.lit(t) for t in TOPIC_TOKENS])) | phrase | F.coalesce(liked, F.lit(False))


def is_relevant_sql(alias: str) -> str:
    text = f"lower(coalesce({alias}.title, '') || ' ' || substr(coalesce({alias}.summary, ''), 1, 1500))"
    tokens = ", ".join(f"'{t}'" for t in TOPIC_TOKENS)
    phrases = " OR ".join(f"contains({text}, '{p}')" for p in TOPIC_PHRASES)
    liked = f"coalesce({alias}.source_channel = 'community' AND {numeric_sql(f'{alias}.metrics[' + chr(39) + 'score' + chr(39) + ']')} >= 100, false)"
    return f"(coalesce({alias}.source_ai_focused, false) OR list_has_any(regexp_extract_all({text}, '{_LATIN}'), [{tokens}]) OR {phrases} OR {liked})"


def numeric(text: Column) -> Column:
    """The number a text plainly is, else null."""
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), text.try_cast("double"))


def numeric_sql(text: str) -> str:
    return f"(CASE WHEN regexp_full_match({text}, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({text} AS DOUBLE) END)"


# Wording that guesses rather than reports.
GUESSING = "传闻|尚未证实|据猜测|推测|可能性(?:较?高|较?大)|或将|或随后|(?:可能|也许|预计|有望).{0,16}(?:发布|推出|上线|开放|宣布|融资|收购|合并)"


def without_guesses(copy: Column) -> Column:
    """Clauses between ； and 。 without those that guess, joined by ；."""
    clauses = F.transform(F.split(copy, "[；。]"), F.trim)
    return F.array_join(F.filter(clauses, lambda c: (c != "") & ~c.rlike(GUESSING)), "；")


def without_guesses_sql(copy: str) -> str:
    return f"array_to_string(list_filter(list_transform(regexp_split_to_array({copy}, '[；。]'), lambda c: trim(c)), lambda c: c <> '' AND NOT regexp_matches(c, '{GUESSING}')), '；')"


def escaped(text: Column) -> Column:
    """HTML escapes of the five special characters."""
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def escaped_sql(text: str) -> str:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        text = f"replace({text}, '{sign}', '{entity}')"
    return text


def fingerprint(*parts: Column) -> Column:
    """SHA-256 of the parts, nulls as empty, joined by a unit separator."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p, F.lit("")) for p in parts]), 256)
