import random
from collections import defaultdict

import pytest

from digestflow.llm import lines, pages

BODY = ["The {0} cache lowers older {1} releases.", "One {1} router moves the {0} ledger.", "Every {0} digest in {1} trims its budget."]
WORDS = ["amber", "basil", "cedar", "delta", "ember", "fjord", "grove", "heath", "inlet", "joust", "krill", "lumen"]


def page(i, *more):
    return "\n".join([BODY[i % 3].format(WORDS[i % 12], WORDS[(i * 5 + 1) % 12] + str(i)), *more])


def rows():
    out = [(i, "s1", f"Story Zorbano{chr(97 + i)}x opens", page(i, f"Reading time: {i} min")) for i in range(12)]
    out += [(100 + i, "s2", f"Story Quibblo{chr(97 + i)}y opens", page(i, "Home > Docs > Blog", "Cookies help us to measure traffic. OK", "— the Night desk")) for i in range(12)]
    return out + [(900, "s1", "Empty", ""), (901, "s1", None, None), (902, None, "No source", "A line.\nA line.")]


def brute(records, min_rows=6, share=0.05):
    sizes, seen = defaultdict(int), defaultdict(set)
    for o, s, _, t in records:
        sizes[s] += 1
        for line in (t or "").split("\n"):
            k = "".join(c for c in line.lower() if c.isalpha())
            if k:
                seen[s, k].add(o)
    hot = {k for k, v in seen.items() if len(v) >= min_rows and len(v) >= share * sizes[k[0]]}
    return {(o, n) for o, s, _, t in records for n, line in enumerate((t or "").split("\n"), 1) if (s, "".join(c for c in line.lower() if c.isalpha())) in hot}


def test_repeated_lines_match_brute_force(items):
    data = rows()
    found = {(r.ordinal, r.line_no) for r in lines.repeated_lines(items(data)).collect()}
    assert found == brute(data) and (3, 2) in found and (902, 1) not in found


def test_prefix_span_counts_documents_and_keeps_order(items):
    data = [(i, "s", "t", "Share this\nunique " + "xyz"[i % 3] * (i + 1) + "\nRead on\nShare this") for i in range(8)]
    got = {tuple(r.sequence): r.support for r in lines.prefix_span(items(data)).collect()}
    assert sorted(map(len, got)) == [1, 1, 2, 2, 2, 3] and set(got.values()) == {8}


def test_prefix_span_grows_until_a_level_is_empty(items):
    data = [(i, "s", "t", "Share this\nRead on\nAll rights\nContact us\nImprint") for i in range(8)]
    got = [len(r.sequence) for r in lines.prefix_span(items(data)).collect()]
    assert sorted(got) == sorted(n for n, many in ((1, 5), (2, 10), (3, 10), (4, 5), (5, 1)) for _ in range(many))


def test_removed_lines_and_cleaned_summary(items):
    cleaned = {r.ordinal: r.cleaned for r in lines.remove_repeated_lines(items(rows())).collect()}
    assert "Reading time" not in cleaned[3] and cleaned[900] == "" and cleaned[901] is None


def test_main_body_keeps_text_and_closing_lines(items):
    got = {r.ordinal: (r.body, list(r.dropped)) for r in pages.main_bodies(items(rows())).collect()}
    body, dropped = got[104]
    assert dropped[:2] == [2, 3] and body.startswith("One ") and "Cookies" not in body
    assert got[900] == ("", []) and got[901] == ("", [])


def test_join_path_gives_the_same_bodies(items):
    df = items(rows())
    broadcast = {r.ordinal: list(r.dropped) for r in pages.main_bodies(df).collect()}
    joined = {r.ordinal: list(r.dropped) for r in pages.main_bodies(df, broadcast_limit=0).collect()}
    assert broadcast == joined


def test_empty_table_and_long_text(items):
    assert pages.main_bodies(items([])).count() == 0 and lines.repeated_lines(items([])).count() == 0
    got = pages.main_bodies(items([(1, "s", "t", "word " * 200_000)])).first()
    assert len(got.body) == 1_000_000 and not got.dropped


@pytest.mark.parametrize(("line", "style"), [("© 2026 Lumen | Docs | Imprint", "menu"), ("1. Some link title", "numbered"), ("- item of a list", "kept"), ("Tags: a, b", "kept"), ("See also: Other story", "label"), ("Home Docs Blog", "menu"), ("The router moves.", "prose")])
def test_styles(line, style):
    assert pages._node(line, None, "")[0] == style


def test_importance_decides_and_not_words(items):
    """A notice no list knows goes once many pages of different stories hold it; the same line on one page stays."""
    body = "The %s module moves %d records before the next review of the depot, which the team had asked for."
    rows = [(i, f"s{i % 40}", f"Story Name{chr(97 + i // 26)}{chr(97 + i % 26)}x tells", f"Blorp the fizzing widget now\n{body % ('abcdefgh'[i % 8] * 3, i)}") for i in range(120)]
    rows.append((999, "s1", "Story Single tells", "Quax the dozing gadget here\n" + body % ("solo", 7)))
    got = {r.ordinal: list(r.dropped) for r in pages.main_bodies(items(rows)).collect()}
    assert all(got[i] == [1] for i in range(120)) and got[999] == []


def test_ascii_lines_are_told_as_by_patterns():
    rng = random.Random(9)
    bits = ["Monday", "suns", "mon", "9", "12 30", " ", "  ", "\t", "\x1c", "_", "-", ".", "! ", "? ", ". ", "|", " > ", "/", ",", "Site", "news", "a" * 45, "Part (part 3)", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 12))).strip()
        site = rng.choice(["", "site news", "mon"])
        slow = pages._BREAKS.sub(" ", pages._DIGITS.sub("9", text.lower())).strip()
        assert pages._plain(text, site) == pages._DAY.sub("9", slow.replace(site, "@") if site else slow)
        assert pages._sentences(text, text.isascii()) == [s for s in pages._SENTENCE_END.split(text) if s]
        phrases = [p for p in pages._PHRASE_END.split(pages._DIGITS.sub("9", text)) if pages._LETTER.search(p)]
        assert not (text.isascii() and pages._wide(text)) or any(len(p) > pages.PHRASE for p in phrases)
    assert pages._wide("words " * 20) and not pages._wide("word, " * 20)
