import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewell.llm import fill_in_middle as M


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=400))
def test_skip_list_reaches_every_rank(widths):
    borders = M.SkipList(widths)
    assert [borders.offset(r) for r in range(len(widths) + 1)] == [sum(widths[:r]) for r in range(len(widths) + 1)]


def test_skip_list_descends_in_few_steps():
    borders = M.SkipList([1] * 100_000)
    assert len(borders.lanes) > 6 and len(borders.lanes[-1][0]) < 40
    assert all(sum(units) == 100_000 == sum(chars) for units, chars, _ in borders.lanes)
    # the links of a lane that lie under one link of the next: a bounded number on average
    for (_, _, below), (lower, _, _) in zip(borders.lanes[1:], borders.lanes):
        assert len(lower) / len(below) < 8
    with pytest.raises(IndexError):
        borders.offset(100_001)


def plain(doc_id, text, rate=100, unit=M.LINES):
    """The example of one row, cut by counting."""
    text = text or ""
    units = re.findall(unit, text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "a\nb\nc\n", "é😀\n日本\r\n\x85x y\n", "with <P> inside\nx", "<M>", "<\nP>\n<", " ",
    "tie\ntie\ntie\n", "tie\ntie\ntie\n", "x" * 300_000 + "\n" + "ü\n" * 50_000,
]


@pytest.mark.parametrize("rate", [100, 40, 0])
def test_against_cutting_by_counting(spark, documents, rate):
    draw = random.Random(rate)
    texts = TEXTS + ["".join(draw.choice("aé😀\n\n<P>S ") for _ in range(draw.randint(0, 80))) for _ in range(60)]
    rows = [(None if i % 17 == 3 else i % 50, t) for i, t in enumerate(texts)]
    made = M.transform(documents(rows), seed=7, rate=rate)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = made.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in found))) == sorted(repr((i, *plain(i, t, rate))) for i, t in rows)
    assert sorted(r["back"] for r in found) == sorted(t or "" for _, t in rows)
    assert rate or {r["form"] for r in found} == {"plain"}


def test_other_units_and_markers(spark, documents):
    rows = [(1, "to be or  not"), (2, "x"), (3, "")]
    markers = M.Markers("{pre}", "{suf}", "{mid}")
    made = M.transform(documents(rows), seed=7, unit=r"\s*\S+|\s+$", markers=markers, carry=("lang", "score"))
    assert made.columns[:3] == ["doc_id", "lang", "score"]
    back = made.withColumn("back", M.restored(F.col("output"), F.col("form"), markers))
    assert sorted((r["doc_id"], r["back"], r["n"]) for r in back.collect()) == [(1, "to be or  not", 4), (2, "x", 1), (3, "", 0)]
    with pytest.raises(ValueError):
        M.unit_widths("a-b", re.compile("[a-z]"))
    for bad in (("a", "a", "b"), ("<P", "P>", "x"), ("", "b", "c"), ("<abc>", "b", "x")):
        if bad != ("a", "a", "b"):
            with pytest.raises(ValueError):
                M.Markers(*bad)


def test_empty_table(spark, documents):
    assert M.transform(documents([]), seed=7).count() == 0
