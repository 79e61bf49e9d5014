import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewell.llm import collocations as P


def plain(rows, longest=5, least=100, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        held = []
        candidates = {w: n for w, n in f.items() if len(w) > 1 and n >= least}
        for w, a in candidates.items():
            longer = (x for x, n in candidates.items() if len(x) > len(w) and n >= a)
            if any(w == x[i : i + len(w)] for x in longer for i in range(len(x))):
                continue
            score, k = min((1000 * a * total[lang] // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
            held.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(held)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def texts(seed, count=60):
    draw = random.Random(seed)
    words = ["a", "B", "é", "日本", "New", "York", "city", "of", "the", "\x1c", "x\x85y", "a-b"]
    fixed = ["New York city", "of the of the of", "a a a a a a a"]
    rows = []
    for i in range(count):
        parts = [draw.choice(fixed) if draw.random() < 0.3 else draw.choice(words) for _ in range(draw.randint(0, 60))]
        text = "".join(p + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?", " \x0b"]) for p in parts)
        rows.append((i, text, draw.choice(["en", "en", "en", "fr", None, "und"])))
    return rows + [(None, None, None), (1, "", "en"), (2, " \t.,\n", "de"), (3, "only", "es")]


def test_pieces_of_long_texts_cut_no_word(monkeypatch):
    for _, text, _ in texts(5):
        raw = (text or "").encode()
        monkeypatch.setattr(P, "PIECE", 1 << 20)
        whole = P.words_of(raw)
        for size in (1, 5, 16):
            monkeypatch.setattr(P, "PIECE", size)
            assert [w for piece in P._pieces(raw) for w in P.words_of(piece)] == whole


def test_phrases_across_flushes_count_once():
    words = P.words_of(b"a b a b. a b c a b a b")
    once = P.Counter("en", [0, 1, 2], 3, None, None)
    once.add(words)
    parts = P.Counter("en", [0, 1, 2], 3, None, None)
    found = [Counter(), Counter()]
    batches = [list(once.flush()), []]
    for w in words:
        parts.add([w])
        batches[1] += parts.flush(goes_on=True)
    for total, own in zip(found, batches):
        for row in (r for batch in own for r in batch.to_pylist()):
            sizes = np.frombuffer(row["sizes"], "<u4")
            prefixes = np.repeat(np.array(row["prefixes"].split("\n")), sizes)
            for prefix, next_, count in zip(prefixes, row["next"].split(" "), np.frombuffer(row["counts"], "<i8")):
                total[prefix, next_] += count
    assert found[0] == found[1] and found[0]["a", "b"] == 5 and found[0]["a b", "a"] == 2


@pytest.mark.parametrize(("seed", "batch"), [(1, 1_000_000), (2, 40), (3, 7)])
def test_against_brute_force(spark, documents, monkeypatch, seed, batch):
    monkeypatch.setattr(P, "BATCH_WORDS", batch)
    monkeypatch.setattr(P, "TASK_ENTRIES", 500)
    rows = texts(seed)
    for least, longest, top in ((5, 5, 2000), (3, 3, 4), (8, 2, 2000)):
        found = P.mine(documents(rows), longest=longest, least=least, top=top)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == plain(rows, longest, least, top)


def test_bitmap_that_lets_everything_through(spark, documents, monkeypatch):
    """Whatever passes a full bitmap is dropped by its exact count."""
    monkeypatch.setattr(P, "BITMAP_BITS", 64)
    rows = texts(9)
    assert sorted(map(tuple, P.mine(documents(rows), least=5).collect())) == plain(rows, least=5)


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([(2_000_000_000_000, 9_000_000_000_000, 2_500_000_000_001, 2_000_000_000_003)], "a bigint, n bigint, l bigint, r bigint")
    a, n, l, r = phrases.first()
    got = phrases.selectExpr("(cast(a as decimal(19,0)) * cast(1000 * n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS s").first()[0]
    assert got == 1000 * a * n // (l * r)


def test_odd_tables(spark, documents):
    assert P.mine(documents([])).count() == 0
    assert P.mine(documents([(1, None), (2, "")])).count() == 0
    assert P.mine(documents([(1, "x y " * 50 + "é " * 3)]), least=10).count() > 0
    again = [(1, "x y", "en")] * 120
    assert [tuple(r) for r in P.mine(documents(again)).collect()] == [("en", 1, "x y", 120, 120, 120, 240, 2000)]
