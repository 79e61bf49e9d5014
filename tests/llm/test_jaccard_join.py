import random

import numpy as np
import pytest

from tidewell.llm import components, jaccard_join as J, shingles, signature_tree as S

ASCII_BLANKS = " \t\n\x0b\x0c\r"


def plain_set(text, words=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in ASCII_BLANKS:
        lowered = lowered.replace(c, " ")
    own = [w for w in lowered.split(" ") if w]
    if not own:
        return set()
    return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)} if len(own) >= words else {tuple(own)}


def brute(rows):
    """(id, set size, component) of every row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for (i, _), s, g in zip(rows, sets, group):
        ids = [k for (k, _), h in zip(rows, group) if h == g and k is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(8))
def test_shingles_name_the_same_sets(seed, monkeypatch):
    monkeypatch.setattr(shingles, "PIECE", 16)
    draw = random.Random(seed)
    texts = ["".join(draw.choice(["a", "B", "é", "Ab", " ", "  ", "\n", "\t", "\x1c", " ", "日本"]) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    texts += [None, "", " ", "A b", "a B", "x" * 100]
    got = shingles.shingle_sets(texts)
    names = {}
    for text, tokens in zip(texts, got):
        plain = plain_set(text)
        assert len(plain) == len(tokens)
        for token in plain:
            names.setdefault(token, set())
    for i, a in enumerate(texts):
        for j in range(i):
            assert len(plain_set(a) & plain_set(texts[j])) == len(np.intersect1d(got[i], got[j]))


@pytest.mark.parametrize("seed", range(20))
def test_tree_connects_what_brute_force_connects(seed):
    draw = np.random.default_rng(seed)
    base = [draw.integers(0, 1 << 60, draw.integers(1, 80)).astype(np.uint64) for _ in range(6)]
    sets = []
    for _ in range(60):
        own = base[draw.integers(6)].copy()
        keep = own[draw.random(len(own)) > draw.choice([0.0, 0.05, 0.15, 0.5])]
        extra = draw.integers(0, 1 << 60, draw.integers(0, 4)).astype(np.uint64)
        sets.append(np.unique(np.concatenate([keep, extra])) if len(keep) + len(extra) else own)
    sizes = np.array([len(s) for s in sets])
    order = S.similar_first(sets, sizes)
    sets, sizes = [sets[i] for i in order], sizes[order]

    def linked(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (sizes[i] + sizes[j] - both)

    want = S.Groups(np.arange(60))
    for i in range(60):
        for j in range(i):
            if linked(i, j):
                want.join(i, j)
    got = S.Groups(np.arange(60))
    links = S.join(S.Tree(sets, sizes, 256), None, got)
    assert (got.labels == want.labels).all() and all(linked(i, j) for i, j in links)
    # the same between two trees, when each side's own links are known
    cross = S.Groups(np.arange(60))
    for i in range(60):
        for j in range(i):
            if linked(i, j) and (i < 25) == (j < 25):
                cross.join(i, j)
    S.join(S.Tree(sets[:25], sizes[:25], 512), S.Tree(sets[25:], sizes[25:], 512), cross)
    assert (cross.labels == want.labels).all()


def near_copies(seed, n=160):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [draw.choice(words) for _ in range(30)]
    families = [[draw.choice(words) for _ in range(draw.randint(4, 60))] for _ in range(8)]
    rows = []
    for i in range(n):
        own = list(draw.choice(families[:2] if i % 2 else families))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
            own[draw.randrange(len(own))] = draw.choice(words)
        if draw.random() < 0.3:
            own += passage
        rows.append((i * 3, " ".join(own)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "One  two"), (2005, "one"), (None, "one two"), (None, "alone here"),
             (0, rows[0][1]), (2006, "A b c d e f g"), (2007, "É b c d e f g"), (2008, "é b c d e f g"), (2009, "z " * 3000)]
    return rows


@pytest.mark.parametrize("seed,tree", [(1, 256), (2, 256), (3, 6), (4, 12)])
def test_join_equals_brute_force(documents, monkeypatch, seed, tree):
    monkeypatch.setattr(J, "TREE_CLASSES", tree)  # small: clusters need several chunks
    monkeypatch.setattr(J, "PIVOTS", 2)
    rows = near_copies(seed)
    df = documents(rows).repartition(5)
    got = sorted((tuple(r) for r in J.join(df).collect()), key=repr)
    assert got == brute(rows)


def test_join_with_hot_tokens_and_cuts(documents, monkeypatch):
    monkeypatch.setattr(J, "TREE_CLASSES", 4)
    monkeypatch.setattr(J, "HOT", 4)
    monkeypatch.setattr(J, "BATCH_TOKENS", 500)
    monkeypatch.setattr(J, "BUCKET_TOKENS", 50)
    monkeypatch.setattr(J, "MOST_BUCKETS", 16)
    rows = near_copies(9, 60)
    got = sorted((tuple(r) for r in J.join(documents(rows).repartition(3)).collect()), key=repr)
    assert got == brute(rows)


def test_join_of_nothing(documents):
    df = documents([(1, None), (2, "")])
    assert sorted(tuple(r) for r in J.join(df).collect()) == [(1, 0, 1), (2, 0, 2)]
    assert J.join(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        J.join(df, similarity="0")


def test_one_of_each_group_stays(documents):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other"), (3, "other"), (4, None), (None, "a b c d e f"), (5, "")]
    df = documents(rows)
    kept = J.keep_one(df, J.join(df))
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 3, 4, 5, None]


def test_one_row_of_each_group_stays_whatever_the_ids(documents):
    one, two, three = "a b c d e f", "k l m n o p", "u v w x y z"
    rows = [(2, one), (3, one), (3, two), (9, two), (None, one), (None, three), (None, three), (4, None), (4, None), (4, ""),
            (None, None), (None, " "), (7, "q r s"), (7, "q r s"), (5, "q r s")]
    df = documents(rows)
    kept = J.one_of_each_group(df)
    assert kept.columns == df.columns
    want = [(2, one), (3, two), (None, three), (4, None), (4, ""), (None, None), (None, " "), (5, "q r s")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert J.one_of_each_group(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", [5, 6])
def test_groups_of_repeated_ids_keep_one_row(documents, seed):
    rows = [(None if i is None else i % 40, t) for i, t in near_copies(seed)]
    whole = brute([(n, t) for n, (_, t) in enumerate(rows)])  # by row number: what is connected
    group = {n: g for n, size, g in whole if size}
    number = {}
    for n, r in enumerate(rows):
        number.setdefault(r, n)
    kept = [(r.doc_id, r.text) for r in J.one_of_each_group(documents(rows).repartition(4)).collect()]
    assert sorted(group[number[r]] for r in kept if number[r] in group) == sorted(set(group.values()))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randint(0, 80), draw.randint(0, 80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(12)] + [(7, 7)]
    group = {v: v for e in edges for v in e}
    for a, b in edges:
        x, y = group[a], group[b]
        group = {v: min(x, y) if g in (x, y) else g for v, g in group.items()}
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(3)
    got = {r.node: r.label for r in components.labels(df).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: g for v, g in group.items() if v in linked}
    assert components.labels(df.limit(0)).collect() == []


def test_structured_words_do_not_share_a_hash(spark, documents):
    """Words on which polynomial hashes modulo 2 ** 64 collide, whatever their base."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    assert len(a) == 1024 and a != b
    one, two = shingles.shingle_sets([a, b])
    assert one[0] != two[0]
    for cut in (200, 256, 257, 512):
        assert len({int(s[0]) for s in shingles.shingle_sets([a[:cut], b[:cut]])}) == 2
    docs = documents([(1, a), (2, b), (3, a.upper())])
    assert sorted((r.doc_id, r.component_id) for r in J.join(docs).collect()) == [(1, 1), (2, 2), (3, 1)]
    assert sorted(r.doc_id for r in J.one_of_each_group(docs).collect()) == [1, 2]


def test_no_hash_is_shared_by_many_short_words():
    words = [f"{c}{i}" for c in ("", "a", "word", "longerword", "é") for i in range(20_000)]
    starts, hashes = shingles.word_hashes(np.frombuffer(" ".join(words).encode() + b" ", np.uint8))
    assert len(starts) == len(words) and len(np.unique(hashes)) == len(set(words))


def test_text_ids(spark, documents):
    docs = documents([("x", "a b c d e f"), ("7", "a b c d e f"), ("8", "z")], "doc_id string, text string")
    assert sorted((tuple(r) for r in J.join(docs).collect()), key=repr) == [(7, 2, 7), (8, 1, 8), (None, 2, 7)]
