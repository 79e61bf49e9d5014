import random

import pytest

from tidewell.llm import decontamination as D, queries, token_counts as T

SF_DIR = "/root/testdata/sf0.001"


def table_distances(item, text):
    """Least edit distance of the item to a substring ending at each place, by the plain table."""
    row = list(range(len(item) + 1))
    out = []
    for c in text:
        new = [0]
        for i, p in enumerate(item):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        out.append(row[-1])
    return out


@pytest.mark.parametrize("seed", range(30))
def test_distances_equal_the_table(seed):
    draw = random.Random(seed)
    item = "".join(draw.choice("ab c") for _ in range(draw.randint(1, 90)))
    text = "".join(draw.choice("ab c") for _ in range(draw.randint(0, 150)))
    assert D.distances(item, text) == table_distances(item, text)


def edited(item, errors, draw):
    out = list(item)
    for _ in range(errors):
        at = draw.randrange(len(out))
        draw.choice([lambda: out.pop(at), lambda: out.insert(at, "q"), lambda: out.__setitem__(at, "z")])()
    return "".join(out)


@pytest.mark.parametrize("seed", range(20))
def test_search_finds_what_brute_force_finds(seed):
    draw = random.Random(seed)
    words = ["the", "of", "thin", "and", "eren", "tion", "is", "ha"]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(6, 30)))) for i in range(4)]
    rows = D.Items([(i, t, int(0.08 * len(t))) for i, t in items if len(t) >= 20])
    parts = [" ".join(draw.choice(words) for _ in range(20)) for _ in range(4)]
    for _, t in items:
        parts.insert(draw.randrange(len(parts)), edited(t, draw.randint(0, int(0.08 * len(t)) + 2), draw))
    text = D.normal(" ".join(parts))
    got = rows.search(rows.automaton(), text)
    for number, (_, item, errors) in enumerate(rows.rows):
        ends = [i + 1 for i, d in enumerate(table_distances(item, text)) if d <= errors]
        found = [g for g in got if g[0] == number]
        assert bool(ends) == bool(found)
        for end in ends:  # every place is near a reported one
            assert any(abs(g[2] - end) <= 2 * errors for g in found)
        for _, start, end, distance in found:
            assert table_distances(item, text[start:end])[-1] <= distance <= errors


def test_hits_cases(spark, documents):
    item = "Where did the tall grey heron stand in the morning?"
    docs = documents([
        (1, f"Before. {item} After."), (2, "where DID the\ntall, grey heron -- stand in the morning"), (3, "Where did the tall gray heron stand in a morning"),
        (4, "Where did the small heron sit?"), (5, None), (6, ""), (None, item), (1, f"Before. {item} After."), (7, ("filler " * 20_000) + item + item),
    ]).withColumnRenamed("shard", "hits")
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "short"), (None, item), (14, item)], "item_id bigint, text string")
    got = [(r.doc_id, sorted((h.item_id, h.distance) for h in r.hits)) for r in D.find(docs, bench).collect()]
    both = lambda d: [(10, d), (14, d)]
    want = [(1, both(0)), (2, both(0)), (3, both(3)), (4, []), (5, []), (6, []), (None, both(0)), (1, both(0)), (7, [(10, 0)] * 2 + [(14, 0)] * 2)]
    assert sorted(got, key=repr) == sorted([(i, h) for i, h in want if i != 3] + [g for g in got if g[0] == 3], key=repr)
    assert {d for i, h in got if i == 3 for _, d in h} <= {3, 4}
    first = next(r for r in D.find(docs, bench).collect() if r.doc_id == 1).hits[0]
    assert (first.start_char, first.end_char) == (8, 8 + len(item) - 1)
    assert [r.hits for r in D.find(docs, bench.limit(0)).collect()] == [[]] * 9
    assert D.find(docs.limit(0), bench).collect() == []


def test_several_passes(spark, documents, monkeypatch):
    docs = documents([(1, "one two three four five six seven"), (2, "eight nine ten eleven twelve thirteen")])
    bench = spark.createDataFrame([(1, "two three four five six"), (2, "nine ten eleven twelve")], "item_id bigint, text string")
    monkeypatch.setattr(D, "PASS_BYTES", 10)
    assert sorted((r.doc_id, [h.item_id for h in r.hits]) for r in D.find(docs, bench).collect()) == [(1, [1]), (2, [2])]


def test_hits_query(spark):
    got = queries.benchmark_hits(spark, SF_DIR).toPandas()
    texts = {r.item_id: r.text for r in queries.read(spark, SF_DIR, "benchmark").collect()}
    docs = {r.doc_id: r.text for r in queries.read(spark, SF_DIR, "documents").collect()}
    plain = {(d, i) for d, t in docs.items() for i, b in texts.items() if D.normal(b) in D.normal(t)}
    assert plain and plain <= set(zip(got.doc_id, got.item_id))
    for r in got[got.distance == 0].itertuples():
        assert D.normal(docs[r.doc_id][r.start_char:r.end_char]) == D.normal(texts[r.item_id])


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers as P
    from tidewell.llm.common import package_file

    return T.Tokenizer(package_file(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)


ALPHABET = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "é", "1", "22", ".", "$$", "\t", "\x1c", "\x85", "　", "日", "🙂", "the ", " of", "\r\n"]


@pytest.mark.parametrize("seed", range(60))
def test_tree_equals_encoding_the_edited_text(tokenizer, seed, monkeypatch):
    monkeypatch.setattr(T, "LEAF", 1 + seed % 7)
    draw = random.Random(seed)
    some = lambda n: "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, n)))
    text = some(200)
    tree = T.SegmentTree(tokenizer, text)
    count = lambda t: len(tokenizer.encoding.encode_ordinary(t))
    assert tree.total == count(text)
    for _ in range(12):
        a = draw.randint(0, len(text))
        b = draw.randint(a, min(len(text), a + draw.choice([0, 1, 5, 300])))
        new = some(draw.choice([0, 1, 3, 60]))
        tree.replace(a, b, new)
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.length == len(text)
        assert [p for leaf in tree.leaves for p in leaf] == tokenizer.cut(text)
        assert tree.total == count(text)


def test_an_edit_encodes_little(tokenizer):
    tree = T.SegmentTree(tokenizer, "some plain words here " * 20_000)
    tree.replace(200_000, 200_004, "other")
    assert tree.encoded < 20


#: A pattern of the kind whose cut of white space depends on a line end at its far end.
LINES = r"""(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def by_lines():
    import public_tokenizers as P

    from tidewell.llm.common import package_file

    return T.Tokenizer(package_file(P.path("byte_bpe_50k.tiktoken")), LINES)


def test_white_space_far_before_an_edit(by_lines):
    tree = T.SegmentTree(by_lines, "a\n        b")
    tree.replace(10, 11, "\nb")
    assert [p for leaf in tree.leaves for p in leaf] == by_lines.cut("a\n        \nb")
    assert tree.total == len(by_lines.encoding.encode_ordinary("a\n        \nb"))


@pytest.mark.parametrize("seed", range(60))
def test_tree_of_a_pattern_with_long_white_space(by_lines, seed, monkeypatch):
    monkeypatch.setattr(T, "LEAF", 1 + seed % 5)
    draw = random.Random(seed)
    pieces = ["a", "b'", "  ", "\n", "\r\n", "        ", ".", "1", "\t", "\x85", "é"]
    some = lambda n: "".join(draw.choice(pieces) for _ in range(draw.randint(0, n)))
    text = some(120)
    tree = T.SegmentTree(by_lines, text)
    for _ in range(15):
        a = draw.randint(0, len(text))
        b = draw.randint(a, min(len(text), a + draw.choice([0, 1, 5, 200])))
        new = some(draw.choice([0, 1, 2, 30]))
        tree.replace(a, b, new)
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.length == len(text)
        assert [p for leaf in tree.leaves for p in leaf] == by_lines.cut(text)
        assert tree.total == len(by_lines.encoding.encode_ordinary(text))


def test_a_leaf_that_grows_is_cut(tokenizer):
    """Many insertions at one place: leaves stay small, and each edit encodes what it touches."""
    tree = T.SegmentTree(tokenizer, "some plain words here " * 2_000)
    text, before = "some plain words here " * 2_000, 0
    for i in range(300):
        new = f" word{i} and more of it" * 3
        tree.replace(20_000, 20_000, new)
        text = text[:20_000] + new + text[20_000:]
        assert tree.encoded - before < 60
        before = tree.encoded
    assert max(map(len, tree.leaves)) <= (T.FULL + 1) * T.LEAF
    assert tree.text() == text and tree.total == len(tokenizer.encoding.encode_ordinary(text))


def test_count_cases(spark, documents):
    import public_tokenizers as P

    docs = documents([(1, "Hello world"), (2, None), (3, ""), (None, "a"), (1, "Hello world"), (4, "x" * 50_000)])
    from pyspark.sql import functions as F

    edits = F.when(F.col("doc_id") < 3, F.expr("array(named_struct('start', 0, 'stop', 5, 'replacement', 'Bye'), null)"))
    rows = T.count(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, edits, with_text=True).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_edited, r.edited[:9]) for r in rows), key=repr)
    xs = next(r.n_tokens for r in rows if r.doc_id == 4)
    assert got == sorted([(1, 2, 1, 3, "Bye world"), (2, 0, 1, 2, "Bye"), (3, 0, 0, 0, ""), (None, 1, 0, 1, "a"), (1, 2, 1, 3, "Bye world"), (4, xs, 0, xs, "x" * 9)], key=repr)
    assert T.count(docs.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []


def test_count_query_equals_the_library(spark, tokenizer):
    got = {r.doc_id: tuple(r)[1:4] for r in queries.edited_token_counts(spark, SF_DIR).collect()}
    want = {}
    for r in queries.read(spark, SF_DIR, "documents").collect():
        text, steps = r.text, T.redactions(r.text)
        for a, b, new in steps:
            text = text[:a] + new + text[b:]
        want[r.doc_id] = (len(tokenizer.encoding.encode_ordinary(r.text)), len(steps), len(tokenizer.encoding.encode_ordinary(text)))
    assert got == want and sum(w[1] for w in want.values()) > 0


def test_short_items_are_found_as_whole_words(spark, documents):
    """Items below the limit: unchanged, between word borders; in scripts without blanks anywhere."""
    bench = spark.createDataFrame([("1", "What is 7 times 8?"), ("2", "今日は何曜日ですか"), ("3", "?!"), ("x", "no number"), ("4", "cat")], "item_id string, text string")
    docs = documents([
        (1, "What is 7 times 8?"), (2, "what is 7 times 88"), (3, "So what is: 7 TIMES 8 then"), (4, "what is 7 time 8"), (5, "ところで今日は何曜日ですかね"),
        (6, "concatenate cats"), (7, "no number ?!"), (8, "The cat. A cat"), (9, None),
    ])
    got = {r.doc_id: [(h.item_id, h.start_char, h.end_char, h.distance) for h in r.hits] for r in D.find(docs, bench).collect()}
    assert got == {
        1: [(1, 0, 17, 0)], 2: [], 3: [(1, 3, 21, 0)], 4: [], 5: [(2, 0, 14, 0)], 6: [], 7: [], 8: [(4, 4, 7, 0), (4, 11, 14, 0)], 9: []}
