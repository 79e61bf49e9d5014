import random
import re

import numpy as np
import pytest
import xxhash

from tidewell.llm import simhash as S


def plain_print(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(own[i : i + words]) for i in range(len(own) - words + 1)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(id, fingerprint, component) of every row, by comparing all pairs."""
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for (i, _), p, g in zip(rows, prints, group):
        ids = [k for (k, _), h in zip(rows, group) if h == g and k is not None]
        out.append((i, f"{p:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_fingerprints(seed, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 16)
    draw = random.Random(seed)
    for _ in range(40):
        text = "".join(draw.choice(["a", "B", "é", "Ab", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "日本"]) for _ in range(draw.randint(0, 60)))
        assert S.fingerprint(text) == plain_print(text)
    assert S.fingerprint(None) == S.fingerprint(" \n") == 0


def flipped(draw, value, bits):
    for b in draw.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.mark.parametrize(("distance", "cell_rows"), [(4, 8192), (4, 6), (2, 8192), (7, 8192), (0, 3)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, distance, cell_rows):
    monkeypatch.setattr(S, "CELL_ROWS", cell_rows)
    draw = random.Random(distance)
    centers = [0, (1 << 64) - 1] + [draw.getrandbits(64) for _ in range(25)]
    values = sorted({flipped(draw, draw.choice(centers), draw.randint(0, 9)) for _ in range(300)})
    group = {v: v for v in values}

    def top(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                group[max(top(a), top(b))] = min(top(a), top(b))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    found = S.links(spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(5), distance).collect()
    got = {v: v for v in values}

    def leader(v):
        while got[v] != v:
            v = got[v]
        return v

    for row in found:
        a, b = (int(np.int64(x).view(np.uint64)) for x in row)
        assert (a ^ b).bit_count() <= distance or top(a) == top(b)
        got[max(leader(a), leader(b))] = min(leader(a), leader(b))
    assert {frozenset(w for w in values if leader(w) == leader(v)) for v in values} == {frozenset(w for w in values if top(w) == top(v)) for v in values}


def test_pairs_in_blocks(monkeypatch):
    draw = np.random.default_rng(3)
    a, b = (draw.integers(0, 16, 40).astype(np.uint64) for _ in range(2))
    starts = draw.integers(0, 20, 40)
    counts = draw.integers(0, 20, 40)
    want = sorted((int(x), int(y)) for i, x in enumerate(a) for y in b[starts[i] : starts[i] + counts[i]] if int(x ^ y).bit_count() <= 1)
    for size in (1, 7, 50, 1 << 20):
        monkeypatch.setattr(S, "PAIRS", size)
        assert sorted((int(x), int(y)) for l, r in S.near_pairs(a, b, starts, counts, 1) for x, y in zip(l, r)) == want


def test_cells_bound_the_distance():
    """Of two fingerprints within the distance one visits a cell where the other is host, in some grid, and once only in it."""
    draw = random.Random(5)
    for bits in range(5):
        for _ in range(30):
            a = draw.getrandbits(64)
            b = flipped(draw, a, bits)
            placed = [(cell, row, host) for rows, cells, host in S.cells(np.array([a, b], np.uint64), 4) for row, cell in zip(rows, cells)]
            hosts = {(row, cell) for cell, row, host in placed if host}
            meets = [cell for cell, row, host in placed if not host and (1 - row, cell) in hosts]
            meets += [cell for row, cell in hosts if row == 0 and (1, cell) in hosts]
            assert meets and len(meets) <= S.BLOCKS


def test_against_brute_force(spark, documents):
    draw = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(draw.choices(vocabulary, k=120)) for _ in range(12)]
    rows = []
    for i in range(90):
        words = draw.choice(base).split()
        for _ in range(draw.choice([0, 0, 1, 1, 2, 6])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((None if i % 19 == 7 else i + 5, " ".join(words).upper() if i % 3 else "\n".join(words)))
    rows += [(1, None), (2, ""), (3, " \t "), (None, None), (4, "one"), (200, "one"), (4, "one"), (201, "two words"), (202, base[0] + " " + base[1] * 40)]
    found = S.near_duplicates(documents(rows)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_odd_tables(spark, documents):
    assert S.near_duplicates(documents([])).count() == 0
    assert S.near_duplicates(documents([])).columns == ["doc_id", "fingerprint", "component_id"]
    assert [tuple(r) for r in S.near_duplicates(documents([(None, None)])).collect()] == [(None, "0" * 16, None)]
    named = documents([("x", "a b c d"), ("7", "a b c d")], "doc_id string, text string")
    assert sorted((tuple(r) for r in S.near_duplicates(named).collect()), key=repr) == sorted(
        [(None, f"{plain_print('a b c d'):016x}", 7), (7, f"{plain_print('a b c d'):016x}", 7)], key=repr)
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([(1,)], "a bigint"), 64)
