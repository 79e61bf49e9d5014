"""Near duplicates by SimHash: fingerprints within a Hamming distance, found by a grid over bit counts.

A fingerprint is cut into segments of a few bits, and each segment is replaced by the number of bits set in
it. One differing bit changes one count by one, so the Manhattan distance of two count vectors never exceeds
the Hamming distance of the fingerprints. The segments are held in ``BLOCKS`` blocks; of a pair within
``distance`` bits at least one block differs in ``distance // BLOCKS`` bits at most, so in that block's grid,
whose cells are the count vectors, the two lie in one cell or in cells that near. Every fingerprint is a
host in its own cell of each grid and visits the cells near it in one direction, so a pair meets once in a
grid. Pairs that meet are verified exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.keyed_join import attach
from . import components
from .common import slices, staged

#: Bits of a segment, and blocks of segments.
SEGMENT_BITS, BLOCKS = 2, 3
#: Rows of a cell that meet in one task; a fuller cell is cut into chunks, and pairs of chunks meet.
CELL_ROWS = 8_192
#: Cells cut into chunks that are broadcast at most; beyond, the join is shuffled.
MOST_BROADCAST = 200_000
#: Pairs verified at once, and bytes of a text hashed at once.
PAIRS, PIECE = 1 << 20, 256 << 10
#: Rows that a task looks at on average when pairs meet.
TASK_ROWS = 500_000

_BITS = np.arange(64, dtype=np.uint64)
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of a lower-cased text, in pieces; of fewer words the whole sequence."""
    held: list[bytes] = []
    at, met = 0, False
    while at < len(text):
        blank = _BLANK.search(text, at + PIECE)
        end = blank.start() if blank else len(text)
        held += text[at:end].split()
        at = end
        if len(held) >= words:
            joined = memoryview(b" ".join(held))
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            ends = np.cumsum(lengths + 1) - 1
            starts = ends - lengths
            hash64 = xxhash.xxh64_intdigest
            count = len(held) - words + 1
            pairs = zip(starts[:count].tolist(), ends[words - 1 :].tolist())
            yield np.fromiter((hash64(joined[a:b], 42) for a, b in pairs), np.uint64, count)
            held, met = held[count:], True
    if held and not met:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), 42)], np.uint64)


def fingerprint(text: str | None, words: int = 4) -> int:
    """A bit is set if it is set in over half of the shingle hashes, repeats included; 0 without words."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes((text or "").encode("utf-8").lower(), words):
        total += len(hashes)
        # bits of each hash as bytes of 0 and 1, summed over the hashes
        for at in range(0, len(hashes), 1 << 15):
            part = hashes[at : at + (1 << 15)].astype("<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = _BITS[2 * ones > total]
    return int(np.bitwise_or.reduce(np.uint64(1) << set_bits)) if len(set_bits) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id bigint, fingerprint bigint) of every row; the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                prints = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))], ["id", "fingerprint"])

    plain = docs.select(F.col(id_col).try_cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "id bigint, fingerprint bigint")


def grids() -> list[list[np.uint64]]:
    """The segments of each block, as bit masks."""
    masks = [np.uint64(((1 << SEGMENT_BITS) - 1) << at & (1 << 64) - 1) for at in range(0, 64, SEGMENT_BITS)]
    borders = [len(masks) * b // BLOCKS for b in range(BLOCKS + 1)]
    return [masks[a:b] for a, b in zip(borders, borders[1:])]


def _steps(dims: int, radius: int) -> list[tuple[int, ...]]:
    """Offsets of the cells within a Manhattan radius that are later in lexical order."""
    found = [()]
    for _ in range(dims):
        found = [(*o, d) for o in found for d in range(-radius, radius + 1) if sum(map(abs, o)) + abs(d) <= radius]
    return [o for o in found if o > (0,) * dims]


def cells(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, cell of each, hosts or visitors) for every grid. A cell is its counts as digits, the grid the last."""
    for block, masks in enumerate(grids()):
        counts = np.stack([np.bitwise_count(prints & m).astype(np.int64) for m in masks], 1)
        base = SEGMENT_BITS + 1
        places = np.array([base**i for i in range(len(masks))], np.int64)
        own = counts @ places
        yield np.arange(len(prints)), own * BLOCKS + block, True
        for step in _steps(len(masks), distance // BLOCKS):
            there = counts + np.array(step)
            inside = np.flatnonzero(((there >= 0) & (there < base)).all(1))
            if len(inside):
                yield inside, (own[inside] + int(places @ np.array(step))) * BLOCKS + block, False


def _placed(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for rows, cell, host in cells(prints, distance):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(prints[rows].view(np.int64)), pa.array(np.full(len(rows), host))], ["cell", "fingerprint", "host"])

    return run


def near_pairs(a: np.ndarray, b: np.ndarray, starts: np.ndarray, counts: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a[i], b[j]) within the distance, j from ``starts[i]`` on for ``counts[i]`` rows of b, in bounded blocks."""
    at, row = 0, 0
    total = np.concatenate([[0], np.cumsum(counts)])
    while row < len(a):
        end = max(int(np.searchsorted(total, total[row] + PAIRS, "right")) - 1, row + 1)
        own = counts[row:end]
        left = np.repeat(np.arange(row, end), own)
        right = np.arange(len(left)) - np.repeat(total[row:end] - total[row], own) + np.repeat(starts[row:end], own)
        near = np.bitwise_count(a[left] ^ b[right]) <= distance
        if near.any():
            yield a[left[near]], b[right[near]]
        row = end


def _met(distance: int):
    """Rows sorted by cell and piece; gives the pointers of fingerprints that meet and are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key: np.ndarray, prints: np.ndarray, role: np.ndarray) -> Iterator[pa.RecordBatch]:
            # within a cell: role 0, hosts on both sides; 1, hosts of the left; 2, hosts of the right; 3 and 4, visitors of either
            order = np.lexsort((role, key[:, 1], key[:, 0]))
            key, prints, role = key[order], prints[order], role[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]).any(1)])
            first = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            sizes = np.bincount(run_of * 5 + role, minlength=5 * len(first)).reshape(-1, 5)
            begin = first[:, None] + np.concatenate([np.zeros((len(first), 1), np.int64), np.cumsum(sizes, 1)[:, :-1]], 1)
            found: list[np.ndarray] = []
            # who meets whom: hosts of one chunk all hosts and visitors of its cell; of two chunks each side the other's
            for left, right in ((0, 0), (0, 3), (1, 2), (1, 4), (2, 3)):
                mine = np.flatnonzero((role == left) & (sizes[run_of, right] > 0))
                if not len(mine):
                    continue
                starts, counts = begin[run_of[mine], right], sizes[run_of[mine], right]
                if left == right:  # each pair once
                    starts = mine + 1
                    counts = begin[run_of[mine], left] + sizes[run_of[mine], left] - starts
                for a, b in near_pairs(prints[mine], prints, starts, counts, distance):
                    found.append(np.stack(components.pointers(a.view(np.int64), b.view(np.int64)), 1))
            if found:
                edges = np.concatenate(found)
                nodes, least = components.pointers(edges[:, 0], edges[:, 1])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["a", "b"])

        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, piece, prints, role = (c.to_numpy() for c in batch.columns)
            held.append((np.stack([cell, piece], 1), prints.view(np.uint64), role.astype(np.int64)))
            size += len(cell)
            if size >= 8 * CELL_ROWS:
                key, prints, role = (np.concatenate(x) for x in zip(*held))
                last = (key == key[-1]).all(1)  # the cell that may go on in the next batch
                done = ~last
                if done.any():
                    yield from links(key[done], prints[done], role[done])
                held, size = [(key[last], prints[last], role[last])], int(last.sum())
        if held:
            yield from links(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): pointers that connect what pairs of distinct fingerprints within ``distance`` bits connect.

    ``distinct`` has one bigint column. Staged.
    """
    if not 0 <= distance < 64:
        raise ValueError("the distance is 0 to 63 bits")
    spark = distinct.sparkSession
    visits = staged(distinct.toDF("fingerprint").mapInArrow(_placed(distance), "cell bigint, fingerprint bigint, host boolean"), "cells")
    full = visits.groupBy("cell").count().filter(F.col("count") > CELL_ROWS)
    full = staged(full.select("cell", F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("chunks")), "full-cells")
    tasks = max(-(-visits.count() // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # a cell that is cut: the rows of a chunk meet those of every chunk, each pair of chunks in a piece of its own
    side = F.broadcast(full) if full.count() <= MOST_BROADCAST else full
    own = visits.join(side, "cell", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = own.withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = own.withColumn("other", other).select(
        "cell", (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).cast("bigint").alias("piece"), "fingerprint",
        F.when(F.col("host"), F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2))
        .when(F.col("own") <= F.col("other"), 3).otherwise(4).alias("role"),
    )
    met = dealt.repartition(tasks, "cell", "piece").sortWithinPartitions("cell", "piece")
    return staged(met.mapInArrow(_met(distance), "a bigint, b bigint"), "near-prints")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row of ``docs``.

    ``fingerprint`` has 16 hexadecimal digits. Rows whose fingerprints differ in ``distance`` bits or fewer are
    linked; ``component_id`` is the smallest id that can be reached over links, the own id included. Null and
    empty texts, and texts of blanks, have fingerprint zero and are linked like any other. A text of fewer than
    ``words`` words is one shingle. Rows that share a fingerprint are one node however many there are. Rows without
    an id take part but name no component: theirs is null unless they reach an id; an id that is no number
    counts as none. Repeated rows stay repeated; an empty table gives an empty one. Other columns play no part.
    """
    rows = staged(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = staged(rows.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-prints")
    label = components.labels(links(nodes.select("fingerprint"), distance)).toDF("fingerprint", "label")
    # one row per fingerprint on both sides: no key is hot
    grouped = staged(nodes.join(label, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint")), "print-groups")
    least = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    named = attach(grouped.select("fingerprint", "label"), least, ["label"]).select("fingerprint", "component_id")
    named = staged(named, "named-prints")
    found = attach(rows, named, ["fingerprint"])
    return found.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
