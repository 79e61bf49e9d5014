"""Exact top-k inner products by aggregation of sorted lists without random access.

Each task takes its rows in blocks. A block keeps one list per component, sorted once. The lists are read
from both ends in step, to one depth for all queries: a query goes by the upper ends of the components where it is
above zero and by the lower ends of the others. What was read gives every row a lower and an upper bound of its score,
for many queries in one product each. Reading stops for a query when few rows can still reach the
k-th score of the blocks before, or the k-th lower bound, and the scores of these rows are resolved. Queries travel in groups of a
checked size, one pass over the rows per group; the result of a pass is written before the next group is fetched.

Sums of whole numbers are exact in 64-bit floats up to 2 ** 53. Where the sizes of a query and of a block leave any
doubt of that, the block is scored in whole numbers of any size instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged

#: Rows in a block; bytes of queries sent with a pass; queries whose bounds are held at once.
BLOCK_ROWS, QUERY_BYTES, AT_ONCE = 2_048, 32 << 20, 256
#: Vectors with a component from this size on have blocks of their own; bound of the sums that floats add up exactly,
#: with room for the bounds of a score; largest score.
LARGE, EXACT, MOST = 1 << 21, 1 << 51, (1 << 63) - 1
#: Eighths of the lists read before the bounds are compared, and the share of rows that may be left to resolve.
READ_EIGHTHS, LEFT = (4, 5, 6, 8), 8


def whole_numbers(vectors: list, scale: int) -> tuple[list[int], list[np.ndarray]]:
    """Positions and floor(scale * x) of the vectors that are not null and hold finite numbers only."""
    at, out = [], []
    for i, v in enumerate(vectors):
        if v is None or not len(v):
            continue
        x = np.array(v, np.float64)  # a null component becomes NaN
        if np.isfinite(x).all():
            at.append(i)
            with np.errstate(over="ignore"):
                scaled = np.floor(scale * x)
            # a product beyond all floats is that of a whole number
            out.append(scaled if np.isfinite(scaled).all() else np.array([int(v) * scale if abs(v) > 1e300 else int(s) for v, s in zip(x, scaled)], object))
    return at, out


def is_large(vector: np.ndarray) -> bool:
    return bool(np.abs(vector).max() >= LARGE)


def exact_scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers; one that does not fit 64 bits counts as the largest or smallest that does."""
    whole = np.array([int(v) for v in q], object)
    sums = [int(sum(int(a) * b for a, b in zip(row, whole))) for row in rows.tolist()]
    return np.array([max(-MOST - 1, min(s, MOST)) for s in sums], np.int64)


class Block:
    """Rows of one length, with a sorted list per component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.most = np.abs(rows).max(0)
        if rows.dtype == object:
            return
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, 0)

    def read(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """What a row adds to a score at least and at most, per unit of each component that is above zero and then of
        each that is below, as far as the first ``depth`` entries of a list tell. A row not yet met there
        adds as much as the last of the list at least, and as the last that was read at most."""
        n, lists = self.rows.shape
        least, most = np.empty((n, 2 * lists)), np.empty((n, 2 * lists))
        for at, part, last, end in ((0, slice(n - depth, n), n - depth, 0), (lists, slice(0, depth), depth - 1, n - 1)):
            least[:, at : at + lists], most[:, at : at + lists] = self.values[end], self.values[last]
            for side in (least, most):
                side[self.order[part], np.arange(at, at + lists)] = self.values[part]
        return least, most

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, reached: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(position, scores, ids) for each query: every row that may be among its best ``k`` given its k-th score ``reached`` so far."""
        n = len(self.ids)
        if self.rows.dtype == object or queries.dtype == object:
            doubtful = np.full(len(queries), True)
        else:
            doubtful = np.abs(queries) @ self.most >= EXACT
        for i in np.flatnonzero(doubtful):
            possible = np.flatnonzero(self.ids != query_ids[i])
            yield i, exact_scores(self.rows[possible], queries[i]), self.ids[possible]
        left = np.flatnonzero(~doubtful)
        for eighths in READ_EIGHTHS:
            if not len(left):
                return
            least, most = self.read(max(n * eighths // 8, 1))
            more = []
            for start in range(0, len(left), AT_ONCE):
                part = left[start : start + AT_ONCE]
                weights = np.hstack([np.maximum(queries[part], 0), np.minimum(queries[part], 0)])
                own = self.ids == query_ids[part, None]
                upper = weights @ most.T
                can = (upper >= reached[part, None]) & ~own
                wide = can.sum(1) > max(4 * k, n // LEFT)
                if n > k and wide.any():
                    lower = np.where(own[wide], -np.inf, weights[wide] @ least.T)
                    can[wide] &= upper[wide] >= np.partition(lower, n - k, 1)[:, n - k, None]
                    wide = can.sum(1) > max(4 * k, n // LEFT)
                if eighths == READ_EIGHTHS[-1]:
                    wide[:] = False
                for i in np.flatnonzero(~wide):
                    possible = np.flatnonzero(can[i])
                    yield part[i], (self.rows[possible] @ queries[part[i]]).astype(np.int64), self.ids[possible]
                more.append(part[wide])
            left = np.concatenate(more)


def search(vectors: DataFrame, is_query: Column, k: int, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best inner products of floor(scale * x) of each query's vector
    with every other row, ties to the smaller id; all of them if there are fewer than ``k``.

    Vectors that are null or empty or hold a null or non-finite component, and rows without an id,
    take no part. Vectors of different length are not compared. Rows that share a query's id are
    its own. A score beyond 64 bits counts as the largest or smallest number of 64 bits. An id that is no number counts
    as none. A vector that repeats under many ids is a tie like any other; a repeated row counts
    again. Other columns play no part. No queries give an empty result.
    """
    rows = vectors.filter(F.col(id_col).try_cast("bigint").isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).try_cast("bigint").alias("id"), F.col(vector_col).alias("vector")
    )
    asked = vectors.filter(is_query & F.col(id_col).try_cast("bigint").isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).try_cast("bigint").alias("id"), F.col(vector_col).alias("vector")
    )
    size = asked.agg(F.coalesce(F.sum(8 * F.size("vector") + 64), F.lit(0))).first()[0]
    groups = -(-size // QUERY_BYTES)
    empty = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = empty.withColumnRenamed("vec_id", id_col)
    for group in range(groups):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == group).distinct().collect()
        found = found.unionByName(staged(_pass(rows, part, k, scale, id_col), "best-vectors"))
    return found


def _pass(rows: DataFrame, queries: list, k: int, scale: int, id_col: str) -> DataFrame:
    at, numbers = whole_numbers([r["vector"] for r in queries], scale)
    asked = np.array([queries[i]["id"] for i in at], np.int64)
    kinds: dict[tuple[int, bool], list[int]] = {}
    for number, q in enumerate(numbers):
        kinds.setdefault((len(q), q.dtype == object), []).append(number)
    alike = [(np.array(held), np.array([numbers[number] for number in held])) for held in kinds.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[tuple[int, bool], list[tuple[int, np.ndarray]]] = {}

        def work(held: list) -> None:
            kind = object if any(v.dtype == object for _, v in held) else np.float64
            block = Block(np.array([i for i, _ in held]), np.array([v for _, v in held], kind))
            for numbers_of, vectors in alike:
                if vectors.shape[1] != block.rows.shape[1]:
                    continue
                reached = np.array([float(best[i][0][k - 1]) if i in best and len(best[i][0]) >= k else -np.inf for i in numbers_of])
                for at, more, of in block.best(asked[numbers_of], vectors, k, reached):
                    scores, ids = best.get(numbers_of[at], (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    scores, ids = np.concatenate([scores, more]), np.concatenate([ids, of])
                    first = np.lexsort((ids, ~scores))[:k]  # ~ turns the order round and fits 64 bits
                    best[numbers_of[at]] = scores[first], ids[first]
            held.clear()

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, v in zip(*whole_numbers(batch.column(1).to_pylist(), scale)):
                held = waiting.setdefault((len(v), is_large(v)), [])
                held.append((ids[i], v))
                if len(held) >= BLOCK_ROWS:
                    work(held)
        for held in waiting.values():
            if held:
                work(held)
        for number, (scores, ids) in best.items():
            yield pa.RecordBatch.from_pydict({
                "query_id": np.full(len(ids), asked[number], np.int64), "id": ids, "score": scores,
            })

    partial = rows.mapInArrow(run, "query_id bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )
