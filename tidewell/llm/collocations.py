"""Phrase collocations by stripes: every prefix keys an associative counter of the words that follow it.

A stripe maps the next words of one prefix to their counts. Tasks build stripes of the texts they read and
merge them elementwise with all others of the same prefix. From merged stripes comes everything else: an entry is
the frequency of an extension; the entry that a prefix has in the stripe of its own prefix is its total; the
largest entries over a phrase, on its right in its own stripe, on its left in the stripes of the phrases that
end with it, tell whether a longer phrase subsumes it.

Only phrases of at least ``least`` occurrences count, and every part of such a phrase is as frequent. So stripes
are built in three passes: of the empty prefix; of single words, between frequent words; of longer prefixes, along
chains of frequent word pairs. What is frequent reaches the tasks as a bitmap of fixed size over hashes. A
bitmap lets some infrequent phrases through, which cost time and are dropped by their exact counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.keyed_join import attach, is_small
from .common import slices, staged
from .shingles import mix

#: Words held at once in a task, and bytes of a text split at once.
BATCH_WORDS, PIECE = 1_000_000, 1 << 20
#: Bits of a bitmap (a power of two): 4 MB, whatever the size of the corpus.
BITMAP_BITS = 1 << 25
#: A stripe of a prefix of k words is cut into WIDEST >> 4 * k parts by its next words.
WIDEST = 256
#: Entries of stripes merged in one task, on average, and rows at which a merge is done in between.
TASK_ENTRIES = 1_000_000
#: Parts in which the best phrases of one language are ranked before the last ranking.
RANK_PARTS = 64

_BORDER = b"\xff"  # occurs in no UTF-8 text
_ENDS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(range(256)).lower().translate(bytes.maketrans(_ENDS, _BORDER * len(_ENDS)))
_CUT = re.compile(rb"[ \t\n\x0b\x0c\r.,;:!?]")
#: Stripes that go to one task, packed: the prefixes, a line each; how many entries each has; the next words of all
#: entries, and their counts. Words hold neither blanks nor line ends.
_PACKED = pa.schema([
    ("bucket", pa.int32()), ("lang", pa.string()), ("prefixes", pa.string()), ("sizes", pa.binary()), ("next", pa.string()), ("counts", pa.binary()),
])
PACKED_DDL = "bucket int, lang string, prefixes string, sizes binary, next string, counts binary"


def words_of(text: bytes) -> list[bytes]:
    """The lower-cased words of a text or of a part of one, with a border wherever a piece ends."""
    return text.translate(_LOWER).replace(_BORDER, b" \xff ").split()


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that do not cut a word."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


class Counter:
    """Stripes of the words of one language that a task has read since the last flush.

    ``words`` and ``pairs`` are bitmaps of what may be frequent (None: not known yet). Prefixes of
    ``lengths`` words are counted; their stripes are dealt out to ``buckets``.
    """

    def __init__(self, lang: str, lengths: Sequence[int], buckets: int, words: np.ndarray | None, pairs: np.ndarray | None) -> None:
        self.lang, self.lengths, self.buckets, self.words, self.pairs = lang, lengths, buckets, words, pairs
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8"), 42)
        self.held: list[bytes] = []
        self.context = 0

    def add(self, words: list[bytes]) -> None:
        self.held += words

    def flush(self, goes_on: bool = False) -> Iterator[pa.RecordBatch]:
        """The stripes of what was added. If the text goes on, its last words stay as context of what follows."""
        if not self.held:
            return
        keep = max(self.lengths)
        tail = self.held[len(self.held) - keep :] if goes_on and keep else []
        coded = pa.array(self.held, pa.binary()).dictionary_encode()
        self.held = tail
        yield from self._stripes(coded.indices.to_numpy().astype(np.int64), coded.dictionary)
        self.context = len(tail)

    def _stripes(self, ids: np.ndarray, dictionary: pa.Array) -> Iterator[pa.RecordBatch]:
        names = dictionary.to_pylist()
        hashes = np.array([xxhash.xxh64_intdigest(w, self.seed) for w in names], np.uint64)
        border = pc.equal(dictionary, _BORDER).to_numpy(zero_copy_only=False)
        known = ~border if self.words is None else ~border & _in_bitmap(self.words, hashes)
        texts = pc.if_else(pa.array(border), pa.scalar(b"", pa.binary()), dictionary).cast(pa.string())  # the border is no text
        n = len(ids)
        fits = np.ones(n, bool)  # whether a phrase of k words may start here
        rank = np.zeros(n, np.int64)  # which one it is; its text and a hash of it
        labels, keys = pa.array([""]), np.zeros(1, np.uint64)
        for k in range(max(self.lengths) + 1):
            start = np.flatnonzero(fits[: n - k] & known[ids[k:]] if k else known[ids])
            if k > 1 and self.pairs is not None:
                start = start[linked[start + k - 1]]
            coded = pa.array(rank[start] << 32 | ids[start + k]).dictionary_encode()
            phrases, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            before, last = phrases >> 32, phrases & 0xFFFFFFFF
            fits = np.zeros(n, bool)
            fits[start] = True
            if k == 1 and self.pairs is not None:
                chain = np.array([xxhash.xxh64_intdigest(names[b], h) for h, b in zip(hashes[first[before]].tolist(), last.tolist())], np.uint64)
                linked = np.zeros(n, bool)
                linked[start] = _in_bitmap(self.pairs, chain)[place] if len(chain) else False
                fits &= linked
            if k in self.lengths:
                # a phrase that ends in the context was counted before
                counted = place if not self.context else place[start + k >= self.context]
                yield from self._packed(before, last, np.bincount(counted, minlength=len(phrases)), labels, keys, texts, hashes, max(WIDEST >> 4 * k, 1))
            if k == max(self.lengths):
                return
            rank = np.zeros(n, np.int64)
            rank[start] = place
            first = last
            keys = mix(keys[before] * np.uint64(0x9E3779B97F4A7C15) + hashes[last])
            labels = texts.take(pa.array(last)) if not k else pc.binary_join_element_wise(labels.take(pa.array(before)), texts.take(pa.array(last)), " ")

    def _packed(
        self, before: np.ndarray, last: np.ndarray, counts: np.ndarray, labels: pa.Array, keys: np.ndarray, texts: pa.Array,
        hashes: np.ndarray, parts: int,
    ) -> Iterator[pa.RecordBatch]:
        met = np.flatnonzero(counts)
        before, last, counts = before[met], last[met], counts[met]
        bucket = (mix(keys[before] + mix(hashes[last]) % np.uint64(parts)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((last, before, bucket))
        before, last, counts, bucket = before[order], last[order], counts[order], bucket[order]
        borders = np.searchsorted(bucket, np.arange(self.buckets + 1))
        out: dict[str, list] = {f.name: [] for f in _PACKED}
        for b in np.flatnonzero(np.diff(borders)):
            own = slice(borders[b], borders[b + 1])
            first = np.flatnonzero(np.concatenate([[True], before[own][1:] != before[own][:-1]]))
            row = (
                int(b), self.lang, "\n".join(labels.take(pa.array(before[own][first])).to_pylist()),
                np.diff(np.append(first, len(before[own]))).astype("<u4").tobytes(),
                " ".join(texts.take(pa.array(last[own])).to_pylist()), counts[own].astype("<u8").tobytes(),
            )
            for column, value in zip(out.values(), row):
                column.append(value)
        yield pa.RecordBatch.from_pydict(out, _PACKED)


def stripes(
    texts: DataFrame, lengths: Sequence[int], buckets: int, words: np.ndarray | None = None, pairs: np.ndarray | None = None,
) -> DataFrame:
    """Stripes (``PACKED_DDL``) of ``texts`` (lang, text): a row for each bucket and flush of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, 1):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = counters.get(lang)
                    if own is None:
                        own = counters[lang] = Counter(lang, lengths, buckets, words, pairs)
                    for piece in _pieces(text.encode("utf-8")):
                        found = words_of(piece)
                        own.add(found)
                        size += len(found)
                        if len(own.held) >= BATCH_WORDS:
                            size -= len(own.held)
                            yield from own.flush(goes_on=True)
                            size += len(own.held)
                    own.add([_BORDER])
                    size += 1
                # however many languages there are, the words held are bounded
                if size >= BATCH_WORDS:
                    for own in counters.values():
                        yield from own.flush()
                    counters.clear()
                    size = 0
        for own in counters.values():
            yield from own.flush()

    return texts.mapInArrow(run, PACKED_DDL)


def _reduced(table: pa.Table) -> pa.Table:
    summed = table.group_by(["lang", "prefix", "next"], use_threads=False).aggregate([("f", "sum")])
    return summed.select(["lang", "prefix", "next", "f_sum"]).rename_columns(["lang", "prefix", "next", "f"])


def merged(rows: DataFrame, least: int, tasks: int) -> DataFrame:
    """(lang, prefix, next, f) of the entries of merged stripes with a count of at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, TASK_ENTRIES
        for batch in batches:
            for _, lang, prefixes, sizes, next_, counts in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(sizes, "<u4")
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                held.append(pa.table({
                    "lang": pa.repeat(lang, len(owner)), "prefix": pa.array(prefixes.split("\n")).take(owner),
                    "next": pa.array(next_.split(" ")), "f": pa.array(np.frombuffer(counts, "<i8")),
                }))
                size += len(owner)
                if size >= limit:
                    held = [_reduced(pa.concat_tables(held))]
                    size = held[0].num_rows
                    limit = 2 * size + TASK_ENTRIES
        if held:
            whole = _reduced(pa.concat_tables(held))
            yield from whole.filter(pc.greater_equal(whole["f"], least)).to_batches(max_chunksize=50_000)

    return rows.repartition(tasks, "bucket").mapInArrow(run, "lang string, prefix string, next string, f bigint")


def bitmap(hashed: DataFrame, key: Column) -> np.ndarray:
    """The bits of all keys, collected as 64-bit words: BITMAP_BITS // 64 rows at most."""
    at = F.pmod(key, F.lit(BITMAP_BITS)).alias("at")
    bits = hashed.select(at).groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    found = bits.toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def frequent_phrases(texts: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all word occurrences; and staged (lang, prefix, next, f) of phrases up to ``longest`` words."""
    spark = texts.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    singles = staged(merged(stripes(texts, [0], 4 * width), 1, width), "words")
    n = staged(singles.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    tasks = max(-(-(n.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // TASK_ENTRIES), width)
    frequent = singles.filter(F.col("f") >= least)
    words = bitmap(frequent, F.xxhash64("lang", "next"))
    found = [frequent]
    if longest > 1:
        pairs = staged(merged(stripes(texts, [1], tasks, words), least, tasks), "word-pairs")
        found.append(pairs)
        if longest > 2:
            chains = bitmap(pairs, F.xxhash64("lang", "prefix", "next"))
            found.append(merged(stripes(texts, list(range(2, longest)), tasks, words, chains), least, tasks))
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return n, staged(whole, "phrases")


def mine(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", *, longest: int = 5, least: int = 100, top: int = 2_000,
    missing: str = "und",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best collocations of each group, named as ``group_col``.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at blanks and tabs into
    words. Candidates are phrases of 2 to ``longest`` words that occur ``a >= least`` times in a group; ``n`` is the
    number of its words. A cut after k words gives ``l`` and ``r``, the frequencies of both parts, and
    floor(1000 * a * n / (l * r)); the lowest counts, of equal ones that with the fewest words first. A
    candidate within a longer one that is as frequent is dropped. Rows without a group belong to ``missing``. Null
    and empty texts, and texts of blanks and signs, hold no word. Ties in score and ``a`` go by the bytes
    of the phrase. Repeated rows count as often as they come; an empty table gives an empty one. Other columns play no part.
    """
    texts = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit(missing)).alias("lang"), F.col(text_col).alias("text"))
    n, phrases = frequent_phrases(texts.filter(F.length("text") > 0), longest, least)
    whole = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    named = phrases.select("lang", whole.alias("phrase"), "prefix", "f").withColumn("words", F.split("phrase", " "))
    # a frequent phrase subsumes what it holds; it is enough to look one word further on either side
    after = named.filter(F.size("words") > 2).select("lang", F.col("prefix").alias("phrase"), "f")
    later = named.filter(F.size("words") > 2).select("lang", F.array_join(F.slice("words", 2, longest), " ").alias("phrase"), "f")
    most = after.union(later).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    candidates = named.filter(F.size("words") > 1).select("lang", "phrase", F.col("f").alias("a"), "words")
    candidates = candidates.join(most, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    # each part of a candidate is frequent itself; a part that many candidates share is a hot key of the join
    cuts = candidates.drop("longer").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    first, rest = F.array_join(F.slice("words", F.lit(1), F.col("k")), " "), F.array_join(F.slice("words", F.col("k") + 1, F.lit(longest)), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    totals = named.select("lang", "phrase", "f")
    small = is_small(totals)
    cuts = attach(cuts, totals.toDF("lang", "first", "l"), ["lang", "first"], small=small)
    cuts = attach(cuts, totals.toDF("lang", "rest", "r"), ["lang", "rest"], small=small)
    cuts = attach(cuts, n, ["lang"])
    # 38 digits hold the products exactly
    score = F.expr("(cast(a as decimal(19,0)) * cast(1000 * n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    cuts = cuts.withColumn("score", score.cast("bigint"))
    best = F.min_by(F.struct("l", "r", "n", "score"), F.struct("score", "k")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # ranked in parts first, so that no task sorts all phrases of a language
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    leading = scored.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= top).drop("place")
    ranked = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    found = ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return found.withColumnRenamed("lang", group_col)
