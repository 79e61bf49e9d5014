"""Similarity self-join of documents on word shingles, exact, by signature trees.

1. Each text becomes a set of 64-bit shingle hashes. Equal sets form one class.
2. Tokens are dealt out by hash in packed blocks, each class once per batch, and counted: what only one
   class has cannot be in an overlap. A class keeps its shared tokens, rarest first; one whose shared
   tokens are less than the required share of its set has no partner and leaves.
3. Two linked classes share a token among the first few of each (prefix lemma: all but ceil(t * n) - 1
   tokens in a common order, of which the unshared come first). Classes that share one form clusters.
4. Every cluster is joined by a signature tree in one task. A cluster too large for a task is dealt out
   in chunks that hold a few common pivots; then only what is not connected yet visits other chunks.
5. What is connected is contracted to components.

Sets and classes are named by 64-bit hashes: among n classes the chance that any two share a name is
about n * n / 4e19.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.keyed_join import attach
from . import components, signature_tree
from .common import slices, staged
from .shingles import set_key, shingle_sets

#: Tokens packed at once in a task; tokens counted in one task on average; most buckets of one pass.
BATCH_TOKENS, BUCKET_TOKENS, MOST_BUCKETS = 600_000, 1_000_000, 16_384
#: Classes of a signature tree in one task, on average, and pivots of a cluster that needs several.
TREE_CLASSES, PIVOTS = 256, 8
#: A token in more than one in HOT classes is dealt out by batch, not by its hash.
HOT = 200


def _pack(values: np.ndarray) -> bytes:
    """Byte planes, highest first: sorted numbers then compress well."""
    return np.ascontiguousarray(values.astype(f">u{values.itemsize}").view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _unpack(planes: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return np.ascontiguousarray(raw).view(f">u{width}").ravel().astype(f"u{width}")


def _top(values: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` (a power of two) equal ranges each 64-bit number falls in."""
    return (values >> np.uint64(64 - (parts.bit_length() - 1))).astype(np.int64) if parts > 1 else np.zeros(len(values), np.int64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in slices(batch, 1):
            yield part, part.column(1).to_pylist()


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Names a row by its id and text."""
    return F.xxhash64(docs[id_col].try_cast("bigint"), docs[text_col])


def digests(docs: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, DataFrame]:
    """Staged: (id, n_shingles, class, row) of every row; and tokens frequent in some batch, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("hot", pa.int64()), ("row", pa.int64())])
        for part, texts in _texts(batches):
            sets = shingle_sets(texts, words)
            keys = [set_key(s) if len(s) else None for s in sets]
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                 pa.nulls(n, pa.int64()), part.column(2)], schema=schema)
            distinct = [s for k, s in {k: s for k, s in zip(keys, sets)}.items() if k is not None]
            if distinct:
                tokens, counts = np.unique(np.concatenate(distinct), return_counts=True)
                often = counts > max(len(distinct) // HOT, 8)
                if often.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(int(often.sum()), pa.int64()), pa.array(counts[often], pa.int64()), pa.nulls(int(often.sum()), pa.int64()),
                         pa.array(tokens[often].view(np.int64)), pa.nulls(int(often.sum()), pa.int64())], schema=schema)

    rows = staged(
        docs.select(F.col(id_col).try_cast("bigint").alias("id"), F.col(text_col).alias("text"), row_key(docs, id_col, text_col).alias("row"))
        .mapInArrow(run, "id bigint, n bigint, class bigint, hot bigint, row bigint"),
        "set-digests",
    )
    return rows.filter("hot is null").drop("hot"), rows.filter("hot is not null").select("hot", "n")


def shared_tokens(docs: DataFrame, text_col: str, words: int, hot: np.ndarray, total: int, share: Fraction) -> DataFrame:
    """Staged: (class, n, tokens, prefix) of the classes that may have a partner.

    ``tokens``: the class's tokens that other classes have too, as int64 bytes, rarest first;
    ``prefix``: how many of them a partner must meet.
    """
    wanted = max(64, -(-total // BUCKET_TOKENS))
    buckets = min(1 << (wanted - 1).bit_length(), MOST_BUCKETS)
    # beyond what one pass can deal out, the range of the hashes is cut and the texts read once for each cut
    cuts = 1 << max(0, (-(-total // (BUCKET_TOKENS * MOST_BUCKETS)) - 1).bit_length())
    parts = buckets * cuts

    def deal(cut: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            size = 0

            def flush() -> Iterator[pa.RecordBatch]:
                nonlocal size
                keys = np.array(list(held), np.int64).view(np.uint64)
                sizes = np.array([len(s) for s in held.values()], np.uint32)
                tokens = np.concatenate(list(held.values()))
                owner = np.repeat(np.arange(len(keys), dtype=np.int64), sizes)
                order = np.argsort(tokens, kind="stable")
                tokens, owner = tokens[order], owner[order]
                at = _top(tokens, parts)
                if len(hot):  # known to be shared: any task can say so
                    known = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
                    at[known] = owner[known] % parts
                    order = np.argsort(at, kind="stable")
                    tokens, owner, at = tokens[order], owner[order], at[order]
                borders = np.searchsorted(at, np.arange(cut * buckets, (cut + 1) * buckets + 1))
                out: dict[str, list] = {"part": [], "classes": [], "sizes": [], "tokens": [], "owners": []}
                for b in np.flatnonzero(np.diff(borders)):
                    own = slice(borders[b], borders[b + 1])
                    present, local = np.unique(owner[own], return_inverse=True)
                    for column, value in zip(out.values(), (
                        int(b), _pack(keys[present]), _pack(sizes[present]), _pack(tokens[own]), _pack(local.astype(np.uint32)),
                    )):
                        column.append(value)
                held.clear()
                size = 0
                yield pa.RecordBatch.from_pydict(out, pa.schema([("part", pa.int64())] + [(c, pa.binary()) for c in ("classes", "sizes", "tokens", "owners")]))

            for part, texts in _texts(batches):
                for tokens in shingle_sets(texts, words):
                    if len(tokens) and (key := set_key(tokens)) not in held:
                        held[key] = tokens
                        size += len(tokens)
                if size >= BATCH_TOKENS:
                    yield from flush()
            if size:
                yield from flush()

        rows = docs.select(F.lit(0).alias("_"), F.col(text_col).alias("text"))
        return rows.mapInArrow(run, "part bigint, classes binary, sizes binary, tokens binary, owners binary")

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        """The postings of a part: tokens of two classes or more, dealt on to their classes."""
        classes, sizes, tokens = [], [], []
        for row in part.itertuples(index=False):
            owners = _unpack(row.owners, 4)
            classes.append(_unpack(row.classes, 8)[owners])
            sizes.append(_unpack(row.sizes, 4)[owners])
            tokens.append(_unpack(row.tokens, 8))
        owner, size, token = np.concatenate(classes), np.concatenate(sizes), np.concatenate(tokens)
        del classes, sizes, tokens, part
        order = np.lexsort((owner, token))
        owner, size, token = owner[order], size[order], token[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])
        owner, size, token = owner[new], size[new], token[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        counts = np.diff(np.concatenate([first, [len(token)]]))
        level = np.repeat(np.minimum(counts, 65534).astype(np.uint16), counts)
        if len(hot):
            level[hot[np.minimum(np.searchsorted(hot, token), len(hot) - 1)] == token] = 65535
        kept = level > 1
        owner, size, token, level = owner[kept], size[kept], token[kept], level[kept]
        to = _top(owner, buckets)
        order = np.lexsort((token, owner, to))
        owner, size, token, level, to = owner[order], size[order], token[order], level[order], to[order]
        borders = np.searchsorted(to, np.arange(buckets + 1))
        out: dict[str, list] = {"part": [], "classes": [], "sizes": [], "counts": [], "tokens": [], "levels": []}
        for b in np.flatnonzero(np.diff(borders)):
            own = slice(borders[b], borders[b + 1])
            present, at, held = np.unique(owner[own], return_index=True, return_counts=True)
            for column, value in zip(out.values(), (
                int(b), _pack(present), _pack(size[own][at]), _pack(held.astype(np.uint32)), _pack(token[own]), _pack(level[own]),
            )):
                column.append(value)
        return pd.DataFrame(out)

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        """All shared tokens of the classes of a part; the classes that may have a partner stay."""
        owner, size, token, level = [], [], [], []
        for row in part.itertuples(index=False):
            held = _unpack(row.counts, 4)
            owner.append(np.repeat(_unpack(row.classes, 8), held))
            size.append(np.repeat(_unpack(row.sizes, 4), held))
            token.append(_unpack(row.tokens, 8))
            level.append(_unpack(row.levels, 2))
        owner, size, token, level = (np.concatenate(x) for x in (owner, size, token, level))
        order = np.lexsort((token, level, owner))
        owner, size, token, level = owner[order], size[order], token[order], level[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])])  # a hot token met in several batches
        owner, size, token = owner[new], size[new], token[new]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ends = np.concatenate([first[1:], [len(owner)]])
        held, whole = ends - first, size[first].astype(np.int64)
        required = -(-whole * share.numerator // share.denominator)
        rows = np.flatnonzero(held >= required)
        return pd.DataFrame({
            "class": owner[first[rows]].view(np.int64), "n": whole[rows],
            "tokens": [token[first[r] : ends[r]].astype("<u8").tobytes() for r in rows],
            "prefix": held[rows] - required[rows] + 1,
        })

    dealt = "part bigint, classes binary, sizes binary, counts binary, tokens binary, levels binary"
    met = None
    for cut in range(cuts):
        some = deal(cut).groupBy("part").applyInPandas(meet, dealt)
        some = staged(some, "shared-tokens") if cuts > 1 else some
        met = some if met is None else met.unionByName(some)
    return staged(met.groupBy("part").applyInPandas(gather, "class bigint, n bigint, tokens binary, prefix bigint"), "candidate-sets")


def _meeting(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges between nodes that share a key."""
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    return node[same], node[same + 1]


def clusters(sets: DataFrame) -> DataFrame:
    """(class, cluster): classes that reach each other over tokens of their prefixes.

    Classes that meet within a batch are contracted before anything is dealt out, so a token that
    very many classes share arrives at its task as a few rows.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            cls, raw, prefix = (batch.column(i).to_pylist() for i in range(3))
            if not cls:
                continue
            token = np.concatenate([np.frombuffer(r, np.int64, k) for r, k in zip(raw, prefix)])
            node = np.repeat(np.array(cls, np.int64), prefix)
            members, least = components.pointers(*_meeting(token, node))
            at = np.searchsorted(members, node)
            inside = np.append(members, 0)[at] == node if len(members) else np.zeros(len(node), bool)
            if inside.any():
                node = np.where(inside, np.append(least, 0)[at], node)
            pairs = np.unique(np.stack([token, node], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], schema=schema)
            if len(members):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(members), pa.int64()), pa.array(members), pa.array(least)], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if held:
            nodes, least = components.pointers(*_meeting(*(np.concatenate(x) for x in zip(*held))))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["a", "b"])

    rows = staged(sets.select("class", "tokens", "prefix").mapInArrow(prefixes, "token bigint, a bigint, b bigint"), "prefixes")
    met = rows.filter("token is not null").select("token", "a").repartition("token").mapInArrow(meet, "a bigint, b bigint")
    edges = met.union(rows.filter("token is null").select("a", "b"))
    return components.labels(edges).toDF("class", "cluster")


def _arrays(part: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    return [np.sort(np.frombuffer(t, np.uint64)) for t in part["tokens"]], part["n"].to_numpy(np.int64)


def _within(share: Fraction):
    def work(part: pd.DataFrame) -> pd.DataFrame:
        """Each class with the smallest class it is connected to among those of its cluster in the group."""
        found: list[pd.DataFrame] = []
        for _, own in part.groupby("cluster", sort=True):
            own = own.drop_duplicates("class").sort_values("class")
            tokens, sizes = _arrays(own)
            order = signature_tree.similar_first(tokens, sizes)
            tokens = [tokens[i] for i in order]
            names = own["class"].to_numpy()[order]
            tree = signature_tree.Tree(tokens, sizes[order], signature_tree.bits_for(tokens))
            groups = signature_tree.Groups(np.arange(len(names)))
            signature_tree.join(tree, None, groups, (share.numerator, share.denominator))
            least = pd.Series(names).groupby(groups.labels).transform("min").to_numpy()
            found.append(pd.DataFrame({"a": names, "b": least}))
        return pd.concat(found)

    return work


def _across(share: Fraction):
    def work(part: pd.DataFrame) -> pd.DataFrame:
        """Links between the visitors of a chunk and its own classes that are not connected yet."""
        sides = []
        for visitor in (False, True):
            own = part[part["visitor"] == visitor].sort_values("class")
            tokens, sizes = _arrays(own)
            order = signature_tree.similar_first(tokens, sizes)
            sides.append(([tokens[i] for i in order], sizes[order], own["class"].to_numpy()[order], own["label"].to_numpy()[order]))
        bits = max(signature_tree.bits_for(s[0]) for s in sides)
        x, y = (signature_tree.Tree(s[0], s[1], bits) if s[0] else None for s in sides)
        if x is None or y is None:
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        names = np.concatenate([s[2] for s in sides])
        groups = signature_tree.Groups(np.unique(np.concatenate([s[3] for s in sides]), return_inverse=True)[1])
        links = signature_tree.join(x, y, groups, (share.numerator, share.denominator))
        return pd.DataFrame([(names[i], names[j]) for i, j in links], columns=["a", "b"], dtype=np.int64)

    return work


def connected(sets: DataFrame, share: Fraction) -> DataFrame:
    """(class, label): the smallest class reached over links; classes without a link may be missing."""
    member = staged(clusters(sets), "clusters")
    sizes = member.groupBy("cluster").agg(F.count("*").alias("size"))
    member = member.join(sizes, "cluster").withColumn("chunks", F.ceil(F.col("size") / TREE_CLASSES).cast("int"))
    member = member.withColumn("chunk", F.pmod(F.hash("class"), F.col("chunks")))
    placed = staged(member.join(sets.drop("prefix"), "class"), "clustered-sets")
    tasks = max(1, -(-placed.count() // TREE_CLASSES))
    edge = "a bigint, b bigint"
    small = placed.filter("chunks = 1").select(F.pmod(F.xxhash64("cluster"), F.lit(tasks)).alias("task"), "cluster", "class", "n", "tokens")
    whole = small.groupBy("task").applyInPandas(_within(share), edge).toDF("class", "label")
    large = placed.filter("chunks > 1")
    if large.isEmpty():
        return whole
    rank = Window.partitionBy("cluster").orderBy(F.xxhash64("class"), "class")
    picked = large.select("cluster", "class", "chunks").withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= PIVOTS)
    pivots = picked.drop("r").join(large.select("class", "n", "tokens"), "class").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    columns = ["cluster", "chunk", "class", "n", "tokens"]
    chunked = large.select(*columns).union(pivots.select(*columns))
    found = staged(chunked.groupBy("cluster", "chunk").applyInPandas(_within(share), edge), "links")
    joined = components.labels(found).withColumnRenamed("node", "class")
    state = staged(large.join(joined, "class", "left").withColumn("label", F.coalesce("label", "class")), "chunk-states")
    # what is not connected to the largest part of its cluster visits every chunk of it
    weights = state.groupBy("cluster", "label").count()
    main = weights.groupBy("cluster").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    strays = state.join(main, "cluster").filter("label <> main").drop("main")
    visits = strays.select("cluster", "class", "n", "tokens", "label", "chunks").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    pieces = visits.groupBy("cluster", "chunk").agg(F.ceil(F.count("*") / TREE_CLASSES).cast("int").alias("pieces"))
    visits = visits.join(pieces, ["cluster", "chunk"]).withColumn("piece", F.pmod(F.hash("class"), F.col("pieces")))
    hosts = state.join(pieces, ["cluster", "chunk"]).withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)")))
    columns = ["cluster", "chunk", "piece", "class", "n", "tokens", "label"]
    meeting = visits.select(*columns, F.lit(True).alias("visitor")).union(hosts.select(*columns, F.lit(False).alias("visitor")))
    more = staged(meeting.groupBy("cluster", "chunk", "piece").applyInPandas(_across(share), edge), "links")
    if more.isEmpty():
        return whole.union(state.select("class", "label"))
    last = components.labels(joined.select(F.col("class").alias("a"), F.col("label").alias("b")).union(more))
    return whole.union(last)


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: str) -> tuple[DataFrame, DataFrame]:
    """(id, n, class, row) of every row; and (class, group, component_id) of the classes, linked ones in one group."""
    share = Fraction(similarity)
    if not 0 < share <= 1:
        raise ValueError("the similarity is above 0 and 1 at most")
    rows, often = digests(docs, id_col, text_col, words)
    classes = rows.filter("class is not null").groupBy("class").agg(F.min("id").alias("first"), F.max("n").alias("n"))
    total, count = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if total:
        # counted per batch, a token with more than 1 / HOT of the classes is frequent in some batch; there are
        # at most 2 * HOT times the mean set size of these
        frequent = often.groupBy("hot").agg(F.sum("n").alias("n")).filter(F.col("n") > max(count // (2 * HOT), 8 * TREE_CLASSES))
        hot = np.array(sorted(r["hot"] % (1 << 64) for r in frequent.select("hot").collect()), np.uint64)
        joined = connected(shared_tokens(docs, text_col, words, hot, total, share), share)
        group = F.coalesce("label", "class")
        grouped = staged(classes.join(joined, "class", "left").select("class", "first", group.alias("group")), "grouped-classes")
        least = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
        # a group may hold a third of the classes: the join is one that splits hot keys
        named = staged(attach(grouped.select("class", "group"), least, ["group"]).select("class", "group", "component_id"), "named-classes")
    else:
        named = classes.select("class", F.col("class").alias("group"), F.col("first").alias("component_id"))
    return rows, named


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: str = "0.75",
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``.

    Two documents are linked when the Jaccard similarity of their sets of ``words``-word shingles is
    at least ``similarity`` (a decimal text, compared exactly); ``component_id`` is the smallest id that
    can be reached over links, the own id included. A text of fewer words is one shingle; null and
    empty texts, and texts of blanks, have no shingle, are linked with nothing and keep their own id.
    Equal texts are linked however many there are. Rows without an id take part, but name no
    component: theirs is null unless they reach an id; an id that is no number counts as none. Repeated rows stay repeated. Other columns
    play no part.
    """
    rows, named = _grouped(docs, id_col, text_col, words, similarity)
    out = attach(rows.filter("class is not null"), named, ["class"]).select("id", "n", "component_id")
    alone = rows.filter("class is null").select("id", "n", F.col("id").alias("component_id"))
    return out.union(alone).toDF(id_col, "n_shingles", "component_id")


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: str = "0.75",
) -> DataFrame:
    """The rows of ``docs`` without near copies: exactly one of each group that links connect, whatever its ids.

    It is the one of the smallest id; a row without an id only where its group has no other. Of rows that
    repeat id and text one stays, the smallest by a hash of its columns. An id that repeats with texts of
    several groups may stay once for each. Rows without a shingle are linked with nothing: each id and
    text of them stays once, and all of those without an id.
    """
    rows, named = _grouped(docs, id_col, text_col, words, similarity)
    linked = attach(rows.filter("class is not null"), named.select("class", "group"), ["class"])
    copies = linked.groupBy("group", "row", "id").agg(F.count("*").alias("copies"))
    first = copies.groupBy("group").agg(F.min(F.struct(F.isnull("id").alias("nameless"), "id", "row", "copies")).alias("first"))
    alone = rows.filter("class is null").groupBy("row").agg(F.count("id").alias("copies"))
    kept = first.select("first.row", "first.copies").union(alone)
    kept = staged(kept.select(F.col("row").alias("_kept"), "copies"), "kept-rows")
    # the list of rows grows with the documents: it is merged, not broadcast, at every size
    def of(keys: DataFrame) -> DataFrame:
        keys = keys.select("_kept").hint("merge")
        return docs.join(keys, row_key(docs, id_col, text_col) == keys["_kept"], "left_semi")

    once = of(kept.filter("copies <= 1"))
    repeated = kept.filter("copies > 1")
    if repeated.isEmpty():
        return once
    whole = F.struct(*[F.col(c) for c in docs.columns])
    rows = of(repeated)
    one = rows.groupBy(row_key(docs, id_col, text_col).alias("_id")).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("_row"))
    return once.union(one.select("_row.*"))


def keep_one(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id names its component in ``joined`` (of ``join``): one document of each group.

    For tables in which an id is one document: of rows that repeat an id one stays, the smallest by a
    hash of its columns, and where their texts differ, a group may go without a survivor. Rows without an
    id stay, as nothing can name them. ``one_of_each_group`` works on rows and has neither limit.
    """
    ids = joined.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.count("*").alias("_rows"), F.min("component_id").alias("component_id")
    ).filter(F.col(id_col) == F.col("component_id"))
    ids = staged(ids.select(id_col, "_rows"), "kept-ids")
    # the list of ids grows with the documents: it is merged, not broadcast, at every size
    once = docs.join(ids.filter("_rows = 1").select(id_col).hint("merge"), id_col, "left_semi").select(docs.columns)
    out = once.union(docs.filter(F.col(id_col).isNull()))
    repeated = ids.filter("_rows > 1").select(id_col)
    if repeated.isEmpty():
        return out
    rows = docs.join(repeated.hint("merge"), id_col, "left_semi")
    whole = F.struct(*[F.col(c) for c in docs.columns])
    first = rows.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("_row"))
    return out.union(first.select("_row.*"))
