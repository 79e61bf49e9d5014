"""Edit-aware token counts: a segment tree of pre-token counts per document.

A text is cut into pre-tokens by the tokenizer's pattern, and a leaf of the tree holds the
characters and tokens of LEAF pre-tokens. Inner nodes hold sums. An edit re-encodes the pre-tokens
it touches, those whose end it may have influenced, and those after it until a pre-token starts
where one started before; sums are updated on the paths to the root. Nothing else is read again. A leaf
that has grown beyond FULL leaves is cut into new ones, for which the sums of all leaves are added up once.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_texts, package_file

#: Pre-tokens in a new leaf, and in how many times as many a leaf is cut; characters beyond its end on which a pre-token may
#: depend, white space aside: where a run of it is cut may depend on all of the run and on what follows.
LEAF, FULL, AHEAD = 64, 4, 4
TABLE_ROWS = 200_000


class Tokenizer:
    """Byte-pair ranks and a pre-token pattern; counts the tokens of a pre-token once while remembered."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        # the tokenizer's white space is the Unicode property
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.known: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, parts: Sequence[str]) -> list[int]:
        try:
            return list(map(self.known.__getitem__, parts))
        except KeyError:
            if len(self.known) > TABLE_ROWS:
                self.known.clear()
            for part in {p for p in parts if p not in self.known}:
                self.known[part] = len(self.encoding.encode_ordinary(part))
            out = list(map(self.known.__getitem__, parts))
            for part in {p for p in parts if len(p) > 64}:
                del self.known[part]
            return out


class SegmentTree:
    """Leaves are lists of pre-tokens; ``chars`` and ``tokens`` are complete binary trees of sums over them."""

    def __init__(self, tokenizer: Tokenizer, text: str) -> None:
        self.tokenizer = tokenizer
        parts = tokenizer.cut(text)
        counts = tokenizer.counts(parts)
        self.leaves = [parts[i : i + LEAF] for i in range(0, len(parts), LEAF)] or [[]]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.base + i] = sum(map(len, leaf))
            self.tokens[self.base + i] = sum(counts[i * LEAF : (i + 1) * LEAF])
        for node in range(self.base - 1, 0, -1):
            self._add_up(node)
        self.encoded = 0

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) for a character; the last leaf that can hold the end."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.base, start

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in place of characters start .. stop - 1; places outside the text are moved to its ends."""
        start = min(max(start, 0), self.length)
        stop = min(max(stop, start), self.length)
        first, index, at = self._first_changed(start)
        head, kept, edge = self.leaves[first][:index], [], at  # kept: old pre-tokens from here on, as far as they are needed
        last, after = first, index

        def more() -> bool:
            """Takes one more old pre-token."""
            nonlocal last, after, edge
            while after >= len(self.leaves[last]):
                if last + 1 >= len(self.leaves):
                    return False
                last, after = last + 1, 0
            kept.append(self.leaves[last][after])
            edge += len(kept[-1])
            after += 1
            return True

        while edge < stop + AHEAD and more():
            pass
        wanted = 8
        while True:
            ended = False
            for _ in range(wanted):
                if not more():
                    ended = True
                    break
            old = "".join(kept)
            text = old[: start - at] + new + old[stop - at :]
            shift = len(new) - (stop - start)
            ends, place = {}, at
            for i, part in enumerate(kept):
                ends[place + shift - at] = i  # where old pre-tokens start in the new text
                place += len(part)
            parts, found, resumed = [], 0, None
            settled = (start - at) + len(new)
            for match in self.tokenizer.pattern.finditer(text):
                if match.start() >= settled and match.start() in ends:
                    resumed = ends[match.start()]
                    break
                if match.end() + AHEAD > len(text) and not ended:
                    break  # it may reach beyond what was taken
                parts.append(match.group())
                found = match.end()
            if resumed is not None or (ended and found == len(text)):
                break
            wanted *= 2
        rest = kept[resumed:] if resumed is not None else []
        self.encoded += len(parts)
        self._store(first, last, head + parts + rest + self.leaves[last][after:])

    def _first_changed(self, start: int) -> tuple[int, int, int]:
        """(leaf, place in it, first character) of the first pre-token that an edit at ``start`` may change: all before it
        end at least AHEAD before the edit and before the white space that reaches up to it."""
        leaf, at = self._leaf_at(start)
        index = 0
        while index < len(self.leaves[leaf]) and at + len(self.leaves[leaf][index]) <= start:
            at += len(self.leaves[leaf][index])
            index += 1

        def before() -> str | None:
            """The pre-token before the place reached, empty leaves skipped."""
            nonlocal leaf, index
            while index == 0:
                if leaf == 0:
                    return None
                leaf -= 1
                index = len(self.leaves[leaf])
            return self.leaves[leaf][index - 1]

        held = self.leaves[leaf][index][: start - at] if index < len(self.leaves[leaf]) else ""
        run = at + len(held.rstrip())  # where the white space before the edit begins, as far as is known
        open_ = run == at
        while (part := before()) is not None and (open_ or at > run - AHEAD):
            index -= 1
            at -= len(part)
            if open_:
                run = at + len(part.rstrip())
                open_ = run == at
        return leaf, index, at

    def _store(self, first: int, last: int, parts: list[str]) -> None:
        """Spreads pre-tokens over leaves first .. last and adds up the paths above them."""
        width = max(1, -(-len(parts) // (last - first + 1)))
        if width > FULL * LEAF:
            self._split(first, last, parts)
            return
        nodes = set()
        for i, leaf in enumerate(range(first, last + 1)):
            own = parts[i * width : (i + 1) * width]
            self.leaves[leaf] = own
            self.chars[self.base + leaf] = sum(map(len, own))
            self.tokens[self.base + leaf] = sum(self.tokenizer.counts(own))
            nodes.add((self.base + leaf) // 2)
        while nodes:
            for node in nodes:
                if node:
                    self._add_up(node)
            nodes = {node // 2 for node in nodes if node > 1}

    def _split(self, first: int, last: int, parts: list[str]) -> None:
        """Puts new leaves in place of leaves first .. last; empty leaves go. Only the new ones are counted, and the sums of
        all are added up, which happens once in as many new pre-tokens as fill FULL leaves."""
        new = [parts[i : i + LEAF] for i in range(0, len(parts), LEAF)]
        sums = [(leaf, self.chars[self.base + i], self.tokens[self.base + i]) for i, leaf in enumerate(self.leaves)]
        sums[first : last + 1] = [(leaf, sum(map(len, leaf)), sum(self.tokenizer.counts(leaf))) for leaf in new]
        sums = [s for s in sums if s[0]]
        self.leaves = [leaf for leaf, _, _ in sums]
        self.base = 1 << (len(sums) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, (_, chars, tokens) in enumerate(sums):
            self.chars[self.base + i], self.tokens[self.base + i] = chars, tokens
        for node in range(self.base - 1, 0, -1):
            self._add_up(node)

    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)


EDITS = "array<struct<start:int,stop:int,replacement:string>>"


def count(
    docs: DataFrame, ranks_path: str, pattern: str, edits: Column | None = None,
    edits_of: Callable[[str], list[tuple[int, int, str]]] | None = None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """The ``keep`` columns of every row with ``n_tokens`` of the whole text, ``n_edits``,
    ``n_tokens_edited`` after its edits and ``n_encoded`` (pre-tokens encoded for them); with
    ``with_text`` also the ``edited`` text.

    Edits are an array column (start, stop, replacement) or come from a function of the text. They
    apply in order, each to the text the one before left, in characters; null edits and null
    replacements delete nothing and insert nothing. Null texts count as empty, and an edit may
    insert into them. Repeated rows stay repeated; columns not named play no part. Narrow.
    """
    ranks = package_file(ranks_path)

    def make():
        tokenizer = Tokenizer(ranks, pattern)

        def work(text: str | None, changes: list | None) -> tuple:
            tree = SegmentTree(tokenizer, text or "")
            before = tree.total
            steps = [(c["start"], c["stop"], c["replacement"]) for c in changes or () if c]
            if edits_of is not None:
                steps += edits_of(text or "")
            for start, stop, new in steps:
                start = 0 if start is None else start
                tree.replace(start, start if stop is None else stop, new or "")
            return (before, len(steps), tree.total, tree.encoded, *([tree.text()] if with_text else []))

        return work

    fields = {"n_tokens": pa.int64(), "n_edits": pa.int64(), "n_tokens_edited": pa.int64(), "n_encoded": pa.int64()}
    schema = "n_tokens bigint, n_edits bigint, n_tokens_edited bigint, n_encoded bigint"
    if with_text:
        fields["edited"], schema = pa.string(), schema + ", edited string"
    changes = edits if edits is not None else F.lit(None)
    rows = docs.select(*keep, F.col(text_col).alias("_text"), changes.cast(EDITS).alias("_edits"))
    return map_texts(rows, ["_text", "_edits"], list(keep), schema, fields, make)


_MASKED = re.compile(
    r"(?<![\w.+-])[\w.+-]+@[\w-]+\.[\w.-]*\w|\b(?=[a-fA-F]*\d)[0-9a-fA-F]{32,}\b|\b\d[\d ()+-]{8,}\d\b"
)
_MASK_SIGN = re.compile(r"[\d@]")


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that mask mail addresses, long keys and long numbers, from the end to the start so that places stay valid."""
    if not _MASK_SIGN.search(text):
        return []
    return [(m.start(), m.end(), "[masked]") for m in _MASKED.finditer(text)][::-1]
