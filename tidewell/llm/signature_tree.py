"""Jaccard self-joins of sets in memory by a signature tree.

Leaves are sets, ordered so that similar ones are neighbours. A node covers a range of them and
holds the OR of their token bitmaps, the range of their sizes, and the most tokens that any of them
loses to bit collisions. Two nodes are followed only while some pair below them could still overlap
enough, and only while not all sets below them are connected already.
"""

from __future__ import annotations

import numpy as np

FAN = 8


class Groups:
    """Union-find over positions, with the label of each position kept up to date."""

    def __init__(self, labels: np.ndarray) -> None:
        self.labels = labels.copy()

    def same(self, a: slice, b: slice) -> bool:
        first = self.labels[a.start]
        return bool((self.labels[a] == first).all() and (self.labels[b] == first).all())

    def join(self, i: int, j: int) -> None:
        a, b = self.labels[i], self.labels[j]
        if a != b:
            self.labels[self.labels == max(a, b)] = min(a, b)


class Tree:
    """``tokens``: sorted arrays, which may leave out tokens that no other set has; ``sizes``: of the whole sets."""

    def __init__(self, tokens: list[np.ndarray], sizes: np.ndarray, bits: int) -> None:
        self.tokens, self.sizes = tokens, sizes
        n = len(tokens)
        signature = np.zeros((n, bits // 64), np.uint64)
        spare = np.zeros(n, np.int64)
        for i, own in enumerate(tokens):
            at = np.unique((own & np.uint64(bits - 1)).astype(np.int64))
            np.bitwise_or.at(signature[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
            spare[i] = len(own) - len(at)
        held = np.array([len(t) for t in tokens], np.int64)
        #: from the leaves up: bitmaps, least and largest size, most tokens held, most tokens lost to collisions
        self.levels = [(signature, sizes, sizes, held, spare)]
        while len(self.levels[-1][0]) > 1:
            bitmap, low, high, most, lost = self.levels[-1]
            at = np.arange(0, len(bitmap), FAN)
            self.levels.append((
                np.bitwise_or.reduceat(bitmap, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.maximum.reduceat(most, at), np.maximum.reduceat(lost, at),
            ))

    def below(self, level: int, node: int) -> slice:
        width = FAN**level
        return slice(node * width, min((node + 1) * width, len(self.tokens)))

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0])))


def bits_for(tokens: list[np.ndarray]) -> int:
    """Bitmap width: several bits per token of the larger sets, within bounds."""
    longest = max((len(t) for t in tokens), default=1)
    return 1 << min(max((4 * longest - 1).bit_length(), 8), 15)


def similar_first(tokens: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """An order in which similar sets are likely neighbours: by their smallest tokens."""
    heads = np.zeros((len(tokens), 2), np.uint64)
    for row, own in zip(heads, tokens):
        row[: min(2, len(own))] = own[:2]
    return np.lexsort((sizes, heads[:, 1], heads[:, 0]))


def _may_overlap(x: Tree, xl: int, xs: np.ndarray, y: Tree, yl: int, ys: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Matrix: can any set below node xs[i] reach the share of the union with any below ys[j]?"""
    bitmap, low, high, most, lost = (part[xs] for part in x.levels[xl])
    bitmap2, low2, high2, most2, lost2 = (part[ys] for part in y.levels[yl])
    p, q = share
    common = np.bitwise_count(bitmap[:, None] & bitmap2[None]).sum(2, dtype=np.int64) + np.minimum(lost[:, None], lost2[None])
    bound = np.minimum(common, np.minimum(most[:, None], most2[None]))
    enough = (p + q) * bound >= p * (low[:, None] + low2[None])  # q * overlap >= p * union
    return enough & (q * high[:, None] >= p * low2[None]) & (q * high2[None] >= p * low[:, None])


def join(x: Tree, y: Tree | None, groups: Groups, share: tuple[int, int] = (75, 100)) -> list[tuple[int, int]]:
    """Links that connect what is similar within ``x`` (``y`` None) or between ``x`` and ``y``.

    Pairs that are connected already need no link of their own. Positions of ``y`` follow those of ``x``.
    """
    if not x.tokens or y is not None and not y.tokens:
        return []
    own = y is None
    other, offset = (x, 0) if own else (y, len(x.tokens))
    p, q = share
    links = []
    todo = [(len(x.levels) - 1, 0, len(other.levels) - 1, 0)]
    while todo:
        xl, a, yl, b = todo.pop()
        left, right = x.below(xl, a), other.below(yl, b)
        if groups.same(left, slice(right.start + offset, right.stop + offset)):
            continue
        if xl == yl == 0:
            if own and a >= b:
                continue
            first, second = x.tokens[a], other.tokens[b]
            overlap = len(np.intersect1d(first, second, assume_unique=True))
            if q * overlap >= p * (int(x.sizes[a]) + int(other.sizes[b]) - overlap):
                groups.join(a, b + offset)
                links.append((a, b + offset))
            continue
        xs = x.children(xl, a) if xl else np.array([a])
        ys = other.children(yl, b) if yl else np.array([b])
        down, down2 = max(xl - 1, 0), max(yl - 1, 0)
        hits = np.argwhere(_may_overlap(x, down, xs, other, down2, ys, share))
        pairs = [(down, int(xs[i]), down2, int(ys[j])) for i, j in hits]
        if own and down == down2:
            pairs = [t for t in pairs if t[1] <= t[3]]
        todo.extend(sorted(pairs, key=lambda t: -abs(t[1] - t[3])))  # neighbours first: they connect the most
    return links
