"""Sets of word shingles as sorted arrays of 64-bit hashes, computed on whole buffers."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes hashed at once: eight times as much memory is held for a moment, a few times over.
PIECE = 512 << 10

#: Words of more bytes are hashed one by one.
LONG_WORD = 256

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACES = [m | np.uint64(1) for m in mix(np.arange(11, 43, dtype=np.uint64) * _BASE)]
#: What keeps of eight bytes those of a word that ends among them.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def _hashed(part: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the words between ``first`` and ``last``: eight bytes after the other, each mixed into what came before.

    Words of up to eight bytes and one length never share a hash; of others each pair does by chance only.
    """
    low = np.concatenate([_LOWER[part], np.zeros(8, np.uint8)])
    eight = np.ndarray(len(part) + 1, "<u8", low.data, strides=(1,))  # the eight bytes from every place on
    size = last - first
    out = mix((size.astype(np.uint64) + np.uint64(1)) * _BASE)
    open_ = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(open_):
        left = np.minimum(size[open_] - at, 8)
        out[open_] = mix((out[open_] ^ (eight[first[open_] + at] & _KEEP[left])) + _BASE)
        at += 8
        open_ = open_[size[open_] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(low[first[i] : last[i]].tobytes(), 42)
    return out


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a byte buffer; words are runs of bytes that are not blanks, A-Z lowered."""
    starts, hashes, at = [], [], 0
    while at < len(buffer):
        end = min(at + PIECE, len(buffer))
        if end < len(buffer):  # cut at a blank
            blanks = np.flatnonzero(_BLANK[buffer[at:end]])
            while not len(blanks) and end < len(buffer):
                end = min(end + PIECE, len(buffer))
                blanks = np.flatnonzero(_BLANK[buffer[at:end]])
            if end < len(buffer):
                end = at + int(blanks[-1]) + 1
        part = buffer[at:end]
        word = np.concatenate([[False], ~_BLANK[part], [False]])
        first, last = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
        starts.append(first + at)
        hashes.append(_hashed(part, first, last))
        at = end
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def shingle_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """The distinct ``words``-word shingles of each text; of fewer words the whole sequence as one; none without words."""
    raw = [t.encode("utf-8") if t else b"" for t in texts]
    starts, hashes = word_hashes(np.frombuffer(b" ".join(raw) + b" ", np.uint8))
    borders = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raw]))
    count = max(len(hashes) - words + 1, 0)
    rolling = np.full(count, words, np.uint64)
    for i in range(words):
        rolling += hashes[i : i + count] * _PLACES[i]
    rolling = mix(rolling)
    out = []
    for a, b in zip(borders, borders[1:]):
        if b - a >= words:
            out.append(np.unique(rolling[a : b - words + 1]))
        elif b > a:
            own = hashes[a:b] * np.array(_PLACES[: b - a], np.uint64)
            out.append(mix(own.sum(dtype=np.uint64, keepdims=True) + np.array([b - a], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(tokens: np.ndarray) -> int:
    """A name of the set as a signed 64-bit number."""
    total = mix(tokens ^ _BASE).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.array([len(tokens)], np.uint64) * _PLACES[9]).view(np.int64)[0])
