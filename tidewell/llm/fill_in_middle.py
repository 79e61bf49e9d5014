"""Fill-in-middle examples: documents cut at two unit borders and put in another order.

A text becomes a row of units (lines by default). An indexable skip list over the borders between
them answers where a border lies: every link of every lane carries how many units and how many code
points it leaps over, so descending from the sparsest lane and adding up what was leapt reaches a
border of any rank exactly, in a logarithmic number of steps and without counting from the start.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_texts
from .shingles import mix

#: A unit is a line with its end, or what follows the last line end.
LINES = r"[^\n]*\n|[^\n]+"
#: One border in 2 ** FANOUT_BITS of a lane is in the next one too.
FANOUT_BITS = 2


@dataclass(frozen=True)
class Markers:
    """Texts that mark the parts of an example."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        for a in self.all:
            for b in self.all:
                overlap = any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b))))
                if not a or overlap or (a is not b and a in b):
                    raise ValueError("markers must not be empty, overlap each other or hold one another")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class SkipList:
    """Borders of units, in lanes; border 0 is the head and lies in all of them.

    Link ``j`` of a lane leads from its border ``j`` to its next one (or to the end) and carries the
    widths of what it leaps; ``below`` tells which link of the lane below begins at the same border.
    Which borders rise to a sparser lane is decided by a hash of their rank, so equal texts give equal lists.
    """

    def __init__(self, widths: Sequence[int]) -> None:
        chars = np.asarray(widths, np.int64)
        units = np.ones(len(chars), np.int64)
        ranks = np.arange(len(chars), dtype=np.uint64)
        self.total = len(chars)
        self.lanes: list[tuple[list[int], list[int], list[int]]] = [(units.tolist(), chars.tolist(), [])]
        tall = mix(ranks)
        while len(ranks) > 1 << FANOUT_BITS:
            level = len(self.lanes)
            rises = (tall >> np.uint64(FANOUT_BITS * (level - 1))) % np.uint64(1 << FANOUT_BITS) == 0
            rises[0] = True
            if rises.all():
                break
            below = np.flatnonzero(rises)
            units, chars = np.add.reduceat(units, below), np.add.reduceat(chars, below)
            ranks, tall = ranks[below], tall[below]
            self.lanes.append((units.tolist(), chars.tolist(), below.tolist()))

    def offset(self, rank: int) -> int:
        """Code points before the border with ``rank`` units before it."""
        if not 0 <= rank <= self.total:
            raise IndexError(rank)
        left, width, at = rank, 0, 0
        for units, chars, below in reversed(self.lanes):
            while left and units[at] <= left:
                left -= units[at]
                width += chars[at]
                at += 1
            if not left:
                return width
            if below:
                at = below[at]
        return width


def unit_widths(text: str, unit: re.Pattern[str]) -> list[int]:
    """Code points of each unit; what no unit matches is refused, as the units would not give the text back."""
    ends = [0, *(m.end() for m in unit.finditer(text))]
    widths = [b - a for a, b in zip(ends, ends[1:])]
    if ends[-1] != len(text) or any(m.start() != a for m, a in zip(unit.finditer(text), ends)):
        raise ValueError("the units do not cover the text")
    return widths


def draws(seed: int, key: Column) -> list[Column]:
    """Four numbers below 2 ** 32 for a row: the first 8-digit groups of a hash of seed and key (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int, rate: int = 100, spm_rate: int = 50,
    unit: str = LINES, markers: Markers = Markers(), carry: Sequence[str] = (),
) -> DataFrame:
    """(id, [carried columns], n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` units; ``form`` is ``psm``, ``spm`` or ``plain``; ``prefix_chars`` and ``middle_chars`` are code points of
    the parts, null if plain; ``output`` is the example. A row's cuts and form depend on ``seed`` and its id
    alone, so rows that repeat an id and text repeat their example, and rows without an id share the cuts of
    an empty id. ``rate`` per cent of the rows are transformed, ``spm_rate`` per cent of these suffix first. Null and
    empty texts, and texts that hold a marker, stay plain (null: an empty output). Parts may be empty. A text
    is handled whole, however long; an empty table gives an empty one. Other columns play no part.
    """
    form_rates = (rate, spm_rate)

    def make():
        pattern, lines = re.compile(unit), unit == LINES

        def work(text: str | None, h1: int, h2: int, h3: int, h4: int) -> tuple:
            text = text or ""
            if lines:  # the same widths, found faster
                parts = text.split("\n")
                widths = [len(p) + 1 for p in parts[:-1]] + ([len(parts[-1])] if parts[-1] else [])
            else:
                widths = unit_widths(text, pattern)
            n = len(widths)
            if not text or any(m in text for m in markers.all) or h3 % 100 >= form_rates[0]:
                return n, "plain", None, None, text
            borders = SkipList(widths)
            a, b = sorted((borders.offset(h1 % (n + 1)), borders.offset(h2 % (n + 1))))
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            first, second, last = markers.all
            if h4 % 100 < form_rates[1]:
                form, output = "spm", f"{second}{suffix}{first}{prefix}{last}{middle}"
            else:
                form, output = "psm", f"{first}{prefix}{second}{suffix}{last}{middle}"
            return n, form, a, b - a, output

        return work

    names = [id_col, *carry]
    plain = docs.select(
        F.col(text_col).alias("_text"), *[d.alias(f"_h{i}") for i, d in enumerate(draws(seed, F.col(id_col)))],
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(names)],
    )
    types = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
    fields = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    made = map_texts(plain, ["_text", *[f"_h{i}" for i in range(4)]], [f"_keep{i}" for i in range(len(names))], fields, types, make)
    return made.toDF(*names, *types)


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that an example was made of."""
    p, s, m = (F.lit(x) for x in markers.all)
    wide = [len(x) for x in markers.all]

    def place(marker: Column) -> Column:
        return F.instr(output, marker)

    def cut(start: Column, end: Column) -> Column:
        return F.substr(output, start, end - start)

    middle = F.substr(output, place(m) + wide[2])
    psm = F.concat(cut(F.lit(wide[0] + 1), place(s)), middle, cut(place(s) + wide[1], place(m)))
    spm = F.concat(cut(place(p) + wide[0], place(m)), middle, cut(F.lit(wide[1] + 1), place(p)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
