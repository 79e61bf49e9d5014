"""Benchmark decontamination by pigeonhole edit matching.

An item of m normalised characters may occur with up to k = rate * m edits. Cut into k + 1 pieces,
at least one piece of any such occurrence is unchanged: all pieces are searched exactly in one pass
over a text, and the surroundings of each hit are verified by the bit-parallel distance of Myers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_texts

_WORD = re.compile(r"[^\W_]+")
#: Bytes of normalised benchmark text searched in one pass.
PASS_BYTES = 8 << 20


def normal(text: str | None) -> str:
    """Words of letters and digits in lower case, one blank between them."""
    return " ".join(_WORD.findall(text)).lower() if text else ""


def word_places(text: str) -> list[tuple[int, int, int]]:
    """(offset in the normal form, start, end in the text) of each word."""
    out, at = [], 0
    for word in _WORD.finditer(text):
        out.append((at, word.start(), word.end()))
        at += len(word.group().lower()) + 1
    return out


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into errors + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def distances(item: str, text: str) -> list[int]:
    """Least edit distance between the item and a substring of ``text`` that ends at each position."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score, out = full, 0, len(item), []
    for c in text:
        match = masks.get(c, 0)
        vertical = match | down
        diagonal = (((match & up) + up) ^ up) | match
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        # substrings may begin anywhere: no charge enters at the top
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(vertical | plus)), plus & vertical
        out.append(score)
    return out


def shares_enough(item: str, errors: int, window: str, grams: set[str]) -> bool:
    """Whether enough three-character pieces of the window are the item's: an edit spoils three at most."""
    needed = len(item) - 2 - 3 * errors
    return needed <= 0 or sum(map(grams.__contains__, map(str.__add__, map(str.__add__, window, window[1:]), window[2:]))) >= needed


def occurrences(item: str, errors: int, text: str) -> list[tuple[int, int, int]]:
    """(start, end, distance) of the best substring in each run of ends within ``errors`` edits."""
    found, run = [], []
    for end, score in enumerate([*distances(item, text), errors + 1]):
        if score <= errors:
            run.append((score, end))
        elif run:
            score_, last = min(run)
            window = text[max(0, last + 1 - len(item) - errors) : last + 1][::-1]
            back = distances(item[::-1], window)  # ends of the reversed match: its start
            start = last - back.index(score_)
            found.append((start, last + 1, score_))
            run = []
    return found


def unspaced(char: str) -> bool:
    """Letters of scripts that put no blanks between words: East Asian, and those of mainland South-East Asia."""
    code = ord(char)
    return code >= 0x2E80 and not 0xA4D0 <= code <= 0xD7FF and not 0xFB00 <= code <= 0xFDFF or 0x0E00 <= code <= 0x0EFF or 0x1000 <= code <= 0x109F or 0x1780 <= code <= 0x17FF


def at_borders(text: str, start: int, end: int) -> bool:
    """Whether a part of a normal form begins and ends where words do; in scripts without blanks it may anywhere."""
    before = start == 0 or text[start - 1] == " " or unspaced(text[start])
    return before and (end == len(text) or text[end] == " " or unspaced(text[end - 1]))


@dataclass
class Items:
    """Items of one pass, and all their pieces in one automaton; ``bordered`` are the numbers of those that count
    only unchanged and as whole words."""

    rows: list[tuple[int, str, int]]
    bordered: frozenset[int] = frozenset()

    def automaton(self):
        machine = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for number, (_, item, errors) in enumerate(self.rows):
            for offset, piece in pieces(item, errors):
                owners.setdefault(piece, []).append((number, offset))
        for piece, places in owners.items():
            machine.add_word(piece, (len(piece), places))
        machine.make_automaton()
        return machine

    def search(self, machine, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, distance) in the normal form of a text."""
        starts: dict[int, set[int]] = {}
        for end, (length, places) in machine.iter(text):
            for number, offset in places:
                starts.setdefault(number, set()).add(end + 1 - length - offset)
        found = set()
        for number, begins in starts.items():
            _, item, errors = self.rows[number]
            if number in self.bordered:
                found.update((number, a, a + len(item), 0) for a in begins if at_borders(text, a, a + len(item)))
                continue
            grams = {item[i : i + 3] for i in range(len(item) - 2)}
            windows: list[list[int]] = []
            for begin in sorted(begins):
                low, high = max(0, begin - errors), min(len(text), begin + len(item) + errors)
                if windows and low <= windows[-1][1]:
                    windows[-1][1] = max(high, windows[-1][1])
                else:
                    windows.append([low, high])
            for low, high in windows:
                window = text[low:high]
                if shares_enough(item, errors, window, grams):
                    found.update((number, low + a, low + b, d) for a, b, d in occurrences(item, errors, window))
        return sorted(found)


def _passes(items: DataFrame, item_col: str, text_col: str, rate: float, shortest: int):
    """Items in groups of a checked size, so that what a pass sends to the tasks is bounded."""
    group, size = [], 0

    def made() -> Items:
        return Items(group, frozenset(n for n, (_, text, _) in enumerate(group) if len(text) < shortest))

    for row in items.select(F.col(item_col).try_cast("bigint").alias("i"), F.col(text_col).alias("t")).sort("i", "t").toLocalIterator():
        text = normal(row["t"])
        if not text or row["i"] is None:
            continue
        if group and size + len(text) > PASS_BYTES:
            yield made()
            group, size = [], 0
        group.append((row["i"], text, int(rate * len(text)) if len(text) >= shortest else 0))
        size += len(text)
    if group:
        yield made()


def find(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", rate: float = 0.08, shortest: int = 20, hits: str = "hits",
) -> DataFrame:
    """The ``keep`` columns of every row of ``docs``, and ``hits``: array of (item_id, start_char,
    end_char, distance) in the characters of the whole text, one for each place where an item occurs
    within ``rate`` edits per normalised character.

    Matching ignores case, white space and punctuation. Items of under ``shortest`` normalised characters count
    where they occur unchanged and as whole words, so an item of one word is found wherever that word is; items
    without a letter or digit, or whose id is absent or no number, find nothing; null and empty texts have no hits;
    items that repeat are all reported; repeated rows stay repeated; a ``hits`` column of the input
    is replaced, other columns play no part. A benchmark over PASS_BYTES is searched in several
    passes. Narrow: documents are not shuffled.
    """
    struct = "array<struct<item_id:bigint,start_char:int,end_char:int,distance:int>>"
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start_char", pa.int32()), ("end_char", pa.int32()), ("distance", pa.int32())]))
    keep = [c for c in keep if c != hits]
    out = docs.withColumn(hits, F.lit(None).cast(struct)) if hits not in docs.columns else docs.drop(hits).withColumn(hits, F.lit(None).cast(struct))
    for items in _passes(benchmark, item_col, item_text, rate, shortest):

        def make(items: Items = items):
            machine = items.automaton()

            def work(text: str | None, before: list | None) -> tuple:
                form = normal(text)
                rows = before or []
                for number, start, end, distance in items.search(machine, form) if form else ():
                    places = word_places(text)
                    inside = [p for p in places if p[0] < end and p[0] + (p[2] - p[1]) > start] or places[:1]
                    rows.append({"item_id": items.rows[number][0], "start_char": inside[0][1], "end_char": inside[-1][2], "distance": distance})
                return (rows,)

            return work

        columns = list(dict.fromkeys([*keep, text_col]))
        out = map_texts(out, [text_col, hits], columns, f"`{hits}` {struct}", {hits: kind}, make)
    return out.select(*keep, F.coalesce(F.col(hits), F.array().cast(struct)).alias(hits))
