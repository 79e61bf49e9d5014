"""Language identification by the nearest of several centroids per language.

Texts become normalised TF-IDF vectors of letter n-grams (2 and 3 bytes of the lower-case UTF-8
text, words bounded by blanks) hashed into DIMS columns. Each language gets a few centroids by
spherical k-means over a bounded sample of its rows; document frequencies cover every training row.
A text goes to the language of its nearest centroid by cosine; a text farther from it than nearly all
texts of that language with about as many grams, which the centroids had not seen, is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, staged

DIMS = 4096
UNKNOWN = "und"
#: Steps of the number of distinct grams, half an octave each, and texts that a step's limit needs.
STEPS, LEAST_TEXTS = 2 * DIMS.bit_length() - 1, 50
#: A centroid nearest to less than this share of its language's rows stands for odd rows, not for the language.
LEAST_SHARE = 0.01
_ASCII = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def letters(text: str) -> bytes:
    """Lower-case UTF-8 with every ASCII character but letters as a blank, one blank at each end."""
    return b" " + text.lower().encode("utf-8", "replace").translate(_ASCII) + b" "


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text)) if text else False


def gram_counts(text: str, out: np.ndarray) -> None:
    """Adds the hashed 2- and 3-byte gram counts of a text to ``out``; runs of blanks do not count."""
    raw = np.frombuffer(letters(text), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return
    two = raw[:-1] * np.uint32(257) + raw[1:]
    three = two[:-1] * np.uint32(263) + raw[2:]
    solid = (raw[:-1] != 32) | (raw[1:] != 32)
    for grams, kept, salt in ((two, solid, 0x9E3779B1), (three, solid[:-1] & solid[1:], 0x85EBCA77)):
        hashed = (grams[kept] * np.uint32(salt)) >> np.uint32(20)  # the upper 12 bits: DIMS columns
        out += np.bincount(hashed, minlength=DIMS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """A row of unit length per text (zeros for a text without grams)."""
    out = np.zeros((len(texts), DIMS), np.float32)
    counts = np.zeros(DIMS, np.int64)
    for row, text in zip(out, texts):
        counts[:] = 0
        gram_counts(text, counts)
        at = np.flatnonzero(counts)
        weights = (1 + np.log(counts[at])) * idf[at]
        row[at] = weights / max(float(np.sqrt((weights**2).sum())), 1e-12)
    return out


def steps(rows: np.ndarray) -> np.ndarray:
    """The step that the number of distinct grams of each vector falls in."""
    return (2 * np.log2(np.maximum((rows > 0).sum(1), 1))).astype(int)


def pieces(text: str, draw: float) -> Iterator[str]:
    """Passages of 8, 16, ... 1024 characters of a longer text, from places set by ``draw``, of whole words if they hold any."""
    for k in range(3, 11):
        length = 1 << k
        if len(text) > length:
            start = int(draw * (1 << 30)) * 7919 * k % (len(text) - length + 1)
            piece = text[start : start + length]
            yield piece[piece.find(" ") + 1 : piece.rfind(" ")] if piece.count(" ") > 1 else piece


@dataclass
class Model:
    """Centroids (rows of unit length), the language of each, the idf, and the cosines (a row per centroid, a column
    per step) below which texts are rejected."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    limits: np.ndarray


def _clusters(rows: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from centres spread by farthest-first choice, without those of odd rows; (centroids, cosines)."""
    centres = [rows.mean(0) / max(np.linalg.norm(rows.mean(0)), 1e-12)]
    while len(centres) < min(k, len(rows)):
        centres.append(rows[np.argmin((rows @ np.array(centres).T).max(1))])
    centroids = np.array(centres)
    for _ in range(rounds):
        own = (rows @ centroids.T).argmax(1)
        for c in np.unique(own):
            mean = rows[own == c].mean(0)
            centroids[c] = mean / max(np.linalg.norm(mean), 1e-12)
    held = np.bincount((rows @ centroids.T).argmax(1), minlength=len(centroids))
    centroids = centroids[held >= LEAST_SHARE * len(rows)]
    return centroids, (rows @ centroids.T)


def _limits(step: np.ndarray, cosine: np.ndarray, low: float, slack: float, unmeasured: float) -> np.ndarray:
    """The limit of each step. One with few texts has that of the next step below; where there is none, ``unmeasured``
    or the first limit above, whichever is less, as texts of fewer grams have lower cosines."""
    out = np.full(STEPS, np.nan)
    for s in range(STEPS):
        own = cosine[step == s]
        if len(own) >= LEAST_TEXTS:
            out[s] = slack * np.quantile(own, low, method="lower")
    measured = out[~np.isnan(out)]
    before = min([unmeasured, *measured[:1]])
    for s in range(STEPS):
        out[s] = before = before if np.isnan(out[s]) else out[s]
    return out


def fit(
    docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    sample_per_language: int = 1500, clusters: int = 4, low: float = 0.01, slack: float = 0.7, unmeasured: float = 0.05,
) -> Model | None:
    """Learns from the rows where ``training`` holds and text and language are not null.

    Document frequencies come from all of them. Centroids come from about ``sample_per_language``
    rows of each language, taken by a hash of id and text: the documented bound of what a
    language's task holds. Rejection limits are per language and number of distinct grams: ``slack``
    times the ``low`` quantile of the cosines of sampled texts, and of passages of them, to centroids of
    the other half of the sample; so a few odd rows move the limit of their own language little and
    that of others not at all. ``unmeasured`` is the limit where a language has too few texts to tell.
    Returns None if there is nothing to learn from. Only the idf, and a few centroids and limits of
    each language, reach the driver.
    """
    rows = docs.filter(training & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        (F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)) / (1 << 30)).alias("draw"),
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    shares = {lang: min(1.0, sample_per_language / n) for lang, n in counts.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, seen = np.zeros(DIMS, np.int64), 0
        out: dict[str, list] = {"lang": [], "body": [], "n": [], "half": []}

        def flush() -> pa.RecordBatch:
            ready = pa.RecordBatch.from_pydict(out, pa.schema([("lang", pa.string()), ("body", pa.binary()), ("n", pa.int64()), ("half", pa.int64())]))
            for column in out.values():
                column.clear()
            return ready

        counts = np.zeros(DIMS, np.int64)
        for batch in batches:
            for lang, text, draw in zip(*(c.to_pylist() for c in batch.columns)):
                counts[:] = 0
                gram_counts(text, counts)
                frequency += counts > 0
                seen += 1
                if draw < shares[lang]:
                    half = int(draw * (1 << 30)) % 2
                    for n, piece in enumerate((text, *pieces(text, draw))):
                        if n:
                            counts[:] = 0
                            gram_counts(piece, counts)
                        at = np.flatnonzero(counts)
                        body = np.stack([at, np.minimum(counts[at], 65535)]).astype(np.uint16).tobytes()
                        for column, value in zip(out.values(), (lang, body, n, half)):
                            column.append(value)
                    if len(out["n"]) >= 500:
                        yield flush()
        for column, value in zip(out.values(), (None, frequency.tobytes(), seen, None)):
            column.append(value)
        yield flush()

    counted = staged(rows.mapInArrow(count, "lang string, body binary, n bigint, half bigint"), "language-sample")

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(DIMS, np.int64), 0
        for part in parts:
            for body, n in zip(part["body"], part["n"]):
                total += np.frombuffer(body, np.int64)
                seen += n
        yield pd.DataFrame({"body": [total.tobytes()], "n": [seen]})

    frequencies = counted.filter("lang is null").select("body", "n")
    sums = frequencies.mapInPandas(add, "body binary, n bigint").repartition(8).mapInPandas(add, "body binary, n bigint").collect()
    total = sum((np.frombuffer(r["body"], np.int64) for r in sums), np.zeros(DIMS, np.int64))
    seen = sum(r["n"] for r in sums)
    idf = np.log((1 + seen) / (1 + total)) + 0.1

    def weighed(bodies: pd.Series) -> np.ndarray:
        held = np.zeros((len(bodies), DIMS), np.float32)
        for row, body in zip(held, bodies):
            at, tally = np.frombuffer(body, np.uint16).reshape(2, -1)
            weights = (1 + np.log(tally)) * idf[at]
            row[at] = weights / max(float(np.sqrt((weights**2).sum())), 1e-12)
        return held

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        part = part[part["body"].str.len() > 0].sort_values(["body", "n"])
        whole = part[part["n"] == 0]
        if not len(whole):
            return pd.DataFrame({"lang": [], "body": [], "limits": []})
        step, cosine = [np.zeros(0, int)], [np.zeros(0)]
        for half in (0, 1):
            learned, unseen = whole[whole["half"] != half]["body"], part[part["half"] == half]["body"]
            if len(learned):
                centroids, _ = _clusters(weighed(learned), clusters, 8)
                for at in range(0, len(unseen), 1000):
                    held = weighed(unseen[at : at + 1000])
                    step.append(steps(held))
                    cosine.append((held @ centroids.T).max(1))
        limits = _limits(np.concatenate(step), np.concatenate(cosine), low, slack, unmeasured)
        centroids, _ = _clusters(weighed(whole["body"]), clusters, 8)
        return pd.DataFrame({
            "lang": part["lang"].iloc[0], "body": [c.astype(np.float32).tobytes() for c in centroids], "limits": limits.tobytes(),
        })

    found = counted.filter("lang is not null").groupBy("lang").applyInPandas(cluster, "lang string, body binary, limits binary")
    kept = sorted(found.collect(), key=lambda r: (r["lang"], bytes(r["body"])))
    if not kept:
        return None
    return Model(
        idf.astype(np.float32), np.array([np.frombuffer(r["body"], np.float32) for r in kept]),
        [r["lang"] for r in kept], np.array([np.frombuffer(r["limits"]) for r in kept]),
    )


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang_pred, score, rejected, and the columns named in ``carry``) of every whole text.

    ``score`` is the cosine to the nearest centroid, 0 to 1. Null texts and texts without a letter
    are ``und`` with score 0 and rejected. A text below the limit of its length keeps its nearest
    language and is marked as rejected. Without a model every text is ``und`` and, as nothing was
    learned, only texts without a letter are rejected. Ties go to the language that sorts first.
    Repeated rows stay repeated; other columns are left out. Narrow: nothing is shuffled.
    """
    names = [id_col, text_col, *carry]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(id_col, *carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).to_pylist()
                n = len(texts)
                langs, scores, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
                known = [i for i, t in enumerate(texts) if t and has_letter(t)]
                if model is None:
                    rejected[known] = False
                for at in range(0, len(known) if model else 0, 1000):
                    some = known[at : at + 1000]
                    held = vectors([texts[i] for i in some], model.idf)
                    cosines = held @ model.centroids.T
                    best = cosines.argmax(1)
                    top = np.clip(cosines.max(1).astype(float), 0, 1)
                    scores[some], rejected[some] = top, top < model.limits[best, steps(held)]
                    for i, c in zip(some, best):
                        langs[i] = model.languages[c]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[2:], pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)],
                    [id_col, *carry, "lang_pred", "score", "rejected"],
                )

    return docs.select(*names).mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
