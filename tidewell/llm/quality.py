"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of each text are standardised and mapped by random cosine features whose inner products
approximate a Gaussian kernel. Each task sums its part of the normal equations, so a fit moves one
small matrix per task whatever the number of rows. Scores of the labelled rows are counted in
fixed bins and pooled into a monotone curve, which turns a score into a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, staged

STATS = (
    "log_chars", "upper", "digit", "blank", "sentence_mark", "symbol", "other_mark", "non_ascii", "word_chars",
    "distinct_words", "repeated_lines", "line_chars", "marked_word", "run_of_marks", "lone_mark_word", "long_word",
)
#: Calibration bins between the raw scores -0.5 and 1.5.
BINS, LOW, HIGH = 2000, -0.5, 1.5

_CLASS = np.zeros(256, np.uint8)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = (
        1 if "A" <= _ch <= "Z" else 2 if _ch.isdigit() and _c < 128 else 3 if _c < 33 else 4 if _ch in ".!?" else
        5 if _ch in "#$%&*+<=>@\\^_`|~{}[]" else 6 if _c < 128 and not _ch.isalnum() else 7 if _c >= 128 else 0
    )
_WORD = re.compile(r"\S+")
_MARKS = re.compile(r"[^\w\s]{2,}")
_ENDS_MARKED = re.compile(r"[^\w\s.,;:'\")]+(?=\s|$)")


def statistics(text: str | None) -> list[float]:
    """The STATS of one whole text; zeros for null and empty texts."""
    if not text:
        return [0.0] * len(STATS)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    share = np.bincount(_CLASS[raw], minlength=8)[:8] / len(raw)
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if line.strip()]
    n, m = max(len(words), 1), max(len(lines), 1)
    marks = _ENDS_MARKED.findall(text)
    return [
        float(np.log1p(len(text))), share[1], share[2], share[3], share[4], share[5], share[6], share[7],
        min(len(text) / n, 40.0), len(set(words)) / n, 1 - len(set(lines)) / m if lines else 0.0,
        float(np.log1p(len(text) / m)), len(marks) / n, len(_MARKS.findall(text)) / n,
        sum(1 for w in words if len(w) == 1 and not w.isalnum()) / n, sum(1 for w in words if len(w) > 20) / n,
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, stats array<double>) of every row. Narrow."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(id_col, *carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                stats = pa.array([statistics(t) for t in part.column(1).to_pylist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], stats], [id_col, *carry, "stats"])

    return docs.select(id_col, text_col, *carry).mapInArrow(run, f"{fields}, stats array<double>")


@dataclass
class Model:
    """Standardisation, random features, weights, and the calibration curve (score, probability)."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([cosines, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.curve), 0, 1)


def pooled(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Monotone shares of each bin: neighbours out of order are pooled (bins without rows get none)."""
    blocks: list[list[float]] = []
    for p, n in zip(positive, count):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.concatenate([np.full(int(k), p / n) for p, n, k in blocks]) if blocks else np.zeros(0)


def fit(rows: DataFrame, features: int = 256, width: float = 4.0, ridge: float = 1e-3, seed: int = 11) -> Model | None:
    """Learns from (stats array<double>, label 0 or 1); rows with a null in either are left out.

    All rows take part. What reaches the driver: a mean and deviation per statistic, one matrix of
    ``features`` + 1 rows, and BINS counts. None without rows.
    """
    rows = rows.filter("stats is not null and label in (0, 1)").select("stats", F.col("label").cast("double").alias("label"))
    d = len(STATS)
    moments = rows.agg(
        F.count("*").alias("n"),
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(d)],
        *[F.sum(F.col("stats")[i] * F.col("stats")[i]).alias(f"q{i}") for i in range(d)],
    ).first()
    n = moments["n"]
    if not n:
        return None
    mean = np.array([moments[f"s{i}"] / n for i in range(d)])
    deviation = np.sqrt(np.maximum(np.array([moments[f"q{i}"] / n for i in range(d)]) - mean**2, 0))
    draw = np.random.default_rng(seed)
    model = Model(
        mean, np.where(deviation > 1e-9, deviation, 1.0), draw.normal(0, 1 / width, (d, features)),
        draw.uniform(0, 2 * np.pi, features), np.zeros(features + 1),
    )
    side = features + 2  # features, constant, label

    def equations(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((side, side))
        for part in parts:
            z = np.hstack([model.features(np.array(part["stats"].tolist())), part[["label"]].to_numpy()])
            total += z.T @ z
        yield pd.DataFrame({"row": range(side), "sums": [r.tobytes() for r in total]})

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": [key[0]], "sums": [sum(np.frombuffer(s) for s in part["sums"]).tobytes()]})

    parts = rows.mapInPandas(equations, "row int, sums binary").withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = parts.groupBy("row", "branch").applyInPandas(add, "row int, sums binary")
    sums = {r["row"]: np.frombuffer(r["sums"]) for r in some.groupBy("row").applyInPandas(add, "row int, sums binary").collect()}
    gram = np.array([sums[i] for i in range(side)])
    penalty = np.full(side - 1, ridge * n)
    penalty[-1] = 0  # the constant is not shrunk
    model.weights = np.linalg.solve(gram[:-1, :-1] + np.diag(penalty) + 1e-9 * np.eye(side - 1), gram[:-1, -1])

    def bins(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, positive = np.zeros(BINS), np.zeros(BINS)
        for part in parts:
            raw = model.raw(np.array(part["stats"].tolist()))
            at = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
            count += np.bincount(at, minlength=BINS)
            positive += np.bincount(at, part["label"], minlength=BINS)
        kept = np.flatnonzero(count)
        yield pd.DataFrame({"bin": kept, "n": count[kept], "positive": positive[kept]})

    counted = rows.mapInPandas(bins, "bin int, n double, positive double").groupBy("bin").agg(F.sum("n"), F.sum("positive"))
    table = np.array(sorted(tuple(r) for r in counted.collect()))
    centres = LOW + (table[:, 0] + 0.5) * (HIGH - LOW) / BINS
    model.curve = centres, pooled(table[:, 2], table[:, 1])
    return model


def score(stats: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """The frame of ``document_statistics`` with a probability, 0 to 1, in place of the statistics.

    Without a model (nothing labelled) every score is 0.5.
    """
    kept = [c for c in stats.columns if c != "stats"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.select(*kept).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column("stats").flatten()).reshape(batch.num_rows, len(STATS))
            found = model.score(values) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(found)], [*kept, name])

    return stats.select(*kept, "stats").mapInArrow(run, f"{fields}, `{name}` double")


def train(
    docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", carry: tuple[str, ...] = (),
) -> tuple[DataFrame, Model | None]:
    """(staged statistics with the id and the carried columns of every row of ``docs``, the model).

    Learns from rows of ``docs`` where ``training`` (over its columns) holds, joined to ``labels``
    on the id. Null ids join nothing; a document with several labels counts once for each; labels
    other than 0 and 1 are left out. None without labelled rows.
    """
    fields = docs.select(id_col, text_col, *carry, training.alias("_training"))
    stats = staged(document_statistics(fields, id_col, text_col, (*carry, "_training")), "document-statistics")
    marks = labels.select(F.col(id_col), F.col(label_col).alias("label")).filter("label in (0, 1)")
    model = fit(stats.filter("_training").select(id_col, "stats").join(marks, id_col))
    return stats.drop("_training"), model


def classify(
    docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", carry: tuple[str, ...] = (),
) -> tuple[DataFrame, Model | None]:
    """(id, carried columns, score) of every row of ``docs``, and the model of ``train``.

    Null and empty texts have statistics of zero and are scored. Repeated rows stay repeated.
    Columns of ``docs`` and ``labels`` not named here play no part. The statistics are computed once.
    """
    stats, model = train(docs, labels, training, id_col, text_col, label_col, carry)
    return score(stats, model), model


def keep_good(docs: DataFrame, model: Model | None, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, with their columns; all without a model.

    Scores are computed beside the rows, so that no text is shuffled.
    """
    if model is None:
        return docs

    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                values = np.array([statistics(t) for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(model.score(values) >= least))

    return docs.mapInArrow(run, docs.schema)
