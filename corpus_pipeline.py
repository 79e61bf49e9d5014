"""Stages that turn raw documents into training text, each reading what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import decontamination, jaccard_join, language_id, piece_codec, quality
from tidewell.llm.common import id_remainder, staged
from tidewell.llm.queries import piece_model, read

#: Scores below this reject a document.
LEAST_QUALITY = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (all, if nothing is labelled)."""
    training = id_remainder("doc_id", 4) != 2
    _, model = quality.train(docs, read(spark, sf_dir, "labels"), training)
    return quality.keep_good(docs, model, LEAST_QUALITY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a learned language: neither without letters nor rejected by distance."""
    model = language_id.fit(docs, id_remainder("doc_id", 3) != 1)
    names = docs.columns
    inner = [f"_{i}" for i in range(len(names))]  # the columns of the documents may be called anything
    plain = docs.select(*[F.col(c).alias(i) for c, i in zip(names, inner)])
    placed = {c: i for c, i in zip(names, inner)}
    found = language_id.predict(plain, model, placed["doc_id"], placed["text"], tuple(i for i in inner if i != placed["doc_id"]))
    return found.filter("not rejected").select(*[F.col(placed[c]).alias(c) for c in names])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each_group(docs)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs within the edit budget."""
    found = decontamination.find(docs, read(spark, sf_dir, "benchmark"), tuple(docs.columns), hits="_hits")
    return found.filter(F.size("_hits") == 0).drop("_hits")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): piece ids with the end id, and the text they decode to."""
    coded = piece_codec.encode(docs, piece_model())
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", free_of_benchmarks),
    ("encoding", encoded),
]

#: The stages learn models and segment text, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; what each returns is written and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
