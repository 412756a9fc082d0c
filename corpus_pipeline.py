"""The corpus pipeline: five stages over the documents, each written and reread by its caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.durable import Scratch, durable
from tidemark.llm import jaccard, linededup, mixing, pieces, quality


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject.

    Without labelled documents of both classes nothing can be told apart: all are kept.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not any(part.any() for part in model):
        return docs
    return quality.classify(docs, model).where("predicted = 1").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that three sources share."""
    return linededup.drop_spread_lines(docs).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that three sources share, or two if they have 50 words or more.

    Near copies keep the latter, as such documents are dropped whole. Telling them is a Jaccard join, so the stages
    drop the latter where near copies are dropped, and the lines of three sources before.
    """
    return drop_copied_passages(durable(drop_lines(spark, docs, sf_dir)))


def drop_copied_passages(docs: DataFrame) -> DataFrame:
    """All documents, without lines of 50 words or more that two sources share, except in near copies."""
    return linededup.drop_passages(docs).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, five words a shingle, similarity 0.8; the others without copied passages."""
    return jaccard.keep_one(durable(drop_copied_passages(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate takes it."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document taken."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("line_dedup", drop_lines),
    ("near_duplicates", keep_one_of_each),
    ("mixing", mix_sources),
    ("encoding", encode_pieces),
]

# The classifier's scores and the encoding are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.put("docs", stage(spark, docs, sf_dir))
        scratch.keep("docs")
    return STAGES[-1][1](spark, docs, sf_dir)
