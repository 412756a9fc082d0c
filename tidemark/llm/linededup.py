"""Cross-site line dedup by distinct-site spread, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import Scratch, durable
from tidemark.llm import jaccard

MIN_SITES = 3
MIN_WORDS = 5
PASSAGE_WORDS = 50


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``docs`` has no such column."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = f"_{name}"
    return name


def spread_lines(lines: DataFrame, min_sites: int, lg_k: int = 10) -> DataFrame:
    """Keys of lines on at least ``min_sites`` sites, with the first document that holds each.

    A sketch of sites per key merges over all partitions. Where its estimate is
    within a factor of two of the threshold, sites are counted exactly.
    """
    known = F.coalesce("site", F.lit("\u0000null"))
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(known, lg_k)).alias("spread"),
        F.min(F.struct("doc_id", "text_key")).alias("first"))
    sketched = durable(sketched.where(F.col("spread") * 2 >= min_sites))
    near = sketched.where(F.col("spread") < 2 * min_sites).select("key")
    exact = (lines.select("key", known.alias("s")).join(near, "key", "left_semi").distinct()
             .groupBy("key").count().where(F.col("count") >= min_sites).select("key"))
    sure = sketched.where(F.col("spread") >= 2 * min_sites).select("key")
    return sketched.select("key", "first").join(sure.unionAll(exact), "key", "left_semi")


def drop_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
                      spare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``docs`` without lines that stand on ``min_sites`` sources or more; ``n_lines, n_removed`` added.

    Lines are trimmed to be compared; those under ``min_words`` words are left
    alone. The document of smallest id (null first) keeps its line, so nothing is lost
    from the corpus. A document left without lines has an empty text and stays.
    Null texts stay null; null sources count as one site. Equal rows are treated
    alike. ``n_chars`` follows the text. Columns with the added names are replaced.
    ``spare`` is given the documents that hold such lines and returns the ``doc_id`` of those that keep theirs.
    """
    base = docs.drop("n_lines", "n_removed")
    own_id, own_key, text_key, dropped = (unused(docs, name) for name in ("_id", "_key", "_text_key", "_gone"))
    base = base.withColumn(text_key, F.xxhash64("text"))
    split = F.split(F.col("text"), "\n", -1)
    cells = F.transform(split, lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("line")))
    long = F.filter(cells, lambda c: F.size(F.split(c["line"], r"\s+", min_words)) >= min_words)
    keyed = F.transform(long, lambda c: F.struct(c["pos"].alias("pos"), F.struct(
        F.xxhash64(c["line"]).alias("a"), F.xxhash64(F.lit(1), c["line"]).alias("b")).alias("key")))
    lines = base.select(
        "doc_id", F.col(text_key).alias("text_key"), F.col("source").alias("site"), F.explode(keyed).alias("c"),
    ).select("doc_id", "text_key", "site", "c.pos", "c.key")
    spread = durable(spread_lines(lines, min_sites))
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))
    gone = (lines.join(spread, "key").where(~same).groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias(dropped))
            .select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), dropped))
    if spare is not None:
        held = lines.join(spread, "key", "left_semi").select("doc_id").distinct()
        with Scratch(docs.sparkSession) as scratch:
            spared = durable(spare(scratch.put("held", docs.join(held, "doc_id", "left_semi"))))
        gone = gone.join(spared.select(F.col("doc_id").alias(own_id)), own_id, "left_anti")
    out = base.join(gone, F.col(text_key).eqNullSafe(F.col(own_key)) & F.col("doc_id").eqNullSafe(F.col(own_id)), "left")
    kept = F.filter(split, lambda x, i: ~F.array_contains(F.col(dropped), i))
    out = out.withColumns({
        "n_lines": F.greatest(F.size(split), F.lit(0)).cast("long"),
        "n_removed": F.greatest(F.size(F.coalesce(dropped, F.array().cast("array<int>"))), F.lit(0)).cast("long"),
        "text": F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
    }).drop(dropped, own_id, own_key, text_key)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id`` of the documents that have a near copy among ``docs``."""
    linked = jaccard.linked_components(docs.select("doc_id", "text"), words, percent)
    many = linked.where("doc_id is not null").distinct().groupBy("component_id").count().where("count > 1")
    return linked.join(many, "component_id", "left_semi").select("doc_id").distinct()


def drop_passages(docs: DataFrame, min_sites: int = 2, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """``drop_spread_lines`` for long lines, which two sources hardly share by chance.

    Documents that are near copies of another holder of such a line keep theirs: they go as
    a whole when near copies do, and cut to what differs they would no longer be found.
    """
    return drop_spread_lines(docs, min_sites, min_words, near_copies)


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return drop_spread_lines(docs).select("doc_id", "text", "n_lines", "n_removed")
