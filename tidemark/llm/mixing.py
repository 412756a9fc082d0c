"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0


def word_count(text: Column) -> Column:
    """Words of a text; null and empty texts have 0."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)), F.lit(0)).cast("long")


def fill_targets(sizes: list[float], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Share ``total`` by weight; what passes ``most`` times a size is shared anew among the rest."""
    caps = [most * s for s in sizes]
    targets, free = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}
    left = total
    while free:
        unit = left / sum(weights[i] for i in sorted(free))
        over = [i for i in sorted(free) if weights[i] * unit > caps[i]]
        if not over:
            for i in free:
                targets[i] = weights[i] * unit
            break
        for i in over:
            targets[i] = caps[i]
            left -= caps[i]
            free.discard(i)
    return targets


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: ``mix_source, source_size, target, rate``.

    ``sized`` has ``source`` and ``size``. Words are summed before the shuffle;
    the driver sees one number per source, not documents. Sources stand in code
    point order, null last, and take ``weights`` in turn. A source without words
    gets target and rate 0.
    """
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    rows = sorted(rows, key=lambda r: (r.source is None, r.source or ""))
    sizes = [float(r.n or 0) for r in rows]
    turn = [float(weights[i % len(weights)]) for i in range(len(rows))]
    targets = fill_targets(sizes, turn, share * sum(sizes), most)
    out = [(r.source, int(n), t, min(most, t / n) if n else 0.0) for r, n, t in zip(rows, sizes, targets)]
    schema = T.StructType([
        T.StructField("mix_source", T.StringType()), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()), T.StructField("rate", T.DoubleType()),
    ])
    return sized.sparkSession.createDataFrame(out, schema)


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of the key: the same in every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def plan_mix(docs: DataFrame, seed: int = 17, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies`` added.

    A document is taken floor(rate) times and once more if its seeded number
    falls under the fraction. Null and empty texts have size 0 and are taken by
    the same rule. Equal ``doc_id`` draw alike; a null id is drawn as one key.
    Columns of ``docs`` with these names are replaced.
    """
    added = ["size", "source_size", "target", "rate", "mix_source", "copies"]
    base = docs.drop(*added)
    sized = base.withColumn("size", word_count(F.col("text")))
    targets = source_targets(sized.select("source", "size"), weights, share, most)
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")), "left")
    whole = F.floor("rate")
    extra = F.when(uniform(F.col("doc_id"), seed) < F.col("rate") - whole, 1).otherwise(0)
    return joined.withColumn("copies", (whole + extra).cast("int")).drop("mix_source", "rate")


def mix(docs: DataFrame, seed: int = 17, **kw) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    planned = plan_mix(docs, seed, **kw).where(F.col("copies") > 0)
    kept = [c for c in docs.columns if c in planned.columns and c not in ("size", "source_size", "target", "copies")]
    repeated = planned.withColumn("_copy", F.explode(F.expr("array_repeat(0, copies)")))
    return repeated.select(*[F.col(f"`{c}`") for c in kept])


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return plan_mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
