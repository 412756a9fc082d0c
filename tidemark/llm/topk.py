"""Exact top-k by inner product: columnar branch and bound."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import blocked, clean, matrix, merge_best

EXACT = float(2**52)
SCHEMA = "query_id long, vec_id long, score long"


def long_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in Python integers, held to the range of a long: for components too large for doubles."""
    whole = [[int(x) for x in r] for r in rows]
    low, high = -(2**63), 2**63 - 1
    return np.array([[min(high, max(low, sum(a * int(b) for a, b in zip(r, q)))) for r in whole] for q in queries], dtype=object)


def search_block(q_ids, queries: np.ndarray, ids, rows: np.ndarray, k: int, width: int = 16) -> list[tuple]:
    """The ``k`` best rows of one block for each query, equal scores by id; a query's own id is no candidate.

    Components lie in columns and are read ``width`` at a time. What the unread
    ones can still add is bounded by the product of both remaining norms; a row
    whose upper bound is under the query's k-th best lower bound is compacted away.
    """
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], np.ascontiguousarray(rows[order].T)
    if np.abs(queries).max() * np.abs(columns).max() * len(columns) >= EXACT:
        full = long_products(queries, columns.T)
        found = []
        for q, line in zip(q_ids, full):
            ranked = sorted((-int(s), int(i)) for s, i in zip(line, ids) if i != q)[:k]
            found += [(int(q), i, -s) for s, i in ranked]
        return found
    dims = len(columns)
    rest = lambda m, d: np.sqrt((m[d:] ** 2).sum(0))
    left_rows = {d: rest(columns, d) for d in range(0, dims + 1, width)}
    found = []
    # The first columns for all queries at once, the others for each query's survivors.
    first = min(width, dims)
    head = queries[:, :first] @ columns[:first]
    for qi, q in enumerate(q_ids):
        alive, partial, d = np.flatnonzero(ids != q), None, first
        partial = head[qi, alive]
        while d < dims:
            if len(alive) > k:
                bound = rest(queries[qi], d) * left_rows[d][alive] * (1 + 1e-9) + 0.5
                kth = np.partition(partial - bound, len(alive) - k)[len(alive) - k]
                keep = partial + bound >= kth
                alive, partial = alive[keep], partial[keep]
            upto = min(d + width, dims)
            partial = partial + queries[qi, d:upto] @ columns[d:upto, alive]
            d = upto
        best = np.argsort(-partial, kind="stable")[:k]  # rows stand in id order: ties go to the smaller
        found += [(int(q), int(ids[alive[j]]), int(partial[j])) for j in best]
    return found


def top_k(candidates: DataFrame, queries: DataFrame, k: int, block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score``: exact, over all ``candidates`` (``vec_id, v``; ``v`` whole numbers as doubles).

    Candidates and queries are dealt into blocks; each pair of blocks of one
    dimension is one task's work, so no task holds more than two blocks. Every
    row is ranked, as in the SQL: rows of a repeated id are candidates each. No queries give no rows.
    """
    by = ["dim"]
    c = blocked(candidates.withColumn("dim", F.size("v")), by, block_rows, "block")
    # Queries may be rows of the candidates: own names keep the two sides apart.
    asked = queries.select((F.col("vec_id") + F.lit(0)).alias("vec_id"), F.transform("v", lambda x: x).alias("v"))
    q = blocked(asked.withColumn("dim", F.size("v")), by, query_rows, "part")
    blocks, parts = c.groupBy("dim").agg(F.first("blocks").alias("blocks")), q.groupBy("dim").agg(F.first("parts").alias("parts"))
    q = q.join(blocks, "dim").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    c = c.join(parts, "dim").withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    key = ["dim", "block", "part"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids, rows = right["vec_id"].to_numpy(), matrix(right["v"])
            at = left["vec_id"].to_numpy()
            asked = matrix(left["v"])
            for i in range(0, len(at), 256):
                found += search_block(at[i : i + 256], asked[i : i + 256], ids, rows, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    partial = q.select(*key, "vec_id", "v").groupBy(*key).cogroup(c.select(*key, "vec_id", "v").groupBy(*key)).applyInPandas(search, SCHEMA)
    return merge_best(partial, k, "long", once=False)


def op7_topk(spark, sf_dir: str) -> DataFrame:
    rows = clean(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    whole = rows.select("vec_id", F.transform("v", lambda x: F.rint(x * 256 - ((x * 256) % 1 + 1) % 1)).alias("v"))
    return top_k(whole, whole.where(F.col("vec_id") % 50 == 0), 5)
