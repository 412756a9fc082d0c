"""Approximate nearest neighbours over balanced posting lists."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import blocked, clean, matrix, merge_best

SAMPLE = 20_000  # vectors that the fit reads at most
MOST_LISTS = 512  # centroids, held in memory by every task
COPIES = 4  # lists a boundary vector stands in at most
SCHEMA = "query_id long, vec_id long, score double"


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means on distinct unit vectors whose lists pay for their size: full lists look farther away."""
    points = np.unique(sample, axis=0)
    lists = max(1, min(lists, len(points)))
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), lists, replace=False)]
    price = np.zeros(lists)
    for _ in range(rounds):
        far = 2 - 2 * points @ centres.T + price
        own = far.argmin(1)
        sizes = np.bincount(own, minlength=lists)
        price += 0.05 * (sizes / (len(points) / lists) - 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        full = sizes > 0
        centres[full] = sums[full] / np.maximum(np.linalg.norm(sums[full], axis=1, keepdims=True), 1e-12)
    return centres


class Graph:
    """Centroids with links to their nearest ones and to random far ones; searched by a beam."""

    def __init__(self, centres: np.ndarray, links: int = 24, seed: int = 7) -> None:
        self.centres = centres
        n = len(centres)
        near = np.argsort(-(centres @ centres.T), axis=1, kind="stable")[:, : links + 1]
        far = np.random.default_rng(seed).integers(0, n, (n, 4))
        self.links = np.hstack([near, far])
        self.entries = np.arange(0, n, max(1, n // 16))

    def search(self, v: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``beam`` centroids found, nearest first, and their distances."""
        seen = np.zeros(len(self.centres), bool)
        known = self.entries
        seen[known] = True
        dist = 2 - 2 * self.centres[known] @ v
        opened = np.zeros(len(self.centres), bool)
        while True:
            order = np.argsort(dist, kind="stable")[:beam]
            known, dist = known[order], dist[order]
            todo = known[~opened[known]][:8]
            if not len(todo):
                return known, np.sqrt(np.maximum(dist, 0))
            opened[todo] = True
            new = np.unique(self.links[todo])
            new = new[~seen[new]]
            seen[new] = True
            known = np.concatenate([known, new])
            dist = np.concatenate([dist, 2 - 2 * self.centres[new] @ v])


def chosen_lists(graph: Graph, vectors: np.ndarray, ratio: float, beam: int, most: int) -> list[list[int]]:
    """For each vector the lists within ``ratio`` times the distance of its nearest centroid, ``most`` at most."""
    out = []
    for v in vectors:
        at, dist = graph.search(v, beam)
        out.append([int(x) for x in at[dist <= dist[0] * ratio + 1e-9][:most]])
    return out


def fit_index(rows: DataFrame, sample: int = SAMPLE, most_lists: int = MOST_LISTS, list_rows: int = 200) -> dict[int, np.ndarray]:
    """Centroids for each vector length, from at most ``sample`` vectors drawn by a hash of the id."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    out = {}
    for dim, part in drawn.groupby(drawn["v"].map(len)):
        count = min(most_lists, math.ceil(len(part) / list_rows))
        out[int(dim)] = balanced_centroids(unit(matrix(part["v"])), count)
    return out


def with_lists(rows: DataFrame, index: dict[int, np.ndarray], ratio: float, beam: int, most: int) -> DataFrame:
    """``rows`` with ``dim`` and one row for each ``list``; lengths the fit did not see share list 0."""

    def assign(batches):
        graphs = {d: Graph(c) for d, c in index.items()}
        for b in batches:
            for i in range(0, len(b), 2048):
                part = b.iloc[i : i + 2048].copy()
                lists = pd.Series([[0]] * len(part), index=part.index, dtype=object)
                for d, group in part.groupby(part["v"].map(len)):
                    if d in graphs:
                        lists[group.index] = pd.Series(chosen_lists(graphs[d], unit(matrix(group["v"])), ratio, beam, most), index=group.index)
                part["lists"] = lists
                yield part[["vec_id", "v", "lists"]]

    held = rows.select("vec_id", "v").mapInPandas(assign, "vec_id long, v array<double>, lists array<int>")
    return held.select("vec_id", "v", F.size("v").alias("dim"), F.explode("lists").alias("list"))


def search(rows: DataFrame, queries: DataFrame, k: int, index=None, boundary: float = 1.05, probe: float = 1.35,
           beam: int | None = None, block_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by cosine, in double precision.

    Every row stands in the lists whose centroid is within ``boundary`` times its
    nearest one's distance (``COPIES`` at most); a query reads the lists within
    ``probe`` times: all of them, unless ``beam`` gives a most. Lists longer than ``block_rows`` are dealt into blocks, so a
    vector that a third of all rows share fills many tasks. ``rows`` and
    ``queries`` have ``vec_id, v`` without zero vectors. A query whose lists hold
    fewer than ``k`` others gets the rest by reading all lists; with fewer
    candidates than ``k`` it gets all. Repeated ids count once with their best score. No rows give no rows.
    """
    index = fit_index(rows) if index is None else index
    posted = blocked(with_lists(rows, index, boundary, 16, COPIES), ["dim", "list"], block_rows, "block")
    blocks = posted.groupBy("dim", "list").agg(F.first("blocks").alias("blocks"))
    key = ["dim", "list", "block"]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            ids, m = right["vec_id"].to_numpy(), matrix(right["v"])
            norms = np.sqrt((m * m).sum(1))
            repeated = len(np.unique(ids)) < len(ids)
            for q, v in zip(left["vec_id"], left["v"]):
                v = np.asarray(v, float)
                cosine = (m * v).sum(1) / (norms * np.sqrt((v * v).sum()))
                cosine[ids == q] = -np.inf
                order = np.argsort(-cosine, kind="stable")
                if repeated:  # the best row of each id
                    order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
                for j in order[:k]:
                    if ids[j] != q:
                        found.append((int(q), int(ids[j]), float(cosine[j])))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def within(asked: DataFrame) -> DataFrame:
        sent = asked.join(blocks, ["dim", "list"]).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
        pairs = sent.select(*key, "vec_id", "v").groupBy(*key).cogroup(posted.select(*key, "vec_id", "v").groupBy(*key))
        return merge_best(pairs.applyInPandas(score, SCHEMA), k, "double")

    every = max(map(len, index.values()), default=1)
    probed = with_lists(queries, index, probe, beam or every, every)
    found = within(probed)
    short = found.groupBy(F.col("query_id").alias("vec_id")).count().where(F.col("count") >= k).select("vec_id")
    rest = queries.join(short, "vec_id", "left_anti").withColumn("dim", F.size("v"))
    whole = within(rest.join(blocks.select("dim", "list"), "dim"))
    return found.join(whole.select("query_id").distinct(), "query_id", "left_anti").unionByName(whole)


def op5_ann(spark, sf_dir: str) -> DataFrame:
    rows = clean(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).where(F.exists("v", lambda x: x != 0))
    return search(rows, rows.where(F.col("vec_id") % 50 == 0), 5)
