"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = 1500  # labelled documents of each class that the fit reads at most
SIGNS = re.compile(r"[^\w\s]")
WORD = re.compile(r"\S+")
BASIC = 14


def line_features(line: str) -> list[float]:
    """Scalars of one line; none depends on the language's words."""
    words = WORD.findall(line)
    n, m = max(1, len(line)), max(1, len(words))
    signs = SIGNS.findall(line)
    letters = sum(map(str.isalpha, line)) or 1
    capitals = sum(map(str.isupper, line))
    unusual = sum(c not in ".,;:'\"-()?" for c in signs)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / m
    ends = sum(not w[-1].isalnum() for w in words)
    return [
        min(3.0, np.log1p(n) / 3), min(3.0, np.log1p(len(words)) / 3), len(signs) / n * 10, min(3.0, unusual / m * 3),
        capitals / letters * 2, sum(w.isupper() and len(w) > 1 for w in words) / m * 2,
        sum(map(str.isdigit, line)) / n * 5, min(3.0, mean / 6), ends / m * 2, len(set(words)) / m,
        sum("|" in w for w in words) / m * 3, float(line[-1:].isalnum()), float("http" in line or "www." in line),
        float(not words),
    ]


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with those of its neighbours and a bias, and the lines' lengths.

    Null and empty texts are one empty line.
    """
    lines = (text or "").split("\n")
    seen: dict[str, list[float]] = {}
    own = np.array([seen.get(x) or seen.setdefault(x, line_features(x)) for x in lines])
    ahead = np.vstack([own[1:], own[-1:]])
    before = np.vstack([own[:1], own[:-1]])
    lengths = np.array([len(x) + 1.0 for x in lines])
    return np.hstack([own, before, ahead, np.ones((len(lines), 1))]), lengths


def marginals(scores: np.ndarray, mask: np.ndarray, trans: np.ndarray):
    """Forward-backward over padded documents: node and edge marginals, log partition.

    ``scores``: documents x lines, the log odds of good; ``mask``: real lines.
    """
    b, t = scores.shape
    node = np.stack([np.zeros_like(scores), scores], -1)
    fwd, bwd = np.empty((b, t, 2)), np.zeros((b, t, 2))
    fwd[:, 0] = node[:, 0]
    for i in range(1, t):
        nxt = np.logaddexp.reduce(fwd[:, i - 1, :, None] + trans, axis=1) + node[:, i]
        fwd[:, i] = np.where(mask[:, i, None], nxt, fwd[:, i - 1])
    for i in range(t - 2, -1, -1):
        prev = np.logaddexp.reduce(trans + (node[:, i + 1] + bwd[:, i + 1])[:, None, :], axis=2)
        bwd[:, i] = np.where(mask[:, i + 1, None], prev, bwd[:, i + 1])
    log_z = np.logaddexp.reduce(fwd[:, -1], axis=1)
    good = np.exp(np.minimum(0.0, fwd[..., 1] + bwd[..., 1] - log_z[:, None]))
    pair = fwd[:, :-1, :, None] + trans + (node[:, 1:] + bwd[:, 1:])[:, :, None, :] - log_z[:, None, None, None]
    return good, np.exp(np.minimum(0.0, pair)) * mask[:, 1:, None, None], log_z


def padded(parts: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(p) for p in parts)
    scores, mask = np.zeros((len(parts), t)), np.zeros((len(parts), t), bool)
    for k, p in enumerate(parts):
        scores[k, : len(p)], mask[k, : len(p)] = p @ weight, True
    return scores, mask


def fit(parts: list[np.ndarray], labels: list[int], rounds: int = 60, rate: float = 0.1, ridge: float = 0.01):
    """Weights and transitions that maximise the likelihood of all lines bearing their document's label.

    Long documents are cut into windows of 32 lines, all of them used. Classes
    weigh alike. Without both classes the weights are zero: every score is 0.5.
    """
    if not parts or len(set(labels)) < 2:
        return np.zeros(parts[0].shape[1] if parts else 3 * BASIC + 1), np.zeros((2, 2))
    cut = [(p[i : i + 32], y) for p, y in zip(parts, labels) for i in range(0, len(p), 32)]
    groups: dict[int, list] = {}
    for p, y in cut:
        groups.setdefault(1 << (len(p) - 1).bit_length(), []).append((p, y))
    counts = [sum(len(p) for p, c in cut if c == k) for k in (0, 1)]
    batches = []
    for size, items in sorted(groups.items()):
        x, mask = np.zeros((len(items), size, parts[0].shape[1])), np.zeros((len(items), size), bool)
        for k, (p, _) in enumerate(items):
            x[k, : len(p)], mask[k, : len(p)] = p, True
        y = np.array([c for _, c in items])
        batches.append((x, mask, y, 0.5 / np.array(counts)[y]))
    weight, trans = np.zeros(parts[0].shape[1]), np.zeros((2, 2))
    state = [np.zeros_like(weight), np.zeros_like(weight), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, rounds + 1):
        g_w, g_t = -ridge * 0.01 * weight, -ridge * trans
        for x, mask, y, share in batches:
            good, pair, _ = marginals(x @ weight, mask, trans)
            g_w = g_w + np.einsum("bt,btf->f", (y[:, None] - good) * mask * share[:, None], x)
            seen = np.zeros((len(y), 2, 2))
            seen[np.arange(len(y)), y, y] = mask[:, 1:].sum(1)
            g_t = g_t + ((seen - pair.sum(1)) * share[:, None, None]).sum(0)
        for at, (value, grad) in enumerate(((weight, g_w), (trans, g_t))):
            m, v = state[2 * at], state[2 * at + 1]
            m[:] = 0.9 * m + 0.1 * grad
            v[:] = 0.99 * v + 0.01 * grad**2
            value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weight, trans


def held_out(doc_id) -> F.Column:
    """Rows never learned from: crc32 of the id as text leaves 2 on division by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS):
    """Fit on at most ``sample`` labelled documents of each class, drawn by a hash of the id.

    Whole documents are read; their features are computed in tasks.
    """
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y")).where(
        F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    drawn = [marked.where(F.col("_y") == y).distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (0, 1)]
    chosen = drawn[0].unionAll(drawn[1])

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [document_features(t)[0].astype("float32") for t in b["text"]]
            yield pd.DataFrame({"id": b["_id"], "y": b["_y"], "x": [p.tobytes() for p in parts]})

    rows = (docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
            .select("_id", "_y", "text").mapInPandas(features, "id long, y int, x binary").toPandas())
    rows = rows.sort_values(["id", "y", "x"])
    width = 3 * BASIC + 1
    return fit([np.frombuffer(x, "float32").reshape(-1, width).astype(float) for x in rows["x"]], list(rows["y"]))


def score_batch(texts: pd.Series, weight: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals of good over all lines of each text."""
    out = np.empty(len(texts))
    held = [document_features(t) for t in texts]
    order = sorted(range(len(held)), key=lambda k: len(held[k][1]))
    for group in (order[i : i + 64] for i in range(0, len(order), 64)):
        scores, mask = padded([held[k][0] for k in group], weight)
        good, _, _ = marginals(scores, mask, trans)
        for k, g in zip(group, good):
            n = held[k][1]
            out[k] = float(np.clip((g[: len(n)] * n).sum() / n.sum(), 0.0, 1.0))
    return out


def classify(docs: DataFrame, model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; only the text is read. Columns with these names are replaced."""
    weight, trans = model

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(np.concatenate([np.empty(0), *[
                score_batch(t.iloc[i : i + 512], weight, trans) for i in range(0, len(t), 512)]]))

    out = docs.drop("score", "predicted").withColumn("score", score(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
