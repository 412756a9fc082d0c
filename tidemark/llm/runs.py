"""Periodic runs of words: internal pattern matching of dyadic blocks over a suffix array."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_WORDS = 1 << 16  # texts are searched together until they hold so many words
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_SQL = "struct<start: bigint, length: bigint, period: bigint>"


class RangeSuccessor:
    """A wavelet tree over a permutation: the least value from ``x`` on within a range of places."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.append(0, np.cumsum(low)).astype(np.int32))
            values = np.concatenate([values[low], values[~low]])

    def _step(self, zeros: np.ndarray, lo: np.ndarray, hi: np.ndarray, one: np.ndarray) -> tuple:
        """The ranges in the child for bit 0 or, where ``one``, for bit 1; and the zeros of the ranges."""
        a, b = zeros[lo], zeros[hi]
        return np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b), b - a

    def __call__(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """For each range ``lo <= place < hi`` the least value of at least ``x``; -1 if there is none."""
        below, a, b = np.zeros(len(lo), np.int64), lo, hi
        for level, zeros in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            a, b, n = self._step(zeros, a, b, one)
            below += np.where(one, n, 0)
        there = (below < hi - lo) & (x < 1 << self.bits)
        a, b, k, value = lo[there], hi[there], below[there], np.zeros(int(there.sum()), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = k >= zeros[b] - zeros[a]
            a, b, n = self._step(zeros, a, b, one)
            k = np.where(one, k - n, k)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
        out = np.full(len(lo), -1, np.int64)
        out[there] = value
        return out


class Factors:
    """Suffix order of a sequence by doubling, with the classes of all factors of 2**k symbols on the way.

    ``ranks[k][i]`` is the first place in the suffix order of those suffixes that share their first
    2**k symbols with suffix ``i``. Only suffixes that are not alone yet are sorted further.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        slots, key = np.arange(n), symbols[order]
        rank = np.zeros(n, np.int32)
        self.ranks: list[np.ndarray] = []
        self.blocks: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        at, length = order, 1
        first = np.append(True, key[1:] != key[:-1])
        while True:
            heads = np.flatnonzero(first)
            sizes = np.diff(np.append(heads, len(slots)))
            begin = np.repeat(slots[heads], sizes)
            rank = rank.copy()
            rank[at] = begin
            self.ranks.append(np.append(rank, np.int32(-1)))  # no suffix is like the one after the last
            sizes = np.repeat(sizes, sizes)
            shared = sizes > 1
            slots, at, begin, sizes = slots[shared], at[shared], begin[shared], sizes[shared]
            if not len(at):
                break
            if length > 1:
                aligned = at % length == 0
                self.blocks.append((length, at[aligned], begin[aligned].astype(np.int64), sizes[aligned]))
            ahead = at + length
            ahead = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
            by = np.lexsort((ahead, begin))
            at, begin, ahead = at[by], begin[by], ahead[by]
            order[slots] = at
            first = np.append(True, (begin[1:] != begin[:-1]) | (ahead[1:] != ahead[:-1]))
            length *= 2
        self.order = order

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` on equal those from ``j`` on."""
        i, j, from_ = i.copy(), j.copy(), i
        for k in range(len(self.ranks) - 1, -1, -1):
            same = self.ranks[k][i] == self.ranks[k][j]
            i[same] += 1 << k
            j[same] += 1 << k
        return i - from_

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before ``i`` equal those before ``j``; ``i < j``."""
        i, j, from_ = i.copy(), j.copy(), i
        for k in range(len(self.ranks) - 1, -1, -1):
            back = np.maximum(i - (1 << k), 0)
            same = (i >= 1 << k) & (self.ranks[k][back] == self.ranks[k][np.maximum(j - (1 << k), 0)])
            i[same] -= 1 << k
            j[same] -= 1 << k
        return from_ - i


def runs_of(symbols: np.ndarray) -> np.ndarray:
    """All runs as rows ``start, length, period``, by start, then period.

    A run is a longest stretch with smallest period ``q`` and at least ``max(6, 4 * q)`` symbols. For
    some power of two ``m`` with (2m - 1) / 3 <= q < (4m - 1) / 3 it holds a block of ``m`` symbols that
    begins at a multiple of ``m``, and the same block ``q`` later. So each block asks for its occurrences
    in that window, which is shorter than the block: they form one arithmetic progression. One or two of them are
    periods to be tried. Three or more mean that the block has the progression's
    difference as period; then the stretches of that period around the block and around its first occurrence must end ``q`` apart.
    Whatever is tried is extended both ways, exactly.
    """
    none = np.empty((0, 3), np.int64)
    if len(symbols) < 6:
        return none
    factors = Factors(symbols)
    if not factors.blocks:
        return none
    successor = RangeSuccessor(factors.order.astype(np.int64))
    starts, periods = [], []
    for m, s, lo, sizes in factors.blocks:
        s, hi = s.astype(np.int64), lo + sizes
        upto = s + (4 * m - 1 + 2) // 3
        one = successor(lo, hi, s + (2 * m - 1 + 2) // 3)
        met = (one >= 0) & (one < upto)
        s, lo, hi, upto, one = s[met], lo[met], hi[met], upto[met], one[met]
        two = successor(lo, hi, one + 1)
        more = (two >= 0) & (two < upto)
        three = np.full(len(s), -1, np.int64)
        three[more] = successor(lo[more], hi[more], two[more] + 1)
        many = (three >= 0) & (three < upto)
        few = ~many
        starts += [s[few], s[more & few]]
        periods += [one[few] - s[few], two[more & few] - s[more & few]]
        s, one, step = s[many], one[many], two[many] - one[many]
        q = one + factors.forward(one, one + step) - s - factors.forward(s, s + step)
        starts.append(s[q > 0])
        periods.append(q[q > 0])
    s, q = np.concatenate(starts), np.concatenate(periods)
    begin = s - factors.backward(s, s + q)
    length = s + q + factors.forward(s, s + q) - begin
    long = length >= np.maximum(6, 4 * q)
    found = np.stack([begin, length, q], 1)[long]
    # A stretch found with several periods is the run of the smallest.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):
        found = found[np.append(True, (found[1:, :2] != found[:-1, :2]).any(1))]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length by period, compared exactly; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words without those that repeat within a run, joined by one space."""
    if not len(runs):
        return b" ".join(words).decode()
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, np.cumsum(edge[:-1]) == 0)).decode()


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed``: the periodic runs of every whole text, words being split at ASCII white space.

    ``runs`` holds ``start, length, period`` in words by start, then period; ``best`` is the one of greatest
    length by period, null without runs; ``collapsed`` keeps of every run its first period. Null and empty texts have no words, no runs and an
    empty ``collapsed``. Rows come back once each, repeated and equal ones alike; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                words, symbols, total, end = [], [], 0, at
                while end < batch.num_rows and total < BATCH_WORDS:
                    own: dict[bytes, int] = {}
                    words.append((texts[end].as_py() or "").encode().split())  # of bytes: at ASCII white space only
                    # No symbol stands in two texts, so nothing is alike across them.
                    symbols += [own.setdefault(w, total + len(own)) for w in words[-1]]
                    total, end = total + len(words[-1]), end + 1
                found = runs_of(np.array(symbols, np.int64))
                edges = np.cumsum([0] + [len(w) for w in words])
                cuts = np.searchsorted(found[:, 0], edges)
                lists, best, kept = [], [], []
                for d, w in enumerate(words):
                    part = found[cuts[d] : cuts[d + 1]] - (edges[d], 0, 0)
                    rows = list(map(tuple, part.tolist()))
                    top = strongest(rows)
                    names = ("start", "length", "period")
                    lists.append([dict(zip(names, r)) for r in rows])
                    best.append(dict(zip(names, top)) if top else None)
                    kept.append(collapsed(w, part))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, end - at), pa.array([len(w) for w in words], pa.int64()), pa.array(lists, pa.list_(RUN)),
                     pa.array(best, RUN), pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "best", "collapsed"])
                at = end

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<{RUN_SQL}>, best {RUN_SQL}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where every tenth text, by the hash of its id, goes on in a period from some word on.

    A null id or text stays as it is.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("_words").cast("long"), F.floor(F.col("_seed") / 10)
    rows = docs.select("doc_id", "text", seed.alias("_seed"))
    rows = rows.withColumn("_words", F.when((F.col("_seed") % 10 == 0) & F.col("text").isNotNull(), words))
    rows = rows.withColumn("_from", F.when(n > 0, g % n))
    rows = rows.withColumn("_period", 1 + F.floor((n - F.col("_from")) / (3 + g % 8)))

    def place(i: Column) -> Column:
        return F.when(i < F.col("_from"), i).otherwise(F.col("_from") + (i - F.col("_from")) % F.col("_period"))

    turned = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("_words", place(i).cast("int")))
    text = F.when(F.col("_from").isNull(), F.col("text")).otherwise(F.array_join(turned, " "))
    return rows.select("doc_id", text.alias("text"))


def op13_runs(spark, sf_dir: str) -> DataFrame:
    rows = find_runs(with_planted_runs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = {c: F.col(f"best.{c}") for c in ("start", "length", "period")}
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[v.alias(c) for c, v in best.items()],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
