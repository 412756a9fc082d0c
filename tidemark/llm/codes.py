"""Vector code compression: product codebooks in whole numbers, with pivot bounds on the distances (LAESA)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 8, 16, 6, 4096, 4
LARGEST = 1 << 27  # sums of squared differences of larger components might not fit a long
SLACK = 1e-6  # of both distances: pivot distances are kept in single precision


def pivots_of(entries: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the entries of one part, each farthest from those before it."""
    chosen = [0]
    apart = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < most and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen + chosen[:1] * (most - len(chosen))]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row the nearest entry (the lower index of equals), its squared distance, and how many distances were evaluated.

    A pivot's distances to row and entry differ by no more than row and entry are apart. Entries are
    evaluated in the order of that bound, and only while it does not exceed the best distance found.
    """
    between = np.sqrt(((pivots[:, None] - entries[None]) ** 2).sum(2).astype(float))
    low = np.zeros((len(x), len(entries)))
    for p in range(len(pivots)):
        own = to_pivots[:, p, None].astype(float)
        np.maximum(low, np.abs(own - between[p]) - SLACK * (own + between[p]), out=low)
    low = low * low * (1 - 1e-9)
    order = np.argsort(low, axis=1, kind="stable")
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    alive, evaluated = np.arange(len(x)), 0
    for turn in range(len(entries)):
        entry = order[alive, turn]
        open_ = low[alive, entry] <= best[alive]
        alive, entry = alive[open_], entry[open_]
        if not len(alive):
            break
        apart = ((x[alive] - entries[entry]) ** 2).sum(1)
        evaluated += len(alive)
        nearer = (apart < best[alive]) | ((apart == best[alive]) & (entry < at[alive]))
        best[alive[nearer]], at[alive[nearer]] = apart[nearer], entry[nearer]
    return at, best, evaluated


def whole_rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Coder:
    """Assigns the rows of Arrow batches (``v`` whole components, ``far`` pivot distances) to given codebooks."""

    def __init__(self, books: np.ndarray, pivots: np.ndarray) -> None:
        self.books, self.pivots = books, pivots
        self.parts, _, self.width = books.shape

    def __call__(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part: the rows' components, their entries and squared distances."""
        v = whole_rows(batch.column("v"), self.parts * self.width).astype(np.int64).reshape(-1, self.parts, self.width)
        far = whole_rows(batch.column("far"), self.parts * self.pivots.shape[1]).reshape(-1, self.parts, self.pivots.shape[1])
        for part in range(self.parts):
            x = v[:, part]
            yield x, *nearest(x, far[:, part], self.books[part], self.pivots[part])[:2]


def kept_rows(vectors: DataFrame, label: str | None) -> DataFrame:
    """``vec_id, label, v``: rows whose vector holds only finite components, as doubles."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.size("embedding") > 0).where(finite)
    own = F.col(label) if label else F.lit(None).cast("int")
    return rows.select("vec_id", own.alias("label"), F.col("embedding").cast("array<double>").alias("v"))


def integers(scale: int) -> Callable[[np.ndarray], np.ndarray]:
    def floored(v: np.ndarray) -> np.ndarray:
        whole = np.floor(v * scale)
        if len(whole) and np.abs(whole).max() >= LARGEST:
            raise ValueError(f"components must be under {LARGEST / scale:.0f}")
        return whole.astype(np.int64)

    return floored


def measured(rows: DataFrame, pivots: np.ndarray, dim: int, scale: int) -> DataFrame:
    """``vec_id, label, v, far``: whole components, and the distance of each part to its fixed pivots; computed once."""
    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    floored = integers(scale)
    parts, _, width = pivots.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = floored(whole_rows(batch.column("v"), dim))
            far = np.sqrt(((v.reshape(-1, parts, 1, width) - pivots[None]) ** 2).sum(3).astype(float)).astype(np.float32)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.size // max(1, len(v))) if len(v) else pa.array([], kind)
                     for m, kind in ((v.astype(np.int32), pa.list_(pa.int32())), (far.reshape(len(v), -1), pa.list_(pa.float32())))]
            lists = [x.cast(pa.list_(x.type.value_type)) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *lists], ["vec_id", "label", "v", "far"])

    return rows.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, v array<int>, far array<float>")


def next_books(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts assigned to it; unused entries stay.

    Each task sums what it assigns, so a row for each component of the codebooks leaves it.
    """
    coder = Coder(books, pivots)
    names = ["place", "total", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for part, (x, at, _) in enumerate(coder(batch)):
                np.add.at(totals[part], at, x)
                counts[part] += np.bincount(at, minlength=books.shape[1])
        spread = np.repeat(counts.ravel(), books.shape[2])
        used = np.flatnonzero(spread)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals.ravel()[used]), pa.array(spread[used])], names)

    sums = rows.select("v", "far").mapInArrow(run, "place long, total long, n long").groupBy("place")
    out = books.copy().ravel()
    for r in sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # as many as the codebooks have components
        out[r.place] = r.total // r.n
    return out.reshape(books.shape)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
              pivots: int = PIVOTS, label: str | None = None) -> tuple[DataFrame, np.ndarray, np.ndarray] | None:
    """The written rows, the final codebooks (parts, entries, width) and the pivots; None without rows that take part.

    Codebooks start as the parts of the first ``entries`` rows by ``vec_id`` (null last), then by vector; fewer rows give fewer
    entries. Vectors of another length than the first row's take no part.
    """
    rows = kept_rows(vectors, label)
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return None
    dim = len(first[0].v)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == dim)
    start = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = integers(scale)(np.array([r.v for r in start])).reshape(len(start), parts, dim // parts).swapaxes(0, 1).copy()
    fixed = np.stack([pivots_of(book, pivots) for book in books])
    written = durable(measured(rows, fixed, dim, scale))
    for _ in range(rounds):
        books = next_books(written, books, fixed)
    return written, books, fixed


def encoded(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` by the given codebooks; two hex digits a part."""
    coder = Coder(books, pivots)
    digits = np.array([f"{i:02x}" for i in range(books.shape[1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.full(batch.num_rows, "", "U1"), np.zeros(batch.num_rows, np.int64)
            for _, at, apart in coder(batch):
                code, error = np.char.add(code, digits[at]), error + apart
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code.tolist(), pa.string()), pa.array(error)],
                                             ["vec_id", "label", "code", "error"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return rows.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, label: str = "label", **options) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every row that takes part.

    Rows whose vector is null, empty or holds null or non-finite components take no part, nor do those of
    another length than the first row's. Repeated rows are rows each, and come out alike; a null id is the
    last in order. ``label_error`` sums ``error`` over equal labels, nulls together. Other columns are left out.
    Components of 32,768 or more (at the usual scale) are refused. An empty table gives no rows.
    """
    fitted = codebooks(vectors, label=label, **options)
    if fitted is None:
        rows = kept_rows(vectors, label)
        return rows.select("vec_id", "label", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")],
                           F.lit("").alias("codebooks_sha256"))
    rows, books, pivots = fitted
    out = durable(encoded(rows, books, pivots))
    totals = out.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = out.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return joined.withColumn("codebooks_sha256", F.lit(digest(books)))


def op11_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")
