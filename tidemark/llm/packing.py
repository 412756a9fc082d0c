"""Packing documents into training sequences of one length, balanced by attention cost."""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.durable import durable
from tidemark.llm.pieces import shipped

MODEL, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
CAPACITY = 2048
END = 1  # the id that closes a document
HIDDEN = 1024  # model width: attention adds tokens / (6 * HIDDEN) to the cost of a token
GROUP_TOKENS, GROUP_ROWS = 1 << 20, 1 << 16  # what one task packs together
STRETCH = 1000
# All but Latin, Cyrillic, kana, Han and the usual punctuation, whose classes have long been settled.
STRANGE = re.compile("[^\x00-\u024f\u0400-\u045f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]")
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


class Ids:
    """Ids of texts as little-endian 32-bit numbers.

    ``tokenizers`` says what they are. Most texts go through a faster encoder of the same vocabulary and pattern, which gives the same ids;
    not those with added tokens, with letters that not every version of Unicode has, or with a very long stretch
    without or of white space, for which it is slow.
    """

    def __init__(self, path: str, ranks: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def plain(self, text: str) -> bool:
        words = text.split()
        lengths = list(map(len, words))
        spaces = len(text) - sum(lengths) - len(words)
        return max(lengths, default=0) < STRETCH and spaces < STRETCH and not STRANGE.search(text) and not any(t in text for t in self.added)

    def __call__(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if self.plain(text) else self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def ids_of(path: str, ranks: str) -> Ids:
    return Ids(path, ranks)


def tokenized(docs: DataFrame, model: str, ranks: str, capacity: int, end: int, with_ids: bool) -> DataFrame:
    """``row, doc_id, doc_tokens, full, tail, whole``: checksums of the document's full pieces, the ids that are left, and those of the full pieces.

    ``whole`` is null unless ids are asked for. ``row`` numbers the rows of a task; write the frame before relying on it.
    """
    names = [shipped(docs.sparkSession, path) for path in (model, ranks)]
    close = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, size = ids_of(*map(SparkFiles.get, names)), 4 * capacity
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, full, tails, wholes = [], [], [], []
                for text in part.column(1):
                    data = ids(text.as_py() or "") + close
                    whole = len(data) // size * size
                    counts.append(len(data) // 4)
                    full.append([zlib.crc32(data[i : i + size]) for i in range(0, whole, size)])
                    tails.append(data[whole:])
                    wholes.append(data[:whole] if with_ids else None)
                rows = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [rows, part.column(0), pa.array(counts, pa.int64()), pa.array(full, pa.list_(pa.int64())),
                     pa.array(tails, pa.binary()), pa.array(wholes, pa.binary())],
                    ["row", "doc_id", "doc_tokens", "full", "tail", "whole"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, doc_tokens long, full array<long>, tail binary, whole binary")


def cost(tokens, hidden: int):
    """Of a piece, in units of a token's linear layers: attention grows with the square."""
    return tokens + tokens * tokens / (6.0 * hidden)


def rooms(total: int, capacity: int) -> list[int]:
    """Lengths of sequences that hold ``total`` tokens without padding: full ones, and a power of two for each bit of the rest."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def packed(lengths: np.ndarray, capacity: int, hidden: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``item, start, length, sequence, offset`` of the pieces that fill the ``rooms`` of all items.

    Items go in descending order, each to the sequence of lowest cost that still has room for all of it (the first of equals);
    where none has, the sequence of lowest cost takes what it has room for, and the rest goes on.
    """
    room = np.array(rooms(int(lengths.sum()), capacity), np.int64)
    used, load = np.zeros(len(room), np.int64), np.zeros(len(room))
    for item in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[item])
        while left:
            at = int(np.where(room >= left, load, np.inf).argmin())
            if room[at] < left:
                at = int(np.where(room > 0, load, np.inf).argmin())
            take = min(left, int(room[at]))
            yield int(item), start, take, at, int(used[at])
            room[at] -= take
            used[at] += take
            load[at] += cost(take, hidden)
            start, left = start + take, left - take


def pack(docs: DataFrame, model: str = MODEL, ranks: str = RANKS, capacity: int = CAPACITY, end: int = END, hidden: int = HIDDEN,
         group_tokens: int = GROUP_TOKENS, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row per piece; ``ids`` as well if asked for.

    A document's full pieces are sequences of their own. What is left of the documents is dealt into groups of about ``group_tokens`` by row,
    so no document, id or source weighs on one task, and packed group by group. No sequence is
    padded: a group's last tokens fill sequences of a power of two. A null or empty text is the closing id alone; each
    row is a document, repeated ones too. ``ids`` holds a piece's ids, 32 bits each, little-endian. Other columns
    are left out, and an empty table gives no rows.
    """
    rows = durable(tokenized(docs, model, ranks, capacity, end, with_ids))
    size = rows.agg(F.sum(F.octet_length("tail") / 4).alias("tokens"), F.count("*").alias("n")).first()
    groups = max(1, -(-int(size.tokens or 0) // group_tokens), -(-size.n // GROUP_ROWS))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        group = table.column("group")[0].as_py() << 32
        tails, full, wholes = (table.column(c).to_pylist() for c in ("tail", "full", "whole"))
        at, start, length, crc, sequence, offset, ids = [], [], [], [], [], [], []

        def put(i: int, s: int, n: int, check: int, seq: int, off: int, data: bytes | None) -> None:
            for column, value in zip((at, start, length, crc, sequence, offset, ids), (i, s, n, check, group + seq, off, data)):
                column.append(value)

        used = 0
        for i, checks in enumerate(full):
            for j, check in enumerate(checks):
                put(i, j * capacity, capacity, check, used, 0, wholes[i] and wholes[i][4 * j * capacity : 4 * (j + 1) * capacity])
                used += 1
        lengths = np.array([len(t) // 4 for t in tails], np.int64)
        for i, s, n, seq, off in packed(lengths, capacity, hidden):
            data = tails[i][4 * s : 4 * (s + n)]
            put(i, len(full[i]) * capacity + s, n, zlib.crc32(data), used + seq, off, data if with_ids else None)
        long = [pa.array(c, pa.int64()) for c in (start, length, crc, sequence, offset)]
        of = table.select(["doc_id", "doc_tokens"]).take(pa.array(at, pa.int64()))
        return pa.table([of.column("doc_id"), *long[:2], pa.array(ids, pa.binary()), long[2], of.column("doc_tokens"), *long[3:]],
                        names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    out = dealt.groupBy("group").applyInArrow(
        fill, f"doc_id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out if with_ids else out.drop("ids")


def op12_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
