"""N-gram Jaccard join by token-combination prefixes, and the components of its links."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import BROADCAST_ROWS, Scratch, broadcast_within, durable  # noqa: F401

FREQUENT = 8  # a shingle that more sets than this are found to have is of the frequent class
KEYS_SENT = 1_000_000  # so many shingle hashes at most are broadcast, some 10 MB
FEW_COMPONENTS, FEW_SETS = 16, 32  # a key of more components or sets than this is paired by blocks
BLOCK = 1024  # sets of a block
BLOCK_BITS = 512  # bytes of parities that a set has in a block
KEYS_HELD, KEYS_COMPARED = 64, 512  # of a set, and of two blocks, to leave out pairs that are made elsewhere
LEAST_PERCENT = 73  # under about 70, sets could link without sharing a pair of frequent shingles
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


class WordCodes(dict):
    """Hashes of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


class Shingler:
    """Distinct 64-bit hashes of a text's word shingles, sorted."""

    def __init__(self, words: int) -> None:
        self.words, self.memo = words, WordCodes()

    def __call__(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
        if not parts:
            return np.empty(0, np.uint64)
        memo, k = self.memo, min(self.words, len(parts))
        if len(memo) > 500_000:
            memo.clear()
        codes = np.fromiter(map(memo.__getitem__, parts), np.uint64, len(parts))
        n = len(parts) - k + 1
        mixed = np.full(n, k, np.uint64)
        for j in range(k):
            mixed = (mixed ^ (codes[j : j + n] * np.uint64(MIX[j % 4] + 2 * (j // 4)))) * np.uint64(MIX[0])
            mixed ^= mixed >> np.uint64(29)
        mixed.sort()
        return mixed[np.append(True, mixed[1:] != mixed[:-1])]


def node_of(codes: np.ndarray) -> int:
    """One number for a set: equal sets are one node of the links."""
    return int.from_bytes(hashlib.blake2b(codes.tobytes(), digest_size=8).digest(), "big", signed=True)


def overlap_needed(n: np.ndarray | int, percent: int):
    """The least intersection of a set of ``n`` with any set it links to."""
    return -(-n * percent // 100)


def parity_bits(codes: np.ndarray) -> bytes:
    """One bit per cell, whether an odd number of shingles falls there; two to four cells a shingle."""
    cells = max(256, 1 << (2 * len(codes) - 1).bit_length())
    counts = np.bincount((codes & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """Shingles in one of two sets but not both: at least as many as cells of unlike parity.

    The larger table is folded upon itself, as if it had had fewer cells.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Parity tables (the last axis) of at most ``size`` bytes, as if they had had fewer cells."""
    while (half := bits.shape[-1] // 2) >= size:
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def apart_by_block(mine: list[bytes], theirs: list[bytes]) -> np.ndarray:
    """``least_apart`` of every two tables of two lists."""
    sizes = [np.fromiter(map(len, tables), np.int64, len(tables)) for tables in (mine, theirs)]
    out = np.empty((len(mine), len(theirs)), np.int32)
    for size in np.union1d(*sizes):
        at, bits = [], []
        for tables, has in zip((mine, theirs), sizes):
            at.append(np.flatnonzero(has >= size))
            rows = [folded(np.frombuffer(tables[i], np.uint8), size) for i in at[-1]]
            bits.append(np.unpackbits(np.array(rows, np.uint8).reshape(len(rows), size), axis=1).astype(np.float32))
        x, y = bits
        both = x.sum(1)[:, None] + y.sum(1) - 2 * (x @ y.T)  # whole numbers, exact
        out[np.ix_(*at)] = both  # pairs with a smaller table have theirs; larger ones overwrite it
    return out


def base_length(n: int, percent: int) -> int:
    """So many shingles, the first in any common order, hold one that is shared with any set it links to."""
    return n - overlap_needed(n, percent) + 1


def probe_length(n: int, percent: int) -> int:
    """Shingles that are looked at for frequent ones; as long as a third of them is not, the rest holds the prefix."""
    return base_length(n, percent) * 3 // 2 + 1


def unlike_at_most(n: int, percent: int) -> int:
    """The most shingles that a set of ``n`` and a set it links to can have in one of them only."""
    return n * (100 - percent) // percent


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n, node, bits, probe``: set size, hash and parities of the set, and its first shingles by hash, half as many again as a prefix has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, nodes, bits, probes = [], [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle(text)
                    sizes.append(len(s))
                    nodes.append(node_of(s) if len(s) else None)
                    bits.append(parity_bits(s) if len(s) else None)
                    probes.append(s[: probe_length(len(s), percent)].view(np.int64) if len(s) else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary()),
                     pa.array(probes, pa.list_(pa.int64()))], ["doc_id", "n", "node", "bits", "probe"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, node long, bits binary, probe array<long>")


def prefix_keys(s: np.ndarray, hot: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The rare shingles of a set's prefix, and hashes of neighbouring frequent ones if it reaches these.

    The order is rare before frequent, then by hash. If the first common shingle of linked sets is rare, it is a key of both. If it is frequent, all that they share
    is, and both have fewer rare shingles than the base is long. Extended to hold ``d + 2`` common shingles, where ``d`` bounds those
    of one set only, their frequent parts have a pair of common shingles with nothing between, in either.
    """
    base = base_length(len(s), percent)
    frequent = np.isin(s, hot, assume_unique=True)
    rare = s[~frequent]
    if len(rare) >= base:
        return rare[:base], s[:0]
    often = s[frequent][: base + unlike_at_most(len(s), percent) + 1 - len(rare)]
    pairs = ((often[:-1] * np.uint64(MIX[1])) ^ often[1:]) * np.uint64(MIX[2])
    return rare, pairs ^ (pairs >> np.uint64(31))


def whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """``node, n, shingles`` of the given ``node, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle(t).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                                 ["node", "n", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, n long, shingles array<long>")


def class_keys(sets: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """``node, n, rare, pairs``: the prefix keys of whole sets, of which ``hot`` (``node, hot``) lists the frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for s, known in zip(batch.column(2), batch.column(3)):
                shingles, frequent = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (s, known))
                keys.append([k.view(np.int64) for k in prefix_keys(shingles, frequent, percent)])
            lists = [pa.array([k[i] for k in keys], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], ["node", "n", "rare", "pairs"])

    joined = sets.join(hot, "node").select("node", "n", "shingles", "hot")
    return joined.mapInArrow(run, "node long, n long, rare array<long>, pairs array<long>")


def shared_only(index: DataFrame) -> DataFrame:
    """Postings whose key stands more than once."""
    return index.join(index.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select("key"), "key", "left_semi")


def in_prefix(placed: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """``key, node, n`` of those rare probe shingles (``key, node, n, pos``) before which fewer rare ones stand than the base is long.

    ``held`` lists the places (``node, hot``) of the frequent shingles, which are not among ``placed``.
    """
    before = F.when(F.col("hot").isNull(), 0).otherwise(F.size(F.filter("hot", lambda h: h < F.col("pos"))))
    base = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    return placed.join(held, "node", "left").where(F.col("pos") - before < base).select("key", "node", "n")


def rare_prefixes(scratch: Scratch, probes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``key, node, n`` of the rare shingles in the prefixes; the frequent shingles, where they stand, and the nodes whose probe is too short to tell the prefix."""
    placed = probes.select("node", "n", F.posexplode("probe").alias("pos", "key"))
    counts = scratch.put("counts", placed.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1"))
    met = scratch.put("met", placed.join(counts, "key"))
    hot = scratch.put("hot", counts.where(F.col("sets") > FREQUENT).select("key"))
    held = scratch.put("held", met.where(F.col("sets") > FREQUENT).groupBy("node").agg(F.first("n").alias("n"), F.collect_list("pos").alias("hot")))  # of one probe
    base = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    deep = scratch.put("deep", held.where(F.least("n", F.floor(base * 3 / 2) + 1) - F.size("hot") < base).select("node"))
    held = held.select("node", "hot")
    rare = met.where(F.col("sets") <= FREQUENT).join(deep, "node", "left_anti")
    rare = scratch.put("rare", in_prefix(rare.select("key", "node", "n", "pos"), held, percent))
    scratch.drop("counts", "met")
    return rare, hot, held, deep


def deep_keys(scratch: Scratch, texts: DataFrame, probes: DataFrame, hot: DataFrame, held: DataFrame, deep: DataFrame,
              words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Postings of the sets that have mostly frequent shingles, with what else they meet: rare ones, and pairs of frequent ones.

    All shingles of these sets are counted. One that more than ``FREQUENT`` of them have is frequent too, unless it stands in the prefix
    of another set as a rare one.
    """
    sets = scratch.put("sets", whole_sets(texts, words))
    each = sets.select("node", "n", F.explode("shingles").alias("key"))
    counts = scratch.put("counts", each.groupBy("key").agg(F.count("*").alias("sets")))
    placed = probes.select("node", "n", F.posexplode("probe").alias("pos", "key"))
    new = broadcast_within(scratch.put("new", counts.select("key").join(hot, "key", "left_anti")), KEYS_SENT)
    met = placed.join(new, "key", "left_semi").join(deep, "node", "left_anti")
    late = scratch.put("late", in_prefix(met, held, percent))
    more = counts.where(F.col("sets") > FREQUENT).select("key").join(late.select("key"), "key", "left_anti")
    frequent = scratch.put("frequent", hot.unionAll(more).distinct())
    lists = each.join(frequent, "key", "left_semi").groupBy("node").agg(F.collect_list("key").alias("hot"))  # of one set
    keys = scratch.put("keys", class_keys(sets, lists, percent))
    rare = keys.select(F.explode("rare").alias("key"), "node", "n").unionAll(late)
    pairs = keys.select(F.explode("pairs").alias("key"), "node", "n")
    return rare, pairs


def pivot_pairs(index: DataFrame, comp: DataFrame, salt: int, percent: int) -> DataFrame:
    """``member, pivot``: for each key its sets with one of them, where the two are in different components."""
    placed = index.join(comp, "node")
    pivots = placed.groupBy("key").agg(
        F.min(F.struct(F.xxhash64(F.lit(salt), "node").alias("h"), "node", "n", "comp")).alias("p"))
    pairs = placed.select("key", F.col("node").alias("member"), F.col("n").alias("na"), "comp").join(
        pivots.select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("nb"), F.col("p.comp").alias("far")), "key")
    return pairs.where((F.col("comp") != F.col("far")) & within(percent)).select("member", "pivot").distinct()


def crossing_pairs(scratch: Scratch, index: DataFrame, comp: DataFrame, percent: int, sketches: DataFrame | None = None) -> DataFrame:
    """``member, pivot``: all pairs of a key between two components; components are paired first, so none is paired with itself.

    Sets that share a key of many sets mostly share many such keys. They are paired block by block, at the first of
    these keys that both have, so that a pair is not made once for each. With ``sketches`` (``node, bits``) the pairs
    that parities rule out are left out there, before they are rows.
    """
    placed = scratch.put("placed", index.join(comp, "node").select("key", "node", "n", "comp"))
    held = scratch.put("key_comps", placed.groupBy("key", "comp").agg(F.count("*").alias("sets")))
    spread = held.groupBy("key").agg(F.count("*").alias("comps"), F.sum("sets").alias("all_sets"),
                                     F.sum(F.when(F.col("sets") <= BLOCK, F.col("sets")).otherwise(0)).alias("small"))
    spread = scratch.put("spread", spread.where("comps > 1"))
    by_join = (F.col("comps") <= FEW_COMPONENTS) & (F.col("all_sets") <= FEW_SETS)
    few, many = spread.where(by_join).select("key"), spread.where(~by_join).select("key", "small")
    some = held.join(few, "key").select("key", "comp")
    met = some.join(some.select("key", F.col("comp").alias("far")), "key").where("comp < far")
    left = placed.select("key", "comp", F.col("node").alias("member"), F.col("n").alias("na")).join(met, ["key", "comp"])
    right = placed.select("key", F.col("comp").alias("far"), F.col("node").alias("pivot"), F.col("n").alias("nb"))
    pairs = left.join(right, ["key", "far"]).where(within(percent)).select("member", "pivot")
    return pairs.unionAll(block_pairs(scratch, placed, held, many, percent, sketches)).distinct()


def short_parities(sketches: DataFrame) -> DataFrame:
    """``node, bits`` with tables of at most ``BLOCK_BITS`` bytes, which bound the difference of sets too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [folded(np.frombuffer(b, np.uint8), BLOCK_BITS).tobytes() for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["node", "bits"])

    return sketches.select("node", "bits").mapInArrow(run, "node long, bits binary")


def block_pairs(scratch: Scratch, placed: DataFrame, held: DataFrame, keys: DataFrame, percent: int, sketches: DataFrame | None = None) -> DataFrame:
    """``member, pivot`` of ``placed`` under ``keys``: pairs of unlike components and of sizes that can link, those that parities rule out left out.

    The sets of a key are cut into blocks of some ``BLOCK``: a component larger than that has blocks of its own, which are not paired with
    one another; the others share blocks, each whole in one. A pair is left out where both sets have a smaller one of the
    keys, as far as their ``KEYS_HELD`` smallest show; at the first key they share they never do.
    """
    rows = placed.join(keys, "key").join(held.select("key", "comp", "sets"), ["key", "comp"])
    pieces = F.ceil(F.when(F.col("sets") > BLOCK, F.col("sets")).otherwise(F.col("small")) / BLOCK)
    large = F.when(F.col("sets") > BLOCK, F.col("comp"))
    slot = F.pmod(F.when(large.isNull(), F.xxhash64("comp")).otherwise(F.xxhash64("node")), pieces)
    rows = scratch.put("blocks", rows.select("key", "node", "n", "comp", large.alias("large"), F.xxhash64(F.coalesce(large, F.lit(0)), slot).alias("block")))
    firsts = scratch.put("first_keys", rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("key")), 1, KEYS_HELD).alias("keys")))  # of one set
    if sketches is not None:
        firsts = scratch.put("block_sets", firsts.join(short_parities(sketches.join(firsts.select("node"), "node", "left_semi")), "node"))
    blocks = scratch.put("block_list", rows.select("key", "block", "large").distinct())
    other = blocks.select("key", F.col("block").alias("b"), F.col("large").alias("far_large"))
    grid = blocks.withColumnRenamed("block", "a").join(other, "key").where("a <= b and (large is null or far_large is null or large != far_large)")
    grid = scratch.put("grid", grid.select("key", "a", "b"))
    ends = grid.select("key", "a", "b", F.col("a").alias("block")).unionAll(grid.where("a < b").select("key", "a", "b", F.col("b").alias("block")))
    wide = rows.select("key", "block", "node", "n", "comp").join(firsts, "node").join(ends, ["key", "block"])
    bounded = sketches is not None

    def pair(table: pa.Table) -> pa.Table:
        key, first, last = (table.column(c)[0].as_py() for c in ("key", "a", "b"))
        block, node, n, comp = (table.column(c).to_numpy() for c in ("block", "node", "n", "comp"))
        lists = table.column("keys").combine_chunks()
        row = np.repeat(np.arange(len(node)), lists.value_lengths().to_numpy(zero_copy_only=False))
        value = lists.flatten().to_numpy(zero_copy_only=False)
        row, value = row[value < key], value[value < key]
        known, place, often = np.unique(value, return_inverse=True, return_counts=True)
        column = np.full(len(known), -1)
        column[np.argsort(-often, kind="stable")[:KEYS_COMPARED]] = np.arange(min(len(known), KEYS_COMPARED))
        row, column = row[column[place] >= 0], column[place][column[place] >= 0]
        has = np.zeros((len(node), min(len(known), KEYS_COMPARED)), np.float32)
        has[row, column] = 1
        x, y = np.flatnonzero(block == first), np.flatnonzero(block == last)
        new = (has[x] @ has[y].T) == 0
        new &= comp[x][:, None] < comp[y] if first == last else comp[x][:, None] != comp[y]
        new &= (n[x][:, None] * 100 >= n[y] * percent) & (n[y] * 100 >= n[x][:, None] * percent)
        if bounded and new.any():
            x, y = x[new.any(1)], y[new.any(0)]
            new = new[new.any(1)][:, new.any(0)]
            bits = table.column("bits").to_pylist()
            apart = apart_by_block([bits[i] for i in x], [bits[j] for j in y])
            new &= apart * (100 + percent) <= (n[x][:, None] + n[y]) * (100 - percent)
        i, j = np.nonzero(new)
        return pa.table({"member": node[x[i]], "pivot": node[y[j]]})

    return wide.groupBy("key", "a", "b").applyInArrow(pair, "member long, pivot long")


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``member, pivot``) that the parities of their sets do not rule out.

    A lower bound of the difference is compared, so no pair that links is lost;
    most pairs that merely share a passage go before any text is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = [least_apart(a, b) * (100 + percent) <= (na + nb) * (100 - percent) for na, a, nb, b in zip(*cols)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["member", "pivot"]).filter(pa.array(keep, pa.bool_()))

    left = sketches.select(F.col("node").alias("member"), F.col("n").alias("na"), F.col("bits").alias("mine"))
    right = sketches.select(F.col("node").alias("pivot"), F.col("n").alias("nb"), F.col("bits").alias("theirs"))
    met = pairs.join(left, "member").join(right, "pivot").select("member", "pivot", "na", "mine", "nb", "theirs")
    return met.mapInArrow(run, "member long, pivot long")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (``member, pivot``) that link by their whole sets, as ``a, b``.

    Texts are smaller than their sets, so texts travel and sets are made again.
    The member's text comes first: a pivot's is then met where its rows are, not sent with each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, held, of = Shingler(words), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keep = []
                for pivot, mine, theirs in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3)):
                    if of != pivot:
                        held, of = shingle(theirs.as_py()), pivot
                    own = shingle(mine)
                    both = len(np.intersect1d(own, held, assume_unique=True))
                    keep.append(100 * both >= percent * (len(own) + len(held) - both))
                yield pa.RecordBatch.from_arrays(part.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("node").alias("member"), F.col("text").alias("mine"))
    right = texts.select(F.col("node").alias("pivot"), F.col("text").alias("theirs"))
    met = pairs.join(left, "member").join(right, "pivot").select("member", "pivot", "mine", "theirs")
    return met.mapInArrow(run, "a long, b long")


def components(scratch: Scratch, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, comp``, written as ``comp``: the smallest node reachable; labels fall to the smallest neighbour's, then jump.

    Labels, one for each end of a link, are sent to the links while they are few, and shuffled with them beyond that.
    """
    if links.isEmpty():
        return scratch.put("comp", nodes.select("node", F.col("node").alias("comp")))
    both = scratch.put("both", links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = scratch.put("label", both.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node")))
    few = label.count() <= BROADCAST_ROWS
    changed = True
    while changed:
        sent = F.broadcast(label) if few else label
        near = both.join(sent.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        low = near.join(sent, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("mid"))
        jump = sent.select(F.col("node").alias("mid"), F.col("comp").alias("far"))
        new = scratch.put("label", low.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("comp")))
        changed = not new.where("old != comp").isEmpty()
        label = new.select("node", "comp")
    label = F.broadcast(label) if few else label
    comp = scratch.put("comp", nodes.join(label, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")))
    scratch.drop("both", "label")
    return comp


def own_texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, text``: for each wanted ``first, node`` (written) the text of document ``first`` that has this set.

    Texts are moved only if more are wanted than can be sent to where they lie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            keep = [node_of(shingle(t)) == n for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = docs.select("doc_id", "text").join(broadcast_within(wanted.withColumnRenamed("first", "doc_id")), "doc_id").select("node", "text")
    return rows.mapInArrow(run, "node long, text string").dropDuplicates(["node"])


def within(percent: int) -> Column:
    """Sizes that can link at all."""
    return (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)


def linked_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; exact.

    Equal sets fall together first. Shingles of more than ``FREQUENT`` sets are of the frequent class and come last in the prefixes;
    rare ones are keys singly, frequent ones by pairs. One pivot per
    key, twice with other pivots, joins most of a near-copy group. Every
    further pair of a key whose ends are in different components is
    checked, first by a bound on parities, then by its texts, so no link between components is missed, and no group of copies is
    expanded into its pairs. Null and empty texts have an empty set and stay alone, as do
    null ids (null component). Rows that repeat an id with another text share the
    smallest component of its texts; rows come back once each. A ``percent`` under 73 is refused.
    Written intermediates are deleted as soon as nothing reads them any more.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent must be at least {LEAST_PERCENT}, not {percent}")
    with Scratch(docs.sparkSession) as scratch:
        sets = scratch.put("signatures", signatures(docs, words, percent))
        all_rows = scratch.put("rows", sets.select("doc_id", "n", "node"))
        known = all_rows.where("n > 0 and doc_id is not null")
        firsts = scratch.put("firsts", known.groupBy("node").agg(F.min("doc_id").alias("first")))
        nodes = firsts.select("node")
        wide = sets.where("n > 0 and doc_id is not null").join(firsts, "node").where("doc_id = first")
        probes = scratch.put("probes", wide.select("node", "n", "bits", "probe").dropDuplicates(["node"]))
        scratch.drop("signatures")
        sketches, probes = probes.select("node", "n", "bits"), probes.select("node", "n", "probe")
        # Linked sets share a shingle of their probes; what first meets in other classes does not link.
        rare, hot, held, deep = rare_prefixes(scratch, probes, percent)
        index = rare
        if not deep.isEmpty():
            texts = scratch.put("texts", own_texts(docs, scratch.put("ends", firsts.join(deep, "node", "left_semi")), words))
            more, pairs = deep_keys(scratch, texts, probes, hot, held, deep, words, percent)
            index = rare.unionAll(more).distinct().unionAll(pairs)
        index = scratch.put("index", shared_only(index))
        scratch.drop("rare", "hot", "held", "deep", "texts", "sets", "counts", "new", "late", "frequent", "keys")
        # Sets that share an id are linked by it: rows may repeat an id with another text.
        several = known.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
        links = scratch.put("links", known.select("doc_id", "node").join(several, "doc_id").where("node != low")
                            .select(F.col("node").alias("a"), F.col("low").alias("b")).distinct())
        comp = components(scratch, nodes, links)

        def linked(pairs: DataFrame) -> None:
            nonlocal links, comp
            pairs = scratch.put("pairs", possible(pairs, sketches, percent))
            if not pairs.isEmpty():
                ends = pairs.select(F.explode(F.array("member", "pivot")).alias("node")).distinct()
                texts = scratch.put("texts", own_texts(docs, scratch.put("ends", firsts.join(ends, "node", "left_semi")), words))
                links = scratch.put("links", links.unionAll(verified(pairs, texts, words, percent)))
                comp = components(scratch, nodes, links)
            scratch.drop("pairs", "ends", "texts")

        for salt in (1, 2):
            linked(pivot_pairs(index, comp, salt, percent))
        linked(crossing_pairs(scratch, index, comp, percent, sketches))
        scratch.drop("index", "placed", "key_comps", "spread", "blocks", "first_keys", "block_sets", "block_list", "grid", "probes", "links")
        smallest = comp.join(firsts, "node").groupBy("comp").agg(F.min("first").alias("component_id"))
        of_node = comp.join(smallest, "comp").select(F.col("node").alias("_node"), "component_id")
        rows = all_rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
        out = rows.join(of_node, F.col("node") == F.col("_node"), "left")
        out = scratch.put("out", out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
        scratch.keep("out")
        return out


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; empty texts and null ids stay, and all rows that repeat a kept id."""
    gone = linked_components(docs, words, percent).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_jaccard(spark, sf_dir: str) -> DataFrame:
    return linked_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
