"""Vector codes, packing and periodic runs: brute force, round trips, and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.compare import connect, duck_rows, spark_rows
from tests.llm.test_llm import ODD, frame
from tidemark.llm import codes, packing, runs
from tidemark.llm.queries import QUERIES, SQL

VECTORS = "vec_id long, embedding array<float>, label int"


# --- 11: codes


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_codes_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert spark_rows(QUERIES["op11_codes"](spark, folder)) == duck_rows(connect(folder), SQL["op11_codes"])


def plain_codes(rows, parts, entries, rounds, scale=4096):
    kept = [(i, label, [int(np.floor(scale * x)) for x in v]) for i, v, label in rows]
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def place(v, p):
        return min((apart(cut(v, p), e), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, _, v in kept:
                held.setdefault(place(v, p)[1], []).append(cut(v, p))
            for j, vs in held.items():
                books[p][j] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for i, label, v in kept:
        at = [place(v, p) for p in range(parts)]
        out.append((i, label, "".join(f"{j:02x}" for _, j in at), sum(d for d, _ in at)))
    totals = {}
    for _, label, _, e in out:
        totals[label] = totals.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[label], sha) for i, label, c, e in out), key=repr)


def test_codes_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.3, 2.0]) for _ in range(16)], rng.choice([1, 2, None])) for i in range(60)]
    rows += rows[:7] * 3 + [(None, [0.0] * 16, 1), (900, [7.0] * 16, 3)]
    bad = [(901, None, 1), (902, [], 1), (903, [float("nan")] * 16, 1), (904, [float("inf")] + [0.0] * 15, 1), (905, [None] + [0.0] * 15, 1), (906, [1.0], 1)]
    table = frame(spark, rows + bad, VECTORS).withColumn("far", F.lit(1)).withColumn("v", F.lit("x"))
    got = codes.compress(table, rounds=3, entries=5).drop("label")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_codes(rows, 8, 5, 3)


def test_codes_few_rows(spark):
    assert codes.compress(frame(spark, [], VECTORS)).count() == 0
    two = codes.compress(frame(spark, [(2, [1.0] * 8, None), (1, [0.0] * 8, None)], VECTORS)).orderBy("vec_id").collect()
    assert [(r.code, r.error, r.label_error) for r in two] == [("00" * 8, 0, 0), ("01" * 8, 0, 0)]
    with pytest.raises(ValueError):
        codes.compress(frame(spark, [(1, [0.0] * 9, 1)], VECTORS))
    with pytest.raises(Exception, match="components must be under"):
        codes.compress(frame(spark, [(1, [1e9] * 8, 1)], VECTORS))


def test_nearest_prunes_and_keeps_ties():
    rng = np.random.default_rng(3)
    entries = rng.integers(-4000, 4000, (16, 8))
    entries[9] = entries[2]
    x = np.concatenate([rng.integers(-4000, 4000, (500, 8)), entries, (entries[:8] + entries[8:]) // 2])
    pivots = codes.pivots_of(entries, 4)
    far = np.sqrt(((x[:, None] - pivots) ** 2).sum(2)).astype(np.float32)
    at, best, evaluated = codes.nearest(x, far, entries, pivots)
    full = ((x[:, None] - entries) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (best == full.min(1)).all() and evaluated < full.size


# --- 12: packing


TOKENIZER = Tokenizer.from_file(packing.MODEL)


def whole_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = ["", None, "one", " two  spaces \n\n\tand  more  \n", "a\x1c \x1f!? \x85 b", "it's we'll\n<|endoftext|> x<|endoftext|>", "日本語 ☃ é\r\n" * 30,
         "long " * 40_000, "word " * 2047, "word " * 2046, "same text here", "same text here", "x" * 5000]


def test_ids_are_those_of_the_tokenizer(spark):
    ids = packing.ids_of(packing.MODEL, packing.RANKS)
    rng = random.Random(8)
    mixed = ["".join(rng.choice(["a", "Ab", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "é", "'s", "12", "!?", "日", "<|endoftext|>"]) for _ in range(60)) for _ in range(300)]
    ranges = [(0, 0x250), (0x400, 0x460), (0x2010, 0x2028), (0x3041, 0x3097), (0x30A1, 0x30FB), (0x4E00, 0x9FA6)]
    anything = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(400)) for _ in range(200)]
    given = [r.text for r in spark.read.parquet(f"/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text in TEXTS + mixed + anything + given + ["ꟊ\U0001e900 a", " " * 5000 + "x" * 5000]:
        assert np.frombuffer(ids(text or ""), "<u4").tolist() == whole_ids(text)[:-1]
    assert sum(map(ids.plain, given)) > 0.9 * len(given)


def check_pieces(rows, texts, capacity=2048):
    """All ids once each, sequences gapless and without padding but at a power of two."""
    wanted = sorted(tuple(whole_ids(t)) for t in texts)
    got, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and len(ids) == r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        got.setdefault(r.doc_id, []).append((r.start, ids.tolist(), r.doc_tokens))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == capacity or end < capacity and end & (end - 1) == 0
    found = []
    for parts in got.values():
        flat = []
        for start, ids, n in sorted(parts):
            assert start == len(flat)
            flat += ids
        assert len(flat) == n
        found.append(tuple(flat))
    assert sorted(found) == wanted
    return sequences


def test_packing_pieces(spark):
    texts = TEXTS + [("w%d " % i) * (i % 90) for i in range(400)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).withColumn("row", F.lit(1)).withColumn("tail", F.lit("x"))
    sequences = check_pieces(packing.pack(docs).collect(), texts)
    tokens = sum(len(whole_ids(t)) for t in texts)
    assert len(sequences) <= tokens // 2048 + 11
    check_pieces(packing.pack(docs, group_tokens=4096).collect(), texts)
    assert spark_rows(packing.pack(docs)) == spark_rows(packing.pack(docs))


def test_packing_odd(spark):
    rows = packing.pack(frame(spark, ODD)).collect()
    assert sum(r.length for r in rows) == sum(len(whole_ids(r[1])) for r in ODD)
    assert packing.pack(frame(spark, [])).count() == 0
    assert len(packing.pack(frame(spark, [(1, None, None, None, None)] * 3), with_ids=False).collect()) >= 1


def test_packed_takes_the_cheapest_with_room():
    lengths = np.array([5, 3, 2, 2, 6, 1, 1, 7, 4])
    got = list(packing.packed(lengths, 8, 4))
    room, load, at = packing.rooms(int(lengths.sum()), 8), None, 0
    load = [0.0] * len(room)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        left = int(lengths[item])
        while left:
            fit = [j for j in range(len(room)) if room[j] >= left] or [j for j in range(len(room)) if room[j]]
            j = min(fit, key=lambda j: (load[j], j))
            take = min(left, room[j])
            assert got[at][0] == item and got[at][2:4] == (take, j)
            room[j], load[j], left, at = room[j] - take, load[j] + packing.cost(take, 4), left - take, at + 1
    assert at == len(got) and not any(room)


# --- 13: runs


def plain_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(11)
    for t in range(600):
        w = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 90))]
        unit = ([0] * rng.randint(1, 14) + [1] * rng.randint(0, 8)) if t % 2 else w[: rng.randint(1, 25)] or [0]
        at = rng.randint(0, len(w))
        w = w[:at] + (unit * rng.randint(1, 8))[: rng.randint(0, 160)] + w[at:]
        assert [tuple(r) for r in runs.runs_of(np.array(w, np.int64)).tolist()] == plain_runs(w)


def test_range_successor():
    rng = np.random.default_rng(2)
    values = rng.permutation(300)
    tree = runs.RangeSuccessor(values)
    lo = rng.integers(0, 300, 500)
    hi, x = np.minimum(300, lo + rng.integers(0, 80, 500)), rng.integers(0, 700, 500)
    wanted = [min((v for v in values[a:b] if v >= c), default=-1) for a, b, c in zip(lo, hi, x)]
    assert tree(lo, hi, x).tolist() == wanted


def plain_digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_query_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") if i % 3 else rng.choice(["x", "yy", "Zé", "日"]) for _ in range(rng.randint(0, 70))), None, None, None) for i in range(400)]
    rows += ODD[:4] + ODD[5:] + [(2, "", None, None, None), (7, "a b\x1c \n\v\f" * 9, None, None, None), (7, "a b\x1c \n\v\f" * 9, None, None, None)]
    frame(spark, rows).withColumn("runs", F.lit("x")).withColumn("_words", F.lit(0)).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op13_runs"](spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((plain_digest(i, t) for i, t, *_ in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 20


def test_runs_long_and_empty(spark):
    assert runs.find_runs(frame(spark, [])).count() == 0
    long = runs.find_runs(frame(spark, [(1, "long " * 200_000 + "end", None, None, None)])).first()
    assert long.n_words == 200_001 and long.collapsed == "long end" and [tuple(r) for r in long.runs] == [(0, 200_000, 1)]
