"""Periodic runs, hard negatives and line dedup against brute force on awkward rows."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from shoplens.llm import hard_negatives, line_dedup, periodic_runs, queries  # noqa: E402

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, _text string, _id long, pos long, _words string, runs string"


# ------------------------------------------------------------------ periodic runs

def _runs(words):
    """All runs (start, end, period) by trying every period at every place."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j if j > i else i + 1
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def _repetitive(rng, n):
    words = []
    vocabulary = rng.choice([1, 2, 3, 40, 1000])
    while len(words) < n:
        part = [str(rng.randrange(vocabulary)) for _ in range(rng.choice([1, 2, 5, 31, 32, 33, 63, 64, 65, 130]))]
        words += part * rng.choice([1, 1, 3, 4, 5, 8]) + part[:rng.randrange(len(part) + 1)]
    return words


def test_transform_is_an_exact_convolution():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, periodic_runs.P, (2, 3, 32))
    got = periodic_runs.ntt(periodic_runs.ntt(a) * periodic_runs.ntt(b) % np.uint64(periodic_runs.P), inverse=True)
    for r in range(3):
        for k in range(32):
            assert int(got[r, k]) == sum(int(a[r, j]) * int(b[r, (k - j) % 32]) for j in range(32)) % periodic_runs.P


def test_block_distances_are_all_zero_mismatch_places():
    rng = random.Random(7)
    for size in (1, 4, 32):
        w = np.array([rng.randrange(2 if size < 32 else 1) if i % 50 else 5 for i in range(600)], np.int64)
        blocks = np.arange(0, 600 - 3 * size, size)
        got = set(zip(*(v.tolist() for v in periodic_runs.zero_distances(w, blocks, size))))
        assert got == {(x, d) for x in blocks.tolist() for d in range(size, 2 * size)
                       if (w[x:x + size] == w[x + d:x + d + size]).all()}


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        docs = [_repetitive(rng, n) for n in (0, 1, 6, 40, 500, 1100)]
        rng.shuffle(docs)
        for words, (n, runs, collapsed) in zip(docs, periodic_runs.document_runs([" ".join(d).encode() for d in docs])):
            want = _runs(words)
            gone = {i for s, e, q in want for i in range(s + q, e)}
            assert (n, runs) == (len(words), want)
            assert collapsed.decode() == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_awkward_rows(spark):
    texts = [None, "", " \t\n", "a", "a a a a a a", "a a a a a a a a a a a a", "É é " * 4,
             "a b " * 3, "a b " * 4, "\x1c \x1c \x1c \x1c \x1c \x1c", " ".join(map(str, list(range(700)) * 5))]
    rows = [(i, t, "x", 1, 1, "x", "x") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "b b b b b b", "x", 1, 1, "x", "x")]
    got = periodic_runs.find_runs(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    want = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        want.append((str(r[0]), len(words), [(s, e - s, q) for s, e, q in _runs(words)]))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs]) for r in got) == sorted(want)
    assert periodic_runs.find_runs(spark.createDataFrame([], DOCS)).count() == 0
    assert periodic_runs.report(periodic_runs.find_runs(periodic_runs.planted(spark.createDataFrame([], DOCS)))).count() == 0


def test_runs_query_equals_brute_force(spark):
    rows = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        if n > 2500:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = _runs(words)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        s, e, q = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=(None,) * 3)
        best = (s, e - s, q, 1000 * (e - s) // q) if runs else (None,) * 4
        assert rows[doc.doc_id] == (
            len(runs), *best, hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


# ------------------------------------------------------------------ hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, tile string, score string, id string, dim string, rank string"


def _mined(rows, anchors, scale=256, low=80, high=100):
    """One output row at a time from the definition."""
    def fit(r):
        return None not in (r[0], r[1], r[2]) and all(x is not None and math.isfinite(x) for x in r[1])

    def whole(v):
        return [math.floor(scale * x) for x in v]

    good, out = [r for r in rows if fit(r)], []
    for a in (r for r in anchors if fit(r)):
        q = whole(a[1])
        scored = sorted((-sum(x * y for x, y in zip(q, whole(r[1]))), r[0], r[2] == a[2]) for r in good
                        if r[0] != a[0] and len(r[1]) == len(q))
        for s, i, _ in [x for x in scored if x[2]][:5]:
            fits = [(n, j) for n, j, same in scored if not same and low * -s <= 100 * -n <= high * -s][:5]
            out += [(a[0], i, k + 1, j, -s, -n) for k, (n, j) in enumerate(fits)]
    return sorted(out)


def _vectors():
    rng = random.Random(13)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(400):
        length = rng.choice([0.2, 1.0, 1.0, 3.0])
        v = [length * (c + rng.gauss(0, 0.5)) for c in centres[i % 4]]
        rows.append((i, v, i % 4 if i % 3 else 0))  # one label holds a third of the rows and more
    rows += [(1000 + i, [0.5] * 6, i % 2) for i in range(40)]  # ties
    rows += [(2000, None, 1), (2001, [1.0, None] + [0.0] * 4, 1), (2002, [float("nan")] * 6, 1), (2003, [float("inf")] * 6, 1),
             (2004, [1.0] * 6, None), (None, [1.0] * 6, 1), (2005, [], 1), (2006, [], 2), (2007, [1.0, 2.0], 1),
             (2008, [1.0, 2.0], 1), (2009, [1.0, 2.0], 2), (2010, [0.0] * 6, 2), (2011, [-1.0] * 6, 3)]
    return rows + [rows[3], rows[3], rows[20]]


@pytest.mark.parametrize("bucket,tile,pairs", [(2048, 256, 32), (16, 4, 3)])
def test_hard_negatives_equal_brute_force(spark, bucket, tile, pairs):
    rows = _vectors()
    df = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], VECTORS).repartition(5)
    chosen = F.col("vec_id").isin([0, 3, 20, 21, 1000, 1001, 2000, 2004, 2005, 2007, 2010, 2011]) | F.col("vec_id").isNull()
    got = hard_negatives.mine(df, df.filter(chosen), bucket=bucket, tile=tile, pairs=pairs).collect()
    anchors = [r for r in rows if r[0] in (0, 3, 20, 21, 1000, 1001, 2000, 2004, 2005, 2007, 2010, 2011, None)]
    want = _mined(rows, anchors)
    assert sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got) == want
    assert len(want) > 50
    assert hard_negatives.mine(df.limit(0), df.limit(0)).count() == 0
    assert hard_negatives.mine(df, df.limit(0)).count() == 0


def test_no_row_that_reaches_the_bound_is_pruned():
    rng = np.random.default_rng(3)
    for _ in range(200):
        dim, n = int(rng.integers(1, 9)), int(rng.integers(1, 60))
        data = rng.integers(-300, 300, (n, dim)).astype(np.int32)
        b = hard_negatives._Bucket({
            "bucket": 0, "dim": dim, "n": n, "longest": math.sqrt(float((data.astype(float) ** 2).sum(axis=1).max())),
            "ids": np.arange(n).tobytes(), "labels": np.zeros(n, np.int64).tobytes(), "data": data.tobytes(),
            "lists": np.ascontiguousarray(np.argsort(data, axis=0).T.astype(np.int32)).tobytes()})
        q = rng.integers(-300, 300, dim).astype(np.int32)
        scores = data.astype(np.int64) @ q.astype(np.int64)
        bound = int(rng.choice(scores))
        assert set(np.flatnonzero(scores >= bound)) <= set(b.candidates(q, float(bound)).tolist())


def test_a_single_tile_is_spread_over_bucket_groups():
    assert hard_negatives.grid(1, 1) == (1, 1)
    of_buckets, of_tiles = hard_negatives.grid(10_000, 1)
    assert of_buckets > 300 and of_tiles == 1
    for buckets, tiles in ((26, 3), (500_000, 40_000), (1, 900), (7, 7)):
        b, t = hard_negatives.grid(buckets, tiles)
        assert buckets * tiles / (b * t) <= 2 * hard_negatives.PAIRS and 1 <= b <= buckets and 1 <= t <= tiles


# ------------------------------------------------------------------ line dedup

def _kept_lines(rows, min_chars=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blanks))

    order = lambda i: (i is not None, i or 0)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or i == max(holders[key(x)], key=order)]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def _line_rows():
    rng = random.Random(17)
    lines = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(12)) for _ in range(30)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    hot = "The same notice stands in very many documents of this table."
    rows += [(5000 + 7 * i, f"own line {i}\n  {hot.upper() if i % 3 else hot}\t\r\nend {i}\n") for i in range(3000)]
    rows += [(90_000, "\n".join([hot] + [f"{hot} {i % 3}" for i in range(200)] + [""] * 70 + [hot, "x"]))]
    rows += [(90_001 + i, "\n".join(f"{hot} {j}" for j in range(3))) for i in range(5)]
    rows += [(i, "é" * 39 + "É") for i in range(91_000, 91_005)] + [(i, "é" * 39) for i in range(91_000, 91_006)]
    rows += [(92_000 + i, " " + "n" * 40) for i in range(2)] + [(92_010 + i, "n" * 40) for i in range(5)]
    rows += [(None, None), (None, f"{hot}\nthe null id"), (93_000, None), (93_001, ""), (93_002, "\n\n"), (93_003, "q" * 300_000)]
    # equal ids: the same document; some rows equal as a whole
    rows += [(94_000, "shared id " * 8), (94_000, "shared id " * 8), (94_000, "shared id " * 8 + "\nmore")]
    return rows + [(94_001 + i, "shared id " * 8) for i in range(4)]


def test_line_dedup_equals_brute_force(spark):
    rows = _line_rows()
    df = spark.createDataFrame([(i, t, "x", 1, 1, "x", "x") for i, t in rows], DOCS).repartition(5)
    got = [(str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.line_report(df).collect()]
    want = _kept_lines(rows)
    assert sorted(got) == want and sum(x[2] for x in want) > 3000
    kept = line_dedup.drop_repeated_lines(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted((i, t) for i, _, _, t in want)
    assert {r._text for r in kept.collect()} == {"x"}
    assert line_dedup.line_report(df.limit(0)).count() == 0 and line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_a_hot_line_is_many_groups_and_bitmaps_hold_dropped_lines_only(spark):
    df = spark.createDataFrame(_line_rows(), "doc_id long, text string")
    groups = line_dedup.first_occurrences(line_dedup.hashed_lines(df))
    most = groups.groupBy("_h1", "_h2").agg(F.count("*").alias("n"), F.sum("_docs").alias("d"), F.max("_docs").alias("m")) \
        .orderBy(F.desc("d")).first()
    assert most.d > 3000 and most.n > 10 and most.m <= 1024
    maps = line_dedup.keep_bitmaps(df).collect()
    assert all(w.bits != 0 for r in maps for w in r.dropped)
    assert all([w.word for w in r.dropped] == sorted({w.word for w in r.dropped}) for r in maps)
    report = {(str(r.doc_id), r.n_dropped) for r in line_dedup.line_report(df).collect() if r.n_dropped}
    assert {(str(r.doc_id), sum(bin(w.bits & (2 ** 64 - 1)).count("1") for w in r.dropped)) for r in maps} == report


def test_first_occurrences_add_no_shuffle_to_the_range_partitions(spark):
    df = line_dedup.first_occurrences(line_dedup.hashed_lines(spark.read.parquet(f"{SF001}/documents.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_line_dedup"])
def test_sql_names_its_columns_as_the_query_does(spark, name):
    assert name in queries.SQL and all(c in queries.SQL[name] for c in queries.QUERIES[name](spark, SF001).columns)
