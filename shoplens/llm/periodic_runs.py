"""Maximal periodic runs of words by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` long, that
no neighbouring word extends. Such a run holds, for the scale B = 2^k with B <= q < 2 B,
a whole block of B words (blocks start at multiples of B) that occurs again q words
later. So at each scale every block is compared with the window that follows it at
distances B to 2 B - 1, by the sum of squared differences of word numbers

    sum (w[x+d+j] - w[x+j])^2 = sum w[x+d+j]^2 + sum w[x+j]^2 - 2 sum w[x+d+j] w[x+j],

whose last term is a correlation of 2 B points by number-theoretic transforms modulo
p = 3 * 2^30 + 1, all in exact integers. A distance with sum zero is a seed: it is
extended word by word to both sides, which also verifies it, and gives the maximal
stretch of that period. Stretches found for a smaller period first keep that period.

Three things spare transforms without missing a seed: below ``DIRECT`` the sums of a
scale are taken without a transform, as word-by-word comparisons of the whole batch; a
block can only match if every probed word of it recurs at a distance in the window; and
a block whose window lies inside a run of a smaller period has only multiples of that
period. No step depends on the neighbours of a document, so Spark deals out rows freely,
and a task works on some ``BATCH_WORDS`` words at a time (or one document).

Defined results: a null or empty text has no words and no runs; a null doc_id, repeated
rows and extra columns make no difference (every row is answered by itself; extra
columns are ignored); texts may have up to 2^32 words; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, id_crc32, text_or_empty

MIN_LENGTH, MIN_COPIES = 6, 4
DIRECT = 32  # scales below it are compared word by word
BATCH_WORDS, BATCH_POINTS = 1 << 19, 1 << 20
PROBES = 8
P, ROOT = 3 * 2 ** 30 + 1, 5  # a prime with 2^30-th roots of one, and a generator
BLANKS = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_SCHEMA = f"doc_id {{id}}, n_words bigint, runs {RUNS}, collapsed string"


# ------------------------------------------------------------------ transform

def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod P."""
    out, have, step = np.ones(n, np.uint64), 1, base
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(step) % np.uint64(P)
        have, step = have + more, step * step % P
    return out


def ntt(a: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Transform of each row (a power of two long) modulo P. Forward takes natural
    order to bit-reversed, inverse takes it back, so no reordering is needed."""
    rows, n = a.shape
    p = np.uint64(P)
    a = a.astype(np.uint64)
    root = pow(ROOT, (P - 1) // n, P)
    if inverse:
        root = pow(root, P - 2, P)
    spans = [n >> i for i in range(1, n.bit_length())]  # half lengths n/2 .. 1
    for half in reversed(spans) if inverse else spans:
        turn = _power(pow(root, n // (2 * half), P), half)
        b = a.reshape(rows, n // (2 * half), 2, half)
        low, high = b[:, :, 0].copy(), b[:, :, 1].copy()
        if inverse:
            high = high * turn % p
            b[:, :, 1] = (low + p - high) % p
            b[:, :, 0] = (low + high) % p
        else:
            b[:, :, 1] = (low + p - high) % p * turn % p
            b[:, :, 0] = (low + high) % p
    return a * np.uint64(pow(n, P - 2, P)) % p if inverse else a


def zero_distances(words: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of every block of ``size`` words that occurs again at a distance
    from size to 2 size - 1, modulo P. ``words`` reaches 3 size - 1 past every start."""
    p = np.uint64(P)
    x = words[blocks[:, None] + np.arange(3 * size - 1)].astype(np.uint64)
    block, window = np.zeros((2, len(blocks), 2 * size), np.uint64)
    # a block turned round makes the product a correlation: place size-1+k is distance k
    block[:, :size] = x[:, size - 1::-1] if size > 1 else x[:, :1]
    window[:, :2 * size - 1] = x[:, size:]
    product = ntt(ntt(block) * ntt(window) % p, inverse=True)[:, size - 1:2 * size - 1]
    squares = np.zeros((len(blocks), 2 * size), np.uint64)
    np.cumsum(window[:, :2 * size - 1] ** 2 % p, axis=1, out=squares[:, 1:])
    there = squares[:, size:] - squares[:, :size]
    here = (block[:, :size] ** 2 % p).sum(axis=1)[:, None]
    rest = (there + here + 2 * (p - product)) % p
    row, k = np.nonzero(rest[:, :size] == 0)
    return blocks[row], k + size


# ------------------------------------------------------------------ runs of a batch

def _extend(w: np.ndarray, x: int, d: int) -> tuple[int, int]:
    """Largest [start, end) around x with w[i] == w[i + d] for all of start .. end - d - 1."""
    lo, step = x, 64
    while lo > 0:
        a = max(0, lo - step)
        bad = np.flatnonzero(w[a:lo] != w[a + d:lo + d])
        if len(bad):
            lo = a + int(bad[-1]) + 1
            break
        lo, step = a, step * 2
    hi, step, last = x, 64, len(w) - d
    while hi < last:
        b = min(last, hi + step)
        bad = np.flatnonzero(w[hi:b] != w[hi + d:b + d])
        if len(bad):
            hi += int(bad[0])
            break
        hi, step = b, step * 2
    return lo, hi + d


def _needed(d: int) -> int:
    return max(MIN_LENGTH, MIN_COPIES * d)


def _direct(w: np.ndarray, most: int, found: dict) -> None:
    """Runs of the periods below ``DIRECT``: stretches of zero differences at each distance."""
    for d in range(1, min(DIRECT, most + 1)):
        same = np.flatnonzero(w[d:] == w[:-d])
        if len(same) < _needed(d) - d:
            continue
        cut = np.flatnonzero(np.diff(same) != 1) + 1
        first, end = np.r_[0, cut], np.r_[cut, len(same)]
        for a, b in zip(first[end - first >= _needed(d) - d], end[end - first >= _needed(d) - d]):
            found.setdefault((int(same[a]), int(same[b - 1]) + 1 + d), d)


def _recurring(w: np.ndarray, key: np.ndarray, blocks: np.ndarray, size: int) -> np.ndarray:
    """Blocks whose probed words all occur again at a distance in [size, 2 size). ``key``
    holds word * len(w) + place in order."""
    n = np.int64(len(w))
    for at in np.linspace(0, size - 1, PROBES).astype(np.int64):
        if not len(blocks):
            break
        here = w[blocks + at] * n + blocks + at
        place = np.searchsorted(key, here + size)
        near = key[np.minimum(place, n - 1)]
        blocks = blocks[(place < n) & (near < here + 2 * size) & (near // n == w[blocks + at])]
    return blocks


def _outside_runs(found: dict, blocks: np.ndarray, size: int) -> np.ndarray:
    """Blocks whose window is not wholly inside one run of a smaller period."""
    if not found or not len(blocks):
        return blocks
    start, end = (np.array(v, np.int64) for v in zip(*sorted(found)))
    reach = np.maximum.accumulate(end)  # the furthest end of the runs that start no later
    at = np.searchsorted(start, blocks, side="right") - 1
    return blocks[(at < 0) | (reach[np.maximum(at, 0)] < blocks + 3 * size - 1)]


def batch_runs(w: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in ``w``: documents of these lengths, one after another,
    each followed by a number of its own, so that no stretch passes its end."""
    most = int(lengths.max(initial=0)) // MIN_COPIES
    found: dict[tuple[int, int], int] = {}
    if not most:
        return []
    _direct(w, most, found)
    size, key = DIRECT, None
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    while size <= most:
        # documents that can hold a run of this scale, and their blocks
        docs = np.flatnonzero(lengths >= MIN_COPIES * size)
        per = lengths[docs] // size
        first = np.repeat(starts[docs], per)
        blocks = first + size * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
        if key is None:
            key = np.sort(w * np.int64(len(w)) + np.arange(len(w)))
        blocks = _outside_runs(found, _recurring(w, key, blocks, size), size)
        longer: dict[tuple[int, int], int] = {}
        if len(blocks):
            # past the end: numbers that no word has, each but once
            past = np.arange(3 * size) + w.max() + 1
            padded = np.concatenate([w, past])
            take = max(1, BATCH_POINTS // (2 * size))
            seeds = [zero_distances(padded, blocks[i:i + take], size) for i in range(0, len(blocks), take)]
            x, d = (np.concatenate(v) for v in zip(*seeds))
            order = np.lexsort((x, d))
            was, lo, hi = -1, 0, 0
            for a, b in zip(x[order].tolist(), d[order].tolist()):
                if b == was and lo <= a and a + size <= hi - b:
                    continue  # in the stretch the last seed gave
                was, (lo, hi) = b, _extend(w, a, b)
                if hi - lo >= _needed(b):
                    longer.setdefault((lo, hi), b)
        for span, d in longer.items():
            found.setdefault(span, d)
        size *= 2
    return [(s, e, d) for (s, e), d in found.items()]


# ------------------------------------------------------------------ documents

def _collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those any run holds after its first period, one blank apart."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, e, d in runs:
        edge[s + d] += 1
        edge[e] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def document_runs(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs as (start, end, period) by start and period, collapsed text) of each text."""
    number = defaultdict(count().__next__)
    split = [t.split() for t in texts]  # bytes.split: space and U+0009 to U+000D
    lengths = np.array([len(s) for s in split], np.int64)
    w = np.empty(int(lengths.sum()) + len(split), np.int64)
    at = 0
    for i, s in enumerate(split):
        w[at:at + len(s)] = np.fromiter(map(number.__getitem__, s), np.int64, len(s))
        w[at + len(s)] = -1 - i
        at += len(s) + 1
    w[w < 0] = len(number) - 1 - w[w < 0]
    ends = np.cumsum(lengths + 1)
    runs: list[list] = [[] for _ in split]
    for s, e, d in batch_runs(w, lengths):
        i = int(np.searchsorted(ends, s, side="right"))
        off = int(ends[i] - lengths[i] - 1)
        runs[i].append((s - off, e - off, d))
    out = []
    for words, mine in zip(split, runs):
        mine.sort(key=lambda r: (r[0], r[2]))
        out.append((len(words), mine, _collapse(words, mine)))
    return out


def _task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        a = 0
        while a < len(texts):
            size, z = 0, a
            while z < len(texts) and (z == a or size + len(texts[z]) <= 6 * BATCH_WORDS):
                size += len(texts[z])
                z += 1
            done = document_runs(texts[a:z])
            runs = [r for _, mine, _ in done for r in mine]
            offsets = np.r_[0, np.cumsum([len(mine) for _, mine, _ in done])].astype(np.int32)
            values = np.array(runs, np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays(
                [pa.array(values[:, 0]), pa.array(values[:, 1] - values[:, 0]), pa.array(values[:, 2])],
                names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, z - a), pa.array([n for n, _, _ in done], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), spans),
                 pa.array([c for _, _, c in done], pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
            a = z


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the
    collapsed text of every row: its words but for those a run holds after its first period."""
    d = doc_columns(docs, {"id": doc_id, "text": text})
    kind = d.schema["id"].dataType.simpleString()
    return d.select("id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")) \
        .mapInArrow(_task, _SCHEMA.format(id=kind))


# ------------------------------------------------------------------ contract of the query

def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row; the text made periodic from a word on where
    crc32(doc_id) is divisible by ten: a period's words are repeated to the old length."""
    d = doc_columns(docs, {"doc_id": "doc_id", "text": "text"}).select("doc_id", text_or_empty().alias("_text")) \
        .withColumn("_h", id_crc32()) \
        .withColumn("_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("_text", F.lit(BLANKS), F.lit(0)))) \
        .withColumn("_n", F.size("_words")).withColumn("_g", F.floor(F.col("_h") / 10)) \
        .withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int"))) \
        .withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")),
                                    F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")))
    made = F.slice(F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail), F.lit(1), F.col("_n"))
    return d.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("_text")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_runs``."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
                                                   F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
