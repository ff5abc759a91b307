"""Language-model scores from a causal self-attention model over subword ids.

Texts are lower-cased words (A-Z only) and an end token. Words are subword ids of a
public byte-level vocabulary, and a one-layer attention network in numpy predicts the
class of each next id from the ids before it (classes are clusters of ids that follow
and surround alike); an id's share of its class comes from counts of the whole
training corpus. Long id sequences are scored in overlapping context windows, batched
and masked: every id is scored once, with at least ``OVERLAP`` ids of context where there
are as many. A word's probability is the mixture of what the attention model gives its
ids (its end included) and its smoothed share of all training words, in which, as in
the base score, a word never seen is one event.

Training is data-parallel: every training text is cut whole into consecutive windows,
which are written; each task runs Adam over its windows from the shared weights, and
weights are averaged in a tree, by windows seen, for ``ROUNDS`` rounds. Word counts cover every training text. Counts of the most frequent
words (at most ``HEAD``, chosen by a count limit) are broadcast; all others are joined.

Defined results: a null or empty text is its end token; a null doc_id counts as empty
text for the split; with no training rows N and V are 0 and the model is uniform;
repeated rows are scored each; very long texts are scored in segments of
``SEGMENT`` words that see the ids before them; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, freed_memory_kept, id_crc32, with_uid, written
from shoplens.llm.packing import encoder

VOCABULARY, END = "byte_bpe_50k", 50256
HELD_OUT_MOD, HELD_OUT_REST = 7, 2
HEAD, SEGMENT, FLUSH = 200_000, 16_384, 400_000
WINDOW, OVERLAP, PAD = 48, 8, 65_535
FREQUENT, START_CLASSES, INNER_CLASSES, BUCKETS, MARKERS, BLOCK = 8192, 24, 36, 96, 64, 1024
WIDTH, HIDDEN, BATCH, ROUNDS, RATE, MIN_STEPS, TASK_WINDOWS = 16, 32, 48, 2, 4e-3, 250, 16_384
MIXTURE = 0.5  # of the attention model; the rest is the frequent words' shares
END_WORD = b"\n"  # the end token among words, none of which holds white space


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


class Subwords:
    """Ids of a word, remembered in two tables of half ``FLUSH`` words: when the newer
    is full it becomes the older, so words in use stay and others are forgotten."""

    def __init__(self):
        self._encoder = encoder(VOCABULARY)
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def __call__(self, word: bytes) -> np.ndarray:
        return np.frombuffer(self.packed(word), "<i4")

    def packed(self, word: bytes) -> bytes:
        """The ids as little-endian 32-bit bytes."""
        return self.packed_all([word])[0]

    def packed_all(self, words: list[bytes]) -> list[bytes]:
        """``packed`` of each word; most are looked up without a call of their own, and new
        ones are encoded together."""
        found = list(map(self._known.get, words))
        if not all(found):  # a word has an id at least
            holes = [i for i, ids in enumerate(found) if ids is None]
            missing = {words[i]: self._older.get(words[i]) for i in holes}
            new = [w for w, ids in missing.items() if ids is None]
            missing.update(zip(new, self._encoder.words(new)))
            if len(self._known) + len(missing) > FLUSH // 2:
                self._older, self._known = self._known, {}
            self._known.update(missing)
            for i in holes:
                found[i] = missing[words[i]]
        return found


_subwords: list[Subwords] = []


def subwords() -> Subwords:
    if not _subwords:
        _subwords.append(Subwords())
    return _subwords[0]


def forget_subwords() -> None:
    """A reused worker keeps the table of words; tasks without words give it back."""
    _subwords.clear()


def _texts(docs: DataFrame) -> DataFrame:
    d = with_uid(doc_columns(docs, {"doc_id": "doc_id", "text": "text"}))
    return d.select("_uid", "doc_id", (id_crc32() % HELD_OUT_MOD == HELD_OUT_REST).alias("held_out"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                       names=["word", "n"])
        counts.clear()
        return b

    for b in batches:
        for text in b.column("text"):
            words = iter(words_of(text.as_py()))
            while part := list(islice(words, FLUSH)):
                counts.update(part)
                if len(counts) >= FLUSH:
                    yield rows()
            counts[END_WORD] += 1
    yield rows()


def word_counts(training: DataFrame) -> DataFrame:
    """(word binary, n) over all words and ends of ``training`` (column text), written."""
    return written(training.select("text").mapInArrow(_count_words, "word binary, n long")
                   .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(counts: DataFrame, most: int = HEAD) -> dict[bytes, int]:
    """All words counted at least so often that there are at most ``most`` of them."""
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = {r[0]: r[1] for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1))).collect()}
    total, least = 0, None
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > most:
            break
        least = s
    if least is None:
        return {}
    return {bytes(r["word"]): r["n"] for r in counts.filter(step >= least).collect()}


# -- sums of arrays over tasks ------------------------------------------------

def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of float64 blobs (column blob) in a tree whose groups hold some 32 MB
    (16 blobs at most, 2 at least); one reaches the driver."""
    fan = int(np.clip((4 << 20) // max(1, size), 2, 16))

    def add(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size)
        for x in g["blob"]:
            total += np.frombuffer(x, np.float64)
        return pd.DataFrame({"part": [int(key[0])], "blob": [total.tobytes()]})

    parts = written(parts)
    n = parts.count()
    while n > 1:
        parts = written(parts.groupBy(F.floor(F.col("part") / fan).cast("long").alias("part"))
                        .applyInPandas(add, "part long, blob binary"))
        n = parts.count()
    rows = parts.collect()
    return np.frombuffer(rows[0]["blob"], np.float64) if rows else np.zeros(size)


def _by_task(df: DataFrame, fn) -> DataFrame:
    """One float64 blob for each task that has rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = fn(batches)
        if out is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.astype(np.float64).tobytes()], pa.binary())],
                names=["part", "blob"])

    return df.mapInArrow(run, "part long, blob binary")


# -- classes -------------------------------------------------------------------

def subword_counts(counts: DataFrame) -> np.ndarray:
    """Occurrences of each id in the training corpus, from its word counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        ids_of, total = subwords(), np.zeros(END + 1)
        for b in batches:
            words, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            for lo in range(0, len(words), SEGMENT):
                part = words[lo:lo + SEGMENT]
                each = ids_of.packed_all([w for w in part if w != END_WORD])
                own = np.array([w != END_WORD for w in part])
                total[END] += n[lo:lo + SEGMENT][~own].sum()
                times = np.repeat(n[lo:lo + SEGMENT][own], np.fromiter(map(len, each), np.int64, len(each)) // 4)
                total += np.bincount(np.frombuffer(b"".join(each), "<i4"), weights=times, minlength=END + 1)
        return total

    return _summed(_by_task(counts, run), END + 1)


def begins_word() -> np.ndarray:
    """Which ids begin a word (a space leads them); the end counts as one."""
    return encoder(VOCABULARY).leads_with_space(END + 1)


def _cut(words: list[bytes], ids_of: Subwords) -> Iterator[np.ndarray]:
    """Consecutive rows of WINDOW + 1 ids (PAD after the last) of an end, the words and an
    end: a row begins with the last id of the one before, so every id is predicted once."""
    end = np.array([END], "<i4")
    held = end
    for lo in range(0, len(words) + 1, SEGMENT):
        own = np.frombuffer(b"".join(ids_of.packed_all(words[lo:lo + SEGMENT])), "<i4")
        held = np.concatenate([held, own])
        if lo + SEGMENT > len(words):
            held = np.concatenate([held, end, np.full(-len(held) % WINDOW, PAD, "<i4")])
        n = (len(held) - 1) // WINDOW
        if n:
            yield np.lib.stride_tricks.sliding_window_view(held, WINDOW + 1)[:n * WINDOW:WINDOW].astype("<u2")
        held = held[n * WINDOW:]


def windows(training: DataFrame) -> DataFrame:
    """(ids binary): all ids of every training text in windows of WINDOW + 1 ids (16 bits
    each, PAD where there is none); written."""
    size = 2 * (WINDOW + 1)

    def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
        data = b"".join(x.tobytes() for x in parts)
        places = np.arange(0, len(data) + 1, size, dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.Array.from_buffers(
            pa.binary(), len(places) - 1, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data)])], names=["ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, out, held = subwords(), [], 0
        for b in batches:
            for text in b.column("text"):
                for part in _cut(words_of(text.as_py()), ids_of):
                    out.append(part)
                    held += len(part)
                    if held >= 4096:
                        yield rows(out)
                        out, held = [], 0
        yield rows(out)

    return written(training.select("text").mapInArrow(run, "ids binary"))


def _windows_of(batch: pa.RecordBatch) -> np.ndarray:
    """Windows of ids (int32), -1 where there is none."""
    ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2").reshape(-1, WINDOW + 1).astype(np.int32)
    ids[ids == PAD] = -1
    return ids


def _surroundings(made: DataFrame, row_of: np.ndarray, markers: np.ndarray) -> np.ndarray:
    """For each frequent id: what precedes it (hashed) and which markers share its window.
    Windows are taken in blocks of ``BLOCK``, so a task holds some 50 MB whatever it reads."""
    rows, columns = int(row_of.max()) + 1, BUCKETS + MARKERS
    marker_of = np.full(END + 1, MARKERS)  # the last column: no marker
    marker_of[markers] = np.arange(len(markers))

    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        forget_subwords()
        total = np.zeros(rows * columns)
        for b in batches:
            every = _windows_of(b)
            for lo in range(0, len(every), BLOCK):
                w = every[lo:lo + BLOCK]
                y, x = w[:, 1:], w[:, :-1]
                ok = y >= 0
                ids = np.where(ok, y, END)
                cell = row_of[ids] * columns
                before = (x.astype(np.int64) * 2654435761 >> 7) % BUCKETS
                np.add.at(total, (cell + before)[ok], 1.0)  # in place: ``total`` is far longer than a block
                has = np.zeros((len(w), MARKERS + 1), bool)
                has[np.arange(len(w))[:, None], marker_of[ids]] = True
                r, m = np.nonzero(has[:, :MARKERS])
                np.add.at(total, (cell[r] + (BUCKETS + m)[:, None])[ok[r]], 1.0)
        return total

    return _summed(_by_task(made, run), rows * columns).reshape(rows, columns)


def _cluster(features: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Weighted k-means of square-rooted profiles; starts at the heaviest rows."""
    if len(features) <= k:
        return np.arange(len(features))
    parts = []
    for lo, hi in ((0, BUCKETS), (BUCKETS, BUCKETS + MARKERS)):
        p = features[:, lo:hi] + 0.05
        parts.append(np.sqrt(p / p.sum(axis=1, keepdims=True)))
    f = np.hstack(parts).astype(np.float32)
    centres = f[np.argsort(-weight, kind="stable")[:k]]
    for _ in range(12):
        own = np.argmax(f @ centres.T - 0.5 * (centres ** 2).sum(axis=1), axis=1)
        for c in range(k):
            mine = own == c
            if weight[mine].sum() > 0:
                centres[c] = np.average(f[mine], axis=0, weights=weight[mine])
    return own


class Model:
    """Weights, classes and shares; everything a scoring task needs (some 1 MB)."""

    def __init__(self, row_of, class_of, log_share, starts, weights):
        self.row_of, self.class_of, self.log_share = row_of, class_of, log_share
        self.starts, self.weights = starts, weights  # classes 0..starts-1 begin words

    def shapes(self) -> list[tuple[str, tuple]]:
        rows, classes = int(self.row_of.max()) + 1, int(self.class_of.max()) + 1
        return [("e", (rows, WIDTH)), ("p", (WINDOW, WIDTH)), ("q", (WIDTH, WIDTH)), ("k", (WIDTH, WIDTH)),
                ("v", (WIDTH, WIDTH)), ("o", (WIDTH, WIDTH)), ("w1", (WIDTH, HIDDEN)), ("b1", (HIDDEN,)),
                ("w2", (HIDDEN, WIDTH)), ("u", (WIDTH, classes)), ("b", (classes,))]

    def flat(self, weights: dict | None = None) -> np.ndarray:
        return np.concatenate([(weights or self.weights)[n].ravel() for n, _ in self.shapes()])

    def unflat(self, x: np.ndarray) -> dict:
        out, at = {}, 0
        for n, shape in self.shapes():
            size = int(np.prod(shape))
            out[n], at = x[at:at + size].reshape(shape).astype(np.float32), at + size
        return out


_FUTURE = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
_SCALE = np.float32(1 / np.sqrt(WIDTH))


def _exponentials(a: np.ndarray) -> np.ndarray:
    """exp of ``a`` in place, less what would overflow, and its sums along the last axis
    (by a product, which is faster than ``sum`` over short rows)."""
    top = max(0.0, float(a.max(initial=0)) - 60.0)
    if top:
        a -= top
    np.exp(a, out=a)
    return np.maximum(a @ np.ones((a.shape[-1], 1), a.dtype), 1e-30)


def _inputs(w: dict, x: np.ndarray) -> np.ndarray:
    """What the network reads at each place of the windows: the row's vector plus the place's."""
    h0 = w["e"].take(x.ravel(), axis=0)
    whole = h0.reshape(len(x), x.shape[1] * WIDTH)
    whole += w["p"][:x.shape[1]].ravel()
    return h0


def forward(w: dict, x: np.ndarray) -> tuple:
    """Class logits for input rows (windows, positions), with what backward needs.
    Products with weights are two-dimensional, over all positions at once."""
    n, t = x.shape
    h0 = _inputs(w, x)
    inward = np.hstack([w["q"] * _SCALE, w["k"], w["v"]])
    q, k, v = np.split((h0 @ inward).reshape(n, t, 3 * WIDTH), 3, axis=2)
    a = q @ k.transpose(0, 2, 1)
    a += _FUTURE[:t, :t]
    a /= _exponentials(a)
    c = (a @ v).reshape(-1, WIDTH)
    h = c @ w["o"]
    h += h0
    r = h @ w["w1"]
    r += w["b1"]
    np.maximum(r, 0, out=r)
    z = r @ w["w2"]
    z += h
    logits = z @ w["u"]
    logits += w["b"]
    return logits.reshape(n, t, -1), (inward, h0, q, k, v, a, c, h, r, z)


def gradients(w: dict, x: np.ndarray, y: np.ndarray, ok: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradient of the mean cross entropy over the positions of ``ok``; that of the
    embedding for the rows that occur in x only, which are returned beside it."""
    logits, (inward, h0, q, k, v, a, c, h, r, z) = forward(w, x)
    n, t = x.shape
    d = logits.reshape(n * t, -1)
    each = (ok.ravel() / max(1, ok.sum())).astype(np.float32)
    sums = _exponentials(d)
    d *= each[:, None] / sums
    d.reshape(-1)[np.arange(0, d.size, d.shape[1]) + y.ravel()] -= each
    g = {"u": z.T @ d, "b": d.sum(axis=0)}
    dz = d @ w["u"].T
    g["w2"] = r.T @ dz
    dr = dz @ w["w2"].T
    dr *= r > 0
    g["w1"], g["b1"] = h.T @ dr, dr.sum(axis=0)
    dh = dr @ w["w1"].T
    dh += dz
    g["o"] = c.T @ dh
    dc = dh @ w["o"].T
    inner = (dc * c).sum(axis=1).reshape(n, t, 1)  # of each row of a with its gradient
    dc = dc.reshape(n, t, WIDTH)
    ds = dc @ v.transpose(0, 2, 1)
    ds -= inner
    ds *= a
    back = np.empty((n, t, 3 * WIDTH), h0.dtype)
    dq, dk, dv = np.split(back, 3, axis=2)
    np.matmul(ds, k, out=dq)
    np.matmul(ds.transpose(0, 2, 1), q, out=dk)
    np.matmul(a.transpose(0, 2, 1), dc, out=dv)
    back = back.reshape(n * t, 3 * WIDTH)
    g["q"], g["k"], g["v"] = np.hsplit(h0.T @ back, 3)
    g["q"] = g["q"] * _SCALE
    dx = back @ inward.T
    dx += dh
    g["p"] = np.zeros_like(w["p"])
    g["p"][:t] = dx.reshape(n, t, WIDTH).sum(axis=0)
    order = np.argsort(x, axis=None, kind="stable")
    sorted_rows = x.ravel()[order]
    firsts = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
    g["e"] = np.add.reduceat(dx.take(order, axis=0), firsts, axis=0)
    return g, sorted_rows[firsts]


class Adam:
    """Adam; of the embedding only the rows of a step move, with their own moments."""

    def __init__(self, model: Model):
        self.small = [(n, s) for n, s in model.shapes() if n != "e"]
        self.flat = np.concatenate([model.weights[n].ravel() for n, _ in self.small])
        self.weights, at = {"e": model.weights["e"].copy()}, 0
        for n, shape in self.small:  # views: a step on ``flat`` moves them all
            size = int(np.prod(shape))
            self.weights[n], at = self.flat[at:at + size].reshape(shape), at + size
        self.moments = [np.zeros_like(self.flat) for _ in range(2)]
        self.row_moments = [np.zeros_like(self.weights["e"]) for _ in range(2)]

    @staticmethod
    def _moved(g: np.ndarray, m1: np.ndarray, m2: np.ndarray, rate: float, step: int) -> np.ndarray:
        m1 += np.float32(0.1) * (g - m1)
        m2 += np.float32(0.01) * (g * g - m2)
        return np.float32(rate / (1 - 0.9 ** step)) * m1 / (np.sqrt(m2 * np.float32(1 / (1 - 0.99 ** step))) + np.float32(1e-8))

    def step(self, g: dict, rows: np.ndarray, rate: float, step: int) -> None:
        self.flat -= self._moved(np.concatenate([g[n].ravel() for n, _ in self.small]), *self.moments, rate, step)
        m1, m2 = (m[rows] for m in self.row_moments)
        self.weights["e"][rows] -= self._moved(g["e"], m1, m2, rate, step)
        self.row_moments[0][rows], self.row_moments[1][rows] = m1, m2


def _train_task(model: Model, seed: int):
    """Adam over a task's windows from the shared weights; returns weights times windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        forget_subwords()
        data = [_windows_of(b) for b in batches if b.num_rows]
        if not data:
            return None
        data = np.concatenate(data)  # TASK_WINDOWS at most, by the deal of the windows
        rows = model.row_of[np.maximum(data[:, :-1], 0)].astype(np.uint16)  # FREQUENT + 2 at most; short keys sort fast
        classes, known = model.class_of[np.maximum(data[:, 1:], 0)].astype(np.int32), data[:, 1:] >= 0
        adam, step, order = Adam(model), 0, np.random.default_rng(seed)
        total = max(MIN_STEPS, -(-len(data) // BATCH))
        while step < total:
            for at in np.array_split(order.permutation(len(data)), -(-len(data) // BATCH)):
                g, touched = gradients(adam.weights, rows[at], classes[at], known[at])
                step += 1
                adam.step(g, touched, RATE * min(1.0, step / 20) * (1.0 - 0.9 * step / total), step)
                if step >= total:
                    break
        return np.concatenate([model.flat(adam.weights) * np.float64(len(data)), [len(data)]])

    return run


def train(training: DataFrame, counts: DataFrame) -> Model:
    """Classes, shares and weights from the training texts."""
    n, begins = subword_counts(counts), begins_word()
    used = np.argsort(-n, kind="stable")[:FREQUENT]
    used = used[n[used] > 0]
    row_of = np.where(begins, len(used), len(used) + 1)  # the two last rows: other ids
    row_of[used] = np.arange(len(used))
    made = windows(training)
    markers = used[begins[used] & (used != END)][:MARKERS]
    profile = _surroundings(made, row_of, markers)
    first = used[begins[used] & (used != END)]
    inner = used[~begins[used]]
    class_of = np.empty(END + 1, np.int64)
    mine = _cluster(profile[row_of[first]], n[first], START_CLASSES)
    # classes: the end, frequent first ids, other first ids | frequent inner ids, other inner ids
    starts = 2 + (int(mine.max()) + 1 if len(mine) else 0)
    class_of[begins] = starts - 1
    class_of[first], class_of[END] = 1 + mine, 0
    mine = _cluster(profile[row_of[inner]], n[inner], INNER_CLASSES)
    class_of[~begins] = starts + (int(mine.max()) + 1 if len(mine) else 0)
    class_of[inner] = starts + mine
    mass = n + 0.1
    of_class = np.bincount(class_of, weights=mass)
    log_share = np.log(mass / of_class[class_of]).astype(np.float32)
    model = Model(row_of, class_of, log_share, starts, None)
    draw = np.random.default_rng(7)
    model.weights = {name: (draw.standard_normal(s) * (0.3 if name in "ep" else WIDTH ** -0.5)).astype(np.float32)
                     for name, s in model.shapes()}
    model.weights["u"] *= 0.1
    model.weights["b1"] *= 0
    model.weights["b"] = np.log(np.maximum(of_class, 0.1) / of_class.sum()).astype(np.float32)
    size = len(model.flat()) + 1
    seen = made.count()
    for r in range(ROUNDS if seen else 0):
        dealt = made.repartition(max(1, -(-seen // TASK_WINDOWS)))
        total = _summed(_by_task(dealt, _train_task(model, r)), size)
        model.weights = model.unflat(total[:-1] / total[-1])
    return model


# -- scoring ----------------------------------------------------------------------

def log_masses(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For windows of input rows x: log probability of class y at each place, and of
    any class that begins a word. Same network as ``forward``, in two-dimensional
    products and without what only training needs."""
    w, (n, t) = model.weights, x.shape
    h0 = _inputs(w, x)
    qkv = h0 @ np.hstack([w["q"] * _SCALE, w["k"], w["v"]])
    q, k, v = (qkv[:, i * WIDTH:(i + 1) * WIDTH].reshape(n, t, WIDTH) for i in range(3))
    a = q @ k.transpose(0, 2, 1)
    a += _FUTURE[:t, :t]
    top = max(0.0, float(a.max()) - 60.0)
    if top:
        a -= top
    np.exp(a, out=a)
    c = a @ np.concatenate([v, np.ones((n, t, 1), np.float32)], axis=2)  # the last column sums the weights
    c = (c[:, :, :WIDTH] / np.maximum(c[:, :, WIDTH:], 1e-30)).reshape(-1, WIDTH)
    h = c @ w["o"]
    h += h0
    r = h @ w["w1"]
    r += w["b1"]
    z = np.maximum(r, 0, out=r) @ w["w2"]
    z += h
    logits = z @ w["u"]
    logits += w["b"]
    top = max(0.0, float(logits.max()) - 60.0)
    if top:  # else exp can't overflow
        logits -= top
    hit = logits.reshape(-1)[np.arange(0, logits.size, logits.shape[1]) + y.ravel()]
    np.exp(logits, out=logits)
    sides = np.zeros((logits.shape[1], 2), np.float32)
    sides[:model.starts, 0], sides[:, 1] = 1, 1
    mass = np.log(np.maximum(logits @ sides, 1e-30))
    return (hit - mass[:, 1]).reshape(n, t), (mass[:, 0] - mass[:, 1]).reshape(n, t)


def id_scores(model: Model, ids: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of ids and of a word's beginning there. For each span
    (lo, first, hi) the places first..hi-1 are scored, once each, with the ids from lo
    on as context; other places are 0."""
    lp, begin = np.zeros(len(ids), np.float32), np.zeros(len(ids), np.float32)
    stride = WINDOW - OVERLAP
    at = [np.arange(first, hi, stride) for _, first, hi in spans]
    score = np.concatenate(at)
    start = np.concatenate([np.maximum(lo + 1, a - OVERLAP) for (lo, _, _), a in zip(spans, at)])
    stop = np.concatenate([np.minimum(a + stride, hi) for (_, _, hi), a in zip(spans, at)])
    rows, classes = model.row_of[ids], model.class_of[ids]
    order = np.argsort(stop - start, kind="stable")  # windows of like length together
    for lo in range(0, len(order), 64):
        block = order[lo:lo + 64]
        first, end = start[block, None], stop[block, None]
        place = first + np.arange(int((end - first).max()))
        inside = np.minimum(place, end - 1)
        hit, new = log_masses(model, rows[inside - 1], classes[inside])
        ok = (place >= score[block, None]) & (place < end)
        lp[place[ok]], begin[place[ok]] = hit[ok], new[ok]
    return lp + np.where(lp < 0, model.log_share[ids], 0), begin


def word_scores(model: Model, texts: list[list[bytes]], ids_of) -> list[np.ndarray]:
    """Per text the natural log probability of each word and of its end, by the network."""
    parts, spans, firsts, counts, at = [], [], [], [], 0
    end = np.array([END], np.int32)
    for words in texts:
        carried = end
        for lo in range(0, len(words) + 1, SEGMENT):
            last = lo + SEGMENT > len(words)
            # a segment looks ahead to the id after its last word
            each = [*ids_of.packed_all(words[lo:lo + SEGMENT]), end.tobytes() if last else ids_of.packed(words[lo + SEGMENT])[:4]]
            own = np.frombuffer(b"".join(each), "<i4")
            lengths = np.fromiter(map(len, each), np.int64, len(each)) // 4
            first = at + len(carried)
            spans.append((at, first, first + len(own)))
            firsts.append(first + np.cumsum(lengths) - lengths)
            counts.append((len(each) if last else len(each) - 1, last))
            parts += [carried, own]
            at = first + len(own)
            carried = np.concatenate([carried, own[:-1]])[-(OVERLAP + 1):]
    lp, begin = id_scores(model, np.concatenate(parts), spans)
    word_at = np.concatenate(firsts)
    # a word: its first id among first ids, its inner ids, and that the next id begins a word
    value = np.add.reduceat(lp.astype(np.float64), word_at) - begin[word_at]
    value[:-1] += begin[word_at[1:]]
    out, row, lo = [], [], 0
    for f, (n, last) in zip(firsts, counts):
        mine = value[lo:lo + len(f)][:n]
        if last:  # nothing follows an end
            mine[-1] = lp[f[-1]] - begin[f[-1]]
        row.append(mine)
        lo += len(f)
        if last:
            out.append(np.concatenate(row))
            row = []
    return out


def _groups(texts: list[list[bytes]], most: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Runs of texts with about so many words in all (a longer text is its own run)."""
    lo, held = 0, 0
    for i, words in enumerate(texts):
        if held and held + len(words) > most:
            yield lo, i
            lo, held = i, 0
        held += len(words) + 1
    if held:
        yield lo, len(texts)


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    with freed_memory_kept(docs.sparkSession):
        texts = _texts(docs)
        training = texts.filter("not held_out")
        counts = word_counts(training)
        return mixed_scores(texts, counts, train(training, counts))


def mixed_scores(texts: DataFrame, counts: DataFrame, model: Model, most: int = HEAD) -> DataFrame:
    """Scores of ``texts`` (as ``_texts`` gives them) by a trained model and the training
    words' counts, of which at most ``most`` are broadcast and the others joined."""
    spark = texts.sparkSession
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = frequent_words(counts, most)
    shared = spark.sparkContext.broadcast((model, head))  # at most HEAD words and the weights
    log_base = float(np.log10(n + v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, known = shared.value
        ids_of = subwords()
        shares = np.log10(np.fromiter(known.values(), np.float64, len(known)) + 1) - log_base
        base = dict(zip(known, shares.tolist()))
        to_ln = np.log(10)
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                tokens, hits, sums, rest, owns, scores = [], [], [], [], [], []
                texts = [words_of(x.as_py()) for x in part.column("text")]
                network = [x for i, j in _groups(texts) for x in word_scores(net, texts[i:j], ids_of)]
                for words, own in zip(texts, network):
                    words.append(END_WORD)
                    found = np.fromiter(map(base.get, words, repeat(np.nan)), np.float64, len(words))
                    other = np.flatnonzero(np.isnan(found))
                    tokens.append(len(words))
                    hits.append(len(words) - len(other))
                    sums.append(float(np.nansum(found)))
                    with np.errstate(invalid="ignore"):  # NaN: words joined later
                        mixed = np.logaddexp(np.log(MIXTURE) + own, np.log(1 - MIXTURE) + found * to_ln)
                    scores.append(float(np.nansum(mixed)) / to_ln)
                    rest.append([words[i] for i in other])
                    owns.append(own[other])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_uid"), part.column("doc_id"), part.column("held_out"), pa.array(tokens, pa.int64()),
                     pa.array(hits, pa.int64()), pa.array(sums, pa.float64()),
                     pa.ListArray.from_arrays(
                         pa.array(np.cumsum([0, *map(len, rest)]), pa.int32()), pa.StructArray.from_arrays(
                             [pa.array([w for r in rest for w in r], pa.binary()),
                              pa.array(np.concatenate(owns), pa.float32())], ["word", "own"])),
                     pa.array(scores, pa.float64())],
                    names=["_uid", "doc_id", "held_out", "n_tokens", "hits", "head_sum", "rest", "head_score"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = written(texts.mapInArrow(run, f"_uid long, doc_id {kind}, held_out boolean, n_tokens long, hits long, "
                                           "head_sum double, rest array<struct<word:binary,own:float>>, head_score double"))
    share = (F.coalesce("n", F.lit(0)) + 1) / float(n + v + 1)
    rare = scored.select("_uid", F.explode("rest").alias("r")).select("_uid", "r.word", "r.own") \
        .join(counts, "word", "left").groupBy("_uid").agg(
            F.sum(F.log10(share)).alias("rare_sum"),
            F.sum(F.log10(MIXTURE * F.exp("own") + (1 - MIXTURE) * share)).alias("rare_score"),
            F.count("n").alias("rare_hits"))
    return scored.join(rare, "_uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hits") + F.coalesce("rare_hits", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0))).alias("base_score"),
        (F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"))
