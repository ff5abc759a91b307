"""Hard negatives by coordinate pruning over length buckets (after LEMP).

Vectors are quantised to floor(scale * x) and range-partitioned by length, so that runs of
``BUCKET`` rows are buckets of nearly one length. A bucket holds its vectors, labels, its
greatest length and, for each coordinate, its rows in order of that coordinate (the
sorted lists). A search for scores of at least t by an anchor q in a bucket of greatest length l
goes so: with c = q_f / |q| and a = arccos(t / (|q| l)), a row x can reach t only if x_f / l
lies between cos(arccos(c) + a) and cos(arccos(c) - a). The anchor's ``FOCUS`` largest
coordinates each give such a feasible range, a slice of a sorted list; the shortest slice is
the candidate set, the other ranges thin it, and the exact integer product verifies
what is left. A bucket too short for t (t > |q| l) is passed over whole.

Anchors are a stated query set, packed into tiles; buckets meet tiles in a grid of groups
whose sizes follow from both counts, so no group is larger than some ``PAIRS`` pairs. Two
searches run over the grid. The first finds each anchor's best rows of its own label; its
first lower bound comes from one bucket, and rises as buckets are met. The second finds,
for each positive, the best rows of other labels whose score lies in the window
``low_percent`` to ``high_percent`` of the positive's score. Each group returns at most k rows per
anchor (and positive), which window functions reduce.

Defined results: rows without id, with a null label, a null vector, or null or
non-finite components take no part; only vectors of equal length (dimension) meet; rows that
share the anchor's id are neither its positives nor its negatives; repeated rows are each a
row, and a repeated anchor is answered for each of its rows; ties go to the smaller vec_id;
a positive with a score below zero has an empty window where low_percent < high_percent;
components have at most 31 bits (larger ones are clipped); extra columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, written

SCALE, ANCHOR_MOD = 256, 100
N_POSITIVES, N_NEGATIVES, LOW_PERCENT, HIGH_PERCENT = 5, 5, 80, 100
BUCKET, TILE, FOCUS, PAIRS = 2048, 256, 4, 32
DENSE = 4  # a candidate set over 1 / DENSE of a bucket is verified by a matrix product
_BUCKETS = "bucket long, dim int, n int, longest double, ids binary, labels binary, data binary, lists binary"
_TILES = "tile long, dim int, n int, ids binary, labels binary, data binary"
_FOUND = "tile long, row int, slot int, vec_id long, score long"
_SLACK = 1e-6


# ------------------------------------------------------------------ packing

def _packer(rows: int, lists: bool):
    """Vectors in their order, ``rows`` to a pack; with ``lists`` also sorted coordinate lists."""

    def pack(number: int, dim: int, part: list) -> pa.RecordBatch:
        ids, labels, data = (np.concatenate(v) for v in zip(*part))
        cols = [pa.array([number], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32())]
        names = ["bucket" if lists else "tile", "dim", "n"]
        if lists:
            longest = math.sqrt(max((float(x) for x in (data.astype(np.float64) ** 2).sum(axis=1)), default=0.0))
            cols.append(pa.array([longest], pa.float64()))
            names.append("longest")
        order = [np.argsort(data, axis=0, kind="stable").T.astype(np.int32)] if lists else []
        for x in (ids, labels, data.astype(np.int32), *order):
            cols.append(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()))
        return pa.RecordBatch.from_arrays(cols, names=names + ["ids", "labels", "data", *(["lists"] if lists else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        for b in batches:
            ids, labels = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            offsets = b.column(2).offsets.to_numpy()
            flat = b.column(2).values.to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            for dim in np.unique(lengths).tolist():
                pick = np.flatnonzero(lengths == dim)
                data = flat[offsets[:-1][pick][:, None] + np.arange(dim)]
                at = 0
                while at < len(pick):
                    room = min(len(pick), at + rows - size.get(dim, 0))
                    held.setdefault(dim, []).append((ids[pick[at:room]], labels[pick[at:room]], data[at:room]))
                    size[dim] = size.get(dim, 0) + room - at
                    at = room
                    if size[dim] == rows:
                        yield pack(first + made, dim, held.pop(dim))
                        size[dim], made = 0, made + 1
        for dim, part in held.items():
            yield pack(first + made, dim, part)
            made += 1

    return run


def quantised(vectors: DataFrame, scale: float = SCALE, vec_id: str = "vec_id", embedding: str = "embedding",
              label: str = "label") -> DataFrame:
    """id, label, v (whole components) and len2 (squared length) of the rows that take part."""
    d = doc_columns(vectors, {"id": vec_id, "v": embedding, "label": label}) \
        .select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                F.col("v").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("v", lambda x: F.greatest(F.lit(-2.0 ** 31), F.least(F.lit(2.0 ** 31 - 1), F.floor(x * scale).cast("double"))))
    return d.filter("id is not null and label is not null and v is not null").filter(~bad) \
        .select("id", "label", F.transform(whole, lambda x: x.cast("int")).alias("v"),
                F.aggregate(whole, F.lit(0.0), lambda s, x: s + x * x).alias("len2"))


# ------------------------------------------------------------------ one tile against one bucket

def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products (in doubles where no sum can pass 2^53)."""
    most = float(np.abs(q.astype(np.int64)).max(initial=0)) * float(np.abs(x.astype(np.int64)).max(initial=0)) * max(1, q.shape[-1])
    if most < 2.0 ** 24:
        return (x.astype(np.float32) @ q.astype(np.float32)).astype(np.int64)
    if most < 2.0 ** 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    exact = x.astype(object) @ q.astype(object)
    return np.clip(exact, np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max).astype(np.int64)


class _Bucket:
    """A bucket with its sorted coordinate lists."""

    def __init__(self, row: dict):
        self.number, self.dim, self.n, self.longest = row["bucket"], row["dim"], row["n"], row["longest"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.data = np.frombuffer(row["data"], np.int32).reshape(self.n, self.dim)
        self.lists = np.frombuffer(row["lists"], np.int32).reshape(self.dim, self.n)

    def candidates(self, q: np.ndarray, at_least: float) -> np.ndarray:
        """Rows that can reach the score ``at_least``: none lost, not all of them reach it."""
        norm = math.sqrt(float((q.astype(np.float64) ** 2).sum()))
        reach = norm * self.longest
        if at_least > reach * (1 + _SLACK) + _SLACK:
            return np.empty(0, np.int64)
        if reach == 0 or at_least <= -reach:
            return np.arange(self.n)
        spread = math.acos(max(-1.0, min(1.0, at_least / reach)))
        ranges = []
        for f in np.argsort(-np.abs(q.astype(np.int64)), kind="stable")[:FOCUS].tolist():
            turn = math.acos(max(-1.0, min(1.0, float(q[f]) / norm)))
            low = self.longest * math.cos(min(math.pi, turn + spread)) - _SLACK * (1 + self.longest)
            high = self.longest * math.cos(max(0.0, turn - spread)) + _SLACK * (1 + self.longest)
            values = self.data[self.lists[f], f]
            a, z = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((int(z - a), f, int(a), int(z), low, high))
        _, best, a, z, _, _ = min(ranges)
        rows = self.lists[best][a:z]
        for _, f, _, _, low, high in ranges:
            if f != best:
                v = self.data[rows, f]
                rows = rows[(v >= low) & (v <= high)]
        return rows

    def scored(self, q: np.ndarray, at_least: float) -> tuple[np.ndarray, np.ndarray]:
        rows = self.candidates(q, at_least)
        if len(rows) * DENSE > self.n:
            return rows, _scores(q, self.data)[rows]
        return rows, _scores(q, self.data[rows])


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by score descending, then id."""
    if len(scores) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        few = np.flatnonzero(scores >= kth)
        return few[np.lexsort((ids[few], -scores[few]))][:k]
    return np.lexsort((ids, -scores))[:k]


class _Best:
    """The k best of each (row, slot) so far, over the buckets a task meets for a tile."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, at: tuple[int, int], ids: np.ndarray, scores: np.ndarray) -> None:
        if at in self.held:
            ids, scores = (np.concatenate(v) for v in zip(self.held[at], (ids, scores)))
        few = _first(ids, scores, self.k)
        self.held[at] = ids[few], scores[few]

    def bound(self, at: tuple[int, int]) -> int | None:
        """The k-th best score, once there are k."""
        scores = self.held[at][1] if at in self.held else ()
        return int(scores[-1]) if len(scores) == self.k else None

    def rows(self, tile: int) -> pa.RecordBatch:
        keys = [(r, s, len(i)) for (r, s), (i, _) in self.held.items()]
        cat = lambda j: np.concatenate([v[j] for v in self.held.values()]) if self.held else np.empty(0, np.int64)
        n = [x[2] for x in keys]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(sum(n), tile, np.int64)), pa.array(np.repeat([x[0] for x in keys], n).astype(np.int32)),
             pa.array(np.repeat([x[1] for x in keys], n).astype(np.int32)), pa.array(cat(0)), pa.array(cat(1))],
            names=["tile", "row", "slot", "vec_id", "score"])


def _search(answer, k: int):
    """Run ``answer(tile row, bucket, best)`` on every pair; a tile's best lists live while its pairs follow
    one another, and are given out as soon as another tile comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, best, buckets = None, _Best(k), {}
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(j)[i].as_py() for j, c in enumerate(b.schema.names)}
                if tile is not None and row["tile"] != tile:
                    yield best.rows(tile)
                    best = _Best(k)
                tile = row["tile"]
                answer(row, _Bucket(row), best)
        if tile is not None:
            yield best.rows(tile)

    return run


def _anchors(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "q_labels"))
    return ids, labels, np.frombuffer(row["q_data"], np.int32).reshape(row["q_n"], row["dim"])


def _positives(k: int):
    def answer(row: dict, bucket: _Bucket, best: _Best) -> None:
        ids, labels, data = _anchors(row)
        lower = dict(zip(row.get("rows") or (), row.get("bounds") or ()))
        for r in range(len(ids)):
            known = [x for x in (best.bound((r, 0)), lower.get(r)) if x is not None]
            rows, scores = bucket.scored(data[r], float(max(known)) if known else -math.inf)
            good = (bucket.labels[rows] == labels[r]) & (bucket.ids[rows] != ids[r])
            if good.any():
                best.add((r, 0), bucket.ids[rows[good]], scores[good])

    return answer


def _negatives(k: int, low: int, high: int):
    def answer(row: dict, bucket: _Bucket, best: _Best) -> None:
        ids, labels, data = _anchors(row)
        wanted: dict[int, list[tuple[int, int]]] = {}
        for r, slot, score in zip(row["rows"], row["slots"], row["bounds"]):
            wanted.setdefault(r, []).append((slot, score))
        for r, slots in wanted.items():
            floor = []
            for slot, score in slots:
                least, most = -(-low * score // 100), high * score // 100
                met = best.bound((r, slot))
                floor.append((slot, least if met is None else max(least, met), most))
            floor = [x for x in floor if x[1] <= x[2]]
            if not floor:
                continue
            rows, scores = bucket.scored(data[r], float(min(x[1] for x in floor)))
            other = (bucket.labels[rows] != labels[r]) & (bucket.ids[rows] != ids[r])
            rows, scores = rows[other], scores[other]
            for slot, least, most in floor:
                good = (scores >= least) & (scores <= most)
                if good.any():
                    best.add((r, slot), bucket.ids[rows[good]], scores[good])

    return answer


# ------------------------------------------------------------------ grid

def grid(buckets: int, tiles: int, pairs: int = PAIRS) -> tuple[int, int]:
    """(groups of buckets, groups of tiles): some ``pairs`` pairs a cell, and as little moved as
    can be, as a bucket is sent to each tile group and a tile to each bucket group."""
    cells = max(1, -(-buckets * tiles // pairs))
    of_buckets = min(buckets, max(1, round(math.sqrt(cells * buckets / max(1, tiles)))))
    return of_buckets, min(max(1, tiles), -(-cells // of_buckets))


def _met(buckets: DataFrame, tiles: DataFrame, sizes: tuple[int, int], bounds: DataFrame | None) -> DataFrame:
    """Each tile beside each bucket of its dimension; ``bounds``: tile, rows, slots, bounds."""
    gb, gt = sizes
    q = tiles.select("tile", "dim", *[F.col(c).alias(f"q_{c}") for c in ("n", "ids", "labels", "data")])
    if bounds is not None:
        q = q.join(bounds, "tile")
    left = q.withColumn("_gt", F.pmod(F.xxhash64("tile"), F.lit(gt))) \
        .withColumn("_gb", F.explode(F.sequence(F.lit(0), F.lit(gb - 1))))
    right = buckets.withColumn("_gb", F.pmod(F.xxhash64("bucket"), F.lit(gb)).cast("int")) \
        .withColumn("_gt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(gt - 1).cast("long"))))
    return left.join(right, ["_gb", "_gt", "dim"]).drop("_gb", "_gt")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("tile", "row", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
         low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, scale: float = SCALE,
         vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
         bucket: int = BUCKET, tile: int = TILE, pairs: int = PAIRS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row of
    ``anchors`` and each of its best rows of the same label in ``vectors``, the best
    rows of other labels whose score is in the positive's window."""
    names = {"vec_id": vec_id, "embedding": embedding, "label": label}
    buckets = written(quantised(vectors, scale, **names).repartitionByRange("len2", "id")
                      .sortWithinPartitions(F.desc("len2"), "id").select("id", "label", "v")
                      .mapInArrow(_packer(bucket, True), _BUCKETS))
    tiles = written(quantised(anchors, scale, **names).select("id", "label", "v").mapInArrow(_packer(tile, False), _TILES))
    n_buckets, n_tiles = buckets.count(), tiles.count()
    sizes = grid(max(1, n_buckets), max(1, n_tiles), pairs)

    def search(pairs_of: DataFrame, answer, k: int) -> DataFrame:
        return _top(pairs_of.mapInArrow(_search(answer, k), _FOUND), k)

    # a first lower bound for each anchor from one bucket of its dimension
    one = buckets.groupBy("dim").agg(F.max("bucket").alias("bucket"))
    seed = search(_met(buckets.join(one, ["dim", "bucket"], "left_semi"), tiles, (1, sizes[1]), None),
                  _positives(n_positives), n_positives)
    bounds = seed.filter(F.col("rank") == n_positives).groupBy("tile").agg(
        F.collect_list(F.struct("row", "score")).alias("_b")).select("tile", F.col("_b.row").alias("rows"), F.col("_b.score").alias("bounds"))
    bounds = written(tiles.select("tile").join(bounds, "tile", "left"))
    # at most n_positives rows an anchor, so a tile's lists are bounded
    positives = written(search(_met(buckets, tiles, sizes, bounds), _positives(n_positives), n_positives)
                        .select("tile", "row", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"),
                                F.col("score").alias("positive_score")))
    windows = positives.groupBy("tile").agg(F.collect_list(F.struct("row", "slot", "positive_score")).alias("_w")) \
        .select("tile", F.col("_w.row").alias("rows"), F.col("_w.slot").alias("slots"), F.col("_w.positive_score").alias("bounds"))
    negatives = search(_met(buckets, tiles, sizes, windows), _negatives(n_negatives, low_percent, high_percent), n_negatives)
    ids = tiles.mapInArrow(_tile_ids, "tile long, row int, anchor_id long")
    return negatives.join(positives, ["tile", "row", "slot"]).join(ids, ["tile", "row"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def _tile_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.select(["tile", "ids"]).to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), row["tile"], np.int64)), pa.array(np.arange(len(ids), dtype=np.int32)),
                 pa.array(ids)], names=["tile", "row", "anchor_id"])


ORACLE = f"""
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % {ANCHOR_MOD} = 0
    ), p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {N_POSITIVES}
    )
    SELECT p.anchor_id, p.positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
           s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND {LOW_PERCENT} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH_PERCENT} * p.positive_score
    QUALIFY rank <= {N_NEGATIVES}"""
