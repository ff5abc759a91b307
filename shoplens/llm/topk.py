"""Exact top-k inner products of a stated query set against all vectors.

Vectors are quantised to floor(scale * x), in the narrowest integers that hold them, and
packed into shard blocks and query tiles of fixed sizes. Blocks and tiles are dealt to the cells of
a grid: a cell has at most ``EDGE`` of each, so a block travels once for ``EDGE`` tiles, a
tile once for ``EDGE`` blocks, and a single tile still spreads over many cells. Every
(tile, block) pair of a cell is one matrix product with a partial selection of each
query's best k; the lists of a tile are then merged in a tree of fixed fan-in. No
task holds more than a cell's blocks and tiles and the scores of one pair, or ``FAN`` lists.
The driver gets one count for each task that packed blocks.

Defined results: vectors that are null or hold null or non-finite components, and
rows without id, take no part; only vectors of equal length meet; rows that share the
query's id are no candidates of it; ties go to the smaller vec_id; repeated candidate
rows are each a candidate; components are integers of at most 63 bits and scores
saturate at a long's range; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, written

SCALE, K, QUERY_MOD = 64, 20, 20
TILE, BLOCK, FAN, EDGE, CELLS = 512, 2048, 16, 16, 32
_PACKED = "block long, dim int, ids binary, data binary"
_LISTS = "tile long, part long, queries binary, ids binary, scores binary"
_LIST_SCHEMA = pa.schema([("tile", pa.int64()), ("part", pa.int64()), ("queries", pa.binary()), ("ids", pa.binary()),
                          ("scores", pa.binary())])
_NO_ID = np.iinfo(np.int64).max


def _narrow(x: np.ndarray) -> bytes:
    """The integers of ``x`` in as few bytes each as hold all of them."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    kind = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(kind).tobytes()


def _matrix(data: bytes, rows: int, dim: int) -> np.ndarray:
    size = len(data) // (rows * dim) if rows * dim else 8
    return np.frombuffer(data, f"<i{size}").reshape(rows, dim)


def _pack(rows: int, scale: float):
    """Quantised vectors in blocks of ``rows``, each ordered by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 24, 0
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids = np.concatenate([i for i, _ in held[dim]])
            data = np.concatenate([d for _, d in held[dim]])
            now, rest = np.split(np.arange(len(ids)), [rows])
            held[dim] = [(ids[rest], data[rest])] if len(rest) else []
            now = now[np.argsort(ids[now], kind="stable")]
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([ids[now].tobytes()], pa.binary()), pa.array([_narrow(data[now])], pa.binary())],
                names=["block", "dim", "ids", "data"])

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            vectors = b.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
            starts = vectors.offsets.to_numpy()[:-1]
            for dim in np.unique(lengths):
                pick = np.flatnonzero(lengths == dim)
                x = values[starts[pick][:, None] + np.arange(dim)[None, :]]
                x = np.clip(np.floor(scale * x), -2.0 ** 62, 2.0 ** 62).astype(np.int64)
                held.setdefault(int(dim), []).append((ids[pick], x))
                while sum(len(i) for i, _ in held[int(dim)]) >= rows:
                    yield block(int(dim))
        for dim in list(held):
            while held[dim]:
                yield block(dim)

    return run


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; exact in doubles where no sum can pass 2^53."""
    largest = [max(float(x.max(initial=0)), -float(x.min(initial=0))) for x in (q, c)]
    most = largest[0] * largest[1] * max(1, q.shape[1])
    if most < 2.0 ** 24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if most < 2.0 ** 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best (score descending, id ascending); unused places hold _NO_ID.
    Columns need no order; ids and valid have the shape of scores."""
    n = scores.shape[1]
    if n > 4 * k:
        # all columns that beat the k-th score, and of those that equal it the k smallest ids
        s = np.where(valid, scores, np.iinfo(np.int64).min)
        kth = -np.partition(-s, k - 1, axis=1)[:, k - 1:k] if (s > np.iinfo(np.int64).min).all() else \
            np.sort(s, axis=1)[:, n - k:n - k + 1]
        out_i, out_s = np.full((len(s), k), _NO_ID), np.zeros((len(s), k), np.int64)
        for r in range(len(s)):
            c = np.flatnonzero((s[r] >= kth[r]) & valid[r])
            c = c[np.lexsort((ids[r][c], -s[r][c]))][:k]
            out_i[r, :len(c)], out_s[r, :len(c)] = ids[r][c], s[r][c]
        return out_i, out_s
    out_i, out_s = np.full((len(scores), k), _NO_ID), np.zeros((len(scores), k), np.int64)
    for r in range(len(scores)):
        c = np.flatnonzero(valid[r])
        c = c[np.lexsort((ids[r][c], -scores[r][c]))][:k]
        out_i[r, :len(c)], out_s[r, :len(c)] = ids[r][c], scores[r][c]
    return out_i, out_s


def _search(k: int):
    """The lists of a cell: for each of its tiles the best of all its blocks."""
    def run(key: tuple, blocks: pa.Table, tiles: pa.Table) -> pa.Table:
        part, _, dim = (x.as_py() for x in key)
        out = []
        for t in tiles.to_pylist():
            qid = np.frombuffer(t["ids"], np.int64)
            q, found = _matrix(t["data"], len(qid), dim), []
            for ids, data in zip(blocks.column("ids"), blocks.column("data")):
                cid = np.frombuffer(ids.as_py(), np.int64)
                scores = _products(q, _matrix(data.as_py(), len(cid), dim))
                found.append(_best(scores, np.broadcast_to(cid, scores.shape), qid[:, None] != cid[None, :], k))
                if len(found) == FAN:
                    found = [_best_of(found, k)]
            if found:
                ids, scores = found[0] if len(found) == 1 else _best_of(found, k)
                out.append({"tile": t["tile"], "part": part, "queries": qid.tobytes(), "ids": ids.tobytes(),
                            "scores": scores.tobytes()})
        return pa.Table.from_pylist(out, schema=_LIST_SCHEMA)

    return run


def _best_of(lists: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, scores = (np.hstack(x) for x in zip(*lists))
    return _best(scores, ids, ids != _NO_ID, k)


def _merge(k: int):
    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        n = len(g["queries"].iloc[0]) // 8
        ids, scores = _best_of([tuple(np.frombuffer(x, np.int64).reshape(n, k) for x in pair)
                                for pair in zip(g["ids"], g["scores"])], k)
        return pd.DataFrame({"tile": [key[0]], "part": [key[1]], "queries": [g["queries"].iloc[0]],
                             "ids": [ids.tobytes()], "scores": [scores.tobytes()]})

    return run


def _unpack(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                q = np.frombuffer(row["queries"], np.int64)
                ids = np.frombuffer(row["ids"], np.int64).reshape(len(q), k)
                scores = np.frombuffer(row["scores"], np.int64).reshape(len(q), k)
                used = ids != _NO_ID
                rank = np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), ids.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.broadcast_to(q[:, None], ids.shape)[used]), pa.array(rank[used]),
                     pa.array(ids[used]), pa.array(scores[used])], names=["query_id", "rank", "vec_id", "score"])

    return run


def _numbered(packed: DataFrame) -> tuple[DataFrame, int]:
    """Blocks with numbers from 0 without gaps, and how many there are."""
    task = F.shiftright("block", 24)
    sizes = sorted(tuple(r) for r in packed.groupBy(task.alias("task")).agg(F.count(F.lit(1))).collect())
    before = [int(x) for x in np.cumsum([0, *(n for _, n in sizes)])]
    # one row for each task that packed
    starts = packed.sparkSession.createDataFrame([(t, b) for (t, _), b in zip(sizes, before)], "task long, before long")
    place = F.col("before") + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)) - 1
    return packed.withColumn("task", task).join(F.broadcast(starts), "task") \
        .select(place.alias("block"), "dim", "ids", "data"), before[-1]


def grid(blocks: int, tiles: int, edge: int = EDGE) -> tuple[int, int, int]:
    """Edge of a cell and the grid's cells along blocks and along tiles. Edges are less
    than ``edge`` only where there would be fewer than ``CELLS`` cells or so."""
    edge = max(1, min(edge, isqrt(blocks * tiles // CELLS)))
    return edge, max(1, -(-blocks // edge)), max(1, -(-tiles // edge))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: float = SCALE, vec_id: str = "vec_id",
          embedding: str = "embedding", tile: int = TILE, block: int = BLOCK, fan: int = FAN,
          edge: int = EDGE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k best rows of
    ``vectors``. Both have the columns ``vec_id`` and ``embedding``."""

    def packed(df: DataFrame, rows: int) -> tuple[DataFrame, int]:
        d = doc_columns(df, {"id": vec_id, "v": embedding}) \
            .select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return _numbered(written(d.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
                                 .mapInArrow(_pack(rows, scale), _PACKED)))

    (blocks, n_blocks), (tiles, n_tiles) = packed(vectors, block), packed(queries, tile)
    edge, across, down = grid(n_blocks, n_tiles, edge)
    # a block goes once to each cell of its column, a tile once to each cell of its row
    own, every = lambda n: F.expr(f"{n} div {edge}"), lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = blocks.select(own("block").alias("x"), every(down).alias("y"), "dim", "ids", "data")
    right = tiles.select(every(across).alias("x"), own("block").alias("y"), "dim", F.col("block").alias("tile"), "ids", "data")
    cell = ["x", "y", "dim"]
    lists = written(left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_search(k), _LISTS))
    while across > 1:
        across = -(-across // fan)
        lists = written(lists.withColumn("part", F.expr(f"part div {fan}"))
                        .groupBy("tile", "part").applyInPandas(_merge(k), _LISTS))
    return lists.mapInArrow(_unpack(k), "query_id long, rank int, vec_id long, score long")
