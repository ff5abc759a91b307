"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring is ``cells`` equal pieces; each shard stands on it at many virtual nodes,
and a document's key (doc_id) hashes to a cell whose rows belong to the next
virtual node clockwise. A shard takes at most its share of rows (shares differ by
one at most and add up to all rows); what overflows a full shard continues
clockwise to the next shard with room. So counts are balanced exactly, and when
shards come or go only keys of their arcs and at the edge of full shards move.

Rows are counted per cell, and only these counts (``cells`` numbers at most, for
any input) reach the driver, which lays out which ranks of a cell go to which shard
and slot; that layout, bounded the same way, is broadcast back. A row's rank in its
cell comes from counts per (cell, input task) and a row number inside one, so even
one id on a third of all rows is numbered in many tasks.

DataFrame functions only. Defined results: a null text has no bytes (size 16, crc32
of the empty text); null ids share one cell; repeated rows are rows; no rows give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, with_uid, written

SHARDS, VIRTUAL_NODES, CELLS, SALTS, ROW_BYTES = 40, 100, 8192, 64, 16


def virtual_nodes(shards: int, per_shard: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. A shard's nodes do not depend
    on the number of shards."""
    nodes = []
    for s in range(shards):
        for v in range(per_shard):
            h = int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big")
            nodes.append((h % cells, h, s))
    return [(cell, s) for cell, _, s in sorted(nodes)]


def layout(counts: dict[int, int], shards: int, per_shard: int = VIRTUAL_NODES,
           cells: int = CELLS) -> list[tuple[int, int, int, int, int]]:
    """(cell, lo, hi, shard, slot): the ranks lo <= r < hi of a cell's rows go to that
    shard's slots from ``slot`` on."""
    nodes = virtual_nodes(shards, per_shard, cells)
    at = [cell for cell, _ in nodes]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    taken = [0] * shards
    out, over = [], []

    def take(cell: int, lo: int, hi: int, shard: int) -> int:
        n = min(hi - lo, room[shard])
        if n:
            out.append((cell, lo, lo + n, shard, taken[shard]))
            taken[shard] += n
            room[shard] -= n
        return lo + n

    for cell in sorted(counts):
        k = bisect_left(at, cell) % len(nodes)
        lo = take(cell, 0, counts[cell], nodes[k][1])
        if lo < counts[cell]:
            over.append((cell, lo, counts[cell], k))
    nearest = list(range(len(nodes)))  # first virtual node at or after k whose shard may have room

    def next_open(k: int) -> int:
        path = []
        while not room[nodes[k][1]]:
            path.append(k)
            k = (k + 1) % len(nodes) if nearest[k] == k else nearest[k]
        for p in path:
            nearest[p] = k
        return k

    for cell, lo, hi, k in over:
        while lo < hi:
            k = next_open(k)
            lo = take(cell, lo, hi, nodes[k][1])
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, per_shard: int = VIRTUAL_NODES,
                    cells: int = CELLS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = written(with_uid(doc_columns(docs, {"doc_id": "doc_id", "text": "text"})).select(
        "_uid", "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(cells)).cast("int").alias("cell"),
        # rows of one input task, so that a repeated id is numbered where it was read
        F.pmod(F.shiftrightunsigned("_uid", 33), F.lit(SALTS)).cast("int").alias("salt")))
    part = written(rows.groupBy("cell", "salt").agg(F.count(F.lit(1)).alias("n")))
    per_cell = {r["cell"]: r["n"] for r in part.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    plan = [dict(zip(("cell", "lo", "hi", "shard", "slot0"), x)) for x in layout(per_cell, shards, per_shard, cells)]
    plan = spark.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(plan)), "array<struct<cell:int,lo:bigint,hi:bigint,shard:int,slot0:bigint>>"))) \
        .withColumnRenamed("cell", "_cell")
    earlier = Window.partitionBy("cell").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # SALTS rows a cell
    part = part.select("cell", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("cell", "salt").orderBy("doc_id", "text_crc32", "_uid")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1).join(part, ["cell", "salt"]) \
        .withColumn("rank", F.col("rank") + F.col("first"))
    return ranked.join(F.broadcast(plan), (F.col("cell") == F.col("_cell")) & (F.col("rank") >= F.col("lo"))
                       & (F.col("rank") < F.col("hi"))) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("rank") - F.col("lo")).alias("slot"))
