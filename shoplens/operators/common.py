"""Shared plan helpers: bounded broadcasts and top-k per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (a top-k result,
    a parameter list): the bound is the k of the producing operator."""
    return F.broadcast(df)


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per group.

    With a literal k Spark plans ``WindowGroupLimit``: each map task keeps only
    its own top k per group before the shuffle, so a hot group ships at most
    k rows per map task and never gathers whole in one task.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= F.lit(k))
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


HOT_ROWS = 1_000_000


def split_hot(df: DataFrame, key: str, order: tuple[str, ...], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows of keys with at most ``hot_rows`` rows, and the rest with ``_piece``,
    which numbers stretches of a key's rows in ``order``.

    Pieces are Spark's range partitions on (key, order), which it cuts from a sample of
    the rows: a hot key spans as many as its rows need, also where all of them
    fall in one minute or second. Where no key is hot, AQE finds the list of hot keys
    empty and drops the second part. The list has at most rows / ``hot_rows`` keys.
    """
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > F.lit(hot_rows)).select(key)
    cold = df.join(hot, key, "left_anti")
    pieces = df.join(hot, key, "left_semi").repartitionByRange(key, *order).withColumn("_piece", F.spark_partition_id())
    return cold, pieces
