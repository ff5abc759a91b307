"""Sinks (K1-K5): result tables, JDBC, managed tables and views. The keyed tables of the
stream (K6-K10) are in ``streaming.versions``.

All writers take a DataFrame and write it from the executors; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, mode: str = "append", **options: str) -> None:
    """K1: append a result to a JDBC table (one connection per partition)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def write_result(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
                 fmt: str = "parquet") -> None:
    """K2 with a file table: same writer, one folder per requirement."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_run(df: DataFrame, path: str, task_id: str) -> None:
    """K2, repeatable: the rows of one run, in place of those the same run wrote before.
    A run is a partition ``run=run-<task id>`` (so readers never take an id for a number);
    others stay as they are. Spark moves the new files in when all tasks are done."""
    df.withColumn("run", F.lit(f"run-{task_id}")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def replace_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """K3: drop-and-create of a managed table, as one overwrite."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K5: temp view that can be re-registered on a second run."""
    df.createOrReplaceTempView(name)
    return df


def use_database(spark: SparkSession, database: str | None) -> None:
    """Optional ``use <db>``."""
    if database:
        spark.catalog.setCurrentDatabase(database)
