"""Helpers shared by the corpus operators.

Row identity: operators that must name a single row (documents may repeat, or
have no id) and see the input once use ``with_uid`` (``monotonically_increasing_id``)
and write what they saw. Such a number holds for one pass only: how files are split, and
so the numbers, may change with the executors Spark has at that moment. Operators
that read the input again use ``with_row_id``, which says what the file says.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable_in_tasks(spark: SparkSession) -> None:
    """Python workers find the package where the driver found it (a local session,
    or an installation at the same place); an installed package needs nothing."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


@contextmanager
def freed_memory_kept(spark: SparkSession) -> Iterator[None]:
    """Python workers of the functions defined meanwhile keep up to 32 MB that they free for
    their next arrays (glibc's settings). By default the arrays of each step of a
    numpy loop go back to the system and are mapped and zeroed anew, page by page, for the next."""
    env = spark.sparkContext.environment
    before = dict(env)
    env.update(MALLOC_MMAP_THRESHOLD_=str(32 << 20), MALLOC_TRIM_THRESHOLD_=str(32 << 20))
    try:
        yield
    finally:
        for name in ("MALLOC_MMAP_THRESHOLD_", "MALLOC_TRIM_THRESHOLD_"):
            env.pop(name)
            if name in before:
                env[name] = before[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session;
    where that is unset, as in tests, a folder beside the warehouse tables."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    root = checkpoint_dir(spark, fallback=f"{warehouse.rstrip('/')}/_checkpoints")
    return f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def written(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is
    cut, every later pass sees the same rows, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Remove this application's intermediate tables (once its results are stored)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_uid(df: DataFrame, name: str = "_uid") -> DataFrame:
    """A number for each row, for one pass over ``df`` (see above)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` with an identity of each row that is the same in every pass: the row's
    place in its Parquet file where ``df`` is a scan of files, which costs no copy; any other
    input is numbered and written once, and that table is what is returned."""
    if df._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation":
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        try:
            return df.withColumn(name, place)
        except AnalysisException:  # files of a format without row places, or a column of that name
            pass
    return written(with_uid(df, name))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Where every character is one byte, ``lower`` is the
    same and far cheaper than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def id_crc32(name: str = "doc_id") -> Column:
    """crc32 of an id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def doc_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the named input columns, under internal names, so that any extra
    column of the input can share a name with one an operator makes."""
    importable_in_tasks(df.sparkSession)
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])
