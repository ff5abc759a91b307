"""Ad-click log: text lines in, typed rows out.

A line is ``<epoch millis> <area> <city> <user> <ad>``. Lines that do not
split into five fields, whose time is not a number of milliseconds up to the year
9999 (so no seconds' fractions or overflow), and null lines are routed to a reject
set instead of failing the job (the original throws on them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ADS_COLUMNS = ["ts", "day", "area", "city", "user_id", "ads_id"]


# Fixed format of a log line: epoch millis and four non-empty fields, one blank apart.
LINE_PATTERN = r"^[0-9]{1,18} [^ ]+ [^ ]+ [^ ]+ [^ ]+$"
MAX_MILLIS = 253_402_300_799_999  # the last millisecond of the year 9999


def parse_lines(lines: DataFrame, line_col: str = "line", keep_rejects: bool = False) -> DataFrame:
    """Parse log lines; with ``keep_rejects`` an ``ok`` flag is kept instead of filtering.

    One anchored regex validates the whole line before it is split once, so
    the filter never re-splits (and at most 18 digits always fit a bigint).
    Every line is either parsed or rejected, null ones as well. With ``keep_rejects`` the
    time a line arrived is kept where the source knows it.
    """
    millis = F.substring_index(F.col(line_col), " ", 1).try_cast("bigint")
    ok = F.coalesce(F.col(line_col).rlike(LINE_PATTERN) & (millis <= MAX_MILLIS), F.lit(False))
    more = ["arrival"] if keep_rejects and "arrival" in lines.columns else []
    src = lines.select(F.col(line_col).alias("line"), ok.alias("ok"), *more)
    if not keep_rejects:
        src = src.filter("ok")
    parts = F.split(F.col("line"), " ")
    # behind the filter every line is good; asking again would match each twice
    split = src.select("line", "ok", *more, (F.when(F.col("ok"), parts) if keep_rejects else parts).alias("_p"))
    p = F.col("_p")
    ts = F.timestamp_millis(p.getItem(0).cast("bigint"))
    out = split.select(
        ts.alias("ts"), F.date_format(ts, "yyyy-MM-dd").alias("day"),
        p.getItem(1).alias("area"), p.getItem(2).alias("city"),
        p.getItem(3).alias("user_id"), p.getItem(4).alias("ads_id"),
        "ok", "line", *more,
    )
    return out if keep_rejects else out.select(*ADS_COLUMNS)


def rejected_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines that do not parse (kept for inspection instead of failing the job)."""
    return parse_lines(lines, line_col, keep_rejects=True).filter(~F.col("ok")).select("line")


def kafka_lines(spark: SparkSession, servers: str, topic: str = "ads_log",
                starting_offsets: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """Streaming source on a Kafka topic (needs the spark-sql-kafka package): line and arrival.

    Offsets are tracked in the query checkpoint, not auto-committed; ``max_per_trigger``
    limits the records of a micro-batch.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
    return reader.load().selectExpr("CAST(value AS STRING) AS line", "timestamp AS arrival")


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source over a folder of text files, one log line per row: line and
    arrival (the time its file was written)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("value").alias("line"), F.col("_metadata.file_modification_time").alias("arrival"))
