"""Input tables: the behaviour log and its three dimensions.

Two ways in:

* :func:`from_catalog` reads the tables by name (Hive/Unity/... catalog), the
  way the original application reads them (optional ``use <db>``).
* :func:`from_testdata` derives the same schemas from the driver's generated
  parquet tables (``events``, ``customer``, ``part``, ``nation``, ``region``);
  the rules are listed in FIXTURES.md section 2.

Either way the result is lazy: column pruning and filters reach the scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ACTION_COLUMNS = [
    "date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids", "city_id", "event_id",
]

# Fixed values of the fixture adapter (FIXTURES.md section 2).
EVENT_KIND = {"view": "search", "signup": "order", "purchase": "pay", "click": "click", "error": "click"}
PAGES_IN_FIXTURE = 10
CATEGORY_MOD = 20
PRODUCT_MOD = 100
CITY_MOD = 25
KEYWORD_MOD = 6
ORDER_CATEGORY_STEP = 7
ORDER_PRODUCT_STEP = 31
MAX_LIST_LEN = 5
MAX_PRODUCT_LIST_LEN = 3
ADS_PER_FIXTURE = 6


class Tables:
    """The four input tables, each opened only when first used."""

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        self._loaders = loaders
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loaders[name]()
        return self._cache[name]

    user_visit_action = property(lambda self: self._get("user_visit_action"))
    user_info = property(lambda self: self._get("user_info"))
    product_info = property(lambda self: self._get("product_info"))
    city_info = property(lambda self: self._get("city_info"))


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# catalog tables
# --------------------------------------------------------------------------

def from_catalog(spark: SparkSession, database: str | None = None) -> Tables:
    """Read ``user_visit_action``, ``user_info``, ``product_info``, ``city_info``.

    ``action_time`` is stored as ``yyyy-MM-dd HH:mm:ss`` text there; it is parsed
    to ``timestamp_ntz`` and a deterministic row id is added as tie-break.
    """
    prefix = f"{database}." if database else ""
    return Tables({
        "user_visit_action": lambda: normalize_actions(spark.table(f"{prefix}user_visit_action")),
        "user_info": lambda: spark.table(f"{prefix}user_info"),
        "product_info": lambda: spark.table(f"{prefix}product_info"),
        "city_info": lambda: spark.table(f"{prefix}city_info"),
    })


def normalize_actions(uva: DataFrame) -> DataFrame:
    """Catalog actions to the common schema: typed time, a row id as tie-break."""
    cols = set(uva.columns)
    out = uva
    if dict(uva.dtypes).get("action_time") == "string":
        out = out.withColumn("action_time", F.to_timestamp_ntz("action_time"))
    if "event_id" not in cols:
        # stable tie-break for equal action times, independent of partitioning
        out = out.withColumn("event_id", F.xxhash64(*[F.col(c) for c in uva.columns]))
    return out.select(*ACTION_COLUMNS)


# --------------------------------------------------------------------------
# fixture adapter over the driver tables
# --------------------------------------------------------------------------

def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _id_list(kind_col: Column, kind: str, k: Column, n: Column, mod: int, step: int, max_len: int) -> Column:
    # concat_ws skips nulls: term j exists only while j < n
    terms = [F.when(n > j, ((k + step * j) % mod + 1).cast("string")) for j in range(max_len)]
    return F.when(kind_col == kind, F.concat_ws(",", *terms))


def day_range_on_ts(events: DataFrame, first_day: str | None, last_day: str | None) -> DataFrame:
    """The inclusive day range as a raw ``ts`` range, so the parquet scan can
    skip row groups (the derived ``date`` column cannot be pushed down)."""
    if first_day is not None:
        events = events.filter(F.col("ts") >= F.to_timestamp_ntz(F.lit(first_day)))
    if last_day is not None:
        events = events.filter(F.col("ts") < F.date_add(F.to_date(F.lit(last_day)), 1).cast("timestamp_ntz"))
    return events


def events_as_actions(events: DataFrame) -> DataFrame:
    """``events`` -> ``user_visit_action`` (one session per user and day)."""
    kind_map = F.create_map(*[F.lit(x) for kv in EVENT_KIND.items() for x in kv])
    ev = events.select(
        "event_id", "user_id", "ts",
        kind_map[F.col("event_type")].alias("kind"),
        _k().alias("k"),
        (F.col("event_id") % MAX_LIST_LEN + 1).alias("n"),
    )
    day = F.date_format("ts", "yyyy-MM-dd")
    k, n, kind = F.col("k"), F.col("n"), F.col("kind")
    n_products = F.least(n, F.lit(MAX_PRODUCT_LIST_LEN))
    return ev.select(
        day.alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("session_id"),
        (k % PAGES_IN_FIXTURE + 1).alias("page_id"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("action_time"),
        F.when(kind == "search", F.concat(F.lit("kw"), (k % KEYWORD_MOD).cast("string"))).alias("search_keyword"),
        F.when(kind == "click", k % CATEGORY_MOD + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(kind == "click", k + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        _id_list(kind, "order", k, n, CATEGORY_MOD, ORDER_CATEGORY_STEP, MAX_LIST_LEN).alias("order_category_ids"),
        _id_list(kind, "order", k, n_products, PRODUCT_MOD, ORDER_PRODUCT_STEP, MAX_PRODUCT_LIST_LEN).alias("order_product_ids"),
        _id_list(kind, "pay", k, n, CATEGORY_MOD, ORDER_CATEGORY_STEP, MAX_LIST_LEN).alias("pay_category_ids"),
        _id_list(kind, "pay", k, n_products, PRODUCT_MOD, ORDER_PRODUCT_STEP, MAX_PRODUCT_LIST_LEN).alias("pay_product_ids"),
        (F.col("event_id") % CITY_MOD + 1).alias("city_id"),
        F.col("event_id"),
    )


def customers_as_users(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + key % 50).alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(key % 5 < 3, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
    )


def parts_as_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("extend_info"),
    )


def nations_as_cities(nation: DataFrame, region: DataFrame) -> DataFrame:
    # region is a fixed 5-row table: broadcasting it is bounded by construction
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def from_testdata(spark: SparkSession, sf_dir: str,
                  day_range: tuple[str | None, str | None] = (None, None)) -> Tables:
    """Fixture tables; ``day_range`` (inclusive) prunes the events scan by time."""
    return Tables({
        "user_visit_action": lambda: events_as_actions(
            day_range_on_ts(read_parquet(spark, sf_dir, "events"), *day_range)),
        "user_info": lambda: customers_as_users(read_parquet(spark, sf_dir, "customer")),
        "product_info": lambda: parts_as_products(read_parquet(spark, sf_dir, "part")),
        "city_info": lambda: nations_as_cities(read_parquet(spark, sf_dir, "nation"),
                                               read_parquet(spark, sf_dir, "region")),
    })


def last_minutes_on_ts(events: DataFrame, minutes: int) -> DataFrame:
    """Rows of the newest ``minutes`` minutes as a raw ``ts`` range (a few rows more: whole
    minutes). The newest time is one value, read from one column before the plan is made."""
    newest = events.agg(F.max("ts")).first()[0]
    if newest is None:
        return events
    return events.filter(F.col("ts") >= F.lit(newest - dt.timedelta(minutes=minutes)).cast("timestamp_ntz"))


def ads_log_lines(spark: SparkSession, sf_dir: str, last_minutes: int | None = None) -> DataFrame:
    """Ad-click log lines ``<epoch ms> <area> <city> <user> <ad>`` from ``events``.

    City = nation ``event_id % 25``; blanks in names become ``-`` so that the
    line splits into exactly five fields. ``last_minutes`` prunes the scan to the newest rows.
    """
    events = read_parquet(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    if last_minutes is not None:
        events = last_minutes_on_ts(events, last_minutes)
    cities = nations_as_cities(read_parquet(spark, sf_dir, "nation"), read_parquet(spark, sf_dir, "region"))
    # cities is the 25-row nation table (fixed size in TPC-H): bounded broadcast
    joined = events.join(F.broadcast(cities), (F.col("event_id") % CITY_MOD + 1) == F.col("city_id"))
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))  # truncating, UTC session
    return joined.select(
        F.concat_ws(
            " ",
            ts_ms.cast("string"),
            F.translate("area", " ", "-"),
            F.translate("city_name", " ", "-"),
            F.col("user_id").cast("string"),
            (_k() % ADS_PER_FIXTURE + 1).cast("string"),
        ).alias("line")
    )
