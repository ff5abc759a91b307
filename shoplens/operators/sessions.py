"""Session roll-up (A1), session ratios (R1) and proportional sampling (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.core import fmt_ts, ordered_join, percent, seconds_between
from shoplens.operators.common import HOT_ROWS, bounded, split_hot, top_k_per_group
from shoplens.params import STEP_LIMIT, VISIT_SECONDS_LIMIT

ORDER = ("action_time", "event_id")
BROADCAST_PICKS = 100_000  # sampled sessions of some 100 bytes each: 10 MB


LISTS = ("search_keywords", "click_product_ids", "order_product_ids", "pay_product_ids")


def _list_aggs() -> list:
    return [
        ordered_join("search_keyword", *ORDER, none_if_empty=True).alias("search_keywords"),
        ordered_join(F.when(F.col("click_product_id") > 0, F.col("click_product_id")), *ORDER, none_if_empty=True).alias("click_product_ids"),
        ordered_join("order_product_ids", *ORDER, none_if_empty=True).alias("order_product_ids"),
        ordered_join("pay_product_ids", *ORDER, none_if_empty=True).alias("pay_product_ids"),
    ]


def _joined_pieces(pieces: DataFrame, keys: list[str], stats: list) -> DataFrame:
    """Sessions of their ordered pieces: each list's pieces that hold a value, in order."""
    merged = [
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("_piece", F.col(c).alias("v"))))),
            lambda x: x["v"]), ",").alias(c)
        for c in LISTS
    ]
    return pieces.groupBy(*keys).agg(*stats, *merged)


def _session_lists(actions: DataFrame, keys: list[str]) -> DataFrame:
    """The four ordered lists of a few picked sessions, by the minutes of each session:
    ordered inside the minute, then joined in minute order."""
    minute = F.date_trunc("minute", "action_time").alias("_piece")
    return _joined_pieces(actions.groupBy(*keys, minute).agg(*_list_aggs()), keys, [])


def _rolled_up(actions: DataFrame, hot_rows: int) -> DataFrame:
    """Stats and the four ordered lists of every session. A session of ordinary size is one
    group, whose rows travel once; one of more than ``hot_rows`` rows is ordered in pieces by
    as many tasks as it needs (``common.split_hot``), then its pieces are joined in order."""
    cold, hot = split_hot(actions, "session_id", ORDER, hot_rows)
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in LISTS]
    whole = cold.groupBy("session_id").agg(*_stat_aggs(), *_list_aggs()) \
        .select("session_id", "_start", "_end", "step_length", *texts)
    pieces = hot.groupBy("session_id", "_piece").agg(*_stat_aggs(), *_list_aggs())
    joined = _joined_pieces(pieces, ["session_id"], [
        F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("step_length").alias("step_length")])
    return whole.unionByName(joined)


def _stat_aggs() -> list:
    return [
        F.min("action_time").alias("_start"),
        F.max("action_time").alias("_end"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def _finish_stats(df: DataFrame, extra: list[str]) -> DataFrame:
    return df.select(
        "session_id",
        seconds_between("_start", "_end").alias("visit_length"),
        "step_length",
        fmt_ts("_start").alias("start_time"),
        *extra,
    )


def session_stats(actions: DataFrame) -> DataFrame:
    """Per session: visit_length (s), step_length, start_time.

    count/min/max aggregate partially on the map side, so even a session
    holding a large share of all rows is pre-reduced before the shuffle.
    """
    return _finish_stats(actions.groupBy("session_id").agg(*_stat_aggs()), [])


def session_info(actions: DataFrame, task_id: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full session roll-up with the four lists, ordered by (time, id)."""
    return _finish_stats(_rolled_up(actions, hot_rows), list(LISTS)).select(F.lit(task_id).alias("task_id"), "*")


def session_stat(sessions: DataFrame, task_id: str, conditions: str) -> DataFrame:
    """One row of session count and four ratios in percent (2 decimals).

    Buckets as coded in the original: visit <= 10 s vs > 10 s, steps < 5 vs >= 5.
    """
    v, s = F.col("visit_length"), F.col("step_length")
    counts = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_if(v <= VISIT_SECONDS_LIMIT).alias("_v_le"),
        F.count_if(v > VISIT_SECONDS_LIMIT).alias("_v_gt"),
        F.count_if(s < STEP_LIMIT).alias("_s_le"),
        F.count_if(s >= STEP_LIMIT).alias("_s_gt"),
    )
    n = F.col("session_count")
    return counts.select(
        F.lit(task_id).alias("task_id"),
        F.lit(conditions).alias("conditions"),
        n,
        percent("_v_le", n, 2).alias("visit_length_le_10s_ratio"),
        percent("_v_gt", n, 2).alias("visit_length_gt_10s_ratio"),
        percent("_s_le", n, 2).alias("step_length_le_5_ratio"),
        percent("_s_gt", n, 2).alias("step_length_gt_5_ratio"),
    )


def session_hour_quota(sessions: DataFrame, want: int) -> DataFrame:
    """Sessions per start hour and the hour's share of ``want``.

    Largest remainders: floor(n_hour * want / total) each, and the sessions still
    missing go one each to the hours of the largest remainders (ties: the earlier
    hour), so the quotas add up to min(want, total). The total is the sum of the hours,
    so the sessions are counted once; the windows see one row per start hour, however
    many sessions there are.
    """
    hours = sessions.groupBy(F.substring("start_time", 1, 13).alias("day_hour")) \
        .agg(F.count(F.lit(1)).alias("hour_sessions"))
    shares = hours.withColumn("total_sessions", F.sum("hour_sessions").over(Window.partitionBy())) \
        .withColumn("_floor", F.expr(f"least(hour_sessions, (hour_sessions * {int(want)}) div total_sessions)")) \
        .withColumn("_rest", F.expr(f"(hour_sessions * {int(want)}) % total_sessions"))
    missing = F.least(F.lit(int(want)).cast("bigint"), F.col("total_sessions")) - F.sum("_floor").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc("_rest"), F.asc("day_hour")))
    more = (place <= missing) & (F.col("_floor") < F.col("hour_sessions"))
    return shares.select("day_hour", "hour_sessions", "total_sessions",
                         (F.col("_floor") + more.cast("bigint")).alias("quota"))


def session_sample(actions: DataFrame, sessions: DataFrame, want: int, task_id: str) -> DataFrame:
    """R2: per start hour, the ``quota`` sessions first in md5(session_id) order.

    Deterministic stand-in for the random pick, without replacement. Every
    quota is <= want, so the window filter carries the literal bound ``want``
    as well and Spark keeps only that many rows per hour on each map task.
    Lists are built afterwards for the picked (<= want) sessions only.
    """
    # true of every session: it makes the hour counts use the same columns as the ranking,
    # so both are planned over one and the same roll-up and its shuffle is made once
    sessions = sessions.filter((F.col("step_length") > 0) & (F.coalesce("visit_length", F.lit(0)) >= 0))
    # one row per start hour: 24 per day of data, independent of the row count,
    # so the broadcast is bounded by the time span and the sessions never shuffle
    # for this join (the partial top-k then runs map-side even for a hot hour)
    quotas = bounded(session_hour_quota(sessions, want).select("day_hour", "quota"))
    keyed = sessions.withColumn("day_hour", F.substring("start_time", 1, 13))
    ranked = top_k_per_group(
        keyed.join(quotas, "day_hour"),
        ["day_hour"], [F.md5("session_id"), F.col("session_id")], want, rank_col="_rn",
    ).filter(F.col("_rn") <= F.col("quota"))
    picked = ranked.select("session_id", "visit_length", "step_length", "start_time")
    # the stats ride along into the list roll-up. There are at most ``want`` picks: up to
    # BROADCAST_PICKS of them go to every task, so that the other actions never shuffle; more
    # are joined as Spark decides
    if want <= BROADCAST_PICKS:
        picked = bounded(picked)
    keys = ["session_id", "visit_length", "step_length", "start_time"]
    return _session_lists(actions.join(picked, "session_id"), keys) \
        .select(F.lit(task_id).alias("task_id"), *keys, *LISTS)
