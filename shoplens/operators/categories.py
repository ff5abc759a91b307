"""R3 hot categories and R4 top sessions per hot category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.core import split_ids
from shoplens.operators.common import bounded, top_k_per_group

CLICK, ORDER, PAY = "click", "order", "pay"


def category_actions(actions: DataFrame) -> DataFrame:
    """One row per (category, action kind) occurrence.

    Precedence click > order > pay as in the original else-if chain; search
    rows have no category and drop out. Empty list parts are skipped.
    """
    click = F.col("click_category_id") > 0
    order = F.col("order_category_ids").isNotNull()
    pay = F.col("pay_category_ids").isNotNull()
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
           .when(order, split_ids("order_category_ids"))
           .when(pay, split_ids("pay_category_ids")))
    kind = F.when(click, F.lit(CLICK)).when(order, F.lit(ORDER)).when(pay, F.lit(PAY))
    # a malformed id part (not a number) is skipped like an empty one
    return actions.select(F.explode(ids).alias("_cid"), kind.alias("action")) \
        .select(F.col("_cid").try_cast("bigint").alias("category_id"), "action") \
        .filter(F.col("category_id").isNotNull())


def category_action_counts(actions: DataFrame) -> DataFrame:
    """A4: count per (category_id, action); partial aggregation map-side."""
    return category_actions(actions).groupBy("category_id", "action") \
        .agg(F.count(F.lit(1)).alias("action_count"))


def category_totals(actions: DataFrame) -> DataFrame:
    """A5: click/order/pay counts per category in columns, 0 when absent."""
    a = F.col("action")
    return category_actions(actions).groupBy("category_id").agg(
        F.count_if(a == CLICK).alias("click_count"),
        F.count_if(a == ORDER).alias("order_count"),
        F.count_if(a == PAY).alias("pay_count"),
    )


def category_top(actions: DataFrame, k: int, task_id: str) -> DataFrame:
    """O1: top k categories by clicks, then orders, then pays (desc), id asc.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: a per-partition
    top-k, never a full sort.
    """
    ranked = category_totals(actions).orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(k)
    return ranked.select(
        F.lit(task_id).alias("task_id"), "category_id", "click_count", "order_count", "pay_count",
    )


def category_session_clicks(actions: DataFrame, top: DataFrame) -> DataFrame:
    """A6 after F11/J3: clicks per (hot category, session).

    ``top`` has at most k rows (a top-k result), so broadcasting it is bounded.
    """
    hot = bounded(top.select(F.col("category_id").alias("click_category_id")))
    return actions.filter(F.col("click_category_id") > 0) \
        .join(hot, "click_category_id", "left_semi") \
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id") \
        .agg(F.count(F.lit(1)).alias("click_count"))


def top_sessions_per_category(actions: DataFrame, top: DataFrame, k: int, task_id: str) -> DataFrame:
    """The k sessions with most clicks per hot category (ties: session id)."""
    clicks = category_session_clicks(actions, top)
    ranked = top_k_per_group(clicks, ["category_id"], [F.desc("click_count"), F.asc("session_id")], k)
    return ranked.select(F.lit(task_id).alias("task_id"), "category_id", "session_id", "click_count", "rank")
