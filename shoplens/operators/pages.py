"""Page views, page-to-page jumps inside sessions and conversion rates.

The jump of an action is (its page, the page of the session's next action
in (time, id) order). A session of ordinary size is one window group, and its rows travel
once. A session of more than ``hot_rows`` rows is cut into pieces (see
``common.split_hot``), each of which gives a *run*: its first and last page and its counts of
target jumps and views. Runs add up, and two runs that follow one another add the jump from
the last page of the one to the first page of the other; a window over the runs of each hot session,
as many as it has pieces, adds those. Everything stays on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.core import percent
from shoplens.operators.common import HOT_ROWS, split_hot
from shoplens.params import PageFlow

ORDER = ("action_time", "event_id")


def _distinct_jumps(flow: PageFlow) -> list[tuple[int, int]]:
    return list(dict.fromkeys(flow.jumps))


def _distinct_from_pages(flow: PageFlow) -> list[int]:
    return list(dict.fromkeys(flow.from_pages))


def _run_totals(actions: DataFrame, flow: PageFlow, with_views: bool, hot_rows: int) -> DataFrame:
    """One row: ``_j<i>`` = count of the i-th distinct target jump, ``_v<k>`` =
    views of the k-th distinct from-page."""
    jumps, views = _distinct_jumps(flow), (_distinct_from_pages(flow) if with_views else [])
    page, to = F.col("page_id"), F.col("_to")
    names = [*(f"_j{i}" for i in range(len(jumps))), *(f"_v{i}" for i in range(len(views)))]

    def linked(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.withColumn("_to", F.lead("page_id").over(Window.partitionBy(*keys).orderBy(*ORDER)))

    def counts() -> list[Column]:
        return [*(F.count_if((page == a) & (to == b)).alias(f"_j{i}") for i, (a, b) in enumerate(jumps)),
                *(F.count_if(page == v).alias(f"_v{i}") for i, v in enumerate(views))]

    cold, hot = split_hot(actions.select("session_id", *ORDER, "page_id"), "session_id", ORDER, hot_rows)
    whole = linked(cold, "session_id").agg(*counts())
    runs = linked(hot, "session_id", "_piece").groupBy("session_id", "_piece").agg(
        F.min_by("page_id", F.struct(*ORDER)).alias("_first"), F.max_by("page_id", F.struct(*ORDER)).alias("_last"), *counts())
    after = F.lead("_first").over(Window.partitionBy("session_id").orderBy("_piece"))
    joints = runs.withColumn("_next", after).agg(
        *[(F.sum(f"_j{i}") + F.count_if((F.col("_last") == a) & (F.col("_next") == b))).alias(f"_j{i}")
          for i, (a, b) in enumerate(jumps)],
        *[F.sum(f"_v{i}").alias(f"_v{i}") for i in range(len(views))])
    return whole.unionByName(joints).agg(*[F.sum(n).alias(n) for n in names])


def page_jumps(actions: DataFrame, flow: PageFlow, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(from_page, to_page, jump_count) for the flow's target jumps that occur."""
    each = F.array(*[F.struct(F.lit(a).cast("bigint").alias("from_page"), F.lit(b).cast("bigint").alias("to_page"),
                              F.col(f"_j{i}").alias("jump_count")) for i, (a, b) in enumerate(_distinct_jumps(flow))])
    return _run_totals(actions, flow, False, hot_rows).select(F.inline(each)).filter(F.col("jump_count") > 0)


def page_jump_counts(actions: DataFrame, flow: PageFlow, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Count per target jump, labelled ``from_to``."""
    return page_jumps(actions, flow, hot_rows).select(F.concat_ws("_", "from_page", "to_page").alias("page_jump"), "jump_count")


def page_view_counts(actions: DataFrame, flow: PageFlow) -> DataFrame:
    """Views of each from-page of the flow (all flow pages but the last)."""
    return actions.filter(F.col("page_id").isin(list(flow.from_pages))) \
        .groupBy("page_id").agg(F.count(F.lit(1)).alias("view_count"))


def page_convert_rate(actions: DataFrame, flow: PageFlow, task_id: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Jumps / views of the from-page, percent with one decimal. One row holds every jump
    count and every from-page's views; jumps that never occur give no row."""
    view_of = {page: k for k, page in enumerate(_distinct_from_pages(flow))}
    rates = F.array(*[F.struct(F.lit(f"{a}_{b}").alias("page_jump"), F.col(f"_j{i}").alias("n"),
                               F.col(f"_v{view_of[a]}").alias("view_count"))
                      for i, (a, b) in enumerate(_distinct_jumps(flow))])
    return _run_totals(actions, flow, True, hot_rows).select(F.inline(rates)).filter(F.col("n") > 0).select(
        F.lit(task_id).alias("task_id"), "page_jump", percent("n", "view_count", 1).alias("rate"))
