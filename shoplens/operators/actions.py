"""The filtered action set (actions of known users matching the conditions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.params import ActionFilter


def _all(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def action_predicates(flt: ActionFilter) -> list[Column]:
    preds = []
    if flt.start_date is not None:
        preds.append(F.col("date") >= F.lit(flt.start_date))
    if flt.end_date is not None:
        preds.append(F.col("date") <= F.lit(flt.end_date))
    if flt.city_id is not None:
        preds.append(F.col("city_id") == F.lit(flt.city_id))
    return preds


def user_predicates(flt: ActionFilter) -> list[Column]:
    preds = []
    if flt.start_age is not None:
        preds.append(F.col("age") >= F.lit(flt.start_age))
    if flt.end_age is not None:
        preds.append(F.col("age") <= F.lit(flt.end_age))
    if flt.professional is not None:
        preds.append(F.col("professional") == F.lit(flt.professional))
    if flt.gender is not None:
        preds.append(F.col("gender") == F.lit(flt.gender))
    return preds


def filter_actions(actions: DataFrame, users: DataFrame, flt: ActionFilter) -> DataFrame:
    """Actions joined with their user, all given conjuncts applied.

    ``user_id`` is the key of ``user_info``, so the inner join that keeps only
    action columns is a left-semi join: no user columns travel, no fan-out.
    The user side is reduced to matching ids first; Spark's byte threshold and
    AQE choose the join.
    """
    a_pred = _all(action_predicates(flt))
    if a_pred is not None:
        actions = actions.filter(a_pred)
    u = users
    u_pred = _all(user_predicates(flt))
    if u_pred is not None:
        u = u.filter(u_pred)
    ids = u.select("user_id")
    return actions.join(ids, "user_id", "left_semi")
