"""Query registry: every requirement as ``(spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables under ``sf_dir`` through the fixture
adapter and runs one operator (or requirement) over the whole input. The
parameters are the fixture test values (FIXTURES.md section 2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.core import fmt_ts
from shoplens.operators import actions as act
from shoplens.operators import ads as ad
from shoplens.operators import buyers as buy
from shoplens.operators import categories as cat
from shoplens.operators import pages as pg
from shoplens.operators import products as prod
from shoplens.operators import sessions as ses
from shoplens.params import ActionFilter, AdsParams, PageFlow, Params, SampleParams
from shoplens.sources.ads import parse_lines
from shoplens.sources.tables import ACTION_COLUMNS, ads_log_lines, from_testdata

# Fixed test parameters (FIXTURES.md section 2).
FIXTURE = Params(
    task_id="task-0",
    actions=ActionFilter(start_date="2024-01-05", end_date="2024-01-25", start_age=15, end_age=45),
    flow=PageFlow((1, 2, 3, 4, 5, 6, 7)),
    sample=SampleParams(size=1000),
    ads=AdsParams(ban_threshold=4, batch_seconds=3600, trend_minutes=60,
                  sliding_window="60 minutes", sliding_slide="10 seconds"),
    trace_date="2024-01-15",
)
PROFILE_FILTER = ActionFilter(professional="BUILDING", gender="M", city_id=7)

Builder = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- inputs

def filtered(spark: SparkSession, sf_dir: str, flt: ActionFilter | None = None) -> DataFrame:
    flt = flt or FIXTURE.actions
    t = from_testdata(spark, sf_dir, (flt.start_date, flt.end_date))
    return act.filter_actions(t.user_visit_action, t.user_info, flt)


def all_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_testdata(spark, sf_dir).user_visit_action


def parsed_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(ads_log_lines(spark, sf_dir))


def _action_rows(df: DataFrame) -> DataFrame:
    return df.select(*[fmt_ts(c).alias(c) if c == "action_time" else c for c in ACTION_COLUMNS])


def _ads_rows(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(F.unix_millis("ts").alias("ts_ms"), "day", "area", "city", "user_id", "ads_id", *extra)


def _p() -> Params:
    return FIXTURE


# ---------------------------------------------------------------- batch

def q_filtered_actions(spark, sf_dir):
    return _action_rows(filtered(spark, sf_dir))


def q_filtered_actions_by_profile(spark, sf_dir):
    return _action_rows(filtered(spark, sf_dir, PROFILE_FILTER))


def q_session_info(spark, sf_dir):
    return ses.session_info(filtered(spark, sf_dir), _p().task_id)


def q_session_stat(spark, sf_dir):
    p = _p()
    return ses.session_stat(ses.session_stats(filtered(spark, sf_dir)), p.task_id, p.actions.to_json())


def q_session_hour_quota(spark, sf_dir):
    return ses.session_hour_quota(ses.session_stats(filtered(spark, sf_dir)), _p().sample.size)


def q_session_sample(spark, sf_dir):
    a = filtered(spark, sf_dir)
    return ses.session_sample(a, ses.session_stats(a), _p().sample.size, _p().task_id)


def q_category_action_counts(spark, sf_dir):
    return cat.category_action_counts(filtered(spark, sf_dir))


def q_category_totals(spark, sf_dir):
    return cat.category_totals(filtered(spark, sf_dir))


def q_category_top10(spark, sf_dir):
    p = _p()
    return cat.category_top(filtered(spark, sf_dir), p.top_categories, p.task_id)


def q_category_session_clicks(spark, sf_dir):
    p = _p()
    a = filtered(spark, sf_dir)
    return cat.category_session_clicks(a, cat.category_top(a, p.top_categories, p.task_id))


def q_top_sessions_per_category(spark, sf_dir):
    p = _p()
    a = filtered(spark, sf_dir)
    top = cat.category_top(a, p.top_categories, p.task_id)
    return cat.top_sessions_per_category(a, top, p.sessions_per_category, p.task_id)


def q_page_view_counts(spark, sf_dir):
    return pg.page_view_counts(filtered(spark, sf_dir), _p().flow)


def q_page_jump_counts(spark, sf_dir):
    return pg.page_jump_counts(filtered(spark, sf_dir), _p().flow)


def q_page_convert_rate(spark, sf_dir):
    return pg.page_convert_rate(filtered(spark, sf_dir), _p().flow, _p().task_id)


def q_area_product_clicks(spark, sf_dir):
    t = from_testdata(spark, sf_dir)
    return prod.area_product_clicks(t.user_visit_action, t.city_info)


def q_area_product_city_remark(spark, sf_dir):
    t = from_testdata(spark, sf_dir)
    return prod.area_product_city_remark(t.user_visit_action, t.city_info, _p().other_label)


def q_area_top3_products(spark, sf_dir):
    t = from_testdata(spark, sf_dir)
    return prod.area_top_products(t.user_visit_action, t.city_info, _p().products_per_area, _p().other_label)


def q_hot_product_buyers(spark, sf_dir):
    a = filtered(spark, sf_dir)
    return buy.hot_product_buyers(a, buy.hot_products(a, _p().hot_products))


def q_hot_product_top_buyers(spark, sf_dir):
    a = filtered(spark, sf_dir)
    return buy.hot_product_top_buyers(a, buy.hot_products(a, _p().hot_products), _p().buyers_per_product)


def q_visit_trace(spark, sf_dir):
    p = _p()
    t = from_testdata(spark, sf_dir, (p.trace_date, p.trace_date))  # the visits: one day of the log
    visits = act.filter_actions(t.user_visit_action, t.user_info, p.actions)
    top = buy.top_buyers_in_one_pass(filtered(spark, sf_dir), p.hot_products, p.buyers_per_product)
    return buy.visit_trace(visits, top, t.product_info, t.user_info, p.trace_date)


# ---------------------------------------------------------------- ads

def _ads_p() -> AdsParams:
    return _p().ads


def _kept(spark, sf_dir):
    a = _ads_p()
    return ad.ads_filtered(parsed_ads(spark, sf_dir), a.ban_threshold, a.batch_seconds)


def _kept_counts(spark, sf_dir):
    a = _ads_p()
    return ad.kept_counts(parsed_ads(spark, sf_dir), a.ban_threshold, a.batch_seconds)


def q_ads_log_parsed(spark, sf_dir):
    return _ads_rows(parsed_ads(spark, sf_dir))


def q_user_ads_day_counts(spark, sf_dir):
    return ad.user_ads_day_counts(_kept_counts(spark, sf_dir))


def q_ads_blacklist(spark, sf_dir):
    a = _ads_p()
    return ad.ads_blacklist(parsed_ads(spark, sf_dir), a.ban_threshold, a.batch_seconds)


def q_ads_filtered(spark, sf_dir):
    return _ads_rows(_kept(spark, sf_dir), ("batch_id",))


def q_area_city_ads_day(spark, sf_dir):
    return ad.area_city_ads_day(_kept_counts(spark, sf_dir))


def q_area_ads_day(spark, sf_dir):
    return ad.area_ads_day(_kept_counts(spark, sf_dir))


def q_area_top3_ads(spark, sf_dir):
    return ad.area_top_ads(ad.area_ads_day(_kept_counts(spark, sf_dir)), _p().ads_per_area)


def q_area_top3_ads_json(spark, sf_dir):
    top = ad.area_top_ads(ad.area_ads_day(_kept_counts(spark, sf_dir)), _p().ads_per_area)
    return ad.area_top_ads_json(top)


def _recent_ads(spark, sf_dir):
    """The log's last minutes: the newest time comes from the ``ts`` column alone, and the
    range it gives reaches the scan before any line is made or parsed."""
    return parse_lines(ads_log_lines(spark, sf_dir, last_minutes=_ads_p().trend_minutes))


def q_last_hour_ads_minutes(spark, sf_dir):
    return ad.last_hour_ads_minutes(_recent_ads(spark, sf_dir), _ads_p().trend_minutes).drop("minute_ms")


def q_last_hour_ads_trend(spark, sf_dir):
    return ad.last_hour_ads_trend(ad.last_hour_ads_minutes(_recent_ads(spark, sf_dir), _ads_p().trend_minutes))


def q_ads_sliding_counts(spark, sf_dir):
    a = _ads_p()
    return ad.ads_sliding_counts(parsed_ads(spark, sf_dir), a.sliding_window, a.sliding_slide)


QUERIES: dict[str, Builder] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

