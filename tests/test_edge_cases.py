"""Cases that the fixtures do not reach: sparse hours, odd lines, empty strings, midnight."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shoplens.operators import ads as ad
from shoplens.operators import sessions as ses
from shoplens.params import ActionFilter, Params
from shoplens.plans.jobs import _params
from shoplens.sources.ads import parse_lines, rejected_lines


def _sessions(spark, per_hour):
    rows = [(f"s{h}-{i}", 1, 1, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00") for h, n in enumerate(per_hour) for i in range(n)]
    return spark.createDataFrame(rows, "session_id string, visit_length long, step_length long, start_time string")


def test_quotas_add_up_however_sparse_the_hours(spark):
    for per_hour, want in (([1] * 60, 50), ([3, 1, 7], 5), ([2, 2], 100), ([5, 5, 5], 1), ([1, 1000], 10)):
        got = {r.day_hour: r for r in ses.session_hour_quota(_sessions(spark, per_hour), want).collect()}
        assert sum(r.quota for r in got.values()) == min(want, sum(per_hour))
        for r in got.values():
            share = r.hour_sessions * min(want, sum(per_hour)) / sum(per_hour)
            assert 0 <= r.quota <= r.hour_sessions and abs(r.quota - share) < 1


def test_every_line_is_parsed_or_rejected(spark):
    lines = ["1700000000000 A C u 1", "999999999999999999 A C u 1", "1700000000000000 A C u 1", None, "", "x A C u 1",
             "253402300799999 A C u 1", "253402300800000 A C u 1", "1700000000000 A C u", "-5 A C u 1"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert parse_lines(df).count() == 2
    assert sorted(str(r.line) for r in rejected_lines(df).collect()) == sorted(str(x) for x in lines if lines.index(x) not in (0, 6))


def test_empty_strings_stay_in_session_lists(spark):
    at = dt.datetime(2024, 1, 1, 10, 0, 0)
    for seconds in (5, 120):
        rows = [("s", at, 1, ""), ("s", at + dt.timedelta(seconds=seconds), 2, "a"), ("t", at, 3, None)]
        a = spark.createDataFrame(rows, "session_id string, action_time timestamp, event_id long, search_keyword string") \
            .withColumns({"click_product_id": F.lit(None).cast("long"), "order_product_ids": F.lit(None).cast("string"),
                          "pay_product_ids": F.lit(None).cast("string")})
        got = {r.session_id: r.search_keywords for r in ses.session_info(a, "t").collect()}
        assert got == {"s": ",a", "t": ""}


def test_trend_is_in_time_order_over_midnight(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 55), "1"), (dt.datetime(2024, 1, 2, 0, 5), "1"), (dt.datetime(2024, 1, 2, 0, 5), "1")]
    clicks = spark.createDataFrame(rows, "ts timestamp, ads_id string")
    (r,) = ad.last_hour_ads_trend(ad.last_hour_ads_minutes(clicks)).collect()
    assert r.trend_json == '[{"23:55":1},{"00:05":2}]'


def test_condition_object_holds_the_page_flow():
    text = '{"startAge":"15","targetPageFlow":"3,4"}'
    p = Params.from_json(text)
    assert p.flow.jump_labels == ["3_4"] and p.actions == ActionFilter(start_age=15) and p.conditions_text() == text
    assert Params.from_json("").flow == Params().flow

    class Options:
        pass

    one, two = _params(Options()), _params(Options())
    assert one.task_id != two.task_id


def test_bans_need_no_window_over_other_users(spark):
    at = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(at + dt.timedelta(seconds=2 * i), "2024-01-01", "A", "C", "hot", "1") for i in range(12)]
    rows += [(at, "2024-01-01", "A", "C", f"u{i}", "1") for i in range(30)]
    clicks = spark.createDataFrame(rows, "ts timestamp, day string, area string, city string, user_id string, ads_id string")
    assert [r.user_id for r in ad.ban_candidates(clicks, 5).collect()] == ["hot"]
    kept = ad.ads_filtered(clicks, 5, 5)
    assert kept.filter("user_id = 'hot'").count() == 5 and kept.count() == 35
    assert ad.area_city_ads_day(ad.kept_counts(clicks, 5, 5)).first().click_count == 35
