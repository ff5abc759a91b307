"""Properties over generated rows and over the fixture tables."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01
from helpers import action, actions_df
from shoplens.operators import ads as ad
from shoplens.operators import pages as pg
from shoplens.operators import products as prod
from shoplens.operators import sessions as ses
from shoplens.params import PageFlow
from shoplens.plans import queries as Q

FLOW = PageFlow((1, 2, 3, 4))


def brute_force_jumps(rows):
    df = pd.DataFrame([(r[2], r[4], r[13], r[3]) for r in rows], columns=["s", "t", "id", "page"])
    df = df.sort_values(["s", "t", "id"])
    df["nxt"] = df.groupby("s")["page"].shift(-1)
    pairs = df.dropna(subset=["nxt"])
    mask = pd.Series([(a, int(b)) in FLOW.jumps for a, b in zip(pairs["page"], pairs["nxt"])],
                     index=pairs.index, dtype=bool)
    pairs = pairs.loc[mask]
    return {f"{a}_{int(b)}": n for (a, b), n in pairs.groupby(["page", "nxt"]).size().items()}


session_rows = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]), st.integers(0, 400), st.integers(1, 4)),
    # seconds 0-400: the hot session crosses minute borders and partition borders
    min_size=1, max_size=120)


@pytest.mark.parametrize("hot_rows", [1, 10**6])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=session_rows)
def test_jumps_equal_brute_force(spark, hot_rows, data):
    rows = [action(i, session=s, seconds=t, page=p) for i, (s, t, p) in enumerate(data)]
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # a hot session spans many range partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.page_jump: r.jump_count
               for r in pg.page_jump_counts(actions_df(spark, rows), FLOW, hot_rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_force_jumps(rows)


def test_ratio_buckets_cover_all_sessions(spark):
    s = ses.session_stats(Q.filtered(spark, SF01))
    r = s.agg(F.count_if(F.col("visit_length") <= 10).alias("le"), F.count_if(F.col("visit_length") > 10).alias("gt"),
              F.count_if(F.col("step_length") < 5).alias("s_le"), F.count_if(F.col("step_length") >= 5).alias("s_gt"),
              F.count(F.lit(1)).alias("n")).first()
    assert r.le + r.gt == r.n and r.s_le + r.s_gt == r.n
    st_ = ses.session_stat(s, "t", "{}").first()
    assert abs(st_.visit_length_le_10s_ratio + st_.visit_length_gt_10s_ratio - 100.0) <= 0.011


def test_sample_within_strata_without_duplicates(spark):
    a = Q.filtered(spark, SF01)
    sample = ses.session_sample(a, ses.session_stats(a), 1000, "t")
    quota = ses.session_hour_quota(ses.session_stats(a), 1000)
    assert sample.count() == sample.select("session_id").distinct().count()
    per_hour = sample.groupBy(F.substring("start_time", 1, 13).alias("day_hour")).count()
    bad = per_hour.join(quota, "day_hour").filter(F.col("count") != F.col("quota")).count()
    assert bad == 0
    assert quota.filter(F.col("quota") > F.col("hour_sessions")).count() == 0
    assert sample.count() <= 1000


def test_jumps_never_exceed_from_page_views(spark):
    a = Q.filtered(spark, SF01)
    j = pg.page_jumps(a, Q.FIXTURE.flow)
    v = pg.page_view_counts(a, Q.FIXTURE.flow).withColumnRenamed("page_id", "from_page")
    assert j.join(v, "from_page").filter(F.col("jump_count") > F.col("view_count")).count() == 0


def test_city_counts_sum_to_area_total(spark):
    t = Q.from_testdata(spark, SF01)
    remark = prod.area_product_city_remark(t.user_visit_action, t.city_info)
    clicks = prod.area_product_clicks(t.user_visit_action, t.city_info)
    joined = remark.join(clicks.withColumnRenamed("click_count", "c2"), ["area", "product_id"])
    assert joined.filter(F.col("click_count") != F.col("c2")).count() == 0
    assert joined.count() == remark.count() == clicks.count()


def test_kept_and_dropped_make_all(spark):
    parsed = Q.parsed_ads(spark, SF01)
    kept = ad.ads_filtered(parsed, 4, 3600)
    ban = ad.ads_blacklist(parsed, 4, 3600)
    dropped = ad.with_batch(parsed, 3600).join(ban, "user_id").filter(F.col("batch_id") > F.col("ban_batch"))
    assert kept.count() + dropped.count() == parsed.count()


def test_large_dimension_falls_back_to_shuffle_join(spark):
    """No hint is given: with Spark's own size-based broadcast off, the semi join is a shuffle join with the same result."""
    import contextlib
    import io

    from shoplens.operators import actions as act
    t = Q.from_testdata(spark, SF01)
    flt = Q.FIXTURE.actions
    small = act.filter_actions(t.user_visit_action, t.user_info, flt)
    want = sorted(r.event_id for r in small.select("event_id").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = act.filter_actions(t.user_visit_action, t.user_info, flt)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            large.explain()
        physical = buf.getvalue().split("== Physical Plan ==")[-1]
        assert "BroadcastHashJoin" not in physical and "SortMergeJoin" in physical
        assert sorted(r.event_id for r in large.select("event_id").collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
