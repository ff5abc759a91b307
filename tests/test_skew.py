"""Hot keys: one session / user holding a third of all rows.

Checks that results stay exact and that the hot group is split over tasks
where the operator claims so; the feedback-loop closed form is checked
against a batch-by-batch simulation of the original loop.
"""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators import ads as ad
from shoplens.operators import pages as pg
from shoplens.operators import sessions as ses
from shoplens.operators.common import split_hot
from shoplens.params import PageFlow

N = 30_000
FLOW = PageFlow((1, 2, 3, 4, 5, 6, 7))


def hot_actions(spark):
    """Every third row belongs to session 'hot'; the rest to 1,000 small sessions."""
    i = F.col("id")
    hot = (i % 3) == 0
    t = F.timestamp_seconds(F.lit(1704067200) + (i * 7) % 86_400).cast("timestamp_ntz")
    return spark.range(N).select(
        F.lit("2024-01-01").alias("date"),
        F.when(hot, F.lit(1)).otherwise(i % 1000 + 2).cast("bigint").alias("user_id"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 1000).cast("string"))).alias("session_id"),
        ((i * 13) % 7 + 1).alias("page_id"),
        t.alias("action_time"),
        F.when(i % 5 == 0, F.concat(F.lit("kw"), (i % 6).cast("string"))).alias("search_keyword"),
        F.when(i % 5 == 1, i % 20 + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(i % 5 == 1, i % 100 + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.lit(None).cast("string").alias("order_category_ids"),
        F.when(i % 5 == 2, (i % 100 + 1).cast("string")).alias("order_product_ids"),
        F.lit(None).cast("string").alias("pay_category_ids"),
        F.when(i % 5 == 3, (i % 100 + 1).cast("string")).alias("pay_product_ids"),
        (i % 25 + 1).alias("city_id"),
        i.alias("event_id"),
    )


def test_hot_session_is_split_into_pieces(spark):
    """Also when all its rows fall in one second."""
    a = hot_actions(spark).select("session_id", "event_id", F.when(
        F.col("session_id") == "hot", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")).otherwise(F.col("action_time")).alias("action_time"))
    cold, hot = split_hot(a, "session_id", ("action_time", "event_id"), 1000)
    assert cold.filter("session_id = 'hot'").isEmpty() and cold.count() + hot.count() == N
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small test pieces
    try:
        per = hot.groupBy("_piece").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("a"), F.max("event_id").alias("z")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per = sorted(per, key=lambda r: r["_piece"])
    assert len(per) >= 4 and max(r.n for r in per) < N / 8   # a third of the rows, spread over many tasks
    assert all(x.z < y.a for x, y in zip(per, per[1:]))      # pieces follow one another


@pytest.mark.parametrize("hot_rows", [1, 20, 10**6])
def test_jumps_with_hot_session_equal_window_lead(spark, hot_rows):
    a = hot_actions(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r.page_jump: r.jump_count for r in pg.page_jump_counts(a, FLOW, hot_rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    lead = a.select(F.concat_ws("_", "page_id", F.lead("page_id").over(w)).alias("j"))
    want = {r.j: r["count"] for r in lead.filter(F.col("j").isin(FLOW.jump_labels)).groupBy("j").count().collect()}
    assert got == want and sum(got.values()) > 0


def test_without_hot_sessions_rows_travel_once(spark):
    """AQE drops the pieces, and no second window over the session is left."""
    df = pg.page_jump_counts(hot_actions(spark), FLOW)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Window [") - final.count("EmptyRelation Window [") == 1  # the other was never run
    assert "rangepartitioning" not in final and "MapInPandas" not in final


@pytest.mark.parametrize("hot_rows", [1, 1000, 10**6])
def test_lists_in_pieces_equal_one_ordered_list(spark, hot_rows):
    a = hot_actions(spark)
    got = ses.session_info(a, "t", hot_rows)
    # one-level reference: every element of the session ordered at once
    order = F.struct("action_time", "event_id")
    one = a.groupBy("session_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("search_keyword").isNotNull(), F.struct(order.alias("o"), F.col("search_keyword").alias("v"))))),
            lambda x: x["v"]), ",").alias("kw"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("pay_product_ids").isNotNull(), F.struct(order.alias("o"), F.col("pay_product_ids").alias("v"))))),
            lambda x: x["v"]), ",").alias("pay"),
        F.count(F.lit(1)).alias("n"))
    joined = got.join(one, "session_id")
    assert joined.count() == 1001
    bad = joined.filter((F.col("search_keywords") != F.col("kw")) | (F.col("pay_product_ids") != F.col("pay"))
                        | (F.col("step_length") != F.col("n")))
    assert bad.count() == 0
    hot = joined.filter(F.col("session_id") == "hot").first()
    assert hot.step_length == N // 3 and len(hot.search_keywords.split(",")) > 1000


# --------------------------------------------------------------- feedback loop

def simulate_loop(rows: pd.DataFrame, threshold: int, batch_ms: int) -> pd.DataFrame:
    """The original loop, batch by batch: snapshot the blacklist, drop its
    users, count every kept row per (day, user, ad) and ban on reaching the
    threshold (the ban applies from the next batch on)."""
    rows = rows.assign(batch=rows["ms"] // batch_ms).sort_values(["batch", "ms"], kind="stable")
    banned: set = set()
    counts: dict = {}
    kept = []
    for _, grp in rows.groupby("batch", sort=True):
        snapshot = set(banned)
        for r in grp.itertuples(index=False):
            if r.user in snapshot:
                continue
            kept.append(r)
            k = (r.day, r.user, r.ad)
            counts[k] = counts.get(k, 0) + 1
            if counts[k] >= threshold:
                banned.add(r.user)
    return pd.DataFrame(kept, columns=rows.columns)


events = st.lists(st.tuples(st.sampled_from(["u1", "u1", "u1", "u2", "u3", "u4"]),   # u1 is hot
                            st.integers(0, 3 * 86_400_000 - 1), st.sampled_from(["1", "2"])),
                  min_size=1, max_size=150)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.integers(1, 6))
def test_closed_form_equals_batch_by_batch_loop(spark, data, threshold):
    t0 = 1704067200000
    lines = [f"{t0 + ms} ASIA C {u} {a}" for u, ms, a in data]
    from shoplens.sources.ads import parse_lines
    parsed = parse_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = sorted((r.user_id, r.ms) for r in
                 ad.ads_filtered(parsed, threshold, 3600).select("user_id", F.unix_millis("ts").alias("ms")).collect())
    rows = pd.DataFrame([(u, t0 + ms, pd.Timestamp(t0 + ms, unit="ms").strftime("%Y-%m-%d"), a) for u, ms, a in data],
                        columns=["user", "ms", "day", "ad"])
    want = sorted((r.user, r.ms) for r in simulate_loop(rows, threshold, 3_600_000).itertuples(index=False))
    assert got == want
