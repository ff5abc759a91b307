"""Golden mini-cases with hand-written rows (FIXTURES.md section 4)."""

from helpers import action, actions_df, cities_df, lines_df, users_df
from shoplens.operators import actions as act
from shoplens.operators import ads as ad
from shoplens.operators import buyers as buy
from shoplens.operators import categories as cat
from shoplens.operators import pages as pg
from shoplens.operators import products as prod
from shoplens.operators import sessions as ses
from shoplens.params import ActionFilter, PageFlow
from shoplens.sources.ads import parse_lines, rejected_lines


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_visit_length_10s_is_le_and_11s_is_gt(spark):
    rows = [action(1, "a", seconds=0), action(2, "a", seconds=10),
            action(3, "b", seconds=0), action(4, "b", seconds=11)]
    s = ses.session_stats(actions_df(spark, rows))
    got = {r.session_id: r.visit_length for r in s.collect()}
    assert got == {"a": 10, "b": 11}
    stat = _one(ses.session_stat(s, "t", "{}"))
    assert (stat.visit_length_le_10s_ratio, stat.visit_length_gt_10s_ratio) == (50.0, 50.0)


def test_four_steps_le_five_steps_gt(spark):
    rows = [action(i, "four", seconds=i) for i in range(4)] + [action(10 + i, "five", seconds=i) for i in range(5)]
    stat = _one(ses.session_stat(ses.session_stats(actions_df(spark, rows)), "t", "{}"))
    assert stat.session_count == 2
    assert (stat.step_length_le_5_ratio, stat.step_length_gt_5_ratio) == (50.0, 50.0)


def test_single_action_session_and_lists(spark):
    rows = [action(1, "x", seconds=5, keyword="kw1"),
            action(2, "y", seconds=1, click_cat=3, click_prod=7),
            action(3, "y", seconds=0, keyword="kw2"),
            action(4, "y", seconds=2, order_cats="1,2", order_prods="5,6"),
            action(5, "y", seconds=3, pay_cats="1", pay_prods="5")]
    info = {r.session_id: r for r in ses.session_info(actions_df(spark, rows), "t").collect()}
    x, y = info["x"], info["y"]
    assert (x.visit_length, x.step_length, x.search_keywords, x.click_product_ids) == (0, 1, "kw1", "")
    assert y.start_time == "2024-01-10 08:00:00"
    assert (y.search_keywords, y.click_product_ids, y.order_product_ids, y.pay_product_ids) == \
        ("kw2", "7", "5,6", "5")


def test_empty_input_gives_zero_ratios(spark):
    stat = _one(ses.session_stat(ses.session_stats(actions_df(spark, [])), "t", "{}"))
    assert stat.session_count == 0
    assert stat.visit_length_le_10s_ratio == 0.0 and stat.step_length_gt_5_ratio == 0.0


def test_click_wins_over_order_and_empty_tail_skipped(spark):
    rows = [action(1, click_cat=4, click_prod=9, order_cats="1,2"),
            action(2, order_cats="1,2,"),
            action(3, pay_cats="2,3,x")]
    got = sorted((r.category_id, r.action, r.action_count)
                 for r in cat.category_action_counts(actions_df(spark, rows)).collect())
    assert got == [(1, "order", 1), (2, "order", 1), (2, "pay", 1), (3, "pay", 1), (4, "click", 1)]


def test_top10_ties_broken_by_id(spark):
    rows = [action(i, click_cat=c) for i, c in enumerate(range(12, 0, -1))]  # 12 categories, one click each
    top = cat.category_top(actions_df(spark, rows), 10, "t")
    assert [r.category_id for r in top.collect()] == list(range(1, 11))


def test_top_sessions_ties_at_rank_10(spark):
    rows = [action(i, session=f"s{i:02d}", click_cat=1) for i in range(12)]
    a = actions_df(spark, rows)
    top = cat.top_sessions_per_category(a, cat.category_top(a, 10, "t"), 10, "t")
    assert sorted(r.session_id for r in top.collect()) == [f"s{i:02d}" for i in range(10)]


def test_top2_buyers_ties(spark):
    rows = [action(1, click_prod=5, click_cat=1)] + \
           [action(10 + u, user=u, pay_cats="1", pay_prods="5") for u in (3, 1, 2)]
    a = actions_df(spark, rows)
    top = buy.hot_product_top_buyers(a, buy.hot_products(a, 10), 2)
    assert sorted((r.product_id, r.user_id, r.rank) for r in top.collect()) == [(5, 1, 1), (5, 2, 2)]


def test_city_remark_one_two_three_cities(spark):
    cities = cities_df(spark, [(1, "NATION_1", "ASIA"), (2, "B_2", "ASIA"), (3, "C", "ASIA")])
    rows = ([action(1, click_prod=1, city=1)] +
            [action(10 + i, click_prod=2, city=c) for i, c in enumerate((1, 2))] +
            [action(20 + i, click_prod=3, city=c) for i, c in enumerate((1, 2, 3))])
    got = {r.product_id: r.city_remark
           for r in prod.area_product_city_remark(actions_df(spark, rows), cities, "其他").collect()}
    assert got[1] == "NATION_1:100.0%"
    assert got[2] == "B_2:50.0%,NATION_1:50.0%"
    assert got[3] == "B_2:33.3%,C:33.3%,其他:33.4%"


def test_top3_ads_ties_and_json(spark):
    rows = [("2024-01-01", "ASIA", ad_id, n) for ad_id, n in (("1", 5), ("2", 3), ("3", 3), ("4", 3))]
    totals = spark.createDataFrame(rows, "day string, area string, ads_id string, click_count bigint")
    j = _one(ad.area_top_ads_json(ad.area_top_ads(totals, 3)))
    assert j.top3_json == '[{"1":5},{"2":3},{"3":3}]'


def test_malformed_ad_lines_are_rejected(spark):
    lines = lines_df(spark, ["1704067200000 ASIA NATION_1 7 2", "garbage", "x ASIA C 1 1", "1 2 3 4"])
    ok = parse_lines(lines).collect()
    assert len(ok) == 1 and ok[0].day == "2024-01-01" and ok[0].area == "ASIA" and ok[0].ads_id == "2"
    assert rejected_lines(lines).count() == 3


def test_threshold_reached_inside_a_batch(spark):
    h = 3_600_000
    t0 = 1704067200000
    lines = [f"{t0 + 1000 * i} ASIA C 7 1" for i in range(3)]          # batch 0: 3 clicks, threshold 2
    lines += [f"{t0 + h + 1000} ASIA C 7 1", f"{t0 + h + 2000} ASIA C 8 1"]  # batch 1
    parsed = parse_lines(lines_df(spark, lines))
    kept = ad.ads_filtered(parsed, 2, 3600)
    assert sorted((r.user_id, r.batch_id - t0 // h) for r in kept.collect()) == \
        [("7", 0), ("7", 0), ("7", 0), ("8", 1)]
    ban = _one(ad.ads_blacklist(parsed, 2, 3600))
    assert ban.user_id == "7" and ban.banned_from == "2024-01-01 00:00:00"


def test_filter_conjuncts_and_optional_keys(spark):
    users = users_df(spark, [(1, "u1", "u1", 20, "BUILDING", "M"), (2, "u2", "u2", 50, "BUILDING", "F")])
    rows = [action(1, user=1, city=3), action(2, user=2, city=3), action(3, user=3, city=3),
            action(4, user=1, city=4)]
    a = actions_df(spark, rows)
    flt = ActionFilter.from_json('{"startDate":"","endDate":"2024-01-10","startAge":"15","endAge":"45",'
                                 '"professionals":"BUILDING","gender":"M","city":"3"}')
    assert [r.event_id for r in act.filter_actions(a, users, flt).collect()] == [1]
    # missing keys are off, like empty ones; user 3 has no user row and drops out
    assert sorted(r.event_id for r in act.filter_actions(a, users, ActionFilter.from_json("{}")).collect()) == \
        [1, 2, 4]


def test_page_jumps_order_by_time_then_id(spark):
    rows = [action(3, "s", seconds=0, page=2), action(1, "s", seconds=0, page=1),
            action(2, "s", seconds=5, page=3), action(4, "t", seconds=0, page=2)]
    j = {r.page_jump: r.jump_count for r in pg.page_jump_counts(actions_df(spark, rows), PageFlow((1, 2, 3))).collect()}
    assert j == {"1_2": 1, "2_3": 1}
    rate = {r.page_jump: r.rate for r in pg.page_convert_rate(actions_df(spark, rows), PageFlow((1, 2, 3)), "t").collect()}
    assert rate == {"1_2": 100.0, "2_3": 50.0}


def test_visit_trace_lists_buyer_visits_in_time_order(spark):
    users = users_df(spark, [(1, "alice", "alice", 20, "X", "F")])
    products = spark.createDataFrame([(5, "bolt", "E")], "product_id bigint, product_name string, extend_info string")
    rows = [action(1, user=1, seconds=30, click_prod=5, click_cat=1),
            action(2, user=1, seconds=10, keyword="kw"),
            action(3, user=1, seconds=20, pay_cats="1", pay_prods="5,6")]
    a = actions_df(spark, rows)
    top = buy.hot_product_top_buyers(a, buy.hot_products(a, 10), 2)
    trace = buy.visit_trace(a, top, products, users, "2024-01-10").collect()
    assert [(r.action_type, r.item) for r in trace] == [("search", "kw"), ("pay", "5,6"), ("click", "5")]
    assert trace[0].product_name == "bolt" and trace[0].username == "alice"




def test_flow_with_repeated_pages(spark):
    rows = [action(1, "s", seconds=0, page=1), action(2, "s", seconds=1, page=2),
            action(3, "s", seconds=2, page=1), action(4, "s", seconds=3, page=3)]
    flow = PageFlow.parse("1,2,1,3")           # jumps 1_2, 2_1, 1_3; page 1 is a from-page twice
    for hot_rows in (1, 10**6):
        rate = {r.page_jump: r.rate for r in pg.page_convert_rate(actions_df(spark, rows), flow, "t", hot_rows).collect()}
        assert rate == {"1_2": 50.0, "2_1": 100.0, "1_3": 50.0}, hot_rows
        jumps = pg.page_jump_counts(actions_df(spark, rows), flow, hot_rows).collect()
        assert sorted((r.page_jump, r.jump_count) for r in jumps) == [("1_2", 1), ("1_3", 1), ("2_1", 1)]
