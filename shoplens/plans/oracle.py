"""DuckDB SQL for every registered query, written from the definitions.

The driver's tables are views in DuckDB (``events``, ``customer`` ...); the
fixture adapter is repeated here as CTEs so that each statement is
self-contained. Column names equal the Spark results.
"""

from __future__ import annotations

from shoplens.plans.queries import FIXTURE, PROFILE_FILTER
from shoplens.params import ActionFilter
from shoplens.sources import tables as fx

TS = "'%Y-%m-%d %H:%M:%S'"


def _list_sql(kind: str, mod: int, step: int, n: str, max_len: int) -> str:
    terms = ", ".join(
        f"CASE WHEN {n} > {j} THEN CAST((k + {step * j}) % {mod} + 1 AS VARCHAR) END" for j in range(max_len))
    return f"CASE WHEN kind = '{kind}' THEN concat_ws(',', {terms}) END"


def _kind_case() -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fx.EVENT_KIND.items())
    return f"CASE event_type {whens} END"


def adapter_ctes() -> str:
    np_ = f"least(n, {fx.MAX_PRODUCT_LIST_LEN})"
    return f"""
ev AS (
  SELECT event_id, ts, user_id, {_kind_case()} AS kind,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id % {fx.MAX_LIST_LEN} + 1 AS n
  FROM events),
uva AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         k % {fx.PAGES_IN_FIXTURE} + 1 AS page_id,
         date_trunc('second', ts) AS action_time,
         CASE WHEN kind = 'search' THEN 'kw' || CAST(k % {fx.KEYWORD_MOD} AS VARCHAR) END AS search_keyword,
         CASE WHEN kind = 'click' THEN k % {fx.CATEGORY_MOD} + 1 ELSE -1 END AS click_category_id,
         CASE WHEN kind = 'click' THEN k + 1 ELSE -1 END AS click_product_id,
         {_list_sql('order', fx.CATEGORY_MOD, fx.ORDER_CATEGORY_STEP, 'n', fx.MAX_LIST_LEN)} AS order_category_ids,
         {_list_sql('order', fx.PRODUCT_MOD, fx.ORDER_PRODUCT_STEP, np_, fx.MAX_PRODUCT_LIST_LEN)} AS order_product_ids,
         {_list_sql('pay', fx.CATEGORY_MOD, fx.ORDER_CATEGORY_STEP, 'n', fx.MAX_LIST_LEN)} AS pay_category_ids,
         {_list_sql('pay', fx.PRODUCT_MOD, fx.ORDER_PRODUCT_STEP, np_, fx.MAX_PRODUCT_LIST_LEN)} AS pay_product_ids,
         event_id % {fx.CITY_MOD} + 1 AS city_id,
         event_id
  FROM ev),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name, 10 + c_custkey % 50 AS age,
         c_mktsegment AS professional, CASE WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS extend_info FROM part),
city_info AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _filter_cte(name: str, flt: ActionFilter) -> str:
    a, u = [], []
    if flt.start_date is not None:
        a.append(f"date >= '{flt.start_date}'")
    if flt.end_date is not None:
        a.append(f"date <= '{flt.end_date}'")
    if flt.city_id is not None:
        a.append(f"city_id = {int(flt.city_id)}")
    if flt.start_age is not None:
        u.append(f"age >= {int(flt.start_age)}")
    if flt.end_age is not None:
        u.append(f"age <= {int(flt.end_age)}")
    if flt.professional is not None:
        u.append(f"professional = '{flt.professional}'")
    if flt.gender is not None:
        u.append(f"gender = '{flt.gender}'")
    uw = (" WHERE " + " AND ".join(u)) if u else ""
    a.append(f"user_id IN (SELECT user_id FROM user_info{uw})")
    return f"{name} AS (SELECT * FROM uva WHERE {' AND '.join(a)})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([adapter_ctes(), _filter_cte("fa", FIXTURE.actions), *ctes]) + "\n"


ACTION_OUT = ", ".join(
    f"strftime(action_time, {TS}) AS action_time" if c == "action_time" else c for c in fx.ACTION_COLUMNS)


def _list(col: str) -> str:
    return f"coalesce(string_agg({col}, ',' ORDER BY action_time, event_id), '')"


SESSION_INFO = f"""si AS (
  SELECT '{FIXTURE.task_id}' AS task_id, session_id,
         (epoch_us(max(action_time)) - epoch_us(min(action_time))) // 1000000 AS visit_length,
         count(*) AS step_length,
         strftime(min(action_time), {TS}) AS start_time,
         {_list('search_keyword')} AS search_keywords,
         {_list("CASE WHEN click_product_id > 0 THEN CAST(click_product_id AS VARCHAR) END")} AS click_product_ids,
         {_list('order_product_ids')} AS order_product_ids,
         {_list('pay_product_ids')} AS pay_product_ids
  FROM fa GROUP BY session_id)"""

WANT = FIXTURE.sample.size
# definition: exact share n * want / total; whole parts first, then one each by largest remainder
QUOTA = f"""h AS (
  SELECT substr(start_time, 1, 13) AS day_hour, count(*) AS hour_sessions,
         (SELECT count(*) FROM si) AS total_sessions
  FROM si GROUP BY 1),
e AS (SELECT *, least({WANT}, total_sessions) AS wanted, hour_sessions * least({WANT}, total_sessions) AS share FROM h),
q AS (
  SELECT day_hour, hour_sessions, total_sessions, CAST(share // total_sessions + CASE
           WHEN row_number() OVER (ORDER BY share % total_sessions DESC, day_hour)
                <= wanted - (SELECT sum(share // total_sessions) FROM e) THEN 1 ELSE 0 END AS BIGINT) AS quota
  FROM e)"""


def _pct(num: str, den: str, digits: int) -> str:
    return (f"CASE WHEN {den} = 0 THEN 0.0 ELSE floor({num} / {den} * {float(10 ** (digits + 2))} + 0.5)"
            f" / {float(10 ** digits)} END")


CATEGORY_ACTIONS = """ca AS (
  SELECT CAST(cid AS BIGINT) AS category_id, action FROM (
    SELECT CAST(click_category_id AS VARCHAR) AS cid, 'click' AS action FROM fa WHERE click_category_id > 0
    UNION ALL
    SELECT unnest(string_split(order_category_ids, ',')) AS cid, 'order' AS action FROM fa
      WHERE NOT click_category_id > 0 AND order_category_ids IS NOT NULL
    UNION ALL
    SELECT unnest(string_split(pay_category_ids, ',')) AS cid, 'pay' AS action FROM fa
      WHERE NOT click_category_id > 0 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL
  ) x WHERE cid <> '')"""

CATEGORY_TOTALS = """ct AS (
  SELECT category_id, CAST(count_if(action = 'click') AS BIGINT) AS click_count,
         CAST(count_if(action = 'order') AS BIGINT) AS order_count,
         CAST(count_if(action = 'pay') AS BIGINT) AS pay_count
  FROM ca GROUP BY category_id)"""

TOP10 = f"""top AS (
  SELECT '{FIXTURE.task_id}' AS task_id, category_id, click_count, order_count, pay_count FROM ct
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT {FIXTURE.top_categories})"""

CSC = """csc AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM fa
  WHERE click_category_id > 0 AND click_category_id IN (SELECT category_id FROM top)
  GROUP BY 1, 2)"""

FLOW = FIXTURE.flow
JUMP_LIST = ", ".join(f"'{j}'" for j in FLOW.jump_labels)
VIEWS = f"""pv AS (
  SELECT page_id, count(*) AS view_count FROM fa WHERE page_id IN ({', '.join(map(str, FLOW.from_pages))})
  GROUP BY page_id)"""
JUMPS = f"""pj AS (
  SELECT page_jump, from_page, count(*) AS jump_count FROM (
    SELECT page_id AS from_page,
           CAST(page_id AS VARCHAR) || '_' ||
           CAST(lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS VARCHAR) AS page_jump
    FROM fa) x
  WHERE page_jump IN ({JUMP_LIST}) GROUP BY 1, 2)"""

AREA_CITY = """apc AS (
  SELECT c.area, a.click_product_id AS product_id, c.city_name, count(*) AS c
  FROM uva a JOIN city_info c ON a.city_id = c.city_id
  WHERE a.click_product_id > 0 GROUP BY 1, 2, 3)"""
OTHER = FIXTURE.other_label
REMARK = f"""rm AS (
  SELECT area, product_id, click_count,
         string_agg(city_name || ':' || CAST(share AS VARCHAR) || '%', ',' ORDER BY rn) FILTER (WHERE rn <= 2)
         || CASE WHEN max(city_count) > 2 THEN
              ',{OTHER}:' || CAST(floor((100.0 - max(share) FILTER (WHERE rn = 1) - max(share) FILTER (WHERE rn = 2))
                                       * 10.0 + 0.5) / 10.0 AS VARCHAR) || '%'
            ELSE '' END AS city_remark
  FROM (
    SELECT s.*, row_number() OVER (PARTITION BY area, product_id ORDER BY share DESC, city_name) AS rn FROM (
      SELECT apc.area, apc.product_id, apc.city_name, t.click_count, t.city_count,
             floor(apc.c / t.click_count * 1000.0 + 0.5) / 10.0 AS share
      FROM apc JOIN (SELECT area, product_id, CAST(sum(c) AS BIGINT) AS click_count, count(*) AS city_count
                     FROM apc GROUP BY 1, 2) t USING (area, product_id)) s) r
  GROUP BY area, product_id, click_count)"""

HOT = f"""hot AS (
  SELECT click_product_id AS product_id, count(*) AS click_count FROM fa WHERE click_product_id > 0
  GROUP BY 1 ORDER BY click_count DESC, product_id LIMIT {FIXTURE.hot_products})"""
BUYERS = """hb AS (
  SELECT CAST(p AS BIGINT) AS product_id, user_id, count(*) AS buy_count FROM (
    SELECT user_id, unnest(string_split(pay_product_ids, ',')) AS p FROM fa WHERE pay_product_ids IS NOT NULL) x
  WHERE p <> '' AND CAST(p AS BIGINT) IN (SELECT product_id FROM hot)
  GROUP BY 1, 2)"""
TOP_BUYERS = f"""tb AS (
  SELECT * FROM (SELECT hb.*, row_number() OVER (PARTITION BY product_id ORDER BY buy_count DESC, user_id) AS rank
                 FROM hb) x WHERE rank <= {FIXTURE.buyers_per_product})"""

ADS = FIXTURE.ads
BATCH_MS = ADS.batch_seconds * 1000


def _ads_with(*ctes: str) -> str:
    base = f"""
ads AS (
  SELECT epoch_us(e.ts) // 1000 AS ts_ms, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS day,
         replace(r.r_name, ' ', '-') AS area, replace(n.n_name, ' ', '-') AS city,
         CAST(e.user_id AS VARCHAR) AS user_id,
         CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % {fx.ADS_PER_FIXTURE} + 1 AS VARCHAR) AS ads_id
  FROM events e JOIN nation n ON n.n_nationkey = e.event_id % {fx.CITY_MOD}
  JOIN region r ON n.n_regionkey = r.r_regionkey),
b AS (SELECT *, ts_ms // {BATCH_MS} AS batch_id FROM ads),
ban AS (
  SELECT user_id, min(batch_id) AS ban_batch FROM (
    SELECT user_id, batch_id, row_number() OVER (PARTITION BY day, user_id, ads_id ORDER BY ts_ms) AS rn FROM b) x
  WHERE rn = {ADS.ban_threshold} GROUP BY user_id),
kept AS (
  SELECT b.* FROM b LEFT JOIN ban USING (user_id) WHERE ban.ban_batch IS NULL OR b.batch_id <= ban.ban_batch),
acd AS (SELECT day, area, city, ads_id, count(*) AS click_count FROM kept GROUP BY 1, 2, 3, 4),
aad AS (SELECT day, area, ads_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM acd GROUP BY 1, 2, 3),
a3 AS (SELECT * FROM (SELECT aad.*, row_number() OVER (PARTITION BY day, area ORDER BY click_count DESC, ads_id) AS rank
                      FROM aad) x WHERE rank <= {FIXTURE.ads_per_area}),
lh AS (
  SELECT ads_id, strftime(make_timestamp(ts_ms * 1000), '%H:%M') AS minute, count(*) AS click_count,
         ts_ms // 60000 AS minute_no FROM ads
  WHERE ts_ms // 60000 > (SELECT max(ts_ms // 60000) FROM ads) - {ADS.trend_minutes} GROUP BY 1, 2, 4)"""
    return "WITH " + ",\n".join([base, *ctes]) + "\n"


def _slide_ms(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"seconds": 1, "minutes": 60, "hours": 3600}[unit] * 1000


W_MS, S_MS = _slide_ms(ADS.sliding_window), _slide_ms(ADS.sliding_slide)


def _mk_ts(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), {TS})"


SQL: dict[str, str] = {
    "filtered_actions": _with() + f"SELECT {ACTION_OUT} FROM fa",
    "filtered_actions_by_profile":
        "WITH " + ",\n".join([adapter_ctes(), _filter_cte("fp", PROFILE_FILTER)]) + f"\nSELECT {ACTION_OUT} FROM fp",
    "session_info": _with(SESSION_INFO) + "SELECT * FROM si",
    "session_stat": _with(SESSION_INFO) + f"""
SELECT '{FIXTURE.task_id}' AS task_id, '{FIXTURE.actions.to_json()}' AS conditions, n AS session_count,
       {_pct('v_le', 'n', 2)} AS visit_length_le_10s_ratio,
       {_pct('v_gt', 'n', 2)} AS visit_length_gt_10s_ratio,
       {_pct('s_le', 'n', 2)} AS step_length_le_5_ratio,
       {_pct('s_gt', 'n', 2)} AS step_length_gt_5_ratio
FROM (SELECT count(*) AS n, count_if(visit_length <= 10) AS v_le, count_if(visit_length > 10) AS v_gt,
             count_if(step_length < 5) AS s_le, count_if(step_length >= 5) AS s_gt FROM si) c""",
    "session_hour_quota": _with(SESSION_INFO, QUOTA) + f"""
SELECT * FROM q""",
    "session_sample": _with(SESSION_INFO, QUOTA) + f"""
SELECT task_id, session_id, visit_length, step_length, start_time, search_keywords, click_product_ids,
       order_product_ids, pay_product_ids
FROM (SELECT si.*, q.quota,
             row_number() OVER (PARTITION BY q.day_hour ORDER BY md5(si.session_id), si.session_id) AS rn
      FROM si JOIN q ON substr(si.start_time, 1, 13) = q.day_hour) x
WHERE rn <= quota""",
    "category_action_counts": _with(CATEGORY_ACTIONS) +
        "SELECT category_id, action, count(*) AS action_count FROM ca GROUP BY 1, 2",
    "category_totals": _with(CATEGORY_ACTIONS, CATEGORY_TOTALS) + "SELECT * FROM ct",
    "category_top10": _with(CATEGORY_ACTIONS, CATEGORY_TOTALS, TOP10) + "SELECT * FROM top",
    "category_session_clicks": _with(CATEGORY_ACTIONS, CATEGORY_TOTALS, TOP10, CSC) + "SELECT * FROM csc",
    "top_sessions_per_category": _with(CATEGORY_ACTIONS, CATEGORY_TOTALS, TOP10, CSC) + f"""
SELECT '{FIXTURE.task_id}' AS task_id, category_id, session_id, click_count, rank FROM (
  SELECT csc.*, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rank FROM csc) x
WHERE rank <= {FIXTURE.sessions_per_category}""",
    "page_view_counts": _with(VIEWS) + "SELECT * FROM pv",
    "page_jump_counts": _with(JUMPS) + "SELECT page_jump, jump_count FROM pj",
    "page_convert_rate": _with(VIEWS, JUMPS) + f"""
SELECT '{FIXTURE.task_id}' AS task_id, pj.page_jump, {_pct('pj.jump_count', 'pv.view_count', 1)} AS rate
FROM pj JOIN pv ON pj.from_page = pv.page_id""",
    "area_product_clicks": _with(AREA_CITY) +
        "SELECT area, product_id, CAST(sum(c) AS BIGINT) AS click_count FROM apc GROUP BY 1, 2",
    "area_product_city_remark": _with(AREA_CITY, REMARK) + "SELECT * FROM rm",
    "area_top3_products": _with(AREA_CITY, REMARK) + f"""
SELECT * FROM (SELECT rm.*, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rank
               FROM rm) x WHERE rank <= {FIXTURE.products_per_area}""",
    "hot_product_buyers": _with(HOT, BUYERS) + "SELECT * FROM hb",
    "hot_product_top_buyers": _with(HOT, BUYERS, TOP_BUYERS) + "SELECT * FROM tb",
    "visit_trace": _with(HOT, BUYERS, TOP_BUYERS) + f"""
SELECT tb.product_id, p.product_name, fa.user_id, u.username, tb.rank AS buyer_rank,
       strftime(fa.action_time, {TS}) AS action_time,
       CASE WHEN fa.click_product_id > 0 THEN 'click' WHEN fa.search_keyword IS NOT NULL THEN 'search'
            WHEN fa.order_product_ids IS NOT NULL THEN 'order' WHEN fa.pay_product_ids IS NOT NULL THEN 'pay' END
         AS action_type,
       CASE WHEN fa.click_product_id > 0 THEN CAST(fa.click_product_id AS VARCHAR)
            WHEN fa.search_keyword IS NOT NULL THEN fa.search_keyword
            WHEN fa.order_product_ids IS NOT NULL THEN fa.order_product_ids
            WHEN fa.pay_product_ids IS NOT NULL THEN fa.pay_product_ids END AS item,
       fa.event_id
FROM fa JOIN tb ON fa.user_id = tb.user_id
LEFT JOIN product_info p ON p.product_id = tb.product_id
LEFT JOIN user_info u ON u.user_id = fa.user_id
WHERE fa.date = '{FIXTURE.trace_date}'""",
    "ads_log_parsed": _ads_with() + "SELECT ts_ms, day, area, city, user_id, ads_id FROM ads",
    "user_ads_day_counts": _ads_with() +
        "SELECT day, user_id, ads_id, count(*) AS click_count FROM kept GROUP BY 1, 2, 3",
    "ads_blacklist": _ads_with() +
        f"SELECT user_id, ban_batch, {_mk_ts(f'ban_batch * {BATCH_MS}')} AS banned_from FROM ban",
    "ads_filtered": _ads_with() + "SELECT ts_ms, day, area, city, user_id, ads_id, batch_id FROM kept",
    "area_city_ads_day": _ads_with() + "SELECT * FROM acd",
    "area_ads_day": _ads_with() + "SELECT * FROM aad",
    "area_top3_ads": _ads_with() + "SELECT * FROM a3",
    "area_top3_ads_json": _ads_with() + """
SELECT day, area,
       '[' || string_agg('{"' || ads_id || '":' || CAST(click_count AS VARCHAR) || '}', ',' ORDER BY rank) || ']'
         AS top3_json
FROM a3 GROUP BY day, area""",
    "last_hour_ads_minutes": _ads_with() + "SELECT ads_id, minute, click_count FROM lh",
    "last_hour_ads_trend": _ads_with() + """
SELECT ads_id,
       '[' || string_agg('{"' || minute || '":' || CAST(click_count AS VARCHAR) || '}', ',' ORDER BY minute_no) || ']'
         AS trend_json
FROM lh GROUP BY ads_id""",
    # definition: every window [start, start + length) aligned to the slide that holds the row
    "ads_sliding_counts": _ads_with() + f"""
SELECT {_mk_ts('start_ms')} AS window_start, {_mk_ts(f'start_ms + {W_MS}')} AS window_end, ads_id,
       count(*) AS click_count
FROM (SELECT ads_id, (ts_ms // {S_MS}) * {S_MS} - j * {S_MS} AS start_ms
      FROM ads, range(0, {W_MS // S_MS}) t(j)) x
GROUP BY 1, 2, 3""",
}
