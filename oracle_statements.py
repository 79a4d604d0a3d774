"""DuckDB SQL for every registered query that SQL can express.

Each statement is an independent statement of the same semantics over the
raw input views (``events``, ``customer``, ...), so a match checks adapters
and operators together.
"""

from __future__ import annotations

from dataclasses import dataclass

ORACLE: dict[str, str] = {}


@dataclass(frozen=True)
class Task:
    """The registered tasks, written out here on their own."""
    start_date: str = "2024-01-01"
    end_date: str = "2024-01-30"
    ages: tuple[int, int] | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()


DEFAULT_PARAMS = Task(ages=(20, 50))
WIDE_PARAMS = Task(ages=(25, 55), professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"), sex="female",
                   keywords=("kw0", "kw1", "kw3", "kw5", "kw7", "kw9"))
CATEGORY_PARAMS = Task(
    cities=("NATION_0", "NATION_2", "NATION_4", "NATION_6", "NATION_8", "NATION_10", "NATION_12",
            "NATION_14", "NATION_16", "NATION_18", "NATION_20", "NATION_22", "NATION_24"),
    category_ids=tuple(i for i in range(100) if i % 2 == 0))
SAMPLE_TOTAL = 1000
SAMPLE_SEED = "shoplens"
BLACKLIST_THRESHOLD = 1
PAGE_FLOW = (1, 2, 3, 4, 5, 6, 7)

# Cities, area levels, and the bucket bounds of visit length
# (seconds) and step length (actions).
CITY_AREA_ROWS = [
    (0, "北京", "华北"), (1, "上海", "华东"), (2, "南京", "华东"),
    (3, "广州", "华南"), (4, "三亚", "华南"), (5, "武汉", "华中"),
    (6, "长沙", "华中"), (7, "西安", "西北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]
AREA_LEVELS = {"华北": "A_Level", "华东": "A_Level", "华中": "B_Level", "华南": "B_Level",
               "西南": "C_Level", "西北": "C_Level"}
REGION_LEVELS = {"AMERICA": "A_Level", "EUROPE": "A_Level", "ASIA": "B_Level", "MIDDLE EAST": "C_Level"}
VISIT_BUCKETS = (
    ("visit_length_1s_3s", 1, 3), ("visit_length_4s_6s", 4, 6), ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30), ("visit_length_30s_60s", 31, 60), ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600), ("visit_length_10m_30m", 601, 1800), ("visit_length_30m", 1801, None))
STEP_BUCKETS = (
    ("step_length_1_3", 1, 3), ("step_length_4_6", 4, 6), ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30), ("step_length_30_60", 31, 60), ("step_length_60", 61, None))


def _date_filter(p: Task) -> str:
    return (f"ts >= DATE '{p.start_date}' "
            f"AND ts < DATE '{p.end_date}' + INTERVAL 1 DAY")


def uva_cte(p: Task | None = DEFAULT_PARAMS) -> str:
    where = f"WHERE {_date_filter(p)}" if p else ""
    return f"""
ev AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events {where}),
uva AS (
  SELECT CAST(ts AS DATE) AS date, user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
         k % 10 AS page_id,
         date_trunc('second', ts) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (event_id // 10) % 100 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN [k, (k + 1) % 100] END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN [(event_id // 10) % 100] END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN [k] END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN [(event_id // 10) % 100] END AS pay_product_ids,
         event_id % 10 AS city_id
  FROM ev)"""


def city_cte() -> str:
    rows = ", ".join(f"({i}, '{c}', '{a}')" for i, c, a in CITY_AREA_ROWS)
    return f"city(city_id, city_name, area) AS (VALUES {rows})"


def level_case(col: str = "area", levels: dict[str, str] | None = None) -> str:
    levels = AREA_LEVELS if levels is None else levels
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in levels.items())
    return f"CASE {whens} ELSE 'D_Level' END"


PRODUCTS_CTE = """prod AS (
  SELECT p_partkey AS pid, p_name AS product_name,
         CASE WHEN p_partkey % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM part)"""

AREA_COUNTS = f"""
basic AS (
  SELECT u.city_id, c.city_name, c.area, u.click_product_id AS pid
  FROM uva u JOIN city c ON u.city_id = c.city_id
  WHERE u.click_product_id IS NOT NULL),
cnt AS (
  SELECT area, pid, count(*) AS click_count,
         string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ','
                    ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos
  FROM basic GROUP BY area, pid)"""

ORACLE["area_product_clicks"] = f"""
WITH {uva_cte()}, {city_cte()}, {AREA_COUNTS}
SELECT * FROM cnt"""

ORACLE["area_product_info"] = f"""
WITH {uva_cte()}, {city_cte()}, {AREA_COUNTS}, {PRODUCTS_CTE}
SELECT cnt.pid, area, click_count, city_infos, product_name, product_status
FROM cnt JOIN prod ON cnt.pid = prod.pid"""

ORACLE["area_top3_products"] = f"""
WITH {uva_cte()}, {city_cte()}, {AREA_COUNTS}, {PRODUCTS_CTE},
ranked AS (
  SELECT cnt.*, product_name, product_status,
         row_number() OVER (PARTITION BY area ORDER BY click_count DESC, cnt.pid) AS rn
  FROM cnt JOIN prod ON cnt.pid = prod.pid)
SELECT area, {level_case()} AS area_level, pid, city_infos, click_count,
       product_name, product_status
FROM ranked WHERE rn <= 3"""


# --- A: session analysis ---------------------------------------------------

def _q(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def where_sql(p: Task) -> str:
    conds = []
    if p.ages:
        conds.append(f"age BETWEEN {p.ages[0]} AND {p.ages[1]}")
    if p.professionals:
        conds.append(f"professional IN ({_q(p.professionals)})")
    if p.cities:
        conds.append(f"city IN ({_q(p.cities)})")
    if p.sex:
        conds.append(f"sex = '{p.sex}'")
    if p.keywords:
        conds.append(f"list_has_any(kw_list, [{_q(p.keywords)}])")
    if p.category_ids:
        conds.append(f"list_has_any(cat_list, [{', '.join(str(i) for i in p.category_ids)}]::BIGINT[])")
    return " AND ".join(conds) or "TRUE"


USERS_CTE = """users AS (
  SELECT c_custkey AS user_id, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

SESS_CTE = """sess AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time,
         count(*) AS step_length,
         date_diff('second', min(action_time), max(action_time)) AS visit_length,
         coalesce(array_to_string(list_sort(list_distinct(
             list(search_keyword) FILTER (WHERE length(search_keyword) > 0))), ','), '') AS search_keywords,
         coalesce(array_to_string(list_sort(list_distinct(list(click_category_id))), ','), '')
             AS click_category_ids,
         coalesce(list_distinct(list(search_keyword)), []) AS kw_list,
         coalesce(list_distinct(list(click_category_id)), []) AS cat_list
  FROM uva GROUP BY session_id)"""


def sessions_ctes(p: Task = DEFAULT_PARAMS) -> str:
    return f"""{uva_cte(p)}, {USERS_CTE}, {SESS_CTE},
enr AS (SELECT s.*, u.age, u.professional, u.city, u.sex FROM sess s JOIN users u USING (user_id)),
filt AS (SELECT * FROM enr WHERE {where_sql(p)}),
fa AS (SELECT * FROM uva WHERE session_id IN (SELECT session_id FROM filt))"""


SESS_COLS = """session_id, user_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       visit_length, step_length, search_keywords, click_category_ids"""

ACTION_COLS = """strftime(date, '%Y-%m-%d') AS date, user_id, session_id, page_id,
       strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword,
       coalesce(click_category_id, -1) AS click_category_id,
       coalesce(click_product_id, -1) AS click_product_id,
       array_to_string(order_category_ids, ',') AS order_category_ids,
       array_to_string(order_product_ids, ',') AS order_product_ids,
       array_to_string(pay_category_ids, ',') AS pay_category_ids,
       array_to_string(pay_product_ids, ',') AS pay_product_ids, city_id"""


def _bucket_sql(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"


VISIT_COUNTS = ",\n       ".join(
    ["count(*) FILTER (WHERE visit_length = 0) AS visit_length_0s"]
    + [f"count(*) FILTER (WHERE {_bucket_sql('visit_length', lo, hi)}) AS {n}"
       for n, lo, hi in VISIT_BUCKETS])
STEP_COUNTS = ",\n       ".join(
    f"count(*) FILTER (WHERE {_bucket_sql('step_length', lo, hi)}) AS {n}"
    for n, lo, hi in STEP_BUCKETS)
RATIOS = ",\n       ".join(
    f"CASE WHEN session_count > 0 THEN CAST(round(CAST({n} / session_count AS DECIMAL(18, 10)), 2)"
    f" AS DOUBLE) ELSE 0.0 END AS {n}_ratio"
    for n, _, _ in VISIT_BUCKETS + STEP_BUCKETS)

ORACLE["scan_actions_range"] = f"""
WITH {uva_cte(None)}
SELECT {ACTION_COLS} FROM uva WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"""

ORACLE["action_kind_counts"] = f"""
WITH {uva_cte()}
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS n, 'click' AS kind FROM uva
  WHERE click_category_id IS NOT NULL GROUP BY date
UNION ALL
SELECT strftime(date, '%Y-%m-%d'), count(*), 'order' FROM uva
  WHERE order_category_ids IS NOT NULL GROUP BY date
UNION ALL
SELECT strftime(date, '%Y-%m-%d'), count(*), 'pay' FROM uva
  WHERE pay_category_ids IS NOT NULL GROUP BY date"""

ORACLE["sessionize"] = f"""
WITH {uva_cte()}, {SESS_CTE}
SELECT {SESS_COLS} FROM sess"""

ORACLE["session_enriched"] = f"""
WITH {sessions_ctes()}
SELECT {SESS_COLS}, age, professional, city, sex FROM enr"""

ORACLE["session_filtered"] = f"""
WITH {sessions_ctes()}
SELECT {SESS_COLS}, age, professional, city, sex FROM filt"""

ORACLE["session_filtered_wide"] = f"""
WITH {sessions_ctes(WIDE_PARAMS)}
SELECT {SESS_COLS}, age, professional, city, sex FROM filt"""

ORACLE["session_filtered_categories"] = f"""
WITH {sessions_ctes(CATEGORY_PARAMS)}
SELECT {SESS_COLS}, age, professional, city, sex FROM filt"""

ORACLE["visit_histogram"] = f"""
WITH {sessions_ctes()}
SELECT count(*) AS session_count,
       {VISIT_COUNTS}
FROM filt"""

ORACLE["step_histogram"] = f"""
WITH {sessions_ctes()}
SELECT count(*) AS session_count,
       {STEP_COUNTS}
FROM filt"""


def _stats(p: Task) -> str:
    return f"""
WITH {sessions_ctes(p)},
c AS (SELECT count(*) AS session_count,
       {VISIT_COUNTS},
       {STEP_COUNTS}
      FROM filt)
SELECT session_count,
       {RATIOS}
FROM c"""


ORACLE["session_stats"] = _stats(DEFAULT_PARAMS)
ORACLE["session_stats_wide"] = _stats(WIDE_PARAMS)

QUOTA_CTES = f"""
hc AS (SELECT strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour,
              count(*) AS hour_count
       FROM filt GROUP BY 1, 2),
hq AS (SELECT date, hour, hour_count,
              CAST(sum(hour_count) OVER (PARTITION BY date) AS BIGINT) AS day_count,
              CAST({SAMPLE_TOTAL} // (SELECT count(DISTINCT date) FROM hc) AS BIGINT) AS per_day
       FROM hc),
quota AS (SELECT *, CAST(least(floor(hour_count / day_count * per_day), hour_count) AS BIGINT) AS quota
          FROM hq),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY sk, session_id) AS rn
  FROM (SELECT *, strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour,
               md5(session_id || ':' || '{SAMPLE_SEED}') AS sk FROM filt) t),
extract AS (SELECT ranked.* FROM ranked JOIN quota USING (date, hour) WHERE rn <= quota)"""

ORACLE["hour_quotas"] = f"""
WITH {sessions_ctes()}, {QUOTA_CTES}
SELECT date, hour, hour_count, day_count, per_day, quota FROM quota"""

ORACLE["session_extract"] = f"""
WITH {sessions_ctes()}, {QUOTA_CTES}
SELECT session_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       search_keywords, click_category_ids
FROM extract"""

ORACLE["session_detail"] = f"""
WITH {sessions_ctes()}, {QUOTA_CTES}
SELECT {ACTION_COLS} FROM uva WHERE session_id IN (SELECT session_id FROM extract)"""

ORACLE["filtered_actions"] = f"""
WITH {sessions_ctes()}
SELECT {ACTION_COLS} FROM fa"""

COUNT_CTES = """
clicks AS (SELECT click_category_id AS category_id, count(*) AS click_count
           FROM fa WHERE click_category_id IS NOT NULL GROUP BY 1),
orders_c AS (SELECT category_id, count(*) AS order_count FROM
             (SELECT unnest(order_category_ids) AS category_id FROM fa
              WHERE order_category_ids IS NOT NULL) GROUP BY 1),
pays_c AS (SELECT category_id, count(*) AS pay_count FROM
           (SELECT unnest(pay_category_ids) AS category_id FROM fa
            WHERE pay_category_ids IS NOT NULL) GROUP BY 1),
universe AS (SELECT category_id FROM clicks UNION SELECT category_id FROM orders_c
             UNION SELECT category_id FROM pays_c),
funnel AS (
  SELECT u.category_id, coalesce(c.click_count, 0) AS click_count,
         coalesce(o.order_count, 0) AS order_count, coalesce(p.pay_count, 0) AS pay_count
  FROM universe u LEFT JOIN clicks c USING (category_id)
       LEFT JOIN orders_c o USING (category_id) LEFT JOIN pays_c p USING (category_id)),
top10 AS (SELECT * FROM funnel
          ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""

ORACLE["category_click_counts"] = f"WITH {sessions_ctes()}, {COUNT_CTES} SELECT * FROM clicks"
ORACLE["category_order_counts"] = f"WITH {sessions_ctes()}, {COUNT_CTES} SELECT * FROM orders_c"
ORACLE["category_pay_counts"] = f"WITH {sessions_ctes()}, {COUNT_CTES} SELECT * FROM pays_c"
ORACLE["category_universe"] = f"WITH {sessions_ctes()}, {COUNT_CTES} SELECT * FROM universe"
ORACLE["category_universe_first_action"] = f"""
WITH {sessions_ctes()}
SELECT DISTINCT category_id FROM (
  SELECT click_category_id AS category_id FROM fa WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT unnest(order_category_ids) FROM fa
   WHERE click_category_id IS NULL AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest(pay_category_ids) FROM fa
   WHERE click_category_id IS NULL AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL)"""
ORACLE["category_funnel_counts"] = f"WITH {sessions_ctes()}, {COUNT_CTES} SELECT * FROM funnel"
ORACLE["category_funnel_counts_rows"] = ORACLE["category_funnel_counts"]
ORACLE["top10_categories"] = f"WITH {sessions_ctes()}, {COUNT_CTES} SELECT * FROM top10"
ORACLE["top10_products_universe"] = f"""
WITH {sessions_ctes()}, {COUNT_CTES}
SELECT p_partkey AS product_id, coalesce(click_count, 0) AS click_count,
       coalesce(order_count, 0) AS order_count, coalesce(pay_count, 0) AS pay_count
FROM part LEFT JOIN funnel ON p_partkey = category_id
ORDER BY click_count DESC, order_count DESC, pay_count DESC, product_id LIMIT 10"""
ORACLE["top10_active_sessions"] = f"""
WITH {sessions_ctes()}, {COUNT_CTES},
sc AS (SELECT click_category_id AS category_id, session_id, count(*) AS click_count
       FROM fa WHERE click_category_id IN (SELECT category_id FROM top10) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
      FROM sc)
SELECT category_id, session_id, click_count FROM r WHERE rn <= 10"""


# --- C: ad clicks -------------------------------------------------------------

LOG_CTES = """
evk AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
geo AS (SELECT c_custkey AS userid, replace(r_name, ' ', '_') AS province,
               replace(n_name, ' ', '_') AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey),
log AS (SELECT evk.ts, geo.province, geo.city, geo.userid, evk.k % 20 AS adid
        FROM evk JOIN geo ON evk.user_id = geo.userid WHERE evk.event_type = 'click'),
ucnt AS (SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, count(*) AS click_count
         FROM log GROUP BY 1, 2, 3),
blk AS (SELECT DISTINCT userid FROM ucnt WHERE click_count > {threshold}),
ccnt AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, adid, count(*) AS click_count
         FROM log GROUP BY 1, 2, 3, 4),
pcnt AS (SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count
         FROM ccnt GROUP BY 1, 2, 3),
mcnt AS (SELECT date_trunc('minute', ts) AS minute_start, adid, count(*) AS click_count
         FROM log GROUP BY 1, 2)"""

LOG = LOG_CTES.format(threshold=BLACKLIST_THRESHOLD)

ORACLE["ad_log_parsed"] = f"""
WITH {LOG},
lines AS (SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' ' || province || ' ' || city || ' '
                 || CAST(userid AS VARCHAR) || ' ' || CAST(adid AS VARCHAR) AS line FROM log),
parts AS (SELECT string_split(line, ' ') AS p FROM lines)
SELECT strftime(make_timestamp(CAST(p[1] AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts,
       p[2] AS province, p[3] AS city, CAST(p[4] AS BIGINT) AS userid, CAST(p[5] AS BIGINT) AS adid
FROM parts"""

ORACLE["clicks_by_user_ad_day"] = f"WITH {LOG} SELECT * FROM ucnt"
ORACLE["blacklist_users"] = f"WITH {LOG} SELECT * FROM blk"
ORACLE["ad_log_clean"] = f"""
WITH {LOG}
SELECT strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts,
       province, city, userid, adid
FROM log WHERE userid NOT IN (SELECT userid FROM blk)"""
ORACLE["clicks_by_city_ad_day"] = f"WITH {LOG} SELECT * FROM ccnt"
ORACLE["clicks_by_province_ad_day"] = f"WITH {LOG} SELECT * FROM pcnt"
ORACLE["province_clicks_direct"] = f"""
WITH {LOG}
SELECT strftime(ts, '%Y%m%d') AS date, province, adid, count(*) AS click_count
FROM log GROUP BY 1, 2, 3"""
ORACLE["province_top3"] = f"""
WITH {LOG},
r AS (SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn
      FROM pcnt)
SELECT date, province, adid, click_count FROM r WHERE rn <= 3"""
MINUTE_SELECT = """SELECT strftime(minute_start, '%Y%m%d') AS date, strftime(minute_start, '%H') AS hour,
       strftime(minute_start, '%M') AS minute, adid, click_count FROM mcnt"""
ORACLE["minute_trend"] = f"WITH {LOG} {MINUTE_SELECT}"
ORACLE["last_hour_trend"] = f"""
WITH {LOG} {MINUTE_SELECT}
WHERE minute_start >= date_trunc('minute', (SELECT max(ts) FROM log)) - INTERVAL 59 MINUTE"""
ORACLE["hourly_sliding_clicks"] = f"""
WITH {LOG},
win AS (SELECT unnest(generate_series(minute_start - INTERVAL 59 MINUTE, minute_start,
                                      INTERVAL 1 MINUTE)) AS ws, adid, click_count FROM mcnt)
SELECT strftime(ws, '%Y-%m-%d %H:%M') AS window_start,
       strftime(ws + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M') AS window_end,
       adid, CAST(sum(click_count) AS BIGINT) AS click_count
FROM win GROUP BY ws, adid"""

# The stream jobs over the whole events file (one micro-batch, empty starting
# blacklist) must equal the batch definitions.
ORACLE["stream_blacklist"] = ORACLE["blacklist_users"]
ORACLE["stream_user_click_totals"] = ORACLE["clicks_by_user_ad_day"]
ORACLE["stream_province_city_clicks"] = ORACLE["clicks_by_city_ad_day"]
ORACLE["stream_province_top3"] = ORACLE["province_top3"]
ORACLE["stream_minute_trend"] = ORACLE["minute_trend"]
ORACLE["stream_running_city_counts"] = ORACLE["clicks_by_city_ad_day"]
ORACLE["stream_running_minute_counts"] = ORACLE["minute_trend"]
ORACLE["stream_sliding_hour_counts"] = ORACLE["hourly_sliding_clicks"]


# --- page flow, area ranking over order lines --------------------------------

_FLOW = PAGE_FLOW
_PAIRS = [f"{a}_{b}" for a, b in zip(_FLOW, _FLOW[1:])]
_WANTED = ", ".join(f"({i}, '{s}')" for i, s in enumerate([str(_FLOW[0])] + _PAIRS))

PAGE_MOVES = f"""
{uva_cte()},
mv AS (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id)
              AS next_page_id FROM uva)"""

ORACLE["page_steps"] = f"""
WITH {PAGE_MOVES}
SELECT page_id, next_page_id, count(*) AS moves FROM mv WHERE next_page_id IS NOT NULL
GROUP BY 1, 2"""

ORACLE["page_flow_conversion"] = f"""
WITH {PAGE_MOVES},
cnt AS (SELECT CAST(page_id AS VARCHAR) || '_' || CAST(next_page_id AS VARCHAR) AS step,
               count(*) AS step_count
        FROM mv WHERE next_page_id IS NOT NULL GROUP BY 1
        UNION ALL
        SELECT '{_FLOW[0]}', count(*) FROM uva WHERE page_id = {_FLOW[0]}),
wanted(step_index, step) AS (VALUES {_WANTED}),
j AS (SELECT CAST(w.step_index AS INTEGER) AS step_index, w.step,
             CAST(coalesce(c.step_count, 0) AS BIGINT) AS step_count
      FROM wanted w LEFT JOIN cnt c ON w.step = c.step),
l AS (SELECT *, lag(step_count) OVER (ORDER BY step_index) AS prev FROM j)
SELECT step_index, step, step_count,
       CASE WHEN step_index = 0 THEN 1.0
            WHEN prev > 0 THEN CAST(round(CAST(step_count / prev AS DECIMAL(18, 10)), 2) AS DOUBLE)
            ELSE 0.0 END AS rate
FROM l"""

ORACLE["area_top3_orders"] = f"""
WITH {PRODUCTS_CTE},
lines AS (SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area, l_partkey AS pid
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               JOIN customer ON o_custkey = c_custkey
               JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey),
cnt AS (SELECT area, pid, count(*) AS click_count,
               string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ','
                          ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos
        FROM lines GROUP BY area, pid),
ranked AS (
  SELECT cnt.*, product_name, product_status,
         row_number() OVER (PARTITION BY area ORDER BY click_count DESC, cnt.pid) AS rn
  FROM cnt JOIN prod ON cnt.pid = prod.pid)
SELECT area, {level_case("area", REGION_LEVELS)} AS area_level,
       pid, city_infos, click_count, product_name, product_status
FROM ranked WHERE rn <= 3"""


# --- scalar expressions ---------------------------------------------------------

_AREAS = ", ".join(f"'{a}'" for _, _, a in CITY_AREA_ROWS)
_AREA_OF_EVENT = f"([{_AREAS}])[event_id % 10 + 1]"

ORACLE["time_exprs"] = """
WITH e AS (SELECT event_id, date_trunc('second', ts) AS t FROM events)
SELECT event_id,
       strftime(t, '%Y-%m-%d_%H') AS date_hour,
       strftime(t, '%Y-%m-%d') AS date,
       strftime(t, '%Y-%m-%d %H:%M:%S') AS time,
       strftime(t, '%Y-%m-%d %H:%M:%S') AS parsed_unpadded,
       strftime(t, '%Y%m%d') AS date_key,
       strftime(t, '%Y-%m-%d') AS date_from_key,
       strftime(t, '%Y%m%d%H%M') AS minute_key,
       strftime(t, '%Y%m%d') AS mk_date, strftime(t, '%H') AS mk_hour, strftime(t, '%M') AS mk_minute,
       date_diff('second', date_trunc('day', t), t) AS seconds_into_day,
       t < TIMESTAMP '2024-01-15 12:00:00' AS is_before,
       t > TIMESTAMP '2024-01-15 12:00:00' AS is_after
FROM e"""

ORACLE["string_exprs"] = f"""
WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, k,
       coalesce(CASE WHEN event_type = 'view' THEN k END, '') = '' AS k_empty_unless_view,
       CASE WHEN event_id % 200 BETWEEN 10 AND 99 THEN '' ELSE '0' END || CAST(event_id % 200 AS VARCHAR) AS padded,
       CAST(user_id AS VARCHAR) || ':' || event_type AS user_type,
       CAST(CAST(k AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(k AS BIGINT) AS VARCHAR) || ','
         || CAST(event_id % 7 AS VARCHAR) AS ids_roundtrip,
       CAST(round(CAST(value / 3 AS DECIMAL(18, 10)), 2) AS DOUBLE) AS third_value,
       {level_case(_AREA_OF_EVENT)} AS area_level,
       CASE WHEN event_id % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status
FROM e"""

ORACLE["group_concat_users_by_type"] = """
SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, user_id // 1000 AS user_range,
       string_agg(DISTINCT CAST(user_id AS VARCHAR), ',' ORDER BY CAST(user_id AS VARCHAR)) AS users
FROM events GROUP BY 1, 2, 3"""


# --- sinks -----------------------------------------------------------------------

TWO_BATCHES = f"""{LOG},
b1 AS (SELECT * FROM log WHERE ts < TIMESTAMP '2024-01-16'),
b2 AS (SELECT * FROM log WHERE ts >= TIMESTAMP '2024-01-10'),
u1 AS (SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, count(*) AS c FROM b1 GROUP BY 1, 2, 3),
u2 AS (SELECT strftime(ts, '%Y%m%d') AS date, userid, adid, count(*) AS c FROM b2 GROUP BY 1, 2, 3),
c1 AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, adid, count(*) AS c FROM b1 GROUP BY 1, 2, 3, 4),
c2 AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, adid, count(*) AS c FROM b2 GROUP BY 1, 2, 3, 4),
p1 AS (SELECT date, province, adid, sum(c) AS c FROM c1 GROUP BY 1, 2, 3),
p2 AS (SELECT date, province, adid, sum(c) AS c FROM c2 GROUP BY 1, 2, 3),
t1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, province
                                   ORDER BY c DESC, adid) AS rn FROM p1) WHERE rn <= 3),
t2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, province
                                   ORDER BY c DESC, adid) AS rn FROM p2) WHERE rn <= 3)"""

ORACLE["upsert_add"] = f"""
WITH {TWO_BATCHES}
SELECT date, userid, adid, CAST(sum(c) AS BIGINT) AS click_count
FROM (SELECT * FROM u1 UNION ALL SELECT * FROM u2) GROUP BY 1, 2, 3"""

ORACLE["upsert_set"] = f"""
WITH {TWO_BATCHES}
SELECT coalesce(c2.date, c1.date) AS date, coalesce(c2.province, c1.province) AS province,
       coalesce(c2.city, c1.city) AS city, coalesce(c2.adid, c1.adid) AS adid,
       coalesce(c2.c, c1.c) AS click_count
FROM c1 FULL OUTER JOIN c2 USING (date, province, city, adid)"""

ORACLE["replace_groups"] = f"""
WITH {TWO_BATCHES}
SELECT date, province, adid, CAST(c AS BIGINT) AS click_count FROM t1
WHERE (date, province) NOT IN (SELECT DISTINCT date, province FROM t2)
UNION ALL
SELECT date, province, adid, CAST(c AS BIGINT) FROM t2"""

ORACLE["upsert_add_inline"] = ORACLE["upsert_add"]
ORACLE["upsert_set_inline"] = ORACLE["upsert_set"]
ORACLE["replace_groups_inline"] = ORACLE["replace_groups"]

# --- native tables, sinks, task JSON: the same statements ------------------------

ORACLE["native_session_stats"] = ORACLE["session_stats"]
ORACLE["native_top10_categories"] = ORACLE["top10_categories"]
ORACLE["native_area_top3_products"] = ORACLE["area_top3_products"]
ORACLE["native_filtered_actions"] = ORACLE["filtered_actions"]
ORACLE["native_raw_session_stats"] = ORACLE["session_stats"]
ORACLE["native_bucketed_filtered_actions"] = ORACLE["filtered_actions"]
ORACLE["native_rejects"] = """
SELECT (['date', 'action_time', 'click_category_id', 'order_category_ids', 'session_id'])[user_id % 5 + 1] AS reason,
       count(*) AS rows
FROM events WHERE event_type = 'purchase' GROUP BY 1"""
ORACLE["session_stats_from_json"] = f"""
WITH s AS ({ORACLE["session_stats"]}) SELECT *, 'run-1' AS taskid FROM s"""
ORACLE["replaced_table"] = ORACLE["clicks_by_city_ad_day"]

# --- three micro-batches of the ad stream, restarted between them -----------------
# Days up to the 9th, the 10th to the 19th, and from the 20th on: no key spans
# two batches, so a batch blocks whom its own clean clicks put over the threshold.

BATCHES = f"""{LOG},
l1 AS (SELECT * FROM log WHERE ts < TIMESTAMP '2024-01-10'),
x1 AS (SELECT DISTINCT userid FROM (SELECT userid, count(*) AS c FROM l1
       GROUP BY strftime(ts, '%Y%m%d'), userid, adid) WHERE c > 1),
l2 AS (SELECT * FROM log WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
       AND userid NOT IN (SELECT userid FROM x1)),
x2 AS (SELECT DISTINCT userid FROM (SELECT userid, count(*) AS c FROM l2
       GROUP BY strftime(ts, '%Y%m%d'), userid, adid) WHERE c > 1),
l3 AS (SELECT * FROM log WHERE ts >= TIMESTAMP '2024-01-20'
       AND userid NOT IN (SELECT userid FROM x1) AND userid NOT IN (SELECT userid FROM x2)),
x3 AS (SELECT DISTINCT userid FROM (SELECT userid, count(*) AS c FROM l3
       GROUP BY strftime(ts, '%Y%m%d'), userid, adid) WHERE c > 1),
cleaned AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)"""
ORACLE["stream_batches_blacklist"] = f"""
WITH {BATCHES} SELECT userid FROM x1 UNION SELECT userid FROM x2 UNION SELECT userid FROM x3"""
ORACLE["stream_batches_city_clicks"] = f"""
WITH {BATCHES}
SELECT strftime(ts, '%Y%m%d') AS date, province, city, adid, count(*) AS click_count
FROM cleaned GROUP BY 1, 2, 3, 4"""
ORACLE["stream_batches_province_top3"] = f"""
WITH {BATCHES},
p AS (SELECT strftime(ts, '%Y%m%d') AS date, province, adid, count(*) AS click_count
      FROM cleaned GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn FROM p)
SELECT date, province, adid, click_count FROM r WHERE rn <= 3"""
ORACLE["stream_line_city_clicks"] = ORACLE["clicks_by_city_ad_day"]
ORACLE["stream_timed_city_clicks"] = ORACLE["clicks_by_city_ad_day"]

# --- late rows: days 10 to 24 arrive last, watermark ten days behind the newest click ----

LATE = """
WITH evk AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
clicks AS (SELECT ts, k % 20 AS adid, date_trunc('minute', ts) AS m,
                  CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1 WHEN ts >= TIMESTAMP '2024-01-25' THEN 2 ELSE 3 END AS part
           FROM evk WHERE event_type = 'click'),
low AS (SELECT max(ts) - INTERVAL 10 DAY AS low FROM clicks WHERE part < 3),
judged AS (SELECT *, part = 3 AND m + INTERVAL 1 MINUTE <= low AS late FROM clicks, low)"""
ORACLE["stream_late_minutes"] = LATE + """
SELECT strftime(m, '%Y%m%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute, adid,
       count(*) AS click_count
FROM judged WHERE NOT late GROUP BY m, adid"""
ORACLE["stream_late_report"] = LATE + """
SELECT part::INT AS part, count(*) AS rows_in, count(*) FILTER (NOT late) AS rows_kept,
       count(*) FILTER (late) AS rows_dropped, count(DISTINCT (m, adid)) FILTER (late) AS late_groups
FROM judged GROUP BY part"""

ORACLE["date_helpers"] = """
WITH d AS (SELECT make_timestamp(epoch_us(now()))::DATE AS today)
SELECT event_type, count(*) AS events, count(*) FILTER (ts::DATE < today) AS before_today,
       count(*) FILTER (ts::DATE < today - 1) AS before_yesterday,
       strftime(any_value(today), '%Y-%m-%d') AS today, strftime(any_value(today) - 1, '%Y-%m-%d') AS yesterday
FROM events, d GROUP BY event_type"""
