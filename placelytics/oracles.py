"""DuckDB SQL for every query, written against the raw tables and independent of the operators."""

from __future__ import annotations

# Logical tables as common table expressions.
_TABLES = """
ev AS (SELECT ts, event_type, user_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
visits AS (
  SELECT CASE WHEN k % 4 < 2 THEN 'T1' ELSE 'T2' END AS user_id,
         concat('P', CAST(k % 4 AS VARCHAR)) AS place_id,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 2 ELSE 0 END AS competitor_id,
         CAST(user_id AS VARCHAR) AS adid, strftime(ts, '%Y-%m-%d') AS date, ts AS datetime
  FROM ev WHERE event_type <> 'purchase'),
place_config AS (
  SELECT DISTINCT user_id, place_id, competitor_id, '2024-01-03' AS start_date FROM visits
  WHERE NOT (place_id = 'P3' AND competitor_id = 2) AND NOT (place_id = 'P2' AND competitor_id = 0)),
shops AS (
  SELECT DISTINCT lpad(CAST(k % 4 AS VARCHAR), 3, '0') AS shop_code,
         concat('P', CAST(k % 4 AS VARCHAR)) AS place_id,
         concat('shop_', CAST(k % 4 AS VARCHAR)) AS caption
  FROM ev),
pos_raw AS (
  SELECT k % 4 AS shop,
         CASE WHEN k % 14 = 13 THEN NULL ELSE concat('item_', CAST(k % 7 AS VARCHAR)) END AS item_name,
         ts AS datetime
  FROM ev WHERE event_type = 'purchase'),
min_counts AS (
  SELECT caption, place_id, CASE WHEN shop_code = '002' THEN 3 ELSE 2 END AS infimum
  FROM shops WHERE shop_code <> '003'),
home_work AS (
  SELECT CAST(c_custkey AS VARCHAR) AS adid, tc AS time_category, r_name AS prefecture,
         n_name AS city, c_mktsegment AS block, '2024-01-01' AS start_date,
         CASE WHEN c_custkey % 3 = 0 THEN '2024-01-15' ELSE '2024-01-31' END AS end_date
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  CROSS JOIN (VALUES ('home'), ('work')) AS v(tc)),
age_gender AS (
  SELECT CAST(c_custkey AS VARCHAR) AS adid, 
         CAST((c_custkey + CASE WHEN sd < '2024-01-01' THEN 1 ELSE 0 END) % 7 * 10 AS INT) AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, sd AS start_date
  FROM customer CROSS JOIN (VALUES ('2023-12-01'), ('2024-01-01')) AS v(sd)),
topics AS (
  SELECT CAST(c_custkey AS VARCHAR) AS adid, c_nationkey % 4 AS topic_id, tn AS topic_number,
         p AS pattern, vr AS ver
  FROM customer CROSS JOIN (VALUES ('preference'), ('behavior')) AS a(p)
  CROSS JOIN (VALUES ('2025-01-01', '10'), ('2025-01-01', '5'), ('2024-01-01', '10')) AS b(vr, tn)),
cohorts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS adid,
         CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE 'interest' END AS visit_category,
         list(DISTINCT o_orderpriority) AS cohortlist, '2024-01-01' AS start_date,
         CASE WHEN o_custkey % 4 = 0 THEN '2024-01-20' ELSE '2024-01-31' END AS end_date
  FROM orders GROUP BY o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE 'interest' END),
spot_catalog AS (
  SELECT s_name AS spot, r_name AS prefecture, n_name AS city, CAST(s_suppkey AS VARCHAR) AS address,
         concat('cat_', CAST(s_suppkey % 5 AS VARCHAR)) AS cohort_caption
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
device_spots AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS adid, spot, prefecture, city, address,
         sd AS start_date, ed AS end_date
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  JOIN spot_catalog ON address = CAST(l_suppkey AS VARCHAR)
  CROSS JOIN (VALUES ('2023-12-01', '2023-12-31'), ('2024-01-01', '2024-01-31')) AS v(sd, ed))
"""

_OWN_DAYS = """
own_days AS (
  SELECT DISTINCT place_id, competitor_id, adid, date FROM visits
  WHERE competitor_id = 0 AND place_id IN (SELECT place_id FROM place_config))
"""

_ALL_DAYS = """
all_days AS (
  SELECT DISTINCT user_id, place_id, competitor_id, adid, date FROM visits
  WHERE user_id IN (SELECT user_id FROM place_config)
    AND place_id IN (SELECT place_id FROM place_config)
    AND competitor_id IN (SELECT competitor_id FROM place_config))
"""

_SHOP_DAYS = """
shop_days AS (
  SELECT DISTINCT user_id, place_id, competitor_id, adid, date FROM visits
  WHERE place_id IN (SELECT place_id FROM shops))
"""

_SALES = """
sales AS (
  SELECT s.shop_code, s.place_id, s.caption, p.item_name, p.datetime
  FROM pos_raw p JOIN shops s ON s.shop_code = lpad(CAST(p.shop AS VARCHAR), 3, '0')
  WHERE p.item_name IS NOT NULL)
"""

_PERIOD = {
    "daily": ("date", "v.date"),
    "weekly": (
        "week_of_monday",
        "CAST(CAST(v.date AS DATE) - CAST(dayofweek(CAST(v.date AS DATE)) - 1 AS INT) AS VARCHAR)",
    ),
    "monthly": ("year_month", "strftime(v.datetime, '%Y-%m')"),
}

_AREAS = "('ASIA', 'AMERICA', 'EUROPE')"


def _with(*tables: str) -> str:
    return "WITH " + ",\n".join(t.strip() for t in (_TABLES, *tables)) + "\n"


def _periods(name: str) -> str:
    column, expression = _PERIOD[name]
    return f"""
periods AS (
  SELECT DISTINCT v.place_id, v.competitor_id, v.adid, {expression} AS {column}
  FROM visits v JOIN (SELECT place_id, competitor_id, min(start_date) AS start_date
                      FROM place_config GROUP BY 1, 2) c
    ON c.place_id = v.place_id AND c.competitor_id = v.competitor_id
  WHERE v.date >= c.start_date)
"""


def _own(name: str) -> str:
    column = _PERIOD[name][0]
    return f"""
own AS (SELECT place_id, competitor_id, {column}, count(adid) AS own_count
        FROM periods GROUP BY place_id, competitor_id, {column})
"""


def _unique(name: str) -> str:
    return _with(_periods(name), _own(name)) + "SELECT * FROM own"


def _overlap(name: str, days: str | None = None) -> str:
    column = _PERIOD[name][0]
    periods = _periods(name)
    if days is not None:
        assert "WHERE " in periods
        periods = periods.replace("WHERE ", f"WHERE v.date {days} AND ", 1)
    return _with(periods, _own(name)) + f"""
SELECT a.{column}, a.place_id, a.competitor_id, b.place_id AS duplication_place_id,
       b.competitor_id AS duplication_competitor_id, count(*) AS duplication_count, o.own_count
FROM periods a
JOIN periods b ON b.adid = a.adid AND b.{column} = a.{column}
 AND (b.place_id <> a.place_id OR b.competitor_id <> a.competitor_id)
JOIN own o ON o.place_id = a.place_id AND o.competitor_id = a.competitor_id AND o.{column} = a.{column}
GROUP BY a.{column}, a.place_id, a.competitor_id, b.place_id, b.competitor_id, o.own_count"""


def _location(minimum: int) -> str:
    return _with(_OWN_DAYS) + f"""
SELECT d.date, d.place_id, d.competitor_id, h.time_category, h.prefecture, h.city, h.block,
       count(d.adid) AS count
FROM own_days d JOIN home_work h ON h.adid = d.adid AND d.date BETWEEN h.start_date AND h.end_date
WHERE h.prefecture IN {_AREAS}
GROUP BY d.date, d.place_id, d.competitor_id, h.time_category, h.prefecture, h.city, h.block
HAVING count(d.adid) >= {minimum}"""


def _cohort(minimum: int) -> str:
    return _with(_OWN_DAYS) + f"""
, unrolled AS (
  SELECT adid, visit_category, unnest(cohortlist) AS cohort, start_date, end_date FROM cohorts
  WHERE visit_category = 'interest')
SELECT d.place_id, d.competitor_id, d.date, c.visit_category, c.cohort, t.topic_id, t.pattern,
       t.topic_number, count(d.adid) AS count
FROM own_days d
JOIN unrolled c ON c.adid = d.adid AND d.date BETWEEN c.start_date AND c.end_date
JOIN topics t ON t.adid = d.adid
WHERE t.ver = '2025-01-01' AND t.topic_number = '10' AND t.pattern = 'preference'
GROUP BY d.place_id, d.competitor_id, d.date, c.visit_category, c.cohort, t.topic_id, t.pattern,
         t.topic_number
HAVING count(d.adid) >= {minimum}"""


def _covisited(period: str, extra: str) -> str:
    return _with(_ALL_DAYS) + f"""
, counts AS (
  SELECT d.place_id, d.competitor_id, s.spot, s.prefecture, s.city, s.address, {period},
         count(d.adid) AS count
  FROM all_days d JOIN device_spots s ON s.adid = d.adid AND d.date BETWEEN s.start_date AND s.end_date
  WHERE s.prefecture IN {_AREAS}{extra}
  GROUP BY d.place_id, d.competitor_id, s.spot, s.prefecture, s.city, s.address, {period})
SELECT n.*, g.cohort_caption
FROM counts n JOIN spot_catalog g
  ON g.spot = n.spot AND g.prefecture = n.prefecture AND g.city = n.city AND g.address = n.address
WHERE g.cohort_caption IN ('cat_0', 'cat_1')"""


def _linked(minutes: int) -> str:
    return f"""
linked AS (
  SELECT DISTINCT v.user_id, v.place_id, v.competitor_id, v.adid, v.date, s.shop_code, s.caption,
         s.item_name
  FROM visits v JOIN sales s ON s.place_id = v.place_id
   AND s.datetime >= v.datetime - INTERVAL {minutes} MINUTE
   AND s.datetime <= v.datetime + INTERVAL {minutes} MINUTE
  WHERE v.competitor_id = 0)
"""


def _link(minutes: int) -> str:
    return _with(_SALES, _linked(minutes)) + "SELECT * FROM linked"


def _buyers(
    join: str, where: str, *attributes: str, competitor: bool = False, fixed: int | None = None
) -> str:
    group = ["l.user_id", "l.place_id", *(["l.competitor_id"] if competitor else []), "l.date"]
    group = ", ".join([*group, "l.caption", "l.shop_code", "l.item_name", *attributes])
    if fixed is not None:
        return _with(_SALES, _linked(30)) + f"""
SELECT {group}, count(l.adid) AS count
FROM linked l JOIN {join} x ON x.adid = l.adid
WHERE {where}
GROUP BY {group}
HAVING count(l.adid) >= {fixed}"""
    return _with(_SALES, _linked(30)) + f"""
SELECT {group}, count(l.adid) AS count
FROM linked l JOIN {join} x ON x.adid = l.adid
JOIN min_counts m ON m.caption = l.caption AND m.place_id = l.place_id
WHERE {where}
GROUP BY {group}, m.infimum
HAVING count(l.adid) >= m.infimum"""


_ROLLING = """
rolling AS (
  SELECT *, visit_count_in_30days - 1 AS visited_30days
  FROM (SELECT *, count(adid) OVER (
          PARTITION BY user_id, place_id, competitor_id, adid
          ORDER BY date_diff('day', DATE '1970-01-01', CAST(date AS DATE))
          RANGE BETWEEN 30 PRECEDING AND CURRENT ROW) AS visit_count_in_30days
        FROM shop_days))
"""


def _rolling(cap: int) -> str:
    return _with(_SHOP_DAYS, _ROLLING) + f"SELECT * FROM rolling WHERE visited_30days <= {cap}"


def _repeat(own: str) -> str:
    return _with(_SHOP_DAYS, _ROLLING, _SALES, _linked(30)) + f"""
SELECT r.date, r.user_id, r.place_id, r.visited_30days, l.caption, l.item_name, count(*) AS count
FROM rolling r
JOIN linked l ON l.user_id = r.user_id AND l.place_id = r.place_id AND l.adid = r.adid AND l.date = r.date
WHERE r.visited_30days <= 15{own}
GROUP BY r.date, r.user_id, r.place_id, r.visited_30days, l.caption, l.item_name"""


def oracle_sql() -> dict[str, str]:
    sql = {f"unique_devices_{name}": _unique(name) for name in _PERIOD}
    sql |= {f"overlap_{name}": _overlap(name) for name in _PERIOD}
    sql |= {
        "unique_devices_weekly_halves": _unique("weekly"),
        "overlap_monthly_halves": _overlap("monthly"),
        "device_days": _with(_OWN_DAYS) + "SELECT * FROM own_days",
        "device_days_all": _with(_ALL_DAYS) + "SELECT * FROM all_days",
        "profile_location": _location(2),
        "profile_location_unsuppressed": _location(1),
        "profile_location_slotted": _location(1),
        "profile_topic": _with(_OWN_DAYS) + """
SELECT d.place_id, d.competitor_id, d.date, t.topic_id, t.pattern, t.topic_number, count(d.adid) AS count
FROM own_days d
JOIN (SELECT DISTINCT place_id, competitor_id FROM place_config) c
  ON c.place_id = d.place_id AND c.competitor_id = d.competitor_id
JOIN topics t ON t.adid = d.adid
WHERE t.ver = '2025-01-01' AND t.topic_number = '10' AND t.pattern = 'preference'
GROUP BY d.place_id, d.competitor_id, d.date, t.topic_id, t.pattern, t.topic_number""",
        "profile_cohort": _cohort(10),
        "profile_cohort_min2": _cohort(2),
        "profile_cohort_split": _cohort(2),
        "covisited_monthly": _covisited("s.start_date", ""),
        "covisited_monthly_slotted": _covisited("s.start_date", ""),
        "covisited_daily": _covisited("d.date", " AND s.start_date = d.date[1:7] || '-01'"),
        "topic_versions": _with() + "SELECT DISTINCT ver FROM topics",
        "pos_sales": _with(_SALES) + """
SELECT shop_code, place_id, caption, item_name, strftime(datetime, '%Y-%m-%d %H:%M:%S.%f') AS datetime
FROM sales""",
        "link_sales_1m": _link(1),
        "link_sales_10m": _link(10),
        "link_sales_30m": _link(30),
        "link_pairs_3m": _with(_SALES) + """
SELECT v.user_id, v.place_id, v.competitor_id, v.adid, v.date, strftime(v.datetime, '%Y-%m-%d %H:%M:%S.%f') AS datetime,
       s.shop_code, s.caption, s.item_name, strftime(s.datetime, '%Y-%m-%d %H:%M:%S.%f') AS sold_at
FROM visits v JOIN sales s ON s.place_id = v.place_id
 AND s.datetime BETWEEN v.datetime - INTERVAL 3 MINUTE AND v.datetime + INTERVAL 3 MINUTE
WHERE v.competitor_id = 0""",
        "linked_devices": _with(_SALES, _linked(30)) + """
SELECT user_id, place_id, competitor_id, date, caption, count(DISTINCT adid) AS count
FROM linked GROUP BY user_id, place_id, competitor_id, date, caption""",
        "linked_visitors": _with(_SALES, _linked(30)) + """
SELECT user_id, place_id, date, caption, shop_code, item_name, count(adid) AS count
FROM linked GROUP BY user_id, place_id, date, caption, shop_code, item_name HAVING count(adid) >= 2""",
        "linked_age_gender": _buyers("age_gender", "x.start_date = '2024-01-01'", "x.age", "x.gender"),
        "linked_age_gender_months": _buyers(
            "age_gender", "x.start_date = l.date[1:7] || '-01'", "x.age", "x.gender"
        ),
        "linked_age_gender_fixed": _buyers(
            "age_gender", "x.start_date = '2024-01-01'", "x.age", "x.gender", fixed=2
        ),
        "overlap_weekly_range": _overlap("weekly", "BETWEEN '2024-01-07' AND '2024-01-20'"),
        "linked_location": _buyers(
            "home_work",
            "x.start_date = '2024-01-01'",
            *["x.time_category", "x.prefecture", "x.city", "x.block"],
        ),
        "linked_topic": _buyers(
            "topics",
            "x.ver = '2025-01-01' AND x.topic_number = '10'",
            *["x.topic_id", "x.pattern", "x.topic_number"],
            competitor=True,
        ),
        "linked_overlap": _with(_SALES, _linked(30)) + """
, own AS (
  SELECT user_id, place_id, competitor_id, date, caption, shop_code, item_name, count(adid) AS own_count
  FROM linked GROUP BY user_id, place_id, competitor_id, date, caption, shop_code, item_name)
SELECT l.user_id, l.place_id, l.competitor_id, l.date, l.caption, l.shop_code, l.item_name,
       v.place_id AS duplication_place_id, v.competitor_id AS duplication_competitor_id,
       count(l.adid) AS count, o.own_count
FROM linked l
JOIN visits v ON v.user_id = l.user_id AND v.place_id = l.place_id AND v.adid = l.adid AND v.date = l.date
JOIN own o ON o.user_id = l.user_id AND o.place_id = l.place_id AND o.competitor_id = l.competitor_id
 AND o.date = l.date AND o.caption = l.caption AND o.shop_code = l.shop_code AND o.item_name = l.item_name
JOIN min_counts m ON m.caption = l.caption AND m.place_id = l.place_id
WHERE v.competitor_id <> 0
GROUP BY l.user_id, l.place_id, l.competitor_id, l.date, l.caption, l.shop_code, l.item_name,
         v.place_id, v.competitor_id, o.own_count, m.infimum
HAVING count(l.adid) >= m.infimum""",
        "visit_gap": _with(_SHOP_DAYS) + """
, history AS (
  SELECT *, lag(date) OVER (PARTITION BY user_id, place_id, competitor_id, adid ORDER BY date) AS previous
  FROM shop_days)
SELECT user_id, place_id, competitor_id, adid, date, coalesce(previous, '0') AS before,
       CAST(coalesce(date_diff('day', CAST(previous AS DATE), CAST(date AS DATE)), 0) AS INT) AS "interval"
FROM history""",
        "rolling_visits": _rolling(15),
        "rolling_visits_cap5": _rolling(5),
        "repeat_by_item": _repeat(""),
        "repeat_by_item_own": _repeat(" AND r.competitor_id = 0"),
    }
    return sql
