"""DuckDB oracle SQL: the same fact derived from ``lineitem`` + ``part`` in one CTE chain,
followed by each query written as plain SQL (close to the reference statements).

Rounding of integer ratios uses the same exact half-away-from-zero rule as
``shelfcast.functions.numeric`` so both engines agree at .5 borders.
"""

from __future__ import annotations


def ratio(num: str, den: str, digits: int) -> str:
    """SQL twin of ``round_ratio``: exact round(num/den, digits) on integers, NULL if den = 0."""
    s = 10 ** digits
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"((2 * abs({n}) * {s} + abs({d})) // (2 * abs({d})))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{q} ELSE {q} END)"
    return f"(CASE WHEN ({d}) IS NULL OR ({d}) = 0 THEN NULL ELSE CAST({signed} AS DOUBLE) / {float(s)!r} END)"


def avg_r(col: str, digits: int) -> str:
    return ratio(f"SUM({col})", f"COUNT({col})", digits)


def pct_r(part: str, whole: str, digits: int) -> str:
    return ratio(f"100 * ({part})", whole, digits)


def dec(col: str) -> str:
    """A money column as an exact decimal of its declared scale."""
    return f"CAST({col} AS DECIMAL(18, 4))"


def avg_money_r(col: str, digits: int = 2) -> str:
    return ratio(f"CAST(SUM({dec(col)}) * 10000 AS HUGEINT)", f"COUNT({col}) * 10000", digits)


def money_r(col: str, digits: int) -> str:
    """The decimal sum, rounded once (half away from zero)."""
    return f"CAST(round(SUM({dec(col)}), {digits}) AS DOUBLE)"


# The fact, rule for rule as in shelfcast.sources.fixture (see FIXTURES.md section 2).
FACT_CTE = """
lines AS (
    SELECT CAST(regexp_extract(p.p_brand, '([0-9]+)', 1) AS INTEGER) AS bn,
           CAST(l.l_suppkey % 10 AS INTEGER) AS sn,
           CAST(l.l_shipdate AS DATE) AS dt,
           CAST(l.l_quantity AS INTEGER) AS q
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
bounds AS (SELECT min(dt) AS d0, CAST(max(dt) - min(dt) AS INTEGER) + 1 AS n_days FROM lines),
daily AS (
    SELECT l.bn, l.sn, CAST(l.dt - b.d0 AS INTEGER) + 1 AS day_num, CAST(SUM(l.q) AS INTEGER) AS units
    FROM lines l, bounds b GROUP BY ALL
),
series AS (
    SELECT bn, sn, min(day_num) AS first_day,
           CASE WHEN bn <= 12 THEN 'FOODS' WHEN bn <= 18 THEN 'HOBBIES' ELSE 'HOUSEHOLD' END AS cat_id,
           CASE WHEN sn < 4 THEN 'CA' WHEN sn < 7 THEN 'TX' ELSE 'WI' END AS state_id,
           CASE WHEN sn < 4 THEN sn + 1 WHEN sn < 7 THEN sn - 3 ELSE sn - 6 END AS store_no
    FROM daily GROUP BY bn, sn
),
series_ids AS (
    SELECT bn, sn, first_day, cat_id, state_id,
           cat_id || '_' || CAST(CASE WHEN cat_id = 'FOODS' THEN bn % 3 + 1 ELSE bn % 2 + 1 END AS VARCHAR) AS dept_id,
           state_id || '_' || CAST(store_no AS VARCHAR) AS store_id
    FROM series
),
series_full AS (
    SELECT *, dept_id || '_' || lpad(CAST(bn AS VARCHAR), CAST(greatest(3, length(CAST(bn AS VARCHAR))) AS INTEGER), '0') AS item_id,
           dept_id || '_' || lpad(CAST(bn AS VARCHAR), CAST(greatest(3, length(CAST(bn AS VARCHAR))) AS INTEGER), '0') || '_' || store_id AS id
    FROM series_ids
),
days AS (SELECT unnest(generate_series(1, n_days)) AS n, d0 FROM bounds),
cal AS (
    SELECT n AS day_num, 'd_' || CAST(n AS VARCHAR) AS d, CAST(d0 + (n - 1) * INTERVAL 1 DAY AS DATE) AS date
    FROM days
),
calendar AS (
    SELECT day_num, d, date,
           CAST((day_num - 1) // 7 + 1 AS INTEGER) AS wm_yr_wk,
           CAST(((date - DATE '1994-12-31') % 7 + 7) % 7 + 1 AS INTEGER) AS wday,
           CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
           CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas'
                WHEN month(date) = 7 AND day(date) = 4 THEN 'IndependenceDay'
                WHEN month(date) = 2 AND day(date) = 14 THEN 'ValentinesDay' END AS event_name_1,
           CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'National'
                WHEN month(date) = 7 AND day(date) = 4 THEN 'National'
                WHEN month(date) = 2 AND day(date) = 14 THEN 'Cultural' END AS event_type_1,
           CASE WHEN month(date) = 7 AND day(date) = 4 AND year(date) % 2 = 0 THEN 'IndependenceDayObserved' END AS event_name_2,
           CASE WHEN month(date) = 7 AND day(date) = 4 AND year(date) % 2 = 0 THEN 'National' END AS event_type_2,
           CAST(day(date) <= 10 AS INTEGER) AS snap_CA,
           CAST(day(date) <= 15 AND day(date) % 2 = 1 AS INTEGER) AS snap_TX,
           CAST(day(date) <= 15 AND day(date) % 3 <> 1 AS INTEGER) AS snap_WI
    FROM cal
),
calendar_named AS (
    SELECT *, ['Saturday', 'Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday'][wday] AS weekday
    FROM calendar
),
base AS (
    SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS bn,
           SUM(CAST(round(p_retailprice * 100) AS BIGINT)) AS s, COUNT(*) AS c
    FROM part GROUP BY 1
),
price_weeks AS (
    SELECT s.bn, s.sn, s.store_id, s.item_id,
           CAST(unnest(generate_series((s.first_day - 1) // 7 + 1, (b.n_days - 1) // 7 + 1)) AS INTEGER) AS wm_yr_wk
    FROM series_full s, bounds b
),
prices AS (
    SELECT w.store_id, w.item_id, w.wm_yr_wk,
           CAST((2 * ((2 * b.s + b.c) // (2 * b.c)) * (100 - 5 * ((((w.wm_yr_wk // 4) * (w.wm_yr_wk // 4)) + w.bn + w.sn) % 5)) + 100) // 200 AS DOUBLE) / 100.0 AS sell_price
    FROM price_weeks w JOIN base b ON w.bn = b.bn
),
grid AS (
    SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, s.bn, s.sn, c.*
    FROM series_full s CROSS JOIN calendar_named c
),
sales_long AS (
    SELECT g.id, g.item_id, g.dept_id, g.cat_id, g.store_id, g.d, CAST(g.day_num AS INTEGER) AS day_num, g.date,
           g.wm_yr_wk, g.weekday, g.wday, g.month, g.year,
           CAST(COALESCE(u.units, 0) AS INTEGER) AS units_sold,
           p.sell_price,
           COALESCE(u.units, 0) * COALESCE(p.sell_price, 0.0) AS revenue,
           g.event_name_1, g.event_type_1, g.event_name_2, g.event_type_2,
           CAST(CASE g.state_id WHEN 'CA' THEN g.snap_CA WHEN 'TX' THEN g.snap_TX WHEN 'WI' THEN g.snap_WI ELSE 0 END AS INTEGER) AS snap_flag,
           CAST(g.event_name_1 IS NOT NULL AS INTEGER) AS has_event,
           g.state_id
    FROM grid g
    LEFT JOIN daily u ON u.bn = g.bn AND u.sn = g.sn AND u.day_num = g.day_num
    LEFT JOIN prices p ON p.store_id = g.store_id AND p.item_id = g.item_id AND p.wm_yr_wk = g.wm_yr_wk
)"""


def with_fact(body: str, extra_ctes: str = "") -> str:
    """``WITH <fact chain>[, extra] <body>``."""
    extra = f",\n{extra_ctes.strip()}" if extra_ctes.strip() else ""
    return f"WITH {FACT_CTE.strip()}{extra}\n{body.strip()}"
