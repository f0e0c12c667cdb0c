"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code: where Spark uses windows, the SQL
often uses self-joins, and vice versa. Stand-in CTEs mirror
``hourgrid/plans/standins.py``.
"""

HOURLY = """
hourly AS (
  SELECT event_type, datetime, target, n,
         CAST(date_diff('day', DATE '2024-01-01', CAST(datetime AS DATE)) AS INTEGER) AS data_block_id,
         event_type IN ('click', 'view') AS is_consumption
  FROM (SELECT event_type, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime,
               CAST(ROUND(CAST(SUM(value) AS DECIMAL(38,6)), 4) AS DOUBLE) AS target, CAST(COUNT(*) AS BIGINT) AS n
        FROM events GROUP BY 1, 2) x)"""

DAILY_DIM = """
daily_dim AS (
  SELECT event_type, CAST(COUNT(DISTINCT user_id) AS DOUBLE) AS eic_count,
         CAST(ROUND(CAST(SUM(value) AS DECIMAL(38,6)), 4) AS DOUBLE) AS installed_capacity,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 2 AS INTEGER) AS data_block_id
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""

DAILY_PRICE = """
daily_price AS (
  SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS data_block_id,
         MIN(value) AS lowest_price_per_mwh, MAX(value) AS highest_price_per_mwh
  FROM events GROUP BY CAST(ts AS DATE))"""

HOUR_PRICE = """
hour_price AS (
  SELECT hour - INTERVAL 2 DAY AS origin_date, euros_per_mwh,
         CAST(date_diff('day', DATE '2024-01-01', CAST(hour AS DATE)) AS INTEGER) AS data_block_id
  FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour,
               CAST(ROUND(CAST(SUM(value) AS DECIMAL(38,6)), 4) AS DOUBLE) / COUNT(*) AS euros_per_mwh
        FROM events GROUP BY 1) x)"""

FLAGS = """
flags AS (
  SELECT CAST(ts AS DATE) AS date, CAST(event_id AS VARCHAR) AS name,
         CASE WHEN value >= 200 THEN event_type ELSE 'none' END AS holiday_type
  FROM events)"""

FLAGS_PIVOT = """
flags_pivot AS (
  SELECT date, bool_or(holiday_type = 'click') AS click, bool_or(holiday_type = 'error') AS error,
         bool_or(holiday_type = 'purchase') AS purchase, bool_or(holiday_type = 'signup') AS signup,
         bool_or(holiday_type = 'view') AS view
  FROM flags GROUP BY date)"""

ORDERS_FACT = """
orders_fact AS (
  SELECT o.o_orderkey, o.o_orderdate, o.o_orderpriority, o.o_orderstatus, o.o_totalprice,
         CAST(c.c_nationkey AS INTEGER) AS c_nationkey, c.c_mktsegment, o.o_orderstatus = 'F' AS is_final
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def rnd(expr: str, k: int) -> str:
    """Half-up rounding through DECIMAL(38,6), matching ``aggregate.rounded``."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {k}) AS DOUBLE)"


SQL: dict[str, str] = {}

SQL["merged_hourly"] = _with(HOURLY, DAILY_DIM, DAILY_PRICE, HOUR_PRICE, FLAGS, FLAGS_PIVOT) + """
SELECT h.event_type, h.datetime, h.target, h.n, h.is_consumption,
       c.eic_count, c.installed_capacity, g.lowest_price_per_mwh, g.highest_price_per_mwh, e.euros_per_mwh,
       COALESCE(f.click, FALSE) AS click, COALESCE(f.error, FALSE) AS error,
       COALESCE(f.purchase, FALSE) AS purchase, COALESCE(f.signup, FALSE) AS signup,
       COALESCE(f.view, FALSE) AS view
FROM hourly h
LEFT JOIN daily_dim c ON c.event_type = h.event_type AND c.data_block_id = h.data_block_id
LEFT JOIN daily_price g ON g.data_block_id = h.data_block_id
LEFT JOIN (SELECT origin_date + INTERVAL 2 DAY AS datetime, euros_per_mwh, data_block_id FROM hour_price) e
       ON e.datetime = h.datetime AND e.data_block_id = h.data_block_id
LEFT JOIN flags_pivot f ON f.date = CAST(h.datetime AS DATE)
"""

SQL["monthly_change"] = _with(ORDERS_FACT) + f"""
, monthly AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month,
         CAST(ROUND(CAST(SUM(o_totalprice) AS DECIMAL(38,6)), 4) AS DOUBLE) AS consumption
  FROM orders_fact WHERE is_final GROUP BY 1)
SELECT month, consumption, consumption - LAG(consumption) OVER (ORDER BY month) AS MoM_diff,
       {rnd("(consumption - LAG(consumption) OVER (ORDER BY month)) / NULLIF(LAG(consumption) OVER (ORDER BY month), 0) * 100.0", 2)} AS MoM_diff_pct
FROM monthly
"""

# ------------------------------------------------------------------ time series

HOLES = """
holes AS (
  SELECT event_type, datetime,
         CASE WHEN date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', datetime) % 17 <> 0 THEN target END AS target
  FROM hourly)"""

_US = {"h": 3_600_000_000, "d": 86_400_000_000}


def _us(text: str) -> int:
    return int(text[:-1]) * _US[text[-1]]


def lag_joins(src: str, lags) -> tuple[str, str]:
    """SELECT list and LEFT JOINs that read the value at exactly t - lag (self-join oracle)."""
    sel, joins = [], []
    for i, lag in enumerate(lags):
        a = f"l{i}"
        sel.append(f"{a}.target AS target_lag_{lag}")
        hours = _us(lag) // _US["h"]
        joins.append(f"LEFT JOIN {src} {a} ON {a}.event_type = b.event_type "
                     f"AND {a}.datetime = b.datetime - to_hours({hours})")
    return ", ".join(sel), "\n".join(joins)


def rolling_select(specs) -> tuple[list[str], list[str]]:
    """Window expressions over [t - w, t) of each lag column, plus WINDOW definitions."""
    exprs, wins = [], {}
    for lag, ws in specs.items():
        for w, funcs in (ws or {}).items():
            wn = f"w_{w}"
            wins[wn] = (f"{wn} AS (PARTITION BY event_type ORDER BY epoch_us(datetime) "
                        f"RANGE BETWEEN {_us(w)} PRECEDING AND 1 PRECEDING)")
            x = f"target_lag_{lag}"
            for fn in funcs:
                name = f"{x}_{w}_win_{fn}"
                if fn == "mean":
                    e = rnd(f"AVG({x}) OVER {wn}", 4)
                elif fn == "std":
                    e = rnd(f"STDDEV_SAMP({x}) OVER {wn}", 4)
                elif fn == "median":
                    e = rnd(f"QUANTILE_CONT({x}, 0.5) OVER {wn}", 4)
                elif fn == "count":
                    e = f"CASE WHEN COUNT(*) OVER {wn} > 0 THEN CAST(COUNT({x}) OVER {wn} AS DOUBLE) END"
                else:
                    raise ValueError(fn)
                exprs.append(f"{e} AS {name}")
    return exprs, list(wins.values())


ROLL_SPECS = {
    "2d": {"6h": ["mean", "std", "median", "count"], "24h": ["mean"], "168h": ["mean"]},
    "3d": None,
    "7d": {"12h": ["mean", "std"]},
}
LAG_SPECS_FEATURES = {"2d": {"6h": ["mean"], "12h": ["mean"], "24h": ["mean"], "168h": ["mean"]},
                      "3d": {"6h": ["mean"], "12h": ["mean"]}, "7d": {"12h": ["mean"], "24h": ["mean"]}}


def _lag_rolling_sql() -> str:
    sel, joins = lag_joins("h", ROLL_SPECS)
    exprs, wins = rolling_select(ROLL_SPECS)
    return _with(HOURLY) + f"""
, h AS (SELECT event_type, datetime, target FROM hourly)
, lagged AS (SELECT b.event_type, b.datetime, b.target, {sel} FROM h b
{joins})
SELECT event_type, datetime, target, {", ".join(f"target_lag_{lag}" for lag in ROLL_SPECS)},
       {", ".join(exprs)}
FROM lagged
WINDOW {", ".join(wins)}
"""


SQL["lag_rolling_features"] = _lag_rolling_sql()


def _feature_table_sql() -> str:
    sel, joins = lag_joins("m", LAG_SPECS_FEATURES)
    exprs, wins = rolling_select(LAG_SPECS_FEATURES)
    merged = SQL["merged_hourly"].replace("SELECT h.event_type", "SELECT h.event_type", 1)
    body = merged.split("\nSELECT h.event_type", 1)
    ctes = body[0]
    merged_select = "SELECT h.event_type" + body[1]
    return ctes + f"""
, m AS ({merged_select})
, lagged AS (SELECT b.*, {sel} FROM m b
{joins})
SELECT lagged.*,
       datetime < TIMESTAMP '2021-10-31 03:00:00'
         OR (datetime >= TIMESTAMP '2022-03-27 03:00:00' AND datetime < TIMESTAMP '2022-10-30 03:00:00')
         OR datetime >= TIMESTAMP '2023-03-26 03:00:00' AS dst,
       CAST(hour(datetime) AS INTEGER) AS hour, CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week,
       CAST(month(datetime) AS INTEGER) AS month, CAST(quarter(datetime) AS INTEGER) AS quarter,
       CAST(dayofmonth(datetime) AS INTEGER) AS day_of_month, CAST(dayofyear(datetime) AS INTEGER) AS day_of_year,
       CAST(weekofyear(datetime) AS INTEGER) AS week_of_year,
       {", ".join(exprs)},
       {rnd("target_lag_2d / NULLIF(installed_capacity, 0)", 4)} AS target_to_capacity,
       {rnd("installed_capacity / NULLIF(eic_count, 0)", 4)} AS capacity_to_eic
FROM lagged
WINDOW {", ".join(wins)}
"""


SQL["feature_table"] = _feature_table_sql()

SQL["capacity_fill"] = _with(HOURLY, HOLES) + """
SELECT event_type, datetime, target,
       COALESCE(target,
                FIRST_VALUE(target IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY datetime
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                LAST_VALUE(target IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY datetime
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                1.0) AS target_filled
FROM holes
"""


def _interp_sql(src: str, out: str, keep_name: bool = False) -> str:
    w = "PARTITION BY event_type ORDER BY datetime"
    value = "target" if not keep_name else "target AS _orig"
    res = "target" if keep_name else out
    return f"""
, pos AS (SELECT event_type, datetime, {value}, ROW_NUMBER() OVER ({w}) AS p FROM {src})
, nb AS (
  SELECT *,
    LAST_VALUE({'_orig' if keep_name else 'target'} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    LAST_VALUE(CASE WHEN {'_orig' if keep_name else 'target'} IS NOT NULL THEN p END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
    FIRST_VALUE({'_orig' if keep_name else 'target'} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
    FIRST_VALUE(CASE WHEN {'_orig' if keep_name else 'target'} IS NOT NULL THEN p END IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
  FROM pos)
SELECT event_type, datetime, {'' if keep_name else 'target, '}
  {rnd(f"CASE WHEN {'_orig' if keep_name else 'target'} IS NOT NULL THEN {'_orig' if keep_name else 'target'} "
       "WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (p - pp) / (np - pp) "
       "WHEN pv IS NOT NULL THEN pv END", 4)} AS {res}
FROM nb
"""


SQL["interpolate_gaps"] = _with(HOURLY, HOLES) + _interp_sql("holes", "target_interp")

SQL["clean_train"] = _with(HOURLY, HOLES) + """
, null_ts AS (SELECT datetime, ROW_NUMBER() OVER (ORDER BY datetime) AS k
              FROM (SELECT DISTINCT datetime FROM holes WHERE target IS NULL OR event_type IS NULL) d)
, kept AS (SELECT * FROM holes WHERE datetime NOT IN (SELECT datetime FROM null_ts WHERE k % 2 = 0))
""" + _interp_sql("kept", "target", keep_name=True)

# ------------------------------------------------------------------ weather

STATIONS = """
stations AS (
  SELECT s_suppkey AS station, lower(n_name) AS county_name, CAST(s_nationkey AS INTEGER) AS county
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""

FGRID = """
fgrid AS (
  SELECT l_suppkey AS station, l_shipdate AS origin_datetime, CAST(l_linenumber * 6 AS INTEGER) AS hours_ahead,
         l_shipdate + to_hours(l_linenumber * 6) AS forecast_datetime,
         CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 2) AS INTEGER) AS data_block_id,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax
  FROM lineitem)"""

HGRID = """
hgrid AS (
  SELECT l_suppkey AS station, l_shipdate + to_hours(l_linenumber * 3) AS datetime,
         CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 2) AS INTEGER) AS data_block_id,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax
  FROM lineitem)"""

_M = ["quantity", "price", "discount", "tax"]


def _county_mean_sql(grid: str, tkeys: str, name: str) -> str:
    avgs = ", ".join(f"{rnd(f'AVG({m})', 4)} AS {m}" for m in _M)
    return f"""
{name} AS (
  SELECT CAST(12 AS INTEGER) AS county, {tkeys}, {avgs}
  FROM (SELECT s.county, g.* EXCLUDE (station) FROM {grid} g JOIN stations s ON s.station = g.station
        WHERE s.county <> 12) x
  GROUP BY {tkeys}
  UNION ALL
  SELECT county, {tkeys}, {avgs}
  FROM (SELECT s.county, g.* EXCLUDE (station) FROM {grid} g JOIN stations s ON s.station = g.station
        WHERE s.county <> 12) y
  GROUP BY county, {tkeys})"""


FKEYS = "origin_datetime, hours_ahead, forecast_datetime, data_block_id"
FCOUNTY = _county_mean_sql("fgrid", FKEYS, "fcounty")
HCOUNTY = _county_mean_sql("hgrid", "datetime, data_block_id", "hcounty")
FDEDUP = """
fdedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY county, forecast_datetime, data_block_id
                                 ORDER BY origin_datetime DESC, hours_ahead DESC) AS rn
    FROM fcounty) z WHERE rn = 1)"""

SQL["forecast_county"] = _with(STATIONS, FGRID, FCOUNTY) + "SELECT * FROM fcounty"
SQL["forecast_dedup"] = _with(STATIONS, FGRID, FCOUNTY, FDEDUP) + "SELECT * FROM fdedup"
SQL["history_county"] = _with(STATIONS, HGRID, HCOUNTY) + "SELECT * FROM hcounty"

COUNTY_FACT = """
county_fact AS (
  SELECT county, datetime, target,
         CAST(floor(date_diff('day', DATE '1995-01-01', CAST(datetime AS DATE)) / 2) AS INTEGER) AS data_block_id
  FROM (SELECT CAST(s_nationkey AS INTEGER) AS county, l_shipdate + to_hours(l_linenumber * 6) AS datetime,
               CAST(ROUND(CAST(SUM(l_extendedprice) AS DECIMAL(38,6)), 4) AS DOUBLE) AS target
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) x)"""


def _pref(alias: str, p: str) -> str:
    return ", ".join(f"{alias}.{m} AS {p}_{m}" for m in _M)


def _stored(cte: str) -> str:
    """A CTE that is computed once, however often it is read."""
    return cte.replace(" AS (", " AS MATERIALIZED (", 1)


SQL["weather_joined"] = _with(STATIONS, FGRID, HGRID, _stored(FCOUNTY), _stored(HCOUNTY), _stored(FDEDUP), _stored(COUNTY_FACT)) + f"""
SELECT c.county, c.datetime, c.target, {_pref("f0", "f0d")}, {_pref("f1", "f1d")}, {_pref("h2", "h2d")},
       {_pref("h1", "h1d")}
FROM county_fact c
LEFT JOIN fdedup f0 ON f0.county = c.county AND f0.forecast_datetime + INTERVAL 1 DAY = c.datetime
                   AND f0.data_block_id = c.data_block_id
LEFT JOIN fdedup f1 ON f1.county = c.county AND f1.forecast_datetime = c.datetime
                   AND f1.data_block_id = c.data_block_id
LEFT JOIN hcounty h2 ON h2.county = c.county AND h2.datetime + INTERVAL 2 DAY = c.datetime
                   AND (CASE WHEN hour(h2.datetime) <= 10 THEN h2.data_block_id + 1 ELSE h2.data_block_id END)
                       = c.data_block_id
LEFT JOIN hcounty h1 ON h1.county = c.county AND h1.datetime + INTERVAL 1 DAY = c.datetime
                   AND h1.data_block_id = c.data_block_id
"""

# ------------------------------------------------------------------ batch 3

_MERGED_CTES, _MERGED_BODY = SQL["merged_hourly"].split("\nSELECT h.event_type", 1)
MERGED = _MERGED_CTES + "\n, merged AS (SELECT h.event_type" + _MERGED_BODY + ")\n"

SQL["weather_forecast_joined"] = _with(STATIONS, FGRID, _stored(FCOUNTY), _stored(FDEDUP), _stored(COUNTY_FACT)) + """
SELECT c.county, c.datetime, f0.price AS f0d_price, f1.price AS f1d_price FROM county_fact c
LEFT JOIN (SELECT county, forecast_datetime + INTERVAL 1 DAY AS t, data_block_id, price FROM fdedup) f0
       ON f0.county = c.county AND f0.t = c.datetime AND f0.data_block_id = c.data_block_id
LEFT JOIN fdedup f1 ON f1.county = c.county AND f1.forecast_datetime = c.datetime AND f1.data_block_id = c.data_block_id
"""

SQL["weather_history_joined"] = _with(STATIONS, HGRID, _stored(HCOUNTY), _stored(COUNTY_FACT)) + """
SELECT c.county, c.datetime, h2.price AS h2d_price, h1.price AS h1d_price FROM county_fact c
LEFT JOIN (SELECT county, datetime + INTERVAL 2 DAY AS t, price,
                  CASE WHEN hour(datetime) <= 10 THEN data_block_id + 1 ELSE data_block_id END AS block FROM hcounty) h2
       ON h2.county = c.county AND h2.t = c.datetime AND h2.block = c.data_block_id
LEFT JOIN (SELECT county, datetime + INTERVAL 1 DAY AS t, price, data_block_id FROM hcounty) h1
       ON h1.county = c.county AND h1.t = c.datetime AND h1.data_block_id = c.data_block_id
"""

SQL["weather_joined_alt"] = _with(STATIONS, FGRID, HGRID, FCOUNTY, HCOUNTY, COUNTY_FACT) + f"""
SELECT c.county, c.datetime, c.target, {_pref("f1", "f1")}, {_pref("h2", "h2")}
FROM county_fact c
JOIN fcounty f1 ON f1.county = c.county AND f1.forecast_datetime = c.datetime AND f1.data_block_id = c.data_block_id
JOIN hcounty h2 ON h2.county = c.county AND h2.datetime + INTERVAL 2 DAY = c.datetime
"""

SQL["forecast_county_union"] = SQL["forecast_county"]

SQL["dedupe_readings"] = _with(HGRID) + """
SELECT station, datetime, data_block_id, quantity, price, discount, tax FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY station, datetime, data_block_id
                               ORDER BY quantity, price, discount, tax) AS rn FROM hgrid) z WHERE rn = 1
"""

SQL["null_profile"] = MERGED + """
SELECT COUNT(*) FILTER (WHERE target IS NULL) AS target_nulls,
       COUNT(*) FILTER (WHERE datetime IS NULL) AS datetime_nulls,
       COUNT(*) FILTER (WHERE eic_count IS NULL) AS eic_count_nulls,
       COUNT(*) FILTER (WHERE installed_capacity IS NULL) AS installed_capacity_nulls,
       COUNT(*) FILTER (WHERE lowest_price_per_mwh IS NULL) AS lowest_price_per_mwh_nulls,
       COUNT(*) FILTER (WHERE highest_price_per_mwh IS NULL) AS highest_price_per_mwh_nulls,
       COUNT(*) FILTER (WHERE euros_per_mwh IS NULL) AS euros_per_mwh_nulls
FROM merged
"""

_PROFILE_COLS = [("datetime", "timestamp_ntz"), ("event_type", "string"), ("target", "double"), ("n", "bigint"),
                 ("is_consumption", "boolean"), ("eic_count", "double"), ("installed_capacity", "double"),
                 ("lowest_price_per_mwh", "double"), ("highest_price_per_mwh", "double"),
                 ("euros_per_mwh", "double"), ("click", "boolean"), ("error", "boolean"),
                 ("purchase", "boolean"), ("signup", "boolean"), ("view", "boolean")]
SQL["column_profile"] = MERGED + "\n".join(
    ("SELECT " if i == 0 else "UNION ALL SELECT ")
    + f"CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", COUNT({c}) AS non_null, '{t}' AS dtype FROM merged"
    for i, (c, t) in enumerate(_PROFILE_COLS)
)

SQL["first_rows"] = MERGED + """
SELECT * FROM merged ORDER BY datetime, event_type, is_consumption, target, n, eic_count LIMIT 5
"""

SQL["series_completeness"] = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS number_of_timeseries, MIN(number_of_entries) AS min_entries,
       {rnd("AVG(number_of_entries)", 2)} AS avg_entries,
       CAST(PERCENTILE_DISC(0.5) WITHIN GROUP (ORDER BY number_of_entries) AS BIGINT) AS median_entries,
       MAX(number_of_entries) AS max_entries
FROM (SELECT user_id, event_type, COUNT(value) AS number_of_entries FROM events GROUP BY 1, 2) t
"""

_OSUM = "CAST(ROUND(CAST(SUM(o_totalprice) AS DECIMAL(38,6)), 4) AS DOUBLE)"

SQL["avg_monthly_by_flag"] = _with(ORDERS_FACT) + f"""
SELECT is_final, {rnd("AVG(sum_target)", 2)} / 1000000.0 AS avg_monthly_target_GWh
FROM (SELECT date_trunc('month', o_orderdate) AS month, is_final, {_OSUM} AS sum_target
      FROM orders_fact GROUP BY 1, 2) t
GROUP BY is_final
"""

SQL["growth_rate"] = _with(ORDERS_FACT) + f"""
, per_ts AS (SELECT o_orderdate, {_OSUM} AS v FROM orders_fact WHERE o_totalprice IS NOT NULL GROUP BY 1)
, bounds AS (SELECT MIN(o_orderdate) AS first_dt, MAX(o_orderdate) AS last_dt FROM per_ts)
, vals AS (SELECT SUM(CASE WHEN o_orderdate = first_dt THEN v END) AS first_val,
                  SUM(CASE WHEN o_orderdate = last_dt THEN v END) AS last_val FROM per_ts, bounds)
SELECT {rnd("(POWER(last_val / first_val, 1.0 / (date_diff('second', first_dt, last_dt) / 86400.0 / 365.25)) - 1) * 100", 2)}
       AS capacity_CAGR
FROM bounds, vals
"""


def _cat_sql(cat: str) -> str:
    return _with(ORDERS_FACT) + f"""
SELECT {cat}, is_final, {rnd("AVG(o_totalprice)", 2)} AS avg_hourly_target, {_OSUM} AS total_target
FROM orders_fact GROUP BY {cat}, is_final
"""


SQL["category_segment"] = _cat_sql("c_mktsegment")
SQL["category_priority"] = _cat_sql("o_orderpriority")
SQL["category_nation"] = _cat_sql("c_nationkey")
SQL["category_all"] = _with(ORDERS_FACT) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS category, CAST({c} AS VARCHAR) AS category_value, is_final, "
    f"{rnd('AVG(o_totalprice)', 2)} AS avg_hourly_target, {_OSUM} AS total_target "
    f"FROM orders_fact GROUP BY {c}, is_final"
    for c in ["c_mktsegment", "o_orderpriority", "c_nationkey"]
)

SQL["top5_month"] = _with(ORDERS_FACT) + f"""
SELECT c_nationkey, c_mktsegment, {_OSUM} AS consumption
FROM orders_fact
WHERE is_final AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'
GROUP BY 1, 2
ORDER BY consumption DESC, c_nationkey, c_mktsegment
LIMIT 5
"""

SQL["daily_moving_avg"] = _with(ORDERS_FACT) + f"""
, daily AS (SELECT CAST(o_orderdate AS DATE) AS date, {_OSUM} AS consumption
            FROM orders_fact WHERE is_final AND c_mktsegment = 'BUILDING' GROUP BY 1)
, ma AS (SELECT date, consumption,
                {rnd("AVG(consumption) OVER (ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 4)} AS consumption_MA_3d,
                {rnd("AVG(consumption) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 4)} AS consumption_MA_7d
         FROM daily)
SELECT CAST(date AS TIMESTAMP) AS date, consumption, consumption_MA_3d, consumption_MA_7d
FROM ma WHERE date >= DATE '1996-03-01' AND date < DATE '1996-04-01'
"""

SQL["holiday_pivot"] = _with(FLAGS, FLAGS_PIVOT) + "SELECT * REPLACE (CAST(date AS TIMESTAMP) AS date) FROM flags_pivot"

_CYC = [("hour", "hour(ts)", 24.0), ("day_of_week", "isodow(ts) - 1", 7.0), ("day_of_month", "dayofmonth(ts)", 30.4),
        ("month", "month(ts)", 12.0), ("day_of_year", "dayofyear(ts)", 365.0),
        ("week_of_year", "weekofyear(ts)", 52.0), ("quarter", "quarter(ts)", 4.0)]
SQL["calendar_features"] = "SELECT event_id, ts, " + ", ".join(
    f"CAST({e} AS INTEGER) AS {n}" for n, e, _ in _CYC
) + """,
       ts < TIMESTAMP '2021-10-31 03:00:00'
         OR (ts >= TIMESTAMP '2022-03-27 03:00:00' AND ts < TIMESTAMP '2022-10-30 03:00:00')
         OR ts >= TIMESTAMP '2023-03-26 03:00:00' AS dst, """ + ", ".join(
    f"{rnd(f'CAST(CAST({fn}(2 * pi() * ({e}) / {p}) AS FLOAT) AS DOUBLE)', 4)} AS {n}_{fn}"
    for n, e, p in _CYC for fn in ("sin", "cos")
) + " FROM events"

SQL["scalar_functions"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       l_shipdate + INTERVAL 36 HOUR AS ship_plus_36h,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS ship_month,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ship_day,
       CAST(round((l_discount * 10 + 55.0) * 10) AS INTEGER) AS grid_lat,
       CASE WHEN abs(l_tax / 100.0 * 1000.0) >= 0.1 THEN l_tax / 100.0 * 1000.0 ELSE 0.0 END AS precip_mm,
       {rnd("sqrt(l_quantity * l_quantity + (l_discount * 100) * (l_discount * 100))", 6)} AS windspeed,
       {rnd("-l_quantity * sin(radians(l_linenumber * 45))", 6)} AS u_component,
       {rnd("-l_quantity * cos(radians(l_linenumber * 45))", 6)} AS v_component,
       CASE WHEN l_extendedprice - 50000.0 < 0.0 THEN 0.0 ELSE l_extendedprice - 50000.0 END AS clipped,
       {rnd("l_tax * 10.0 * 0.1", 6)} AS snow_mm,
       {rnd("l_extendedprice / NULLIF(l_discount, 0)", 4)} AS price_per_discount,
       abs(l_extendedprice - l_quantity * 1000.0) AS abs_err,
       CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS label,
       CAST(round_even(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS price_even,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS price_up,
       date_diff('microsecond', TIMESTAMP '1995-01-01', l_shipdate) / 1e6 AS elapsed_s,
       l_shipdate + to_hours(l_linenumber) AS ship_plus_lines_h
FROM lineitem
"""

SQL["yield_target"] = MERGED + f"""
, y AS (SELECT event_type, datetime, installed_capacity,
               CASE WHEN NOT is_consumption THEN target / (CASE WHEN installed_capacity < 1.0 THEN 1.0
                                                           ELSE installed_capacity END) END AS yv
        FROM merged)
SELECT event_type, datetime, {rnd("yv", 6)} AS yield,
       {rnd("yv * (CASE WHEN installed_capacity < 1.0 THEN 1.0 ELSE installed_capacity END)", 4)} AS target_back
FROM y
"""

SQL["time_span"] = _with(HOURLY) + """
SELECT MIN(datetime) AS first_ts, MAX(datetime) AS last_ts, date_diff('hour', MIN(datetime), MAX(datetime)) AS span_hours
FROM hourly
"""

SQL["value_counts"] = """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2
"""

SQL["distinct_values"] = _with(HOURLY, HOLES) + "SELECT DISTINCT datetime FROM holes WHERE target IS NULL"

SQL["range_filter"] = _with(HOURLY) + """
SELECT * FROM hourly
WHERE datetime BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-14 23:00:00' AND event_type = 'click'
"""

SQL["not_null_filter"] = _with(HOURLY) + """
SELECT * FROM hourly WHERE date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', datetime) % 17 <> 0
"""

SQL["semi_join_filter"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
"""

SQL["anti_join_filter"] = """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey)
  AND o_orderpriority IN ('1-URGENT', '2-HIGH')
"""

SQL["train_window"] = _with(HOURLY) + """
SELECT event_type, datetime, target, is_consumption FROM hourly
WHERE datetime BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-21 23:00:00'
"""

SQL["duplicate_line_keys"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

SQL["cast_and_fill"] = MERGED + """
SELECT event_type, datetime, COALESCE(CAST(eic_count AS DOUBLE), 0.0) AS eic,
       COALESCE(installed_capacity, 1.0) AS capacity, CAST(n AS INTEGER) AS n
FROM merged
"""

# ------------------------------------------------------------------ backtest

SQL["month_folds"] = _with(ORDERS_FACT) + """
, b AS (SELECT MIN(o_orderdate) AS start FROM orders_fact)
SELECT 'test' AS kind, CAST(r.fold AS INTEGER) AS fold, start AS train_start,
       start + to_months(CAST(60 + r.fold AS INTEGER)) - INTERVAL 1 HOUR AS train_end,
       start + to_months(CAST(60 + r.fold AS INTEGER)) AS test_start,
       start + to_months(CAST(61 + r.fold AS INTEGER)) - INTERVAL 1 HOUR AS test_end
FROM b CROSS JOIN range(0, 4) r(fold)
"""

SHARE_FOLDS = """
share_b AS (SELECT MIN(CAST(datetime AS DATE)) AS d0, MAX(CAST(datetime AS DATE)) AS d1 FROM hourly),
share_c AS (
  SELECT CAST(d0 AS TIMESTAMP) AS ts0, CAST(d1 AS TIMESTAMP) + INTERVAL 1 DAY AS end_excl,
         CAST(ceil(CAST((date_diff('day', d0, d1) + 1) * 86400000000000 AS DOUBLE) * 0.64 / 86400000000000.0) AS BIGINT) AS train_days,
         CAST(ceil(CAST((date_diff('day', d0, d1) + 1) * 86400000000000 AS DOUBLE) * 0.16 / 86400000000000.0) AS BIGINT) AS val_days
  FROM share_b),
share_d AS (
  SELECT *, ts0 + to_days(CAST(train_days AS INTEGER)) AS val_start,
         ts0 + to_days(CAST(train_days + val_days AS INTEGER)) AS test_start0,
         CAST(ceil(val_days / 3.0) AS BIGINT) AS val_step
  FROM share_c),
share_e AS (
  SELECT *, CAST(ceil(date_diff('hour', test_start0, end_excl) / 72.0) AS BIGINT) AS test_step FROM share_d),
folds AS (
  SELECT 'val' AS kind, CAST(r.fold AS INTEGER) AS fold,
         ts0 + to_days(CAST(r.fold * val_step AS INTEGER)) AS train_start,
         val_start + to_days(CAST(r.fold * val_step AS INTEGER)) - INTERVAL 1 HOUR AS train_end,
         val_start + to_days(CAST(r.fold * val_step AS INTEGER)) AS test_start,
         val_start + to_days(CAST(r.fold * val_step AS INTEGER)) + INTERVAL 1 DAY + INTERVAL 23 HOUR AS test_end
  FROM share_e CROSS JOIN range(0, 3) r(fold)
  UNION ALL
  SELECT 'test', CAST(r.fold AS INTEGER),
         ts0 + to_days(CAST(val_days + r.fold * test_step AS INTEGER)),
         test_start0 + to_days(CAST(r.fold * test_step AS INTEGER)) - INTERVAL 1 HOUR,
         test_start0 + to_days(CAST(r.fold * test_step AS INTEGER)),
         test_start0 + to_days(CAST(r.fold * test_step AS INTEGER)) + INTERVAL 1 DAY + INTERVAL 23 HOUR
  FROM share_e CROSS JOIN range(0, 3) r(fold))"""

SQL["share_folds"] = _with(HOURLY, SHARE_FOLDS) + "SELECT * FROM folds"

LABELLED = """
lh AS (SELECT event_type, datetime, target, is_consumption FROM hourly),
lagged2 AS (
  SELECT b.*, l2.target AS target_lag_2d, l7.target AS target_lag_7d FROM lh b
  LEFT JOIN lh l2 ON l2.event_type = b.event_type AND l2.datetime = b.datetime - INTERVAL 2 DAY
  LEFT JOIN lh l7 ON l7.event_type = b.event_type AND l7.datetime = b.datetime - INTERVAL 7 DAY),
labelled AS (
  SELECT x.*, f.kind, f.fold,
         CASE WHEN x.datetime >= f.test_start THEN 'test'
              WHEN x.datetime >= date_trunc('day', f.train_end) - INTERVAL 3 DAY THEN 'eval'
              ELSE 'train' END AS part
  FROM lagged2 x JOIN folds f ON x.datetime BETWEEN f.train_start AND f.test_end)"""

_LAB = _with(HOURLY, SHARE_FOLDS, LABELLED)

SQL["fold_membership"] = _LAB + "SELECT event_type, datetime, kind, fold, part FROM labelled"

SQL["naive_scores"] = _LAB + f"""
SELECT kind, fold, is_consumption, part, {rnd("AVG(abs(target - target_lag_2d))", 4)} AS mae,
       COUNT(abs(target - target_lag_2d)) AS n_scored
FROM labelled WHERE target_lag_2d IS NOT NULL GROUP BY 1, 2, 3, 4
"""

SQL["mae_ratio"] = _LAB + f"""
, sc AS (SELECT kind, fold, is_consumption, part, AVG(abs(target - target_lag_2d)) AS mae
         FROM labelled WHERE target_lag_2d IS NOT NULL GROUP BY 1, 2, 3, 4)
, w AS (SELECT kind, fold, is_consumption, MAX(CASE WHEN part = 'train' THEN mae END) AS train_mae,
               MAX(CASE WHEN part = 'test' THEN mae END) AS test_mae FROM sc GROUP BY 1, 2, 3)
SELECT kind, fold, is_consumption, {rnd("train_mae", 4)} AS train_mae, {rnd("test_mae", 4)} AS test_mae,
       {rnd("train_mae / NULLIF(test_mae, 0)", 4)} AS ratio
FROM w
"""

SQL["error_percentiles"] = _LAB + f"""
SELECT is_consumption,
       {rnd("quantile_cont(abs(target - target_lag_2d), 0.5)", 4)} AS p50,
       {rnd("quantile_cont(abs(target - target_lag_2d), 0.6)", 4)} AS p60,
       {rnd("quantile_cont(abs(target - target_lag_2d), 0.75)", 4)} AS p75
FROM labelled WHERE target_lag_2d IS NOT NULL AND part = 'test' GROUP BY 1
"""

SQL["residuals_by_hour"] = _LAB + f"""
SELECT is_consumption, CAST(hour(datetime) AS INTEGER) AS hour, CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week,
       {rnd("AVG(abs(target - target_lag_2d))", 4)} AS mae
FROM labelled WHERE target_lag_2d IS NOT NULL AND part = 'test' GROUP BY 1, 2, 3
"""

SQL["residuals_weekly"] = _LAB + f"""
SELECT event_type,
       CAST(CAST(datetime AS DATE) + CAST((7 - isodow(datetime)) % 7 AS INTEGER) AS TIMESTAMP) AS week,
       {rnd("AVG(abs(target - target_lag_2d))", 4)} AS mae
FROM labelled WHERE target_lag_2d IS NOT NULL AND part = 'test' GROUP BY 1, 2
"""

SQL["score_compare"] = _LAB + f"""
, s2 AS (SELECT kind, fold, is_consumption, AVG(abs(target - target_lag_2d)) AS mae_lag_2d,
                COUNT(*) AS n_lag_2d
         FROM labelled WHERE part = 'test' AND target_lag_2d IS NOT NULL GROUP BY 1, 2, 3)
, s7 AS (SELECT kind, fold, is_consumption, AVG(abs(target - target_lag_7d)) AS mae_lag_7d,
                COUNT(*) AS n_lag_7d
         FROM labelled WHERE part = 'test' AND target_lag_7d IS NOT NULL GROUP BY 1, 2, 3)
SELECT s2.kind, s2.fold, s2.is_consumption, {rnd("mae_lag_2d", 4)} AS mae_lag_2d, n_lag_2d,
       {rnd("mae_lag_7d", 4)} AS mae_lag_7d, n_lag_7d
FROM s2 LEFT JOIN s7 ON s2.kind = s7.kind AND s2.fold = s7.fold AND s2.is_consumption = s7.is_consumption
"""

SQL["supplier_daily_features"] = f"""
WITH daily AS (SELECT l_suppkey, l_shipdate AS day, CAST(ROUND(CAST(SUM(l_extendedprice) AS DECIMAL(38,6)), 4) AS DOUBLE) AS revenue
               FROM lineitem GROUP BY 1, 2)
, lagged AS (
  SELECT b.*, a.revenue AS revenue_lag_7d, c.revenue AS revenue_lag_28d, e.revenue AS revenue_lag_364d FROM daily b
  LEFT JOIN daily a ON a.l_suppkey = b.l_suppkey AND a.day = b.day - INTERVAL 7 DAY
  LEFT JOIN daily c ON c.l_suppkey = b.l_suppkey AND c.day = b.day - INTERVAL 28 DAY
  LEFT JOIN daily e ON e.l_suppkey = b.l_suppkey AND e.day = b.day - INTERVAL 364 DAY)
SELECT l_suppkey, day, revenue, revenue_lag_7d, revenue_lag_28d, revenue_lag_364d,
  {rnd("AVG(revenue_lag_7d) OVER w28", 4)} AS revenue_lag_7d_28d_win_mean,
  {rnd("STDDEV_SAMP(revenue_lag_7d) OVER w28", 4)} AS revenue_lag_7d_28d_win_std,
  CASE WHEN COUNT(*) OVER w28 > 0 THEN CAST(COUNT(revenue_lag_7d) OVER w28 AS DOUBLE) END AS revenue_lag_7d_28d_win_count,
  {rnd("QUANTILE_CONT(revenue_lag_7d, 0.5) OVER w7", 4)} AS revenue_lag_7d_7d_win_median
FROM lagged
WINDOW w28 AS (PARTITION BY l_suppkey ORDER BY epoch_us(day) RANGE BETWEEN {28 * 86_400_000_000} PRECEDING AND 1 PRECEDING),
       w7 AS (PARTITION BY l_suppkey ORDER BY epoch_us(day) RANGE BETWEEN {7 * 86_400_000_000} PRECEDING AND 1 PRECEDING)
"""

# The SQL-text reports (S8) must equal their DataFrame twins.
for _name in ["null_profile", "series_completeness", "avg_monthly_by_flag", "growth_rate", "category_segment",
              "monthly_change", "top5_month", "daily_moving_avg", "first_rows"]:
    SQL[f"sql_{_name}"] = SQL[_name]

SQL["sql_merged"] = _with(HOURLY, DAILY_DIM, DAILY_PRICE, HOUR_PRICE) + """
SELECT h.event_type, h.datetime, h.target, h.is_consumption, h.data_block_id,
       c.eic_count, c.installed_capacity, g.lowest_price_per_mwh, g.highest_price_per_mwh, e.euros_per_mwh
FROM hourly h
LEFT JOIN daily_dim c ON c.event_type = h.event_type AND c.data_block_id = h.data_block_id
LEFT JOIN daily_price g ON g.data_block_id = h.data_block_id
LEFT JOIN hour_price e ON e.origin_date + INTERVAL 2 DAY = h.datetime AND e.data_block_id = h.data_block_id
"""

SQL["drop_nulls"] = _with(HOURLY) + """
SELECT event_type, datetime, target, data_block_id FROM hourly
WHERE date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', datetime) % 17 <> 0
  AND event_type IS NOT NULL AND datetime IS NOT NULL AND target IS NOT NULL AND data_block_id IS NOT NULL
"""

SQL["day_partition_roundtrip"] = _with(HOURLY) + """
SELECT *, CAST(CAST(datetime AS DATE) AS TIMESTAMP) AS day FROM hourly
WHERE CAST(datetime AS DATE) >= DATE '2024-01-03' AND CAST(datetime AS DATE) < DATE '2024-01-10'
"""

SQL["csv_roundtrip"] = "SELECT * FROM orders"
SQL["json_map_roundtrip"] = """
SELECT CAST(n_nationkey AS INTEGER) AS county,
       n_name || ':' || CAST(COALESCE(c.n, 0) AS VARCHAR) AS county_name
FROM nation LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1) c ON c.c_nationkey = n_nationkey
"""

SQL["top_bottom_items"] = f"""
WITH m AS (SELECT l_returnflag, l_suppkey, AVG(l_quantity) AS mq FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY mq DESC NULLS LAST, l_suppkey) AS rank_top,
             ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY mq ASC NULLS LAST, l_suppkey) AS rank_bottom
      FROM m)
SELECT l_returnflag, l_suppkey, {rnd("mq", 6)} AS mean_l_quantity, rank_top, rank_bottom
FROM r WHERE rank_top <= 5 OR rank_bottom <= 5
"""

SQL["csv_flags_roundtrip"] = """
SELECT event_id, ts, value, value >= 100 AS is_high, event_type = 'view' AS is_view FROM events
"""

SQL["negated_list"] = """
SELECT event_id, CASE WHEN event_type <> 'click' THEN event_type END AS kind FROM events WHERE event_type NOT IN ('view', 'error')
"""

SQL["null_group_percentiles"] = f"""
SELECT kind, {rnd("quantile_cont(value, 0.25)", 4)} AS p25, {rnd("quantile_cont(value, 0.5)", 4)} AS p50, {rnd("quantile_cont(value, 0.9)", 4)} AS p90
FROM (SELECT value, CASE WHEN event_type <> 'click' THEN event_type END AS kind FROM events) e GROUP BY kind
"""

SQL["fine_sums"] = f"""
SELECT l_returnflag, l_linestatus, {rnd("SUM(l_tax / 1000.0)", 5)} AS total_target FROM lineitem GROUP BY 1, 2
"""

SQL["station_names"] = """
SELECT s_suppkey AS station, lower(n_name) AS county_name, CAST(s_nationkey AS INTEGER) AS county
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

SQL["declared_tables"] = _with(HOURLY) + "SELECT event_type, datetime, target, n FROM hourly"

SQL["holdout_remainder"] = _with(HOURLY) + """
SELECT event_type, datetime, CASE WHEN rn <= 100 THEN 'sample' ELSE 'rest' END AS part FROM (
  SELECT event_type, datetime,
         ROW_NUMBER() OVER (ORDER BY md5(event_type || '|' || strftime(datetime, '%Y-%m-%d %H:%M:%S'))) AS rn FROM hourly) z
"""

SQL["column_kinds"] = _with(ORDERS_FACT) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS non_null, '{t}' AS dtype FROM orders_fact"
    for c, t in [("o_orderpriority", "string"), ("o_orderstatus", "string"), ("c_mktsegment", "string"),
                 ("is_final", "boolean"), ("c_nationkey", "int")])

SQL["linear_trend"] = f"""
SELECT COUNT(*) AS n, {rnd("regr_slope(l_extendedprice, l_quantity)", 2)} AS slope,
       {rnd("regr_intercept(l_extendedprice, l_quantity)", 1)} AS intercept FROM lineitem
"""

SQL["calendar_years"] = """
SELECT l_orderkey, l_linenumber, ts, """ + ", ".join(f"CAST({e} AS INTEGER) AS {n}" for n, e, _ in _CYC) + """,
       ts < TIMESTAMP '2021-10-31 03:00:00'
         OR (ts >= TIMESTAMP '2022-03-27 03:00:00' AND ts < TIMESTAMP '2022-10-30 03:00:00')
         OR ts >= TIMESTAMP '2023-03-26 03:00:00' AS dst
FROM (SELECT l_orderkey, l_linenumber, l_shipdate + INTERVAL 27 YEAR + to_hours(CAST(3 * l_linenumber AS INTEGER)) AS ts FROM lineitem) t
"""

SQL["prediction_rows"] = _LAB + """
SELECT event_type, datetime, kind, fold, is_consumption, target, 'linear' AS model_label, TRUE AS scored
FROM labelled WHERE part = 'test' AND kind = 'test'
"""

SQL["best_lag"] = _LAB + f"""
, e AS (SELECT 'lag_2d' AS model_label, fold, AVG(abs(target - target_lag_2d)) AS mae FROM labelled
        WHERE part = 'test' AND kind = 'val' AND target_lag_2d IS NOT NULL GROUP BY fold
        UNION ALL
        SELECT 'lag_7d', fold, AVG(abs(target - target_lag_7d)) FROM labelled
        WHERE part = 'test' AND kind = 'val' AND target_lag_7d IS NOT NULL GROUP BY fold)
, m AS (SELECT model_label, AVG(mae) AS mean_mae, COUNT(*) AS n_folds FROM e GROUP BY 1)
SELECT model_label, {rnd("mean_mae", 4)} AS mean_mae, n_folds, mean_mae = (SELECT MIN(mean_mae) FROM m) AS is_best FROM m
"""


def boosted_tree_ctes(depth: int, least: int) -> str:
    """CTEs ``tree`` (and its parts) of one boosted tree: all splits of all nodes are tried level by level."""
    parts = ["""
l0 AS (SELECT 1 AS node, (SELECT AVG(l_extendedprice) FROM lineitem) - l_extendedprice AS g,
              CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem),
tops AS (SELECT 0 AS feature, MAX(x0) AS top FROM l0 UNION ALL SELECT 1, MAX(x1) FROM l0 UNION ALL SELECT 2, MAX(x2) FROM l0)"""]
    for k in range(depth + 1):
        parts.append(f"t{k} AS (SELECT node, SUM(g) AS tg, COUNT(*) AS tn, SUM(g * g) AS tgg FROM l{k} GROUP BY node)")
        if k == depth:
            break
        values = " UNION ALL ".join(f"SELECT node, {f} AS feature, x{f} AS v, SUM(g) AS g, COUNT(*) AS n FROM l{k} GROUP BY node, x{f}" for f in range(3))
        parts.append(f"""
c{k} AS (SELECT node, feature, v, SUM(g) OVER w AS lg, SUM(n) OVER w AS ln,
                COALESCE((SELECT SUM(g) FROM h{k} m WHERE m.node = h{k}.node AND m.feature = h{k}.feature AND m.v IS NULL), 0) AS mg,
                COALESCE((SELECT SUM(n) FROM h{k} m WHERE m.node = h{k}.node AND m.feature = h{k}.feature AND m.v IS NULL), 0) AS mn
         FROM h{k} WHERE v IS NOT NULL WINDOW w AS (PARTITION BY node, feature ORDER BY v)),
s{k} AS (SELECT node, feature, v, TRUE AS to_left, lg + mg AS lg, ln + mn AS ln FROM c{k} UNION ALL SELECT node, feature, v, FALSE, lg, ln FROM c{k}),
g{k} AS (SELECT s{k}.*, tn, lg * lg / ln + (tg - lg) * (tg - lg) / NULLIF(tn - ln, 0) - tg * tg / tn AS gain, tgg FROM s{k} JOIN t{k} USING (node)
         WHERE ln >= {least} AND tn - ln >= {least}),
b{k} AS (SELECT * FROM g{k} WHERE ROUND(gain / tgg, 9) > 0
         QUALIFY row_number() OVER (PARTITION BY node ORDER BY ROUND(gain / tgg, 9) DESC, feature, v, to_left DESC) = 1),
l{k + 1} AS (SELECT 2 * l.node + CASE WHEN x IS NULL THEN CAST(NOT to_left AS INTEGER) ELSE CAST(x > v AS INTEGER) END AS node, g, x0, x1, x2
             FROM (SELECT l{k}.*, b{k}.v, b{k}.to_left, CASE feature WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END AS x FROM l{k} JOIN b{k} USING (node)) l)""".replace(
            f"c{k} AS", f"h{k} AS ({values}),\nc{k} AS", 1))
    splits = " UNION ALL ".join(f"SELECT b.node, b.feature, b.v, b.to_left, t.tn, b.gain, -t.tg / t.tn AS value FROM b{k} b JOIN t{k} t ON t.node = b.node" for k in range(depth))
    leaves = " UNION ALL ".join([f"SELECT node, NULL, NULL, NULL, tn, NULL, -tg / tn FROM t{k} WHERE node NOT IN (SELECT node FROM b{k})" for k in range(depth)]
                                + [f"SELECT node, NULL, NULL, NULL, tn, NULL, -tg / tn FROM t{depth}"])
    parts.append(f"tree AS ({splits} UNION ALL {leaves})")
    return ", ".join(parts)


_NAMES = "CASE tree.feature WHEN 0 THEN 'quantity' WHEN 1 THEN 'discount' WHEN 2 THEN 'tax' END"

SQL["boosted_tree"] = "WITH " + boosted_tree_ctes(3, 50) + f"""
SELECT CAST(node AS INTEGER) AS node, {_NAMES} AS feature, CASE WHEN v < top THEN v END AS threshold, to_left AS missing_left,
       CAST(tn AS BIGINT) AS n_rows, {rnd("gain / 1e6", 2)} AS gain_millions, {rnd("value", 3)} AS value
FROM tree LEFT JOIN tops ON tops.feature = tree.feature
"""

SQL["boosted_gains"] = "WITH " + boosted_tree_ctes(3, 50) + f"""
SELECT {_NAMES} AS feature, {rnd("SUM(gain) / 1e6", 2)} AS gain_millions, COUNT(*) AS n_splits, CAST(SUM(tn) AS BIGINT) AS n_rows
FROM tree WHERE feature IS NOT NULL GROUP BY 1
"""

SQL["stopping_rounds"] = f"""
WITH sums AS (SELECT l_returnflag, CAST(l_linenumber AS INTEGER) AS round, SUM(l_extendedprice) AS s, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
means AS (SELECT l_returnflag AS f, SUM(s) / SUM(n) AS mean FROM sums GROUP BY 1),
errors AS (SELECT a.l_returnflag, a.round, {rnd("abs(SUM(b.s) / SUM(b.n) - MAX(mean))", 2)} AS error
           FROM sums a JOIN sums b ON b.l_returnflag = a.l_returnflag AND b.round <= a.round JOIN means ON f = a.l_returnflag GROUP BY 1, 2),
best AS (SELECT e.l_returnflag, e.round, (SELECT MIN(x.round) FROM errors x WHERE x.l_returnflag = e.l_returnflag AND x.round <= e.round
                AND x.error = (SELECT MIN(y.error) FROM errors y WHERE y.l_returnflag = e.l_returnflag AND y.round <= e.round)) AS best FROM errors e),
stops AS (SELECT l_returnflag, COALESCE(MIN(CASE WHEN round - best >= 2 THEN round END), MAX(round)) AS stop_round FROM best GROUP BY 1)
SELECT s.l_returnflag, b.best AS best_round, s.stop_round FROM stops s JOIN best b ON b.l_returnflag = s.l_returnflag AND b.round = s.stop_round
"""

_EIGHT = " UNION ALL ".join(f"SELECT x.target, {k} AS candidate, l.target AS preds, f.fold FROM hourly x JOIN folds f ON x.datetime BETWEEN f.test_start AND f.test_end AND f.kind = 'val' "
                            f"JOIN hourly l ON l.event_type = x.event_type AND l.datetime = x.datetime - INTERVAL {k} DAY" for k in range(1, 9))

SQL["halving_rungs"] = _with(HOURLY, SHARE_FOLDS) + f"""
, errs AS (SELECT candidate, fold, AVG(abs(target - preds)) AS mae FROM ({_EIGHT}) GROUP BY 1, 2)
, r0 AS (SELECT candidate, AVG(mae) AS e, row_number() OVER (ORDER BY AVG(mae), candidate) AS place FROM errs WHERE fold <= 0 GROUP BY 1)
, r1 AS (SELECT candidate, AVG(mae) AS e, row_number() OVER (ORDER BY AVG(mae), candidate) AS place FROM errs
         WHERE fold <= 1 AND candidate IN (SELECT candidate FROM r0 WHERE place <= (SELECT ceil(COUNT(*) / 2.0) FROM r0)) GROUP BY 1)
, r2 AS (SELECT candidate, AVG(mae) AS e, row_number() OVER (ORDER BY AVG(mae), candidate) AS place FROM errs
         WHERE fold <= 2 AND candidate IN (SELECT candidate FROM r1 WHERE place <= (SELECT ceil(COUNT(*) / 2.0) FROM r1)) GROUP BY 1)
, every AS (SELECT 0 AS rung, *, (SELECT COUNT(*) FROM r0) AS n FROM r0 UNION ALL SELECT 1, *, (SELECT COUNT(*) FROM r1) FROM r1
            UNION ALL SELECT 2, *, (SELECT COUNT(*) FROM r2) FROM r2)
SELECT CAST(rung AS INTEGER) AS rung, CAST(candidate AS INTEGER) AS candidate, {rnd("e", 4)} AS mean_error, CAST(place AS INTEGER) AS place,
       place <= ceil(n / 2.0) AS survives FROM every
"""

SQL["ddl_gas_prices"] = _with(DAILY_PRICE) + """
SELECT CAST(DATE '2024-01-01' + data_block_id AS TIMESTAMP) AS forecast_date, CAST(lowest_price_per_mwh AS FLOAT) AS lowest_price_per_mwh,
       CAST(highest_price_per_mwh AS FLOAT) AS highest_price_per_mwh, CAST(DATE '2024-01-01' + data_block_id - 1 AS TIMESTAMP) AS origin_date, data_block_id
FROM daily_price
"""

SQL["ddl_clients"] = _with(ORDERS_FACT) + f"""
, kinds AS (SELECT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS product_type
            FROM (SELECT DISTINCT c_mktsegment FROM orders_fact WHERE c_nationkey IS NOT NULL))
SELECT k.product_type, c_nationkey AS county, CAST(COUNT(*) AS INTEGER) AS eic_count, {rnd("SUM(o_totalprice)", 2)} AS installed_capacity,
       is_final AS is_business, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date,
       CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS data_block_id
FROM orders_fact o JOIN kinds k ON k.c_mktsegment = o.c_mktsegment WHERE c_nationkey IS NOT NULL
GROUP BY k.product_type, c_nationkey, is_final, CAST(o_orderdate AS DATE)
"""

SQL["versioned_reload"] = _with(HOURLY) + "SELECT event_type, datetime, n * 10 AS n FROM hourly WHERE n > 1"

SQL["naive_scores_sliced"] = SQL["naive_scores"]

SQL["sketched_percentiles"] = _with(ORDERS_FACT) + """
SELECT c_mktsegment, q, COUNT(*) AS n, TRUE AS within FROM orders_fact CROSS JOIN (VALUES (0.05::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.95::DOUBLE)) v(q)
WHERE o_totalprice IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY c_mktsegment, q
"""

SQL["clustered_range"] = """
SELECT l_suppkey, l_shipdate, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_suppkey BETWEEN 10 AND 40 AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
"""

SQL["sliding_median"] = f"""
WITH daily AS (SELECT l_suppkey, l_shipdate AS day, CAST(ROUND(CAST(SUM(l_extendedprice) AS DECIMAL(38,6)), 4) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, day, revenue, {rnd("m", 4)} AS revenue_28d_win_median
FROM (SELECT *, median(revenue) OVER (PARTITION BY l_suppkey ORDER BY day RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS m FROM daily)
"""
