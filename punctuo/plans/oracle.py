"""Oracle SQL (DuckDB dialect) for the named queries.

Each string re-states a query's semantics independently of Spark, over the raw
test tables (views ``events``, ``orders`` ... are registered by the checker).
Doubles are rounded to 6 decimals like the Spark side; DuckDB's HUGEINT sums
are cast back to BIGINT and DECIMAL literals are avoided (``::DOUBLE``).
"""

from __future__ import annotations

# --- fixed values of the test tables and labels, stated here again so that a
# --- wrong constant in the library shows as a difference ---------------------
YEAR_A, YEAR_B = 1999, 2000
LOAD_EDGES = (0, 10, 12, 14, 16, 20, 100, 120, 140, 160, 1_000_000_000)
LOAD_NAMES = ("(0, 10]", "(10, 12]", "(12, 14]", "(14, 16]", "(16, 20]", "(20, 100]", "(100, 120]", "(120, 140]", "(140, 160]", "(160, 1e+09]")
GUST_EDGES = (0, 150, 200, 250, 300, 350, 400, 1_000_000_000)
GUST_NAMES = ("[0, 150)", "[150, 200)", "[200, 250)", "[250, 300)", "[300, 350)", "[350, 400)", "[400, 1e+09)")
DELAY_EDGES = (-2000, 0, 15, 30, 60, 5000)
DELAY_NAMES = ("early", "0–15 min", "15–30 min", "30–60 min", "≥ 60 min")
BAD_RAIN_FROM = "2024-01-21"
PLACE_MONTHS = ("1995-01-01", "2001-08-01")
PERIODS = {"jul-sep": (7, 8, 9), "dec": (12,), "from-apr": (4, 5, 6, 7, 8, 9, 10, 11, 12)}
PLACE_ATTRS = ("place_id", "name", "region", "lat", "lon", "distance_km", "area")
CATEGORICAL = ("direction", "aircraft", "runway", "airline")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
NULL_REASONS = {"place_code": "no code in the source", "direction": "code other than departure/arrival"}
NULL_REASON_OTHER = "flight without a matched place"
# --- end of fixed values ------------------------------------------------------

R = lambda e, name: f"round({e}, 6) AS {name}"


def _case_bin(expr: str, edges, closed: str) -> str:
    parts = []
    for i in range(1, len(edges)):
        lo, hi = float(edges[i - 1]), float(edges[i])
        if closed == "right":
            parts.append(f"WHEN {expr} > {lo}::DOUBLE AND {expr} <= {hi}::DOUBLE THEN {i}")
        else:
            parts.append(f"WHEN {expr} >= {lo}::DOUBLE AND {expr} < {hi}::DOUBLE THEN {i}")
    return "CASE " + " ".join(parts) + " END"


def _case_label(expr: str, labels) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {i} THEN '{lab}'" for i, lab in enumerate(labels, 1)) + " END"


def _names(expr: str, names, base: int) -> str:
    arr = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return f"{arr}[{expr} + {1 - base}]"


# ------------------------------------------------------------------ binding CTEs
FEV = """flights_ev AS (
  SELECT event_id AS flight_id, ts AS planned_ts, CAST(ts AS DATE) AS day,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
         value - 20.0 AS delay_min, COALESCE(value - 20.0 >= 15.0, false) AS is_late,
         CASE WHEN event_id % 2 = 0 THEN 'departure' ELSE 'arrival' END AS direction,
         event_type AS aircraft, 'A' || CAST(user_id % 40 AS VARCHAR) AS airline,
         'R' || CAST(event_id % 4 AS VARCHAR) AS runway,
         'NATION_' || CAST(user_id % 25 AS VARCHAR) AS place_code
  FROM events)"""

FOR = """flights_or AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_no, CAST(o.o_orderdate AS DATE) AS day,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
         CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS weekday,
         l.l_quantity - 20.0 AS delay_min, COALESCE(l.l_quantity - 20.0 >= 15.0, false) AS is_late,
         CASE l.l_returnflag WHEN 'A' THEN 'departure' WHEN 'R' THEN 'arrival' END AS direction,
         p.p_brand AS airline, p.p_type AS aircraft,
         CASE WHEN o.o_orderkey % 50 = 0 THEN NULL WHEN o.o_orderkey % 49 = 0 THEN 'XXXX'
              WHEN o.o_orderkey % 10 = 1 THEN 'N' || CAST(n.n_nationkey AS VARCHAR) ELSE n.n_name END AS place_code
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN part p ON l.l_partkey = p.p_partkey)"""

PLACES = """places_b AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS place_id, n.n_name AS name, r.r_name AS region,
         CASE WHEN n.n_nationkey = 24 THEN NULL ELSE n.n_name END AS key_a,
         'N' || CAST(n.n_nationkey AS VARCHAR) AS key_b,
         -60.0::DOUBLE + 5.0::DOUBLE * CAST(n.n_nationkey AS DOUBLE) AS lat,
         -170.0::DOUBLE + 14.0::DOUBLE * CAST(n.n_nationkey AS DOUBLE) AS lon,
         n.n_nationkey = 21 AS is_home
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
home AS (SELECT arg_min(lat, place_id) AS h_lat, arg_min(lon, place_id) AS h_lon FROM places_b WHERE is_home),
places_d AS (
  SELECT p.*, 12742.0::DOUBLE * asin(sqrt(pow(sin((radians(p.lat) - radians(h.h_lat)) / 2), 2)
           + cos(radians(h.h_lat)) * cos(radians(p.lat)) * pow(sin((radians(p.lon) - radians(h.h_lon)) / 2), 2))) AS distance_km
  FROM places_b p, home h),
places_geo AS (
  SELECT *, CASE WHEN distance_km IS NULL OR isnan(distance_km) THEN NULL
                 WHEN distance_km >= 3500.0 THEN 'intercontinental' ELSE 'europe and around' END AS area
  FROM places_d),
pa AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key_a ORDER BY place_id) AS rn
                                   FROM places_geo WHERE key_a IS NOT NULL) WHERE rn = 1),
pb AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key_b ORDER BY place_id) AS rn
                                   FROM places_geo WHERE key_b IS NOT NULL) WHERE rn = 1)"""


def _lookup_cols(attrs) -> str:
    return ", ".join(f"COALESCE(a.{x}, b.{x}) AS {x}" for x in attrs)


MATCHED = "CASE WHEN a.name IS NOT NULL THEN 'key_a' WHEN b.name IS NOT NULL THEN 'key_b' END AS matched_by"

ENR = f"""enriched_or AS (
  SELECT f.*, {_lookup_cols(PLACE_ATTRS)}, {MATCHED}
  FROM flights_or f LEFT JOIN pa a ON f.place_code = a.key_a LEFT JOIN pb b ON f.place_code = b.key_b)"""

WEV = """weather_raw AS (
  SELECT CAST(ts AS DATE) AS day,
         max(value) FILTER (WHERE event_type = 'error') AS g,
         avg(value) FILTER (WHERE event_type = 'view') - 33.0::DOUBLE AS tavg,
         greatest(avg(value) FILTER (WHERE event_type = 'click') - 35.0::DOUBLE, 0.0::DOUBLE) AS prcp,
         1000.0::DOUBLE + avg(value) FILTER (WHERE event_type = 'purchase') - 30.0::DOUBLE AS pres
  FROM events GROUP BY 1),
weather_ev AS (
  SELECT day, tavg, tavg - 5.0::DOUBLE AS tmin, prcp,
         (CASE WHEN dayofmonth(day) % 10 = 0 THEN NULL ELSE g END) / 3.5::DOUBLE AS wspd,
         CASE WHEN dayofmonth(day) % 10 = 0 THEN NULL ELSE g END AS wpgt, pres
  FROM weather_raw)"""


def _raw_select(where: str, extra_seconds: int) -> str:
    return f"""SELECT CAST(event_id AS VARCHAR) AS "Identifier", strftime(ts, '%d/%m/%Y') AS "STD",
         strftime(ts, '%H:%M:%S') AS "STA_STD_ltc",
         strftime(ts + to_seconds(CAST(floor(value * 60) AS BIGINT) + {extra_seconds}), '%H:%M:%S') AS "ATA_ATD_ltc",
         ' ' || (CASE WHEN event_id % 3 = 0 THEN 'EZY' ELSE 'LX' END) || CAST(user_id AS VARCHAR) || ' ' AS "FLT",
         CASE event_id % 5 WHEN 0 THEN 'X' WHEN 1 THEN 'S' WHEN 2 THEN 'L' WHEN 3 THEN 'S' ELSE 'L' END AS "LSV",
         CASE WHEN event_id % 7 = 0 THEN '-' ELSE 'G' || CAST(event_id % 30 AS VARCHAR) END AS "GAT",
         event_type AS "ACT",
         CASE WHEN event_id % 11 = 0 THEN '#N/A' ELSE 'NATION_' || CAST(user_id % 25 AS VARCHAR) END AS "Org/Des"
  FROM events {where}"""


RAW_COLS = ("Identifier", "STD", "STA_STD_ltc", "ATA_ATD_ltc", "FLT", "LSV", "GAT", "ACT", "Org/Des")
RAW = f"raw_ev AS ({_raw_select('', 0)})"
RAW_DUP = (f"raw_ev AS ({_raw_select('', 0)} UNION ALL {_raw_select('WHERE event_id < 50', 0)} "
           f"UNION ALL {_raw_select('WHERE event_id >= 50 AND event_id < 100', 60)})")


def _tok(c: str) -> str:
    return f"CASE WHEN trim(\"{c}\") IN ('-', '#N/A', '') THEN NULL ELSE trim(\"{c}\") END AS \"{c}\""


CLEAN = f"""raw_t AS (SELECT DISTINCT {', '.join(_tok(c) for c in RAW_COLS)} FROM raw_ev),
c1 AS (SELECT *, strptime("STD" || ' ' || "STA_STD_ltc", '%d/%m/%Y %H:%M:%S') AS planned_ts,
              strptime("STD" || ' ' || "ATA_ATD_ltc", '%d/%m/%Y %H:%M:%S') AS actual0,
              CAST(strptime("STD", '%d/%m/%Y') AS DATE) AS day0 FROM raw_t),
c2 AS (SELECT *, date_diff('microsecond', planned_ts, actual0) / 60000000.0::DOUBLE AS raw_delay FROM c1),
c3 AS (SELECT *, COALESCE(raw_delay < -720.0::DOUBLE, false) AS rolled_over FROM c2),
c4 AS (SELECT *, CASE WHEN rolled_over THEN actual0 + INTERVAL 1 DAY ELSE actual0 END AS actual_ts FROM c3),
clean_ev AS (
  SELECT "Identifier", "FLT" AS flight_no, "LSV", "GAT", "ACT" AS aircraft, "Org/Des" AS place_code,
         planned_ts, rolled_over, actual_ts, raw_delay,
         date_diff('microsecond', planned_ts, actual_ts) / 60000000.0::DOUBLE AS delay_min,
         COALESCE(date_diff('microsecond', planned_ts, actual_ts) / 60000000.0::DOUBLE >= 15.0::DOUBLE, false) AS is_late,
         day0 AS day, CAST(year(day0) AS INTEGER) AS year, CAST(month(day0) AS INTEGER) AS month,
         CAST(isodow(day0) - 1 AS INTEGER) AS weekday, CAST(hour(planned_ts) AS INTEGER) AS hour,
         CASE "LSV" WHEN 'S' THEN 'departure' WHEN 'L' THEN 'arrival' END AS direction,
         CASE WHEN regexp_matches("FLT", '^..\\p{{L}}') THEN substring("FLT", 1, 3) ELSE substring("FLT", 1, 2) END AS airline
  FROM c4)"""

SEV = """scored_ev AS (
  SELECT *, round((hour * 4 + weekday * 3 + flight_id % 17) / 140.0::DOUBLE, 4) AS p_late,
         CAST(hour AS DOUBLE) - 5.0::DOUBLE AS pred_min FROM flights_ev),
split_days AS (
  SELECT day, rk <= ceil(nd * 0.2::DOUBLE) AS is_test FROM (
    SELECT day, row_number() OVER (ORDER BY md5(CAST(day AS VARCHAR) || '42'), day) AS rk, count(*) OVER () AS nd
    FROM (SELECT DISTINCT day FROM scored_ev WHERE day IS NOT NULL))),
scored_split AS (SELECT s.*, d.is_test FROM scored_ev s JOIN split_days d USING (day)),
test_scored AS (SELECT * FROM scored_split WHERE is_test)"""


def sql(ctes, body: str) -> str:
    """WITH <ctes> <body>; a body that starts with more CTEs is joined by a comma."""
    body = body.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return "WITH " + ",\n".join(ctes) + sep + body


def summary_cols(delay="delay_min", flag="is_late") -> str:
    return (f"count(*) AS n, {R(f'avg({delay})', 'avg_delay')}, {R(f'median({delay})', 'median_delay')}, "
            f"{R(f'avg(CAST({flag} AS DOUBLE)) * 100.0::DOUBLE', 'late_pct')}")


# ------------------------------------------------------------------ per-query SQL
ORACLE: dict[str, str] = {}

ORACLE["clean_rollover"] = sql([RAW, CLEAN], f"""
SELECT flight_no, planned_ts, actual_ts, {R('delay_min', 'delay_min')}, {R('delay_min - 1440.0::DOUBLE', 'delay_uncorrected')}
FROM clean_ev WHERE rolled_over""")

ORACLE["clean_metrics"] = sql([RAW_DUP, CLEAN], f"""
SELECT (SELECT count(*) FROM raw_ev) AS raw_rows, CAST({len(RAW_COLS)} AS INTEGER) AS raw_cols,
       (SELECT count(*) FROM raw_ev) - count(*) AS duplicate_rows,
       count(*) - count(DISTINCT "Identifier") - max(CAST("Identifier" IS NULL AS INTEGER)) AS duplicate_ids,
       count_if(rolled_over) AS rollovers, {R('min(raw_delay)', 'min_before')},
       {R('min(delay_min)', 'min_after')}, {R('max(delay_min)', 'max_after')}
FROM clean_ev""")

ORACLE["build_report"] = sql([RAW_DUP, CLEAN, PLACES], f"""
looked AS (SELECT c.*, {MATCHED} FROM clean_ev c LEFT JOIN pa a ON c.place_code = a.key_a LEFT JOIN pb b ON c.place_code = b.key_b)
SELECT (SELECT count(*) FROM raw_ev) AS raw_rows, count(*) AS "rows", (SELECT count(*) FROM raw_ev) - count(*) AS duplicate_rows,
       count_if(rolled_over) AS rollovers, {R('min(raw_delay)', 'min_before')}, {R('min(delay_min)', 'min_after')},
       {R('max(delay_min)', 'max_after')}, {R('avg(delay_min)', 'avg_delay')},
       count_if(matched_by = 'key_a') AS via_key_a, count_if(matched_by = 'key_b') AS via_key_b,
       count_if(place_code IS NULL) AS without_code, count_if(place_code IS NOT NULL AND matched_by IS NULL) AS code_unknown
FROM looked""")

ORACLE["duplicate_keys"] = sql([RAW_DUP, CLEAN], """
SELECT "Identifier", count(*) AS n_rows FROM clean_ev GROUP BY "Identifier" HAVING count(*) > 1""")

ORACLE["calendar_and_prefix"] = sql([RAW, CLEAN], f"""
SELECT "Identifier" AS flight_key, day, year, month, weekday,
       {_names('weekday', WEEKDAYS, 0)} AS weekday_name, {_names('month', MONTHS, 1)} AS month_name,
       hour, direction, airline, flight_no
FROM clean_ev""")

_FACT_ATTRS = ("name", "region", "lat", "lon", "distance_km", "area")
ORACLE["fact_table"] = sql([RAW, CLEAN, PLACES, WEV], f"""
looked AS (
  SELECT c.*, {_lookup_cols(_FACT_ATTRS)}, {MATCHED}
  FROM clean_ev c LEFT JOIN pa a ON c.place_code = a.key_a LEFT JOIN pb b ON c.place_code = b.key_b),
w AS (SELECT l.*, w.tavg, w.tmin, w.prcp, w.wspd, w.wpgt, w.pres, COALESCE(w.tmin < 0.0::DOUBLE, false) AS frost
      FROM looked l LEFT JOIN weather_ev w USING (day)),
h AS (SELECT day, hour, count(*) AS hour_load, avg(delay_min) AS ha FROM w GROUP BY day, hour),
h2 AS (SELECT day, hour, hour_load, CAST(sum(hour_load) OVER (PARTITION BY day) AS BIGINT) AS day_load,
              max(ha) OVER (PARTITION BY day ORDER BY hour RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev_hour_delay
       FROM h)
SELECT w."Identifier", w.flight_no, w."LSV", w."GAT", w.aircraft, w.place_code, w.rolled_over,
       {R('w.delay_min', 'delay_min')}, w.is_late, w.day, w.year, w.month, w.weekday, w.hour, w.direction, w.airline,
       w.name, w.region, {R('w.lat', 'lat')}, {R('w.lon', 'lon')}, {R('w.distance_km', 'distance_km')}, w.area,
       w.matched_by, {R('w.tavg', 'tavg')}, {R('w.tmin', 'tmin')}, {R('w.prcp', 'prcp')}, {R('w.wspd', 'wspd')},
       {R('w.wpgt', 'wpgt')}, {R('w.pres', 'pres')}, w.frost, h2.hour_load, h2.day_load,
       {R('h2.prev_hour_delay', 'prev_hour_delay')}
FROM w LEFT JOIN h2 USING (day, hour)""")

ORACLE["bad_period_check"] = sql([WEV], f"""
SELECT count_if(day >= DATE '{BAD_RAIN_FROM}') AS suspect_days,
       {R(f"avg(CASE WHEN day >= DATE '{BAD_RAIN_FROM}' THEN prcp END)", 'mean_inside')},
       {R(f"avg(CASE WHEN NOT (day >= DATE '{BAD_RAIN_FROM}') THEN prcp END)", 'mean_outside')}
FROM weather_ev""")

ORACLE["bad_period_null"] = sql([WEV], f"""
SELECT day, {R('tavg', 'tavg')}, {R('tmin', 'tmin')},
       {R(f"CASE WHEN day >= DATE '{BAD_RAIN_FROM}' THEN NULL ELSE prcp END", 'prcp')},
       {R('wspd', 'wspd')}, {R('wpgt', 'wpgt')}, {R('pres', 'pres')}
FROM weather_ev""")

ORACLE["summary_direction_hour"] = sql([FEV], f"""
SELECT direction, hour, {summary_cols()}
FROM flights_ev WHERE direction IS NOT NULL AND hour IS NOT NULL
GROUP BY direction, hour HAVING count(*) >= 100""")

_HL = "hl AS (SELECT day, hour, count(*) AS hour_load FROM flights_ev GROUP BY day, hour)"
_LOAD_BIN = _case_bin("h.hour_load", LOAD_EDGES, "right")
ORACLE["summary_load_class"] = sql([FEV, _HL], f"""
f AS (SELECT f.*, {_LOAD_BIN} AS load_bin FROM flights_ev f LEFT JOIN hl h USING (day, hour))
SELECT direction, load_bin, {summary_cols()}, {_case_label('load_bin', LOAD_NAMES)} AS load_class
FROM f WHERE direction IS NOT NULL AND load_bin IS NOT NULL
GROUP BY direction, load_bin HAVING count(*) >= 200""")

ORACLE["load_class_ends"] = sql([FEV, _HL], f"""
f AS (SELECT f.*, {_LOAD_BIN} AS load_bin FROM flights_ev f LEFT JOIN hl h USING (day, hour)),
s AS (SELECT load_bin, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct FROM f WHERE load_bin IS NOT NULL
      GROUP BY load_bin HAVING count(*) >= 200)
SELECT min(load_bin) AS first_bin, {R('arg_min(late_pct, load_bin)', 'first_late_pct')},
       max(load_bin) AS last_bin, {R('arg_max(late_pct, load_bin)', 'last_late_pct')} FROM s""")

_HOURS = list(range(6, 23))
ORACLE["heat_weekday_hour"] = sql([FEV], f"""s AS (
  SELECT weekday, hour, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct FROM flights_ev
  WHERE weekday IS NOT NULL AND hour IS NOT NULL GROUP BY weekday, hour HAVING count(*) >= 30 AND hour BETWEEN 6 AND 22),
g AS (SELECT weekday, {', '.join(f'max(CASE WHEN hour = {h} THEN late_pct END) AS h{h:02d}' for h in _HOURS)} FROM s GROUP BY weekday),
spine AS (SELECT CAST(range AS INTEGER) AS weekday FROM range(7))
SELECT spine.weekday, {_names('spine.weekday', WEEKDAYS, 0)} AS weekday_name,
       {', '.join(R(f'g.h{h:02d}', f'h{h:02d}') for h in _HOURS)}
FROM spine LEFT JOIN g USING (weekday)""")

ORACLE["compare_groups"] = sql([FOR], f"""
SELECT *, CAST(row_number() OVER (ORDER BY late_pct DESC, airline) AS INTEGER) AS late_rank
FROM (SELECT * FROM (SELECT airline, {summary_cols()} FROM flights_or WHERE airline IS NOT NULL
                     GROUP BY airline HAVING count(*) >= 100)
      ORDER BY n DESC, airline LIMIT 12)""")


def _timeline(src: str, bucket: str, rolling: bool) -> str:
    roll = ""
    window = ""
    if rolling:
        roll = (", " + R("CASE WHEN count(late_pct) OVER w >= 4 THEN avg(late_pct) OVER w END", "late_pct_roll")
                + ", " + R("CASE WHEN count(avg_delay) OVER w >= 4 THEN avg(avg_delay) OVER w END", "avg_delay_roll"))
        window = "\nWINDOW w AS (PARTITION BY series ORDER BY bucket ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"
    return f"""base AS (SELECT {bucket} AS bucket, direction, delay_min, is_late FROM {src}),
t AS (SELECT 'all' AS series, bucket, count(*) AS n, avg(delay_min) AS avg_delay,
             avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct FROM base WHERE bucket IS NOT NULL GROUP BY bucket
      UNION ALL
      SELECT direction, bucket, count(*), avg(delay_min), avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE
      FROM base WHERE bucket IS NOT NULL AND direction IS NOT NULL GROUP BY direction, bucket)
SELECT series, bucket, n, {R('avg_delay', 'avg_delay')}, {R('late_pct', 'late_pct')}{roll} FROM t{window}"""


ORACLE["timeline_day_rolling"] = sql([FEV], _timeline("flights_ev", "day", True))
ORACLE["timeline_week"] = sql([FEV], _timeline("flights_ev", "CAST(date_trunc('week', day) AS DATE)", False))
ORACLE["timeline_month"] = sql([FOR], _timeline("flights_or", "CAST(date_trunc('month', day) AS DATE)", False))

ORACLE["arg_extremes"] = sql([FEV], f"""s AS (
  SELECT direction, hour, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct FROM flights_ev
  WHERE direction IS NOT NULL AND hour IS NOT NULL GROUP BY direction, hour HAVING count(*) >= 100),
d AS (SELECT weekday, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct FROM flights_ev
      WHERE weekday IS NOT NULL GROUP BY weekday)
SELECT * FROM (SELECT 'max_hour' AS kind, direction || '|' || CAST(hour AS VARCHAR) AS key, {R('late_pct', 'value')}
               FROM s ORDER BY late_pct DESC, direction, hour LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'min_hour', direction || '|' || CAST(hour AS VARCHAR), {R('late_pct', 'value')}
               FROM s ORDER BY late_pct ASC, direction, hour LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'max_weekday', CAST(weekday AS VARCHAR), {R('late_pct', 'value')}
               FROM d ORDER BY late_pct DESC, weekday LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'min_weekday', CAST(weekday AS VARCHAR), {R('late_pct', 'value')}
               FROM d ORDER BY late_pct ASC, weekday LIMIT 1)""")

_HEAD = (f"count(*) AS n, {R('avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE', 'late_pct')}, "
         f"{R('avg(delay_min)', 'avg_delay')}, {R('median(delay_min)', 'median_delay')}, "
         "count(DISTINCT place_code) AS n_places")
ORACLE["headline"] = sql([FOR], f"SELECT {_HEAD} FROM flights_or")


def _ym(cond: str, sfx: str) -> str:
    return (f"count_if({cond}) AS n_{sfx}, avg(CASE WHEN {cond} THEN CAST(is_late AS DOUBLE) END) * 100.0::DOUBLE AS late_pct_{sfx}, "
            f"avg(CASE WHEN {cond} THEN delay_min END) AS avg_delay_{sfx}, "
            f"median(CASE WHEN {cond} THEN delay_min END) AS median_delay_{sfx}, "
            f"count(DISTINCT CASE WHEN {cond} THEN place_code END) AS n_places_{sfx}")


ORACLE["headline_delta"] = sql([FOR], f"""a AS (
  SELECT {_ym(f'year = {YEAR_A}', 'sel')}, {_ym(f'year = {YEAR_B}', 'oth')}
  FROM flights_or WHERE year IN ({YEAR_A}, {YEAR_B}))
SELECT n_sel, {R('late_pct_sel', 'late_pct_sel')}, {R('avg_delay_sel', 'avg_delay_sel')},
       {R('median_delay_sel', 'median_delay_sel')}, n_places_sel,
       CASE WHEN n_oth > 0 THEN n_sel - n_oth END AS diff_n,
       {R('CASE WHEN n_oth > 0 THEN late_pct_sel - late_pct_oth END', 'diff_late_pct')},
       {R('CASE WHEN n_oth > 0 THEN avg_delay_sel - avg_delay_oth END', 'diff_avg_delay')},
       {R('CASE WHEN n_oth > 0 THEN median_delay_sel - median_delay_oth END', 'diff_median_delay')},
       CASE WHEN n_oth > 0 THEN n_places_sel - n_places_oth END AS diff_n_places
FROM a""")

ORACLE["filtered_headline"] = sql([FOR], f"""base AS (
  SELECT * FROM flights_or WHERE direction = 'departure' AND airline IN ('Brand#11', 'Brand#22', 'Brand#33')
  AND year = {YEAR_A})
SELECT * FROM (SELECT {_HEAD} FROM base) WHERE (SELECT count(*) FROM base) >= 50""")

ORACLE["year_compare"] = sql([FOR], f"""
SELECT year, {_HEAD} FROM flights_or WHERE year IS NOT NULL GROUP BY year""")

ORACLE["year_month"] = sql([FOR], f"""
SELECT year, month, count(*) AS n, {R('avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE', 'late_pct')},
       {R('avg(delay_min)', 'avg_delay')}, count(DISTINCT place_code) AS n_places
FROM flights_or WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month""")


def _periods_union() -> str:
    parts = []
    for name, months in PERIODS.items():
        parts.append(f"SELECT '{name}' AS period, year, is_late FROM flights_or "
                     f"WHERE year IN ({YEAR_A}, {YEAR_B}) AND month IN ({', '.join(map(str, months))})")
    return "\n      UNION ALL ".join(parts)


_PERIOD_CTE = f"""p AS ({_periods_union()}),
a AS (SELECT period, count_if(year = {YEAR_A}) AS na, count_if(year = {YEAR_B}) AS nb,
             avg(CASE WHEN year = {YEAR_A} THEN CAST(is_late AS DOUBLE) END) AS la,
             avg(CASE WHEN year = {YEAR_B} THEN CAST(is_late AS DOUBLE) END) AS lb FROM p GROUP BY period),
pc AS (SELECT period, CASE WHEN na > 0 AND nb > 0 THEN na END AS n_a, CASE WHEN na > 0 AND nb > 0 THEN nb END AS n_b,
              CASE WHEN na > 0 AND nb > 0 THEN la * 100 END AS late_pct_a,
              CASE WHEN na > 0 AND nb > 0 THEN lb * 100 END AS late_pct_b,
              CASE WHEN na > 0 AND nb > 0 THEN CAST(nb AS DOUBLE) / CAST(na AS DOUBLE) * 100.0::DOUBLE END AS n_ratio_pct
       FROM a)"""

ORACLE["period_compare"] = sql([FOR, _PERIOD_CTE], f"""
SELECT period, n_a, n_b, {R('late_pct_a', 'late_pct_a')}, {R('late_pct_b', 'late_pct_b')}, {R('n_ratio_pct', 'n_ratio_pct')}
FROM pc""")

ORACLE["period_rule"] = sql([FOR, _PERIOD_CTE], """
SELECT COALESCE(bool_or(CASE WHEN period = 'jul-sep' THEN late_pct_b < late_pct_a * 0.4::DOUBLE END)
                AND bool_or(CASE WHEN period = 'dec' THEN late_pct_b > late_pct_a * 0.6::DOUBLE END), false)
       AS summer_peak_removed
FROM pc""")

ORACLE["area_year"] = sql([FOR, PLACES, ENR], f"""a AS (
  SELECT area, count_if(year = {YEAR_A}) AS n_a, count_if(year = {YEAR_B}) AS n_b,
         count(DISTINCT CASE WHEN year = {YEAR_A} THEN place_code END) AS places_a,
         count(DISTINCT CASE WHEN year = {YEAR_B} THEN place_code END) AS places_b
  FROM enriched_or WHERE area IS NOT NULL AND month >= 4 AND year IN ({YEAR_A}, {YEAR_B}) GROUP BY area)
SELECT area, n_a, n_b, places_a, places_b,
       {R('CAST(n_b AS DOUBLE) / CAST(n_a AS DOUBLE) * 100.0::DOUBLE', 'n_kept_pct')},
       {R('CAST(places_b AS DOUBLE) / CAST(places_a AS DOUBLE) * 100.0::DOUBLE', 'places_kept_pct')}
FROM a WHERE n_a > 0 AND n_b > 0""")

ORACLE["place_change"] = sql([FOR], f"""a AS (
  SELECT place_code, {summary_cols()}, count_if(year = {YEAR_A}) AS n_a, count_if(year = {YEAR_B}) AS n_b
  FROM flights_or WHERE place_code IS NOT NULL GROUP BY place_code)
SELECT *, {R('(CAST(n_b AS DOUBLE) - CAST(n_a AS DOUBLE)) / NULLIF(CAST(n_a AS DOUBLE), 0) * 100.0::DOUBLE', 'change_pct')}
FROM a WHERE n_a >= 50""")

_PLACE_STATS = f"""stats AS (
  SELECT place_code, count(*) AS n, avg(delay_min) AS avg_delay, median(delay_min) AS median_delay,
         avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct
  FROM flights_or WHERE place_code IS NOT NULL GROUP BY place_code HAVING count(*) >= 200),
info AS (
  SELECT s.place_code, {_lookup_cols(_FACT_ATTRS)}, {MATCHED}
  FROM stats s LEFT JOIN pa a ON s.place_code = a.key_a LEFT JOIN pb b ON s.place_code = b.key_b),
ps AS (
  SELECT s.*, i.name, i.region, i.lat, i.lon, i.distance_km, i.area FROM stats s JOIN info i USING (place_code)
  WHERE i.matched_by IS NOT NULL AND i.area = 'europe and around' AND i.lat IS NOT NULL)"""

_PS_COLS = (f"place_code, n, {R('avg_delay', 'avg_delay')}, {R('median_delay', 'median_delay')}, "
            f"{R('late_pct', 'late_pct')}, name, region, {R('lat', 'lat')}, {R('lon', 'lon')}, "
            f"{R('distance_km', 'distance_km')}, area")
ORACLE["place_stats"] = sql([FOR, PLACES, _PLACE_STATS], f"SELECT {_PS_COLS} FROM ps")
ORACLE["place_rank"] = sql([FOR, PLACES, _PLACE_STATS],
                           f"SELECT {_PS_COLS} FROM ps ORDER BY late_pct DESC, place_code LIMIT 10")
ORACLE["color_limits"] = sql([FOR, PLACES, _PLACE_STATS], f"""q AS (
  SELECT CAST(floor(quantile_cont(late_pct, 0.05)) AS DOUBLE) AS lo, CAST(ceil(quantile_cont(late_pct, 0.95)) AS DOUBLE) AS hi FROM ps)
SELECT {R('lo', 'color_lo')}, {R('CASE WHEN lo = hi THEN hi + 1 ELSE hi END', 'color_hi')} FROM q""")

ORACLE["place_month_series"] = sql([FOR], f"""m AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS month_start, count(*) AS n,
         avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct
  FROM flights_or WHERE place_code = 'NATION_7' GROUP BY 1),
spine AS (SELECT CAST(generate_series AS DATE) AS month_start
          FROM generate_series(DATE '{PLACE_MONTHS[0]}', DATE '{PLACE_MONTHS[1]}', INTERVAL 1 MONTH))
SELECT s.month_start, COALESCE(m.n, 0) AS n, {R('COALESCE(m.late_pct, 0.0::DOUBLE)', 'late_pct')}
FROM spine s LEFT JOIN m USING (month_start)""")

ORACLE["top_places"] = sql([FOR, PLACES, ENR], f"""a AS (
  SELECT place_code, count(*) AS n, max(name) AS name, max(lat) AS lat, max(lon) AS lon, max(distance_km) AS distance_km
  FROM enriched_or WHERE lat IS NOT NULL GROUP BY place_code ORDER BY n DESC, place_code LIMIT 60)
SELECT place_code, n, name, {R('lat', 'lat')}, {R('lon', 'lon')}, {R('distance_km', 'distance_km')},
       concat_ws(' · ', place_code, name) AS label FROM a""")

ORACLE["two_key_lookup"] = sql([FOR, PLACES, ENR], f"""
SELECT order_key, line_no, place_code, place_id, name, region, {R('lat', 'lat')}, {R('lon', 'lon')}, matched_by
FROM enriched_or""")

_CODES = """codes AS (SELECT place_code, count(*) AS n FROM flights_or GROUP BY place_code),
look AS (SELECT c.*, a.key_a IS NOT NULL AS in_a, b.key_b IS NOT NULL AS in_b,
                CASE WHEN a.name IS NOT NULL THEN 'key_a' WHEN b.name IS NOT NULL THEN 'key_b' END AS matched_by
         FROM codes c LEFT JOIN pa a ON c.place_code = a.key_a LEFT JOIN pb b ON c.place_code = b.key_b)"""

ORACLE["lookup_report"] = sql([FOR, PLACES, _CODES], """
SELECT count_if(place_code IS NOT NULL) AS n_codes,
       count_if(place_code IS NOT NULL AND in_a) AS codes_in_key_a,
       count_if(place_code IS NOT NULL AND in_b) AS codes_in_key_b,
       CAST(COALESCE(sum(CASE WHEN matched_by = 'key_a' THEN n END), 0) AS BIGINT) AS rows_via_key_a,
       CAST(COALESCE(sum(CASE WHEN matched_by = 'key_b' THEN n END), 0) AS BIGINT) AS rows_via_key_b,
       CAST(COALESCE(sum(CASE WHEN place_code IS NULL THEN n END), 0) AS BIGINT) AS rows_without_code,
       CAST(COALESCE(sum(CASE WHEN place_code IS NOT NULL AND matched_by IS NULL THEN n END), 0) AS BIGINT) AS rows_code_unknown
FROM look""")

ORACLE["unmatched_codes"] = sql([FOR, PLACES, _CODES], """
SELECT place_code, n FROM look WHERE place_code IS NOT NULL AND matched_by IS NULL""")

ORACLE["join_cardinality"] = sql([FOR, PLACES, ENR], """
SELECT (SELECT count(*) FROM flights_or) AS rows_in, (SELECT count(*) FROM enriched_or) AS rows_out,
       (SELECT CAST(COALESCE(max(c), 0) AS BIGINT) FROM (SELECT key_a, count(*) AS c FROM places_b WHERE key_a IS NOT NULL GROUP BY key_a)) AS max_rows_per_key_a,
       (SELECT CAST(COALESCE(max(c), 0) AS BIGINT) FROM (SELECT key_b, count(*) AS c FROM places_b WHERE key_b IS NOT NULL GROUP BY key_b)) AS max_rows_per_key_b""")

ORACLE["distance_area"] = sql([PLACES], f"SELECT place_id, name, {R('distance_km', 'distance_km')}, area FROM places_geo")

_DAYS = """fw AS (SELECT f.*, w.wpgt, w.prcp, w.tavg, w.tmin FROM flights_ev f LEFT JOIN weather_ev w USING (day)),
dt AS (SELECT day, count(*) AS n, count_if(is_late) AS n_late, max(wpgt) AS wpgt, max(prcp) AS prcp,
              max(tavg) AS tavg, max(tmin) AS tmin FROM fw GROUP BY day)"""

_GUST_BIN = _case_bin("wpgt", GUST_EDGES, "left")
ORACLE["weather_class_busy"] = sql([FEV, WEV], f"""fw AS (
  SELECT f.*, w.wpgt FROM flights_ev f LEFT JOIN weather_ev w USING (day) WHERE w.wpgt IS NOT NULL),
d AS (SELECT day, count(*) AS n, count_if(is_late) AS n_late, max(wpgt) AS wpgt FROM fw GROUP BY day),
d2 AS (SELECT *, CASE WHEN n > (SELECT median(n) FROM d) THEN 'busy day' ELSE 'quiet day' END AS day_type,
              {_GUST_BIN} AS class_no FROM d)
SELECT day_type, class_no, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_days,
       {R('CAST(sum(n_late) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(n) AS DOUBLE)', 'late_pct')},
       {_case_label('class_no', GUST_NAMES)} AS weather_class
FROM d2 WHERE class_no IS NOT NULL GROUP BY day_type, class_no HAVING count(*) >= 3""")

_DAY_WEATHER = f"""dw AS (
  SELECT day, n, CAST(n_late AS DOUBLE) * 100.0::DOUBLE / CAST(n AS DOUBLE) AS late_pct, wpgt, prcp, tavg,
         strftime(day, '%d-%m-%Y') AS day_label,
         {_case_label(_GUST_BIN, GUST_NAMES)} AS wind_class
  FROM dt WHERE n >= 50)"""
ORACLE["day_weather"] = sql([FEV, WEV, _DAYS, _DAY_WEATHER], f"""
SELECT day, n, {R('late_pct', 'late_pct')}, {R('wpgt', 'wpgt')}, {R('prcp', 'prcp')}, {R('tavg', 'tavg')}, day_label, wind_class
FROM dw""")
ORACLE["worst_days"] = sql([FEV, WEV, _DAYS, _DAY_WEATHER], f"""
SELECT * FROM (SELECT day, n, {R('late_pct', 'late_pct')}, {R('wpgt', 'wpgt')}, {R('prcp', 'prcp')}, {R('tavg', 'tavg')},
                      day_label, wind_class FROM dw)
ORDER BY late_pct DESC, day LIMIT 10""")


def _share(cond: str, name: str) -> str:
    return R(f"avg(CASE WHEN {cond} THEN CAST(is_late AS DOUBLE) END) * 100.0::DOUBLE", name)


ORACLE["cond_means"] = sql([FEV, WEV, _HL], f"""dl AS (SELECT day, count(*) AS day_load FROM flights_ev GROUP BY day),
f AS (SELECT f.*, hl.hour_load, dl.day_load, w.wpgt, COALESCE(w.tmin < 0.0::DOUBLE, false) AS frost
      FROM flights_ev f LEFT JOIN hl USING (day, hour) LEFT JOIN weather_ev w USING (day) LEFT JOIN dl USING (day)),
m AS (SELECT median(day_load) AS med FROM dl)
SELECT {_share(f"direction = 'departure' AND hour_load > (SELECT avg(hour_load) FROM f) * 1.1::DOUBLE", 'late_pct_busy_hours')},
       {_share(f"direction = 'departure' AND hour_load <= (SELECT avg(hour_load) FROM f) * 0.9::DOUBLE", 'late_pct_quiet_hours')},
       {_share(f"day_load > (SELECT med FROM m) AND wpgt >= (SELECT round(avg(wpgt), 6) FROM weather_ev) * 1.1::DOUBLE", 'late_pct_busy_storm')},
       {_share(f"NOT (day_load > (SELECT med FROM m)) AND wpgt < (SELECT round(avg(wpgt), 6) FROM weather_ev) * 0.9::DOUBLE", 'late_pct_quiet_calm')},
       {_share('frost', 'late_pct_frost')}, {_share('NOT frost', 'late_pct_no_frost')}
FROM f""")

ORACLE["mean_of_day_shares"] = sql([FEV, WEV, _DAYS], f"""
SELECT {R(f"avg(CASE WHEN wpgt >= (SELECT round(avg(wpgt), 6) FROM weather_ev) * 1.1::DOUBLE THEN CAST(n_late AS DOUBLE) / CAST(n AS DOUBLE) END) * 100.0::DOUBLE", 'storm_day_late_pct')},
       {R(f"avg(CASE WHEN wpgt < (SELECT round(avg(wpgt), 6) FROM weather_ev) * 0.9::DOUBLE THEN CAST(n_late AS DOUBLE) / CAST(n AS DOUBLE) END) * 100.0::DOUBLE", 'calm_day_late_pct')}
FROM dt""")

_FINDINGS = """b AS (SELECT f.*, hl.hour_load, w.wpgt, COALESCE(w.tmin < 0.0::DOUBLE, false) AS frost
      FROM flights_ev f LEFT JOIN hl USING (day, hour) LEFT JOIN weather_ev w USING (day) WHERE f.year = 2024),
dd AS (SELECT day, count(*) AS day_load, avg(CAST(is_late AS DOUBLE)) AS share, max(wpgt) AS wpgt FROM b GROUP BY day),
x AS (SELECT b.*, dd.day_load > (SELECT median(day_load) FROM dd) AS busy FROM b JOIN dd USING (day))"""


def _pct(cond: str, name: str) -> str:
    return R(f"count_if(({cond}) AND is_late) * 100.0::DOUBLE / nullif(count_if({cond}), 0)", name)


ORACLE["fixed_findings"] = sql([FEV, WEV, _HL, _FINDINGS], f"""
SELECT {_pct("direction = 'departure' AND hour_load > 14", 'late_pct_busy_hours')},
       {_pct("direction = 'departure' AND hour_load <= 120", 'late_pct_quiet_hours')},
       {R("(SELECT avg(CASE WHEN wpgt >= 200.0::DOUBLE THEN share END) * 100.0::DOUBLE FROM dd)", 'storm_day_late_pct')},
       {R("(SELECT avg(CASE WHEN wpgt < 300.0::DOUBLE THEN share END) * 100.0::DOUBLE FROM dd)", 'calm_day_late_pct')},
       {_pct("busy AND wpgt >= 200.0::DOUBLE", 'late_pct_busy_storm')},
       {_pct("NOT busy AND wpgt < 300.0::DOUBLE", 'late_pct_quiet_calm')},
       {_pct("frost", 'late_pct_frost')}, {_pct("NOT frost", 'late_pct_no_frost')}
FROM x""")

ORACLE["delay_histogram"] = sql([FEV], """c AS (
  SELECT CAST(floor((least(greatest(delay_min, -60.0::DOUBLE), 119.9::DOUBLE) - (-60.0::DOUBLE)) / 5.0::DOUBLE) AS INTEGER) AS bin_no,
         count(*) AS n FROM flights_ev WHERE delay_min IS NOT NULL GROUP BY 1),
spine AS (SELECT CAST(range AS INTEGER) AS bin_no FROM range(36))
SELECT s.bin_no, round(-60.0::DOUBLE + s.bin_no * 5.0::DOUBLE, 6) AS bin_lo,
       round(-60.0::DOUBLE + s.bin_no * 5.0::DOUBLE + 5.0::DOUBLE, 6) AS bin_hi, COALESCE(c.n, 0) AS n
FROM spine s LEFT JOIN c USING (bin_no)""")

ORACLE["delay_quantiles"] = sql([FEV], f"""
SELECT {R('quantile_cont(delay_min, 0.25)', 'q25')}, {R('quantile_cont(delay_min, 0.75)', 'q75')},
       {R('quantile_cont(delay_min, 0.99)', 'q99')}, {R('max(delay_min)', 'max_delay_min')} FROM flights_ev""")


def _profile_row(c: str) -> str:
    q = f'"{c}"'
    return (f"SELECT '{c}' AS column_name, count(DISTINCT {q}) AS n_distinct, count_if({q} = '-') AS n_dash, "
            f"count_if({q} = '#N/A') AS n_na, "
            f"{R(f'avg(CASE WHEN {q} IS NULL OR {q} IN (' + chr(39) + '-' + chr(39) + ', ' + chr(39) + '#N/A' + chr(39) + ', ' + chr(39) + chr(39) + ') THEN 1 ELSE 0 END) * 100.0::DOUBLE', 'empty_pct')}, "
            f'first({q} ORDER BY CAST("Identifier" AS BIGINT)) AS example FROM raw_ev')


ORACLE["column_profile"] = sql([RAW], "\n UNION ALL ".join(_profile_row(c) for c in RAW_COLS))

_ENR_COLS = ("order_key", "line_no", "day", "year", "month", "weekday", "delay_min", "is_late", "direction",
             "airline", "aircraft", "place_code", *PLACE_ATTRS, "matched_by")
def _reason(c: str) -> str:
    return NULL_REASONS.get(c, NULL_REASON_OTHER)


ORACLE["null_profile"] = sql([FOR, PLACES, ENR], "\n UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS n_null, "
    f"{R(f'count_if({c} IS NULL) * 100.0::DOUBLE / count(*)', 'null_pct')}, '{_reason(c)}' AS reason "
    f"FROM enriched_or" for c in _ENR_COLS))

ORACLE["weather_coverage"] = sql([FEV, WEV], f"""
SELECT {R('avg(CAST(COALESCE(w.tavg IS NOT NULL, false) AS DOUBLE)) * 100', 'pct_with_weather')},
       {R('avg(CAST(COALESCE(w.wpgt IS NOT NULL, false) AS DOUBLE)) * 100', 'pct_with_gust')}
FROM flights_ev f LEFT JOIN weather_ev w USING (day)""")

ORACLE["area_share"] = sql([FOR, PLACES, ENR], f"""
SELECT area, count(*) AS n, {R('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM enriched_or)', 'share_pct')}
FROM enriched_or GROUP BY area""")

ORACLE["value_freq"] = sql([FOR], "SELECT aircraft AS value, count(*) AS n FROM flights_or WHERE aircraft IS NOT NULL GROUP BY aircraft")

ORACLE["source_summary"] = sql([WEV], """
SELECT count(*) AS n_rows, min(day) AS first_day, max(day) AS last_day,
       CAST(date_diff('day', min(day), max(day)) + 1 AS INTEGER) AS expected_days,
       CAST(date_diff('day', min(day), max(day)) + 1 - count(DISTINCT day) AS BIGINT) AS missing_days
FROM weather_ev""")

ORACLE["coverage"] = sql([FOR, PLACES, ENR], f"""
SELECT {R('avg(CAST(COALESCE(name IS NOT NULL, false) AS DOUBLE)) * 100', 'pct_with_place')},
       {R('avg(CAST(COALESCE(place_code IS NOT NULL, false) AS DOUBLE)) * 100', 'pct_with_code')},
       {R("avg(CAST(COALESCE(direction = 'departure', false) AS DOUBLE)) * 100", 'pct_departure')}
FROM enriched_or""")

ORACLE["features"] = sql([FEV], f"""h AS (SELECT day, hour, count(*) AS hour_load, avg(delay_min) AS ha FROM flights_ev GROUP BY day, hour),
h2 AS (SELECT day, hour, hour_load, CAST(sum(hour_load) OVER (PARTITION BY day) AS BIGINT) AS day_load,
              max(ha) OVER (PARTITION BY day ORDER BY hour RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev_hour_delay
       FROM h)
SELECT f.flight_id, f.day, f.hour, h2.hour_load, h2.day_load, {R('h2.prev_hour_delay', 'prev_hour_delay')}
FROM flights_ev f LEFT JOIN h2 USING (day, hour)""")

_TOPCAT = """long AS (
  SELECT 'direction' AS column_name, direction AS value FROM flights_ev UNION ALL
  SELECT 'aircraft', aircraft FROM flights_ev UNION ALL
  SELECT 'runway', runway FROM flights_ev UNION ALL
  SELECT 'airline', airline FROM flights_ev),
cnt AS (SELECT column_name, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY column_name, value),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank
                       FROM cnt) WHERE rank <= 30)"""
ORACLE["top_categories"] = sql([FEV, _TOPCAT], "SELECT column_name, value, n, rank FROM top")
ORACLE["encode_other"] = sql([FEV, _TOPCAT], "SELECT f.flight_id, " + ", ".join(
    f"COALESCE((SELECT t.value FROM top t WHERE t.column_name = '{c}' AND t.value = f.{c}), 'other') AS {c}"
    for c in CATEGORICAL) + " FROM flights_ev f")

ORACLE["split_days"] = sql([FEV, SEV], "SELECT day, is_test FROM split_days")

ORACLE["split_year"] = sql([FOR], f"""
SELECT CASE WHEN year = {YEAR_B} THEN 'test' ELSE 'train' END AS side, count(*) AS n_rows, count(DISTINCT day) AS n_days
FROM flights_or WHERE year IN ({YEAR_A}, {YEAR_B}) GROUP BY 1""")

_TRAIN = """tr AS (SELECT avg(CAST(is_late AS DOUBLE)) AS share, median(delay_min) AS med FROM scored_split WHERE NOT is_test)"""
ORACLE["baseline"] = sql([FEV, SEV, _TRAIN], f"""
SELECT {R('(SELECT share FROM tr)', 'train_late_share')}, {R('avg(CAST(is_late AS DOUBLE))', 'test_late_share')},
       {R('avg(pow(CAST(is_late AS DOUBLE) - (SELECT share FROM tr), 2))', 'brier_const')},
       {R('avg(abs(delay_min - (SELECT med FROM tr)))', 'mae_const')}
FROM test_scored""")

ORACLE["metrics"] = sql([FEV, SEV], f"""
SELECT count(*) AS n, {R('avg(pow(p_late - CAST(is_late AS DOUBLE), 2))', 'brier')},
       {R('avg(abs(delay_min - pred_min))', 'mae')},
       {R('1.0::DOUBLE - sum(pow(delay_min - pred_min, 2)) / (var_pop(delay_min) * count(delay_min))', 'r2')}
FROM test_scored""")

ORACLE["auc"] = sql([FEV, SEV], f"""d AS (
  SELECT p_late, count_if(is_late) AS pos, count_if(NOT is_late) AS neg FROM test_scored
  WHERE p_late IS NOT NULL AND is_late IS NOT NULL GROUP BY p_late),
c AS (SELECT *, CAST(COALESCE(sum(neg) OVER (ORDER BY p_late ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS below FROM d)
SELECT {R('sum(CAST(pos AS DOUBLE) * (below + CAST(neg AS DOUBLE) * 0.5::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))', 'auc')}
FROM c""")

_Q10 = "[" + ", ".join(f"{i / 10}::DOUBLE" for i in range(11)) + "]"
ORACLE["calibration"] = sql([FEV, SEV], f"""e AS (SELECT list_sort(list_distinct(quantile_cont(p_late, {_Q10}))) AS edges FROM test_scored),
b AS (SELECT t.*, CASE WHEN t.p_late >= e.edges[1] AND t.p_late <= e.edges[-1] AND len(e.edges) >= 2
                       THEN CAST(greatest(len(list_filter(e.edges, lambda x: x < t.p_late)), 1) AS INTEGER) END AS bin
      FROM test_scored t, e)
SELECT bin, {R('avg(p_late)', 'p_mean')}, {R('avg(CAST(is_late AS DOUBLE))', 'late_rate')}, count(*) AS n
FROM b WHERE bin IS NOT NULL GROUP BY bin""")


def _thresholds_sql() -> str:
    from punctuo.operators.evaluate import thresholds
    return "[" + ", ".join(f"{t}::DOUBLE" for t in thresholds()) + "]"


ORACLE["confusion_sweep"] = sql([FEV, SEV], f"""d AS (
  SELECT p_late, count_if(is_late) AS pos, count_if(NOT is_late) AS neg FROM test_scored GROUP BY p_late),
x AS (SELECT d.*, unnest({_thresholds_sql()}) AS threshold FROM d),
a AS (SELECT threshold,
             CAST(COALESCE(sum(CASE WHEN p_late >= threshold THEN pos END), 0) AS BIGINT) AS tp,
             CAST(COALESCE(sum(CASE WHEN p_late >= threshold THEN neg END), 0) AS BIGINT) AS fp,
             CAST(COALESCE(sum(CASE WHEN NOT (p_late >= threshold) THEN pos END), 0) AS BIGINT) AS fn,
             CAST(COALESCE(sum(CASE WHEN NOT (p_late >= threshold) THEN neg END), 0) AS BIGINT) AS tn
      FROM x GROUP BY threshold)
SELECT {R('threshold', 'threshold')}, tp, fp, fn, tn, {R('tp / greatest(tp + fp, 1)', 'precision')},
       {R('tp / greatest(tp + fn, 1)', 'recall')}, {R('(tp + tn) / (tp + fp + fn + tn)', 'accuracy')}
FROM a""")

_BYDAY = """bd AS (
  SELECT t.day, avg(CAST(t.is_late AS DOUBLE)) * 100.0::DOUBLE AS actual_pct, avg(t.p_late) * 100.0::DOUBLE AS pred_pct,
         count(*) AS n, max(w.wpgt) AS wpgt
  FROM test_scored t LEFT JOIN weather_ev w USING (day) GROUP BY t.day HAVING count(*) >= 150)"""
_BYDAY_COLS = (f"day, {R('actual_pct', 'actual_pct')}, {R('pred_pct', 'pred_pct')}, n, {R('wpgt', 'wpgt')}, "
               f"{R('actual_pct - pred_pct', 'error')}")
ORACLE["pred_by_day"] = sql([FEV, SEV, WEV, _BYDAY], f"SELECT {_BYDAY_COLS} FROM bd")
ORACLE["top_misses"] = sql([FEV, SEV, WEV, _BYDAY],
                           f"SELECT {_BYDAY_COLS} FROM bd ORDER BY actual_pct - pred_pct DESC, day LIMIT 3")

ORACLE["pred_by_hour"] = sql([FEV, SEV], f"""h AS (
  SELECT hour, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS actual_pct, avg(p_late) * 100.0::DOUBLE AS pred_pct,
         count(*) AS n FROM test_scored GROUP BY hour HAVING count(*) >= 100)
SELECT hour, {R('actual_pct', 'actual_pct')}, {R('pred_pct', 'pred_pct')}, n, {R('abs(actual_pct - pred_pct)', 'abs_gap')}
FROM h""")

_DCLASS = _case_bin("delay_min", DELAY_EDGES, "left")
ORACLE["pred_by_delay_class"] = sql([FEV, SEV], f"""c AS (SELECT {_DCLASS} AS class_no, p_late FROM test_scored)
SELECT class_no, {R('avg(p_late) * 100.0::DOUBLE', 'pred_pct')}, count(*) AS n,
       {_case_label('class_no', DELAY_NAMES)} AS delay_class
FROM c WHERE class_no IS NOT NULL GROUP BY class_no""")

ORACLE["pred_overall"] = sql([FEV, SEV], f"""
SELECT {R('avg(p_late) * 100.0::DOUBLE', 'pred_pct')}, {R('avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE', 'actual_pct')}
FROM test_scored""")

ORACLE["skill"] = sql([FEV, SEV, _TRAIN], f"""
SELECT {R('avg(abs(delay_min - (SELECT med FROM tr))) - avg(abs(delay_min - pred_min))', 'mae_gain')},
       {R('avg(p_late) - (SELECT share FROM tr)', 'chance_minus_train_share')},
       {R('1.0::DOUBLE - avg(CAST(is_late AS DOUBLE))', 'never_warn_accuracy')}
FROM test_scored""")

ORACLE["format_report"] = sql([FOR], """s AS (
  SELECT airline, count(*) AS n, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct, avg(delay_min) AS avg_delay
  FROM flights_or WHERE airline IS NOT NULL GROUP BY airline HAVING count(*) >= 100)
SELECT airline, translate(format('{:,}', n), ',.', '.,') AS n_text,
       COALESCE(translate(format('{:,.1f}', late_pct), ',.', '.,'), '–') AS late_pct_text,
       COALESCE(translate(format('{:,.1f}', avg_delay), ',.', '.,'), '–') AS avg_delay_text,
       concat_ws(' · ', airline, translate(format('{:,}', n), ',.', '.,')) AS label
FROM s""")


ORACLE["rounded_report"] = sql([FOR], """
SELECT airline, count(*) AS n, round_even(sum(delay_min) / count(delay_min), 2) AS avg_delay,
       round_even(count_if(is_late) * 100.0::DOUBLE / count(*), 1) AS late_pct
FROM flights_or WHERE airline IS NOT NULL GROUP BY airline""")

ORACLE["selection_text"] = sql([FOR], """
SELECT '1999 · departure · airline Brand#11, Brand#22 · type (all) · ' || translate(format('{:,}', count(*)), ',.', '.,') || ' flights' AS selection
FROM flights_or WHERE direction = 'departure' AND airline IN ('Brand#11', 'Brand#22') AND year = 1999""")

ORACLE["raw_preview"] = sql([RAW], """
SELECT * FROM raw_ev ORDER BY CAST("Identifier" AS BIGINT) LIMIT 8""")

ORACLE["build_summary"] = sql([RAW, CLEAN, PLACES], f"""
look AS (SELECT c.*, {MATCHED} FROM clean_ev c LEFT JOIN pa a ON c.place_code = a.key_a
         LEFT JOIN pb b ON c.place_code = b.key_b)
SELECT count(*) AS rows, count_if(rolled_over) AS rollovers, count_if(matched_by = 'key_a') AS via_key_a,
       count_if(matched_by = 'key_b') AS via_key_b, count_if(place_code IS NOT NULL AND matched_by IS NULL) AS code_unknown,
       {R('avg(delay_min)', 'avg_delay')}
FROM look""")

ORACLE["direction_code_freq"] = sql([RAW], """
l AS (SELECT CASE WHEN trim("LSV") IN ('-', '#N/A', '') THEN NULL ELSE trim("LSV") END AS c FROM raw_ev)
SELECT CASE c WHEN 'S' THEN 'departure' WHEN 'L' THEN 'arrival' ELSE c END AS value, count(*) AS n
FROM l WHERE c IS NOT NULL GROUP BY 1""")

ORACLE["unknown_codes_text"] = sql([FOR, PLACES, _CODES], """
SELECT string_agg(place_code || ' (' || CAST(n AS VARCHAR) || '×)', ', ' ORDER BY place_code || ' (' || CAST(n AS VARCHAR) || '×)')
       AS unknown_codes
FROM look WHERE place_code IS NOT NULL AND matched_by IS NULL""")

ORACLE["pred_heavy"] = sql([FEV, SEV], f"""
SELECT {R('avg(p_late) * 100.0::DOUBLE', 'pred_pct')}, count(*) AS n FROM test_scored WHERE delay_min >= 60.0::DOUBLE""")

ORACLE["pred_worst_hour"] = sql([FEV, SEV], f"""h AS (
  SELECT hour, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS actual_pct, avg(p_late) * 100.0::DOUBLE AS pred_pct,
         count(*) AS n FROM test_scored GROUP BY hour HAVING count(*) >= 50)
SELECT hour, {R('actual_pct', 'actual_pct')}, {R('pred_pct', 'pred_pct')}, n, {R('abs(actual_pct - pred_pct)', 'abs_gap')}
FROM h ORDER BY abs(actual_pct - pred_pct) DESC, hour LIMIT 1""")

ORACLE["raw_rain_series"] = sql([WEV], f"SELECT day, {R('prcp', 'prcp')} FROM weather_ev")

ORACLE["csv_clean_roundtrip"] = sql([RAW_DUP, CLEAN], f"""
SELECT "Identifier", flight_no, CASE "LSV" WHEN 'S' THEN 'departure' WHEN 'L' THEN 'arrival' END AS direction,
       CASE WHEN regexp_matches(flight_no, '^..\\p{{L}}') THEN substr(flight_no, 1, 3) ELSE substr(flight_no, 1, 2) END AS airline,
       place_code, planned_ts, actual_ts, rolled_over, {R('delay_min', 'delay_min')}, is_late, day, year, month, weekday, hour
FROM clean_ev""")

ORACLE["airports_read"] = f"""
SELECT CAST(n_nationkey AS VARCHAR) AS "Airport_ID", 'The "' || n_name || '", Airport' AS "Name", n_name AS "City", r_name AS "Country",
       'N' || CAST(n_nationkey AS VARCHAR) AS "IATA", CASE WHEN n_nationkey = 24 THEN NULL ELSE n_name END AS "ICAO",
       {R('CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE -60.0::DOUBLE + 5.0::DOUBLE * n_nationkey END', '"Latitude"')},
       {R('-170.0::DOUBLE + 14.0::DOUBLE * n_nationkey', '"Longitude"')}, 12.0::DOUBLE AS "Altitude", CAST(NULL AS DOUBLE) AS "Timezone",
       'E' AS "DST", CAST(NULL AS VARCHAR) AS "Tz", 'airport' AS "Type", 'x' AS "Source"
FROM nation JOIN region ON n_regionkey = r_regionkey"""

ORACLE["weather_read"] = sql([WEV], f"""
SELECT day, {R('tavg', 'tavg')}, {R('tmin', 'tmin')}, CAST(NULL AS DOUBLE) AS tmax,
       {R("CASE WHEN day >= DATE '2024-01-21' THEN NULL ELSE prcp END", 'prcp')}, {R('wspd', 'wspd')}, {R('wpgt', 'wpgt')}, {R('pres', 'pres')}, 'EDDF' AS station
FROM weather_ev""")

ORACLE["last_per_series"] = f"SELECT * FROM ({ORACLE['timeline_day_rolling']}) AS t QUALIFY row_number() OVER (PARTITION BY series ORDER BY bucket DESC) = 1"

ORACLE["heat_weekday_hour_n"] = sql([FEV], f"""s AS (
  SELECT weekday, hour, count(*) AS n FROM flights_ev
  WHERE weekday IS NOT NULL AND hour IS NOT NULL GROUP BY weekday, hour HAVING count(*) >= 30 AND hour BETWEEN 6 AND 22),
g AS (SELECT weekday, {', '.join(f'max(CASE WHEN hour = {h} THEN n END) AS h{h:02d}' for h in range(6, 23))} FROM s GROUP BY weekday),
spine AS (SELECT CAST(range AS INTEGER) AS weekday FROM range(7))
SELECT spine.weekday, ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][spine.weekday + 1] AS weekday_name,
       {', '.join(f'g.h{h:02d}' for h in range(6, 23))}
FROM spine LEFT JOIN g USING (weekday)""")

ORACLE["weather_classes"] = sql([FEV, WEV], f"""e(variable, class_no, lo, hi, weather_class) AS (VALUES
  ('wpgt', 1, 0, 30, '< 30'), ('wpgt', 2, 30, 40, '30–40'), ('wpgt', 3, 40, 50, '40–50'), ('wpgt', 4, 50, 60, '50–60'), ('wpgt', 5, 60, 75, '60–75'), ('wpgt', 6, 75, 250, '≥ 75'),
  ('prcp', 1, 0, 1, 'dry (< 1)'), ('prcp', 2, 1, 5, '1–5'), ('prcp', 3, 5, 15, '5–15'), ('prcp', 4, 15, 250, '≥ 15'),
  ('tavg', 1, -20, 0, '< 0'), ('tavg', 2, 0, 5, '0–5'), ('tavg', 3, 5, 10, '5–10'), ('tavg', 4, 10, 15, '10–15'), ('tavg', 5, 15, 20, '15–20'), ('tavg', 6, 20, 40, '≥ 20'),
  ('tmin', 1, -20, -3, '< −3'), ('tmin', 2, -3, 0, '−3–0'), ('tmin', 3, 0, 5, '0–5'), ('tmin', 4, 5, 10, '5–10'), ('tmin', 5, 10, 15, '10–15'), ('tmin', 6, 15, 40, '≥ 15'),
  ('wspd', 1, 0, 5, '< 5'), ('wspd', 2, 5, 10, '5–10'), ('wspd', 3, 10, 15, '10–15'), ('wspd', 4, 15, 20, '15–20'), ('wspd', 5, 20, 60, '≥ 20'),
  ('pres', 1, 900, 1005, '< 1005'), ('pres', 2, 1005, 1012, '1005–1012'), ('pres', 3, 1012, 1018, '1012–1018'), ('pres', 4, 1018, 1025, '1018–1025'), ('pres', 5, 1025, 1100, '≥ 1025')),
f AS (SELECT day, count(*) AS n, count_if(is_late) AS n_late FROM flights_ev GROUP BY day),
d AS (SELECT f.*, w.* EXCLUDE (day) FROM f JOIN weather_ev w USING (day)),
l AS (SELECT day, n, n_late, unnest(['wpgt', 'prcp', 'tavg', 'tmin', 'wspd', 'pres']) AS variable, unnest([wpgt, prcp, tavg, tmin, wspd, pres]) AS value FROM d),
m AS (SELECT variable, median(n) AS med FROM l WHERE value IS NOT NULL GROUP BY variable),
c AS (SELECT l.*, e.class_no, e.weather_class, CASE WHEN n > med THEN 'busy day' ELSE 'quiet day' END AS day_type
      FROM l JOIN m USING (variable) JOIN e ON e.variable = l.variable AND value >= lo AND value < hi)
SELECT variable, class_no, weather_class, day_type, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_days,
       {R('CAST(sum(n_late) AS DOUBLE) * 100.0::DOUBLE / CAST(sum(n) AS DOUBLE)', 'late_pct')}
FROM (SELECT * FROM c UNION ALL SELECT * REPLACE ('all days' AS day_type) FROM c) AS both_views
GROUP BY variable, class_no, weather_class, day_type HAVING count(*) >= 3""")

_PERMUTED = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r} AS rep, b.flight_id, b.is_late, {', '.join(f'd.{x} AS {x}' if x == c else f'b.{x} AS {x}' for x in ('hour', 'weekday', 'slot'))} FROM b JOIN "
    f"(SELECT {c}, row_number() OVER (ORDER BY md5(CAST(flight_id AS VARCHAR) || '|{c}|{r}|42'), flight_id) AS rid FROM b) d USING (rid)"
    for c in ("hour", "weekday", "slot") for r in (0, 1))
ORACLE["importance_formula"] = sql([FEV, SEV], f"""b AS (
  SELECT flight_id, is_late, hour, weekday, flight_id % 17 AS slot, row_number() OVER (ORDER BY md5(CAST(flight_id AS VARCHAR) || '|42'), flight_id) AS rid FROM test_scored),
x AS (SELECT 'none' AS feature, 0 AS rep, flight_id, is_late, hour, weekday, slot FROM b UNION ALL {_PERMUTED}),
y AS (SELECT feature, rep, round((hour * 4 + weekday * 3 + slot) / 140.0::DOUBLE, 4) AS p, count_if(is_late) AS pos, count_if(NOT is_late) AS neg FROM x GROUP BY ALL),
z AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature, rep ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM y),
a AS (SELECT feature, rep, CAST(sum(pos * (below + 0.5::DOUBLE * neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM z GROUP BY feature, rep)
SELECT feature, {R("(SELECT auc FROM a WHERE feature = 'none') - avg(auc)", 'auc_drop')} FROM a WHERE feature <> 'none' GROUP BY feature""")

ORACLE["year_delta"] = sql([FOR], """s AS (
  SELECT year, CAST(count(*) AS DOUBLE) AS n, avg(CAST(is_late AS DOUBLE)) * 100.0::DOUBLE AS late_pct, avg(delay_min) AS avg_delay, median(delay_min) AS median_delay,
         CAST(count(DISTINCT place_code) AS DOUBLE) AS n_places
  FROM flights_or WHERE year IN (1999, 2000) GROUP BY year),
m AS (SELECT unnest([1, 2, 3, 4, 5]) AS measure_no, unnest(['n', 'late_pct', 'avg_delay', 'median_delay', 'n_places']) AS measure, a.v AS va, b.v AS vb
      FROM (SELECT [n, late_pct, avg_delay, median_delay, n_places] AS v FROM s WHERE year = 1999) a,
           (SELECT [n, late_pct, avg_delay, median_delay, n_places] AS v FROM s WHERE year = 2000) b)
SELECT measure_no, measure, round(va[measure_no], 6) AS value_a, round(vb[measure_no], 6) AS value_b, round(vb[measure_no] - va[measure_no], 6) AS delta FROM m""")
