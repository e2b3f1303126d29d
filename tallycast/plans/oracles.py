"""DuckDB SQL oracles for the registered queries.

The CTE blocks below restate the adapters and operators in plain SQL over the
driver's views. Where a Spark operator uses a physical shortcut (lags inside a
(key, phase) window, grid by ``explode(sequence)``, union-aggregate zero fill),
the oracle uses the textbook form (positional ``lag`` per key, cross product +
left join) so the comparison checks the shortcut.
"""

from __future__ import annotations

from ..config import DAILY, DEFAULT

D = "CAST({} AS DOUBLE)".format

# Fixed values, written out here a second time so that the oracles do not take them from the code they check:
# holidays by date (name, month, day, first year) and by n-th weekday (name, month, ISO weekday, n; -1 is the last), named periods.
_DATES = [("New Year's Day", 1, 1, None), ("Lincoln's Birthday", 2, 12, None), ("Juneteenth National Independence Day", 6, 19, 2021),
          ("Independence Day", 7, 4, None), ("Veterans Day", 11, 11, None), ("Christmas Day", 12, 25, None)]
_NTH = [("Martin Luther King Jr. Day", 1, 1, 3), ("Washington's Birthday", 2, 1, 3), ("Casimir Pulaski Day", 3, 1, 1), ("Memorial Day", 5, 1, -1),
        ("Labor Day", 9, 1, 1), ("Columbus Day", 10, 1, 2), ("Thanksgiving", 11, 4, 4)]
_PERIODS = [("01-06", "01-07", "Winter Fest"), ("01-07", "01-09", "Auto Show"), ("01-15", "01-15", "Parade"),
            ("07-01", "07-04", "Summer Fair"), ("07-03", "07-05", "Jazz Fest"), ("09-10", "09-12", "Air Show")]
_PERIOD_YEARS = (1995, 2024)
_WEEKDAYS = [(name, m, w, 7 * n - 6 if n > 0 else 25, 7 * n if n > 0 else 31) for name, m, w, n in _NTH]


def dur(s: str = "started_at", e: str = "ended_at") -> str:
    return f"CAST(trunc((epoch_us({e}) - epoch_us({s})) / 1000000) AS BIGINT)"


EV_TRIPS = f"""
ev_trips AS (
  SELECT CAST(event_id AS VARCHAR) AS ride_id, event_type AS rideable_type, ts AS started_at,
         ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 10000) AS ended_at,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE 'Stop ' || CAST(user_id AS VARCHAR) || '/' || event_type END AS start_station_name,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS start_station_id,
         CAST(NULL AS VARCHAR) AS end_station_name,
         CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS end_station_id,
         {D(41.8)} + user_id * {D('1e-4')} + (value - {D(250.0)}) * {D('1e-6')} AS start_lat,
         {D(-87.6)} - user_id * {D('1e-4')} AS start_lng,
         {D(41.8)} + user_id * {D('1e-4')} + (value - {D(250.0)}) * {D('1e-6')} + {D('1e-3')} AS end_lat,
         {D(-87.6)} - user_id * {D('1e-4')} + {D('1e-3')} AS end_lng,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'member' ELSE 'casual' END AS member_casual
  FROM events)"""

MAPPING = """
mapping AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS raw_station_id, CAST(c.canon AS VARCHAR) AS canonical_station_id
  FROM supplier s JOIN (SELECT s_nationkey, min(s_suppkey) AS canon FROM supplier GROUP BY 1) c
    ON s.s_nationkey = c.s_nationkey
  WHERE s.s_suppkey <> c.canon)"""


def clean_cte(name: str, trips: str, cfg, mapping: bool) -> str:
    d = dur()
    where = (f"t.start_station_id IS NOT NULL AND {d.replace('started_at', 't.started_at').replace('ended_at', 't.ended_at')}"
             f" >= {cfg.min_trip_seconds} AND "
             f"{d.replace('started_at', 't.started_at').replace('ended_at', 't.ended_at')} <= {cfg.max_trip_hours * 3600}")
    if mapping:
        return f"""
{name} AS (
  SELECT t.*, coalesce(m.canonical_station_id, t.start_station_id) AS station_id
  FROM {trips} t LEFT JOIN mapping m ON t.start_station_id = m.raw_station_id
  WHERE {where})"""
    return f"""
{name} AS (
  SELECT t.*, t.start_station_id AS station_id FROM {trips} t WHERE {where})"""


def _lit_d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


OR_TRIPS = f"""
or_trips AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS ride_id,
         o.o_orderpriority AS rideable_type, o.o_orderdate AS started_at, l.l_shipdate AS ended_at,
         'Supplier ' || CAST(l.l_suppkey AS VARCHAR) AS start_station_name,
         CAST(l.l_suppkey AS VARCHAR) AS start_station_id,
         CAST(NULL AS VARCHAR) AS end_station_name,
         CAST(l.l_suppkey AS VARCHAR) AS end_station_id,
         {D(41.7)} + (l.l_suppkey % 97) * {D('1e-3')} + l.l_discount * {D('1e-3')} AS start_lat,
         {D(-87.7)} + (l.l_suppkey % 89) * {D('1e-3')} + l.l_quantity * {D('1e-5')} AS start_lng,
         {D(41.7)} + (l.l_suppkey % 97) * {D('1e-3')} + l.l_discount * {D('1e-3')} AS end_lat,
         {D(-87.7)} + (l.l_suppkey % 89) * {D('1e-3')} + l.l_quantity * {D('1e-5')} AS end_lng,
         CASE WHEN l.l_returnflag = 'R' THEN 'member' ELSE 'casual' END AS member_casual
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def grid_ctes(prefix: str, clean: str, cfg, trim: bool = True) -> str:
    unit = cfg.grain.unit
    g = f"""
{prefix}_scope AS (
  SELECT station_id, count(*) AS trips FROM {clean}
  WHERE started_at >= (SELECT max(started_at) - INTERVAL {cfg.scope_lookback_days} DAY FROM {clean})
  GROUP BY station_id ORDER BY trips DESC, station_id LIMIT {cfg.top_n}),
{prefix}_counts AS (
  SELECT station_id, date_trunc('{unit}', started_at) AS hour, CAST(count(*) AS INTEGER) AS trips
  FROM {clean} WHERE station_id IN (SELECT station_id FROM {prefix}_scope) GROUP BY 1, 2),
{prefix}_full AS (
  SELECT s.station_id, g.hour, CAST(coalesce(c.trips, 0) AS INTEGER) AS trips
  FROM {prefix}_scope s
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(hour) FROM {prefix}_counts),
                                            (SELECT max(hour) FROM {prefix}_counts), INTERVAL 1 {unit})) AS hour) g
  LEFT JOIN {prefix}_counts c ON c.station_id = s.station_id AND c.hour = g.hour)"""
    if trim:
        g += f""",
{prefix}_first AS (
  SELECT station_id, date_trunc('month', min(started_at)) AS first_month FROM {clean} GROUP BY 1),
{prefix}_grid AS (
  SELECT g.station_id, g.hour, g.trips FROM {prefix}_full g LEFT JOIN {prefix}_first f
    ON g.station_id = f.station_id WHERE g.hour >= f.first_month)"""
    else:
        g += f""",
{prefix}_grid AS (SELECT * FROM {prefix}_full)"""
    return g


def holiday_sql(d: str) -> str:
    def fixed(x, m, day, since):
        c = f"(month({x}) = {m} AND day({x}) = {day}"
        if since:
            c += f" AND year({x}) >= {since}"
        return c + ")"
    parts = [fixed(d, m, day, s) for _, m, day, s in _DATES]
    parts += [f"(month({d}) = {m} AND isodow({d}) = {w} AND day({d}) BETWEEN {lo} AND {hi})"
              for _, m, w, lo, hi in _WEEKDAYS]
    for _, m, day, s in _DATES:
        parts.append(f"(isodow({d}) = 5 AND {fixed(f'({d} + INTERVAL 1 DAY)', m, day, s)})")
        parts.append(f"(isodow({d}) = 1 AND {fixed(f'({d} - INTERVAL 1 DAY)', m, day, s)})")
    return "(" + " OR ".join(parts) + ")"


def calendar_cols(ts: str = "hour") -> str:
    return f"""CAST(hour({ts}) AS INTEGER) AS hour_of_day, CAST(isodow({ts}) AS INTEGER) AS day_of_week,
         CAST(month({ts}) AS INTEGER) AS month, isodow({ts}) >= 6 AS is_weekend,
         {holiday_sql(f'CAST({ts} AS DATE)')} AS is_holiday,
         sin(hour({ts}) * (2 * pi()) / 24) AS hour_sin, cos(hour({ts}) * (2 * pi()) / 24) AS hour_cos,
         sin(month({ts}) * (2 * pi()) / 12) AS month_sin, cos(month({ts}) * (2 * pi()) / 12) AS month_cos"""


def lag_cols(grain, src: str = "trips", key: str = "station_id", ts: str = "hour") -> str:
    """Textbook definitions: positional lag per key; rolling mean of the
    same-phase lags s, 2s, ..., k*s with nulls skipped."""
    w = f"OVER (PARTITION BY {key} ORDER BY {ts})"
    cols = [f"lag({src}, {h}) {w} AS lag_{h}" for h in grain.lags]
    for k in grain.rolling:
        lags = [f"lag({src}, {grain.season * i}) {w}" for i in range(1, k + 1)]
        num = " + ".join(f"coalesce({x}, 0)" for x in lags)
        den = " + ".join(f"CAST({x} IS NOT NULL AS INTEGER)" for x in lags)
        cols.append(f"CAST(({num}) AS DOUBLE) / nullif({den}, 0) AS {grain.roll_name(k)}")
    return ",\n         ".join(cols)


def station_master_cte(name: str, clean: str) -> str:
    return f"""
{name}_mode AS (
  SELECT station_id, start_station_name AS name FROM (
    SELECT station_id, start_station_name,
           row_number() OVER (PARTITION BY station_id ORDER BY count(*) DESC, start_station_name) AS rn
    FROM {clean} WHERE start_station_name IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
{name} AS (
  SELECT c.station_id, m.name, median(start_lat) AS lat, median(start_lng) AS lng,
         count(*) AS total_trips, strftime(min(started_at), '%Y-%m') AS first_month,
         strftime(max(started_at), '%Y-%m') AS last_month
  FROM {clean} c LEFT JOIN {name}_mode m ON c.station_id = m.station_id
  GROUP BY c.station_id, m.name)"""


EV_COV = f"""
ev_hours AS (
  SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events),
                                (SELECT max(date_trunc('hour', ts)) FROM events), INTERVAL 1 HOUR)) AS hour),
ev_stats AS (
  SELECT date_trunc('hour', ts) AS hour, avg(value) AS v_avg, count_if(event_type = 'error') AS n_err,
         count(*) AS n, avg(CASE WHEN event_type = 'view' THEN value END) AS v_view
  FROM events GROUP BY 1),
ev_cov AS (
  SELECT h.hour AS timestamp,
         coalesce(v_avg, {D(0.0)}) / {D(10.0)} - {D(5.0)} AS temperature_2m,
         coalesce(n_err, 0) * {D(0.25)} AS precipitation,
         CASE WHEN hour(h.hour) < 6 AND coalesce(n_err, 0) >= 2 THEN coalesce(n_err, 0) * {D(0.1)}
              ELSE {D(0.0)} END AS snowfall,
         CAST(coalesce(n, 0) AS DOUBLE) AS wind_speed_10m,
         coalesce(v_view, {D(0.0)}) / {D(5.0)} AS relative_humidity_2m
  FROM ev_hours h LEFT JOIN ev_stats s ON h.hour = s.hour)"""

OR_COV = f"""
or_days AS (
  SELECT unnest(generate_series((SELECT min(date_trunc('day', o_orderdate)) FROM orders),
                                (SELECT max(date_trunc('day', o_orderdate)) FROM orders), INTERVAL 1 DAY)) AS hour),
or_stats AS (
  SELECT date_trunc('day', l_shipdate) AS hour, avg(l_quantity) AS q, avg(l_discount) AS d, avg(l_tax) AS t,
         count(*) AS n, avg(l_extendedprice) AS p
  FROM lineitem GROUP BY 1),
or_cov AS (
  SELECT h.hour AS timestamp, coalesce(q, {D(0.0)}) AS temperature_2m,
         coalesce(d, {D(0.0)}) * {D(10.0)} AS precipitation, coalesce(t, {D(0.0)}) * {D(10.0)} AS snowfall,
         CAST(coalesce(n, 0) AS DOUBLE) AS wind_speed_10m, coalesce(p, {D(0.0)}) / {D(1000.0)} AS relative_humidity_2m
  FROM or_days h LEFT JOIN or_stats s ON h.hour = s.hour)"""

EVENT_DAYS = """
cal AS (
  SELECT CAST(CAST(y AS VARCHAR) || '-' || s AS DATE) AS start_date, CAST(CAST(y AS VARCHAR) || '-' || e AS DATE) AS end_date,
         event_name
  FROM (VALUES {pats}) p(s, e, event_name), range({y0}, {y1}) r(y)),
event_days AS (
  SELECT date, event_name FROM (
    SELECT CAST(d AS DATE) AS date, event_name,
           row_number() OVER (PARTITION BY CAST(d AS DATE) ORDER BY start_date, event_name) AS rn
    FROM (SELECT unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d, event_name, start_date FROM cal))
  WHERE rn = 1)""".format(
    pats=", ".join(f"('{s}', '{e}', '{n}')" for s, e, n in _PERIODS), y0=_PERIOD_YEARS[0], y1=_PERIOD_YEARS[1] + 1)

HOUR_BASE = "WITH " + ",".join([EV_TRIPS, MAPPING, clean_cte("ev_clean", "ev_trips", DEFAULT, True),
                                grid_ctes("hg", "ev_clean", DEFAULT)])
HOUR_BASE_UNTRIMMED = "WITH " + ",".join([EV_TRIPS, MAPPING, clean_cte("ev_clean", "ev_trips", DEFAULT, True),
                                          grid_ctes("hg", "ev_clean", DEFAULT, trim=False)])
DAY_BASE = "WITH " + ",".join([OR_TRIPS, clean_cte("or_clean", "or_trips", DAILY, False),
                               grid_ctes("dg", "or_clean", DAILY)])

ORACLES: dict[str, str] = {}

ORACLES["naive_mae_by_hour"] = HOUR_BASE + f""",
f AS (SELECT *, CAST(hour(hour) AS INTEGER) AS hour_of_day,
             lag(trips, 168) OVER (PARTITION BY station_id ORDER BY hour) AS lag_168 FROM hg_grid)
SELECT hour_of_day, round(avg(abs(trips - CAST(coalesce(lag_168, 0) AS DOUBLE))), 6) + 0.0 AS mae, count(*) AS n
FROM f GROUP BY hour_of_day"""

_RULES = lambda cfg: f"""count(*) AS total,
       count_if(NOT (start_station_id IS NOT NULL)) AS missing_station,
       count_if(NOT ({dur()} >= {cfg.min_trip_seconds})) AS too_short_or_negative,
       count_if(NOT ({dur()} <= {cfg.max_trip_hours * 3600})) AS too_long"""

ORACLES["removal_report"] = f"WITH {EV_TRIPS} SELECT {_RULES(DEFAULT)} FROM ev_trips"
ORACLES["removal_report_daily"] = f"WITH {OR_TRIPS} SELECT {_RULES(DAILY)} FROM or_trips"
ORACLES["clean_trips"] = ("WITH " + ",".join([EV_TRIPS, MAPPING, clean_cte("ev_clean", "ev_trips", DEFAULT, True)])
                          + """ SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
  end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual, station_id FROM ev_clean""")
ORACLES["top_n_scope"] = HOUR_BASE + " SELECT station_id, trips FROM hg_scope"
ORACLES["series_hour_counts"] = HOUR_BASE + " SELECT * FROM hg_counts"
ORACLES["full_grid"] = HOUR_BASE_UNTRIMMED + " SELECT * FROM hg_grid"
ORACLES["grid_identity"] = HOUR_BASE_UNTRIMMED + """
SELECT count(*) AS n_rows, count(DISTINCT station_id) AS n_keys, count(DISTINCT hour) AS n_hours,
       count(DISTINCT station_id) * count(DISTINCT hour) AS expected_rows,
       count(*) = count(DISTINCT station_id) * count(DISTINCT hour) AS is_complete FROM hg_grid"""
ORACLES["trim_to_lifetime"] = DAY_BASE + " SELECT * FROM dg_grid"
ORACLES["station_master"] = ("WITH " + ",".join([EV_TRIPS, MAPPING, clean_cte("ev_clean", "ev_trips", DEFAULT, True),
                                                 station_master_cte("sm", "ev_clean")])
                             + " SELECT station_id, name, round(lat, 6) + 0.0 AS lat, round(lng, 6) + 0.0 AS lng, total_trips,"
                               " first_month, last_month FROM sm")
ORACLES["station_month_panel"] = "WITH " + ",".join([OR_TRIPS, clean_cte("or_clean", "or_trips", DAILY, False)]) + """
SELECT station_id, strftime(started_at, '%Y-%m') AS month,
       CAST(count_if(member_casual = 'member') AS INTEGER) AS member_trips,
       CAST(count_if(member_casual = 'casual') AS INTEGER) AS casual_trips,
       CAST(count_if(member_casual IN ('member', 'casual')) AS INTEGER) AS total_trips
FROM or_clean GROUP BY 1, 2"""


def _round_cols(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)


_CAL_D = ["hour_sin", "hour_cos", "month_sin", "month_cos"]
ORACLES["calendar_features"] = DAY_BASE + f""",
c AS (SELECT *, {calendar_cols()} FROM dg_grid)
SELECT station_id, hour, trips, hour_of_day, day_of_week, month, is_weekend, is_holiday, {_round_cols(_CAL_D)} FROM c"""

ORACLES["holiday_flag"] = f"""
WITH d AS (SELECT CAST(unnest(generate_series(make_date(CAST((SELECT year(min(o_orderdate)) FROM orders) AS BIGINT), 1, 1),
                                              make_date(CAST((SELECT year(max(o_orderdate)) FROM orders) AS BIGINT), 12, 31),
                                              INTERVAL 1 DAY)) AS DATE) AS date)
SELECT date, {{name}} AS holiday FROM d WHERE {holiday_sql('date')}"""


def _holiday_name_sql(d: str) -> str:
    def fixed(x, m, day, since):
        c = f"(month({x}) = {m} AND day({x}) = {day}"
        if since:
            c += f" AND year({x}) >= {since}"
        return c + ")"
    br = [(fixed(d, m, day, s), n) for n, m, day, s in _DATES]
    br += [(f"(month({d}) = {m} AND isodow({d}) = {w} AND day({d}) BETWEEN {lo} AND {hi})", n)
           for n, m, w, lo, hi in _WEEKDAYS]
    for n, m, day, s in _DATES:
        br.append((f"(isodow({d}) = 5 AND {fixed(f'({d} + INTERVAL 1 DAY)', m, day, s)})", f"{n} (observed)"))
        br.append((f"(isodow({d}) = 1 AND {fixed(f'({d} - INTERVAL 1 DAY)', m, day, s)})", f"{n} (observed)"))
    esc = lambda s: s.replace("'", "''")
    return "CASE " + " ".join(f"WHEN {c} THEN '{esc(n)}'" for c, n in br) + " END"


ORACLES["holiday_flag"] = ORACLES["holiday_flag"].replace("{name}", _holiday_name_sql("date"))

ORACLES["event_flag"] = DAY_BASE + "," + EVENT_DAYS + """
SELECT g.station_id, g.hour, g.trips, CAST(e.event_name IS NOT NULL AS INTEGER) AS is_major_event
FROM dg_grid g LEFT JOIN event_days e ON CAST(g.hour AS DATE) = e.date"""
ORACLES["event_coverage"] = DAY_BASE + "," + EVENT_DAYS + """,
f AS (SELECT g.*, CAST(e.event_name IS NOT NULL AS INTEGER) AS is_major_event
      FROM dg_grid g LEFT JOIN event_days e ON CAST(g.hour AS DATE) = e.date)
SELECT strftime(hour, '%Y-%m') AS month, CAST(sum(is_major_event) AS BIGINT) AS event_rows, count(*) AS rows,
       round(sum(is_major_event) / count(*), 6) + 0.0 AS event_share FROM f GROUP BY 1"""

_COV = ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m"]
ORACLES["covariate_join"] = HOUR_BASE + "," + EV_COV + f"""
SELECT g.hour, g.station_id, g.trips, {_round_cols(_COV)} FROM hg_grid g LEFT JOIN ev_cov c ON g.hour = c.timestamp"""
ORACLES["covariate_match_rate"] = HOUR_BASE + "," + EV_COV + f"""
SELECT count(*) AS total, count(c.temperature_2m) AS matched, round(count(c.temperature_2m) / count(*), 6) + 0.0 AS match_rate,
       count(c.temperature_2m) / count(*) >= {DEFAULT.min_covariate_match} AS passed
FROM hg_grid g LEFT JOIN ev_cov c ON g.hour = c.timestamp"""
ORACLES["station_features"] = HOUR_BASE + "," + station_master_cte("sm", "ev_clean") + """
SELECT g.station_id, g.hour, g.trips, round(m.lat, 6) + 0.0 AS lat, round(m.lng, 6) + 0.0 AS lng
FROM hg_grid g LEFT JOIN sm m ON g.station_id = m.station_id"""


def _lag_names(grain):
    return [f"lag_{h}" for h in grain.lags] + [grain.roll_name(k) for k in grain.rolling]


ORACLES["lag_features"] = HOUR_BASE + f""",
f AS (SELECT station_id, hour, trips, {lag_cols(DEFAULT.grain)} FROM hg_grid)
SELECT station_id, hour, trips, {", ".join(f"lag_{h}" for h in DEFAULT.grain.lags)},
       {_round_cols([DEFAULT.grain.roll_name(k) for k in DEFAULT.grain.rolling])} FROM f"""
ORACLES["lag_features_daily"] = DAY_BASE + f""",
f AS (SELECT station_id, hour, trips, {lag_cols(DAILY.grain)} FROM dg_grid)
SELECT station_id, hour, trips, {", ".join(f"lag_{h}" for h in DAILY.grain.lags)},
       {_round_cols([DAILY.grain.roll_name(k) for k in DAILY.grain.rolling])} FROM f"""

FEAT_HOUR = HOUR_BASE + "," + EV_COV + "," + station_master_cte("sm", "ev_clean") + f""",
feat AS (
  SELECT g.station_id, g.hour, g.trips, {calendar_cols('g.hour')},
         c.temperature_2m, c.precipitation, c.snowfall, c.wind_speed_10m, c.relative_humidity_2m,
         m.lat, m.lng, {lag_cols(DEFAULT.grain, 'g.trips', 'g.station_id', 'g.hour')}
  FROM hg_grid g LEFT JOIN ev_cov c ON g.hour = c.timestamp LEFT JOIN sm m ON g.station_id = m.station_id)"""

_FEAT_D = _CAL_D + _COV + ["lat", "lng"] + [DEFAULT.grain.roll_name(k) for k in DEFAULT.grain.rolling]
ORACLES["feature_table"] = FEAT_HOUR + f"""
SELECT station_id, hour, trips, hour_of_day, day_of_week, month, is_weekend, is_holiday,
       {", ".join(f"lag_{h}" for h in DEFAULT.grain.lags)}, {_round_cols(_FEAT_D)} FROM feat"""


# ---------------------------------------------------------------- backtest (day grain)
def _bt_ctes(grain, base: str, grid_name: str, n: int) -> str:
    last_bucket = "CAST(last_day(mx) AS TIMESTAMP)" + (" + INTERVAL 23 HOUR" if grain.unit == "hour" else "")
    return base + f""",
f AS (SELECT station_id, hour, trips, CAST(isodow(hour) AS INTEGER) AS day_of_week,
             CAST(hour(hour) AS INTEGER) AS hour_of_day,
             lag(trips, {grain.week}) OVER (PARTITION BY station_id ORDER BY hour) AS naive_lag,
             strftime(hour, '%Y-%m') AS m FROM {grid_name}),
lastb AS (SELECT max(hour) AS mx FROM f),
wins AS (SELECT DISTINCT m AS "window" FROM f, lastb
         WHERE NOT (m = strftime(mx, '%Y-%m') AND mx < {last_bucket}) ORDER BY 1 DESC LIMIT {n}),
cut AS (SELECT w."window", (SELECT max(hour) FROM f WHERE f.m < w."window") AS cutoff FROM wins w),
naive AS (SELECT 'seasonal_naive' AS predictor, m AS "window", station_id, hour, trips,
                 CAST(coalesce(naive_lag, 0) AS DOUBLE) AS prediction FROM f WHERE m IN (SELECT "window" FROM wins)),
recent AS (SELECT c."window", f.* FROM f JOIN cut c ON f.hour <= c.cutoff AND f.hour > c.cutoff - INTERVAL 56 DAY),
prof AS (SELECT "window", station_id, day_of_week, hour_of_day, avg(trips) AS pm FROM recent GROUP BY ALL),
smean AS (SELECT "window", station_id, avg(trips) AS sm FROM recent GROUP BY ALL),
hist AS (SELECT 'historical_mean' AS predictor, f.m AS "window", f.station_id, f.hour, f.trips,
                coalesce(p.pm, s.sm, 0.0) AS prediction
         FROM f LEFT JOIN prof p ON p."window" = f.m AND p.station_id = f.station_id
                 AND p.day_of_week = f.day_of_week AND p.hour_of_day = f.hour_of_day
         LEFT JOIN smean s ON s."window" = f.m AND s.station_id = f.station_id
         WHERE f.m IN (SELECT "window" FROM wins)),
preds AS (SELECT * FROM naive UNION ALL SELECT * FROM hist),
results AS (SELECT predictor, "window", avg(abs(trips - prediction)) AS mae,
                   sqrt(avg(pow(trips - prediction, 2))) AS rmse, count(*) AS n FROM preds GROUP BY 1, 2)"""


BT_DAY = _bt_ctes(DAILY.grain, DAY_BASE, "dg_grid", DAILY.n_windows)
ORACLES["eval_months"] = BT_DAY + ' SELECT "window" FROM wins'
ORACLES["eval_months_hourly"] = _bt_ctes(DEFAULT.grain, HOUR_BASE, "hg_grid", DEFAULT.n_windows) + ' SELECT "window" FROM wins'
ORACLES["backtest_naive"] = BT_DAY + """ SELECT predictor, "window", round(mae, 6) + 0.0 AS mae, round(rmse, 6) + 0.0 AS rmse, n
FROM results WHERE predictor = 'seasonal_naive'"""
ORACLES["backtest_hist_mean"] = BT_DAY + """ SELECT predictor, "window", round(mae, 6) + 0.0 AS mae, round(rmse, 6) + 0.0 AS rmse, n
FROM results WHERE predictor = 'historical_mean'"""
ORACLES["backtest_summary"] = BT_DAY + """,
nv AS (SELECT "window", mae AS naive_mae FROM results WHERE predictor = 'seasonal_naive')
SELECT r.predictor, round(avg(mae), 6) + 0.0 AS mae_mean, round(stddev_samp(mae), 6) + 0.0 AS mae_std,
       round(avg(rmse), 6) + 0.0 AS rmse_mean, round(avg(mae / nullif(naive_mae, 0)), 6) + 0.0 AS mase_mean
FROM results r LEFT JOIN nv ON r."window" = nv."window" GROUP BY r.predictor"""

PT_DAY = BT_DAY + """,
lastw AS (SELECT max("window") AS w FROM wins),
pt AS (SELECT n.station_id, n.hour, n.trips, n.prediction AS pred_seasonal_naive, h.prediction AS pred_historical_mean
       FROM naive n JOIN hist h ON n.station_id = h.station_id AND n.hour = h.hour
       WHERE n."window" = (SELECT w FROM lastw)),
err AS (SELECT *, abs(trips - pred_historical_mean) AS ae_model, abs(trips - pred_seasonal_naive) AS ae_naive,
               pred_historical_mean - trips AS bias_model,
               abs(trips - pred_seasonal_naive) - abs(trips - pred_historical_mean) AS improvement FROM pt)"""
ORACLES["prediction_table"] = PT_DAY + """ SELECT station_id, hour, trips,
  round(pred_seasonal_naive, 6) + 0.0 AS pred_seasonal_naive, round(pred_historical_mean, 6) + 0.0 AS pred_historical_mean FROM pt"""
ORACLES["error_overall"] = PT_DAY + """ SELECT round(avg(ae_model), 6) + 0.0 AS model_mae, round(avg(ae_naive), 6) + 0.0 AS naive_mae,
  round(avg(improvement), 6) + 0.0 AS mae_reduction_vs_naive, round(avg(bias_model), 6) + 0.0 AS mean_bias, count(*) AS n,
  round((1 - avg(ae_model) / nullif(avg(ae_naive), 0)) * 100, 6) + 0.0 AS pct_reduction FROM err"""

_SLICE = """round(avg(ae_model), 6) + 0.0 AS mae_model, round(avg(ae_naive), 6) + 0.0 AS mae_naive,
  round(avg(improvement), 6) + 0.0 AS mae_reduction, round(avg(trips), 6) + 0.0 AS avg_trips,
  CAST(sum(trips) AS BIGINT) AS total_trips, count(*) AS n,
  round(1 - avg(ae_model) / nullif(avg(ae_naive), 0), 6) + 0.0 AS pct_reduction_vs_naive"""
ORACLES["error_by_weekday"] = PT_DAY + f" SELECT CAST(isodow(hour) AS INTEGER) AS day_of_week, {_SLICE} FROM err GROUP BY 1"
ORACLES["error_by_weekend"] = PT_DAY + f" SELECT isodow(hour) >= 6 AS is_weekend, {_SLICE} FROM err GROUP BY 1"
ORACLES["error_by_day"] = PT_DAY + f" SELECT CAST(hour AS DATE) AS date, {_SLICE} FROM err GROUP BY 1"
ORACLES["error_by_rain"] = PT_DAY + "," + OR_COV + f""" SELECT c.precipitation > 0.5 AS rainy, {_SLICE}
FROM err LEFT JOIN or_cov c ON err.hour = c.timestamp GROUP BY 1"""
ORACLES["error_by_series"] = PT_DAY + "," + clean_cte("or_clean2", "or_trips", DAILY, False) + "," + \
    station_master_cte("sm", "or_clean2") + f""",
s AS (SELECT station_id, {_SLICE} FROM err GROUP BY 1)
SELECT s.*, sm.name, round(sm.lat, 6) + 0.0 AS lat, round(sm.lng, 6) + 0.0 AS lng FROM s LEFT JOIN sm ON s.station_id = sm.station_id"""
ORACLES["peak_bias"] = PT_DAY + """,
thr AS (SELECT trips AS t FROM (SELECT trips, row_number() OVER (ORDER BY trips) - 1 AS i FROM err)
        WHERE i = (SELECT CAST(round((count(*) - 1) * 0.95) AS BIGINT) FROM err))
SELECT trips >= (SELECT t FROM thr) AS top_demand, round(avg(trips), 6) + 0.0 AS avg_actual,
       round(avg(pred_historical_mean), 6) + 0.0 AS avg_pred, round(avg(bias_model), 6) + 0.0 AS mean_bias,
       round(avg(ae_model), 6) + 0.0 AS mae_model, count(*) AS n, CAST((SELECT t FROM thr) AS DOUBLE) AS threshold
FROM err GROUP BY 1"""
ORACLES["worst_k_series"] = PT_DAY + f" SELECT station_id, {_SLICE} FROM err GROUP BY 1 ORDER BY mae_model DESC, station_id LIMIT 5"


ORACLES["best_days"] = PT_DAY + f" SELECT CAST(hour AS DATE) AS date, {_SLICE} FROM err GROUP BY 1 ORDER BY avg(ae_model), date LIMIT 5"
ORACLES["error_by_hour"] = FEAT_HOUR + f""",
err AS (SELECT hour, trips, abs(trips - roll_mean_7d) AS ae_model, abs(trips - lag_168) AS ae_naive,
               abs(trips - lag_168) - abs(trips - roll_mean_7d) AS improvement
        FROM feat WHERE lag_168 IS NOT NULL AND roll_mean_7d IS NOT NULL)
SELECT CAST(hour(hour) AS INTEGER) AS hour_of_day, {_SLICE} FROM err GROUP BY 1"""


# ---------------------------------------------------------------- profiles
EV_CLEAN_BASE = "WITH " + ",".join([EV_TRIPS, MAPPING, clean_cte("ev_clean", "ev_trips", DEFAULT, True)])
ORACLES["raw_overview"] = f"""WITH {EV_TRIPS} SELECT count(*) AS total_trips, min(started_at) AS min_started_at,
  max(started_at) AS max_started_at, count(DISTINCT start_station_id) AS n_start_station_ids,
  count(DISTINCT end_station_id) AS n_end_station_ids FROM ev_trips"""
ORACLES["clean_overview"] = EV_CLEAN_BASE + """ SELECT count(*) AS clean_trips,
  count(DISTINCT start_station_id) AS clean_start_station_ids FROM ev_clean"""
ORACLES["monthly_demand"] = f"WITH {OR_TRIPS} SELECT strftime(started_at, '%Y-%m') AS month, count(*) AS trips FROM or_trips GROUP BY 1"
ORACLES["peak_low_month"] = f"""WITH {OR_TRIPS},
m AS (SELECT strftime(started_at, '%Y-%m') AS month, count(*) AS trips FROM or_trips GROUP BY 1),
p AS (SELECT month, trips FROM m ORDER BY trips DESC, month LIMIT 1),
l AS (SELECT month, trips FROM m ORDER BY trips, month LIMIT 1)
SELECT p.month AS peak_month, p.trips AS peak_trips, l.month AS low_month, l.trips AS low_trips,
       (SELECT count(*) FROM m) AS months FROM p, l"""
ORACLES["quality_summary"] = f"""WITH {EV_TRIPS},
w AS (SELECT count(*) AS total, count_if({dur()} < 60) AS r1, count_if({dur()} > 86400) AS r2,
             count_if(start_station_id IS NULL) AS r3, count_if(end_station_id IS NULL) AS r4,
             count_if(started_at > ended_at) AS r5 FROM ev_trips)
SELECT rule, rows, round(rows / total * 100, 6) + 0.0 AS pct FROM (
  SELECT 'duration < 60s' AS rule, r1 AS rows, total FROM w UNION ALL
  SELECT 'duration > 24h', r2, total FROM w UNION ALL
  SELECT 'missing start_station_id', r3, total FROM w UNION ALL
  SELECT 'missing end_station_id', r4, total FROM w UNION ALL
  SELECT 'started_at > ended_at', r5, total FROM w)"""
ORACLES["duration_histogram"] = f"""WITH {EV_TRIPS},
d AS (SELECT {dur()} AS s FROM ev_trips),
b AS (SELECT CAST(least(floor(s / 72.0), 99) AS INTEGER) AS bin FROM d WHERE s BETWEEN 0 AND 7200)
SELECT bin, count(*) AS trips, CAST(bin * 72.0 AS DOUBLE) AS lo_seconds, CAST((bin + 1) * 72.0 AS DOUBLE) AS hi_seconds
FROM b GROUP BY bin"""
ORACLES["hourly_profile"] = EV_CLEAN_BASE + """ SELECT CAST(hour(started_at) AS INTEGER) AS hour,
  isodow(started_at) >= 6 AS is_weekend, count(*) AS trips FROM ev_clean GROUP BY 1, 2"""
ORACLES["weekday_hour_pivot"] = EV_CLEAN_BASE + " SELECT CAST(isodow(started_at) AS INTEGER) AS weekday, " + ", ".join(
    f"count_if(hour(started_at) = {h}) AS h{h}" for h in range(24)) + " FROM ev_clean GROUP BY 1"
ORACLES["type_hourly"] = EV_CLEAN_BASE + """ SELECT CAST(hour(started_at) AS INTEGER) AS hour, member_casual,
  count(*) AS trips FROM ev_clean GROUP BY 1, 2"""
SYS = EV_CLEAN_BASE + "," + EV_COV + """,
sys AS (SELECT date_trunc('hour', started_at) AS timestamp, count(*) AS trips FROM ev_clean GROUP BY 1),
sw AS (SELECT s.timestamp, s.trips, c.temperature_2m, c.precipitation, c.snowfall FROM sys s JOIN ev_cov c
       ON s.timestamp = c.timestamp)"""
ORACLES["system_hourly"] = SYS + " SELECT * FROM sys"
ORACLES["system_match_rate"] = SYS + """ SELECT count(*) AS hours, count(c.timestamp) AS matched,
  round(count(c.timestamp) / count(*), 6) + 0.0 AS match_rate, count(c.timestamp) / count(*) >= 0.95 AS passed
  FROM sys s LEFT JOIN ev_cov c ON s.timestamp = c.timestamp"""
ORACLES["mean_by_hour_of_day"] = SYS + """ SELECT CAST(hour(timestamp) AS INTEGER) AS hour,
  round(avg(trips), 6) + 0.0 AS avg_trips FROM sys GROUP BY 1"""
ORACLES["temp_bins"] = SYS + """ SELECT CAST(floor(temperature_2m / 5.0) * 5.0 AS DOUBLE) + 0.0 AS temp_bin_c,
  round(avg(trips), 6) + 0.0 AS avg_trips_per_hour, count(*) AS hours FROM sw GROUP BY 1 HAVING count(*) >= 20"""
for _name, _flag, _col in (("rain_effect", "precipitation > 0.5", "rainy_hour"), ("snow_effect", "snowfall > 0", "snowy_hour")):
    ORACLES[_name] = SYS + f""",
g AS (SELECT {_flag} AS {_col}, avg(trips) AS a, count(*) AS hours FROM sw GROUP BY 1)
SELECT {_col}, round(a, 6) + 0.0 AS avg_trips_per_hour, hours,
       round((1 - a / nullif((SELECT a FROM g WHERE NOT {_col}), 0)) * 100, 6) + 0.0 AS reduction_pct FROM g"""
ORACLES["zero_inflation"] = DAY_BASE + """ SELECT count(*) AS station_hours,
  round(avg(CAST(trips = 0 AS DOUBLE)), 6) + 0.0 AS zero_share, round(avg(trips), 6) + 0.0 AS avg_trips FROM dg_grid"""
ORACLES["zero_inflation_monthly"] = DAY_BASE + """ SELECT strftime(hour, '%Y-%m') AS month, count(*) AS station_hours,
  round(avg(CAST(trips = 0 AS DOUBLE)), 6) + 0.0 AS zero_share, round(avg(trips), 6) + 0.0 AS avg_trips FROM dg_grid GROUP BY 1"""
VOL = EV_CLEAN_BASE + """,
vol AS (SELECT station_id, count(*) AS trips FROM ev_clean
        WHERE started_at >= (SELECT max(started_at) - INTERVAL 365 DAY FROM ev_clean) GROUP BY 1),
rk AS (SELECT station_id, trips, row_number() OVER (ORDER BY trips DESC, station_id) AS rank,
              sum(trips) OVER (ORDER BY trips DESC, station_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              / (SELECT sum(trips) FROM vol) AS cum_share FROM vol)"""
ORACLES["cum_share_rank"] = VOL + " SELECT station_id, trips, rank, round(cum_share, 6) + 0.0 AS cum_share FROM rk"
ORACLES["rank_for_share"] = VOL + """ SELECT rank AS top_n, round(cum_share, 6) + 0.0 AS cum_share,
  (SELECT min(rank) FROM rk WHERE cum_share >= 0.65) AS rank_for_target, CAST(0.65 AS DOUBLE) AS target FROM rk WHERE rank IN (10, 20, 50, 100)"""
ORACLES["shift_sanity"] = EV_CLEAN_BASE + """,
wk AS (SELECT CAST(hour(started_at) AS INTEGER) AS hour, count(*) AS trips FROM ev_clean WHERE isodow(started_at) < 6 GROUP BY 1),
v AS (SELECT (SELECT hour FROM wk ORDER BY trips DESC, hour LIMIT 1) AS peak_hour,
             coalesce((SELECT trips FROM wk WHERE hour = 8), 0) AS morning_trips,
             coalesce((SELECT trips FROM wk WHERE hour = 3), 0) AS night_trips)
SELECT *, peak_hour IN (16, 17, 18) AS peak_ok, morning_trips > 3 * night_trips AS morning_ok,
       peak_hour IN (16, 17, 18) AND morning_trips > 3 * night_trips AS passed FROM v"""
ORACLES["coordinate_quality"] = EV_CLEAN_BASE + "," + station_master_cte("sm", "ev_clean") + """
SELECT count(*) AS stations, count_if(lat IS NULL) AS missing_lat, count_if(lng IS NULL) AS missing_lng,
  count_if(lat < 41.0 OR lat > 43.0) AS lat_outside_box, count_if(lng < -89.0 OR lng > -87.0) AS lng_outside_box FROM sm"""


# ---------------------------------------------------------------- spatial
def _hav(a: str, b: str) -> str:
    return (f"2 * {D(6371000.0)} * asin(sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + "
            f"cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2)))")


SPATIAL = f"""WITH
vol AS (SELECT l_partkey, count(*) AS total_trips FROM lineitem GROUP BY 1),
st AS (SELECT CAST(vec_id AS VARCHAR) AS station_id,
         CASE WHEN vec_id % 3 = 0 THEN 'Dock & Pier ' || CAST(label AS VARCHAR)
              WHEN vec_id % 3 = 1 THEN 'dock and pier  ' || CAST(label AS VARCHAR)
              ELSE 'DOCK ' || CAST(label AS VARCHAR) END AS station_name,
         {D(41.85)} + CAST(floor(vec_id / 500.0) AS DOUBLE) * {D(0.05)} + CAST(embedding[1] AS DOUBLE) * {D(0.02)} AS lat,
         {D(-87.65)} + CAST(embedding[2] AS DOUBLE) * {D(0.02)} AS lng,
         CAST(coalesce(v.total_trips, 0) AS BIGINT) AS total_trips
       FROM embeddings e LEFT JOIN vol v ON e.vec_id = v.l_partkey),
pp AS (SELECT a.station_id AS id_a, a.station_name AS name_a, a.total_trips AS trips_a,
              b.station_id AS id_b, b.station_name AS name_b, b.total_trips AS trips_b, {_hav('a', 'b')} AS d
       FROM st a JOIN st b ON a.station_id < b.station_id),
pairs AS (SELECT id_a, name_a, trips_a, id_b, name_b, trips_b, round(d, 1) + 0.0 AS dist_m FROM pp WHERE d < 30),
e0 AS (SELECT CASE WHEN trips_a >= trips_b THEN id_b ELSE id_a END AS raw_station_id,
              CASE WHEN trips_a >= trips_b THEN id_a ELSE id_b END AS canonical_station_id,
              greatest(trips_a, trips_b) AS canonical_trips
       FROM pairs
       WHERE regexp_replace(replace(lower(coalesce(name_a, '')), '&', 'and'), '\\s+', '', 'g')
           = regexp_replace(replace(lower(coalesce(name_b, '')), '&', 'and'), '\\s+', '', 'g')),
edges AS (SELECT raw_station_id, canonical_station_id, canonical_trips FROM (
            SELECT *, row_number() OVER (PARTITION BY raw_station_id ORDER BY canonical_trips DESC,
                                         canonical_station_id) AS rn FROM e0) WHERE rn = 1),
walk AS (SELECT * FROM (WITH RECURSIVE w(raw, cur, depth) AS (
            SELECT raw_station_id, canonical_station_id, 0 FROM edges
            UNION ALL
            SELECT w.raw, e.canonical_station_id, w.depth + 1 FROM w JOIN edges e ON w.cur = e.raw_station_id
            WHERE w.depth < 100)
          SELECT raw, cur, depth FROM w)),
flat AS (SELECT raw AS raw_station_id, arg_max(cur, depth) AS canonical_station_id FROM walk GROUP BY raw)"""
ORACLES["near_pairs"] = SPATIAL + " SELECT * FROM pairs"
ORACLES["duplicate_edges"] = SPATIAL + " SELECT * FROM edges"
ORACLES["flatten_mapping"] = SPATIAL + " SELECT * FROM flat"


def _guards(src: str) -> str:
    chains = f"(SELECT count(*) FROM {src} WHERE canonical_station_id IN (SELECT raw_station_id FROM {src}))"
    selfm = "coalesce(count_if(raw_station_id = canonical_station_id), 0)"
    return f"""
SELECT count(*) AS rows, count(*) - count(DISTINCT raw_station_id) AS duplicate_raw_ids,
       {selfm} AS self_maps, count(DISTINCT canonical_station_id) AS targets, {chains} AS chains,
       count(*) - count(DISTINCT raw_station_id) = 0 AND {chains} = 0 AND {selfm} = 0 AS passed
FROM {src}"""


ORACLES["mapping_guards"] = SPATIAL + _guards("flat")
ORACLES["supplier_mapping_guards"] = "WITH " + MAPPING + _guards("mapping")

_SLOTS = [f"{w}_{h}" for w in (0, 1) for h in range(24)]
ORACLES["station_profiles"] = HOUR_BASE + """,
pm AS (SELECT station_id, CAST(isodow(hour) >= 6 AS INTEGER) AS w, hour(hour) AS h, avg(trips) AS a FROM hg_grid GROUP BY ALL),
pv AS (SELECT station_id, """ + ", ".join(
    f"""coalesce(max(a) FILTER (WHERE w = {s.split('_')[0]} AND h = {s.split('_')[1]}), 0.0) AS "{s}\"""" for s in _SLOTS) + """
       FROM pm GROUP BY station_id),
pt AS (SELECT *, """ + " + ".join(f'"{s}"' for s in _SLOTS) + """ AS total FROM pv)
SELECT station_id, """ + ", ".join(
    f"""round(CASE WHEN total > 0 THEN "{s}" / total ELSE 0.0 END, 6) + 0.0 AS "{s}\"""" for s in _SLOTS) + " FROM pt"


# ---------------------------------------------------------------- serving (hour grain, seasonal-naive artifact)
SERVE = HOUR_BASE + """,
lastday AS (SELECT CAST(max(hour) AS DATE) AS d FROM hg_grid),
asof_days AS (SELECT d - 2 AS as_of FROM lastday UNION ALL SELECT d - 1 FROM lastday),
fut AS (SELECT a.as_of, k.station_id,
               unnest(generate_series(CAST(a.as_of + 1 AS TIMESTAMP), CAST(a.as_of + 1 AS TIMESTAMP) + INTERVAL 23 HOUR,
                                      INTERVAL 1 HOUR)) AS hour
        FROM asof_days a JOIN (SELECT DISTINCT station_id FROM hg_grid) k
          ON EXISTS (SELECT 1 FROM hg_grid g WHERE g.station_id = k.station_id
                     AND CAST(g.hour AS DATE) <= a.as_of)),
store AS (SELECT f.as_of, f.station_id, f.hour, CAST(coalesce(p.trips, 0) AS DOUBLE) AS prediction,
                 'seasonal-naive-v1' AS model_version
          FROM (SELECT DISTINCT as_of, station_id, hour FROM fut) f
          LEFT JOIN hg_grid p ON p.station_id = f.station_id AND p.hour = f.hour - INTERVAL 168 HOUR),
detail AS (SELECT s.*, g.trips AS actual, abs(s.prediction - g.trips) AS absolute_error
           FROM store s JOIN hg_grid g ON s.station_id = g.station_id AND s.hour = g.hour),
daily AS (SELECT as_of, CAST(hour AS DATE) AS target_date, avg(absolute_error) AS mae, count(*) AS n
          FROM detail GROUP BY 1, 2)"""
ORACLES["batch_forecast"] = SERVE + " SELECT as_of, station_id, hour, round(prediction, 6) + 0.0 AS prediction, model_version FROM store"
ORACLES["forecast_eval"] = SERVE + " SELECT as_of, target_date, round(mae, 6) + 0.0 AS mae, n FROM daily"
ORACLES["replay_mae"] = ORACLES["forecast_eval"]
ORACLES["forecast_unmatched"] = SERVE + """ SELECT s.as_of, s.station_id, s.hour, s.prediction, s.model_version FROM store s
  WHERE NOT EXISTS (SELECT 1 FROM hg_grid g WHERE g.station_id = s.station_id AND g.hour = s.hour)"""
ORACLES["store_health"] = SERVE + """ SELECT count(DISTINCT as_of) AS partitions, max(as_of) AS newest_as_of, count(*) AS rows,
  'seasonal-naive-v1' AS newest_model_version FROM store"""
ORACLES["forecast_lookup"] = SERVE + """ SELECT as_of, station_id, hour, round(prediction, 2) + 0.0 AS prediction, model_version
  FROM store WHERE as_of = (SELECT max(as_of) FROM store) AND station_id = (SELECT min(station_id) FROM store)"""
ORACLES["forecast_scope"] = SERVE + """ SELECT station_id FROM hg_scope
  WHERE station_id IN (SELECT station_id FROM store WHERE as_of = (SELECT max(as_of) FROM store))"""
ORACLES["history_coverage"] = HOUR_BASE + f""",
lk AS (SELECT CAST(CAST(max(hour) AS DATE) - 1 AS TIMESTAMP) + INTERVAL 23 HOUR AS last FROM hg_grid),
hs AS (SELECT last, last + INTERVAL 1 HOUR - INTERVAL {DEFAULT.grain.needed_history} HOUR AS start FROM lk),
keys AS (SELECT DISTINCT station_id FROM hg_grid WHERE hour <= (SELECT last FROM lk)),
cov AS (SELECT station_id, count(*) AS n_rows, count(DISTINCT hour) AS n_hours, min(hour) AS first_hour,
               max(hour) AS last_hour FROM hg_grid
        WHERE hour <= (SELECT last FROM lk) AND hour >= (SELECT start FROM hs) GROUP BY 1)
SELECT k.station_id, c.n_rows, c.n_hours, c.first_hour, c.last_hour,
       coalesce(c.n_rows, 0) = {DEFAULT.grain.needed_history} AND coalesce(c.n_hours, 0) = {DEFAULT.grain.needed_history}
       AND c.first_hour IS NOT DISTINCT FROM (SELECT start FROM hs)
       AND c.last_hour IS NOT DISTINCT FROM (SELECT last FROM lk) AS complete
FROM keys k LEFT JOIN cov c ON k.station_id = c.station_id"""
def _inference_sql() -> str:
    g = DEFAULT.grain
    lags = ",\n         ".join(
        f"(SELECT trips FROM hg_grid h WHERE h.station_id = f.station_id AND h.hour = f.hour - INTERVAL {l} HOUR) AS lag_{l}"
        for l in g.lags)
    rolls = ",\n         ".join(
        f"(SELECT avg(trips) FROM hg_grid h WHERE h.station_id = f.station_id AND hour(h.hour) = hour(f.hour)"
        f" AND h.hour BETWEEN f.hour - INTERVAL {24 * k} HOUR AND f.hour - INTERVAL 24 HOUR) AS {g.roll_name(k)}"
        for k in g.rolling)
    return HOUR_BASE + "," + EV_COV + "," + station_master_cte("sm", "ev_clean") + f""",
lk AS (SELECT CAST(CAST(max(hour) AS DATE) - 1 AS TIMESTAMP) + INTERVAL 23 HOUR AS last FROM hg_grid),
keys AS (SELECT DISTINCT station_id FROM hg_grid WHERE hour <= (SELECT last FROM lk)),
fut AS (SELECT k.station_id, unnest(generate_series((SELECT last FROM lk) + INTERVAL 1 HOUR,
                                                    (SELECT last FROM lk) + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS hour
        FROM keys k),
fl AS (SELECT f.station_id, f.hour, {lags},
         {rolls} FROM fut f),
feat AS (SELECT fl.*, {calendar_cols('fl.hour')}, c.temperature_2m, c.precipitation, c.snowfall, c.wind_speed_10m,
                c.relative_humidity_2m, m.lat, m.lng
         FROM fl LEFT JOIN ev_cov c ON fl.hour = c.timestamp LEFT JOIN sm m ON fl.station_id = m.station_id)
SELECT station_id, hour, CAST(NULL AS INTEGER) AS trips, hour_of_day, day_of_week, month, is_weekend, is_holiday,
       {", ".join(f"lag_{h}" for h in g.lags)}, {_round_cols(_FEAT_D)} FROM feat"""


ORACLES["inference_features"] = _inference_sql()

_BASELINE = """(SELECT avg(abs(trips - coalesce(l168, 0))) FROM (
   SELECT hour, trips, lag(trips, 168) OVER (PARTITION BY station_id ORDER BY hour) AS l168 FROM hg_grid)
   WHERE hour >= CAST((SELECT min(as_of) FROM asof_days) + 1 - 7 AS TIMESTAMP)
     AND hour < CAST((SELECT min(as_of) FROM asof_days) + 1 AS TIMESTAMP))"""
ORACLES["performance_gate"] = SERVE + f"""
SELECT 'performance' AS gate, avg(mae) <= {_BASELINE} * 1.2 AS passed, round(avg(mae), 4) + 0.0 AS mean_mae,
       round({_BASELINE}, 4) + 0.0 AS baseline_mae, round({_BASELINE} * 1.2, 4) + 0.0 AS threshold,
       CAST(0.2 AS DOUBLE) AS tolerance, count(*) AS n_days FROM daily"""


def _drift_core(base: str) -> str:
    """Drift statistics over a ``sides`` CTE (feature rows + side 'ref'/'cur')."""
    cols = ["temperature_2m", "precipitation", "wind_speed_10m", "lag_24", "lag_168", "roll_mean_7d"]
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    melt = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value, side FROM sides WHERE {notnull}" for c in cols)
    ne = "(n_ref * n_cur / (n_ref + n_cur))"
    lam = f"((sqrt({ne}) + {D(0.12)} + {D(0.11)} / sqrt({ne})) * ks)"
    series = "0 + " + " + ".join(f"({(-1) ** (k - 1)} * exp({D(-2.0 * k * k)} * ({lam} * {lam})))" for k in range(1, 101))
    return base + f""",
melt AS ({melt}),
hist AS (SELECT col, value, count_if(side = 'ref') AS nr, count_if(side = 'cur') AS nc FROM melt GROUP BY ALL),
e AS (SELECT *, sum(nr) OVER (PARTITION BY col) AS tot_r, sum(nc) OVER (PARTITION BY col) AS tot_c,
             sum(nr) OVER (PARTITION BY col ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               / sum(nr) OVER (PARTITION BY col) AS ecdf_r,
             sum(nc) OVER (PARTITION BY col ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               / sum(nc) OVER (PARTITION BY col) AS ecdf_c,
             coalesce(lead(value) OVER (PARTITION BY col ORDER BY value) - value, 0.0) AS gap FROM hist),
st AS (SELECT col, sum(abs(ecdf_r - ecdf_c) * gap) AS w1, max(abs(ecdf_r - ecdf_c)) AS ks,
              CAST(max(tot_r) AS BIGINT) AS n_ref, CAST(max(tot_c) AS BIGINT) AS n_cur FROM e GROUP BY col),
sd AS (SELECT col, greatest(stddev_pop(value), {D(0.001)}) AS ref_std FROM melt WHERE side = 'ref' GROUP BY col),
stats AS (SELECT st.col AS "column", w1, ks, n_ref, n_cur, ref_std, w1 / ref_std AS w1_norm,
                 CASE WHEN ks = 0 THEN 1.0 ELSE least(greatest(2 * ({series}), 0.0), 1.0) END AS ks_pvalue,
                 CASE WHEN n_ref > 1000 THEN 'wasserstein' ELSE 'ks' END AS test
          FROM st JOIN sd ON st.col = sd.col),
dr AS (SELECT *, CASE WHEN test = 'wasserstein' THEN w1_norm >= 0.1 ELSE ks_pvalue < 0.05 END AS drifted FROM stats)"""


def _drift_sql(gate: bool) -> str:
    base = _drift_core(FEAT_HOUR + """,
cs AS (SELECT CAST(CAST(max(hour) AS DATE) - 6 AS TIMESTAMP) AS t FROM feat),
sides AS (SELECT *, CASE WHEN hour < (SELECT t FROM cs) THEN 'ref' ELSE 'cur' END AS side FROM feat)""")
    if not gate:
        return base + """ SELECT "column", round(w1, 6) + 0.0 AS w1, round(ks, 6) + 0.0 AS ks, n_ref, n_cur,
  round(ref_std, 6) + 0.0 AS ref_std, round(w1_norm, 6) + 0.0 AS w1_norm, round(ks_pvalue, 6) + 0.0 AS ks_pvalue,
  test, drifted FROM dr"""
    return base + """ SELECT 'drift' AS gate, avg(CAST(drifted AS DOUBLE)) <= 0.5 AS passed,
  round(avg(CAST(drifted AS DOUBLE)), 6) + 0.0 AS drift_share, CAST(0.5 AS DOUBLE) AS max_drift_share,
  CAST(count(*) AS INTEGER) AS n_columns, list_sort(list("column")) AS columns, CAST(NULL AS VARCHAR) AS note FROM dr"""


ORACLES["drift_statistics"] = _drift_sql(False)
ORACLES["feature_product"] = ORACLES["feature_table"]
ORACLES["drift_from_days"] = ORACLES["drift_statistics"]
ORACLES["drift_gate"] = _drift_sql(True)


# ---------------------------------------------------------------- promotion (day grain, naive champion vs hist-mean)
_CHAMP = BT_DAY + """,
champ AS (SELECT CAST(CAST(min("window") || '-01' AS DATE) - 1 AS TIMESTAMP) AS through FROM wins),
allm AS (SELECT DISTINCT m AS "window" FROM f, lastb WHERE NOT (m = strftime(mx, '%Y-%m') AND mx < CAST(last_day(mx) AS TIMESTAMP))),
unseen AS (SELECT max("window") AS eval_month FROM allm
           WHERE CAST("window" || '-01' AS TIMESTAMP) > (SELECT through FROM champ))"""
ORACLES["unseen_full_month"] = _CHAMP + " SELECT eval_month FROM unseen"
ORACLES["promotion_decision"] = _CHAMP + """,
mm AS (SELECT predictor, avg(abs(trips - prediction)) AS mae FROM preds WHERE "window" = (SELECT eval_month FROM unseen)
       GROUP BY 1),
cur AS (SELECT mae FROM mm WHERE predictor = 'seasonal_naive'),
cand AS (SELECT mae FROM mm WHERE predictor = 'historical_mean')
SELECT CASE WHEN (SELECT mae FROM cand) <= (SELECT mae FROM cur) * 0.98 THEN 'promoted' ELSE 'kept' END AS status,
       (SELECT mae FROM cand) <= (SELECT mae FROM cur) * 0.98 AS promoted,
       (SELECT eval_month FROM unseen) AS eval_month,
       round((SELECT mae FROM cand), 4) + 0.0 AS mae_candidate, round((SELECT mae FROM cur), 4) + 0.0 AS mae_current,
       round((SELECT mae FROM cur) * 0.98, 4) + 0.0 AS required_candidate_mae, CAST(0.02 AS DOUBLE) AS min_improvement,
       'seasonal-naive-v1' AS current_version"""


# ---------------------------------------------------------------- sources and streaming
ORACLES["trip_csv_roundtrip"] = f"""WITH {EV_TRIPS} SELECT ride_id, rideable_type,
  date_trunc('second', started_at) AS started_at, date_trunc('second', ended_at) AS ended_at,
  start_station_name, start_station_id, end_station_name, end_station_id,
  start_lat, start_lng, end_lat, end_lng, member_casual FROM ev_trips"""
ORACLES["incremental_months"] = f"""WITH {OR_TRIPS}
SELECT DISTINCT strftime(started_at, '%Y-%m') AS month FROM or_trips
WHERE strftime(started_at, '%Y-%m') BETWEEN '1998-01' AND '2000-12'"""
ORACLES["payload_to_rows"] = "WITH " + EV_COV + f" SELECT timestamp, {_round_cols(_COV)} FROM ev_cov"
ORACLES["stream_hour_counts"] = EV_CLEAN_BASE + """ SELECT station_id, date_trunc('hour', started_at) AS hour,
  CAST(count(*) AS INTEGER) AS trips FROM ev_clean GROUP BY 1, 2"""

ORACLES["busiest_series_range"] = DAY_BASE + """,
top AS (SELECT station_id FROM (SELECT station_id, count(*) AS n FROM or_clean
        WHERE started_at >= (SELECT max(started_at) - INTERVAL 365 DAY FROM or_clean)
        GROUP BY 1 ORDER BY n DESC, station_id LIMIT 1))
SELECT station_id, min(hour) AS first_hour, max(hour) AS last_hour, CAST(sum(trips) AS BIGINT) AS total_trips,
       count(*) AS buckets FROM dg_grid WHERE station_id IN (SELECT station_id FROM top) GROUP BY 1"""
ORACLES["recent_partitions"] = SERVE + " SELECT DISTINCT as_of FROM store ORDER BY as_of DESC LIMIT 5"

_MON = _drift_core(FEAT_HOUR + SERVE[len(HOUR_BASE):] + """,
refs0 AS (SELECT least(CAST((SELECT min(as_of) FROM asof_days) AS TIMESTAMP) + INTERVAL 23 HOUR,
                       CAST((SELECT min(target_date) FROM daily) AS TIMESTAMP) - INTERVAL 1 HOUR) AS ref_end),
refs AS (SELECT ref_end - INTERVAL 1439 HOUR AS ref_start, ref_end FROM refs0),
sides AS (
  SELECT *, 'ref' AS side FROM feat WHERE hour BETWEEN (SELECT ref_start FROM refs) AND (SELECT ref_end FROM refs)
  UNION ALL
  SELECT *, 'cur' AS side FROM feat WHERE CAST(hour AS DATE) IN (SELECT target_date FROM daily))""")
ORACLES["monitoring_summary"] = _MON + f""",
perf AS (SELECT avg(mae) <= {_BASELINE} * (1 + 0.2) AS p FROM daily),
drg AS (SELECT avg(CAST(drifted AS DOUBLE)) <= 0.5 AS d FROM dr)
SELECT CASE WHEN NOT p THEN 'critical' WHEN NOT d THEN 'warning' ELSE 'ok' END AS status, p AND d AS passed,
       'seasonal-naive-v1' AS model_version, strftime(ref_start, '%Y-%m-%d %H:%M:%S') AS reference_start,
       strftime(ref_end, '%Y-%m-%d %H:%M:%S') AS reference_end, p AS performance_passed, d AS drift_passed
FROM perf, drg, refs"""

ORACLES["grid_trip_total"] = HOUR_BASE + """
SELECT CAST(sum(trips) AS BIGINT) AS grid_trips,
       (SELECT count(*) FROM ev_clean WHERE station_id IN (SELECT station_id FROM hg_scope)) AS clean_in_scope,
       CAST(sum(trips) AS BIGINT) = (SELECT count(*) FROM ev_clean WHERE station_id IN (SELECT station_id FROM hg_scope))
         AS conserved
FROM hg_grid"""

ORACLES["stream_ingest_trips"] = ORACLES["trip_csv_roundtrip"]
ORACLES["trip_zip_roundtrip"] = ORACLES["trip_csv_roundtrip"]

ORACLES["served_error_by_hour"] = SERVE + """ SELECT CAST(hour(hour) AS INTEGER) AS hour_of_day,
  round(avg(absolute_error), 6) + 0.0 AS mae, round(avg(actual), 6) + 0.0 AS avg_trips,
  round(avg(prediction - actual), 6) + 0.0 AS mean_bias, count(*) AS n FROM detail GROUP BY 1"""

ORACLES["backtest_hist_mean_16w"] = ORACLES["backtest_hist_mean"].replace("INTERVAL 56 DAY", "INTERVAL 112 DAY")
_G = DEFAULT.grain
ORACLES["leakage_gate"] = HOUR_BASE + f""",
cutp AS (SELECT CAST(CAST(max(hour) AS DATE) - 2 AS TIMESTAMP) + INTERVAL 23 HOUR AS cut FROM hg_grid),
spoiled AS (SELECT station_id, hour, CASE WHEN hour > cut THEN trips + 1000 ELSE trips END AS trips FROM hg_grid, cutp),
a AS (SELECT station_id, hour, {lag_cols(_G)} FROM hg_grid), b AS (SELECT station_id, hour, {lag_cols(_G)} FROM spoiled),
d AS (SELECT {" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _G.feature_names)} AS differs
      FROM a JOIN b USING (station_id, hour), cutp WHERE hour <= cut + INTERVAL 24 HOUR)
SELECT 'leakage' AS gate, count_if(differs) = 0 AS passed, count(*) AS checked_rows, CAST(count_if(differs) AS BIGINT) AS leaked_rows,
       CAST(24 AS INTEGER) AS min_lag, CAST(24 AS INTEGER) AS horizon FROM d"""
ORACLES["state_inference_features"] = ORACLES["inference_features"]
ORACLES["replay_summary"] = SERVE + f""" SELECT count(*) AS days, CAST(sum(n) AS BIGINT) AS n, round(avg(mae), 6) + 0.0 AS mean_mae,
  round({_BASELINE}, 6) + 0.0 AS reference_mae, round(avg(mae) - {_BASELINE}, 6) + 0.0 AS delta FROM daily"""
ORACLES["event_calendar_csv"] = """
SELECT p.event_name, count(*) AS orders
FROM orders, (VALUES (106, 107, 'Winter Fest'), (107, 109, 'Auto Show'), (115, 115, 'Parade'),
              (701, 704, 'Summer Fair'), (703, 705, 'Jazz Fest'), (910, 912, 'Air Show')) p(a, b, event_name)
WHERE month(o_orderdate) * 100 + day(o_orderdate) BETWEEN p.a AND p.b AND year(o_orderdate) BETWEEN 1995 AND 2024
GROUP BY 1"""
ORACLES["id_mapping_csv"] = """
WITH c AS (SELECT s_nationkey, min(s_suppkey) AS canon FROM supplier GROUP BY 1)
SELECT CAST(s_suppkey AS VARCHAR) AS raw_station_id, CAST(canon AS VARCHAR) AS canonical_station_id
FROM supplier JOIN c USING (s_nationkey) WHERE s_suppkey <> canon"""
ORACLES["current_model"] = _CHAMP + """,
mm AS (SELECT predictor, avg(abs(trips - prediction)) AS mae FROM preds WHERE "window" = (SELECT eval_month FROM unseen) GROUP BY 1),
two AS (SELECT (SELECT mae FROM mm WHERE predictor = 'seasonal_naive') AS sn, (SELECT mae FROM mm WHERE predictor = 'historical_mean') AS hm),
made AS (SELECT 1 AS number, hm <= sn * 0.98 AS promoted, 'historical-mean-v1' AS v FROM two
         UNION ALL SELECT 2, sn <= hm * 0.98, 'seasonal-naive-v2' FROM two)
SELECT CAST(number AS INTEGER) AS number, v AS new_version, 'models/' || v AS artifact_path, (SELECT eval_month FROM unseen) AS eval_month
FROM made WHERE promoted ORDER BY number DESC LIMIT 1"""
