"""Table contracts and schema assertions."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the contracts, which results must match.
S, D, TS, I, L, B, DT = (T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.IntegerType(),
                         T.LongType(), T.BooleanType(), T.DateType())


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Raw trips: exact column list and order (timestamps are strings on disk).
TRIP_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at",
    "start_station_name", "start_station_id", "end_station_name", "end_station_id",
    "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
]
TRIPS_CSV = _st(("ride_id", S), ("rideable_type", S), ("started_at", S), ("ended_at", S),
                ("start_station_name", S), ("start_station_id", S), ("end_station_name", S),
                ("end_station_id", S), ("start_lat", D), ("start_lng", D), ("end_lat", D),
                ("end_lng", D), ("member_casual", S))
TRIPS = _st(*[(f.name, TS if f.name in ("started_at", "ended_at") else f.dataType) for f in TRIPS_CSV.fields])

WEATHER_COLUMNS = ["timestamp", "temperature_2m", "precipitation", "snowfall",
                   "wind_speed_10m", "relative_humidity_2m"]
WEATHER = _st(("timestamp", TS), *[(c, D) for c in WEATHER_COLUMNS[1:]])

MAPPING = _st(("raw_station_id", S), ("canonical_station_id", S))
EVENT_CALENDAR = _st(("start_date", DT), ("end_date", DT), ("event_name", S))
GRID = _st(("station_id", S), ("hour", TS), ("trips", I))
STATION_MASTER = _st(("station_id", S), ("name", S), ("lat", D), ("lng", D), ("total_trips", L),
                     ("first_month", S), ("last_month", S))
STATION_MONTH_PANEL = _st(("station_id", S), ("month", S), ("member_trips", I), ("casual_trips", I),
                          ("total_trips", I))
FORECAST_STORE = _st(("as_of", DT), ("station_id", S), ("hour", TS), ("prediction", D),
                     ("model_version", S), ("created_at", S))
DAILY_ACCURACY = _st(("as_of", DT), ("target_date", DT), ("mae", D), ("n", L))
BACKTEST_ROWS = _st(("predictor", S), ("window", S), ("mae", D), ("rmse", D), ("n", L))
BACKTEST_SUMMARY = _st(("predictor", S), ("mae_mean", D), ("mae_std", D), ("rmse_mean", D), ("mase_mean", D))


class SchemaError(ValueError):
    pass


def check_columns(columns: list[str], expected: list[str], source: str, ordered: bool = True) -> None:
    """Exact column equality (order included) else an error naming missing/extra columns."""
    if list(columns) == list(expected) or (not ordered and set(columns) == set(expected)):
        return
    missing = [c for c in expected if c not in columns]
    extra = [c for c in columns if c not in expected]
    raise SchemaError(
        f"{source}: schema mismatch; missing={missing} extra={extra} "
        f"(order {'differs' if not missing and not extra else 'n/a'})")
