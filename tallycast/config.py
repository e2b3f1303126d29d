"""Pipeline configuration.

Fixed values: the defaults, feature names and covariate names below are the
published pipeline settings that results must match.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Grain:
    """Time grain of a series grid.

    ``unit`` is the bucket unit, ``season`` the number of buckets in one
    seasonal cycle (hour-of-day at hour grain, day-of-week at day grain) and
    ``week`` the number of buckets in a week. Lags are in buckets and must be
    multiples of ``season`` so that lags and same-phase rolling means share one
    window partitioning ``(key, phase)``.
    """

    unit: str
    season: int
    week: int
    lags: tuple[int, ...]
    rolling: tuple[int, ...]
    horizon: int
    phase_col: str
    roll_suffix: str

    @property
    def interval(self) -> str:
        return f"INTERVAL 1 {self.unit.upper()}"

    def lag_name(self, h: int) -> str:
        return f"lag_{h}"

    def roll_name(self, k: int) -> str:
        return f"roll_mean_{k}{self.roll_suffix}"

    @property
    def feature_names(self) -> list[str]:
        return [self.lag_name(h) for h in self.lags] + [self.roll_name(k) for k in self.rolling]

    @property
    def naive_lag(self) -> str:
        return self.lag_name(self.week)

    @property
    def needed_history(self) -> int:
        return max(max(self.lags), max(self.rolling) * self.season)


HOUR = Grain("hour", 24, 168, (24, 48, 168), (7, 28), 24, "hour_of_day", "d")
DAY = Grain("day", 7, 7, (7, 14, 28), (4, 8), 7, "day_of_week", "w")

COVARIATES = (
    "temperature_2m",
    "precipitation",
    "snowfall",
    "wind_speed_10m",
    "relative_humidity_2m",
)

CALENDAR_FEATURES = (
    "hour_of_day", "day_of_week", "month", "is_weekend", "is_holiday",
    "hour_sin", "hour_cos", "month_sin", "month_cos",
)

DRIFT_COLUMNS = (
    "temperature_2m", "precipitation", "wind_speed_10m", "lag_24", "lag_168", "roll_mean_7d",
)


@dataclass(frozen=True)
class Config:
    start_month: str = "2023-07"
    end_month: str = "2026-06"
    top_n: int = 200
    scope_lookback_days: int = 365
    min_trip_seconds: int = 60
    max_trip_hours: int = 24
    n_windows: int = 4
    min_covariate_match: float = 0.95
    grain: Grain = HOUR
    covariates: tuple[str, ...] = COVARIATES
    model_params: dict = field(default_factory=lambda: {"max_iter": 50, "max_depth": 6, "step_size": 0.1})
    tree_params: dict = field(default_factory=lambda: {"n_estimators": 2000, "learning_rate": 0.05, "num_leaves": 63})
    sweep_estimators: int = 500  # cap of trees of a sweep's fits; a fit stops early as any other
    min_improvement: float = 0.02

    def params_of(self, kind: str) -> dict:
        return self.tree_params if kind == "poisson_trees" else self.model_params

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)

    @property
    def model_features(self) -> list[str]:
        return list(CALENDAR_FEATURES) + list(self.covariates) + ["lat", "lng", "station_id"] + self.grain.feature_names


DEFAULT = Config()
DAILY = Config(grain=DAY, min_trip_seconds=86_400, max_trip_hours=24 * 90)
