"""Calendar expressions: parts, ISO weekday, cyclic encodings, holidays, month bounds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The holiday calendar we publish (US federal + Illinois).
#   fixed dates (month, day): New Year 1 Jan; Lincoln's Birthday 12 Feb;
#   Juneteenth 19 Jun (from 2021); Independence Day 4 Jul; Veterans Day 11 Nov;
#   Christmas 25 Dec. A fixed date on a Saturday is also observed on the
#   Friday before, on a Sunday also on the Monday after.
#   n-th weekday rules (month, ISO weekday, first day, last day of the window):
#   Martin Luther King Jr. Day 3rd Monday of January; Washington's Birthday
#   3rd Monday of February; Casimir Pulaski Day 1st Monday of March; Memorial
#   Day last Monday of May; Labor Day 1st Monday of September; Columbus Day
#   2nd Monday of October; Thanksgiving 4th Thursday of November.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1, None),
    ("Lincoln's Birthday", 2, 12, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
]
WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 1, 15, 21),
    ("Washington's Birthday", 2, 1, 15, 21),
    ("Casimir Pulaski Day", 3, 1, 1, 7),
    ("Memorial Day", 5, 1, 25, 31),
    ("Labor Day", 9, 1, 1, 7),
    ("Columbus Day", 10, 1, 8, 14),
    ("Thanksgiving", 11, 4, 22, 28),
]


def iso_dow(c: Column) -> Column:
    """ISO weekday, Monday = 1 ... Sunday = 7 (``dayofweek`` would give Sunday = 1)."""
    return (F.weekday(c) + 1).cast("int")


def _fixed_match(d: Column, month: int, day: int, since: int | None) -> Column:
    cond = (F.month(d) == month) & (F.dayofmonth(d) == day)
    if since is not None:
        cond = cond & (F.year(d) >= since)
    return cond


def holiday_name(date_col: Column) -> Column:
    """Name of the holiday on a DATE (null if none); pure expression, no join."""
    d = date_col
    branches = []
    for name, m, day, since in FIXED_HOLIDAYS:
        branches.append((_fixed_match(d, m, day, since), F.lit(name)))
    for name, m, dow, lo, hi in WEEKDAY_HOLIDAYS:
        branches.append(((F.month(d) == m) & (iso_dow(d) == dow) & F.dayofmonth(d).between(lo, hi), F.lit(name)))
    for name, m, day, since in FIXED_HOLIDAYS:
        nxt, prv = F.date_add(d, 1), F.date_sub(d, 1)
        branches.append(((iso_dow(d) == 5) & _fixed_match(nxt, m, day, since), F.lit(f"{name} (observed)")))
        branches.append(((iso_dow(d) == 1) & _fixed_match(prv, m, day, since), F.lit(f"{name} (observed)")))
    expr = None
    for cond, val in branches:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def _is_fixed(d: Column) -> Column:
    md = F.date_format(d, "MM-dd")
    always = [f"{m:02d}-{day:02d}" for _, m, day, since in FIXED_HOLIDAYS if since is None]
    cond = md.isin(*always)
    for _, m, day, since in FIXED_HOLIDAYS:
        if since is not None:
            cond = cond | ((md == f"{m:02d}-{day:02d}") & (F.year(d) >= since))
    return cond


def is_holiday(date_col: Column) -> Column:
    """Holiday flag as a compact expression (same calendar as ``holiday_name``):
    fixed dates, their Friday/Monday observances, and n-th weekday rules as a
    (month/weekday/week-of-month) key lookup. Kept small because it is part of
    every feature plan."""
    d = date_col
    dow = iso_dow(d)
    nth_keys = [f"{m}/{w}/{(lo + 6) // 7}" for _, m, w, lo, hi in WEEKDAY_HOLIDAYS if hi - lo == 6 and lo % 7 == 1]
    key = F.concat_ws("/", F.month(d).cast("string"), dow.cast("string"),
                      F.ceil(F.dayofmonth(d) / 7).cast("string"))
    last = [(m, w, lo) for _, m, w, lo, hi in WEEKDAY_HOLIDAYS if not (hi - lo == 6 and lo % 7 == 1)]
    cond = _is_fixed(d) | key.isin(*nth_keys)
    for m, w, lo in last:
        cond = cond | ((F.month(d) == m) & (dow == w) & (F.dayofmonth(d) >= lo))
    cond = cond | ((dow == 5) & _is_fixed(F.date_add(d, 1))) | ((dow == 1) & _is_fixed(F.date_sub(d, 1)))
    return cond


def holiday_calendar(spark: SparkSession, first_year: Column | int, last_year: Column | int) -> DataFrame:
    """One row per holiday date in [first_year, last_year] (years may be scalar subqueries)."""
    fy = F.lit(first_year) if isinstance(first_year, int) else first_year
    ly = F.lit(last_year) if isinstance(last_year, int) else last_year
    days = spark.range(1).select(
        F.explode(F.sequence(F.make_date(fy, F.lit(1), F.lit(1)), F.make_date(ly, F.lit(12), F.lit(31)))).alias("date"))
    return (days.select("date", holiday_name(F.col("date")).alias("holiday"))
            .where(F.col("holiday").isNotNull()))


def phase_expr(unit: str, ts: str = "hour") -> tuple[str, Column]:
    """Seasonal phase of a bucket: hour of day (hour grain) or ISO weekday (day grain)."""
    if unit == "hour":
        return "hour_of_day", F.hour(F.col(ts)).cast("int")
    return "day_of_week", iso_dow(F.col(ts))


def calendar_features(df: DataFrame, ts: str = "hour") -> DataFrame:
    """Target-free time features; column names follow the feature contract.
    One projection (not nine ``withColumn`` calls) keeps analysis cheap; a
    phase column already carried by the grid is reused, not recomputed."""
    two_pi = 2 * math.pi
    t = F.col(ts)
    hod = F.hour(t).cast("int")
    dow = iso_dow(t)
    mon = F.month(t).cast("int")
    cols = [hod.alias("hour_of_day"), dow.alias("day_of_week"), mon.alias("month"),
            (dow >= 6).alias("is_weekend"), is_holiday(F.to_date(t)).alias("is_holiday"),
            F.sin(hod * two_pi / 24).alias("hour_sin"), F.cos(hod * two_pi / 24).alias("hour_cos"),
            F.sin(mon * two_pi / 12).alias("month_sin"), F.cos(mon * two_pi / 12).alias("month_cos")]
    names = ["hour_of_day", "day_of_week", "month", "is_weekend", "is_holiday",
             "hour_sin", "hour_cos", "month_sin", "month_cos"]
    return df.select("*", *[c for c, n in zip(cols, names) if n not in df.columns])


def month_bounds(month: Column) -> tuple[Column, Column]:
    """First and last day of the month of a DATE/TIMESTAMP (leap years included)."""
    return F.trunc(month, "month"), F.last_day(month)


def last_bucket_of_month(ts: Column, unit: str) -> Column:
    """Last bucket start in the month of ``ts``: 23:00 of the last day (hour grain)
    or the last day itself (day grain)."""
    last_day = F.last_day(ts).cast("timestamp_ntz")
    if unit == "hour":
        return F.timestamp_add("HOUR", F.lit(23), last_day)
    return last_day
