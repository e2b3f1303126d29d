"""Feature drift between a reference and a current frame.

Per column: Wasserstein-1 distance normalised by the reference's population
standard deviation (floored at 0.001), and the two-sample Kolmogorov-Smirnov
statistic with its asymptotic p-value. A column drifts when the reference has
more than ``large_n`` rows and normalised W1 >= 0.1, or otherwise when the
K-S p-value < 0.05. Everything runs on the per-(column, value) histogram:
values are melted, counted per side, and ECDFs are distributed prefix sums, so
no column is held in one task. The counts may also come from histograms stored
day by day, so that a reference of sixty days is a merge and not a scan.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DRIFT_COLUMNS
from ..functions.exprs import materialize, prefix_sums
from ..sources.commits import commit, records_by_folder


def usable_columns(reference: DataFrame, current: DataFrame, columns=DRIFT_COLUMNS, eps: float = 1e-9) -> list[str]:
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    if not shared:
        return []
    row = reference.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in shared]).first()
    return [c for c in shared if row[c] is not None and row[c] > eps]


def _melt(df: DataFrame, cols: list[str], *keep: str) -> DataFrame:
    complete = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    return complete.select(*keep, F.explode(arr).alias("kv")).select(*keep, "kv.column", "kv.value")


# ---------------------------------------------------------------- daily histograms
def record_days(features: DataFrame, path: str, days: list[dt.date], columns=DRIFT_COLUMNS, ts: str = "hour") -> list[dt.date]:
    """Counts (day, column, value, n) of the complete rows of the given days,
    staged in one write and then committed day by day; days that have a commit
    are not counted again. Returns the days counted now."""
    spark = features.sparkSession
    known = records_by_folder(spark, f"{path}/commits/day=*")
    new = [d for d in days if f"day={d.isoformat()}" not in known]
    if not new:
        return []
    rows = features.where((F.col(ts) >= F.lit(dt.datetime.combine(min(new), dt.time()))) & (F.col(ts) < F.lit(dt.datetime.combine(max(new), dt.time()) + dt.timedelta(days=1))))
    counts = (_melt(rows.withColumn("day", F.to_date(ts)).where(F.col("day").isin(new)), list(columns), "day")
              .groupBy("day", "column", "value").agg(F.count("*").alias("n")))
    attempt = uuid.uuid4().hex
    counts.write.partitionBy("day").parquet(f"{path}/data/{attempt}")
    return [d for d in new if commit(spark, f"{path}/commits/day={d.isoformat()}", 1, {"attempt": attempt, "columns": list(columns)})]


def merged_days(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    """(column, value, n) over the days from ``first`` to ``last``, both
    inclusive; a day without a commit is an error."""
    known = {k.split("=", 1)[1]: v[0][1]["attempt"] for k, v in records_by_folder(spark, f"{path}/commits/day=*").items()}
    days = [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    missing = [d for d in days if d not in known]
    if missing:
        raise ValueError(f"no histogram of {missing[:5]}")
    by_attempt: dict[str, list[str]] = {}
    for d in days:
        by_attempt.setdefault(known[d], []).append(d)
    out = None
    for attempt, some in by_attempt.items():
        # a day without complete rows has a commit and no file
        part = spark.read.schema("column string, value double, n long, day date").parquet(f"{path}/data/{attempt}").where(F.col("day").isin([dt.date.fromisoformat(d) for d in some]))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("column", "value").agg(F.sum("n").alias("n"))


def drift_of_days(spark: SparkSession, path: str, reference: tuple[dt.date, dt.date], current: tuple[dt.date, dt.date], **limits) -> DataFrame:
    """``drift_statistics`` of two spans of days from the stored histograms,
    without reading the features again; constant reference columns are left out."""
    ref, cur = (merged_days(spark, path, *span) for span in (reference, current))
    both = ref.select("column", "value", F.col("n").alias("nr"), F.lit(0).cast("long").alias("nc")).unionByName(
        cur.select("column", "value", F.lit(0).cast("long").alias("nr"), F.col("n").alias("nc")))
    hist = materialize(both.groupBy("column", "value").agg(F.sum("nr").alias("nr"), F.sum("nc").alias("nc")), "table")
    varied = hist.where("nr > 0").groupBy("column").agg(F.count("*").alias("_k")).where("_k > 1").select("column")
    return statistics_of(hist.join(varied, "column", "left_semi"), **limits)


def drift_statistics(reference: DataFrame, current: DataFrame, cols: list[str], large_n: int = 1000,
                     w1_threshold: float = 0.1, p_threshold: float = 0.05) -> DataFrame:
    """Per column: normalised Wasserstein-1 and two-sample Kolmogorov-Smirnov,
    exact for any number of distinct values: both sides' values are counted
    once and their running shares come from distributed prefix sums. A side
    without complete rows is an error."""
    both = _melt(reference, cols).withColumn("side", F.lit("ref")).unionByName(_melt(current, cols).withColumn("side", F.lit("cur")))
    return statistics_of(both.groupBy("column", "value").agg(F.count_if(F.col("side") == "ref").alias("nr"),
                                                             F.count_if(F.col("side") == "cur").alias("nc")), large_n, w1_threshold, p_threshold)


def statistics_of(hist: DataFrame, large_n: int = 1000, w1_threshold: float = 0.1, p_threshold: float = 0.05) -> DataFrame:
    """The statistics of ``drift_statistics`` from counts (column, value, nr, nc)
    of the reference and the current side, however they were made."""
    hist = materialize(hist, "table")
    e = prefix_sums(hist, ["column"], "value", ["nr", "nc"])
    gap = F.abs(F.try_divide("nr_upto", "nr_total") - F.try_divide("nc_upto", "nc_total"))
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    weight = F.col("nr").cast("double")
    s = e.groupBy("column").agg(
        F.sum(gap * step).alias("w1"), F.max(gap).alias("ks"), F.max("nr_total").alias("n_ref"), F.max("nc_total").alias("n_cur"),
        F.sum(weight * F.col("value")).alias("_sum"))
    mean = s.select(F.col("column").alias("_c"), F.try_divide("_sum", "n_ref").alias("_mean"))
    # deviations from the mean, not a difference of large sums
    std = (hist.join(mean, F.col("column") == F.col("_c")).groupBy("column")
           .agg(F.greatest(F.sqrt(F.try_divide(F.sum(weight * F.pow(F.col("value") - F.col("_mean"), 2)), F.sum("nr"))), F.lit(0.001)).alias("ref_std")))
    s = materialize(s.drop("_sum").join(std, "column"), "table")
    empty = s.agg(F.min("n_ref"), F.min("n_cur")).first()
    if not empty[0] or not empty[1]:
        raise ValueError(f"drift needs complete rows on both sides; reference has {empty[0] or 0}, current has {empty[1] or 0}")
    ne = F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    # lambda is materialised as a column first: the 100-term series then refers
    # to it instead of repeating the whole expression (keeps codegen small)
    s = s.withColumn("_lam", (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(ne)) * F.col("ks"))
    lam2 = F.col("_lam") * F.col("_lam")
    series = sum(((-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam2) for k in range(1, 101))
    p = F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0))
    return (s.withColumn("w1_norm", F.col("w1") / F.col("ref_std"))
            .withColumn("ks_pvalue", F.when(F.col("ks") == 0, F.lit(1.0)).otherwise(p))
            .drop("_lam")
            .withColumn("test", F.when(F.col("n_ref") > large_n, F.lit("wasserstein")).otherwise(F.lit("ks")))
            .withColumn("drifted", F.when(F.col("test") == "wasserstein", F.col("w1_norm") >= w1_threshold)
                        .otherwise(F.col("ks_pvalue") < p_threshold)))


def drift_gate(reference: DataFrame, current: DataFrame, max_share: float = 0.5, columns=DRIFT_COLUMNS) -> DataFrame:
    """One row: drift share = drifted / usable columns, passed when <= max_share."""
    if not 0 <= max_share <= 1:
        raise ValueError("max_share must be between 0 and 1")
    spark = reference.sparkSession
    cols = usable_columns(reference, current, columns)
    if not cols:
        return spark.createDataFrame([("drift", True, 0.0, max_share, 0, [], "no shared non-constant columns")],
                                     "gate string, passed boolean, drift_share double, max_drift_share double, "
                                     "n_columns int, columns array<string>, note string")
    stats = drift_statistics(reference, current, cols)
    return (stats.agg(F.avg(F.col("drifted").cast("double")).alias("drift_share"),
                      F.count(F.lit(1)).cast("int").alias("n_columns"),
                      F.sort_array(F.collect_list("column")).alias("columns"))
            .select(F.lit("drift").alias("gate"), (F.col("drift_share") <= max_share).alias("passed"),
                    "drift_share", F.lit(float(max_share)).alias("max_drift_share"), "n_columns", "columns",
                    F.lit(None).cast("string").alias("note")))
