"""Error analysis on a wide prediction table (model vs. naive)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import prefix_sums
from ..functions.calendar import iso_dow


def error_table(preds: DataFrame, model: str, naive: str = "pred_seasonal_naive") -> DataFrame:
    """Absolute errors of both predictors, model bias and improvement."""
    return (preds.withColumn("ae_model", F.abs(F.col("trips") - F.col(model)))
            .withColumn("ae_naive", F.abs(F.col("trips") - F.col(naive)))
            .withColumn("bias_model", F.col(model) - F.col("trips"))
            .withColumn("improvement", F.col("ae_naive") - F.col("ae_model")))


def overall_error(err: DataFrame) -> DataFrame:
    return (err.agg(F.avg("ae_model").alias("model_mae"), F.avg("ae_naive").alias("naive_mae"),
                    F.avg("improvement").alias("mae_reduction_vs_naive"), F.avg("bias_model").alias("mean_bias"),
                    F.count(F.lit(1)).alias("n"))
            .withColumn("pct_reduction", (1 - F.try_divide(F.col("model_mae"), F.col("naive_mae"))) * 100))


def error_slice(err: DataFrame, *keys: str | Column) -> DataFrame:
    """Same measures by one or more keys (a null key forms its own group)."""
    return (err.groupBy(*keys).agg(
        F.avg("ae_model").alias("mae_model"), F.avg("ae_naive").alias("mae_naive"),
        F.avg("improvement").alias("mae_reduction"), F.avg("trips").alias("avg_trips"),
        F.sum("trips").cast("bigint").alias("total_trips"), F.count(F.lit(1)).alias("n"))
        .withColumn("pct_reduction_vs_naive", 1 - F.try_divide(F.col("mae_model"), F.col("mae_naive"))))


def by_hour(err: DataFrame) -> DataFrame:
    return error_slice(err, F.hour("hour").cast("int").alias("hour_of_day"))


def by_weekend(err: DataFrame) -> DataFrame:
    return error_slice(err, (iso_dow(F.col("hour")) >= 6).alias("is_weekend"))


def by_day(err: DataFrame) -> DataFrame:
    return error_slice(err, F.to_date("hour").alias("date"))


def by_series(err: DataFrame, master: DataFrame | None = None) -> DataFrame:
    out = error_slice(err, "station_id")
    if master is not None:
        out = out.join(master.select("station_id", "name", "lat", "lng"), "station_id", "left")
    return out


def by_rain(err: DataFrame, covariates: DataFrame, threshold: float = 0.5) -> DataFrame:
    w = covariates.select(F.col("timestamp").alias("hour"), "precipitation")
    j = err.join(w, "hour", "left")
    return error_slice(j, (F.col("precipitation") > threshold).alias("rainy"))


def nearest_rank_quantile(df: DataFrame, col: str, q: float) -> Column:
    """Exact 'nearest' quantile (value at sorted index round((n-1)q)) as a
    scalar subquery, from distributed prefix sums of the distinct values'
    counts: no task holds all values, whatever their number."""
    hist = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = prefix_sums(hist, [], "value", ["n"])
    return ranked.where(F.col("n_upto") > F.round((F.col("n_total") - 1) * q)).agg(F.min("value")).scalar()


def peak_bias(err: DataFrame, model: str, q: float = 0.95) -> DataFrame:
    thr = nearest_rank_quantile(err, "trips", q)
    return (err.groupBy((F.col("trips") >= thr).alias("top_demand")).agg(
        F.avg("trips").alias("avg_actual"), F.avg(model).alias("avg_pred"), F.avg("bias_model").alias("mean_bias"),
        F.avg("ae_model").alias("mae_model"), F.count(F.lit(1)).alias("n"))
        .withColumn("threshold", thr.cast("double")))


def worst_k(slice_df: DataFrame, by: str, k: int, ascending: bool = False, tie: str | None = None) -> DataFrame:
    order = F.asc(by) if ascending else F.desc(by)
    cols = [order] + ([F.asc(tie)] if tie else [])
    return slice_df.orderBy(*cols).limit(k)
