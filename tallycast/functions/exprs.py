"""Generic column expressions and small plan helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def all_of(conds) -> Column:
    """Horizontal AND (Kleene: a null predicate drops the row in a filter)."""
    return reduce(lambda a, b: a & b, list(conds))


def hsum(cols) -> Column:
    return reduce(lambda a, b: a + b, list(cols))


def duration_seconds(start: str = "started_at", end: str = "ended_at") -> Column:
    """Whole seconds between two timestamps, truncated toward zero (may be negative)."""
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def bucket(col: str | Column, unit: str) -> Column:
    """Truncate a naive timestamp to ``unit`` and keep it naive."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def month_str(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM")


def round6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (used once, after the last aggregation)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (a limit, a
    config-sized list, a one-row aggregate)."""
    return F.broadcast(df)


def materialize(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """Materialise a reused intermediate.

    ``checkpoint``: reliable checkpoint into the session's shared
    ``spark.checkpoint.dir`` - cuts lineage (iterative loops, tables that are
    rewritten in place); never a local checkpoint.
    ``table``: written once as Parquet to the same shared folder and read back -
    data products that many plans reuse: short plans, columnar, pruned reads.
    """
    import uuid

    from ..session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(df.sparkSession)
    if mode == "table":
        path = f"{base.rstrip('/')}/tallycast-table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return df.checkpoint(eager=True)


def discard(df: DataFrame) -> None:
    """Deletes a ``table`` of ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("tallycast-table-"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def prefix_sums(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Adds, per key and in ``order``, ``<value>_upto`` (running sum including the
    row), ``<value>_total`` and ``next_<order>`` (null on the last row).

    Rows are range-partitioned by (keys, order), so one key's rows may lie in
    many partitions; local sums are completed from a table with one row per key
    and partition. ``order`` must be unique within a key.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cols = [F.col(k) for k in [*keys, order]]
    # written once: the sampled range bounds must be the same for both uses
    parts = materialize(df.repartitionByRange(n, *cols).withColumn("_part", F.spark_partition_id()), "table")
    per = parts.groupBy(*keys, "_part").agg(F.min(order).alias("_first"), *[F.sum(v).alias(f"_s_{v}") for v in values])
    by = Window.partitionBy(*keys)
    run = by.orderBy("_part")
    before = run.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                         F.lead("_first").over(run).alias("_follows"),
                         *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
                         *[F.sum(f"_s_{v}").over(by).alias(f"{v}_total") for v in values])
    w = Window.partitionBy(*keys, "_part").orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    local = parts.withColumns({f"_l_{v}": F.sum(v).over(upto) for v in values} | {"_next": F.lead(order).over(w)})
    cond = all_of([F.col("_part") == F.col("_p")] + [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return (local.join(offsets, cond)
            .withColumns({f"{v}_upto": F.col(f"_l_{v}") + F.col(f"_o_{v}") for v in values}
                         | {f"next_{order}": F.coalesce("_next", "_follows")})
            .select(*df.columns, *[f"{v}_upto" for v in values], *[f"{v}_total" for v in values], f"next_{order}"))
