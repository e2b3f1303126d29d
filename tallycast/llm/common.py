"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches for Python workers of at most ``BATCH_ROWS`` rows in this
    session: texts are long, and the default of 10,000 rows is made for numbers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back: cuts
    the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with underscores in front until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def is_held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id's text mod 4 is 2
    (a null id is held out as well)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def string_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every value of an Arrow string column (null: empty)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def running_totals(df: DataFrame, keys: list[str], order: Column, values: dict[str, Column], total_rows: int,
                   rows_per_bucket: int = 20_000) -> DataFrame:
    """Adds for every ``values`` item a column with its sum over the rows of the
    same ``keys`` (null is a key) that come before this row in ``order``, a
    64-bit hash that is uniform within every key. Rows with equal hashes must be
    interchangeable.

    The hash's top bits cut every key into buckets, so a key that holds a third
    of all rows is summed by many tasks; offsets come from a table with one row
    per key and bucket.
    """
    bits = min(40, (max(total_rows, 1) // rows_per_bucket).bit_length())
    bucket = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    cut = df.withColumns({"_order": order, "_bucket": bucket} | {f"_v_{k}": v for k, v in values.items()})
    per = cut.groupBy(*keys, "_bucket").agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in values])
    # buckets are non-negative, and rows of one bucket share the hash's sign, so signed order serves
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"),
                         *[F.coalesce(F.sum(f"_s_{k}").over(w), F.lit(0)).alias(f"_o_{k}") for k in values])
    inner = Window.partitionBy(*keys, "_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns({f"_l_{k}": F.coalesce(F.sum(f"_v_{k}").over(inner), F.lit(0)) for k in values})
    cond = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (local.join(offsets, cond, "inner")
            .withColumns({k: F.col(f"_l_{k}") + F.col(f"_o_{k}") for k in values})
            .select(*df.columns, *values))


def ordered_ranks(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds ``out``: 0, 1, 2 ... in ``order`` over the whole table. Rows are
    range-partitioned and numbered per partition; the offsets come from one row
    per partition. The ranges' table is written once, so the sampled bounds
    cannot differ between the two uses."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    parts = parts.withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    # one row per range partition is broadcast
    return (parts.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
            .withColumn(out, F.col("_row") + F.col("_offset")).drop("_at", "_part", "_row", "_p", "_offset"))
