"""Near-duplicate series keys: distance join through grid bins, duplicate
edges, mapping dedupe and chain flattening, mapping guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.exprs import materialize
from ..functions.geo import haversine_m, normalize_name


# Fixed value: metres per degree of latitude used to size the grid cells
# (slightly below the true minimum of ~110.57 km so cells are never too small).
M_PER_DEG = 110_000.0


CELL_ROWS = 2000  # rows of a cell that one join key takes from either side


def near_pairs(stations: DataFrame, max_m: float = 30.0, key: str = "station_id",
               name: str = "station_name", cell_rows: int = CELL_ROWS) -> DataFrame:
    """Unordered pairs (id_a < id_b) closer than ``max_m`` metres.

    Candidate pruning is an equi-join on grid cells after exploding each point
    into its 3 x 3 neighbour cells on one side, so no nested-loop join is
    planned. Cells are sized from ``max_m`` itself (longitude cells widened by
    the largest |latitude| present), so candidates are a constant factor
    (~3x) of the true pairs instead of every pair in a coarse bin. A cell with
    more than ``cell_rows`` points is cut into parts by a hash, and every part
    meets every part of its neighbours under a key of its own: no key gets more
    than about ``cell_rows`` rows from one cell, wherever the points lie."""
    s0 = stations.where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    cell_lat = max_m / M_PER_DEG
    max_abs_lat = s0.agg(F.max(F.abs("lat"))).scalar()
    cell_lng = F.lit(max_m / M_PER_DEG) / F.cos(F.radians(F.least(max_abs_lat, F.lit(89.0))))
    cell = ["lat_bin", "lng_bin"]
    s = s0.select(F.col(key).alias("id"), F.col(name).alias("name"), "lat", "lng", "total_trips",
                  F.floor(F.col("lat") / cell_lat).alias("lat_bin"), F.floor(F.col("lng") / cell_lng).alias("lng_bin"))
    offsets = F.explode(F.array(*[F.struct(F.lit(a).alias("dl"), F.lit(b).alias("dg")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    moved = [(F.col("lat_bin") + F.col("o.dl")).alias("lat_bin"), (F.col("lng_bin") + F.col("o.dg")).alias("lng_bin")]

    hot = materialize(s.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("parts")).where("parts > 1"), "table")
    beside = hot.select("*", offsets.alias("o")).select(*moved, "parts").groupBy(*cell).agg(F.max("parts").alias("parts_b"))

    def parts(side: DataFrame, table: DataFrame, column: str) -> DataFrame:
        return side.join(table.withColumnRenamed("parts", column), cell, "left").withColumn(column, F.coalesce(column, F.lit(1)))

    def part(n: str):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    points = ("id", "name", "lat", "lng", "total_trips")
    own = parts(s, hot, "parts_own")
    b = own.select("*", part("parts_own").alias("j"), offsets.alias("o")).select(*[F.col(c).alias(f"{c}_b") for c in points], "j", *moved)
    b = parts(b, hot, "parts_a").select("*", every("parts_a").alias("i"))
    a = parts(own, beside, "parts_b").select(*[F.col(c).alias(f"{c}_a") for c in points], part("parts_own").alias("i"), every("parts_b").alias("j"), *cell)
    j = a.join(b, [*cell, "i", "j"]).where(F.col("id_a") < F.col("id_b"))
    d = haversine_m(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"))
    return (j.withColumn("dist", d).where(F.col("dist") < max_m)
            .select("id_a", "name_a", F.col("total_trips_a").alias("trips_a"), "id_b", "name_b",
                    F.col("total_trips_b").alias("trips_b"), F.round("dist", 1).alias("dist_m")))


def duplicate_edges(pairs: DataFrame) -> DataFrame:
    """Pairs with equal normalised names -> edge lower-volume id -> higher
    (tie: b -> a), then one edge per raw id (highest canonical volume, then
    smallest canonical id)."""
    same = pairs.where(normalize_name(F.col("name_a")) == normalize_name(F.col("name_b")))
    a_wins = F.col("trips_a") >= F.col("trips_b")
    e = same.select(F.when(a_wins, F.col("id_b")).otherwise(F.col("id_a")).alias("raw_station_id"),
                    F.when(a_wins, F.col("id_a")).otherwise(F.col("id_b")).alias("canonical_station_id"),
                    F.greatest("trips_a", "trips_b").alias("canonical_trips"))
    w = Window.partitionBy("raw_station_id").orderBy(F.desc("canonical_trips"), F.asc("canonical_station_id"))
    return e.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def flatten_mapping(edges: DataFrame) -> DataFrame:
    """Pointer jumping: replace every target that is itself mapped by its target
    until nothing changes. Chains halve with each round (one self join, lineage
    cut in the shared folder), so a mapping of n rows is flat after log2(n) + 2
    rounds unless it has a cycle, which is an error."""
    m = materialize(edges.select("raw_station_id", "canonical_station_id"), "table")
    rounds = m.count().bit_length() + 2
    for _ in range(rounds):
        nxt = m.select(F.col("raw_station_id").alias("_r"), F.col("canonical_station_id").alias("_c"))
        step = (m.join(nxt, m["canonical_station_id"] == nxt["_r"], "left")
                .select("raw_station_id", F.coalesce("_c", "canonical_station_id").alias("canonical_station_id"),
                        F.col("_c").isNotNull().alias("_moved")))
        step = materialize(step, "table")
        m = step.drop("_moved")
        if step.where("_moved").isEmpty():
            return m
    raise ValueError("the mapping has a cycle and cannot be flattened")


def mapping_guards(mapping: DataFrame) -> DataFrame:
    """Rows, duplicate raw ids, remaining chains and self maps (all must be 0)."""
    raws = mapping.select(F.col("raw_station_id").alias("_r")).distinct()
    chains = mapping.join(raws, mapping["canonical_station_id"] == raws["_r"], "left_semi").select(F.count(F.lit(1))).scalar()
    return (mapping.agg(F.count(F.lit(1)).alias("rows"),
                        (F.count(F.lit(1)) - F.count_distinct("raw_station_id")).alias("duplicate_raw_ids"),
                        F.count_if(F.col("raw_station_id") == F.col("canonical_station_id")).alias("self_maps"),
                        F.count_distinct("canonical_station_id").alias("targets"))
            .withColumn("chains", chains)
            .withColumn("passed", (F.col("duplicate_raw_ids") == 0) & (F.col("chains") == 0) & (F.col("self_maps") == 0)))
