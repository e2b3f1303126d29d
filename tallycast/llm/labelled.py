"""A bounded sample of labelled documents for fitting a classifier."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, stored

CLASS_BYTES = 64 << 20


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, class_bytes: int = CLASS_BYTES) -> tuple[list, np.ndarray, float]:
    """(texts as strings, 0/1 labels, share of label 1 among all learnable labels).

    Of each class the ``per_class`` rows whose id hashes lowest are taken, from
    rows that are not held out, and of these, in the same order, as many as fit
    into ``class_bytes`` of text (a longer one is left out); an id that documents
    repeat gives the text that hashes lowest. The bounds make the fit's cost
    independent of the corpus. Rows without an id or a 0/1 label are not learnable; null texts
    count as empty. The share counts every learnable label.
    """
    known = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
             .filter(F.col("_y").isin(0, 1) & ~is_held_out(F.col("_id"))))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    share = (n1 + 1) / (n0 + n1 + 2)
    order = [F.xxhash64(F.col("_id").cast("string"), F.lit(label)), F.col("_id")]
    picked = None
    for y in (0, 1):
        part = known.filter(F.col("_y") == y).orderBy(*order).limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    # at most 2 * per_class ids are broadcast, and as many texts are written
    own = stored(texts.join(F.broadcast(picked), "_id").groupBy("_id", "_y").agg(F.min(F.struct(F.xxhash64("_t").alias("h"), "_t")).alias("s"))
                 .select("_id", "_y", F.col("s._t").alias("_t")), "sample")
    room, fits = {0: class_bytes, 1: class_bytes}, []
    for r in own.select("_id", "_y", F.octet_length("_t").alias("n"), order[0].alias("h")).orderBy("h", "_id", "_y").collect():
        if r["n"] <= room[r["_y"]]:
            room[r["_y"]] -= r["n"]
            fits.append((r["_id"], r["_y"]))
    keep = docs.sparkSession.createDataFrame(fits, own.select("_id", "_y").schema)
    got = own.join(F.broadcast(keep), ["_id", "_y"]).select("_id", "_t", "_y").toArrow().sort_by([("_id", "ascending"), ("_t", "ascending"), ("_y", "ascending")])
    return got["_t"].to_pylist(), np.array(got["_y"].to_pylist(), dtype=np.float64), share


def prior_shift(y: np.ndarray, share: float) -> float:
    """What the log-odds fitted on the sample must gain to hold for the corpus."""
    ours = (y.sum() + 1) / (len(y) + 2)
    return math.log(share / (1 - share)) - math.log(ours / (1 - ours))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
