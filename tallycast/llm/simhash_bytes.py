"""SimHash near-duplicates through an inverted index on byte positions.

A 64-bit fingerprint is eight bytes at eight positions. Two fingerprints at
``max_bits`` = 3 or fewer differing bits differ in at most three bytes, so at
least five positional bytes agree. Any five of eight positions hold three
positions of one half, so the postings are keyed by every triple of positions
of the lower and of the upper half (eight lists per fingerprint): a pair that
can match meets in at least one list, and a list of unrelated fingerprints
holds a 2^-24 share of them instead of the 2^-8 of a single byte. For each
pair that meets, the agreeing positional bytes are tallied, pairs that reach
the guaranteed five are kept and verified by their bit distance.

Lists longer than ``dense_list`` (thousands of near copies whose fingerprints
differ in a few bits) are not paired at all. There the members meet at
*common neighbours*: two fingerprints are within three bits exactly when some
value lies within one bit of the one and two bits of the other. Every member
posts itself (radius 0), its one-bit and its two-bit neighbours inside the five
bytes that the list leaves open; a value that somebody reaches with at most one
bit links all who reach it to that one. The rows are a constant times the
members, no link is lost, and no pair outside the distance is made.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, stored, string_bytes
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
MIN_BYTES = 5
DENSE_LIST = 1024
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Unsigned fingerprint of one text given as UTF-8 bytes: ASCII letters are
    lower-cased, words are split at ASCII white space, each ``shingle`` words in
    a row (all words, if there are fewer) are hashed by XXH64, repeats included;
    a bit is 1 if it is set in over half the hashes. No word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    hashes = np.fromiter([h(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())],
                         np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp long): the fingerprint of every row, as a signed 64-bit value."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((simhash(t, shingle) for t in string_bytes(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    schema = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {schema}, fp long")


def _byte(col, i: int):
    return F.shiftrightunsigned(col, 8 * i).bitwiseAND(F.lit(255))


def postings(fps: DataFrame) -> DataFrame:
    """(key, fp): one row per fingerprint and triple of byte positions."""
    def key(n, triple):
        bits = F.lit(n)
        for i in triple:
            bits = F.shiftleft(bits, 8).bitwiseOR(_byte(F.col("fp"), i))
        return bits.cast("long")

    return fps.select("fp", F.explode(F.array(*[key(n, t) for n, t in enumerate(TRIPLES)])).alias("key"))


def shared_bytes(xor):
    """How many of the eight positional bytes agree, from the XOR of two fingerprints."""
    return reduce(lambda a, b: a + b, [(_byte(xor, i) == 0).cast("int") for i in range(8)])


def _masks(spark: SparkSession) -> DataFrame:
    """(table, mask): for each of the eight tables, every mask of at most two
    bits in the five bytes that its triple leaves open (8 x 861 rows)."""
    rows = []
    for n, triple in enumerate(TRIPLES):
        bits = [1 << (8 * b + j) for b in range(8) if b not in triple for j in range(8)]
        rows += [(n, m - (1 << 64) if m >> 63 else m) for m in [0, *bits, *(x | y for x, y in combinations(bits, 2))]]
    return spark.createDataFrame(rows, "table int, mask long")


def links(classes: DataFrame, max_bits: int = MAX_BITS, dense_list: int = DENSE_LIST) -> DataFrame:
    """(a, b): links between different fingerprints at most ``max_bits`` apart.
    In lists of up to ``dense_list`` members every such pair; in longer ones
    a star through each common neighbour, with the same connected components."""
    if max_bits != MAX_BITS:
        raise ValueError("the byte-position index is laid out for a distance of 3 bits")
    posts = stored(postings(classes.select("fp")), "simhash-postings")
    sizes = posts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    hot = sizes.filter(F.col("n") > dense_list).select("key")
    sparse = posts.join(sizes.filter(F.col("n") <= dense_list).select("key"), "key", "left_semi")
    xor = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (sparse.withColumnRenamed("fp", "a").join(sparse.withColumnRenamed("fp", "b"), "key")
             .filter(F.col("a") < F.col("b"))
             .filter(shared_bytes(xor) >= MIN_BYTES)
             .filter(F.bit_count(xor) <= max_bits)
             .select("a", "b"))
    return pairs.unionByName(_dense_links(posts.join(hot, "key", "left_semi"))).distinct()


def _dense_links(members: DataFrame) -> DataFrame:
    """Links inside the long lists, by common neighbours (see the module's text)."""
    reach = F.when(F.bit_count("mask") <= 1, F.col("fp"))
    posted = (members.withColumn("table", F.shiftrightunsigned("key", 24).cast("int"))
              .join(F.broadcast(_masks(members.sparkSession)), "table")  # 6,888 rows, whatever the input
              .select("key", "fp", "mask", F.col("fp").bitwiseXOR(F.col("mask")).alias("value")))
    hubs = posted.groupBy("key", "value").agg(F.min(reach).alias("hub"), F.count("*").alias("n"))
    hubs = hubs.filter("hub is not null and n > 1").select("key", "value", "hub")
    return (posted.join(hubs, ["key", "value"]).filter("fp != hub")
            .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, dense_list: int = DENSE_LIST) -> DataFrame:
    """One row per input row: (doc_id, fingerprint, component_id).

    ``fingerprint``: 16 lowercase hex digits. ``component_id``: the smallest
    id among all rows reachable over links. Null and empty texts have the
    fingerprint zero, linked like any other; repeated rows keep their row each;
    a null id keeps its row and never names a component unless all are null.
    Extra columns are ignored; an empty table gives an empty table.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = links(classes, max_bits, dense_list)
    comp = connected_components(edges)
    rep = (classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
           .withColumn("root", F.coalesce("root", "fp")))
    ids = rep.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rep.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id")
    return (fps.join(named, F.col("fp") == F.col("_fp"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one_per_group(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, columns unchanged:
    the row of smallest id (a null id counts as the largest), of rows with the
    same id the one whose text hashes lowest. Rows are told apart by a number, so
    exactly one row of a group stays whatever ids are missing or repeated."""
    row, = free_names(docs, "_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    groups = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), **params).select(F.col("doc_id").alias("r"), "component_id")
    names = numbered.select(F.col(row).alias("n"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("name"),
                            F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"))
    stays = groups.join(names, F.col("r") == F.col("n")).groupBy("component_id").agg(F.min(F.struct("unnamed", "name", "h", "n")).alias("s"))
    return numbered.join(stays.select(F.col("s.n").alias(row)), row, "left_semi").select(*docs.columns)
