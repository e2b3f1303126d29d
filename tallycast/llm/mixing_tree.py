"""Mixing sources to target weights with a multivariate-hypergeometric tree.

1. Every source has a target number of words: ``share`` times all words, dealt
   by weight, no source above ``cap`` times its own size (the excess goes to
   the others by weight until none is above).
2. Documents are cut into blocks of ``block_words`` words. A source gives
   ``floor(target / size)`` whole passes over its blocks and one partial pass:
   the blocks of a random permutation, up to exactly the words that are left.
   That fixes an exact quota of drawn blocks per source.
3. A binary tree over the output shards splits the quota vector: each node's
   blocks are an urn, its left half draws as many as its shards hold, by the
   multivariate hypergeometric law (one conditional hypergeometric draw per
   source, inverted from its exact distribution). All shards get equally many
   blocks and every quota is used up exactly.
4. A source's drawn blocks, in permuted order, are handed to the shards in runs
   of those counts, so draws are disjoint; inside a shard ``shuffle_key`` is a
   random order.

Only DataFrame expressions are used. The permutation is a hash order summed in
buckets (``running_totals``), so no source is ever sorted in one task; the tree
works on one row per node, with one number per source in it. All draws are
functions of the seed and the rows: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, running_totals, stored

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2.0
BLOCK_WORDS = 256
SHARDS = 16
SEED = 20


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, rank, source_size, target) from (source, size) rows.

    Sources in code-point order, null last, weigh ``weights``, repeating. Water
    filling: with the sources in order of cap * size / weight, the capped ones
    are a prefix, found from running sums over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    per = per.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_ratio = everything.orderBy(F.col("most") / F.col("w"), "rank")
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - before) / rest)
    fits = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(F.col("most") / F.col("w"), "rank", "level")))
    per = per.withColumn("fit", fits.over(everything))
    target = F.when(F.col("fit").isNull(), F.col("most")).otherwise(F.least("most", F.col("fit.level") * F.col("w")))
    return per.select("source", "rank", "source_size", target.alias("target"))


def _ln_factorial(n: Column) -> Column:
    x = n.cast("double")
    stirling = (x * F.ln(x) - x + 0.5 * F.ln(2 * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
                + 1 / (1260 * x * x * x * x * x))
    return F.when(n <= 20, F.ln(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(stirling)


def _ln_choose(n: Column, k: Column) -> Column:
    return _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)


def hypergeometric(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``marked`` are among ``draws`` out of ``total``: the smallest
    k whose distribution function reaches the uniform ``u``. Terms follow from
    each other by their ratio, starting ten deviations below the mean."""
    n, m, d = (c.cast("double") for c in (total, marked, draws))
    mean = d * m / n
    spread = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - m / n) * (n - d) / F.greatest(n - 1, F.lit(1.0)))) * 10 + 5
    low = F.greatest(F.lit(0).cast("long"), draws - (total - marked), F.floor(mean - spread))
    high = F.least(marked, draws, F.ceil(mean + spread))
    first = F.exp(_ln_choose(marked, low) + _ln_choose(total - marked, draws - low) - _ln_choose(total, draws))

    def step(acc, k):
        ratio = F.coalesce(F.try_divide((m - k) * (d - k), (k + 1) * (n - m - d + k + 1)), F.lit(0.0))
        hit = acc["k"].isNull() & (acc["cum"] + acc["p"] >= u)
        return F.struct(F.when(hit, k).otherwise(acc["k"]).alias("k"), (acc["p"] * ratio).alias("p"),
                        (acc["cum"] + acc["p"]).alias("cum"))

    zero = F.struct(F.lit(None).cast("long").alias("k"), first.alias("p"), F.lit(0.0).alias("cum"))
    found = F.aggregate(F.sequence(low, high), zero, step, lambda acc: F.coalesce(acc["k"], high))
    return F.when((total <= 0) | (marked <= 0) | (draws <= 0), F.lit(0).cast("long")).otherwise(found)


def _uniform(*parts) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def splitting_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(rank, bounds) from (rank, quota): ``bounds[k]`` is the first index, among
    the source's drawn blocks, that belongs to shard k + 1."""
    total = F.expr("aggregate(counts, 0L, (a, x) -> a + x)")
    nodes = (quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q"))
             .filter(F.size("q") > 0)
             .select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.col("q.rank").alias("ranks"), F.col("q.quota").alias("counts"))
             .withColumn("all", total))
    depth = (shards - 1).bit_length()
    for _ in range(depth):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        edge = lambda k: F.floor(k.cast("decimal(38,0)") * F.col("all") / shards).cast("long")
        inner = nodes.withColumn("mid", mid).withColumn("left", edge(F.col("mid")) - edge(F.col("lo")))

        def draw(acc, x):
            u = _uniform(F.lit(seed), F.col("lo"), F.col("hi"), F.size(acc["out"]))
            got = hypergeometric(acc["pool"], x, acc["open"], u)
            return F.struct((acc["pool"] - x).alias("pool"), (acc["open"] - got).alias("open"),
                            F.concat(acc["out"], F.array(got)).alias("out"))

        start = F.struct(total.alias("pool"), F.col("left").alias("open"), F.array().cast("array<bigint>").alias("out"))
        inner = inner.withColumn("drawn", F.aggregate("counts", start, draw, lambda acc: acc["out"]))
        rest = F.zip_with("counts", "drawn", lambda a, b: a - b)
        halves = F.array(F.struct("lo", F.col("mid").alias("hi"), F.col("drawn").alias("counts")),
                         F.struct(F.col("mid").alias("lo"), "hi", rest.alias("counts")))
        whole = F.array(F.struct("lo", "hi", "counts"))
        split = F.when(F.col("hi") - F.col("lo") > 1, halves).otherwise(whole)
        nodes = (inner.select("ranks", "all", F.explode(split).alias("n")).select("ranks", "all", "n.*"))
        nodes = stored(nodes, "mix-tree")
    leaves = nodes.select("lo", F.explode(F.arrays_zip("ranks", "counts")).alias("z")).select("lo", "z.*")
    return (leaves.groupBy(F.col("ranks").alias("rank"))
            .agg(F.sort_array(F.collect_list(F.struct("lo", "counts"))).alias("s"))
            .select("rank", F.expr("aggregate(s.counts, cast(array() as array<bigint>), "
                                   "(a, x) -> concat(a, array(coalesce(try_element_at(a, -1), 0L) + x)))").alias("bounds")))


def mix(docs: DataFrame, block_words: int | None = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
        weights=WEIGHTS, share: float = SHARE, cap: float = CAP, row: str | None = None) -> DataFrame:
    """The drawn blocks: (row, doc_id, source, size, source_size, target, block,
    epoch, words, shard, shuffle_key).

    ``row`` names an input row (repeated rows are drawn from separately): the
    column of that name given, or a number.
    ``block_words`` None makes every document one block. A document of no words
    (null or empty text) has one block of none; a block that is not drawn in the
    partial pass appears there with ``words`` 0 and no shard. A null source is
    a source; a null id is an id like any other. Other columns are ignored; an
    empty table gives an empty table.
    """
    if cap > 2:
        raise ValueError("a source is passed over at most twice")
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    base = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("key"), number.alias("row")), "mix-base")
    targets = stored(source_targets(base, weights, share, cap)
                     .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                 .otherwise(0).cast("long"))
                     .withColumn("open", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")),
                     "mix-targets")
    if block_words:
        n = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("size") / block_words))
        blocks = (base.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
                  .withColumn("length", F.greatest(F.lit(0).cast("long"), F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words))))
    else:
        blocks = base.withColumn("block", F.lit(0).cast("long")).withColumn("length", F.col("size"))
    blocks = stored(running_totals(blocks, ["source"], F.xxhash64("key", "block"),
                                   {"words_before": F.col("length"), "index": F.lit(1)}, blocks.count()), "mix-blocks")
    t = targets.withColumnRenamed("source", "_source")
    on = F.col("source").eqNullSafe(F.col("_source"))
    part = F.greatest(F.lit(0).cast("long"), F.least("length", F.col("open") - F.col("words_before")))
    drawn = blocks.join(t, on).withColumn("part", part)
    quotas = (drawn.groupBy("rank").agg(F.max("passes").alias("passes"), F.count("*").alias("n"), F.count_if(F.col("part") > 0).alias("m"))
              .select("rank", (F.col("passes") * F.col("n") + F.col("m")).alias("quota"), F.col("n").alias("per_pass")))
    quotas = stored(quotas, "mix-quotas")
    tree = splitting_tree(quotas, shards, seed).join(quotas.select("rank", "per_pass"), "rank")
    tree = tree.withColumnRenamed("rank", "_rank")
    out = drawn.join(tree, F.col("rank") == F.col("_rank")).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    words = F.when(F.col("epoch") < F.col("passes"), F.col("length")).otherwise(F.col("part"))
    taken = (F.col("epoch") < F.col("passes")) | (F.col("part") > 0)
    at = F.col("epoch") * F.col("per_pass") + F.col("index")
    shard = F.when(taken, F.size(F.filter("bounds", lambda b: b <= at)))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", "block", "epoch", words.alias("words"),
                      shard.alias("shard"), F.xxhash64(F.lit(seed), shard, "key", "block", "epoch").alias("shuffle_key"))


def taken_words(mixed: DataFrame) -> DataFrame:
    """One row per input row: (doc_id, size, source_size, target, taken, n_shards)."""
    return (mixed.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
                                     F.first("target").alias("target"), F.sum("words").alias("taken"),
                                     F.size(F.collect_set("shard")).alias("n_shards"))
            .drop("row"))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """``docs`` as mixed: every row as many times as it is drawn (0 to 2), columns
    unchanged. Documents are whole blocks here; the one document that a source's
    quota cuts is taken when at least half its words are. Documents of no words,
    whose taking changes no target, stay once. Rows are told apart by a number,
    so repeated ids and texts keep their own draws."""
    row, copies = free_names(docs, "_row", "_copies")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    m = mix(numbered.select("doc_id", "source", "text", F.col(row).alias("row")), block_words=None, row="row", **params)
    whole = F.col("shard").isNotNull() & (2 * F.col("words") >= F.col("size")) & (F.col("size") > 0)
    times = m.groupBy(F.col("row").alias(row)).agg(F.when(F.first("size") == 0, F.lit(1)).otherwise(F.count_if(whole).cast("int")).alias(copies))
    drawn = numbered.join(times.filter(F.col(copies) > 0), row)
    return drawn.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
