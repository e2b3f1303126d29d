import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallycast.llm import mixing_tree as M


def slow_targets(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: unit * weight[s] for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


def corpus(n=160, seed=3):
    rng = random.Random(seed)
    rows = [(1000, None, "a", 0), (1001, "", "a", 0), (None, "x y", None, 0), (1002, "one word \t\x0b two", "é", 1)]
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "Z", "é", "\U0001f600", None, "only"])
        rows.append((i, " ".join("w" * 3 for _ in range(rng.choice([1, 5, 40, 90]))), source, i))
    rows += [rows[7], rows[7]]
    return rows


def test_targets_quotas_and_limits(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += size(t)
    want = slow_targets(dict(sizes))
    mixed = M.mix(df, block_words=16, shards=5).cache()
    blocks = mixed.collect()
    docs = M.taken_words(mixed).collect()
    assert Counter((r.doc_id, r.size) for r in docs) == Counter((i, size(t)) for i, t, _, _ in rows)
    took = defaultdict(int)
    for r in blocks:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9) and r.source_size == sizes[r.source]
        took[r.source] += r.words
        assert (r.shard is None) == (r.words == 0 and r.shard is None) and (r.shard is None or 0 <= r.shard < 5)
    for s, n in took.items():
        assert abs(n - want[s]) <= 0.5 + 1e-9
    assert all(0 <= r.taken <= 2 * r.size for r in docs)
    # disjoint draws, equally many blocks in all shards, exact quotas
    drawn = [r for r in blocks if r.shard is not None]
    assert len({(r.row, r.block, r.epoch) for r in drawn}) == len(drawn)
    per = Counter(r.shard for r in drawn)
    assert max(per.values()) - min(per.values()) <= 1 and len(per) == 5
    again = M.mix(df.repartition(3), block_words=16, shards=5)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.block, r.epoch, r.words, -1 if r.shard is None else r.shard)
    assert sorted(map(key, blocks)) == sorted(map(key, again.collect()))


def test_hypergeometric_inverts_the_exact_distribution(spark):
    total, marked, draws = 23, 9, 11
    lo, hi = max(0, draws - (total - marked)), min(marked, draws)
    pmf = {k: math.comb(marked, k) * math.comb(total - marked, draws - k) / math.comb(total, draws) for k in range(lo, hi + 1)}
    us = [i / 200 + 0.001 for i in range(199)]
    got = spark.createDataFrame([(u,) for u in us], "u double").select(
        "u", M.hypergeometric(F.lit(total), F.lit(marked), F.lit(draws), F.col("u")).alias("k")).collect()
    for r in got:
        cum, k = 0.0, lo
        while cum + pmf[k] < r.u and k < hi:
            cum, k = cum + pmf[k], k + 1
        assert r.k == k
    big = spark.range(1).select(M.hypergeometric(F.lit(2_000_000), F.lit(700_000), F.lit(1_000_000), F.lit(0.5)).alias("k")).first().k
    assert abs(big - 350_000) <= 1


def test_tree_uses_up_quotas(spark):
    q = spark.createDataFrame([(0, 40), (1, 0), (2, 700), (3, 3)], "rank int, quota long")
    rows = {r["rank"]: r.bounds for r in M.splitting_tree(q, shards=7).collect()}
    assert {k: v[-1] for k, v in rows.items()} == {0: 40, 1: 0, 2: 700, 3: 3}
    counts = {k: [b - a for a, b in zip([0, *v], v)] for k, v in rows.items()}
    assert all(x >= 0 for v in counts.values() for x in v)
    per = [sum(v[i] for v in counts.values()) for i in range(7)]
    assert max(per) - min(per) <= 1


def test_empty_and_whole_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(empty).collect() == [] and M.mixed_documents(empty).collect() == []
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    n = Counter((r.doc_id, r.source) for r in out.collect())
    have = Counter((i, s) for i, _, s, _ in rows)
    assert all(v <= 2 * have[k] for k, v in n.items()) and n[(1000, "a")] == 1 and n[(1001, "a")] == 1
