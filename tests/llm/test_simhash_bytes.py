import itertools
import random

import xxhash

from tallycast.llm import simhash_bytes as S


def slow_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, fps, bits=3):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, x), (b, y) in itertools.combinations(zip(ids, fps), 2):
        if bin(x ^ y).count("1") <= bits:
            r, s = sorted((find(a), find(b)))
            root[s] = r
    return {i: find(i) for i in ids}


def corpus():
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(400)]
    texts = [None, "", " \t ", "One", "one two", "ONE two Three", "É a b c d", "x " * 3000]
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([5, 60, 300]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            t = list(base)
            if rng.random() < 0.7:
                t[rng.randrange(len(t))] = "changed%d" % rng.randrange(9)
            texts.append(" ".join(t))
    return texts + texts[10:13]


def test_rows_equal_brute_force_for_sparse_and_dense_lists(spark):
    texts = corpus()
    ids = [7 * i + 3 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in zip(ids, texts)], "doc_id long, text string, fp int, key string")
    fps = [slow_simhash(t) for t in texts]
    want = components(ids, fps)
    for dense in (1, 1000):
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(df, dense_list=dense).collect()}
        assert got == {i: (f"{f:016x}", want[i]) for i, f in zip(ids, fps)}
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_links_lose_nothing_near_a_dense_centre(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 60:
        f = base
        for _ in range(rng.randrange(1, 6)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = components(signed, fps)
    pairs = {(a, b) for (a, x), (b, y) in itertools.combinations(zip(signed, fps), 2) if bin(x ^ y).count("1") <= 3}
    assert {tuple(sorted(r)) for r in S.links(df).collect()} == {tuple(sorted(p)) for p in pairs}
    from tallycast.llm.components import connected_components
    got = {r.node: r.root for r in connected_components(S.links(df, dense_list=2)).collect()}
    assert {i: got.get(i, i) for i in signed} == want


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d")], "doc_id long, text string")
    rows = S.near_duplicates(df).collect()
    assert len(rows) == 3 and {r.component_id for r in rows} == {4}
    assert [r.doc_id for r in S.keep_one_per_group(df).collect()] == [4]
