import random

import numpy as np

from tallycast.llm import latent_decontam as L

VOCAB = ["w%d" % i for i in range(3000)]
COMMON = ["the", "of", "and", "to", "in"]


def prose(rng, n):
    return [rng.choice(COMMON) if rng.random() < 0.4 else VOCAB[int(3000 * rng.random() ** 2)] for _ in range(n)]


def said(words):
    return " ".join(w.capitalize() + "." if i % 12 == 11 else w for i, w in enumerate(words))


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def slow_leaks(docs, items):
    """Brute force: every stretch of an item's length and a half of every document."""
    out = set()
    for d, text in docs:
        words = L.words_of(text or "")
        for k, item in items:
            q, ans = L.words_of(item or ""), L.answer_of(item or "")
            for a in range(0, max(1, len(words)), 4):
                part = words[a:a + len(q) * 3 // 2]
                if q and slow_lcs(q, part) >= L.LCS_SHARE * len(q) and slow_lcs(ans, part) >= L.ANSWER_SHARE * len(ans):
                    out.add((d, k))
                    break
    return out


def test_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(-1, 6) for _ in range(rng.randrange(0, n))] for n in (90, 60))
        a = [x for x in a if x >= 0]
        assert L.lcs(np.array(a, int), np.array(b, int)) == slow_lcs(a, b)


def corpus():
    rng = random.Random(4)
    items = [(k, said(prose(rng, n))) for k, n in enumerate([15, 18, 24, 30, 40, 45, 58, 90, 200, 33, 36, 50] * 2)] + [(98, None), (99, " .. ")]
    docs = [(i, said(prose(rng, rng.choice([3, 60, 300])))) for i in range(60)]
    for i, (k, t) in enumerate(items[:24]):
        body = t.split()
        if i % 3 == 1:  # a paraphrase: every sixth word is another
            body = [w if j % 6 else "changed%d" % j for j, w in enumerate(body)]
        docs.append((1000 + i, " ".join(prose(rng, rng.randrange(90)) + (body if i % 3 < 2 else [w.upper() + "," for w in body]) + prose(rng, 40))))
        docs.append((2000 + i, " ".join(rng.sample(t.split(), len(t.split())))))  # the same words in another order
    return docs + [(3000, None), (3001, ""), (None, items[3][1]), (3002, " ".join(prose(rng, 20_000)) + " " + items[5][1]), docs[63], docs[63]], items


def test_finds_what_brute_force_finds(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, h string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in L.leaks(d, b).collect()]
    want = slow_leaks([r for r in docs if r[0] != 3002], items) | {(3002, 5)}
    assert want <= set(got) and set(got) - want <= {(2000 + k, k) for k, _ in items}
    assert len(got) == len(set(got)) + 2 * sum(1 for x in set(got) if x[0] == docs[63][0])
    assert {(1000 + i, i) for i in range(24)} <= set(got) and (None, 3) in got
    kept = L.drop_leaks(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((i is None, i or 0) for i, _ in docs if i not in {x for x, _ in got})


def test_randomised_svd_finds_the_leading_directions(spark):
    rng = random.Random(2)
    topics = [[VOCAB[40 * t + j] for j in range(12)] for t in range(4)]
    docs = [(i, " ".join(rng.choice(topics[i % 4]) for _ in range(64))) for i in range(80)]
    q = L.Queries([(t, " ".join(ws)) for t, ws in enumerate(topics)])
    enc = L.encode(spark.createDataFrame(docs, "doc_id long, text string"), q.vocab)
    df, n = L.passage_frequencies(enc, len(q.vocab))
    rows = [[q.vocab[w] for w in t.split()][a:a + L.PASSAGE] for _, t in docs for a in range(0, 64, L.PASSAGE)]
    assert n == len(rows) and df.tolist() == [sum(w in r for r in rows) for w in range(len(q.vocab))]
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    a = np.array([np.bincount(r, minlength=len(idf)) for r in rows]) * idf
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    vectors, values = L.randomised_svd(enc, idf, rank=4, oversample=20)
    assert np.allclose(values, s[:4], rtol=0.02)
    assert np.linalg.norm(vectors.T @ vt[:4].T) > 1.9


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([("q", "a b")], "item_id string, text string")
    assert L.leaks(docs.limit(0), items).collect() == []
    assert L.leaks(docs, items.limit(0)).collect() == []
    assert [(r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()] == [(1, "q")]
    assert L.leaks(docs, spark.createDataFrame([("q", "zzz yyy")], "item_id string, text string")).collect() == []
