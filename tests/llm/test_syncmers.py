import hashlib
import random
import re

import xxhash

from tallycast.llm import syncmers as M


def h64(*parts, start=42):
    """Spark's xxhash64: each value is hashed with the hash so far as its seed."""
    h = start
    for p in parts:
        data = p.encode() if isinstance(p, str) else int(p).to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def pack(h, i):
    return ((h % (1 << 64)) >> 24 << M.POSITION_BITS) | min(i, (1 << M.POSITION_BITS) - 1)


def slow_sketch(text):
    syms = re.findall(r"[^ \t\n\x0b\x0c\r]{1,4}", text)
    hs = [h64(s) for s in syms]
    if not hs:
        return []
    if len(hs) < M.K:
        return [pack(h64(*hs, "short"), 0)]
    g = [h64(a, b) for a, b in zip(hs, hs[1:])]
    first = {}
    for i in range(len(hs) - M.K + 1):
        inner = g[i:i + M.K - M.S + 1]
        if min(inner) in (inner[0], inner[-1]):
            p = pack(h64(g[i], g[i + M.S], hs[i + M.K - 1]), i)
            first.setdefault(p >> M.POSITION_BITS, p)
    return sorted(first.values())[:M.ANCHORS]


def slow_likeness(a, b):
    mask = (1 << M.POSITION_BITS) - 1
    pa, pb = {x >> M.POSITION_BITS: x & mask for x in a}, {x >> M.POSITION_BITS: x & mask for x in b}
    if not pa and not pb:
        return 1.0
    union = sorted({*pa, *pb})[:M.ANCHORS]
    off = sorted(pa[h] - pb[h] for h in union if h in pa and h in pb)
    return sum(abs(x - off[len(off) // 2]) <= M.DRIFT for x in off) / len(union) if off else 0.0


def corpus():
    rng = random.Random(8)
    vocab = ["w%dq%d" % (i, i * i) for i in range(500)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.choice([3, 20, 150, 600]))) for _ in range(40)]
    texts += ["", None, " \n", "x", "no spaces" * 1, "é" * 3000, "a b c d e " * 400, texts[0], texts[1] + " tail"]
    rng.shuffle(texts)
    rows = [(i * 5 - 20, t) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "null id text of some words here"), (rows[4][0], "other text under the same id")]


def test_rows_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string").repartition(3)
    got = M.compare(df).collect()
    key = lambda i, t: (M.NO_ID if i is None else i, h64(t))
    order = sorted({key(i, t or ""): t or "" for i, t in rows}.items())
    after = {k: order[(n + 1) % len(order)][1] for n, (k, _) in enumerate(order)}
    hexed = lambda sk: "".join(f"{x:016x}" for x in sk)
    want = []
    for i, t in rows:
        t = t or ""
        nxt, half = after[key(i, t)], len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = slow_sketch(t), slow_sketch(edited), slow_sketch(nxt)
        want.append((M.NO_ID if i is None else i, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b),
                     round(slow_likeness(a, b), 9), round(slow_likeness(a, c), 9)))
    assert sorted((M.NO_ID if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                   round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(want)
    long = [r for r in got if r.n_chars > 600 and len(set(r.fingerprint)) > 1 and r.fingerprint != r.edited_fingerprint]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)


def test_single_and_empty(spark):
    one = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    r = M.compare(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c d a b c d"[:8] + b"a b c d").hexdigest() or r.near_next == 1.0
    assert M.compare(one.limit(0)).collect() == []
