import random
import re
from collections import Counter

import numpy as np
import pytest

from tallycast.llm import collocations


def brute(rows, least=10, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        if any(100 * b >= 50 * a for (m, q), b in cand.items() if m == lang and len(q) > len(p)
               and p in {q[i:i + len(p)] for i in range(len(q) - len(p) + 1)}):
            continue
        score, k = min((10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
                  for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))


def texts(rng, n):
    words = ["the", "of", "The", "new", "york", "city", "Ärger", "ÄRGER", "\x1c", "a\x00b", "x y", "�", "é", "zz"]
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 60)):
            parts.append(rng.choice(["New York city", "the of the of", rng.choice(words), rng.choice(words)]))
            parts.append(rng.choice([" ", "  ", "\t", " ", " ", ". ", "\n", ",", "\r", "\x0b"]))
        yield "".join(parts)


def test_equals_brute_force_over_small_tries_and_arrays(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["en", "de", None, ""]), t) for t in texts(rng, 250)]
    rows += [("en", None), ("en", ""), (None, "the of"), ("fr", "solo")] + [rows[0]] * 15
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "lang string, text string, h1 int, word string").repartition(5)
    want = brute(rows)
    assert len(want) > 60 and {r[0] for r in want} == {"en", "de", "und", ""}

    def got(**kw):
        return sorted(map(tuple, collocations.collocations(df, **kw).collect()))
    assert got() == want
    assert got(limits=collocations.Limits(flush=50, cache=3, slots=64, block=40)) == want
    assert got(top=9) == [r for r in want if r[1] <= 9]


def test_long_texts_are_cut_without_losing_phrases(monkeypatch):
    rng = random.Random(1)
    text = " ".join(texts(rng, 40)).encode()
    whole = [w for part in collocations.words_of(text) for w in part]
    for size in (1, 7, 64):
        monkeypatch.setattr(collocations, "PART", size)
        assert [w for part in collocations.words_of(text) for w in part] == whole
    assert [w for part in collocations.words_of(b"x" * 5000) for w in part] == [b"x" * 5000]


@pytest.mark.parametrize("n, alphabet", [(0, 3), (1, 3), (300, 12), (3000, 60), (3000, 2000)])
def test_trie_finds_its_candidates_and_nothing_else(n, alphabet):
    rng = np.random.default_rng(n + alphabet)
    symbols = rng.integers(-2 ** 62, 2 ** 62, alphabet)
    draw = np.minimum(rng.zipf(1.4, (n, 3)) - 1, alphabet - 1)
    third = rng.random(n) < 0.5
    cand = {(int(symbols[a]), int(symbols[b]), int(symbols[c]) if t else 0) for (a, b, c), t in zip(draw, third)}
    rows = np.array(sorted(cand), np.int64).reshape(-1, 3)
    trie = collocations.build_trie(*rows.T)
    at = np.arange(len(trie.ends))
    assert {tuple(map(int, x)) for x in zip(*trie.phrases(at))} == cand and len(at) == len(cand)
    seq = symbols[np.minimum(rng.zipf(1.4, 5000) - 1, alphabet - 1)]
    seq[rng.random(5000) < 0.05] = 0
    counts = np.zeros(len(trie.ends), np.int64)
    vocabulary = np.append(0, symbols)
    codes = np.array([np.flatnonzero(vocabulary == h)[0] for h in seq])
    collocations.count_states(trie, codes[:2000], vocabulary, 0, counts)
    collocations.count_states(trie, codes[1998:], vocabulary, 2, counts)
    want = Counter()
    for k in (2, 3):
        want.update(tuple(g) + (0,) * (3 - k) for g in zip(*[seq[i:].tolist() for i in range(k)]) if 0 not in g and tuple(g) + (0,) * (3 - k) in cand)
    seen = np.flatnonzero(counts)
    assert {tuple(map(int, p)): int(counts[s]) for p, s in zip(zip(*trie.phrases(seen)), seen)} == dict(want)


def test_empty_table_and_rare_phrases(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).collect() == []
    few = spark.createDataFrame([("en", "one two three")] * 9, "lang string, text string")
    assert collocations.collocations(few).collect() == []
    assert [r.phrase for r in collocations.collocations(few, min_count=9).collect()] == ["one two three"]
