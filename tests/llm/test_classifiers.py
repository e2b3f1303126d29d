import random
import zlib

import numpy as np

from tallycast.llm import byte_cnn, toxicity
from tallycast.llm.common import is_held_out

WORDS = ["then", "ander", "thing", "eshor", "reon", "ouble", "ingha", "ation", "whor", "nded"]


def auc(s, y):
    s, y = np.array(s), np.array(y)
    return (s[y == 1][:, None] > s[y == 0][None]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None]).mean()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def test_chunks_cover_all_bytes():
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        text = bytes((i % 255) + 1 for i in range(n))
        c = byte_cnn.chunks_of(text)
        back = np.zeros((len(c) - 1) * byte_cnn.HOP + byte_cnn.CHUNK, np.uint8)
        for i, row in enumerate(c):
            back[i * byte_cnn.HOP:i * byte_cnn.HOP + byte_cnn.CHUNK] = row
        assert back[:n].tobytes() == text and not back[n:].any()


def test_convolution_equals_the_direct_sum():
    rng = np.random.default_rng(0)
    table = rng.normal(size=(byte_cnn.WIDTH, 256, byte_cnn.FILTERS)).astype(np.float32)
    model = byte_cnn.Model(table, rng.normal(size=byte_cnn.FILTERS).astype(np.float32), rng.normal(size=3 * byte_cnn.FILTERS + 1), 0.3)
    texts = [b"", b"short", bytes(rng.integers(1, 255, 700, dtype=np.uint8)), b"x" * 3000]
    want = []
    for t in texts:
        pooled = []
        for c in byte_cnn.chunks_of(t):
            r = [sum(table[j, c[p + j]] for j in range(byte_cnn.WIDTH)) for p in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STRIDE)]
            pooled.append(np.tanh(np.max(r, axis=0) + model.bias))
        z = np.concatenate([np.mean(pooled, 0), np.max(pooled, 0), np.min(pooled, 0), [byte_cnn.filled(len(t))]])
        want.append(z @ model.head + model.offset)
    for batch in (1, 3, 64):
        assert np.allclose(byte_cnn.logits(texts, model, batch), want, atol=1e-3)


def test_quality_learns_and_scores_every_row(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(20, 90)) if good else " ".join(w.upper() + "!!" for w in prose(rng, 60).split())
        rows.append((i, text, "s", 0.5))
        labels.append((i, int(good), 0))
    rows += [(900, None, "s", 0.1), (901, "", None, 0.1), (902, "y" * 60_000, "s", 0.1), (None, "abc", "s", 0.1), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    lab = spark.createDataFrame(labels + [(5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = byte_cnn.train(docs, lab)
    got = byte_cnn.score(docs, model, ["doc_id", "text", "score"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    same = {}
    for r in got:
        assert same.setdefault(r.text or "", r.score) == r.score
    y = dict((a, b) for a, b, _ in labels)
    held = [r for r in got if r.doc_id in y and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 20 and auc([r.score for r in held], [y[r.doc_id] for r in held]) > 0.97
    kept = byte_cnn.keep_good(docs, lab)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = spark.createDataFrame([], "doc_id long, text string")
    for kind in (byte_cnn, toxicity):
        model = kind.train(docs, none)
        assert {r.score for r in kind.score(docs, model, ["doc_id"]).collect()} == {0.5}
        assert kind.score(empty, kind.train(empty, none), ["doc_id"]).collect() == []
    ids = spark.range(8)
    assert [r.h for r in ids.select(is_held_out(ids.id).alias("h")).collect()] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(8)]


def model_of(texts):
    return toxicity.CharModel(sum(toxicity.trigram_counts(t) for t in texts))


def test_viterbi_equals_enumeration():
    lm = model_of(["the idiot moron loser scum pathetic words of the corpus stupid tail"] * 3)
    for span in ("1d10t", "m0r0n", "s.c.u.m", "looooser", "p@th3t1c", "$tup1d", "é1x"):
        paths = [("", 0.0)]
        for options in toxicity.lattice(span):
            paths = [(p + t, s + c) for p, s in paths for t, c in options]

        def total(p, s):
            a = b = 0
            for ch in p:
                k = toxicity.CODE.get(ch, 1)
                s, a, b = s + lm.step(a, b, k), b, k
            return s + lm.step(a, b, 0)
        best = max(total(p, s) for p, s in paths)
        first = toxicity.decode(span, lm)[0]
        assert abs(max(total(p, s) for p, s in paths if p == first) - best) < 1e-4
    assert toxicity.decode("1d10t", lm)[0] == "idiot" and "scum" in toxicity.decode("s.c.u.m", lm)


def test_trigrams_do_not_depend_on_the_layout_of_the_documents(spark):
    texts = ["the cat", None, "", "Ärger 12 über\U0001f600x", "a" * 5000, "  two  blanks ", "x"]
    want = sum(toxicity.trigram_counts(t) for t in texts if t is not None)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for parts in (1, 3, 16):
        assert (toxicity.corpus_trigrams(df.repartition(parts)) == want).all()
    assert want.reshape((toxicity.SIZE,) * 3)[0, 0, toxicity.CODE["t"]] == 2


def test_toxicity_finds_plain_and_hidden_words(spark):
    rng = random.Random(4)
    bad = ["moron", "scumbag", "idiot", "veqular", "vequton", "vequria"]
    rows, labels = [], []
    for i in range(400):
        toxic = rng.random() < 0.3
        words = prose(rng, rng.randrange(5, 60)).split()
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    hidden = [(1000, "then 1d10t reon"), (1001, "whor m0r0n thing"), (1002, "then i d i o t nded"), (1003, "then s.c.u.m.b.a.g reon"),
              (1004, "iiiidiot reon"), (1005, "vequnew thing")]
    clean = [(1100, "then a o i reon"), (1101, "thing 12:30 reon"), (1102, None), (1103, ""), (1104, "call a.b@c.de ation")]
    docs = spark.createDataFrame(rows + hidden + clean + [rows[0]], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, lab), ["doc_id"]).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert min(got[i] for i, _ in hidden) >= toxicity.TOXIC_AT > max(got[i] for i, _ in clean)
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert auc([got[i] for i, _ in held], [y for _, y in held]) > 0.97


def test_spaced_words_keep_their_borders_and_trailing_look_alikes_count():
    lm = model_of(["you are a stupid idiot and i say you scum are a loser with an ass piss off u moron this is a kiss of the class"] * 5)

    def words(text):
        return toxicity.spaced_words(text, text.split(), lm)
    assert "stupid" in words("you are a s t u p i d")
    assert "scum" in words("y o u s c u m")
    assert {"stupid", "scum"} <= set(words("s t u p i d  s c u m"))
    assert "moron" in words("u m o r o n") and "idiot" in words("i d i o o o t")
    assert "ass" in toxicity.token_words("a$$", lm) and "ass" in toxicity.token_words("a$$!!", lm)
    assert "piss" in toxicity.token_words("p!$$", lm) and toxicity.token_words("class.", lm) == ("class",)
