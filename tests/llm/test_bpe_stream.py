import hashlib
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallycast.llm import bpe_stream

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as f:
        return bpe_stream.Vocabulary(f.read())


@pytest.fixture(scope="module")
def theirs():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(t, text):
    return t.encode(text, add_special_tokens=False).ids


ODD = ["<|endoftext|>", "<|startoftext|>", "<|endof", "|>", "'s", "'", "'re", "'LL", "''t", "\x1c", "\x00", "\x85", " ", "​", "　",
       "É", "É", "́", "̈́", "İ", "ΣΑΣ", "ß", "ﬁ", "²", "Ⅷ", "١٢", "한국", "한", "日本語", "😀", "👩‍👧", "�",
       "!!", "...", "--", "a" * 30, "1234", "don't", "we'LL", "x_y", "\n", " ", "  ", "\t"]


def odd_text(rng, n):
    return "".join(rng.choice(ODD) if rng.random() < 0.5 else "".join(rng.choice("abcdefghiorstuvwxyzABZ  ,.'é") for _ in range(rng.randrange(1, 9)))
                   for _ in range(n))


def test_every_character_is_encoded_as_the_library_does(ours, theirs):
    chars = [chr(c) for c in range(0x32000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    rows = ["a" + "b".join(chars[i:i + 40]) + " " + " ".join(chars[i:i + 40]) for i in range(0, len(chars), 40)]
    for text, e in zip(rows, theirs.encode_batch(rows, add_special_tokens=False)):
        if list(bpe_stream.encode_text(ours, text)) != e.ids:
            wrong = [hex(ord(c)) for c in dict.fromkeys(text) if list(bpe_stream.encode_text(ours, f"a{c}b")) != ids_of(theirs, f"a{c}b")]
            raise AssertionError(wrong or text)


def test_mixed_texts_are_encoded_as_the_library_does(ours, theirs, monkeypatch):
    rng = random.Random(3)
    texts = [odd_text(rng, rng.randrange(0, 60)) for _ in range(1500)]
    want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert [list(bpe_stream.encode_text(ours, t)) for t in texts] == want
    monkeypatch.setattr(bpe_stream, "PIECE", 40)
    monkeypatch.setattr(bpe_stream, "SHORT", 4)
    ours.runs.clear()
    assert [list(bpe_stream.encode_text(ours, t)) for t in texts] == want
    ours.runs.clear()


def test_words_merged_together_equal_words_merged_alone(ours, theirs):
    rng = random.Random(8)
    words = ["".join(rng.choice("aeinorstlé日") for _ in range(rng.randrange(1, 30))) for _ in range(3000)] + ["a", "é", "aaaaaaaa", "abababab"]
    words = list(dict.fromkeys(words))
    want = [tuple(e.ids) for e in theirs.encode_batch(words, add_special_tokens=False)]
    assert ours._merge_all(words) == want and ours._merge_all([]) == []
    ours.runs.clear()
    ours.words.clear()
    runs = {"it's", "<|endoftext|>x", "x" * 500, "a,b", "ÀB", "\x1cq"}
    ours.learn(runs)
    assert all(list(ours.runs[r]) == ids_of(theirs, r) for r in runs) and "a,b" in ours.runs and "x" * 500 not in dict(ours.runs)


def test_the_transducer_in_pieces_equals_the_library_on_unbroken_runs(ours, theirs):
    rng = random.Random(4)
    words = list(ours.ids)
    runs = ["a" * 5000, "ab" * 2000, "th" * 3000 + "e", "=" * 4000, "日" * 1500, "😀" * 700, "é" * 2000, "hahaha" * 500 + "h"]
    runs += ["".join(rng.choice("etaoinsh") for _ in range(3000)) for _ in range(6)]
    runs += ["".join(w.removesuffix("</w>") for w in rng.choices(words, k=600) if w.removesuffix("</w>").isascii() and w.removesuffix("</w>").isalpha())
             for _ in range(6)]
    for run in runs:
        want = ids_of(theirs, run)
        for step in (1, 64):
            t, got, at, held = bpe_stream.Transducer(ours, step), [], 0, 0
            while at < len(run):
                n = rng.randrange(1, 200)
                got += t.feed(run[at:at + n])
                held, at = max(held, len(t.symbols)), at + n
            assert got + t.close() == want and held <= ours.lookahead + 4 * step + 40


def test_lookahead_is_needed_and_suffices():
    # by hand: with merges ab < bc < xa, adding c changes nothing; "x a b": a+b first, so x stays alone
    import json
    merges = [["b", "c"], ["a", "b"], ["x", "a"]]
    spec = {"model": {"vocab": {t: i for i, t in enumerate(["a", "b", "c", "x", "bc", "ab", "xa"])}, "merges": merges}}
    v = bpe_stream.Vocabulary(json.dumps(spec).encode())
    assert v.merged(list("xab")) == ["x", "ab"] and v.merged(list("xabc")) == ["xa", "bc"]
    assert v.lookahead == 3  # b + c takes b from a + b, which leaves a to x
    spec["model"]["merges"] = [["ab", "c"], ["a", "b"]]
    with pytest.raises(ValueError):
        bpe_stream.Vocabulary(json.dumps(spec).encode())


def test_decoding(ours, theirs):
    rng = random.Random(6)
    for _ in range(300):
        text = odd_text(rng, rng.randrange(0, 40))
        ids = ids_of(theirs, text)
        d = bpe_stream.Decoder(ours, True)
        cut = rng.randrange(0, len(ids) + 1)
        assert d.feed(ids[:cut]) + d.feed(ids[cut:]) + d.close() == theirs.decode(ids, skip_special_tokens=False)
    text = "the 日本語 😀 naïve café don't"
    d = bpe_stream.Decoder(ours, False)
    parts = [d.feed([i]) for i in ids_of(theirs, text)] + [d.close()]
    assert "".join(parts) == "the 日本語 😀 naïve café don 't "
    d = bpe_stream.Decoder(ours, False)
    assert d.feed([i for i in ids_of(theirs, "日")][:1]) + d.close() in ("日 ", "�", "日")


def test_columns_nulls_and_long_texts(spark, theirs):
    rows = [(1, "Hello world", 5, "x"), (2, None, 6, None), (3, "", 7, "y"), (3, " \n\t", 7, "y"), (None, "z" * 200_000 + " " + "ab " * 50_000, 8, ""),
            (1, "Hello world", 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, _encoded_ids string")
    got = bpe_stream.decode(bpe_stream.encode(df, PATH), PATH)
    assert got.columns == ["doc_id", "text", "_encoded_ids", "ids", "decoded"]
    back = got.collect()
    assert len(back) == 6
    for r in back:
        want = ids_of(theirs, r.text or "")
        assert r.ids == want and r.decoded == theirs.decode(want, skip_special_tokens=False)
    assert bpe_stream.encode(df.limit(0), PATH).collect() == []


def test_query_digests(spark, theirs):
    from tallycast.llm.queries import REGISTRY
    got = {r.doc_id: r for r in REGISTRY["op12_streaming_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = ids_of(theirs, r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
