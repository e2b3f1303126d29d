"""Phrase collocations by tries of candidates that are matched at all positions at once.

Texts are cut into pieces and words; every word becomes the 64-bit hash of its
language and itself, so whatever follows works on integer arrays and keeps the
languages apart. The texts are read once: runs of words are stored as codes of
their own small vocabulary. Four passes, all of them partitioned by Spark:

1. words: exact counts per language (partial counts a task, one shuffle);
2. pair candidates: neighbours that are both frequent words (Apriori: a phrase
   is no more frequent than its parts), and whose partial counts reach the minimum;
3. triple candidates: neighbours whose two pairs are both pair candidates;
4. counting: the candidates of a block become a double-array trie, which is
   broadcast. numpy advances the states of all text positions together, level
   by level, and ``bincount``s the accepting states; Spark sums the shards.

What is broadcast is bounded: the filters of scans 2 and 3 are bitmaps of
``Limits.slots`` bits (hash collisions only add candidates), and a trie holds
about ``Limits.block`` candidates; more candidates are counted in more scans.
"""

from __future__ import annotations

import math
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, stored, string_bytes

MIN_COUNT = 10
TOP = 2000
COVER_PERCENT = 50       # a longer candidate with at least this share of the occurrences absorbs
PART = 1 << 20           # bytes of a text that are split at a time
NO_LANG = "und"
MANY = 8                 # children of a trie node that is placed by itself
BUCKET_BITS = 20
BATCH_BYTES = 8 << 20

# Letters that are lowered, symbols that end a piece, symbols that part words.
_UPPER, _ENDS, _GAPS = bytes(range(65, 91)), b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_MAP = bytes.maketrans(_UPPER + _ENDS + _GAPS, _UPPER.lower() + b"\n" * len(_ENDS) + b" " * len(_GAPS))
_BREAK = b"\xff"  # no byte of UTF-8


@dataclass(frozen=True)
class Limits:
    """Bounds of memory; they do not change results."""

    flush: int = 1 << 20    # words of a stored run, at most 2^20
    cache: int = 1 << 18    # distinct words that a task remembers between runs
    slots: int = 1 << 24    # bits of a candidate filter
    block: int = 500_000    # candidates of a trie


def words_of(text: bytes):
    """Lists of the words of a text in order, ``_BREAK`` between pieces; a long
    text comes in several lists, cut where a piece or a word ends."""
    at, n = 0, len(text)
    while at < n:
        end = at + PART
        if end < n:
            tail = text[at:end].translate(_MAP)
            cut = max(tail.rfind(b" "), tail.rfind(b"\n"))
            while cut < 0 and end < n:  # a word longer than a part
                end = min(n, end + PART)
                tail = text[at:end].translate(_MAP)
                cut = max(tail.rfind(b" "), tail.rfind(b"\n"))
            end = at + cut + 1 if cut >= 0 and end < n else end
        yield text[at:end].translate(_MAP).replace(b"\n", b" " + _BREAK + b" ").split()
        at = end


class _Codes(dict):
    """Word to code within one language; code 0 is a break. ``hashes`` holds the
    signed 64-bit hash of every code, ``words`` its language and word."""

    def __init__(self, lang: str, seed: int, hashes: array, words: list):
        super().__init__({_BREAK: 0})
        self.lang, self.seed, self.hashes, self.words = lang, seed, hashes, words
        self.head = f"{len(lang.encode())}:{lang}:".encode()

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(self.head + word, self.seed)
        self.hashes.append((h - (1 << 64) if h >= 1 << 63 else h) or 1)
        self.words.append((self.lang, word))
        code = self[word] = len(self.words) - 1
        return code


_STORED = pa.schema([("codes", pa.binary()), ("vocabulary", pa.binary()), ("skip", pa.int32()),
                     ("h", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])


def _row(codes: array, skip: int, hashes: array, counts: np.ndarray) -> pa.RecordBatch:
    """A stored run of words: codes of its own vocabulary (code 0: break); the
    first ``skip`` words are the end of the run before, repeated as context."""
    ids = np.frombuffer(codes, np.int32)
    own = np.bincount(ids, minlength=len(hashes))
    own[0] += 1
    used = np.flatnonzero(own)
    at = np.zeros(len(own), np.uint32)
    at[used] = np.arange(len(used))
    counts[:len(own)] += np.bincount(ids[skip:], minlength=len(own))
    return pa.RecordBatch.from_arrays([pa.array([at[ids].tobytes()], pa.binary()), pa.array([np.frombuffer(hashes, np.int64)[used].tobytes()], pa.binary()),
                                       pa.array([skip], pa.int32()), *[pa.nulls(1, f.type) for f in list(_STORED)[3:]]], schema=_STORED)


def _counted(hashes: array, words: list, counts: np.ndarray) -> pa.RecordBatch:
    """The counts of a task's words so far."""
    at = np.flatnonzero(counts[1:len(words)]) + 1
    said = [words[i] for i in at]
    return pa.RecordBatch.from_arrays([*[pa.nulls(len(at), f.type) for f in list(_STORED)[:3]], pa.array(np.frombuffer(hashes, np.int64)[at]),
                                       pa.array([w[0] for w in said], pa.string()), pa.array([w[1] for w in said], pa.binary()), pa.array(counts[at])], schema=_STORED)


def encoded(batches, seed: int, limits: Limits):
    """Stored runs of about ``limits.flush`` words, and word counts whenever the
    task's vocabulary is emptied, from batches of (lang, text)."""
    def fresh():
        return array("q", [0]), [None], {}, np.zeros(limits.flush + limits.cache + 2, np.int64)

    hashes, words, caches, counts = fresh()
    held, skip = array("i"), 0

    def grown() -> np.ndarray:
        return counts if len(words) <= len(counts) else np.append(counts, np.zeros(len(words), np.int64))

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), string_bytes(b.column(1))):
            for some in words_of(text):
                for i in range(0, len(some), limits.flush):
                    cache = caches.get(lang)
                    if cache is None:
                        cache = caches[lang] = _Codes(lang, seed, hashes, words)
                    held.extend(map(cache.__getitem__, some[i:i + limits.flush]))
                    if len(held) < limits.flush:
                        continue
                    counts = grown()
                    yield _row(held, skip, hashes, counts)
                    held = held[-2:]
                    skip = len(held)
                    if len(words) > limits.cache:
                        yield _counted(hashes, words, counts)
                        context = [(hashes[c], words[c]) for c in held]
                        hashes, words, caches, counts = fresh()
                        held = array("i")
                        for h, said in context:  # the context keeps its words under new codes
                            if said is None:
                                held.append(0)
                            else:
                                held.append(caches.setdefault(said[0], _Codes(said[0], seed, hashes, words))[said[1]])
            held.append(0)
    if len(held) > skip:
        counts = grown()
        yield _row(held, skip, hashes, counts)
    yield _counted(hashes, words, counts)


def _runs(batches):
    """(codes, vocabulary, skip) of stored runs."""
    for b in batches:
        for codes, vocabulary, skip in zip(b.column(0), b.column(1), b.column(2).to_pylist()):
            yield np.frombuffer(codes.as_buffer(), np.uint32).astype(np.int64), np.frombuffer(vocabulary.as_buffer(), np.int64), skip


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode_words(docs: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """(the stored runs, (h, lang, word, n) of all words). Should two words share
    a hash, the next seed is taken."""
    for seed in range(100):
        def run(batches, seed=seed):
            yield from encoded(batches, seed, limits)

        both = stored(_texts(docs).mapInArrow(run, "codes binary, vocabulary binary, skip int, h long, lang string, word binary, n long"), "runs")
        words = both.filter("h IS NOT NULL").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))
        words = stored(words.withColumn("word", F.col("word").cast("string")), "words")
        if not words.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count():
            return both.filter("codes IS NOT NULL").select("codes", "vocabulary", "skip"), words
    raise RuntimeError("no hash seed keeps all words apart")


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a.view(np.uint64) * _M1) ^ ((b.view(np.uint64) ^ (b.view(np.uint64) >> np.uint64(29))) * _M2)
    return x ^ (x >> np.uint64(32))


def _slots(h: np.ndarray, slots: int) -> np.ndarray:
    return (h.view(np.uint64) & np.uint64(slots - 1)).astype(np.int64)


def _filter_of(found: DataFrame, hashes: list[str], slots: int):
    """Broadcast bitmap of the slots of ``found``'s words or pairs: at most ``slots`` numbers reach the driver."""
    def run(batches):
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            at = _slots(cols[0] if len(cols) == 1 else _mix(cols[0], cols[1]), slots)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at).astype(np.int32))], ["slot"])

    bits = np.zeros(slots, bool)
    bits[found.select(*hashes).mapInArrow(run, "slot int").distinct().toArrow()["slot"].to_numpy()] = True
    return found.sparkSession.sparkContext.broadcast(np.packbits(bits))


def _partial_counts(codes: list[np.ndarray], vocabulary: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row per distinct tuple of words with its number; codes are below 2^21, so a tuple is one number."""
    size = len(vocabulary)
    key = codes[0]
    for c in codes[1:]:
        key = key * size + c
    key, n = np.unique(key, return_counts=True)
    cols = []
    for _ in codes:
        cols.append(vocabulary[key % size])
        key = key // size
    return pa.RecordBatch.from_arrays([*map(pa.array, reversed(cols)), pa.array(n.astype(np.int64))], names)


def pair_candidates(runs: DataFrame, words: DataFrame, min_count: int, limits: Limits) -> DataFrame:
    """(h1, h2): neighbouring frequent words found ``min_count`` times."""
    known = _filter_of(words, ["h"], limits.slots)

    def run(batches):
        bits = np.unpackbits(known.value).view(bool)
        for codes, vocabulary, skip in _runs(batches):
            codes = codes[max(skip - 1, 0):]
            ok = (bits[_slots(vocabulary, limits.slots)] & (vocabulary != 0))[codes]
            at = np.flatnonzero(ok[:-1] & ok[1:])
            yield _partial_counts([codes[at], codes[at + 1]], vocabulary, ["h1", "h2", "n"])

    found = runs.mapInArrow(run, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    return stored(found.filter(F.col("n") >= min_count).select("h1", "h2"), "pairs")


def triple_candidates(runs: DataFrame, pairs: DataFrame, min_count: int, limits: Limits) -> DataFrame:
    """(h1, h2, h3): both pairs are candidates, found ``min_count`` times."""
    known = _filter_of(pairs, ["h1", "h2"], limits.slots)

    def run(batches):
        bits = np.unpackbits(known.value).view(bool)
        for codes, vocabulary, skip in _runs(batches):
            codes = codes[max(skip - 2, 0):]
            seq = vocabulary[codes]
            pair = bits[_slots(_mix(seq[:-1], seq[1:]), limits.slots)] & (seq[:-1] != 0) & (seq[1:] != 0)
            at = np.flatnonzero(pair[:-1] & pair[1:])
            yield _partial_counts([codes[at], codes[at + 1], codes[at + 2]], vocabulary, ["h1", "h2", "h3", "n"])

    found = runs.mapInArrow(run, "h1 long, h2 long, h3 long, n long").groupBy("h1", "h2", "h3").agg(F.sum("n").alias("n"))
    return stored(found.filter(F.col("n") >= min_count).select("h1", "h2", "h3"), "triples")


@dataclass
class Trie:
    """Double array over word codes: the child of slot s by code c lies at
    ``base[s] + c`` if ``check`` there is s. Slot 0 is the root."""

    symbols: np.ndarray  # word hashes, sorted as unsigned numbers
    codes: np.ndarray    # code of each, from 1
    starts: np.ndarray   # where the symbols of every bucket of hashes (their upper bits) begin
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray   # number of the candidate that ends at a slot, or -1
    ends: np.ndarray     # slot of each candidate

    def code(self, seq: np.ndarray) -> np.ndarray:
        """Codes of words; 0, which leads nowhere, for breaks and words outside the trie."""
        bucket = (seq.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        out = np.zeros(len(seq), np.int32)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        open_ = np.flatnonzero((at < end) & (seq != 0))
        at, end = at[open_], end[open_]
        while len(open_):
            hit = self.symbols[at] == seq[open_]
            out[open_[hit]] = self.codes[at[hit]]
            go = ~hit & (at + 1 < end)
            open_, at, end = open_[go], at[go] + 1, end[go]
        return out

    def phrases(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Word hashes of candidates, first word first, 0 where there is no third."""
        by_code = np.zeros(len(self.codes) + 1, np.int64)
        by_code[self.codes] = self.symbols
        back, at = [], self.ends[numbers].astype(np.int64)
        for _ in range(3):
            up = self.check[at]
            back.append(np.where(at > 0, by_code[np.where(at > 0, at - self.base[up], 0)], 0))
            at = np.where(at > 0, up, 0)
        two = back[2] == 0
        return [np.where(two, back[1], back[2]), np.where(two, back[0], back[1]), np.where(two, 0, back[0])]


def build_trie(h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> Trie:
    """The trie of distinct candidates (h3 = 0: of two words). Nodes with many
    children get the first base that fits, nodes with one child any free slot."""
    third = h3 != 0
    symbols = np.unique(np.concatenate([h1, h2, h3[third]]).view(np.uint64))
    if not len(symbols):
        symbols = np.zeros(1, np.uint64)
    starts_of = np.searchsorted(symbols, np.arange(1 << BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS))
    h1, h2, h3 = (h.view(np.uint64) for h in (h1, h2, h3))
    rows = np.stack([np.searchsorted(symbols, h) for h in (h1, h2)] + [np.where(third, np.searchsorted(symbols, h3), -1)])
    # frequent children get small codes, so that the children of most nodes lie close together
    uses = np.bincount(rows[1:][rows[1:] >= 0], minlength=len(symbols))
    codes = np.empty(len(symbols), np.int64)
    codes[np.argsort(-uses, kind="stable")] = np.arange(1, len(symbols) + 1)
    c1, c2, c3 = codes[rows[0]], codes[rows[1]], np.where(third, codes[rows[2]], 0)
    span = len(symbols) + 1

    size = 2 * len(h1) + 2 * span + 1024
    base, check = np.zeros(size + span, np.int32), np.full(size + span, -1, np.int32)
    free = np.ones(size, bool)
    free[0], check[0] = False, -2

    def grow() -> None:
        nonlocal base, check, free, size
        base = np.append(base, np.zeros(size, np.int32))
        check = np.append(check, np.full(size, -1, np.int32))
        free = np.append(free, np.ones(size, bool))
        size *= 2

    def place(parents: np.ndarray, kids: np.ndarray) -> None:
        """Gives the children ``kids`` (codes, grouped by parent slot) their slots."""
        starts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        counts = np.diff(np.append(starts, len(parents)))
        order = np.argsort(-counts, kind="stable")

        def first_fit(nodes) -> None:
            low = 0
            for i in nodes:
                c, at = kids[starts[i]:starts[i] + counts[i]], low
                while True:
                    while at + 4096 + span >= size:
                        grow()
                    fit = np.arange(at, at + 4096)
                    for code in c:
                        fit = fit[free[fit + code]]
                        if not len(fit):
                            break
                    if len(fit):
                        break
                    at += 4096
                    low = max(low, at)
                slot, p = fit[0] + c, parents[starts[i]]
                base[p], free[slot], check[slot] = fit[0], False, p

        def by_lot(nodes: np.ndarray) -> np.ndarray:
            """Random bases for all nodes at once, again for those that clash; the nodes left after 100 rounds."""
            rng = np.random.default_rng(len(nodes))
            while len(nodes) and 2.5 * (free.size - np.count_nonzero(free) + counts[nodes].sum()) > free.size:
                grow()
            for _ in range(100):
                if not len(nodes):
                    break
                at = rng.integers(0, size - span, len(nodes))
                which = np.repeat(np.arange(len(nodes)), counts[nodes])
                kid = np.arange(len(which)) - np.repeat(np.cumsum(counts[nodes]) - counts[nodes], counts[nodes]) + np.repeat(starts[nodes], counts[nodes])
                slot = at[which] + kids[kid]
                owner = np.full(size, -1, np.int32)
                owner[slot] = which
                bad = np.zeros(len(nodes), bool)
                bad[which[~free[slot] | (owner[slot] != which)]] = True
                fits = ~bad[which]
                base[parents[starts[nodes[~bad]]]] = at[~bad]
                check[slot[fits]] = parents[kid[fits]]
                free[slot[fits]] = False
                nodes = nodes[bad]
            return nodes

        first_fit(order[counts[order] > MANY])
        first_fit(by_lot(order[(counts[order] > 1) & (counts[order] <= MANY)]))
        ones = starts[counts == 1]
        while len(spare := np.flatnonzero(free)[:len(ones)]) < len(ones):
            grow()
        base[parents[ones]] = spare - kids[ones]
        free[spare], check[spare] = False, parents[ones]

    def groups(parent: np.ndarray, kid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = np.unique(parent * span + kid)
        return both // span, both % span

    if len(h1):
        place(*groups(np.zeros(len(c1), np.int64), c1))
        s1 = base[0] + c1
        place(*groups(s1, c2))
        s2 = base[s1] + c2
        if third.any():
            place(*groups(s2[third], c3[third]))
        ends = np.where(third, base[s2] + c3, s2)
    else:
        ends = np.zeros(0, np.int64)
    used = int(np.flatnonzero(check != -1)[-1]) + 1 + span  # no base plus code lies beyond
    accept = np.full(min(used, len(base)), -1, np.int32)
    accept[ends] = np.arange(len(ends))
    return Trie(symbols.view(np.int64), codes.astype(np.int32), np.append(starts_of, len(symbols)).astype(np.int32),
                base[:used].copy(), check[:used].copy(), accept, ends.astype(np.int32))


def count_states(trie: Trie, codes: np.ndarray, vocabulary: np.ndarray, skip: int, counts: np.ndarray) -> None:
    """Adds the accepted states of all positions of a run to ``counts``; matches
    that end within the first ``skip`` words were counted before."""
    code = trie.code(vocabulary)[codes]
    at = np.flatnonzero(code)
    state = np.zeros(len(at), np.int32)
    for level in range(3):
        inside = at + level < len(code)
        at, state = at[inside], state[inside]
        c = code[at + level]
        new = trie.base[state] + c
        go = (c != 0) & (trie.check[new] == state)
        at, state = at[go], new[go]
        seen = trie.accept[state[at + level >= skip]]
        counts += np.bincount(seen[seen >= 0], minlength=len(counts))


def count_candidates(runs: DataFrame, candidates: DataFrame, min_count: int, limits: Limits) -> DataFrame:
    """(h1, h2, h3, a): exact counts of the stored candidates with ``min_count`` occurrences."""
    spark = runs.sparkSession
    blocks = max(1, math.ceil(candidates.count() / limits.block))
    parts = candidates.withColumn("_block", F.pmod(F.xxhash64("h1", "h2", "h3"), F.lit(blocks)))
    counted = None
    for k in range(blocks):
        got = parts.filter(F.col("_block") == k).select("h1", "h2", "h3").toArrow()
        trie = build_trie(*(got[c].to_numpy() for c in ("h1", "h2", "h3")))
        del got
        shared = spark.sparkContext.broadcast(trie)
        del trie

        def run(batches, shared=shared):
            trie = shared.value
            counts = np.zeros(len(trie.ends), np.int64)
            for codes, vocabulary, skip in _runs(batches):
                count_states(trie, codes, vocabulary, skip, counts)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["phrase", "n"])

        def name(batches, shared=shared):
            for b in batches:
                h = shared.value.phrases(b.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([*map(pa.array, h), b.column(1)], ["h1", "h2", "h3", "a"])

        sums = runs.mapInArrow(run, "phrase int, n long").groupBy("phrase").agg(F.sum("n").alias("a"))
        named = stored(sums.filter(F.col("a") >= min_count).mapInArrow(name, "h1 long, h2 long, h3 long, a long"), "counted")
        shared.unpersist()
        counted = named if counted is None else counted.unionByName(named)
    return counted


def _score(a: str, l: str, r: str) -> Column:
    """floor(1000000 a a / (l r)) in decimals of 38 digits, which holds counts up to 10^15."""
    return F.expr(f"(1000000BD * CAST({a} AS DECIMAL(16,0)) * CAST({a} AS DECIMAL(16,0))) "
                  f"div (CAST({l} AS DECIMAL(16,0)) * CAST({r} AS DECIMAL(16,0)))").cast("long")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, cover_percent: int = COVER_PERCENT,
                 limits: Limits = Limits()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two or
    three words of every language.

    ``docs`` needs ``lang`` and ``text``; other columns are ignored, whatever
    their names. A null language is ``und``, a null text empty. Repeated rows
    count as often as they come. Ties in score and count go by phrase in byte
    order, so the result is the same on every run. Long texts are split part by
    part, phrases across parts included. An empty table, and a language without
    a phrase of ``min_count`` occurrences, give no rows.
    """
    bounded_batches(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))  # a stored run is megabytes
    runs, words = encode_words(docs, limits)
    common = words.filter(F.col("n") >= min_count)
    pairs = pair_candidates(runs, common, min_count, limits)
    triples = triple_candidates(runs, pairs, min_count, limits)
    both = pairs.withColumn("h3", F.lit(0).cast("long")).unionByName(triples)
    counted = count_candidates(runs, both, min_count, limits)

    two = counted.filter("h3 = 0").select("h1", "h2", "a")
    three = counted.filter("h3 != 0")
    one = common.select("h", "n", "word")

    def word(i: int) -> DataFrame:
        return one.select(F.col("h").alias(f"h{i}"), F.col("n").alias(f"n{i}"), F.col("word").alias(f"w{i}"))

    covered = (three.select("h1", "h2", "a").unionByName(three.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
               .groupBy("h1", "h2").agg(F.max("a").alias("longer")))
    lang = common.select(F.col("h").alias("h1"), "lang")
    cut2 = (two.join(covered, ["h1", "h2"], "left").filter(f"longer IS NULL OR 100 * longer < {int(cover_percent)} * a")
            .join(word(1), "h1").join(word(2), "h2")
            .select("h1", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"),
                    _score("a", "n1", "n2").alias("score")))
    cut3 = (three.join(two.select("h1", "h2", F.col("a").alias("a12")), ["h1", "h2"])
            .join(two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("a23")), ["h2", "h3"])
            .join(word(1), "h1").join(word(2).drop("n2"), "h2").join(word(3), "h3")
            .withColumns({"s1": _score("a", "n1", "a23"), "s2": _score("a", "a12", "n3")})
            .select("h1", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                    F.when(F.col("s1") <= F.col("s2"), F.col("n1")).otherwise(F.col("a12")).alias("l"),
                    F.when(F.col("s1") <= F.col("s2"), F.col("a23")).otherwise(F.col("n3")).alias("r"),
                    F.least("s1", "s2").alias("score")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    best = (cut2.unionByName(cut3).join(lang, "h1").drop("h1")
            .withColumn("rank", rank).filter(F.col("rank") <= top))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
