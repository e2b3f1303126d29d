"""Toxicity of text that may be obfuscated: noisy-channel decoding, then scoring.

Writers hide words by look-alike symbols (``1d10t``), by spacing them out
(``s c u m``, ``s.c.u.m``) and by repeating letters (``loooser``). Every
suspicious span becomes a lattice: at each place the letters it may stand for,
or nothing (a space: nothing or a word border), with a channel cost. A Viterbi search under a character trigram
model of the corpus restores the likeliest spellings, which are scored together
with the plain words.

The language model counts the trigrams of *all* documents (one partial-sum
aggregate over a fixed alphabet, so the table is bounded whatever the corpus).
Word and prefix weights are log-odds from a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .labelled import prior_shift, sigmoid, training_sample

PER_CLASS = 2000
TOXIC_AT = 0.3
PREFIXES = (4, 5, 6)
MIN_SUPPORT = 3
STRONG = 4.0  # word weights above count twice
N_BEST = 4

# What a symbol may stand for, symbols that may be noise, the letters of the language model.
LOOK_ALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
NOISE = frozenset(".-_*~'\"`^,/\\#%&=:;<>[]{}?)")
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"

SIZE = 64
CODE = {c: i + 2 for i, c in enumerate(LETTERS)}  # 0: word border, 1: any other letter
LIKE_COST, SKIP_COST, NOISE_COST, REPEAT_COST = -0.7, -2.5, -0.2, -0.3
GAP_COST = -3.0  # a wider space that is no word border

_TABLE = np.array([CODE.get(chr(c).lower(), 1 if chr(c).isalpha() else 0) for c in range(0x10000)], np.uint8)


def trigram_counts(text: str) -> np.ndarray:
    """Dense SIZE^3 counts of letter trigrams over UTF-16 units; anything that
    is no letter is a word border. Borders in a row are not counted, so texts
    joined by two borders give the sum of their own counts."""
    code = _TABLE[np.frombuffer(f"  {text} ".encode("utf-16-le", "surrogatepass"), np.uint16)].astype(np.int64)
    counts = np.bincount((code[:-2] << 12) | (code[1:-1] << 6) | code[2:], minlength=SIZE ** 3)
    counts.reshape(SIZE, SIZE, SIZE)[:, 0, 0] = 0
    return counts


def corpus_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigram counts of all texts; SIZE^3 = 262,144 numbers at most reach the driver."""
    src = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null")

    def run(batches):
        total = np.zeros(SIZE ** 3, np.int64)
        for b in batches:
            held, n = [], 0
            for t in b.column(0).to_pylist():
                held.append(t)
                n += len(t)
                if n > 1_000_000:
                    total += trigram_counts("\n\n".join(held))
                    held, n = [], 0
            if held:
                total += trigram_counts("\n\n".join(held))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    got = src.mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SIZE ** 3, np.int64)
    out[got["gram"].to_numpy()] = got["n"].to_numpy()
    return out


class CharModel:
    """Interpolated trigram model: log P(c | a, b)."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        tri[0, 0] = tri[:, 0].sum(0)  # a word's first letter has nothing before its border
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1) / (uni.sum() + SIZE)
        p2 = (bi + 4 * p1) / (bi.sum(1, keepdims=True) + 4)
        self.logp = np.log((tri + 4 * p2[None]) / (tri.sum(2, keepdims=True) + 4)).astype(np.float32)

    def step(self, a: int, b: int, c: int) -> float:
        return float(self.logp[a, b, c])


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each run of equal symbols the strings it may stand for, with channel costs."""
    out, i = [], 0
    while i < len(span):
        ch, j = span[i], i
        while j < len(span) and span[j] == ch:
            j += 1
        n, i = j - i, j
        if ch in LOOK_ALIKES:
            opts = [(c * k, LIKE_COST * k + REPEAT_COST * (n - k)) for c in LOOK_ALIKES[ch] for k in {1, min(n, 2)}]
            out.append(opts if ch.isdigit() else [*opts, ("", SKIP_COST)])
        elif ch.isspace():
            out.append([("", NOISE_COST if n == 1 else GAP_COST), (" ", NOISE_COST)])
        elif ch in NOISE:
            out.append([("", NOISE_COST)])
        elif n >= 3:
            out.append([(ch, REPEAT_COST), (ch * 2, REPEAT_COST)])
        elif n == 2:
            out.append([(ch * 2, 0.0), (ch, 2 * REPEAT_COST)])
        else:
            out.append([(ch, 0.0)])
    return out


def decode(span: str, lm: CharModel, n_best: int = N_BEST) -> list[str]:
    """The ``n_best`` likeliest spellings of a span (Viterbi: states are the last
    two letters, the best prefixes of each are kept)."""
    states = {(0, 0): [(0.0, "")]}
    for options in lattice(span):
        new: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for (a, b), paths in states.items():
            for text, cost in options:
                x, y, add = a, b, cost
                for c in text:
                    k = 0 if c == " " else CODE.get(c, 1)
                    add += lm.step(x, y, k)
                    x, y = (y, k) if k else (0, 0)
                new.setdefault((x, y), []).extend((s + add, p + text) for s, p in paths)
        states = {k: sorted(set(v), reverse=True)[:n_best] for k, v in new.items()}
    ends = sorted(((s + lm.step(a, b, 0), p) for (a, b), v in states.items() for s, p in v), reverse=True)
    return list(dict.fromkeys(p for _, p in ends))[:n_best]


# Punctuation that is taken off a token's ends (look-alikes may begin a word).
_AFTER = ".,;:!?\"'()[]{}<>*#%&$…|»«“”’-_/\\=~`^"
_AFTER_SURE = "".join(c for c in _AFTER if c not in LOOK_ALIKES)
_BEFORE = ".,;:?\"')[]{}<>*#%&…»«“”‘-_/\\=~`^"
_RUN = re.compile(r"([^\W\d_])\1\1")
_SPACED = re.compile(r"(?<!\S)(?:\S[^\S\n]+){2,}\S(?!\S)")


def suspicious(core: str) -> bool:
    """Letters mixed with other symbols, or a letter at least three times in a row."""
    if core.isalpha():
        return _RUN.search(core) is not None
    return any(c.isalpha() for c in core)


def token_words(token: str, lm: CharModel) -> tuple:
    """A lower-cased token as scored: without the punctuation around it, and
    with the restored spellings if it is suspicious; look-alikes at its end are
    taken as punctuation, as letters, and as letters before exclamation marks."""
    core = token.rstrip(_AFTER).lstrip(_BEFORE)
    if not core:
        return ()
    wide = token.rstrip(_AFTER_SURE).lstrip(_BEFORE)
    forms = dict.fromkeys((core, wide.rstrip(_AFTER_SURE + "!"), wide))
    return tuple(dict.fromkeys([core, *(w for f in forms if suspicious(f) for w in decode(f, lm))]))


def spaced_words(low: str, tokens: list[str], lm: CharModel) -> list[str]:
    """Words of the restored spellings of runs of at least three single symbols:
    of a run as one word (letters repeated across spaces are one), and of a run
    whose spaces may be word borders."""
    if "111" not in "".join(["1" if len(t) == 1 else "0" for t in tokens]):
        return []
    runs = [m.group() for m in _SPACED.finditer(low)]
    return [w for run in runs for f in ("".join(run.split()), run) for path in decode(f, lm) for w in path.split()]


@dataclass
class Model:
    words: dict[str, float]
    prefixes: dict[str, float]
    slope: tuple[float, float]
    offset: float
    lm: CharModel

    def weight(self, word: str) -> float:
        v = self.words.get(word, 0.0)
        for n in PREFIXES:
            if len(word) >= n and (w := self.prefixes.get(word[:n], 0.0)) > v:
                v = w
        return v


def evidence(model: Model, cache_size: int = 1_000_000):
    """A function from a text to its largest word weight (0 where there is none)."""
    cache: dict[str, float] = {}

    def largest(text: str) -> float:
        low = text.lower()
        tokens = low.split()
        found = set(tokens)
        values = list(map(cache.get, found))
        if None in values:
            if len(cache) > cache_size:
                cache.clear()
            for t in found:
                if t not in cache:
                    cache[t] = max(map(model.weight, token_words(t, model.lm)), default=0.0)
            values = list(map(cache.get, found))
        return max([0.0, *values, *map(model.weight, spaced_words(low, tokens, model.lm))])

    return largest


def log_odds(x: float, model: Model) -> float:
    return model.slope[0] * x + model.slope[1] * max(0.0, x - STRONG) + model.offset


def _weights(texts: list[str], y: np.ndarray, lm: CharModel) -> tuple[dict, dict]:
    """Log-odds of the words and of the word prefixes that speak for label 1."""
    pos, neg = Counter(), Counter()
    for t, label in zip(texts, y):
        low = t.lower()
        tokens = low.split()
        words = {w for tok in set(tokens) for w in token_words(tok, lm)} | set(spaced_words(low, tokens, lm))
        (pos if label else neg).update(words | {(n, w[:n]) for w in words for n in PREFIXES if len(w) >= n})
    n1, n0 = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    words, prefixes = {}, {}
    for f, n in pos.items():
        if n >= MIN_SUPPORT:
            w = math.log((n + 0.5) / (n1 + 1)) - math.log((neg.get(f, 0) + 0.5) / (n0 + 1))
            if w > 1.0:
                w *= min(1.0, n / 10) ** 0.5
                if isinstance(f, tuple):
                    prefixes[f[1]] = w
                else:
                    words[f] = w
    return words, prefixes


def fit(texts: list[str], y: np.ndarray, share: float, lm: CharModel) -> Model:
    """Weights from every other sample row, calibration on the rest, then weights
    from all rows. With fewer than two classes every text scores the share."""
    if len(set(y.tolist())) < 2:
        return Model({}, {}, (0.0, 0.0), math.log(share / (1 - share)), lm)
    half = np.arange(len(y)) % 2 == 0
    first = Model(*_weights([t for t, h in zip(texts, half) if h], y[half], lm), (0.0, 0.0), 0.0, lm)
    find = evidence(first)
    x = np.array([[v, max(0.0, v - STRONG), 1.0] for v in (find(t) for t, h in zip(texts, half) if not h)])
    t, at = y[~half], np.array([0.8, 1.0, -3.0])
    b = at.copy()
    for _ in range(800):  # a ridge keeps separable data finite
        b -= 0.2 * (x.T @ (sigmoid(x @ b) - t) / max(1, len(t)) + 1e-3 * (b - at))
    words, prefixes = _weights(texts, y, lm)
    return Model(words, prefixes, (max(b[0], 0.1), max(b[1], 0.0)), float(b[2] + prior_shift(t, share)), lm)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    lm = CharModel(corpus_trigrams(docs))
    texts, y, share = training_sample(docs, labels, label, per_class)
    return fit(texts, y, share, lm)


def score(docs: DataFrame, model: Model, keep: list[str], out: str = "score") -> DataFrame:
    """The ``keep`` columns of every row and ``out``, the probability of label 1
    for the whole text. Null and empty texts hold no evidence and score the
    offset; equal texts score equal; a kept column named like ``out`` is
    replaced; an empty table gives an empty table."""
    keep = [c for c in keep if c != out]
    src = docs.select(*keep, F.col("text").cast("string").alias("_scored_text"))

    def run(batches):
        find = evidence(model)
        for b in batches:
            s = np.fromiter((log_odds(find(t.as_py() or ""), model) for t in b.column(len(keep))), np.float64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(sigmoid(s))], [*keep, out])

    return src.mapInArrow(run, StructType([*src.schema.fields[:len(keep)], StructField(out, DoubleType())]))
