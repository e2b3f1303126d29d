"""Document quality by a byte-level convolutional network in numpy.

The whole text is cut into overlapping chunks of ``CHUNK`` bytes. In every
chunk, learned filters over ``WIDTH`` bytes are evaluated at every ``STRIDE``-th
position and max-pooled; a document's mean, largest and smallest pooled
activation of each filter are combined into one probability. A filter is a
table of one weight per byte value and offset, so a convolution is a sum of
``WIDTH`` table rows. Training (Adam on a bounded, documented sample, a fixed
number of steps and a fixed seed) costs the same for any corpus; scoring is one
pass over the documents in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import string_bytes
from .labelled import prior_shift, sigmoid, training_sample

CHUNK, HOP, WIDTH, STRIDE, FILTERS = 256, 224, 8, 2, 16
POSITIONS = (CHUNK - WIDTH) // STRIDE + 1
PER_CLASS = 1200
STEPS, BATCH = 400, 48
SHORT_SHARE = 0.25
KEEP_AT = 0.7


@dataclass
class Model:
    table: np.ndarray   # WIDTH x 256 x FILTERS; byte 0 is the padding and weighs nothing
    bias: np.ndarray    # FILTERS
    head: np.ndarray    # 3 * FILTERS + 1: mean, max, min over a document's chunks; size of its first chunk
    offset: float


def chunks_of(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover all bytes (n x CHUNK, zero padded; an empty text has one)."""
    n = max(1, -(-(len(text) - (CHUNK - HOP)) // HOP))
    data = np.zeros((n - 1) * HOP + CHUNK, np.uint8)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[::HOP]


def filled(n_bytes: int) -> float:
    """How empty a text leaves its first chunk: 0 from ``CHUNK`` bytes on, 1 for none."""
    return 1.0 - float(np.log1p(min(n_bytes, CHUNK)) / np.log1p(CHUNK))


def _responses(x: np.ndarray, table: np.ndarray, out: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    at = x.astype(np.intp)
    n = len(x)
    for j in range(WIDTH):
        idx = at[:, j:j + STRIDE * (POSITIONS - 1) + 1:STRIDE]
        if j == 0:
            np.take(table[j], idx, axis=0, out=out[:n], mode="clip")
        else:
            np.take(table[j], idx, axis=0, out=tmp[:n], mode="clip")
            out[:n] += tmp[:n]
    return out[:n]


def _buffers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.empty((n, POSITIONS, FILTERS), np.float32), np.empty((n, POSITIONS, FILTERS), np.float32)


def logits(texts: list[bytes], model: Model, batch: int = 64) -> np.ndarray:
    """The log-odds of every text; memory is bounded by the longest text and ``batch`` chunks."""
    bufs = _buffers(batch)
    out = np.empty(len(texts))
    held, owner, sums, highs, lows, counts = [], [], {}, {}, {}, {}

    def flush():
        x = np.concatenate(held)
        doc = np.concatenate(owner)
        for s in range(0, len(x), batch):
            m = np.tanh(_responses(x[s:s + batch], model.table, *bufs).max(axis=1) + model.bias)
            d = doc[s:s + batch]
            cuts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            add, hi, lo = np.add.reduceat(m, cuts), np.maximum.reduceat(m, cuts), np.minimum.reduceat(m, cuts)
            for k, i in enumerate(d[cuts].tolist()):
                if i in sums:
                    sums[i] += add[k]
                    np.maximum(highs[i], hi[k], out=highs[i])
                    np.minimum(lows[i], lo[k], out=lows[i])
                else:
                    sums[i], highs[i], lows[i] = add[k].astype(np.float64), hi[k].copy(), lo[k].copy()
        for i in sums:
            out[i] = np.concatenate([sums[i] / counts[i], highs[i], lows[i], [filled(len(texts[i]))]]) @ model.head + model.offset
        held.clear(), owner.clear(), sums.clear(), highs.clear(), lows.clear(), counts.clear()

    waiting = 0
    for i, t in enumerate(texts):
        c = chunks_of(t)
        held.append(c)
        owner.append(np.full(len(c), i))
        counts[i] = len(c)
        waiting += len(c)
        if waiting >= 16 * batch:
            flush()
            waiting = 0
    if held:
        flush()
    return out


def fit(texts: list[bytes], y: np.ndarray, share: float, seed: int = 7) -> Model:
    """Learns the filters and the head. With fewer than two classes the model
    answers the share of label 1 for every text."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32)
    table[:, 0] = 0
    p = [table, np.full(FILTERS, -1.0), np.zeros(3 * FILTERS + 1), np.zeros(1)]
    if len(set(y.tolist())) < 2:
        return Model(table, p[1].astype(np.float32), p[2], float(np.log(share / (1 - share))))
    def drawn(i):
        """A training text's chunks; for a quarter of the draws those of a short
        piece of it, as short texts are rare among the labelled ones."""
        t = texts[i]
        if rng.random() < SHORT_SHARE:
            n = int(rng.integers(16, CHUNK))
            a = int(rng.integers(0, max(1, len(t) - n + 1)))
            t = t[a:a + n]
        c = chunks_of(t)
        # a step's size is bounded: a very long text trains on a random subset of its chunks
        return c if len(c) <= 40 else c[np.sort(rng.choice(len(c), 40, replace=False))]

    m1 = [np.zeros_like(x, dtype=np.float64) for x in p]
    m2 = [np.zeros_like(x, dtype=np.float64) for x in p]
    ones, zeros = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    balance = prior_shift(np.array([0.0, 1.0]), share)
    for step in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(ones, BATCH // 2), rng.choice(zeros, BATCH // 2)])
        parts = [drawn(i) for i in pick]
        x = np.concatenate(parts)
        n = np.array([len(c) for c in parts])
        start = np.concatenate(([0], np.cumsum(n)[:-1]))
        r = _responses(x, p[0], *_buffers(len(x)))
        best = r.argmax(axis=1)
        h = np.tanh(np.take_along_axis(r, best[:, None, :], 1)[:, 0] + p[1])
        mean, hi, lo = np.add.reduceat(h, start) / n[:, None], np.maximum.reduceat(h, start), np.minimum.reduceat(h, start)
        full = np.array([[filled(np.count_nonzero(c[0]))] for c in parts])
        z = np.concatenate([mean, hi, lo, full], axis=1)
        err = (sigmoid(z @ p[2] + p[3][0]) - y[pick]) / len(pick)
        gz = err[:, None] * p[2][None]
        doc = np.repeat(np.arange(len(pick)), n)
        gh = (gz[:, :FILTERS] / n[:, None])[doc]
        for part, ext in ((gz[:, FILTERS:2 * FILTERS], hi), (gz[:, 2 * FILTERS:3 * FILTERS], lo)):
            hit = h == ext[doc]
            ties = np.add.reduceat(hit.astype(np.float64), start)
            gh = gh + hit * (part / ties)[doc]
        ga = gh * (1 - h * h)
        gt = np.zeros((WIDTH, 256 * FILTERS))
        f = np.arange(FILTERS)[None]
        who = np.arange(len(x))[:, None]
        for j in range(WIDTH):
            byte = x[who, best * STRIDE + j].astype(np.int64)
            gt[j] = np.bincount((byte * FILTERS + f).ravel(), ga.ravel(), 256 * FILTERS)
        gt = gt.reshape(WIDTH, 256, FILTERS)
        gt[:, 0] = 0
        grads = [gt, ga.sum(0), z.T @ err + 1e-4 * p[2], np.array([err.sum()])]
        rate = 0.02 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in enumerate(grads):
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            move = rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
            p[k] = (p[k] - move).astype(p[k].dtype)
    return Model(p[0], p[1].astype(np.float32), p[2], float(p[3][0] + balance))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    texts, y, share = training_sample(docs, labels, label, per_class)
    return fit([t.encode() for t in texts], y, share)


def score(docs: DataFrame, model: Model, keep: list[str], out: str = "score") -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` and ``out``, the probability
    of label 1 for the whole text. Null texts score as empty ones (one chunk of
    padding); equal texts score equal; a kept column named like ``out`` is
    replaced; an empty table gives an empty table."""
    keep = [c for c in keep if c != out]
    src = docs.select(*keep, F.col("text").cast("string").alias("_scored_text"))

    def run(batches):
        for b in batches:
            s = np.empty(b.num_rows)
            for i in range(0, b.num_rows, 1024):
                s[i:i + 1024] = sigmoid(logits(string_bytes(b.column(len(keep)).slice(i, 1024)), model))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(s)], [*keep, out])

    from pyspark.sql.types import DoubleType, StructField, StructType
    return src.mapInArrow(run, StructType([*src.schema.fields[:len(keep)], StructField(out, DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``at``, columns unchanged."""
    name = "_quality_score"
    while name in docs.columns:
        name += "_"
    return score(docs, train(docs, labels), docs.columns, name).filter(F.col(name) >= at).select(*docs.columns)
