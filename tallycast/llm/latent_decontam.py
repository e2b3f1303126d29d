"""Benchmark decontamination by latent semantic retrieval.

1. Words of the benchmark items are the vocabulary; every document becomes the
   sequence of its words' numbers (-1 elsewhere), written once. Other words are
   orthogonal to every query and never match, so nothing is lost by that.
2. Passages are ``PASSAGE`` words. Their TF-IDF matrix A (all documents' passages
   x vocabulary) gets a distributed randomised SVD: tasks sum A'(A Omega) for
   a Gaussian Omega; with Q, an orthonormal basis of the sum, tasks sum
   (AQ)'(AQ), whose eigenvectors rotate Q to the leading right singular vectors.
   Only vocabulary x rank numbers reach the driver. The latent space is whitened
   (divided by the singular values): else the words that all passages share make
   all passages alike.
3. Every passage (overlapping by half) is searched in the latent space: items'
   passages with a large cosine, and a large enough share of the query's length,
   become candidates, and stay so if they share enough of the query's whole
   TF-IDF weight. The items are the stated query set, taken in blocks.
4. Around a candidate the longest common subsequence of words must reach
   ``LCS_SHARE`` of the item, and ``ANSWER_SHARE`` of the item's answer, its last
   sentence: paraphrases pass, texts that share topic words do not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import free_names, stored

PASSAGE, STEP = 32, 16
RANK, OVERSAMPLE = 64, 8
COSINE, COVER, WEIGHT_SHARE = 0.4, 0.35, 0.4
LCS_SHARE, ANSWER_SHARE = 0.6, 0.6
ITEM_BLOCK = 512
WORD_BLOCK = 1024
GROUP_WORDS = 100_000  # words of documents that a task works on at a time
SEED = 8

def word_forms(tokens: pa.Array) -> pa.Array:
    """Lower-case letters and digits of every token; empty where it has none."""
    return pc.replace_substring_regex(pc.utf8_lower(tokens), r"[^\p{L}\p{N}]+", "")


def words_of(text: str) -> list[str]:
    return [w for w in word_forms(pc.utf8_split_whitespace(pa.array([text])).flatten()).to_pylist() if w]


def answer_of(text: str) -> list[str]:
    """The words of the last sentence; of the last third, where there is only one."""
    parts = [words_of(s) for s in re.split(r"(?<=[.!?])\s+", text.strip())]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        return parts[-1]
    every = parts[0] if parts else []
    return every[-max(1, len(every) // 3):] if every else []


class Queries:
    """A block of benchmark items: vocabulary, word numbers, answers."""

    def __init__(self, items: list[tuple]):
        self.ids, self.vocab, self.words, self.answers = [], {}, [], []
        for item_id, text in items:
            ws = words_of(text or "")
            if ws:
                self.ids.append(item_id)
                self.words.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in ws], np.int32))
                self.answers.append(np.array([self.vocab[w] for w in answer_of(text)], np.int32))
        # an item is searched by its passages; a short rest belongs to the last one
        self.pieces = []
        for k, w in enumerate(self.words):
            cuts = [*range(0, max(1, len(w) - PASSAGE // 2), PASSAGE), len(w)]
            self.pieces += [(k, a, b) for a, b in zip(cuts, cuts[1:])]

    def vectors(self, basis: np.ndarray, idf: np.ndarray) -> np.ndarray:
        rows = [(basis[self.words[k][a:b]] * idf[self.words[k][a:b], None]).sum(0) for k, a, b in self.pieces]
        return np.array(rows, np.float32).reshape(len(rows), basis.shape[1])


def encode(docs: DataFrame, vocab: dict[str, int]) -> DataFrame:
    """(doc_id, h, words): the vocabulary numbers of every row's words, as int32 bytes, and the text's hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))
    words = list(vocab)  # in the order of their numbers

    def run(batches):
        known = pa.array(words, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds the tokens held at a time
                b = batch.slice(at, 256)
                lists = pc.utf8_split_whitespace(b.column(2))
                tokens = lists.flatten().dictionary_encode()
                forms = word_forms(tokens.dictionary)
                number = pc.fill_null(pc.index_in(forms, value_set=known), -1).to_numpy().astype(np.int32)
                number[pc.equal(forms, "").to_numpy(zero_copy_only=False)] = -2
                ids = number[tokens.indices.to_numpy()] if len(tokens) else np.zeros(0, np.int32)
                keep = ids != -2
                # how many kept words come before each document's first and after its last token
                upto = np.concatenate(([0], np.cumsum(keep)))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
                packed = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer((upto * 4).astype(np.int64)), pa.py_buffer(ids[keep])])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed.cast(pa.binary())], ["doc_id", "h", "words"])

    return src.mapInArrow(run, StructType([*src.schema.fields[:2], *StructType.fromDDL("words binary").fields]))


def passages(batch: pa.RecordBatch, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of documents as (numbers of the known words, their blocks of
    ``step`` words, each document's first block, word counts)."""
    column, i = batch.column(2), 0
    while i < batch.num_rows:
        parts, n = [], 0
        while i < batch.num_rows and n < GROUP_WORDS:
            parts.append(np.frombuffer(column[i].as_py(), np.int32))
            n += len(parts[-1])
            i += 1
        lengths = np.array([len(p) for p in parts])
        blocks = -(-lengths // step)
        first = np.concatenate(([0], np.cumsum(blocks)))
        ids = np.concatenate(parts)
        start = np.cumsum(lengths) - lengths
        doc = np.repeat(np.arange(len(parts)), lengths)
        block = first[doc] + (np.arange(len(ids)) - start[doc]) // step
        known = ids >= 0
        yield ids[known], block[known], first, lengths


def _sum_by_word(ids: np.ndarray, block: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` words the sum of its blocks' rows of ``y``."""
    out = np.zeros((n, y.shape[1]), np.float64)
    if len(ids):
        order = np.argsort(ids, kind="stable")
        s, where = ids[order], block[order]
        cuts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        ends = np.r_[cuts[1:], len(s)]
        a = 0
        while a < len(cuts):  # copies of 16,384 rows, or of one word's
            b = max(a + 1, int(np.searchsorted(ends, cuts[a] + 16_384, side="right")))
            out[s[cuts[a:b]]] = np.add.reduceat(y[where[cuts[a]:ends[b - 1]]], cuts[a:b] - cuts[a], axis=0)
            a = b
    return out


def _block_sums(ids: np.ndarray, block: np.ndarray, n_blocks: int, table: np.ndarray) -> np.ndarray:
    """Sum of ``table`` rows over the words of every block (``block`` ascends)."""
    out = np.zeros((n_blocks, table.shape[1]), np.float32)
    if len(ids):
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        out[block[cuts]] = np.add.reduceat(table[ids], cuts, axis=0)
    return out


def passage_frequencies(encoded: DataFrame, n_words: int) -> tuple[np.ndarray, int]:
    """(passages that hold each word, number of passages) over all documents."""
    def run(batches):
        df, n = np.zeros(n_words, np.int64), 0
        for b in batches:
            for ids, block, first, _ in passages(b, PASSAGE):
                pair = np.unique(block * n_words + ids)
                df += np.bincount(pair % n_words, minlength=n_words)
                n += int(first[-1])
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, df[at]])], ["word", "n"])

    rows = encoded.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    word, n = rows["word"].to_numpy(), rows["n"].to_numpy()
    df = np.zeros(n_words, np.int64)
    df[word[word >= 0]] = n[word >= 0]
    return df, int(n[word < 0].sum())


def _summed(encoded: DataFrame, n_rows: int, n_cols: int, per_batch) -> np.ndarray:
    """The sum over all documents of an n_rows x n_cols matrix that ``per_batch``
    yields for parts of a batch. Tasks emit their sums in slices of rows; slices
    are added in two levels, so that no task adds more than a share of them."""
    def run(batches):
        from pyspark import TaskContext

        total = np.zeros((n_rows, n_cols))
        for b in batches:
            for part in per_batch(b):
                total += part
        at = list(range(0, n_rows, WORD_BLOCK))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([TaskContext.get().partitionId() % 64] * len(at)),
                                          pa.array([total[a:a + WORD_BLOCK].tobytes() for a in at], pa.binary())], ["at", "salt", "part"])

    def add(table):
        first = table.slice(0, 1)
        total = sum(np.frombuffer(x) for x in table["part"].to_pylist())
        return pa.table({"at": first["at"], "salt": first["salt"], "part": pa.array([total.tobytes()], pa.binary())})

    kind = "at long, salt long, part binary"
    once = encoded.mapInArrow(run, kind).groupBy("at", "salt").applyInArrow(add, kind)
    rows = once.groupBy("at").applyInArrow(add, kind).collect()
    out = np.zeros((n_rows, n_cols))
    for r in rows:
        part = np.frombuffer(r.part).reshape(-1, n_cols)
        out[r["at"]:r["at"] + len(part)] = part
    return out


def randomised_svd(encoded: DataFrame, idf: np.ndarray, rank: int = RANK, oversample: int = OVERSAMPLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors as vocabulary x rank, singular values) of the
    TF-IDF matrix of all passages."""
    n = len(idf)
    width = min(n, rank + oversample)
    omega = np.random.default_rng(seed).normal(size=(n, width)).astype(np.float32) * idf[:, None].astype(np.float32)

    def forth_and_back(b):
        for ids, block, first, _ in passages(b, PASSAGE):
            y = _block_sums(ids, block, int(first[-1]), omega)
            yield _sum_by_word(ids, block, y, n) * idf[:, None]

    q, _ = np.linalg.qr(_summed(encoded, n, width, forth_and_back))
    table = (q * idf[:, None]).astype(np.float32)

    def gram(b):
        for ids, block, first, _ in passages(b, PASSAGE):
            y = _block_sums(ids, block, int(first[-1]), table).astype(np.float64)
            yield y.T @ y

    values, u = np.linalg.eigh(_summed(encoded, width, width, gram))
    best = [k for k in np.argsort(-values)[:rank] if values[k] > 1e-9 * values.max()]
    return q @ u[:, best], np.sqrt(values[best])


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel over ``a``)."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        m = masks.get(x, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _leaks_of(doc: np.ndarray, hits: dict[int, list[tuple[int, float]]], queries: Queries) -> list[tuple]:
    out = []
    for k, places in hits.items():
        item, answer = queries.words[k], queries.answers[k]
        best = None
        for start, cosine in places:
            a, b = max(0, start - len(item) // 2 - STEP), start + PASSAGE + len(item) + STEP
            region = doc[a:b]
            n = lcs(item, region)
            if n >= LCS_SHARE * len(item) and lcs(answer, region) >= ANSWER_SHARE * len(answer) and (best is None or n > best[0]):
                best = (n, cosine, a)
        if best:
            out.append((queries.ids[k], best[1], best[0], len(item), best[2]))
    return out


def search(encoded: DataFrame, queries: Queries, basis: np.ndarray, idf: np.ndarray, item_type: str) -> DataFrame:
    """Verified leaks: (doc_id, h, item_id, cosine, lcs_words, item_words, from_word)."""
    table = (basis * idf[:, None]).astype(np.float32)
    q = queries.vectors(basis, idf)
    length = np.sqrt((q * q).sum(1))
    unit = q / np.maximum(length, 1e-30)[:, None]
    of_piece = np.array([k for k, _, _ in queries.pieces])
    shift = np.array([a for _, a, _ in queries.pieces])
    weight = np.zeros((len(idf), len(queries.pieces)), np.float32)
    for p, (k, a, e) in enumerate(queries.pieces):
        np.add.at(weight[:, p], queries.words[k][a:e], idf[queries.words[k][a:e]] ** 2)
    enough = np.array([WEIGHT_SHARE * weight[queries.words[k][a:e], p].sum() for p, (k, a, e) in enumerate(queries.pieces)])

    def candidates(ids, block, first, lengths):
        """(passage, piece, cosine) of a group of documents."""
        n = int(first[-1])
        sums = _block_sums(ids, block, n + 1, table)
        pair = sums[:-1] + sums[1:]
        ends = first[1:][lengths > 0] - 1
        pair[ends] = sums[ends]  # a document's last block stands alone
        norm = np.sqrt((pair * pair).sum(1))
        begin = np.searchsorted(block, np.arange(n + 2))
        stop = begin[2:].copy()
        stop[ends] = begin[ends + 1]
        for s in range(0, n, 4096):
            dot = pair[s:s + 4096] @ unit.T
            i, j = np.nonzero((dot >= COSINE * np.maximum(norm[s:s + 4096, None], 1e-9)) & (dot >= COVER * length[None]))
            at, cosine = s + i, dot[i, j] / np.maximum(norm[s + i], 1e-9)
            sizes = stop[at] - begin[at]
            ok = sizes > 0
            at, j, cosine, sizes = at[ok], j[ok], cosine[ok], sizes[ok]
            if len(at):
                cuts = np.cumsum(sizes) - sizes
                token = np.repeat(begin[at] - cuts, sizes) + np.arange(int(sizes.sum()))
                shared = np.add.reduceat(weight[ids[token], np.repeat(j, sizes)], cuts)
                ok = shared >= enough[j]
                yield from zip(at[ok].tolist(), j[ok].tolist(), cosine[ok].tolist())

    def run(batches):
        for b in batches:
            rows, done = [], 0
            for ids, block, first, lengths in passages(b, STEP):
                hits: dict[int, dict[int, list]] = {}
                for w, p, c in candidates(ids, block, first, lengths):
                    d = int(np.searchsorted(first, w, side="right")) - 1
                    hits.setdefault(d, {}).setdefault(int(of_piece[p]), []).append(((w - int(first[d])) * STEP - int(shift[p]), c))
                for d, found in hits.items():
                    words = np.frombuffer(b.column(2)[done + d].as_py(), np.int32)
                    rows += [(done + d, *x) for x in _leaks_of(words, found, queries)]
                done += len(lengths)
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array([r[1] for r in rows], schema_item),
                 pa.array([r[2] for r in rows], pa.float64()), *[pa.array([r[n] for r in rows], pa.int64()) for n in (3, 4, 5)]],
                ["doc_id", "h", "item_id", "cosine", "lcs_words", "item_words", "from_word"])

    schema_item = pa.string() if item_type == "string" else pa.int64()
    kinds = f"item_id {item_type}, cosine double, lcs_words long, item_words long, from_word long"
    return encoded.select("doc_id", "h", "words").mapInArrow(run, StructType([*encoded.schema.fields[:2], *StructType.fromDDL(kinds).fields]))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, h, item_id, cosine, lcs_words, item_words, from_word): one row per
    document row and benchmark item that its text gives away; ``h`` is the
    text's hash.

    Null and empty texts give nothing away; items without words are not looked
    for; repeated rows and repeated items are reported each; a null id is kept;
    other columns are ignored. Empty tables give an empty table.
    """
    kind = "string" if dict(benchmark.dtypes)["item_id"] == "string" else "bigint"
    out, block = None, []
    items = benchmark.select(F.col("item_id").cast(kind), F.col("text").cast("string")).orderBy("item_id", "text")
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(f"h long, item_id {kind}, cosine double, lcs_words long, item_words long, from_word long").fields])

    def of(block):
        queries = Queries(block)
        if not queries.vocab:
            return None
        encoded = stored(encode(docs, queries.vocab), "latent-words")
        df, n = passage_frequencies(encoded, len(queries.vocab))
        idf = np.log((n + 1) / (df + 1)) + 1e-3
        vectors, values = randomised_svd(encoded, idf)
        basis = vectors / values[None]
        return stored(search(encoded, queries, basis, idf, kind), "latent-leaks")

    for row in items.toLocalIterator():  # the stated query set, a block at a time
        block.append(tuple(row))
        if len(block) == ITEM_BLOCK:
            part = of(block)
            out, block = (part if out is None else out if part is None else out.unionByName(part)), []
    part = of(block) if block else None
    out = part if out is None else out if part is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text gives no benchmark item away, columns unchanged."""
    doc_id, h = free_names(docs, "_id", "_h")
    bad = leaks(docs.select("doc_id", "text"), benchmark).select(F.col("doc_id").alias(doc_id), F.col("h").alias(h)).distinct()
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (own == F.col(h)), "left_anti")
