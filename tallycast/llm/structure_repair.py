"""Repair of the turn structure of conversations by Four-Russians block tables.

Messages may be blank, duplicated, cut short or in the wrong role. A message is
kept, given another role or deleted, and empty messages are inserted, at the
least cost that makes the roles ``(system? (user assistant)+)?``. Of equally
cheap repairs the one whose edit initials come first in ASCII is taken.

The costs to go from each of the four states of that pattern form a vector;
less its minimum, only a few vectors occur at all. A message is one of nine
symbols, so the vector before every block of ``BLOCK`` symbols is precomputed
for every vector after it. Conversations are read block by block by lookup, from
the last one to the first, then traced forward: a block is expanded backward
from the vector after it, and its edits are chosen in order.

Rows are range-partitioned by conversation and order, so a conversation that
holds a third of all rows is cut into pieces of many tasks. A piece is a
function from the vector after it to the vector before it, and from the state
before it to the state after it; only these summaries, one row per piece, meet
in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK = 4
INSERT_COST, ROLE_COST, DELETE_COST, CUT_COST = 3, 3, 4, 3

# White space; initials of the roles that the pattern knows.
SPACE = " \t\n\x0b\x0c\r"
INITIALS = "sua"

# The pattern as an automaton: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NEXT = (2, 2, 3, 2)                       # where an inserted or renamed message leads ...
GIVEN = ("user", "user", "assistant", "user")  # ... and its role
ENDS = (0, 3)
SYMBOLS = 9  # initial (s, u, a, other) x (whole, cut short), and: must be deleted
FAR = 1 << 20


def symbol(initial: str, fault: str) -> int:
    return 8 if fault == "d" else 2 * (INITIALS + "x").index(initial) + (fault == "c")


def _options(state: int, sym: int):
    """(edit, cost, next state) of a message, in the order of the edits' initials."""
    yield "D", DELETE_COST, state
    if sym < 8:
        cut = CUT_COST * (sym % 2)
        kept = KEPT.get((state, (INITIALS + "x")[sym // 2]))
        if kept is not None:
            yield "K", cut, kept
        yield "R", ROLE_COST + cut, NEXT[state]


def _closed(costs: list[int]) -> list[int]:
    """Cheapest costs when messages may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT_COST + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return costs


@dataclass
class Tables:
    vectors: np.ndarray    # (vector, state): cost to go less the least
    step: np.ndarray       # (vector, symbol) -> vector before the symbol
    step_cost: np.ndarray  # ... and what the least cost grows by
    block: np.ndarray      # (vector, block) -> vector before the block
    block_cost: np.ndarray
    end: int               # vector after the last message


@cache
def tables() -> Tables:
    """All vectors reachable from the end, the transitions of symbols and blocks."""
    start = _closed([0 if s in ENDS else FAR for s in range(4)])
    found, order, step, cost = {tuple(start): 0}, [tuple(start)], [], []
    for v in order:  # grows while it is read
        row, add = [], []
        for sym in range(SYMBOLS):
            now = _closed([min(c + v[t] for _, c, t in _options(s, sym)) for s in range(4)])
            low = min(now)
            key = tuple(c - low for c in now)
            if key not in found:
                found[key] = len(order)
                order.append(key)
            row.append(found[key])
            add.append(low)
        step.append(row)
        cost.append(add)
    step, cost = np.array(step), np.array(cost)
    block, block_cost = np.arange(len(order))[:, None], np.zeros((len(order), 1), np.int64)
    for _ in range(BLOCK):  # one more symbol in front of every block
        block, block_cost = (np.concatenate([step[block, s] for s in range(SYMBOLS)], 1),
                             np.concatenate([block_cost + cost[block, s] for s in range(SYMBOLS)], 1))
    return Tables(np.array(order), step, cost, block, block_cost, 0)


def blocks_of(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """(the first symbols, fewer than a block; codes of the whole blocks)."""
    head = len(symbols) % BLOCK
    weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    return symbols[:head].tolist(), (symbols[head:].reshape(-1, BLOCK) @ weights).tolist()


def before(symbols: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors before a piece and the costs it adds, for several vectors after it."""
    t = tables()
    head, blocks = blocks_of(symbols)
    cost = np.zeros(len(v), np.int64)
    for b in reversed(blocks):
        cost += t.block_cost[v, b]
        v = t.block[v, b]
    for s in reversed(head):
        cost += t.step_cost[v, s]
        v = t.step[v, s]
    return v, cost


@cache
def _expanded(after: int, symbols: tuple[int, ...], state: int) -> tuple[str, int]:
    """(edits, state after them) of a few symbols: the first edit by initial that is on a cheapest way."""
    t = tables()
    vs = [after]
    for s in reversed(symbols):
        vs.append(int(t.step[vs[-1], s]))
    vs.reverse()
    edits = []
    for i, s in enumerate(symbols):
        now, later = t.vectors[vs[i]], t.vectors[vs[i + 1]]
        while True:
            left = int(now[state] + t.step_cost[vs[i + 1], s])
            fits = {e: to for e, c, to in _options(state, s) if c + later[to] == left}
            if "D" not in fits and INSERT_COST + now[NEXT[state]] == now[state]:
                edits.append("I")
                state = NEXT[state]
                continue
            edit = min(fits)
            edits.append(edit)
            state = fits[edit]
            break
    return "".join(edits), state


def trace(symbols: np.ndarray, after: int, state: int, last: bool) -> tuple[str, int]:
    """(edits of a piece, state after it), given the vector after it and the
    state before it; the last piece ends with the insertions still needed."""
    t = tables()
    head, blocks = blocks_of(symbols)
    vs = [after]
    for b in reversed(blocks):
        vs.append(int(t.block[vs[-1], b]))
    edits, state = _expanded(vs[-1], tuple(head), state)
    out = [edits]
    for b, v in zip(blocks, reversed(vs[:-1])):
        edits, state = _expanded(v, tuple(b // SYMBOLS ** k % SYMBOLS for k in range(BLOCK - 1, -1, -1)), state)
        out.append(edits)
    while last and state not in ENDS:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def _symbols(initials: str, faults: str) -> np.ndarray:
    return np.array([symbol(i, f) for i, f in zip(initials, faults)], np.int64)


def illegal_pairs(initials: str) -> int:
    """Neighbours that the pattern never has side by side."""
    return sum(p not in ("su", "ua", "au") for p in map("".join, zip(initials, initials[1:])))


def ordered_messages(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, at): ``at`` numbers the rows in order of
    conversation and turn (nulls first), then role and text; its upper bits are
    the range partition. Stored, so that every later step sees the same numbers."""
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64), F.xxhash64("text")]
    # the row's own number last: rows that are equal in everything may lie in several partitions
    cut = src.withColumn("_own", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_own").sortWithinPartitions(*order, "_own")
    return stored(cut.drop("_own").withColumn("at", F.monotonically_increasing_id()), "messages")


def faults(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, at, initial, fault): blank b, duplicate d, cut short c or none (-)."""
    src = messages.select("conv_id", "turn", "at", "role", F.sha2("text", 256).alias("_text"), F.rtrim("text", F.lit(SPACE)).alias("_end"))
    src = src.select("conv_id", "turn", "at", "role", "_text", (F.col("_end") == "").alias("_blank"),
                     F.right("_end", F.lit(1)).isin(".", "!", "?").alias("_whole"))
    first = (src.groupBy("conv_id", "role", "_text").agg(F.min("at").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
             .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_text").alias("_t"), "_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_text") == F.col("_t"))
    initial = F.substring("role", 1, 1)
    return src.join(first, same, "left").select(
        "conv_id", "turn", "at", F.when(initial.isin(*INITIALS), initial).otherwise("x").alias("initial"),
        F.when(F.col("_blank"), "b").when(F.col("at") > F.col("_first"), "d").when(~F.col("_whole"), "c").otherwise("-").alias("fault"))


def _in_order(what: str) -> Column:
    rows = F.sort_array(F.collect_list(F.struct("at", what)))
    return F.array_join(F.transform(rows, lambda r: r[what]), "")


def pieces_of(marked: DataFrame) -> DataFrame:
    """One row per conversation and range partition, with one character per
    message; no larger than the partition."""
    return (marked.groupBy("conv_id", F.shiftright("at", 33).alias("part"))
            .agg(_in_order("initial").alias("initials"), _in_order("fault").alias("faults"), F.min("at").alias("first_at")))


def _backward(pieces: DataFrame) -> DataFrame:
    """(conv_id, part, after, cost, lowest, n_pieces, is_last) of the pieces:
    the vector after each, once the functions of all later pieces are applied."""
    def summary(batches):
        every = np.arange(len(tables().vectors))
        for b in batches:
            got = [before(_symbols(i, f.replace("b", "d")), every) for i, f in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0].tolist() for g in got], pa.list_(pa.int64())),
                                              pa.array([g[1].tolist() for g in got], pa.list_(pa.int64()))], ["conv_id", "part", "map", "cost"])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part", ascending=False)
        v, out = tables().end, []
        for m, c in zip(pdf["map"], pdf["cost"]):
            out.append((v, int(c[v])))
            v = int(m[v])
        return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), "part": pdf["part"].to_numpy(),
                             "after": [o[0] for o in out], "piece_cost": [o[1] for o in out],
                             "first_cost": [int(tables().vectors[v][0]) if i == len(out) - 1 else 0 for i in range(len(out))],
                             "is_first": [i == len(out) - 1 for i in range(len(out))], "is_last": [i == 0 for i in range(len(out))]})

    kind = pieces.schema["conv_id"].dataType.simpleString()
    sums = pieces.select("conv_id", "part", "initials", "faults").mapInArrow(summary, f"conv_id {kind}, part long, map array<long>, cost array<long>")
    return sums.groupBy("conv_id").applyInPandas(chain, f"conv_id {kind}, part long, after long, piece_cost long, first_cost long, is_first boolean, is_last boolean")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which null keys meet."""
    named = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(named, cond, "left").drop(*[f"_k_{k}" for k in keys])


def edited_pieces(marked: DataFrame) -> DataFrame:
    """The pieces with the vector after each, the state before each, its edits and costs.

    Pieces that hold a whole conversation know both; the others, two a range
    partition at most, are chained."""
    pieces = pieces_of(marked)
    count = pieces.groupBy("conv_id").agg(F.count("*").alias("n_pieces"))
    pieces = stored(_null_safe(pieces, count, ["conv_id"]), "pieces")
    cut = pieces.filter("n_pieces > 1")
    kind = pieces.schema["conv_id"].dataType.simpleString()
    known = _null_safe(pieces, _backward(cut), ["conv_id", "part"])

    def edits(batches):
        t = tables()
        for b in batches:
            rows = b.to_pylist()
            got = []
            for r in rows:
                sym = _symbols(r["initials"], r["faults"].replace("b", "d"))
                whole = r["n_pieces"] == 1
                after = t.end if whole else r["after"]
                found = {s: trace(sym, after, s, whole or r["is_last"]) for s in ((0,) if whole or r["is_first"] else range(4))}
                cost = r["piece_cost"]
                if whole:
                    v, c = before(sym, np.array([after]))
                    cost = int(c[0] + t.vectors[v[0]][0])
                else:
                    cost += r["first_cost"]
                got.append((r["conv_id"], r["part"], r["first_at"], r["initials"], r["faults"], cost, r["n_pieces"],
                            [found[s][0] if s in found else None for s in range(4)], [found[s][1] if s in found else None for s in range(4)]))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([g[i] for g in got], k) for i, k in enumerate(
                (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())), 1)]],
                ["conv_id", "part", "first_at", "initials", "faults", "cost", "n_pieces", "edits", "states"])

    def states(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        s, out, bad, last = 0, [], [], ""
        for to, i in zip(pdf["states"], pdf["initials"]):
            out.append(s)
            bad.append(illegal_pairs(last + i[0]) if last else 0)
            s, last = int(to[s]), i[1]
        return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), "part": pdf["part"].to_numpy(), "state": out, "seams": bad})

    order = ["conv_id", "part", "initials", "faults", "first_at", "n_pieces", "after", "piece_cost", "first_cost", "is_first", "is_last"]
    traced = stored(known.select(*order).mapInArrow(edits, f"conv_id {kind}, part long, first_at long, initials string, faults string, "
                                                           "cost long, n_pieces long, edits array<string>, states array<long>"), "edits")
    ends = F.concat(F.substring("initials", 1, 1), F.right("initials", F.lit(1))).alias("initials")
    start = (traced.filter("n_pieces > 1").select("conv_id", "part", "states", ends)
             .groupBy("conv_id").applyInPandas(states, f"conv_id {kind}, part long, state long, seams long"))
    full = _null_safe(traced, start, ["conv_id", "part"])
    state = F.coalesce("state", F.lit(0))
    return stored(full.select("conv_id", "part", "first_at", "initials", "faults", "cost", state.cast("int").alias("state"),
                              F.coalesce("seams", F.lit(0)).cast("long").alias("seams"), F.get("edits", state.cast("int")).alias("edits")), "edited")


def report(marked: DataFrame, edited: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation that has messages."""
    turns = marked.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))

    def each(mark: str) -> Column:
        return F.sum(F.length("faults") - F.length(F.replace("faults", F.lit(mark), F.lit("")))).cast("long")

    pair = "aggregate(sequence(1, length(initials)), 0L, (n, i) -> n + IF(i < length(initials) AND substring(initials, i, 2) NOT IN ('su', 'ua', 'au'), 1L, 0L))"
    whole = edited.groupBy("conv_id").agg(
        each("b").alias("blank"), each("d").alias("duplicate"), each("c").alias("truncated"),
        F.sum(F.expr(pair) + F.col("seams")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "edits"))), lambda p: p["edits"]), "").alias("audit"))
    return _null_safe(whole, turns, ["conv_id"]).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired_messages(messages: DataFrame, edited: DataFrame) -> DataFrame:
    """(conv_id, major, minor, role, text): the messages that the repairs leave,
    in order of (major, minor) within their conversation."""
    kind = edited.schema["conv_id"].dataType.simpleString()

    def rows(batches):
        for b in batches:
            for r in b.to_pylist():
                at, sub, state = r["first_at"], 0, r["state"]
                major, minor, role, own = [], [], [], []
                i = 0
                for e in r["edits"]:
                    if e != "D":
                        major.append(at)
                        minor.append(sub)
                        role.append(None if e == "K" else GIVEN[state])
                        own.append(None if e == "I" else at)
                        state = KEPT[state, r["initials"][i]] if e == "K" else NEXT[state]
                    sub += 1
                    if e != "I":
                        at, sub, i = at + 1, 0, i + 1
                yield pa.RecordBatch.from_arrays([pa.array([r["conv_id"]] * len(major), b.column(0).type), pa.array(major, pa.int64()), pa.array(minor, pa.int64()),
                                                  pa.array(role, pa.string()), pa.array(own, pa.int64())], ["conv_id", "major", "minor", "given", "own"])

    left = edited.select("conv_id", "first_at", "initials", "edits", "state").mapInArrow(
        rows, f"conv_id {kind}, major long, minor long, given string, own long")
    texts = messages.select(F.col("at").alias("own"), "role", "text")
    # inserted messages have no row of their own and stay out of the join
    kept = left.filter("own IS NOT NULL").join(texts, "own").select("conv_id", "major", "minor", F.coalesce("given", "role").alias("role"), "text")
    return kept.unionByName(left.filter("own IS NULL").select("conv_id", "major", "minor", F.col("given").alias("role"), F.lit("").alias("text")))


def digests(repaired: DataFrame, out: str = "repaired_sha256") -> DataFrame:
    """(conv_id, SHA-256 of ``role:text`` of its messages joined by newlines).
    A digest is a chain: the messages of a conversation stream through one task,
    which holds no more than the digest so far."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, digest, none = None, None, True
        for b in batches:
            ids, found = [], []
            for c, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if none or c != conv:
                    if not none:
                        ids.append(conv)
                        found.append(digest.hexdigest())
                    conv, digest, none = c, hashlib.sha256(), False
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(found, pa.string())], ["conv_id", out])
        if not none:
            yield pa.RecordBatch.from_arrays([pa.array([conv], b.column(0).type), pa.array([digest.hexdigest()], pa.string())], ["conv_id", out])

    n = max(1, int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chains = repaired.repartition(n, "conv_id").sortWithinPartitions("conv_id", "major", "minor").select("conv_id", "role", "text")
    return chains.mapInArrow(run, f"conv_id {kind}, {out} string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report per conversation, repaired messages) of ``conv_id``, ``turn``,
    ``role`` and ``text``; other columns are ignored, whatever their names.

    A null conversation id is a conversation of its own; null turns come first,
    a null role or text is one space. Equal turns go by role, then by the text's
    first 64 characters, then by its hash; rows equal in all are neighbours, and
    all but the first are duplicates. Empty tables give empty tables."""
    messages = ordered_messages(rows)
    marked = stored(faults(messages), "faults")
    edited = edited_pieces(marked)
    return report(marked, edited), repaired_messages(messages, edited)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with known faults, by crc32 of ``conv_id:turn`` mod 20: 0 drops
    the row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes its role user. Nulls become one space
    in the key, the role and the text."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    src = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (src.filter("_fault != 0").select("conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                                             text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1))).alias("_copy"))
            .drop("_copy"))


def repair_digests(originals: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) for every conversation of ``originals``, of what became of
    it in ``rows``; zeros, no edits and the digest of nothing where no row is left."""
    found, left = repair(rows)
    sha = digests(left)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [originals.select("conv_id").distinct(), found, sha]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    return every.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
                                        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
