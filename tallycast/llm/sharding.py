"""Balanced label propagation: linked documents move to common shards while the
shards' document counts stay even.

Links are given as groups of documents (a group is a clique, here: equal
texts). Every document starts in a shard drawn from its id. In each round every
group has one target, the shard where most of its members are, and its members
in shards that hold no more of them ask to go there. Requests are granted where
shards exchange equally many documents (swaps and longer cycles), and as far as
a shard has room (capacity: the even share, which documents without links make
way for), the lowest hashes first. Every move raises the number of pairs that
lie together, so the rounds go on until no request can be granted: neither for
the best shards with room, nor for the best shards at all, nor for any others.
Group tallies hold at most one row per shard, so a group with a third of all
documents is joined as a few rows and its members are never gathered.

At the end the counts are made even exactly: a shard keeps its linked documents
up to its quota; all others, the overflow ordered by group and then the
documents without links, fill the open places in shard order. Ranks are
distributed (``ordered_ranks``): no shard and no group is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ordered_ranks, stored

SHARDS = 16
DIGIT = 7  # bits of the 63-bit turns that requests are counted by at a time


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def _start(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def circulation(asks: list[list[int]], room: list[int]) -> list[list[int]]:
    """How many of ``asks[s][t]`` moves from s to t are made, so that no shard
    gains more than its room: shortest cycles first (a cycle through the last
    node ends at a shard's room)."""
    n = len(room)
    left = [[*row, 0] for row in asks]
    for s in range(n):
        left[s][s], left[s][n] = 0, room[s]
    left.append([sum(map(sum, asks))] * n + [0])

    def cycle(start):
        came, queue = {}, [start]
        for s in queue:
            for t in range(n + 1):
                if left[s][t] > 0 and t not in came and not (s == n and t == start == came[n]):
                    came[t] = s
                    if t == start:
                        path = [start]
                        while len(path) < 2 or path[-1] != start:
                            path.append(came[path[-1]])
                        return path[::-1]
                    queue.append(t)
        return None

    while found := [c for c in map(cycle, range(n)) if c]:
        path = min(found, key=len)
        edges = list(zip(path, path[1:]))
        some = min(left[s][t] for s, t in edges)  # uses up an edge
        for s, t in edges:
            left[s][t] -= some
    return [[asks[s][t] - left[s][t] if s != t else 0 for t in range(n)] for s in range(n)]


def _limits(asked: DataFrame, room: list[int]) -> tuple[list[int], list[list[int]]]:
    """(for each pair of shards, from * shards + to, the turn below which requests
    are granted; the numbers granted). Turns are counted by their first digit;
    where more requests share a digit than may still go, those by the next."""
    shards = len(room)
    limit, moved = [0] * (shards * shards), [[0] * shards for _ in room]
    flow: list[list[int]] = []
    pairs = None
    for bits in range(63 - DIGIT, -1, -DIGIT):
        rows = asked.filter("wish is not null").withColumn("pair", F.col("shard") * shards + F.col("wish"))
        if pairs is not None:  # within the first digits found so far
            rows = rows.filter(F.col("pair").isin(pairs) & (F.shiftright(F.col("turn"), bits + DIGIT) == F.shiftright(
                F.get(F.array(*[F.lit(x).cast("long") for x in limit]), F.col("pair")), bits + DIGIT)))
        counts: dict[int, list] = {}
        # shards * shards * 2 ** DIGIT rows at most
        for x in rows.groupBy("pair", F.shiftright("turn", bits).alias("digits")).agg(F.count("*").alias("n")).collect():
            counts.setdefault(x["pair"], []).append((x["digits"], x["n"]))
        if pairs is None:
            asks = [[sum(n for _, n in counts.get(s * shards + t, [])) for t in range(shards)] for s in range(shards)]
            flow = circulation(asks, room)
        pairs = []
        for pair, digits in counts.items():
            s, t = divmod(pair, shards)
            for digit, n in sorted(digits):
                limit[pair] = digit << bits
                if n > flow[s][t] - moved[s][t]:
                    break
                moved[s][t] += n
                limit[pair] = min((digit + 1) << bits, (1 << 63) - 1)
            if moved[s][t] < flow[s][t]:
                pairs.append(pair)
        if not pairs:
            break
    return limit, moved


def propagate(linked: DataFrame, capacity: int, shards: int, rounds: int | None = None) -> DataFrame:
    """(node, grp, shard) from (node, grp, shard), after propagation until nothing
    can move (or ``rounds`` rounds)."""
    state, r, idle = linked, 0, 0
    filled = {x["shard"]: x["n"] for x in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # ``shards`` rows
    filled = [filled.get(k, 0) for k in range(shards)]
    # idle 0: best shard with room, 1: best shard, 2: any of the group's shards
    while idle < 3 and (rounds is None or r < rounds):
        room = [max(0, capacity - n) for n in filled]
        tally = state.groupBy("grp", "shard").agg(F.count("*").alias("n"))
        open_ = F.get(F.array(*[F.lit(x) for x in room]), F.col("shard")) > 0 if idle == 0 else F.lit(True)
        tie = F.xxhash64("grp", "shard", F.lit(r))
        rank = F.struct("n", tie.alias("tie"), "shard") if idle < 2 else F.struct(F.lit(0).alias("z"), tie.alias("tie"), "shard", "n")
        # at most ``shards`` rows of a group meet
        best = tally.groupBy(F.col("grp").alias("_g")).agg(
            F.max(F.when(open_, rank)).alias("to"), F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("have"))
        asked = state.join(best, F.col("grp") == F.col("_g"))
        # a move from no more to no fewer raises the pairs that lie together, whoever else moves to the group's target
        wish = F.when((F.col("to.shard") != F.col("shard")) & (F.col("to.n") >= F.element_at("have", F.col("shard"))), F.col("to.shard"))
        turn = F.shiftrightunsigned(F.xxhash64("grp", "node", F.lit(r)), 1)
        asked = stored(asked.select("node", "grp", "shard", wish.alias("wish"), turn.alias("turn")), "propagate")
        limit, moved = _limits(asked, room)
        granted = F.col("wish").isNotNull() & (F.col("turn") < F.get(
            F.array(*[F.lit(x).cast("long") for x in limit]), F.col("shard") * shards + F.col("wish")))
        state = asked.select("node", "grp", F.when(granted, F.col("wish")).otherwise(F.col("shard")).alias("shard"))
        filled = [n + sum(row[k] for row in moved) - sum(moved[k]) for k, n in enumerate(filled)]
        idle = 0 if any(map(any, moved)) else idle + 1
        r += 1
    return state


def assign(nodes: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """(node, shard, slot) for (node, grp): counts differ by one at most, slots
    run from 0 without gaps in each shard. ``node`` must be unique; rows with
    the same non-null ``grp`` are linked to each other."""
    nodes = stored(nodes.select("node", "grp"), "shard-nodes")
    total = nodes.count()
    quota = [(k + 1) * total // shards - k * total // shards for k in range(shards)]
    groups = nodes.filter("grp is not null").groupBy(F.col("grp").alias("_g")).agg(F.count("*").alias("n")).filter("n > 1").select("_g")
    # written first, so that a large group's side of the join can be split
    linked = nodes.join(stored(groups, "shard-groups"), F.col("grp") == F.col("_g")).select("node", "grp", _start(F.col("node"), shards).alias("shard"))
    linked = propagate(stored(linked, "shard-linked"), min(quota, default=0), shards, rounds)
    # linked documents first, by shard and group; then, as if in shard number ``shards``, the rest in a fixed random order
    placed = nodes.select("node").join(linked, "node", "left").select(
        "node", F.coalesce("shard", F.lit(shards)).alias("at"), F.coalesce("grp", F.lit(0)).alias("grp"))
    ranked = stored(ordered_ranks(placed, [F.col("at"), F.col("grp"), F.xxhash64("node"), F.col("node")], "rank")
                    .select("node", "at", "rank"), "shard-ranked")
    have = {x["at"]: x["n"] for x in ranked.groupBy("at").agg(F.count("*").alias("n")).collect()}  # ``shards`` + 1 rows
    n = [have.get(k, 0) for k in range(shards + 1)]
    keep = [*map(min, quota, n), 0]
    begin = [sum(n[:k]) for k in range(shards + 1)]
    pooled = [sum(n[:k]) - sum(keep[:k]) for k in range(shards + 1)]
    free = [sum(quota[:k]) - sum(keep[:k]) for k in range(shards + 1)]
    number = lambda xs, k: F.get(F.array(*[F.lit(x).cast("long") for x in xs]), k)
    within = F.col("rank") - number(begin, F.col("at"))
    over = within - number(keep, F.col("at"))
    ranked = ranked.withColumns({"within": within, "over": over, "pool": over + number(pooled, F.col("at"))})
    to = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in free[1:]]), lambda x: x <= F.col("pool")))
    slot = F.col("pool") + number([keep[k] - free[k] for k in range(shards)], to)
    return ranked.select("node", F.when(F.col("over") < 0, F.col("at")).otherwise(to).cast("int").alias("shard"),
                         F.when(F.col("over") < 0, F.col("within")).otherwise(slot).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """One row per input row: (doc_id, size, text_crc32, text_group, shard, slot).

    ``size``: UTF-8 bytes of the text (null: none) plus 1. Documents with equal
    texts are linked (null and empty texts count as equal). Ids need not be
    unique or present: rows are placed one by one. Texts are reduced to a digest
    where they are read; other columns are ignored; an empty table gives an
    empty table.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    # 128 bits decide which texts are equal; the 64-bit group name is only compared within them by the links
    base = stored(docs.select("doc_id", text_size(F.col("text")).alias("size"), F.crc32(raw).cast("long").alias("text_crc32"),
                              F.xxhash64(F.md5(raw)).alias("text_group")).withColumn("node", F.monotonically_increasing_id()), "shard-base")
    placed = assign(base.select("node", F.col("text_group").alias("grp")), shards, rounds)
    return base.join(placed, "node").select("doc_id", "size", "text_crc32", "text_group", "shard", "slot")
