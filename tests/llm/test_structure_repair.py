import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tallycast.llm import structure_repair as sr
from tallycast.llm.queries import REGISTRY

PATTERN = re.compile(r"(s?(ua)+)?")


def brute_edits(rows):
    """(cost, audit, repaired) over all edit scripts, cheapest first, then by audit; rows are (role, text, fault)."""
    best = None
    queue = [(0, "", "", ())]
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for role, text, fault in [*rows, (None, None, None)]:
        new = {}
        for cost, audit, initials, out in queue:
            for ins in inserts:
                c, a = cost + 3 * len(ins), audit + "I" * len(ins)
                i, o = initials + "".join(r[0] for r in ins), out + tuple((r, "") for r in ins)
                if role is None:
                    steps = [(c, a, i, o)]
                else:
                    cut = 3 * (fault == "c")
                    steps = [(c + 4, a + "D", i, o)]
                    if fault not in "bd":
                        steps.append((c + cut, a + "K", i + (role[:1] or "?"), o + ((role, text),)))
                        steps += [(c + 3 + cut, a + "R", i + r[0], o + ((r, text),)) for r in ("user", "assistant")]
                for step in steps:
                    if re.fullmatch(r"s?(ua)*u?", step[2]):  # a prefix of the pattern
                        key = step[2]
                        # only the last initials matter for what may follow
                        state = (len(key) > 0, key[-1:])
                        if state not in new or step[:2] < new[state][:2]:
                            new[state] = step
        queue = list(new.values())
    best = min((q for q in queue if PATTERN.fullmatch(q[2])), key=lambda q: q[:2])
    return best[0], best[1], "\n".join(f"{r}:{t}" for r, t in best[3])


def expected(table):
    """The contract, row by row; table rows are (conv_id, turn, role, text)."""
    out = {c: [] for c, *_ in table}
    for c, t, role, text in table:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out[c] += [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    result = {}
    for c, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in rows:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "b" if not body else "d" if (role, text) in seen else "c" if body[-1] not in ".!?" else "-"
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, audit, repaired = brute_edits(marked)
        turns = [t for t, *_ in rows if t is not None]
        faults = [m[2] for m in marked]
        result[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("c"),
                     sum((a[1][:1] or "x") + (b[1][:1] or "x") not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
                     cost, audit, hashlib.sha256(repaired.encode()).hexdigest())
    return result


def run(spark, table, extra=False):
    cols = "conv_id long, turn long, role string, text string"
    rows = [(*r, 1, "z") for r in table] if extra else table
    df = spark.createDataFrame(rows, cols + (", at int, fault string" if extra else ""))
    got = sr.repair_digests(df, sr.damaged(df)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_block_tables_equal_single_steps():
    t = sr.tables()
    rng = np.random.default_rng(0)
    assert 3 < len(t.vectors) < 200 and (t.vectors.min(1) == 0).all()
    for n in range(0, 30):
        sym = rng.integers(0, 9, n)
        v, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), int)
        for s in sym[::-1]:
            cost += t.step_cost[v, s]
            v = t.step[v, s]
        got = sr.before(sym, np.arange(len(t.vectors)))
        assert (got[0] == v).all() and (got[1] == cost).all()


def test_traces_are_the_cheapest_and_first_of_all_scripts():
    rng = random.Random(1)
    for n in [*range(9)] * 40:
        rows = [(rng.choice(["user", "user", "assistant", "assistant", "system", "tool", ""]), f"t{i}", rng.choice("---cbd")) for i in range(n)]
        sym = sr._symbols("".join(r[0][:1] if r[0][:1] in set("sua") else "x" for r in rows), "".join(r[2].replace("b", "d") for r in rows))
        v, cost = sr.before(sym, np.array([0]))
        audit, state = sr.trace(sym, 0, 0, True)
        want = brute_edits(rows)
        assert (cost[0] + sr.tables().vectors[v[0]][0], audit) == want[:2] and state in sr.ENDS


def table_of(seed, convs, turns):
    rng = random.Random(seed)
    texts = ["Hello.", "Why?", "no end", "", " \n", "a.b", "Yes! ", "wait.\t\n", None, "x" * 70 + "1.", "x" * 70 + "2."]
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, turns)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2]
            rows.append((c, rng.choice([t, t, t, t + 1, None]) if rng.random() < 0.3 else t, rng.choice(["system", "tool", None, "", role, role, role, role]), rng.choice(texts)))
    rng.shuffle(rows)
    # equal turns with equal role and 64 first characters go by a hash that Python does not have
    return [r for r in rows if not (r[3] or "").startswith("xxx") or r[1] is not None and sum((q[0], q[1]) == (r[0], r[1]) for q in rows) == 1]


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 3), (3, 13)])
def test_equals_brute_force_with_conversations_cut_into_pieces(spark, seed, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        table = table_of(seed, [*range(25), None], 9) + table_of(seed + 10, [77], 160)
        table += [table[0]] * 3
        assert run(spark, table, extra=seed == 2) == expected(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_dropped_and_empty_conversations(spark):
    drop = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert run(spark, [(*drop, "user", "Hi.")]) == {drop[0]: none}
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert sr.repair_digests(empty, sr.damaged(empty)).collect() == []
    table = [(5, None, None, None), (None, None, "user", "Hi.")]
    assert run(spark, table) == expected(table)


def test_messages_are_returned_in_order_with_long_texts(spark):
    long = "word " * 60_000 + "end."
    keep = [t for t in range(60) if zlib.crc32(f"1:{t}".encode()) % 20 > 4][:3]
    rows = [(1, keep[0], "user", long), (1, keep[1], "user", "Short."), (1, keep[2], "assistant", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report, left = sr.repair(df)
    r = report.first()
    assert (r.cost, r.audit) == (3, "KIKK")
    got = [(m.role, m.text) for m in sorted(left.collect(), key=lambda m: (m.major, m.minor))]
    assert got == [("user", long), ("assistant", ""), ("user", "Short."), ("assistant", "Yes.")]


def test_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in REGISTRY["op11_block_repair"](spark, sf).collect()}
    assert got == expected(table)
