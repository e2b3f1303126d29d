import random
import re

import regex

from tallycast.llm import license_rules as L


def test_every_known_sentence_has_a_trigger_word_and_is_one_sentence(spark):
    forms = [f for fs in L.SENTENCES.values() for f in fs]
    assert all(re.search(L.WORDS, f, re.I) for f in forms)
    assert {s for _, _, steps in L.RULES for s in steps} == set(L.SENTENCES)
    df = spark.createDataFrame([(f,) for f in forms], "t string").select("t", L.normal(__import__("pyspark").sql.functions.col("t")).alias("n"))
    assert all(r.n == L.normal_form(r.t) for r in df.collect())


def slow_scan(text):
    table = {L.normal_form(f): k for k, fs in L.SENTENCES.items() for f in fs}
    counts = []
    starts = "|".join(r"[^\p{L}\p{N}]+".join(h) for h in L.starters()) + r"|copyright (?:\(c\)|©|\d{4})"
    paragraphs = r"(?<=[.!?])(?=\s|$)|(?<=:)(?=[ \t]*\n)|\n[ \t#/*;-]*\n"
    for cut in ("\n|" + paragraphs, paragraphs, paragraphs + rf"|(?<=:)(?=\s+\d+[.)])|(?<=\s)(?=(?i:{starts})(?![\p{{L}}\p{{N}}]))"):
        words = [w for w in (L.normal_form(p) for p in regex.split(cut, text, flags=regex.V1)) if w]
        seq = [(i, table[w]) for i, w in enumerate(words) if w in table]
        found = []
        for rule, lic, steps in L.RULES:
            for p in range(len(seq) - len(steps) + 1):
                part = seq[p:p + len(steps)]
                if [x for _, x in part] == steps and all(b[0] - a[0] <= L.GAP + 1 for a, b in zip(part, part[1:])):
                    found.append((rule, lic, part[0][0], part[-1][0], len(steps)))
        found = [m for m in found if not any(o[4] > max(1, m[4]) and o[2] <= m[2] and m[3] <= o[3] for o in found)]
        counts.append(found)
    out = {}
    for found in counts:
        tally = {}
        for m in found:
            tally[(m[1], m[0], m[4])] = tally.get((m[1], m[0], m[4]), 0) + 1
        for k, n in tally.items():
            out[k] = max(n, out.get(k, 0))
    return out


def wrap(text, width=40):
    words, lines, cur = text.split(), [], ""
    for w in words:
        cur = f"{cur} {w}".strip()
        if len(cur) > width:
            lines.append("# " + cur)
            cur = ""
    return "\n".join(lines + ["# " + cur])


def test_scan_equals_brute_force(spark):
    rng = random.Random(9)
    forms = [f for fs in L.SENTENCES.values() for f in fs]
    rows = [(0, None), (1, ""), (2, "no such words"), (3, "BE!! THAT\nThis work is licensed under the GNU General Public License, version 3."),
            (4, "Released under the MIT License.\n" * 300), (5, "licensed to kill")]
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.4:
                steps = rng.choice(L.RULES)[2]
                body = rng.choice([" ", "\n\n", "\n\n"]).join(L.SENTENCES[s][0] + rng.choice(["", "", " Odd words here."]) for s in steps)
                parts.append(rng.choice([body, "\n\n".join(map(wrap, body.split("\n\n"))), body.upper(), body.replace(" ", "  ")]))
            elif kind < 0.6:
                parts.append(rng.choice(forms))
            else:
                parts.append("Plain prose about the rights of ants. It goes on")
        rows.append((100 + i, rng.choice(["\n", "\n\n", " "]).join(parts)))
    rows.append((99, "\n".join(forms)))
    rows += [rows[3], (None, "All rights reserved.")]
    df = spark.createDataFrame([(*r, "MIT") for r in rows], "doc_id long, text string, license string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.license, r.rule, r.sentences, r.matches) for r in L.scan(df).collect()))
    want = sorted((i is None, i or 0, lic, rule, n, times) for i, t in rows for (lic, rule, n), times in slow_scan(t or "").items())
    assert got == want
    assert {x[3] for x in got} == {r[0] for r in L.RULES}
    assert any(x[3] == "apache-header" for x in got) and any(x[3] == "mit-text" for x in got)


def joined(rule):
    return " ".join(L.SENTENCES[s][0] for s in dict((r[0], r[2]) for r in L.RULES)[rule])


def test_published_texts_on_one_line_wrapped_and_after_a_lead_in(spark):
    cases = {}
    for rule, lic, steps in L.RULES:
        body = joined(rule)
        for text in (body, f"Title 1.0 Copyright (c) 2024 Some Body {body}", wrap(body), f"Note: {body}", f"Read this first\n\n{body}\n\nBye."):
            cases[len(cases)] = (text, rule)
    cases[len(cases)] = ("MIT License Copyright (c) 2020 A. Person " + joined("mit-text"), "mit-text")
    cases[len(cases)] = ("MIT License Copyright (c) 2020 A. Person " + joined("mit-text"), "mit-title")
    bsd = [L.SENTENCES[s][0] for s in ("bsd-grant", "bsd-source", "bsd-binary")]
    cases[len(cases)] = (f"BSD Copyright 2020, Me. {bsd[0]} 1. {bsd[1]} 2. {bsd[2]}", "bsd2-text")
    cases[len(cases)] = ("Note: Licensed under the MIT License.", "mit-notice")
    df = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string")
    got = {}
    for r in L.scan(df).collect():
        got.setdefault(r.doc_id, set()).add(r.rule)
    lone = {r[0] for r in L.RULES if len(r[2]) == 1 and len(L.normal_form(L.SENTENCES[r[2][0]][0]).split()) < L.STARTER_WORDS}
    missed = [(rule, text) for i, (text, rule) in cases.items() if rule not in got.get(i, ())]
    # a title of three words or fewer is only known as a line or sentence of its own
    assert all(rule in lone for rule, _ in missed), [m for m in missed if m[0] not in lone]


def test_extra_columns_and_very_long_texts(spark):
    long = "Plain words about rights and wrongs of ants. " * 20_000 + joined("mit-text")
    df = spark.createDataFrame([(1, long, "a", 2, [1])], "doc_id long, text string, m string, lines int, names array<int>")
    assert [(r.doc_id, r.rule) for r in L.scan(df).collect()] == [(1, "mit-text")]


def test_empty(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
