import os
import random
from collections import Counter

import pytest

import corpus_pipeline as P
from tallycast.llm import labelled, latent_decontam, mixing_tree, queries, simhash_bytes

SF = "/root/testdata/sf0.001"


def small_tables(spark, folder):
    rng = random.Random(12)
    words = ["ation", "thing", "eshor", "nded", "whor", "reon", "ouble", "ingha", "stly", "anea", "thre", "blen"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", ",", "."]) for _ in range(n))
    items = [(k, prose(30)) for k in range(5)]
    docs, labels = [], []
    for i in range(220):
        bad = rng.random() < 0.25
        text = " ".join(w.upper() + "!!" for w in prose(60).split()) if bad else prose(rng.randrange(40, 160))
        docs.append([i, text, "en", rng.choice(["a", "b", "b", "b", None]), len(text)])
        labels.append((i, int(not bad), 0))
    for i in range(10):
        docs.append([1000 + i, docs[i][1], "en", "a", 1])           # exact copies
        docs.append([2000 + i, prose(30) + " " + items[i % 5][1] + " " + prose(20), "en", "b", 1])  # leaks
    docs += [[3000, None, None, None, None], [3001, "", "en", "a", 0], [3002, prose(9000), "en", "b", 1]]
    for name, rows, kind in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
                             ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")
    return docs, {i for i, q, _ in labels if not q}


def test_each_stage_takes_effect(spark, tmp_path):
    rows, bad = small_tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, [set(r[0] for r in rows)]
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "shards"]
    outs = []
    for i, (name, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        outs.append(docs.collect())
        if name != "shards":
            assert docs.columns == columns
        kept.append({r.doc_id for r in outs[-1]})
        assert kept[-1] <= kept[-2]
    quality, unique, clean, mixed, sharded = outs
    assert len(bad & kept[1]) < 0.1 * len(bad) and len(kept[1] - bad) > 0.95 * (len(rows) - len(bad))
    # near duplicates: exactly one document of every component of the stage's own input
    again = simhash_bytes.near_duplicates(spark.read.parquet(f"{tmp_path}/out/quality")).collect()
    assert kept[2] == {r.component_id for r in again}
    # decontamination: what the operator reports on the stage's input goes, everything else stays
    leaks = latent_decontam.leaks(spark.read.parquet(f"{tmp_path}/out/near_duplicates"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    gone = {r.doc_id for r in leaks.collect()}
    assert {2000 + i for i in range(10)} & kept[2] <= gone and kept[3] == kept[2] - gone
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    per = Counter(r.shard for r in sharded)
    assert len(sharded) == len(mixed) and max(per.values()) - min(per.get(s, 0) for s in range(16)) <= 1


def test_stages_tell_rows_apart_and_keep_clashing_columns(spark):
    """Null and repeated ids, columns named like helpers, very long texts."""
    rng = random.Random(3)
    words = ["ation", "thing", "eshor", "nded", "whor", "reon", "ouble", "ingha"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(n))
    texts = [prose(60) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (4, texts[2]), (9, texts[0]), (10, prose(20_000)), (11, None), (12, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, n, "u", "v", 7, 8) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, _row int, _id string, _h string, _words int, _copies int")
    kept = simhash_bytes.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    # equal texts are one group, null and empty ones too: one row each, the smallest id's, a null id last
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect()) == sorted(
        [(False, 9, texts[0][:9]), (True, 0, texts[1][:9]), (False, 4, texts[2][:9]), (False, 4, texts[3][:9]), (False, 10, rows[7][1][:9]), (False, 11, "")])
    bench = spark.createDataFrame([(1, texts[1])], "item_id long, text string")
    clean = latent_decontam.drop_leaks(docs, bench)
    assert clean.columns == docs.columns and sorted(r._row for r in clean.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    mixed = mixing_tree.mixed_documents(docs, share=1.0)
    assert mixed.columns == docs.columns and Counter(r._row for r in mixed.collect()) == dict.fromkeys(range(10), 1)


def test_the_labelled_sample_is_bounded_in_rows_and_bytes(spark):
    texts = [(i, f"{i} " * 50) for i in range(60)] + [(7, "again")] * 40 + [(8, "x" * 100_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    got, y, _ = labelled.training_sample(docs, labels, "quality", 500)
    assert len(got) == len(y) <= 60 and sum(t == "again" for t in got) <= 1
    few, y, _ = labelled.training_sample(docs, labels, "quality", 500, class_bytes=1000)
    assert 2 <= len(few) < len(got) and sum(len(t) for t, k in zip(few, y) if k) <= 1000


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_entry_registers_one_query_per_operator(spark):
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in e.queries()
    assert set(queries.REGISTRY) == set(names) and set(e.oracle_sql()) <= set(e.queries())


def test_library_imports_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("tallycast", "__spark_entry__.py"):
        src = os.path.join(root, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if os.path.isdir(src) else {}))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not any(n.startswith('op') and n[2].isdigit() for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
