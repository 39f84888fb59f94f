"""The pipeline's stages, each on its own input, and the registered queries over sf0.001."""

from __future__ import annotations

import collections
import importlib
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import toxicity
from tallymart.llm._graph import union_find
from tallymart.llm.oracle import llm_oracle
from tallymart.llm.queries import llm_queries
from tests.check_oracle import compare, connect
from tests.llm.data import documents, prose, shingles
from tests.llm.test_models_and_search import labelled, toxic

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(12)
    rows, labels = labelled(21, 500, toxic)
    passage = " ".join(f"bench{i}" for i in range(30))
    rows += [(1000 + i, rows[8][1]) for i in range(5)] + [(1010, rows[9][1] + " added")]
    rows += [(1020 + i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(3)]
    rows += [(1030, f"{prose(rng, 900)} {' '.join(passage.split()[:14])}")]
    rows += [(None, prose(rng, 50)), (None, "again " + prose(rng, 50)), (1040, None), (1041, ""), (1050, prose(rng, 60)), (1050, prose(rng, 60))]
    documents(spark, rows).drop("size").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect_on_what_the_one_before_kept(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs.collect(), spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        seen.append(name)
        if name != "sharding":
            assert docs.columns == columns
        ids = collections.Counter(r.doc_id for r in after)
        if name == "toxicity":
            labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
            bad = {r.doc_id for r in labels if r.toxic}
            assert len([i for i in bad if i in ids]) <= 0.05 * len(bad)
            clean = [r for r in before if r.doc_id not in bad]
            assert sum(r.doc_id in ids for r in clean) >= 0.98 * len(clean)
        elif name == "near_dedup":
            texts = {r.doc_id: r.text for r in before if r.doc_id is not None and r.doc_id != 1050}
            sets = {i: shingles(t, 5) for i, t in texts.items()}
            some = [i for i in sets if sets[i]]
            links = [(a, b) for n, a in enumerate(some) for b in some[:n] if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
            lost = {i for i, root in union_find(links).items() if i != root}
            assert lost and set(ids) - {None, 1050} == set(texts) - lost
            assert ids[1050] == 2 and ids[None] == 2  # different texts, so no copy is left of either
        elif name == "decontamination":
            assert {r.doc_id for r in before} - set(ids) == {1020, 1021, 1022} and 1030 in ids
        elif name == "mixture":
            assert set(ids.values()) <= {1, 2} | ({ids[None]} if None in ids else set())
            words = sum(len(r.text.split()) for r in before if r.text)
            assert abs(sum(len(r.text.split()) for r in after if r.text) / (1.5 * words) - 1) < 0.02
        else:
            assert sum(ids.values()) == len(before)
            assert {r.shard for r in after} == set(range(8))
    assert seen == ["toxicity", "near_dedup", "decontamination", "mixture", "sharding"]


def test_run_equals_its_stages_and_takes_empty_tables(spark, folder, tmp_path):
    once = corpus_pipeline.run(spark, folder).drop("slot")
    again = corpus_pipeline.run(spark, folder).drop("slot")
    assert sorted(map(repr, once.collect())) == sorted(map(repr, again.collect()))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rejected_documents_are_those_scored_toxic(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = corpus_pipeline.toxicity_stage(spark, docs, folder)
    assert kept.count() == toxicity.score(docs, model).filter(F.col("toxicity") < 0.3).count()


def test_texts_that_share_an_id_are_decided_each_by_itself(spark, tmp_path):
    rng = random.Random(31)
    one, other, third = (prose(rng, 80) for _ in range(3))
    passage = " ".join(f"bench{i}" for i in range(30))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = [(3, one), (5, f"{one} added"), (5, other), (7, third), (7, third)]
    kept = corpus_pipeline.near_dedup_stage(spark, documents(spark, near), str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, one), (5, other), (7, third)]
    mixed = [(5, f"{passage} {one}"), (5, other), (6, third)]
    kept = corpus_pipeline.decontamination_stage(spark, documents(spark, mixed), str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, other), (6, third)]


def test_every_text_of_a_shared_id_stays_once(spark, tmp_path):
    rng = random.Random(32)
    rows = [(7, prose(rng, 60)) for _ in range(6)] * 2
    for turn in range(2):
        docs = documents(spark, rows[turn * 3 :] + rows[: turn * 3])
        kept = corpus_pipeline.near_dedup_stage(spark, docs, str(tmp_path)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == sorted(set(rows))


def test_columns_with_clashing_names_keep_their_values(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns(
        {x: F.concat(F.lit(x), F.substring("text", 1, 9)) for x in ("toxicity", "_key", "_key_copies", "_copies", "_copy", "_shared", "a.b", "first")}
    )
    for _, step in corpus_pipeline.STAGES[:4]:
        out = step(spark, docs, folder)
        assert out.columns == docs.columns
        for x in ("toxicity", "_key", "_key_copies", "_copies", "_copy", "_shared", "a.b", "first"):
            assert out.filter(~F.col(f"`{x}`").eqNullSafe(F.concat(F.lit(x), F.substring("text", 1, 9)))).count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")
@pytest.mark.parametrize("name", sorted(llm_oracle()))
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert ok, note


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 14)]


def test_entry_works_without_the_operators(monkeypatch):
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline", *llm_queries()} <= set(entry.queries())
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n.startswith(("tallymart.llm", "corpus")) else real(n, *a))
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert "silver_stores" in bare.queries() and not any(n.startswith("op") or n == "pipeline" for n in bare.queries())
    assert set(bare.oracle_sql()) == set(bare.queries())
