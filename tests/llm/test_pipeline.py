"""The pipeline's stages, each against a plain version on its own input, and the registered queries."""

from __future__ import annotations

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect
from starloom.llm import packing, quality, registry
from test_native import SCHEMA, mixed_plainly, naive_best_fit
from test_pairs import components_plainly, kept_plainly

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and output of every stage, written and read again."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{base}/{name}")
        docs = found[name] = spark.read.parquet(f"{base}/{name}")
    return found


def test_stages_keep_the_columns(steps):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_duplicates", "mix_sources", "pack"]
    for name in names[:-1]:
        assert steps[name].columns == steps["documents"].columns
        assert steps[name].count() > 0


def test_quality_stage(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = {r.doc_id for r in steps["quality_classifier"].collect()}
    scored = quality.op9(steps["documents"], labels).collect()
    assert kept == {r.doc_id for r in scored if r.predicted}
    good = [r.doc_id for r in labels.where("quality = 1").collect()]
    assert len(kept & set(good)) >= 0.97 * len(good)


def test_line_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps["quality_classifier"].collect()]
    plain = kept_plainly(rows)
    had = {i for i, t in rows if t.split()}
    found = {r.doc_id: r for r in steps["line_dedup"].collect()}
    assert {i: r.text for i, r in found.items()} == {i: t for i, t in plain.items() if t.split() or i not in had}
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_near_duplicate_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps["line_dedup"].collect()]
    firsts = {i for i, _, c in components_plainly(rows, corpus_pipeline.PERCENT) if i == c}
    assert {r.doc_id for r in steps["near_duplicates"].collect()} == firsts


def test_mix_stage(steps):
    rows = [(r.doc_id, r.text, r.source) for r in steps["near_duplicates"].collect()]
    copies = {i: taken // size for i, size, _, taken in mixed_plainly(rows) if size}
    found = {}
    for r in steps["mix_sources"].collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert {i: n for i, n in found.items() if i in copies} == {i: n for i, n in copies.items() if n}


def test_pack_stage(steps):
    coder = packing.Coder(packing.default_tokenizer())
    expected = sum(len(packing.bounds(len(coder.ids(r.text)) + 1, 2048)) for r in steps["mix_sources"].collect())
    found = steps["pack"].collect()
    assert len(found) == expected
    lengths = [r.length for r in found]
    assert len({r.sequence_id for r in found}) == len(naive_best_fit(lengths, 2048))


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA + ", lang string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_near_duplicate_stage_keeps_rows_without_id_and_other_texts_of_an_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "s"), (2, text, "s"), (2, "another text of this id, quite on its own here", "s"), (None, text, "s"), (None, "b", "s")]
    docs = spark.createDataFrame([(*r, "en", 1) for r in rows], SCHEMA + ", lang string, n_chars bigint")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((str(r.doc_id), r.text[:2]) for r in kept) == [("1", "w0"), ("2", "an"), ("None", "b"), ("None", "w0")]


def test_near_duplicate_stage_keeps_one_text_of_a_repeated_id(spark):
    words = [f"w{i}" for i in range(100)]
    near, far = " ".join([*words[:-2], "x", "y"]), " ".join(f"z{i}" for i in range(50))
    rows = [(1, " ".join(words), "s"), (1, near, "s"), (1, far, "s"), (2, near + " more", "s"), (3, "", "s"), (3, None, "s"), (3, far, "s")]
    docs = spark.createDataFrame([(*r, "en", 1) for r in rows], SCHEMA + ", lang string, n_chars bigint")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id, (r.text or "")[:1]) for r in kept) == [(1, "w"), (1, "z"), (3, ""), (3, "")]


def test_queries_are_registered():
    names = queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names
    assert set(oracle_sql()) >= set(registry.ORACLES)


def test_pipeline_runs(spark):
    assert queries()["pipeline"](spark, SF_DIR).columns[:2] == ["doc_id", "piece"]


@pytest.mark.parametrize("name", list(registry.ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(registry.QUERIES[name](spark, folder), connect(folder), registry.ORACLES[name]) is None
