"""The pipeline, stage by stage, and the registered queries."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_SMALL = "/root/testdata/sf0.001"

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402
import corpus_pipeline  # noqa: E402
from dispatchkit.llm import exact_dedup, jaccard_join, mixing, quality  # noqa: E402
from dispatchkit.llm import queries as llm_queries  # noqa: E402
from dispatchkit.llm.common import materialize, read_table  # noqa: E402


def test_one_query_per_operator():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("key", sorted(llm_queries.oracle_sql()))
def test_queries_equal_their_sql(spark, key):
    r = check_oracle.compare(spark, SF_SMALL, key, entry.queries()[key], entry.oracle_sql()[key])
    assert r["status"] == "MATCH" and "type_diff" not in r, r


@pytest.mark.parametrize("key", ["op2_source_mix", "op4_jaccard_join", "op6_token_files", "op7_exact_dedup", "op9_packing",
                                 "op10_substring_dedup", "op1_license_scan", "op3_fingerprints", "op5_quality_classifier",
                                 "op12_brown_lm"])
def test_queries_answer_every_document(spark, key):
    ids = {r[0] for r in read_table(spark, SF_SMALL, "documents").select("doc_id").collect()}
    got = [r[0] for r in entry.queries()[key](spark, SF_SMALL).select("doc_id").collect()]
    assert set(got) == ids and (key == "op9_packing" or len(got) == len(ids))


@pytest.mark.parametrize("key", ["op1_license_scan", "op2_source_mix", "op3_fingerprints", "op7_exact_dedup", "op8_url_lists"])
def test_native_queries_plan_no_python(spark, key):
    plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct",
                                       "BroadcastNestedLoopJoin"))


def test_pipeline_equals_its_stages_by_hand(spark):
    source = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels")
    good = {r.doc_id for r in quality.quality_scores(source, labels).filter("predicted = 1").collect()}
    docs = {r.doc_id: r for r in source.collect() if r.doc_id in good}
    by_text = {}
    for i in sorted(docs):
        by_text.setdefault(" ".join((docs[i].text or "").encode().decode().split(" ")), i)
    stages, now = [], source
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, SF_SMALL), f"test-{name}")
        stages.append(now)
        if name != "packing":
            assert now.columns == source.columns
    assert {r.doc_id for r in stages[0].collect()} == good
    texts = [r.text for r in stages[1].collect()]
    assert len(texts) == len(set(texts)) == stages[1].count() <= len(by_text)
    third = {r.doc_id for r in stages[2].collect()}
    assert third == {r.doc_id for r in jaccard_join.jaccard_components(stages[1]).filter("doc_id = component_id").collect()}
    copies = {r.doc_id: r.copies for r in mixing.taken_words(stages[2]).collect()}
    got = {}
    for r in stages[3].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: c for i, c in copies.items() if c}
    packed = stages[4].collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)
    assert sum(1 for r in packed if r.start == 0) == stages[3].count()
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(str, out.drop("ids", "sequence_id", "offset", "start", "length").distinct().collect())) == \
        sorted(map(str, stages[4].drop("ids", "sequence_id", "offset", "start", "length").distinct().collect()))


def test_stages_take_an_empty_table_and_odd_rows(spark, docs, no_docs):
    for start in (no_docs, docs.select("doc_id", "text", "lang", "source", "n_chars")):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, SF_SMALL), f"test-{name}")
        assert (now.count() == 0) == (start.count() == 0)


def test_entry_point_works_without_the_folder():
    import subprocess
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['dispatchkit.llm'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
    assert exact_dedup.SALTS > 1
