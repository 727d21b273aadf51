"""Each stage of the pipeline on the whole table, against plain Python on the stage's own input."""

import re

import corpus_pipeline
import pytest
from test_search import _brute

from tallyfold.llm import pii
from tallyfold.session import materialise


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tables):
    docs, out = tables("documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = materialise(stage(spark, docs, sf_dir), name)
        out[name] = (docs, result)
        docs = result
    return out


def test_stages_return_the_columns_of_documents(stages):
    for name, (docs, out) in stages.items():
        assert out.columns[: len(docs.columns)] == docs.columns, name


def test_rejected_documents_go_and_clean_ones_stay(stages, tables):
    docs, out = stages["quality_filter"]
    kept = {r.doc_id for r in out.collect()}
    label = {r.doc_id: r.quality for r in tables("labels").collect()}
    assert sum(i in kept for i, y in label.items() if y) >= 0.97 * sum(label.values())
    assert sum(i in kept for i, y in label.items() if not y) <= 0.3 * (len(label) - sum(label.values()))


def test_one_document_of_each_group_stays(stages):
    docs, out = stages["near_duplicates"]
    classes = _brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for c, _ in classes.values()})


def test_leaking_documents_go(stages, tables):
    docs, out = stages["benchmark_leaks"]
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [words(r.text) for r in tables("benchmark").collect()]
    leaks = {r.doc_id for r in docs.collect() if any(x in words(r.text) for x in items)}
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - leaks


def test_personal_data_is_masked(stages):
    docs, out = stages["personal_data"]
    before = {r.doc_id: r for r in docs.collect()}
    for r in out.collect():
        spans = [s[:3] for s in pii.spans_of(before[r.doc_id].text)]
        assert r.text == pii.masked(before[r.doc_id].text, spans) and not pii.spans_of(r.text)
    assert out.count() == len(before)


def test_run_is_the_stages_in_turn(spark, sf_dir, stages):
    key = ("doc_id", "copy")
    want = sorted(tuple(r) for r in stages["source_mix"][1].select(*key).collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select(*key).collect()) == want


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows(spark, sf_dir, odd_docs, number):
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, odd_docs, sf_dir)
    assert set(odd_docs.columns) <= set(out.columns) and out.count() <= 2 * odd_docs.count()
    assert stage(spark, odd_docs.limit(0), sf_dir).count() == 0
