from collections import Counter

import __spark_entry__ as entry_point
import corpus_pipeline
from mensario.llm import decontam, mixing, simhash
from mensario.llm.common import cut, table
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD
from tests.llm.test_decontam import brute as leaked
from tests.llm.test_simhash import brute as classes
from tests.llm.test_simhash import plain


def test_registered():
    queries = entry_point.queries()
    assert [q for q in queries if q.startswith("op")] == [f for f in sorted((q for q in queries if q.startswith("op")), key=lambda q: int(q[2:].split("_")[0]))]
    assert {q.split("_")[0] for q in queries if q.startswith("op")} == {f"op{i}" for i in range(1, 11)} and "pipeline" in queries


def test_stages_take_effect_one_after_the_other(spark):
    docs = table(spark, TESTDATA, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = cut(stage(spark, docs, TESTDATA))
        assert docs.columns == columns
        kept[name] = docs.collect()
    assert len(kept["language"]) >= 0.99 * table(spark, TESTDATA, "documents").where("text <> ''").count()
    before = sorted((r.doc_id, r.text) for r in kept["language"])
    groups = classes([plain(t) for _, t in before])
    firsts = {before[k][0] for k in groups}
    assert {r.doc_id for r in kept["near_duplicates"]} == firsts and len(kept["near_duplicates"]) == len(firsts)
    items = [(r.item_id, r.text) for r in table(spark, TESTDATA, "benchmark").collect()]
    bad = {r[0] for r in leaked([(r.doc_id, r.text) for r in kept["near_duplicates"]], items) if r[2]}
    assert bad and {r.doc_id for r in kept["decontamination"]} == firsts - bad
    assert set(Counter(r.doc_id for r in kept["mixture"]).values()) <= {1, 2}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in kept["mixture"])


def test_stages_on_odd_and_empty_tables(spark, odd, docs):
    for df in (odd, docs([])):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, TESTDATA)
            assert out.count() <= 2 * len(ODD)
    assert simhash and mixing and decontam
