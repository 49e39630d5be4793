"""The pipeline's stages against plain Python, and the contract around them."""

import os
import re

import pytest

import corpus_pipeline as pipeline
from docsmith.llm import op2_mixing, op4_quality_votes, op7_simhash_trie, op10_secret_scan
from docsmith.llm.queries import ORACLE, QUERIES
from docsmith.session import materialize
from tests.conftest import SF_SMALL
from tests.llm.test_operators import plain_base, plain_components, plain_simhash

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = [docs.collect()]
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), name.replace(" ", "-"))
        seen.append(docs.collect())
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    raw, good, single, clean, mixed, packed = seen
    assert 0 < len(good) < len(raw) and {r.doc_id for r in good} <= {r.doc_id for r in raw}
    assert all(len(r.text.split()) >= 50 for r in good)
    groups = plain_components([(r.doc_id, plain_simhash(r.text)) for r in good], op7_simhash_trie.MAX_BITS)
    assert sorted(r.doc_id for r in single) == sorted(set(groups.values()))
    before = {r.doc_id: r.text for r in single}
    assert {r.doc_id for r in clean} == set(before)
    for r in clean:
        assert not plain_base(r.text) and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or "[SECRET]" in r.text
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean} and sum(len(r.text.split()) for r in mixed) >= 0.85 * op2_mixing.BUDGET * sum(len(r.text.split()) for r in clean)
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}


def test_mixing_stage_meets_the_targets(spark):
    n = 6000
    kinds = [("plain words only " * 5, 0.93), ("write to me@example.org now " * 4, 0.05), ("copyright notice of a text " * 3, 0.02)]
    texts = [t for t, share in kinds for _ in range(round(share * n))]
    rows = [(i, t, ("es" if i % 19 == 0 else "en"), ("hot" if i % 3 else f"src{i % 7}"), len(t)) for i, t in enumerate(texts)]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "mix-test")
    told = op2_mixing.shares(op2_mixing.mix_probabilities(docs)[1]).collect()
    assert len(told) == 8 + 2 + 3
    for r in told:
        assert r.expected == pytest.approx(r.reachable, rel=1e-3), r
    sample = [(r.lang, r.source, r.text, len(r.text.split())) for r in pipeline.source_mixing(spark, docs, "").collect()]
    total = sum(r[3] for r in sample)
    text_of = {"contact": kinds[1][0], "legal": kinds[2][0], "short prose": kinds[0][0]}
    for r in told:
        own = sum(x[3] for x in sample if r.value in x[:2] or text_of.get(r.value) == x[2])
        assert own / total == pytest.approx(r.reachable, rel=0.12), r
    assert total == pytest.approx(op2_mixing.BUDGET * sum(len(t.split()) for t in texts), rel=0.03)


def test_sql_of_the_operators(spark):
    from tools.oracle_check import check

    results = check(spark, SF_SMALL, names=list(ORACLE), verbose=False)
    assert {n: r[0] for n, r in results.items()} == {n: "OK" for n in ORACLE}


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert len(pipeline.STAGES) == 5


@pytest.mark.parametrize("module", [op4_quality_votes, op10_secret_scan])
def test_native_operators_have_no_python_in_their_plans(spark, module, monkeypatch):
    """Neither in the plan of a result, nor in those of what is written on the way."""
    plans = []
    told = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(module, "materialize", lambda df, tag: materialize(told(df), tag))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for result in ([module.quality_votes, module.keep_good] if module is op4_quality_votes else [module.scan, module.redact]):
        told(result(docs))
    assert len(plans) >= 3
    assert not [p for p in plans if re.search("Python|Pandas|Arrow|ExistingRDD", p)]
