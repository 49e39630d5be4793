"""Nothing is lost silently: absent fields, superseded rows, broken lines,
unknown classes, and fixtures that really join."""

import pytest
from pyspark.sql import functions as F

from docsmith.functions.labels import prompt
from docsmith.operators import catalog as CT
from docsmith.operators import hierarchy as HY
from docsmith.operators import labelling as LL
from docsmith.operators import pages as PG
from docsmith.plans.views import spark_view
from docsmith.sources import io as IO
from tests.conftest import SF_SMALL


def write(tmp_out, *lines):
    path = f"{tmp_out}/in.jsonl"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_absent_score_is_the_default_and_null_fails_its_module(spark, tmp_out):
    path = write(
        tmp_out,
        '{"module_name": "m1", "class_name": "A", "class_doc": "Doc.", "synopsis": "S."}',
        "",
        '{"module_name": "m2", "class_name": "B", "class_doc": "Doc.", "visibility_score": null}',
        '{"module_name": "m2", "class_name": "C", "class_doc": "Doc.", "visibility_score": 0.7}',
        '{"module_name": "m3", "class_name": "D", "class_doc": "old", "visibility_score": null}',
        '{"module_name": "m3", "class_name": "D", "class_doc": "new", "visibility_score": 0.5}',
        '{"module_name": "m4", "class_name": "E"}',
    )
    recs = IO.read_records(spark, path, with_seq=True, with_flags=True)
    got = {r.module_name: (r.status, r.class_count) for r in PG.module_results(recs, "seq").collect()}
    assert got == {"m1": ("success", 1), "m2": ("error", 0), "m3": ("success", 1), "m4": ("success", 1)}
    pages = {r.path: r.content for r in PG.module_pages(recs, "seq").collect()}
    assert set(pages) == {"m1/A.md", "m3/D.md", "m4/E.md"}
    assert "new" in pages["m3/D.md"] and "S." in pages["m1/A.md"]


def test_latest_row_with_a_null_order_or_payload(spark):
    df = spark.createDataFrame([("k", None, "first"), ("k", 2, None), ("j", None, "only"), ("i", 1, "b"), ("i", 1, "a")], "k string, o int, v string")
    got = {r.k: r.v for r in LL.latest_per_key(df, ["k"], "o").collect()}
    assert (got["k"], got["j"]) == (None, "only")
    again = {r.k: r.v for r in LL.latest_per_key(df.orderBy(F.desc("v")), ["k"], "o").collect()}
    assert got == again


@pytest.mark.parametrize("line", ['{"module_name": "m"', "not json"])
def test_broken_lines_fail_the_read(spark, tmp_out, line):
    path = write(tmp_out, '{"module_name": "m", "class_name": "A"}', line)
    for flags in (False, True):
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
            IO.read_records(spark, path, with_flags=flags).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        IO.read_label_cache(spark, path).collect()


def test_cache_line_without_a_class_fails(spark, tmp_out):
    path = write(tmp_out, '{"synopsis": "x"}')
    with pytest.raises(Exception, match="no class_name"):
        IO.read_label_cache(spark, path).collect()


def test_unknown_classes_have_no_methods(spark):
    classes = spark.createDataFrame([("A", True, True, 0, 0)], "class_name string, instantiable boolean, has_isa boolean, n_in long, n_out long")
    methods = spark.createDataFrame([("A", "Run", True), ("B", "Run", True)], "class_name string, method_name string, is_callable boolean")
    bases = spark.createDataFrame([], "class_name string, base_name string")
    ports = spark.createDataFrame([], "class_name string, direction string, port int, types array<string>")
    got = {r.class_name: r.semantic_methods for r in CT.catalog_profile(classes, bases, ports, methods).collect()}
    assert got == {"A": ["Run"], "B": []}
    assert [r.class_name for r in HY.semantic_methods(methods, classes).collect()] == ["A"]


def test_limits_are_parameters(spark):
    long = spark.createDataFrame([("A", "x" * 3000)], "class_name string, class_doc string")
    short, whole = (long.select(prompt("class_name", "class_doc", n).alias("p")).first().p for n in (100, 5000))
    assert "x" * 101 not in short and "x" * 3000 in whole
    rec = spark.sql("select 'm' as module_name, 'A' as class_name, transform(sequence(1, 9), i -> concat('M', i)) as semantic_methods")
    assert "*...and 6 more*" in PG.class_page(rec, shown_methods=3).first().content


def test_fixtures_join(spark):
    V = lambda n: spark_view(spark, n, SF_SMALL)
    prof = CT.catalog_profile(V("v_classes"), V("v_bases"), HY.ports_from_text(V("v_ports")),
                              V("v_help_methods").unionByName(V("v_methods")))
    for view in ("v_help", "v_records"):
        rows = CT.attach_profile(V(view).select("class_name"), prof).collect()
        assert len({r.role for r in rows}) >= 4
        assert any(r.input_datatype for r in rows) and any(r.output_datatype for r in rows)
        assert any(r.semantic_methods for r in rows) and any(not r.semantic_methods for r in rows)
        cache = LL.dedupe_label_cache(V("v_cache"), "seq")
        hits = LL.cache_hits(V(view).select("class_name"), cache).count()
        assert 0 < hits < len(rows)


def test_a_cluster_needs_its_own_checkpoint_folder(monkeypatch):
    from docsmith import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scratch_scope_removes_what_it_wrote(spark):
    import os

    from docsmith.session import materialize, scratch_scope

    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        inner = materialize(spark.range(3), "scoped")
        path = inner.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and inner.count() == 3
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3
