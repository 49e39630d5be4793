"""Physical-plan properties that matter at scale."""

import re

from docsmith.operators import helpparse as hp
from docsmith.operators import pages as PG
from docsmith.session import cluster_conf
from docsmith.sources import io as IO
from tests.test_helpparse import DUP, FOO


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_help_dump_parses_without_shuffle(spark):
    dump = spark.createDataFrame([("m", "vtkFoo", FOO), ("m", "vtkDup", DUP), ("n", "vtkFoo", FOO)],
                                 "module_name string, class_name string, help_text string")
    IO.write_help_dump_bucketed(dump, "help_dump_bucketed_test", 4)
    try:
        table = spark.table("help_dump_bucketed_test")
        nested = hp.structured_docs(table, prepartitioned=True)
        plan = _plan(nested)
        assert "Exchange" not in plan
        assert nested.count() == 3
    finally:
        spark.sql("drop table if exists help_dump_bucketed_test")


def test_index_lines_never_gather_a_module(spark):
    # one module holding most classes: the index is line rows, no per-module collection
    recs = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'vtkOther' || (id % 7) else 'vtkHot' end as module_name",
        "concat('vtkC', id) as class_name", "'s' as synopsis", "id as seq")
    plan = _plan(PG.module_index_lines(recs, "seq"))
    assert "listagg" not in plan and "collect_list" not in plan


def test_class_pages_do_not_shuffle(spark):
    recs = spark.range(10).selectExpr("'m' as module_name", "concat('vtkC', id) as class_name",
                                      "'d' as class_doc", "'' as synopsis", "0.5 as visibility_score")
    assert "Exchange" not in _plan(PG.class_page(recs))


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_line_level_stubs_never_gather_a_file(spark, tmp_path):
    from docsmith.operators import stubs as SB

    (tmp_path / "vtkHot.pyi").write_text("\n".join(f"class vtkC{i}:\n    pass" for i in range(200)) + "\n")
    recs = spark.createDataFrame([("vtkHot", "vtkC1", "d")], "module_name string, class_name string, class_doc string")
    plan = _plan(SB.annotate_stub_lines(IO.read_stub_lines(spark, str(tmp_path)), recs))
    assert "listagg" not in plan and "collect_list" not in plan
    # the only windows are per split (file, block) and per file over the split summaries
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        assert "block" in spec


def test_checkpoint_dir_comes_from_the_session(spark):
    from docsmith.session import ensure_checkpoint_dir, materialize

    named = spark.sparkContext.getCheckpointDir()
    assert named and ensure_checkpoint_dir(spark) == named      # never replaced once set
    back = materialize(spark.range(5), "probe")
    assert back.count() == 5
    base = named.split(":", 1)[-1].strip("/")        # file:/x and file:///x name the same folder
    assert back.inputFiles() and all(base in f for f in back.inputFiles())
