"""Sources, sinks, the end-to-end build and the streaming build."""

import json
import os

import pytest

from docsmith.operators import catalog as CT
from docsmith.operators import labelling as LL
from docsmith.operators import pages as PG
from docsmith.plans.jobs import build_all
from docsmith.sources import io as IO
from docsmith.streaming.incremental import catalog_stream, read_catalog
from tests.test_helpparse import DUP, FOO


def test_records_round_trip_keeps_nulls_and_unicode(spark, tmp_out):
    recs = spark.createDataFrame(
        [("vtkÄ", "mod", "Dokumentation ✓", None, "utility", "", "", ["X"], "Syn.", None, 0.3)],
        IO.RECORD)
    IO.write_records(recs, f"{tmp_out}/records")
    raw = "".join(open(os.path.join(f"{tmp_out}/records", f), encoding="utf-8").read()
                  for f in os.listdir(f"{tmp_out}/records") if f.endswith(".json"))
    row = json.loads(raw.strip().splitlines()[0])
    assert row["class_name"] == "vtkÄ" and "Dokumentation ✓" in raw  # not \\u-escaped
    assert "action_phrase" in row and row["action_phrase"] is None
    back = IO.read_records(spark, f"{tmp_out}/records").first()
    assert back.class_name == "vtkÄ" and back.semantic_methods == ["X"]


def test_missing_sources(spark, tmp_out):
    assert IO.read_records(spark, f"{tmp_out}/nope", missing_ok=True).count() == 0
    with pytest.raises(Exception):
        IO.read_records(spark, f"{tmp_out}/nope").count()
    assert IO.read_stubs(spark, f"{tmp_out}/nope").count() == 0
    assert IO.read_label_cache(spark, f"{tmp_out}/nope").count() == 0


def test_defaults_on_read(spark, tmp_out):
    os.makedirs(f"{tmp_out}/r")
    with open(f"{tmp_out}/r/part.json", "w") as f:
        f.write('{"class_name": "vtkA"}\n{"module_name": "m"}\n')
    rows = {(r.module_name, r.class_name) for r in IO.read_records(spark, f"{tmp_out}/r").collect()}
    assert rows == {("unknown", "vtkA"), ("m", "")}


def test_label_cache_blank_lines_last_wins(spark, tmp_out):
    os.makedirs(f"{tmp_out}/cache")
    with open(f"{tmp_out}/cache/llm-cache.jsonl", "w") as f:
        f.write('{"class_name": "vtkA", "synopsis": "old", "action_phrase": "", "visibility_score": 0.1}\n')
        f.write("\n   \n")
        f.write('{"class_name": "vtkB", "synopsis": "b", "action_phrase": "x", "visibility_score": 0.5}\n')
        f.write('{"class_name": "vtkA", "synopsis": "new", "action_phrase": "y", "visibility_score": 0.9}\n')
    got = {r.class_name: (r.synopsis, r.visibility_score) for r in IO.read_label_cache(spark, f"{tmp_out}/cache").collect()}
    assert got == {"vtkA": ("new", 0.9), "vtkB": ("b", 0.5)}


def test_stub_and_help_text_sources(spark, tmp_out):
    os.makedirs(f"{tmp_out}/stubs/sub")
    for name, body in [("vtkA.pyi", "class vtkA:\n"), ("vtkB.pyi", "x\n"), ("notes.txt", "no"),
                       ("sub/vtkC.pyi", "deep\n")]:
        with open(f"{tmp_out}/stubs/{name}", "w") as f:
            f.write(body)
    got = {r.module_name: r.content for r in IO.read_stubs(spark, f"{tmp_out}/stubs").collect()}
    assert got == {"vtkA": "class vtkA:\n", "vtkB": "x\n"}
    os.makedirs(f"{tmp_out}/help/vtkmodules.vtkCommonCore")
    with open(f"{tmp_out}/help/vtkmodules.vtkCommonCore/vtkFoo.txt", "w") as f:
        f.write(FOO)
    h = IO.read_help_dump(spark, f"{tmp_out}/help/*", fmt="text").first()
    assert (h.module_name, h.class_name, h.help_text) == ("vtkCommonCore", "vtkFoo", FOO)


def _catalog_inputs(spark):
    help_dump = spark.createDataFrame([("vtkmodules.vtkCommonCore", "vtkFoo", FOO), ("vtkCommonCore", "vtkDup", DUP),
                                       ("vtkOther", "vtkLonely", "class vtkLonely\n |  Alone.\n")],
                                      "module_name string, class_name string, help_text string")
    classes = spark.createDataFrame([("vtkFoo", True, True, 0, 1)],
                                    "class_name string, instantiable boolean, has_isa boolean, n_in bigint, n_out bigint")
    bases = spark.createDataFrame([("vtkFoo", "vtkAlgorithm")], "class_name string, base_name string")
    ports = spark.createDataFrame([("vtkFoo", "out", 0, ["vtkPolyData"])],
                                  "class_name string, direction string, port int, types array<string>")
    methods = spark.createDataFrame([("vtkFoo", "Other", True), ("vtkFoo", "GetX", True)],
                                    "class_name string, method_name string, is_callable boolean")
    return help_dump, classes, bases, ports, methods


def test_build_all_end_to_end(spark, tmp_out):
    help_dump, classes, bases, ports, methods = _catalog_inputs(spark)
    cache = spark.createDataFrame([("vtkDup", "Cached.", "caching", 0.8)], IO.LABEL)
    stubs = spark.createDataFrame([("vtkCommonCore", "class vtkFoo(vtkAlgorithm):\n    pass\n")],
                                  "module_name string, content string")
    res = build_all(spark, help_dump, classes, bases, ports, methods, f"{tmp_out}/out", stubs=stubs,
                    label_cache=cache, labeller=LL.default_labeller)
    assert res.ok and res.stages == ["catalog", "labels", "records", "stubs", "pages"]
    recs = {r.class_name: r for r in IO.read_records(spark, f"{tmp_out}/out/records").collect()}
    assert recs["vtkFoo"].module_name == "vtkCommonCore"          # bare module name
    assert recs["vtkFoo"].role == "input" and recs["vtkFoo"].output_datatype == "vtkPolyData"
    assert recs["vtkFoo"].semantic_methods == ["GetX", "Other"]
    assert recs["vtkDup"].synopsis == "Cached." and recs["vtkDup"].visibility_score == 0.8
    assert recs["vtkFoo"].synopsis == "vtkFoo docs."               # default labeller on a miss
    assert res.summary["catalog"] == {"total_records": 3, "modules": 2, "total_methods": 5}
    assert res.summary["labels"] == {"classified": 3, "total": 3}
    assert res.summary["pages"]["modules_ok"] == 2
    stub = IO.read_stubs(spark, f"{tmp_out}/out/stubs").first()
    assert stub.content.startswith('class vtkFoo(vtkAlgorithm):\n    """vtkFoo - a test class.')
    pages = spark.read.parquet(f"{tmp_out}/out/pages")
    assert pages.count() == 3
    assert {r.module_name for r in pages.select("module_name").collect()} == {"vtkCommonCore", "vtkOther"}


def test_streaming_catalog(spark, tmp_out):
    help_dump, classes, bases, ports, methods = _catalog_inputs(spark)
    help_dump.limit(2).write.parquet(f"{tmp_out}/in/batch1")
    profile = CT.catalog_profile(classes, bases, ports, methods)
    q = catalog_stream(spark, f"{tmp_out}/in/*", profile, f"{tmp_out}/cat", f"{tmp_out}/ckpt")
    q.awaitTermination(120)
    out = read_catalog(spark, f"{tmp_out}/cat")
    assert out.count() == 2
    assert {r.role for r in out.collect()} <= {"input", "utility"}


def test_label_cache_export_round_trip(spark, tmp_out):
    recs = spark.createDataFrame([
        ("vtkA", "m", "Syn A.", "", 0.4), ("vtkB", "m", "", "", 0.9), ("vtkC", "m", "", "act", None),
    ], "class_name string, module_name string, synopsis string, action_phrase string, visibility_score double")
    exported = CT.export_label_cache(recs)
    IO.write_label_cache(exported, f"{tmp_out}/cache")
    back = {r.class_name: (r.synopsis, r.action_phrase, r.visibility_score)
            for r in IO.read_label_cache(spark, f"{tmp_out}/cache").collect()}
    assert back == {"vtkA": ("Syn A.", "", 0.4), "vtkC": ("", "act", 0.3)}


def test_labeller_failures_are_isolated(spark):
    def flaky(batch):
        out = []
        for name in batch["class_name"]:
            if name.endswith("3"):
                raise RuntimeError("model error")
            out.append('{"synopsis": "ok", "visibility_score": 0.5}' if not name.endswith("5")
                       else "not json")
        return out

    reqs = spark.createDataFrame([(f"vtkC{i}", "doc" if i != 7 else "  ") for i in range(10)],
                                 "class_name string, class_doc string")
    labels = {r.class_name: r.synopsis for r in LL.label_classes(reqs, None, labeller=flaky, concurrency=3).collect()}
    # raising rows and unparsable replies get no label; blank docs never reach the labeller
    assert set(labels) == {f"vtkC{i}" for i in range(10)} - {"vtkC3", "vtkC5", "vtkC7"}
    assert set(labels.values()) == {"ok."}


def test_read_records_file_order(spark, tmp_out):
    os.makedirs(f"{tmp_out}/ordered")
    for f, names in (("a.json", ["vtkZ", "vtkA", "vtkM"]), ("b.json", ["vtkB", "vtkA"])):
        with open(f"{tmp_out}/ordered/{f}", "w") as fh:
            fh.writelines(json.dumps({"class_name": n, "module_name": "m", "synopsis": f + n}) + "\n" for n in names)
    recs = IO.read_records(spark, f"{tmp_out}/ordered", with_seq=True)
    ordered = [r.synopsis for r in recs.orderBy("seq").collect()]
    assert ordered == ["a.jsonvtkZ", "a.jsonvtkA", "a.jsonvtkM", "b.jsonvtkB", "b.jsonvtkA"]
    # last wins in file order
    latest = LL.latest_per_key(recs.select("class_name", "synopsis", "seq"), ["class_name"], "seq")
    assert {r.class_name: r.synopsis for r in latest.collect()}["vtkA"] == "b.jsonvtkA"


def test_build_with_a_hot_module_and_copies(spark, tmp_out):
    # one module holds most classes, a third of the dump rows are copies of one
    # class, and the same class name appears in many modules
    hot = [("vtkHot", f"vtkH{i}", f"class vtkH{i}\n |  Hot {i}.\n") for i in range(60)]
    copies = [("vtkHot", "vtkH0", "class vtkH0\n |  Hot 0.\n")] * 40
    spread = [(f"vtkM{i}", "vtkShared", "class vtkShared\n |  Shared.\n") for i in range(20)]
    dump = spark.createDataFrame(hot + copies + spread, "module_name string, class_name string, help_text string")
    _, classes, bases, ports, methods = _catalog_inputs(spark)
    res = build_all(spark, dump, classes, bases, ports, methods, f"{tmp_out}/hot")
    assert res.ok
    recs = IO.read_records(spark, f"{tmp_out}/hot/records")
    assert recs.count() == 60 + 20
    assert {r.class_doc for r in recs.filter("class_name = 'vtkH0'").collect()} == {"Hot 0."}
    idx = {r.module_name: r.content for r in PG.assemble(spark.read.parquet(f"{tmp_out}/hot/module_index"),
                                                         ["module_name"]).collect()}
    assert idx["vtkHot"].startswith("# vtkHot\n\n**60 classes**")
    assert res.summary["pages"] == {"modules_ok": 21, "modules_total": 21, "classes_total": 80}


def test_streaming_epochs_and_restart(spark, tmp_out):
    help_dump, classes, bases, ports, methods = _catalog_inputs(spark)
    help_dump.filter("class_name = 'vtkFoo'").write.parquet(f"{tmp_out}/in2/a")
    help_dump.filter("class_name != 'vtkFoo'").coalesce(1).write.parquet(f"{tmp_out}/in2/b")
    profile = CT.catalog_profile(classes, bases, ports, methods)
    args = (spark, f"{tmp_out}/in2/*", profile, f"{tmp_out}/cat2", f"{tmp_out}/ckpt2")
    q = catalog_stream(*args, max_files_per_trigger=1)
    q.awaitTermination(180)
    out = read_catalog(spark, f"{tmp_out}/cat2")
    assert out.count() == 3
    assert out.select("epoch").distinct().count() == 2          # one file per micro-batch
    # a restart on the same checkpoint finds nothing new: no epoch is redone
    q2 = catalog_stream(*args, max_files_per_trigger=1)
    q2.awaitTermination(180)
    assert read_catalog(spark, f"{tmp_out}/cat2").count() == 3


def test_label_fields_copied_as_given(spark):
    reqs = spark.createDataFrame([("vtkA", "doc"), ("vtkB", "doc"), ("vtkC", "doc")],
                                 "class_name string, class_doc string")
    replies = spark.createDataFrame([
        ("vtkA", '{"synopsis": "a", "action_phrase": null}'),   # present but null: copied as null
        ("vtkB", '{"visibility_score": 0.7}'),                   # absent fields: defaults
    ], "class_name string, content string")
    labels = LL.label_classes(reqs, None, responses=replies)
    got = {r.class_name: (r.synopsis, r.action_phrase, r.visibility_score, r.matched)
           for r in LL.apply_labels(reqs, labels).collect()}
    assert got == {"vtkA": ("a.", None, 0.3, True), "vtkB": ("", "", 0.7, True), "vtkC": ("", "", 0.3, False)}


def test_help_dump_parquet_source(spark, tmp_out):
    spark.createDataFrame([("vtkmodules.vtkCommonCore", "vtkFoo", FOO, 1)],
                          "module_name string, class_name string, help_text string, extra int") \
        .write.parquet(f"{tmp_out}/dump")
    h = IO.read_help_dump(spark, f"{tmp_out}/dump")
    assert h.columns == ["module_name", "class_name", "help_text"]
    assert h.first().module_name == "vtkCommonCore"
