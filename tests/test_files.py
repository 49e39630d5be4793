"""The sink of plain files, and stub files read by lines and written again."""

import os

import pytest
from pyspark.sql import functions as F

from docsmith.operators import pages as PG
from docsmith.operators import stubs as SB
from docsmith.plans.jobs import build_all
from docsmith.sources import files as FS
from docsmith.sources import io as IO
from tests.test_io_jobs import _catalog_inputs


def found(folder):
    out = {}
    for at, _, names in os.walk(folder):
        for name in names:
            path = os.path.relpath(os.path.join(at, name), folder)
            if not path.startswith(FS.OUTCOMES):
                with open(os.path.join(folder, path), "rb") as f:
                    out[path] = f.read()
    return out


def rows(spark, *data):
    return spark.createDataFrame(data, "path string, data string, owner string, error string")


def test_files_replace_the_folder_and_tell_outcomes(spark, tmp_out):
    out = f"{tmp_out}/out"
    FS.write_files(rows(spark, ("a/x.md", "one", None, None), ("a/ä ö.md", "", None, None)), out)
    assert found(out) == {"a/x.md": b"one", "a/ä ö.md": b""}
    parts = rows(spark, *[("b.md", f"{i},", "o", None) for i in range(50)], ("c.md", None, None, "no such thing"))
    FS.write_files(FS.together(parts.repartition(7), F.expr("int(replace(data, ',', ''))")), out)
    assert found(out) == {"b.md": "".join(f"{i}," for i in range(50)).encode()}
    told = {r.path: (r.bytes, r.error) for r in FS.file_outcomes(spark, out).collect()}
    assert told == {"b.md": (140, None), "c.md": (0, "no such thing")}
    assert {r.path: bytes(r.data) for r in FS.read_files(spark, out, "*.md").collect()} == found(out)
    FS.write_files(rows(spark).filter("false"), out)
    assert found(out) == {} and FS.file_outcomes(spark, out).count() == 0
    assert os.listdir(tmp_out) == ["out"]


@pytest.mark.parametrize("bad", [[("../x.md", "x", None, None)], [("/etc/x", "x", None, None)], [(None, "x", None, None)], [("a", "x", "p", None), ("a", "y", "q", None)]])
def test_a_failed_task_leaves_the_old_files(spark, tmp_out, bad):
    out = f"{tmp_out}/out"
    FS.write_files(rows(spark, ("a.md", "old", None, None)), out)
    good = [(f"new{i}.md", "new", None, None) for i in range(20)]
    with pytest.raises(Exception, match="not the path|has rows from"):
        FS.write_files(rows(spark, *good, *bad).coalesce(1), out)
    with pytest.raises(Exception, match="not the path|has rows from"):
        FS.write_files(rows(spark, *good).repartition(4).unionByName(rows(spark, *bad).coalesce(1)), out)
    assert found(out) == {"a.md": b"old"} and os.listdir(tmp_out) == ["out"]


def test_a_commit_that_stopped_half_way_is_put_right(spark, tmp_out):
    out = f"{tmp_out}/out"
    FS.write_files(rows(spark, ("a.md", "old", None, None)), out)
    os.rename(out, f"{out}.old")
    with pytest.raises(Exception, match="not the path"):
        FS.write_files(rows(spark, ("..", "x", None, None)), out)
    assert found(out) == {"a.md": b"old"}


STUBS = {
    "vtkNoEnd": b"class A:\n    pass",
    "vtkEnd": b"class A:\n    pass\n",
    "vtkBlank": b"class A:\n\n\n\n    pass\n\n\n",
    "vtkAllBlank": b"class A:\n\n\n",
    "vtkLast": b"class A:",
    "vtkLastNl": b"class A:\n",
    "vtkEmpty": b"",
    "vtkNewline": b"\n",
    "vtkBom": b"\xef\xbb\xbfclass A:\r\n    pass\r\n",
    "vtkBomNoEnd": b"\xef\xbb\xbf# x\nclass A:\n    def f(self): ...",
    "vtkOnlyBom": b"\xef\xbb\xbf",
    "vtkHas": b"class A(B):\n    \"\"\"there\"\"\"\n",
    "vtkTwice": b"class A:\n  x\nclass A:\n  y\nclass AB:\n  z\n",
    "vtkBad": b"class A:\n    x = '\xff'\n",
    "otherBad": b"class A:\n    x = '\xff\xfe'",
    "vtkWide": "class A:\n    # äöü\u2028x\x85y\n".encode() * 3,
}


def plain_annotated(content, docs):
    """The whole-file rule, by plain string work on the original text."""
    text = content.decode("utf-8")
    lines = text.split("\n")
    inserts = {}
    for name, doc in docs.items():
        for i, line in enumerate(lines[:-1]):
            head = line.rstrip()
            if head.endswith(":") and f"class {name}" in head and head.split(f"class {name}", 1)[1][:1] in ("(", ":"):
                after = next((k for k in range(i + 1, len(lines)) if lines[k].strip()), None)
                if after is None:
                    inserts[len(lines) - 1] = doc
                elif not lines[after].strip().startswith(('"""', "'''")):
                    inserts[after] = doc
                break
    return "\n".join((f'    """{inserts[i]}"""\n' if i in inserts else "") + line for i, line in enumerate(lines)).encode()


@pytest.mark.parametrize("split", ["128m", "5b", "17b"])
def test_stub_files_by_lines_across_splits(spark, tmp_out, split):
    """Every file is cut at any byte; what is written equals the bytes that the
    whole-file rule gives."""
    os.makedirs(f"{tmp_out}/in")
    for name, data in STUBS.items():
        with open(f"{tmp_out}/in/{name}.pyi", "wb") as f:
            f.write(data)
    modules = [m for m in STUBS if m.startswith("vtk")]
    recs = spark.createDataFrame([(m, "A", "Doc of ä.") for m in modules] + [(m, "Z", "") for m in modules], "module_name string, class_name string, class_doc string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        annotated = SB.annotate_stub_lines(IO.read_stub_lines(spark, f"{tmp_out}/in"), recs)
        SB.write_stub_lines(annotated, f"{tmp_out}/lines")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    annotated = spark.read.parquet(f"{tmp_out}/lines")
    if split != "128m":
        assert annotated.filter("file LIKE '%vtkBlank%'").select("block").distinct().count() > 1
    IO.write_stub_files(annotated, f"{tmp_out}/out")
    want = {f"{m}.pyi": plain_annotated(data, {"A": "Doc of ä."} if m.startswith("vtk") else {}) if m not in ("vtkBad", "otherBad") else data for m, data in STUBS.items()}
    del want["vtkBad.pyi"]
    got = found(f"{tmp_out}/out")
    assert got == want
    files = SB.write_outcomes(SB.stub_files(annotated), FS.file_outcomes(spark, f"{tmp_out}/out"))
    assert {r.path: r.error for r in files.collect() if r.error} == {"vtkBad.pyi": SB.NOT_UTF8}
    changed = sum(want[f"{m}.pyi"] != STUBS[m] for m in modules if m != "vtkBad")
    assert SB.stub_summary(files).first().asDict() == {"files_written": len(STUBS) - 1, "files_total": len(STUBS), "files_annotated": changed, "docstrings_inserted": changed}


def test_two_texts_of_one_module_fail_the_write(spark, tmp_out):
    stubs = spark.createDataFrame([("m", "class A:\n  x\n"), ("m", "class A:\n  y\n"), ("n", "z")], "module_name string, content string")
    recs = spark.createDataFrame([("m", "A", "Doc.")], "module_name string, class_name string, class_doc string")
    with pytest.raises(Exception, match="has rows from"):
        IO.write_stub_files(SB.annotate_stub_lines(SB.text_line_rows(stubs), recs), f"{tmp_out}/out")
    same = stubs.filter("content NOT LIKE '%y%'")
    IO.write_stub_files(SB.annotate_stub_lines(SB.text_line_rows(same.unionByName(same)), recs), f"{tmp_out}/out")
    assert found(f"{tmp_out}/out") == {"m.pyi": b'class A:\n    """Doc."""\n  x\n', "n.pyi": b"z"}


def test_lines_are_distributed_by_block(spark, tmp_out):
    """No exchange deals lines out by file alone, and a large file is annotated
    in many blocks."""
    n = 16_000
    text = "".join(f"class C{i}:\n    x\n" for i in range(n))
    stubs = spark.createDataFrame([("m", text)], "module_name string, content string")
    recs = spark.range(n).select(F.lit("m").alias("module_name"), F.concat(F.lit("C"), "id").alias("class_name"), F.concat(F.lit("Doc "), "id").alias("class_doc"))
    out = SB.annotate_stub_lines(SB.text_line_rows(stubs, 1000), recs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Exchange hashpartitioning(file" in x and "block" not in x.split("),")[0]]
    assert not [x for x in lines if "line#" in x]
    assert out.filter("sub <> 1").count() == n and out.select("block").distinct().count() == 32
    IO.write_stub_files(out, f"{tmp_out}/out")
    assert found(f"{tmp_out}/out")["m.pyi"].decode() == "".join(f'class C{i}:\n    """Doc {i}"""\n    x\n' for i in range(n))


def test_page_files(spark, tmp_out):
    recs = spark.createDataFrame([("m", "B", "b"), ("m", "A", "a"), ("n", "index", "hidden"), ("n", "C", "c")], "module_name string, class_name string, synopsis string")
    main = PG.main_index_lines(PG.module_results(recs))
    IO.write_page_files(PG.class_page(recs), PG.module_index_lines(recs), main, f"{tmp_out}/md")
    got = found(f"{tmp_out}/md")
    assert set(got) == {"m/A.md", "m/B.md", "n/C.md", "m/index.md", "n/index.md", "index.md"}
    assert got["m/index.md"].decode() == "# m\n\n**2 classes**\n\n## Classes\n\n- [`A`](A.md) - a\n- [`B`](B.md) - b"
    assert got["n/index.md"].decode().startswith("# n\n\n**2 classes**") and got["index.md"].decode().endswith("- [m](m/index.md) (2 classes)\n- [n](n/index.md) (2 classes)")


def test_the_last_text_of_a_class_wins(spark, tmp_out):
    _, classes, bases, ports, methods = _catalog_inputs(spark)
    help_text = lambda doc: f"class vtkA\n |  {doc}\n"
    for k, texts in enumerate([["zebra", "apple"], ["zebra"], ["mango"]]):
        spark.createDataFrame([("m", "vtkA", help_text(t)) for t in texts] + [("m", f"vtk{k}", help_text("own"))], "module_name string, class_name string, help_text string").coalesce(1).write.parquet(f"{tmp_out}/dump/{k}")
    stubs = spark.createDataFrame([("m", "class vtkA:\n    x\n")], "module_name string, content string")

    def build(*folders):
        dump = IO.read_help_dump(spark, f"{tmp_out}/dump/{{{','.join(folders)}}}", with_seq=True)
        res = build_all(spark, dump, classes, bases, ports, methods, f"{tmp_out}/out", stubs=stubs)
        assert res.ok and res.summary["stubs"]["files_written"] == res.summary["stubs"]["files_total"] == 1
        got = found(f"{tmp_out}/out/markdown")
        recs = IO.read_records(spark, f"{tmp_out}/out/records", with_seq=True)
        last = [r.class_doc for r in recs.filter("class_name = 'vtkA'").orderBy("seq").collect()]
        return got["m/vtkA.md"].decode(), found(f"{tmp_out}/out/stubs")["m.pyi"].decode(), last

    for folders, doc, given in ((("0",), "apple", 2), (("0", "1"), "zebra", 2), (("0", "1", "2"), "mango", 3)):
        page, stub, last = build(*folders)
        assert f"## Description\n\n{doc}\n" in page and f'"""{doc}"""' in stub
        assert last[-1] == doc and len(last) == given
