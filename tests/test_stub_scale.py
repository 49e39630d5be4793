"""The work on a stub file grows with its lines, not with their square."""

import os

import pytest
from pyspark.sql import functions as F

from docsmith.operators import stubs as SB
from docsmith.plans import queries_jobs as QJ
from docsmith.sources import files as FS
from docsmith.sources import io as IO

TEXTS = {"vtkNull": None, "vtkEmpty": "", "vtkNl": "\n", "vtkNoEnd": "class A:\n  x", "vtkEnd": "class A:\n\n  x\n", "vtkTwoEnds": "a\n\n"}


def _stubs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "module_name string, content string")


@pytest.mark.parametrize("line_rows", [QJ._stub_line_rows, SB.text_line_rows])
def test_lines_do_not_work_on_the_whole_text(spark, line_rows):
    """Nothing above the explode reads the file's text: it would be read for
    every line."""
    out = line_rows(_stubs(spark))
    above, explode, _ = out._jdf.queryExecution().optimizedPlan().toString().partition("Generate posexplode")
    assert explode and "split(" not in above and "length(" not in above and "content" not in above
    got = {}
    for r in sorted(out.collect(), key=lambda r: r.row):
        got.setdefault(r.module_name, []).append(r.line)
    assert got["vtkNoEnd"] == ["class A:", "  x"] and got["vtkEnd"] == ["class A:", "", "  x"] and got["vtkTwoEnds"] == ["a", ""] and got["vtkNl"] == [""]
    sizes = {r.module_name: r.file_size for r in out.collect()}
    assert sizes["vtkEnd"] == 14 and sizes["vtkNoEnd"] == 12


def test_docstrings_are_not_looked_up_by_line(spark):
    """Files of several blocks of lines get the text of the whole-file rule, and
    no line searches a file's docstrings."""
    n = SB.BLOCK_LINES
    text = "\n" + "".join(f"class C{i}(B):\n" + "\n" * (i % 3) + ('    """there"""\n' if i % 5 == 0 else "    x\n") for i in range(n))
    texts = {"m": text, "end": text.rstrip("\n"), "blank": "class C1:\n\n\n", "none": text, "empty": None}
    stubs = spark.createDataFrame(list(texts.items()), "module_name string, content string")
    docs = {f"C{i}": f"Doc\n  {i}" for i in range(1, n, 2)}
    recs = spark.createDataFrame([(m, c, d) for m in ("m", "end", "blank", "empty") for c, d in docs.items()], "module_name string, class_name string, class_doc string")
    out = SB.annotate_stubs(stubs, recs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at" not in plan and "map_from_entries" not in plan
    got = {r.module_name: (r.content, r.inserted) for r in out.collect()}

    def want(lines):
        for i, line in enumerate(lines):
            name = line[6:].split("(")[0].split(":")[0] if line.startswith("class ") else None
            after = next((k for k in range(i + 1, len(lines)) if lines[k].strip()), len(lines) - 1) if name in docs else None
            if after is not None and "there" not in lines[after]:
                yield after, f'    """{docs[name]}"""'

    for m in ("m", "end", "blank"):
        lines = texts[m].split("\n")
        ins = dict(want(lines))
        assert got[m] == ("\n".join(f"{ins[i]}\n{x}" if i in ins else x for i, x in enumerate(lines)), len(ins)) and ins
    assert got["none"] == (text, 0) and got["empty"] == (None, 0)


def test_no_task_orders_the_lines_of_a_whole_file(spark, tmp_out):
    """A large file of one split is annotated and written in pieces of lines;
    its bytes are those of the whole-file rule, and no piece is left behind."""
    n = SB.BLOCK_LINES + 1
    os.makedirs(f"{tmp_out}/in")
    head = "\ufeff# " + "\n" * SB.BLOCK_LINES  # a mark, and blank lines over a piece's end
    given = {"big": head + "".join(f"class C{i}:\n    x\n" for i in range(n)) + "class Z:\n" + "\n" * (2 * SB.BLOCK_LINES), "small": "class C1:\n    y"}
    for name, text in given.items():
        with open(f"{tmp_out}/in/{name}.pyi", "w", newline="") as f:
            f.write(text)
    recs = spark.range(n).select(F.lit("big").alias("module_name"), F.concat(F.lit("C"), "id").alias("class_name"), F.lit("Doc\u00e4").alias("class_doc")).unionByName(
        spark.createDataFrame([("big", "Z", "Last"), ("small", "C1", "One")], "module_name string, class_name string, class_doc string"))
    lines = IO.read_stub_lines(spark, f"{tmp_out}/in")
    assert lines.filter("module_name = 'big'").select("block").distinct().count() == 1
    annotated = SB.annotate_stub_lines(lines, recs)
    # what the windows and joins order together are the lines of a piece
    plan = annotated._jdf.queryExecution().executedPlan().toString()
    dealt = [x.split("hashpartitioning(")[1] for x in plan.splitlines() if "Exchange hashpartitioning(file#" in x and "REPARTITION" in x]
    assert dealt and all(SB.PIECE in x for x in dealt)
    SB.write_stub_lines(annotated, f"{tmp_out}/lines")
    annotated = spark.read.parquet(f"{tmp_out}/lines")
    sizes = []
    write = FS.write_files

    def seen(rows, path, pieces=None):
        if pieces is None:  # the pieces: rows of each file that is written by itself
            sizes.extend(r["count"] for r in rows.groupBy("path").count().collect())
        else:
            assert rows.filter("data is not null").isEmpty()
        write(rows, path, pieces)

    FS.write_files = seen
    try:
        IO.write_stub_files(annotated, f"{tmp_out}/out")
    finally:
        FS.write_files = write
    assert sizes and max(sizes) <= 2 * SB.BLOCK_LINES and len(sizes) > 4
    z = "class Z:\n" + "\n" * (2 * SB.BLOCK_LINES) + '    """Last"""\n'
    want = {"big.pyi": head + "".join(f'class C{i}:\n    """Doc\u00e4"""\n    x\n' for i in range(n)) + z, "small.pyi": 'class C1:\n    """One"""\n    y'}
    for name, text in want.items():
        with open(f"{tmp_out}/out/{name}", newline="") as f:
            assert f.read() == text
    assert sorted(os.listdir(tmp_out)) == ["in", "lines", "out"]
    told = {r.path: (r.bytes, r.error) for r in FS.file_outcomes(spark, f"{tmp_out}/out").collect()}
    assert told == {p: (len(t.encode()), None) for p, t in want.items()}


def test_pieces_of_two_owners_or_a_bad_path_leave_the_old_files(spark, tmp_out):
    schema = "path string, data string, owner string, piece string, at int"
    failed = spark.createDataFrame([("bad", "why")], "path string, error string")
    good = [("a.gz", f"{i},", "o", f"{i // 10:05d}", i) for i in range(100)]
    FS.write_files_in_pieces(spark.createDataFrame(good, schema).repartition(5), f"{tmp_out}/out", ["at"], failed)
    text = "".join(f"{i}," for i in range(100))
    for more in ([("a.gz", "x", "p", "00099", 0)], [("../a", "x", "o", "0", 0)], [(None, "x", "o", "0", 0)]):
        with pytest.raises(Exception, match="has rows from|not the path"):
            FS.write_files_in_pieces(spark.createDataFrame(good + more, schema), f"{tmp_out}/out", ["at"], failed)
        with open(f"{tmp_out}/out/a.gz") as f:
            assert f.read() == text
        assert {r.path: r.error for r in FS.file_outcomes(spark, f"{tmp_out}/out").collect()} == {"a.gz": None, "bad": "why"}
        assert not [x for x in os.listdir(tmp_out) if "pieces-" in x and ".staged-" not in x]


def test_files_are_summed_up_without_sorting_their_lines(spark, tmp_out):
    annotated = SB.annotate_stub_lines(SB.text_line_rows(_stubs(spark)), spark.createDataFrame([("vtkEnd", "A", "Doc")], "module_name string, class_name string, class_doc string"))
    SB.write_stub_lines(annotated, f"{tmp_out}/lines")
    files = SB.stub_files(spark.read.parquet(f"{tmp_out}/lines"))
    above, scan, _ = files._jdf.queryExecution().executedPlan().toString().partition("FileScan")
    assert scan and "HashAggregate" in [x for x in above.splitlines() if "Aggregate" in x][-1]
    assert {(r.module_name, r.inserted, r.error) for r in files.collect()} == {(m, int(m == "vtkEnd"), None) for m in TEXTS}
