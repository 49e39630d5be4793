"""Classification, stubs and pages on hand-made catalogs."""

from pyspark.sql import functions as F

from docsmith.operators import catalog as CT
from docsmith.operators import hierarchy as HY
from docsmith.operators import pages as PG
from docsmith.operators import stubs as SB

CLASSES = [  # name, instantiable, has_isa, n_in, n_out
    ("vtkSphereSource", True, True, 0, 1), ("vtkSTLReader", True, True, 1, 1),
    ("vtkContourFilter", True, True, 1, 1), ("vtkPolyDataMapper", True, True, 1, 0),
    ("vtkSTLWriter", True, True, 1, 0), ("vtkRenderer", True, True, 0, 0),
    ("vtkRenderWindow", True, True, 0, 0), ("vtkCamera", True, True, 0, 0),
    ("vtkActor", True, True, 0, 0), ("vtkProperty", True, True, 0, 0),
    ("vtkLookupTable", True, True, 0, 0), ("vtkNamedColors", True, True, 0, 0),
    ("vtkImageAlgorithm", False, True, 1, 1), ("vtkAbstractThing", False, True, 0, 0),
    ("vtkNoIsa", True, False, 0, 0), ("vtkOpenGLThing", True, True, 0, 0),
    ("vtkAlgoNoPorts", True, True, 0, 0), ("vtkSink", True, True, 2, 0),
    ("vtkCycA", True, True, 0, 0), ("vtkCycB", True, True, 0, 0),
    ("vtkD", True, True, 0, 0),
]
BASES = [
    ("vtkSphereSource", "vtkPolyDataAlgorithm"), ("vtkPolyDataAlgorithm", "vtkAlgorithm"),
    ("vtkAlgorithm", "vtkObject"), ("vtkSTLReader", "vtkReader"), ("vtkReader", "vtkAlgorithm"),
    ("vtkContourFilter", "vtkPolyDataAlgorithm"), ("vtkPolyDataMapper", "vtkMapper"),
    ("vtkMapper", "vtkAbstractMapper"), ("vtkAbstractMapper", "vtkAlgorithm"),
    ("vtkSTLWriter", "vtkWriter"), ("vtkWriter", "vtkAlgorithm"), ("vtkRenderer", "vtkViewport"),
    ("vtkRenderWindow", "vtkWindow"), ("vtkActor", "vtkProp3D"), ("vtkProp3D", "vtkProp"),
    ("vtkLookupTable", "vtkScalarsToColors"), ("vtkOpenGLThing", "vtkObject"),
    ("vtkAlgoNoPorts", "vtkAlgorithm"), ("vtkSink", "vtkAlgorithm"),
    ("vtkCycA", "vtkCycB"), ("vtkCycB", "vtkCycA"),
    ("vtkD", "vtkB1"), ("vtkD", "vtkB2"), ("vtkB1", "vtkTop"), ("vtkB2", "vtkTop"),
]
EXPECTED_ROLES = {
    "vtkSphereSource": "input", "vtkSTLReader": "input", "vtkContourFilter": "filter",
    "vtkPolyDataMapper": "properties", "vtkSTLWriter": "output", "vtkRenderer": "renderer",
    "vtkRenderWindow": "utility", "vtkCamera": "scene", "vtkActor": "properties",
    "vtkProperty": "properties", "vtkLookupTable": "properties", "vtkNamedColors": "color",
    "vtkImageAlgorithm": "filter", "vtkAbstractThing": "utility", "vtkNoIsa": "utility",
    "vtkOpenGLThing": "renderer", "vtkAlgoNoPorts": "filter", "vtkSink": "output",
    "vtkCycA": "utility", "vtkD": "utility", "vtkNonExistentClass": "utility",
}


def _catalog(spark):
    classes = spark.createDataFrame(CLASSES, "class_name string, instantiable boolean, has_isa boolean, "
                                             "n_in bigint, n_out bigint")
    bases = spark.createDataFrame(BASES, "class_name string, base_name string")
    return classes, bases


def test_isa_closure_diamond_and_cycle(spark):
    classes, bases = _catalog(spark)
    isa = {(r.class_name, r.ancestor) for r in HY.isa_closure(classes, bases).collect()}
    anc = lambda c: {a for k, a in isa if k == c}
    assert anc("vtkD") == {"vtkD", "vtkB1", "vtkB2", "vtkTop"}
    assert anc("vtkCycA") == {"vtkCycA", "vtkCycB"}
    assert anc("vtkSphereSource") == {"vtkSphereSource", "vtkPolyDataAlgorithm", "vtkAlgorithm", "vtkObject"}
    assert len(isa) == len(set(isa))
    # no pair for names that are only bases
    assert not any(k == "vtkTop" for k, _ in isa)


def test_role_truth_table(spark):
    classes, bases = _catalog(spark)
    flags = HY.isa_flags(bases)
    names = spark.createDataFrame([(n,) for n in EXPECTED_ROLES], "class_name string")
    got = {r.class_name: r.role for r in HY.roles(names, classes, flags).collect()}
    # vtkRenderWindow has no vtkRenderWindow ancestor here except itself:
    EXPECTED_ROLES["vtkRenderWindow"] = "infrastructure"
    assert got == EXPECTED_ROLES


def test_datatypes_and_semantic_methods(spark):
    classes, bases = _catalog(spark)
    flags = HY.isa_flags(bases)
    ports = spark.createDataFrame([
        ("vtkContourFilter", "in", 0, ["vtkDataSet"]), ("vtkContourFilter", "out", 0, ["vtkPolyData"]),
        ("vtkContourFilter", "in", 1, ["vtkOther"]),
        ("vtkSphereSource", "out", 0, ["", "vtkPolyData", None, "vtkX"]),
        ("vtkSphereSource", "in", 0, ["vtkIgnored"]),  # n_in = 0
        ("vtkCamera", "out", 0, ["vtkNotAlgo"]),
        ("vtkSink", "in", 0, ["", None]),
    ], "class_name string, direction string, port int, types array<string>")
    methods = spark.createDataFrame([
        ("vtkSphereSource", "SetRadius", True), ("vtkSphereSource", "GetRadius", True),
        ("vtkSphereSource", "__init__", True), ("vtkSphereSource", "_private", True),
        ("vtkSphereSource", "Modified", True), ("vtkSphereSource", "GetRadiusMinValue", False),
        ("vtkSphereSource", "Zeta", True), ("vtkSphereSource", "alpha", True),
    ], "class_name string, method_name string, is_callable boolean")
    names = spark.createDataFrame([(n,) for n in ("vtkContourFilter", "vtkSphereSource", "vtkCamera",
                                                  "vtkSink", "vtkNonExistentClass")], "class_name string")
    prof = {r.class_name: r for r in HY.profile(names, classes, flags, ports, methods).collect()}
    assert (prof["vtkContourFilter"].input_datatype, prof["vtkContourFilter"].output_datatype) == (
        "vtkDataSet", "vtkPolyData")
    assert (prof["vtkSphereSource"].input_datatype, prof["vtkSphereSource"].output_datatype) == (
        "", "vtkPolyData,vtkX")
    assert (prof["vtkCamera"].input_datatype, prof["vtkCamera"].output_datatype) == ("", "")
    assert prof["vtkSink"].input_datatype == ""
    assert prof["vtkSphereSource"].semantic_methods == ["GetRadius", "SetRadius", "Zeta", "alpha"]
    unknown = prof["vtkNonExistentClass"]
    assert (unknown.role, unknown.input_datatype, unknown.output_datatype, unknown.semantic_methods) == (
        "utility", "", "", [])


STUB = "\n".join([
    '"""module docstring"""',
    "class vtkA(vtkObject):",
    "    def f(self): ...",
    "",
    "class vtkB:",
    "",
    "    x: int",
    "class vtkC(vtkObject):",
    '    """present"""',
    "class vtkAB(vtkA):",
    "    pass",
    "class vtkD:",
])
STUB_EXPECTED = "\n".join([
    '"""module docstring"""',
    "class vtkA(vtkObject):",
    '    """A doc."""',
    "    def f(self): ...",
    "",
    "class vtkB:",
    "",
    '    """B doc."""',
    "    x: int",
    "class vtkC(vtkObject):",
    '    """present"""',
    "class vtkAB(vtkA):",
    "    pass",
    "class vtkD:",
])


def test_annotate_stubs(spark):
    stubs = spark.createDataFrame([("vtkMod", STUB), ("vtkOther", STUB)], "module_name string, content string")
    recs = spark.createDataFrame([
        ("vtkMod", "vtkA", "A doc."), ("vtkMod", "vtkB", "B doc."), ("vtkMod", "vtkC", "C doc."),
        ("vtkMod", "vtkAB", ""), ("vtkMod", "vtkD", "D doc."),
    ], "module_name string, class_name string, class_doc string")
    out = {r.module_name: r for r in SB.annotate_stubs(stubs, recs).collect()}
    assert out["vtkMod"].content == STUB_EXPECTED
    assert out["vtkMod"].inserted == 2
    assert out["vtkOther"].content == STUB  # no docs for the module: copied through
    assert out["vtkMod"].path == "vtkMod.pyi"


def _record(spark):
    return spark.sql("""
      select 'vtkTest' as class_name, 'vtkCommonCore' as module_name, 'A test class.' as class_doc,
        named_struct('class_doc', 'A test class.', 'sections', map(
          '|  Methods defined here:', named_struct('methods',
              map('SetX', 'SetX(self)\\nC++: void SetX()\\nSet it.', 'GetX', 'GetX(self)', 'Other', 'o'),
              'method_count', 3),
          '|  Methods inherited from vtkObject:', named_struct('methods', map('Modified', 'm'), 'method_count', 1)
        )) as structured_docs,
        'filter' as role, 'vtkDataSet' as input_datatype, '' as output_datatype,
        array('GetX', 'SetX') as semantic_methods, 'Tests things.' as synopsis, 'testing' as action_phrase,
        cast(0.7 as double) as visibility_score""")


def test_class_page_exact_text(spark):
    page = PG.class_page(_record(spark)).first()
    expected = "\n".join([
        "# vtkTest", "", "**Module:** `vtkmodules.vtkCommonCore`", "",
        "| | |", "|---|---|", "| **Role** | filter |", "| **Action** | testing |",
        "| **Visibility** | ⭐⭐⭐⭐ (0.7) |", "| **Input Type** | vtkDataSet |", "",
        "## Synopsis", "", "Tests things.", "",
        "## Description", "", "A test class.", "",
        "## Key Methods", "", "`GetX`, `SetX`", "",
        "## Methods", "",
        "### Methods defined here:", "",
        "#### `GetX`", "", "GetX(self)", "",
        "#### `SetX`", "", "SetX(self)\nSet it.", "",
    ])
    assert page.content == expected
    assert page.path == "vtkCommonCore/vtkTest.md"


def test_minimal_page_and_more_methods(spark):
    rec = spark.sql("""select 'vtkMin' as class_name, 'm' as module_name, '' as class_doc, '' as synopsis,
        cast(null as string) as role, '' as action_phrase, cast(0.0 as double) as visibility_score,
        '' as input_datatype, '' as output_datatype,
        transform(sequence(1, 23), i -> concat('M', lpad(cast(i as string), 2, '0'))) as semantic_methods""")
    content = PG.class_page(rec).first().content
    shown = ", ".join(f"`M{i:02d}`" for i in range(1, 21))
    assert content == "\n".join(["# vtkMin", "", "**Module:** `vtkmodules.m`", "",
                                 "## Key Methods", "", shown, "\n*...and 3 more*", ""])


def test_indexes_and_summary(spark):
    recs = spark.createDataFrame([
        ("vtkB", "vtkM1", "Bee.", 1, 0.5, False), ("vtkA", "vtkM1", "", 2, 0.5, False), ("vtkA", "vtkM1", "Later A.", 3, 0.5, False),
        ("vtkC", "vtkM2", "See.", 4, None, True),  # an explicit null in the record's JSON
    ], "class_name string, module_name string, synopsis string, seq int, visibility_score double, score_null boolean")
    idx = {r.module_name: r.content for r in PG.assemble(PG.module_index_lines(recs, "seq"), ["module_name"]).collect()}
    assert idx["vtkM1"] == "\n".join(["# vtkM1", "", "**2 classes**", "", "## Classes", "",
                                       "- [`vtkA`](vtkA.md) - Later A.", "- [`vtkB`](vtkB.md) - Bee."])
    results = PG.module_results(recs)
    status = {r.module_name: (r.status, r.class_count) for r in results.collect()}
    assert status == {"vtkM1": ("success", 2), "vtkM2": ("error", 0)}
    main = PG.assemble(PG.main_index_lines(results, "VTK 9.9")).first().content
    assert main == "\n".join(["# VTK Python API Documentation", "", "**VTK 9.9**", "",
                              "This documentation covers 1 modules with 2 classes.", "", "## Modules", "",
                              "- [vtkM1](vtkM1/index.md) (2 classes)"])
    assert PG.build_summary(results).first().asDict() == {"modules_ok": 1, "modules_total": 2, "classes_total": 2}
    # pages of the failing module are not rendered
    pages = PG.module_pages(recs.withColumn("class_doc", F.lit("d")), "seq")
    assert sorted(r.class_name for r in pages.collect()) == ["vtkA", "vtkB"]


def test_search_and_stats(spark):
    recs = spark.createDataFrame([(i, f"vtkN{i}", "m" + str(i % 3), f"Syn {i}") for i in range(30)],
                                 "seq int, class_name string, module_name string, synopsis string")
    page = CT.search(recs, "VTKN1", field="class_name", limit=4).collect()
    assert [r.class_name for r in page] == ["vtkN1", "vtkN10", "vtkN11", "vtkN12"]
    assert {r.total_hits for r in page} == {11}
    assert CT.search(recs, "x", field="seq").count() == 0
    assert CT.search(recs, "", field="missing").first().total_hits == 30


def test_two_files_of_one_module_stay_apart(spark):
    stubs = spark.createDataFrame([("vtkMod", STUB), ("vtkMod", "class vtkB:\n    y: int\n")],
                                  "module_name string, content string")
    recs = spark.createDataFrame([("vtkMod", "vtkA", "A doc."), ("vtkMod", "vtkB", "B doc.")],
                                 "module_name string, class_name string, class_doc string")
    out = sorted(r.content for r in SB.annotate_stubs(stubs, recs).collect())
    assert out == sorted([STUB_EXPECTED, 'class vtkB:\n    """B doc."""\n    y: int\n'])


def test_repeated_class_rows_give_one_profile_row(spark):
    classes, bases = _catalog(spark)
    doubled = classes.unionByName(classes)
    flags = HY.isa_flags(bases.unionByName(bases))
    names = spark.createDataFrame([("vtkActor",)], "class_name string")
    assert [r.role for r in HY.roles(names, doubled, flags).collect()] == ["properties"]


def test_line_level_stubs_match_whole_files(spark, tmp_path):
    from docsmith.sources import io as IO

    texts = {
        "vtkMod": STUB + "\n",                       # trailing newline
        "vtkEnd": "x = 1\nclass vtkA(vtkObject):\n\n  \n",   # decl followed by blank lines only
        "vtkLast": "class vtkB:\n    pass\nclass vtkA(vtkObject):",  # decl is the last piece
        "vtkNoNl": "class vtkA:\n   ",            # only a blank last piece after the decl
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.pyi").write_text(text)
    recs = spark.createDataFrame(
        [(m, c, f"{c} in {m}.") for m in texts for c in ("vtkA", "vtkB", "vtkC", "vtkD")],
        "module_name string, class_name string, class_doc string")
    whole = {r.module_name: r.content for r in SB.annotate_stubs(IO.read_stubs(spark, str(tmp_path)), recs).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48")   # many splits per file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = IO.read_stub_lines(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > len(texts)
        rows = SB.annotate_stub_lines(lines, recs).orderBy("module_name", "file", "block", "row", "sub").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rebuilt = {}
    for r in rows:
        rebuilt[r.module_name] = rebuilt.get(r.module_name, "") + r.line + ("\n" if r.nl else "")
    assert rebuilt == whole
    assert whole["vtkEnd"] == 'x = 1\nclass vtkA(vtkObject):\n\n  \n    """vtkA in vtkEnd."""\n'
    assert whole["vtkNoNl"] == 'class vtkA:\n    """vtkA in vtkNoNl."""\n   '


def test_repeated_records_insert_one_docstring(spark):
    stubs = spark.createDataFrame([("vtkMod", "class vtkA:\n    pass\n")], "module_name string, content string")
    recs = spark.createDataFrame([("vtkMod", "vtkA", "first"), ("vtkMod", "vtkA", "second")],
                                 "module_name string, class_name string, class_doc string")
    out = SB.annotate_stubs(stubs, recs).first()
    assert out.content == 'class vtkA:\n    """second"""\n    pass\n' and out.inserted == 1


def test_search_without_order_column(spark):
    recs = spark.createDataFrame([("m2", "vtkB", "b"), ("m1", "vtkA", "a"), ("m1", "vtkC", "c")],
                                 "module_name string, class_name string, synopsis string")
    page = CT.search(recs, "vtk", limit=2).collect()
    assert [(r.module_name, r.class_name) for r in page] == [("m1", "vtkA"), ("m1", "vtkC")]
    assert {r.total_hits for r in page} == {3}
