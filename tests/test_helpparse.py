"""Help-text parsing on literal texts; expected values worked out by hand
from the format rules (SURVEY §2.3), not by re-running a parser."""

from docsmith.operators import helpparse as hp

NL = "\n"
DASHES = "-" * 70

FOO = NL.join([
    "Help on class vtkFoo in module vtkmodules.vtkCommonCore:",
    "",
    "class vtkFoo(vtkObject)",
    " |  vtkFoo - a test class.",
    " |  ",
    " |  It does C++: things",
    " |  virtual stuff",
    " |  See vtkBar::Baz",
    " |  Keep std::vector",
    " |",
    " |  Method resolution order:",
    " |      vtkFoo",
    " |      vtkObject",
    " |  ",
    " |  Methods defined here:",
    " |  ",
    " |  GetX(self) -> int",
    " |      Return x.",
    " |      C++: int GetX()",
    " |  ",
    " |  SetX(self, x:int) -> None",
    " |      Set x.",
    " |  ",
    " |  GetX(...)",
    " |      Second GetX doc.",
    " |  ",
    " |  Empty(self)",
    " |      C++: void Empty()",
    " |  ",
    " |  " + DASHES,
    " |  Methods inherited from vtkObject:",
    " |  ",
    " |  Modified(self)",
    " |      Mark modified.",
    " |  ",
    " |  " + DASHES,
    " |  Methods defined here:",
    " |  ",
    " |  Other(self)",
    " |      Replaces the first section.",
])

DUP = NL.join([
    "class vtkDup(vtkObject)",
    " |  Dup doc.",
    " |  Method resolution order:",
    " |  Methods defined here:",
    " |  GetX(self)",
    " |      first.",
    " |  SetX(self)",
    " |      set.",
    " |  GetX(self, y)",
    " |      second.",
    " |  Weird(C++: only)",
    " |     Odd(x)",
    " |      odd doc.",
    " |  (nameless)",
    " |      dropped with its block.",
])

NO_MRO = NL.join([
    "class vtkNoMro",
    " |  Doc line.",
    " |  This prose says Methods defined here: inside the doc.",
    " |  F(self)",
    " |      f doc.",
])

PREFIX = NL.join([
    "class vtkAbcDef(vtkObject)",
    " |  Belongs to the longer name.",
    " |  Method resolution order:",
])


def _parse(spark, rows):
    """Parsed rows by class, with the map key orders read inside Spark
    (a collected MapType becomes a dict through a hash map: order is lost)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "module_name string, class_name string, help_text string")
    secs = F.col("structured_docs.sections")
    nested = hp.structured_docs(df).select(
        "*",
        F.map_keys(secs).alias("section_order"),
        F.transform(F.map_values(secs), lambda v: F.map_keys(v["methods"])).alias("method_order"),
    ).collect()
    return {r.class_name: r for r in nested}


def test_class_doc_cleaning_and_span(spark):
    r = _parse(spark, [("m", "vtkFoo", FOO)])["vtkFoo"]
    assert r.class_doc == "vtkFoo - a test class.\n\nKeep std::vector"
    assert r.structured_docs.class_doc == r.class_doc


def test_repeated_section_last_non_empty_instance_wins(spark):
    r = _parse(spark, [("m", "vtkFoo", FOO)])["vtkFoo"]
    secs = r.structured_docs.sections
    assert r.section_order == ["|  Methods defined here:", "|  Methods inherited from vtkObject:"]
    defined = secs["|  Methods defined here:"]
    assert dict(defined.methods) == {"Other": "Other(self)\nReplaces the first section."}
    assert defined.method_count == 1
    inherited = secs["|  Methods inherited from vtkObject:"]
    # the separator that follows a method stays in its doc
    assert dict(inherited.methods) == {"Modified": "Modified(self)\nMark modified.\n\n" + DASHES}


def test_duplicate_method_last_wins_first_position(spark):
    r = _parse(spark, [("m", "vtkDup", DUP)])["vtkDup"]
    methods = r.structured_docs.sections["|  Methods defined here:"].methods
    # signature removed by cleaning -> empty doc -> no entry; 5-space indent is a signature;
    # a nameless signature drops its block
    assert r.method_order == [["GetX", "SetX", "Odd"]]
    assert methods["GetX"] == "GetX(self, y)\nsecond."
    assert methods["Odd"] == "Odd(x)\nodd doc."
    assert "Weird" not in methods


def test_no_mro_line_and_header_in_prose(spark):
    r = _parse(spark, [("m", "vtkNoMro", NO_MRO)])["vtkNoMro"]
    # without the MRO marker the class doc runs to the end of the text
    assert r.class_doc == ("Doc line.\nThis prose says Methods defined here: inside the doc.\n"
                           "F(self)\nf doc.")
    secs = r.structured_docs.sections
    assert r.section_order == ["|  This prose says Methods defined here: inside the doc."]
    assert dict(secs[r.section_order[0]].methods) == {"F": "F(self)\nf doc."}


def test_class_line_is_a_prefix_match(spark):
    r = _parse(spark, [("m", "vtkAbc", PREFIX)])["vtkAbc"]
    assert r.class_doc == "Belongs to the longer name."


def test_empty_and_missing_text_give_a_record(spark):
    got = _parse(spark, [("m", "vtkEmpty", ""), ("m", "vtkNull", None)])
    for name in ("vtkEmpty", "vtkNull"):
        assert got[name].class_doc == ""
        assert dict(got[name].structured_docs.sections) == {}


def test_flat_methods_match_nested(spark):
    df = spark.createDataFrame([("m", "vtkFoo", FOO), ("m", "vtkDup", DUP)],
                               "module_name string, class_name string, help_text string")
    docs, methods = hp.parse_help(df)
    flat = {(r.class_name, r.section, r.method): r.doc for r in methods.collect()}
    assert flat[("vtkDup", "|  Methods defined here:", "GetX")] == "GetX(self, y)\nsecond."
    assert len(flat) == 5
    counts = {(r.class_name, r.section): r.method_count for r in hp.methods_per_section(methods).collect()}
    assert counts[("vtkDup", "|  Methods defined here:")] == 3


def test_one_exchange_in_parse_plan(spark):
    df = spark.createDataFrame([("m", "vtkFoo", FOO)], "module_name string, class_name string, help_text string")
    plan = hp.structured_docs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_copies_collapse_and_variants_stay_apart(spark):
    # a group of exact copies of one row collapses into one document; a row with
    # the same key but another text is parsed as its own document
    rows = [("m", "vtkDup", DUP)] * 40 + [("m", "vtkDup", FOO.replace("vtkFoo", "vtkDup")), ("m", "vtkFoo", FOO)]
    df = spark.createDataFrame(rows, "module_name string, class_name string, help_text string").repartition(5)
    got = hp.structured_docs(df).collect()
    dups = [r for r in got if r.class_name == "vtkDup"]
    assert len(dups) == 2 and len(got) == 3
    docs = sorted(dict(r.structured_docs.sections).get("|  Methods defined here:").method_count for r in dups)
    assert docs == [1, 3]
    counts = hp.methods_per_section(hp.parse_help(df)[1]).collect()
    assert sorted(r.method_count for r in counts if r.class_name == "vtkDup") == [1, 1, 3]
