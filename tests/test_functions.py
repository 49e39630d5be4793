"""Column functions: docstring cleaning, strip, scores, formatting, labels."""

import pytest
from pyspark.sql import functions as F

from docsmith.functions.labels import parse_label, strip_code_fence
from docsmith.functions.scores import one_decimal, stars
from docsmith.functions.text import (
    clean_docstring,
    format_method_doc,
    py_strip,
    section_label,
    thousands,
    truncate_doc,
)


def _one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_clean_docstring_cases(spark):
    got = _one(spark, clean_docstring, [
        "", None, "C++: vtkObject::Method() -> void\nThis is the description.",
        "virtual void Method()\nDescription here.", "This is a simple description.",
        "  a  \n\n\n\n  b  ", "see vtkFoo::Bar\nstd::x stays", "  \n  x\n  ",
    ])
    assert got == ["", "", "This is the description.", "Description here.",
                   "This is a simple description.", "a\n\nb", "std::x stays", "x"]


def test_py_strip_matches_python(spark):
    ws = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    vals = [ws + "a b" + ws, "​x​", " é ", "", "\x1c\x1fx"]
    assert _one(spark, py_strip, vals) == [v.strip() for v in vals]


def test_format_method_doc(spark):
    got = _one(spark, format_method_doc, [
        "", None, " . ", "Get(self)\nC++: int Get()\n  Returns.  \n---- sep\nvtkA::B\n", "::only",
    ])
    assert got == ["*No documentation available.*"] * 3 + ["Get(self)\nReturns."] + \
        ["*No documentation available.*"]


def test_section_label_truncate_thousands(spark):
    assert _one(spark, section_label, ["|  Methods defined here:", " | a | "]) == [
        "Methods defined here:", "a"]
    long = "é" * 2001
    assert _one(spark, truncate_doc, ["short", long]) == ["short", "é" * 2000 + "..."]
    assert _one(spark, thousands, [0, 999, 1234567, -1234], "bigint") == ["0", "999", "1,234,567", "-1,234"]


@pytest.mark.parametrize("v", [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.7, 0.75, 0.85, 0.95,
                               1.0, 0.3, 0.04999, 0.125, 2.25, 12.35, 100.05, 1e-9])
def test_one_decimal_matches_printf(spark, v):
    assert _one(spark, one_decimal, [v], "double") == [f"{v:.1f}"]


def test_stars_half_even(spark):
    got = _one(spark, stars, [0.1, 0.3, 0.5, 0.7, 0.9, 1.0, 0.0], "double")
    assert [len(s) for s in got] == [round(v * 5) for v in [0.1, 0.3, 0.5, 0.7, 0.9, 1.0, 0.0]]


def test_strip_code_fence(spark):
    got = _one(spark, strip_code_fence, [
        "```json\n{}\n```", "```", "``````", "  plain  ", "```\n{\"a\": 1}```", "x```",
    ])
    assert got == ["{}", "", "", "plain", '{"a": 1}', "x"]


# (content, expected label or None); label = (synopsis, action_phrase, score), absent
# fields already at their defaults
LABEL_CASES = [
    ('```json\n{"synopsis": "Reads files", "action_phrase": "file reading", "visibility_score": 0.9}\n```',
     ("Reads files.", "file reading", 0.9)),
    ('{"synopsis": " \'Quoted.\' ", "visibility_score": 0.25}', ("Quoted.", "", 0.25)),
    ("Sorry, no JSON.", None),
    ("[1, 2]", None),
    ('"just a string"', None),
    ('{"synopsis": "x", "visibility_score": "high"}', ("x.", "", 0.3)),
    ('{"synopsis": "x", "visibility_score": true}', ("x.", "", 1.0)),
    ('{"synopsis": "x", "visibility_score": 1.7}', ("x.", "", 1.0)),
    ('{"synopsis": "x", "visibility": 0, "visibility_score": 0.4}', ("x.", "", 0.4)),
    ('{"synopsis": 5, "visibility": 0.6}', None),
    ('{"synopsis": null}', None),
    ("{}", ("", "", 0.3)),
    ("", None),
    (None, None),
    ('{"visibility": -2}', ("", "", 0.0)),
    ('{"visibility": "yes", "visibility_score": 0.8}', ("", "", 0.3)),
    ('{"visibility_score": false}', ("", "", 0.0)),
    ('{"synopsis": ""}', ("", "", 0.3)),
    ('```\n{"synopsis": "a"}```', ("a.", "", 0.3)),
    ("```", None),
    ('  {"synopsis": "Tab\\tbed", "visibility": 1}  ', ("Tab\tbed.", "", 1.0)),
    ('{"synopsis": "ok.", "action_phrase": 7, "visibility": [1], "visibility_score": 0.2}', ("ok.", "7", 0.3)),
    ('{"synopsis": "x"} Hope this helps!', None),
    ('{"synopsis": "x"}{"synopsis": "y"}', None),
    ('{"synopsis": "x"}, {"synopsis": "y"}', None),
    ('```json\n{"synopsis": "x"}\n```\nMore text', None),
]


def test_parse_label_cases(spark):
    from docsmith.operators.labelling import parse_responses

    df = spark.createDataFrame([(f"c{i}", c) for i, (c, _) in enumerate(LABEL_CASES)],
                               "class_name string, content string")
    got = {r.class_name: (r.synopsis, r.action_phrase, r.visibility_score)
           for r in parse_responses(df).collect()}
    flags = {r.class_name: r.is_label for r in parse_label(df).collect()}
    for i, (_, want) in enumerate(LABEL_CASES):
        assert flags[f"c{i}"] is (want is not None), LABEL_CASES[i][0]
        assert got.get(f"c{i}") == want, LABEL_CASES[i][0]
