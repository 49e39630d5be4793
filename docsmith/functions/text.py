"""Column expressions for help-text and docstring cleaning.

All functions take and return ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen (the
array forms use SQL higher-order functions, still JVM-side).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsmith.schema import (
    MAX_DOC_CHARS,
    NO_METHOD_DOC,
    PY_WHITESPACE_CHARS,
    TRUNCATION_SUFFIX,
)



def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: removes every Unicode whitespace at both ends.
    ``btrim`` with an explicit character set: a code-point scan, no regex."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE_CHARS))


def py_lstrip(c: Column | str) -> Column:
    """Python ``str.lstrip()`` (SQL ``ltrim(trimStr, str)`` argument order)."""
    return F.call_function("ltrim", F.lit(PY_WHITESPACE_CHARS), col_(c))


def is_blank(c: Column | str) -> Column:
    return py_strip(c) == F.lit("")


def collapse_blank_lines(c: Column | str) -> Column:
    """Three or more newlines become two (at most one blank line in a row)."""
    return F.regexp_replace(col_(c), r"\n{3,}", "\n\n")


def is_cpp_line(line: Column | str) -> Column:
    """FLT3: a docstring line that carries C++ rather than prose.

    Dropped when it contains ``C++:``, or starts (after stripping) with
    ``virtual ``, or contains ``::`` together with ``vtk`` in any case.
    """
    line = col_(line)
    return (
        line.contains("C++:")
        | py_strip(line).startswith("virtual ")
        | (line.contains("::") & F.lower(line).contains("vtk"))
    )


def is_page_noise_line(line: Column | str) -> Column:
    """FLT4: a method-doc line left out of a rendered page.

    Blank lines, lines starting ``C++:`` or ``---`` (after stripping) and any
    line containing ``::``.
    """
    line = col_(line)
    s = py_strip(line)
    return (s == "") | s.startswith("C++:") | line.contains("::") | s.startswith("---")


def clean_docstring(doc: Column | str) -> Column:
    """TXT8 on a whole string: drop C++ lines, strip each line, strip the whole,
    collapse runs of blank lines.  Null or empty input gives ``""``."""
    lines = F.split(F.coalesce(col_(doc), F.lit("")), "\n", -1)
    kept = F.filter(lines, lambda ln: ~is_cpp_line(ln))
    joined = F.array_join(F.transform(kept, py_strip), "\n")
    return collapse_blank_lines(py_strip(joined))


def finish_cleaned_lines(joined: Column | str) -> Column:
    """Final step of TXT8 when the per-line work was done by an aggregate:
    ``joined`` is the newline-join of the kept, stripped lines."""
    return collapse_blank_lines(py_strip(F.coalesce(col_(joined), F.lit(""))))


def format_method_doc(doc: Column | str) -> Column:
    """SCL10: method documentation as shown on a page."""
    doc = col_(doc)
    kept = F.filter(F.split(py_strip(doc), "\n", -1), lambda ln: ~is_page_noise_line(ln))
    body = F.array_join(F.transform(kept, py_strip), "\n")
    return (
        F.when(doc.isNull() | (doc == "") | (py_strip(doc) == "."), F.lit(NO_METHOD_DOC))
        .when(F.size(kept) == 0, F.lit(NO_METHOD_DOC))
        .otherwise(body)
    )


def section_label(section: Column | str) -> Column:
    """SCL11: section key as a heading: bars removed, stripped."""
    return py_strip(F.replace(col_(section), F.lit("|"), F.lit("")))


def truncate_doc(doc: Column | str, limit: int = MAX_DOC_CHARS) -> Column:
    """SCL1: cut to ``limit`` characters and mark the cut, only if longer."""
    doc = col_(doc)
    return F.when(
        F.length(doc) > limit, F.concat(F.substring(doc, 1, limit), F.lit(TRUNCATION_SUFFIX))
    ).otherwise(doc)


def thousands(n: Column | str) -> Column:
    """SCL12: integer with comma thousands separators."""
    return F.format_number(col_(n).cast("bigint"), 0)


def bare_module(module: Column | str) -> Column:
    """Module path reduced to its last dotted component (``a.b.vtkX`` -> ``vtkX``)."""
    return F.regexp_extract(col_(module), r"([^.]*)$", 1)
