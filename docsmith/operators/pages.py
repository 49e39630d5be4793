"""Markdown pages (JOB4-JOB6, SCL9-SCL11, AGG8).

* A class page depends on its record only, so it is one projection with
  array higher-order functions: no shuffle, no join.
* Index pages list many rows.  They are produced as *line rows*
  ``(..., kind, sort_key, line)``: a page is its lines in ``(kind, sort_key)``
  order.  Sorting them is a range-partitioned global sort, so a module holding
  a third of all classes is spread over many tasks instead of being gathered
  into one string in one task.  :func:`assemble` joins lines into one string
  for small outputs (tests, a single module).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsmith.functions.scores import one_decimal, stars
from docsmith.functions.text import format_method_doc, section_label, thousands  # noqa: F401
from docsmith.operators.labelling import latest_per_key
from docsmith.schema import KEY_METHODS_SHOWN, PAGE_DEFAULT_VISIBILITY

# Fixed values of the page format.
MODULE_PATH_PREFIX = "vtkmodules."
DEFAULT_TITLE = "VTK Python API Documentation"
INDEX_FILE = "index.md"
TABLE_HEAD = ("| | |", "|---|---|")
ROLE_ROW = "| **Role** | "
ACTION_ROW = "| **Action** | "
VISIBILITY_ROW = "| **Visibility** | "
INPUT_ROW = "| **Input Type** | "
OUTPUT_ROW = "| **Output Type** | "
ROW_END = " |"
SYNOPSIS = "## Synopsis"
DESCRIPTION = "## Description"
KEY_METHODS = "## Key Methods"
METHODS = "## Methods"
CLASSES = "## Classes"
MODULES = "## Modules"

PAGE_ERROR = "visibility_score is null: "


def _empty() -> Column:
    return F.array().cast("array<string>")


def _lines(*xs) -> Column:
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs])


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def metadata_lines(role="role", action="action_phrase", score="visibility_score",
                   in_type="input_datatype", out_type="output_datatype") -> Column:
    """SCL9: the metadata table as lines; rows only for present values, the
    visibility row only for a positive score; no table without rows."""
    role, action, in_type, out_type = (F.col(c) for c in (role, action, in_type, out_type))
    s = F.coalesce(F.col(score), F.lit(PAGE_DEFAULT_VISIBILITY))
    rows = F.filter(F.array(
        F.when(_nonempty(role), F.concat(F.lit(ROLE_ROW), role, F.lit(ROW_END))),
        F.when(_nonempty(action), F.concat(F.lit(ACTION_ROW), action, F.lit(ROW_END))),
        F.when(s > 0, F.concat(F.lit(VISIBILITY_ROW), stars(s), F.lit(" ("), one_decimal(s), F.lit(")" + ROW_END))),
        F.when(_nonempty(in_type), F.concat(F.lit(INPUT_ROW), in_type, F.lit(ROW_END))),
        F.when(_nonempty(out_type), F.concat(F.lit(OUTPUT_ROW), out_type, F.lit(ROW_END))),
    ), lambda x: x.isNotNull())
    return F.when(F.size(rows) > 0, F.concat(_lines(*TABLE_HEAD), rows, _lines(""))).otherwise(_empty())


def key_method_lines(sem: Column, shown_methods: int = KEY_METHODS_SHOWN) -> Column:
    """First ``shown_methods`` semantic methods, and how many more (ORD2)."""
    n = F.size(sem)
    shown = F.array_join(F.transform(F.slice(sem, 1, shown_methods),
                                     lambda m: F.concat(F.lit("`"), m, F.lit("`"))), ", ")
    more = F.when(n > shown_methods, F.array(F.concat(
        F.lit("\n*...and "), (n - shown_methods).cast("string"), F.lit(" more*")))).otherwise(_empty())
    return F.when(n > 0, F.concat(_lines(KEY_METHODS, ""), F.array(shown), more, _lines(""))).otherwise(_empty())


def method_section_lines(sections: Column, sem: Column) -> Column:
    """The "Methods" part: per section (map order) the methods also in the
    semantic list (JN7), sorted by name (ORD4); sections with none are
    skipped, but the heading shows whenever both inputs are non-empty."""
    def one_section(e):
        km = F.array_sort(F.filter(F.map_entries(e["value"]["methods"]),
                                   lambda m: F.array_contains(sem, m["key"])))
        body = F.flatten(F.transform(km, lambda m: F.array(
            F.concat(F.lit("#### `"), m["key"], F.lit("`")), F.lit(""), format_method_doc(m["value"]), F.lit(""))))
        return F.when(F.size(km) > 0, F.concat(
            F.array(F.concat(F.lit("### "), section_label(e["key"])), F.lit("")), body)).otherwise(_empty())

    secs = F.coalesce(sections, F.create_map().cast("map<string,struct<methods:map<string,string>,method_count:int>>"))
    has = (F.size(F.map_keys(secs)) > 0) & (F.size(sem) > 0)
    return F.when(has, F.concat(_lines(METHODS, ""),
                                F.flatten(F.transform(F.map_entries(secs), one_section)))).otherwise(_empty())


_PAGE_FIELDS = {"class_doc": "string", "synopsis": "string", "role": "string", "action_phrase": "string",
                "visibility_score": "double", "input_datatype": "string", "output_datatype": "string",
                "semantic_methods": "array<string>"}


def class_page(records: DataFrame, keep: tuple[str, ...] = (), shown_methods: int = KEY_METHODS_SHOWN) -> DataFrame:
    """JOB4: ``(module_name, class_name, path, content, *keep)`` per record.
    Record fields the table lacks read as absent (null)."""
    for c, t in _PAGE_FIELDS.items():
        if c not in records.columns:
            records = records.withColumn(c, F.lit(None).cast(t))
    name, module = F.col("class_name"), F.col("module_name")
    syn, doc = F.col("synopsis"), F.col("class_doc")
    sem = F.coalesce(F.col("semantic_methods"), _empty())
    sections = F.col("structured_docs.sections") if "structured_docs" in records.columns else F.lit(None)
    lines = F.concat(
        F.array(F.concat(F.lit("# "), name), F.lit(""),
                F.concat(F.lit("**Module:** `" + MODULE_PATH_PREFIX), module, F.lit("`")), F.lit("")),
        metadata_lines(),
        F.when(_nonempty(syn), F.array(F.lit(SYNOPSIS), F.lit(""), syn, F.lit(""))).otherwise(_empty()),
        F.when(_nonempty(doc), F.array(F.lit(DESCRIPTION), F.lit(""), doc, F.lit(""))).otherwise(_empty()),
        key_method_lines(sem, shown_methods),
        method_section_lines(sections, sem),
    )
    return records.select(
        "module_name", "class_name",
        F.concat(module, F.lit("/"), name, F.lit(".md")).alias("path"),
        F.array_join(lines, "\n").alias("content"),
        *keep,
    )


def page_failures(records: DataFrame) -> Column:
    """A class page cannot be rendered when its score was given as an explicit
    null (the score is multiplied for the star count).  An absent score is
    the default.  ``score_null`` tells the two apart where the reader set it
    (``io.read_records(..., with_flags=True)``)."""
    return F.coalesce(F.col("score_null"), F.lit(False)) if "score_null" in records.columns else F.lit(False)


def current_records(records: DataFrame, order_col: str | None = None) -> DataFrame:
    """AGG2: one record per class of a module, the last by ``order_col``, else
    the one with the greatest docstring.  Pages, results and indexes built
    from these agree on one record."""
    return latest_per_key(records, ["module_name", "class_name"], order_col or ("class_doc" if "class_doc" in records.columns else None))


def module_results(records: DataFrame, order_col: str | None = None) -> DataFrame:
    """AGG8 per module: ``(module_name, status, class_count, error)``; a module
    with a failing page among its current records is ``error`` with 0 classes,
    without affecting others; ``error`` names its first failing class (in name
    order) and is null on success."""
    records = current_records(records, order_col)
    return records.groupBy("module_name").agg(
        F.count_distinct("class_name").alias("n"),
        F.count_if(page_failures(records)).alias("failed"),
        F.min(F.when(page_failures(records), F.col("class_name"))).alias("first"),
    ).select(
        "module_name",
        F.when(F.col("failed") > 0, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.when(F.col("failed") > 0, F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("class_count"),
        F.when(F.col("failed") > 0, F.concat(F.lit(PAGE_ERROR), F.coalesce("first", F.lit("")))).alias("error"),
    )


def build_summary(results: DataFrame) -> DataFrame:
    """AGG8: modules ok / total and classes total."""
    return results.agg(
        F.count_if(F.col("status") == "success").alias("modules_ok"),
        F.count(F.lit(1)).alias("modules_total"),
        F.sum("class_count").cast("bigint").alias("classes_total"),
    )


def module_pages(records: DataFrame, order_col: str | None = None, shown_methods: int = KEY_METHODS_SHOWN) -> DataFrame:
    """JOB4 for the build: class pages of modules without failures, one per
    class (AGG2: last record by ``order_col`` wins)."""
    recs = current_records(records, order_col)
    bad = recs.filter(page_failures(recs)).select("module_name").distinct()
    return class_page(recs.join(bad, "module_name", "left_anti"), shown_methods=shown_methods)


def module_index_lines(records: DataFrame, order_col: str | None = None) -> DataFrame:
    """JOB5 as line rows ``(module_name, path, kind, sort_key, line)``: a header
    with the class count, then one bullet per class in name order (with its
    synopsis if any).  Last record per ``(module, class)`` wins."""
    recs = latest_per_key(records.select("module_name", "class_name", "synopsis", *([order_col] if order_col else [])),
                          ["module_name", "class_name"], order_col) if order_col else \
        records.groupBy("module_name", "class_name").agg(F.max("synopsis").alias("synopsis"))
    counts = recs.groupBy("module_name").agg(F.count(F.lit(1)).alias("n"))
    header = counts.select(
        "module_name",
        F.inline(F.array(*[
            F.struct(F.lit(f"{i:02d}").alias("sort_key"), x.alias("line"))
            for i, x in enumerate([
                F.concat(F.lit("# "), F.col("module_name")), F.lit(""),
                F.concat(F.lit("**"), F.col("n").cast("string"), F.lit(" classes**")), F.lit(""),
                F.lit(CLASSES), F.lit(""),
            ])
        ])),
    ).withColumn("kind", F.lit(0))
    bullets = recs.select(
        "module_name", F.lit(1).alias("kind"), F.col("class_name").alias("sort_key"),
        F.concat(F.lit("- [`"), F.col("class_name"), F.lit("`]("), F.col("class_name"), F.lit(".md)"),
                 F.when(_nonempty(F.col("synopsis")), F.concat(F.lit(" - "), F.col("synopsis"))).otherwise(F.lit("")))
        .alias("line"),
    )
    lines = header.select("module_name", "kind", "sort_key", "line").unionByName(bullets)
    return lines.select("module_name", F.concat("module_name", F.lit("/" + INDEX_FILE)).alias("path"), "kind", "sort_key", "line")


def main_index_lines(results: DataFrame, version: str = "VTK (version unknown)",
                     title: str = DEFAULT_TITLE) -> DataFrame:
    """JOB6 as line rows ``(path, kind, sort_key, line)``: successful modules only,
    totals in the header, one bullet per module in name order."""
    ok = results.filter(F.col("status") == "success")
    totals = ok.agg(F.count(F.lit(1)).alias("m"), F.coalesce(F.sum("class_count"), F.lit(0)).alias("c"))
    header = totals.select(F.inline(F.array(*[
        F.struct(F.lit(f"{i:02d}").alias("sort_key"), x.alias("line"))
        for i, x in enumerate([
            F.lit("# " + title), F.lit(""), F.lit(f"**{version}**"), F.lit(""),
            F.concat(F.lit("This documentation covers "), F.col("m").cast("string"), F.lit(" modules with "),
                     thousands(F.col("c")), F.lit(" classes.")),
            F.lit(""), F.lit(MODULES), F.lit(""),
        ])
    ]))).withColumn("kind", F.lit(0))
    bullets = ok.select(
        F.lit(1).alias("kind"), F.col("module_name").alias("sort_key"),
        F.concat(F.lit("- ["), F.col("module_name"), F.lit("]("), F.col("module_name"), F.lit("/index.md) ("),
                 F.col("class_count").cast("string"), F.lit(" classes)")).alias("line"),
    )
    lines = header.select("kind", "sort_key", "line").unionByName(bullets)
    return lines.select(F.lit(INDEX_FILE).alias("path"), "kind", "sort_key", "line")


def assemble(lines: DataFrame, group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Join line rows into page text per group, in ``(kind, sort_key)``
    order.  Gathers a whole page into one row: for bounded pages only."""
    return lines.groupBy(*group_cols).agg(
        F.expr("listagg(line, '\\n') within group (order by kind, sort_key)").alias("content"))
