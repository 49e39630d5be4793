"""Help-text parsing (TXT1-TXT10) as gap-and-island window functions.

A help dump is one row per class: ``(module_name, class_name, help_text)``.
Parsing explodes each text into numbered lines and finds

* the class docstring span (TXT2),
* section islands: a running count of header lines (TXT3, TXT4),
* method islands inside a section: a running count of signature lines (TXT5),
* each method's cleaned docstring, one ``listagg`` per island (TXT6, TXT8),
* the surviving method per name and section (TXT7),

and assembles the nested ``structured_docs`` value (TXT10).

Physical plan: the dump is hash-partitioned once on the document key
(``module_name, class_name`` and a hash of the text) *before* the explode, so
the shuffle moves each text once and not one row per line.  That shuffle is
the exchange of an aggregation that drops exact copies (its partial step runs
map-side).  Every later window and group-by is keyed by the document key plus
more columns, which that partitioning already satisfies: the whole parse has
exactly one Exchange.  Each running-window pass is one Window operator, and
both passes share one ordering (document key, line number), so Spark sorts
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsmith.functions.text import finish_cleaned_lines, is_cpp_line, py_strip
from docsmith.schema import HELP_DOC_INDENT, HELP_PREFIX, MRO_MARKER, SECTION_HEADERS

DOC_KEYS = ("module_name", "class_name")
# Internal document identity: a hash of the text.  It is deterministic (a
# retried task reproduces it whatever the row order of its input), it keeps
# rows that share (module, class) but differ in text apart (their lines never
# mix in one window), and exact copies of a row collapse into one document.
DOC_ID = "_doc"
_KEYS = DOC_KEYS + (DOC_ID,)
# Ingestion order of the dump's rows, if it has one (see io.read_help_dump).
SEQ = "seq"
_NL = "\n"


def _carried(rows: DataFrame) -> list[Column]:
    """The ingestion order of a document, from whichever of its rows has it."""
    return [F.max(SEQ).alias(SEQ)] if SEQ in rows.columns else []


def with_doc_id(help_df: DataFrame) -> DataFrame:
    """Tag every input row with its document id (hash of the help text)."""
    if DOC_ID in help_df.columns:
        return help_df
    return help_df.withColumn(DOC_ID, F.xxhash64(F.coalesce(F.col("help_text"), F.lit(""))))


def _running(keys=_KEYS):
    return (
        Window.partitionBy(*keys)
        .orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _listagg_ordered(col_name: str, order_by: str = "pos") -> Column:
    return F.expr(f"listagg({col_name}, '\\n') within group (order by {order_by})")


def partition_by_doc(help_df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Co-locate each document's text on the document key: the one shuffle.

    Exact copies (same module, class and text) collapse into one document by
    an aggregation whose partial step runs before the shuffle, so a group of
    copies holding a third of all rows shrinks map-side instead of landing on
    one reducer.  Its output is hash-partitioned on the document key, which
    every later window and group-by of the parse reuses."""
    tagged = with_doc_id(help_df)
    if num_partitions:
        tagged = tagged.repartition(num_partitions, *_KEYS)
    return distinct_texts(tagged)


def distinct_texts(tagged: DataFrame) -> DataFrame:
    """One row per document; with an ingestion order ``seq``, where its text
    was given last."""
    if SEQ not in tagged.columns:
        return tagged.dropDuplicates(list(_KEYS))
    return tagged.groupBy(*_KEYS).agg(F.first("help_text").alias("help_text"), F.max(SEQ).alias(SEQ))


def explode_lines(help_df: DataFrame) -> DataFrame:
    """TXT1: one row per line, ``pos`` from 0, empty lines and order kept."""
    own = [SEQ] if SEQ in help_df.columns else []
    lines = with_doc_id(help_df).select(
        *_KEYS, *own,
        F.posexplode(F.split(F.coalesce(F.col("help_text"), F.lit("")), _NL, -1)).alias("pos", "line"),
    ).withColumn("pos", F.col("pos").cast("bigint"))
    return lines.withColumns({c: F.when(F.col("pos") == 0, F.col(c)) for c in own})  # a document's first line carries its order


def is_section_header(line: Column) -> Column:
    """TXT3: the line contains one of the header phrases anywhere."""
    cond = F.lit(False)
    for h in SECTION_HEADERS:
        cond = cond | line.contains(h)
    return cond


def header_name(line: Column) -> Column:
    """Section key of a header line: stripped, then every bar-prefix removed
    (the leading bar survives because stripping removed the space before it)."""
    return F.replace(py_strip(line), F.lit(HELP_PREFIX), F.lit(""))


def mark_lines(lines: DataFrame) -> DataFrame:
    """Per-line flags (no window) and the first running-window pass.

    Adds ``is_p`` (bar-prefixed body line), ``is_cls`` (the ``class <name>``
    line), ``is_mro``, ``is_hdr``, then running ``cls_seen``, ``mro_seen``,
    ``sec`` (section number) and ``sec_name``.
    """
    line = F.col("line")
    stripped = py_strip(line)
    is_cls = stripped.startswith(F.concat(F.lit("class "), F.col("class_name")))
    w = _running()
    flagged = lines.select(
        "*",
        line.startswith(HELP_PREFIX).alias("is_p"),
        F.coalesce(is_cls, F.lit(False)).alias("is_cls"),
        is_section_header(line).alias("is_hdr"),
    ).withColumn("is_mro", line.contains(MRO_MARKER) & ~F.col("is_cls"))
    # one select: the four running aggregates share one Window operator
    return flagged.select(
        "*",
        F.max(F.col("is_cls").cast("int")).over(w).alias("cls_seen"),
        F.max(F.col("is_mro").cast("int")).over(w).alias("mro_seen"),
        F.sum(F.col("is_hdr").cast("int")).over(w).alias("sec"),
        F.last(F.when(F.col("is_hdr"), header_name(line)), ignorenulls=True).over(w).alias("sec_name"),
    )


def class_doc_lines(marked: DataFrame) -> Column:
    """TXT2 predicate: a body line after the first class line, before any
    method-resolution-order line."""
    return (
        F.col("is_p")
        & ~F.col("is_cls")
        & (F.col("cls_seen") == 1)
        & (F.col("mro_seen") == 0)
    )


def mark_methods(marked: DataFrame) -> DataFrame:
    """TXT5, second running-window pass over the same ordering.

    ``is_content``: a body line inside a section (header lines excluded);
    ``is_sig``: a content line with ``(`` that is not a 6-space continuation;
    ``mid``: running signature count, the method-island id; ``mname``: name of
    the island's signature; ``in_block``: the line belongs to a named island
    opened in the same section.
    """
    line = F.col("line")
    stripped = py_strip(line)
    is_content = ~F.col("is_hdr") & F.col("is_p") & (F.col("sec") > 0)
    mline = F.replace(line, F.lit(HELP_PREFIX), F.lit(""))
    w = _running()
    flagged = marked.select("*", is_content.alias("is_content"), mline.alias("mline")).withColumn(
        "is_sig", F.col("is_content") & (stripped != "") & line.contains("(")
        & ~line.startswith(HELP_DOC_INDENT) & ~stripped.startswith("------"))
    # one select: the three running aggregates share one Window operator
    return flagged.select(
        "*",
        F.sum(F.col("is_sig").cast("int")).over(w).alias("mid"),
        F.max(F.when(F.col("is_sig"), F.col("sec"))).over(w).alias("sig_sec"),
        F.last(F.when(F.col("is_sig"), py_strip(F.substring_index(F.col("mline"), "(", 1))),
               ignorenulls=True).over(w).alias("mname"),
    ).withColumn(
        "in_block",
        F.col("is_content") & (F.col("mid") > 0) & (F.col("sig_sec") == F.col("sec")) & (F.col("mname") != ""),
    )


def class_docs(marked: DataFrame) -> DataFrame:
    """TXT2 + TXT8 alone: ``(module_name, class_name, class_doc)``."""
    sub = F.substr(F.col("line"), F.lit(5))
    kept = F.when(class_doc_lines(marked) & ~is_cpp_line(sub), py_strip(sub))
    return (
        marked.withColumn("cdoc_line", kept)
        .groupBy(*_KEYS)
        .agg(_listagg_ordered("cdoc_line").alias("cdoc_raw"))
        .select(*DOC_KEYS, finish_cleaned_lines("cdoc_raw").alias("class_doc"))
    )


def islands(methods_marked: DataFrame) -> DataFrame:
    """TXT2 + TXT6 in one aggregation.

    Every document yields one class-docstring island (``is_cdoc``, sec = mid =
    -1; fed by its class-doc lines, and by line 0 so that a text without a
    docstring still yields a row) and one island per named method block.  A
    line that is both (a header phrase inside the class prose) feeds both.
    Columns: keys, ``is_cdoc``, ``sec``, ``mid``, ``section``, ``method``,
    ``start``, ``doc``.  Method islands whose doc cleans to ``""`` are dropped.
    """
    sub = F.substr(F.col("line"), F.lit(5))
    is_cdoc_line = class_doc_lines(methods_marked)
    tags = F.array_compact(F.array(
        F.when(is_cdoc_line | (F.col("pos") == 0),
               F.struct(F.lit(-1).cast("bigint").alias("sec"), F.lit(-1).cast("bigint").alias("mid"),
                        F.lit(True).alias("is_cdoc"))),
        F.when(F.col("in_block"),
               F.struct(F.col("sec").cast("bigint").alias("sec"), F.col("mid").cast("bigint").alias("mid"),
                        F.lit(False).alias("is_cdoc"))),
    ))
    text = F.when(
        F.col("t.is_cdoc"),
        F.when(is_cdoc_line & ~is_cpp_line(sub), py_strip(sub)),
    ).otherwise(F.when(~is_cpp_line(F.col("mline")), py_strip(F.col("mline"))))
    return (
        methods_marked.filter(is_cdoc_line | (F.col("pos") == 0) | F.col("in_block"))
        .withColumn("t", F.explode(tags))
        .withColumn("kept_line", text)
        .groupBy(*_KEYS, F.col("t.sec").alias("sec"), F.col("t.mid").alias("mid"))
        .agg(
            F.first("t.is_cdoc").alias("is_cdoc"),
            F.first("mname").alias("method"),
            F.first("sec_name").alias("section"),
            F.min("pos").alias("start"),
            _listagg_ordered("kept_line").alias("doc_raw"),
            *_carried(methods_marked),
        )
        .withColumn("doc", finish_cleaned_lines("doc_raw"))
        .withColumn("method", F.when(~F.col("is_cdoc"), F.col("method")))
        .withColumn("section", F.when(~F.col("is_cdoc"), F.col("section")))
        .drop("doc_raw")
        .filter(F.col("is_cdoc") | (F.col("doc") != ""))
    )


def method_blocks(methods_marked: DataFrame) -> DataFrame:
    """TXT6: one row per method island with its cleaned, non-empty docstring."""
    return islands(methods_marked).filter(~F.col("is_cdoc")).drop("is_cdoc")


def resolve_duplicates(blocks: DataFrame) -> DataFrame:
    """TXT7: last non-empty section instance per section name wins whole; in
    it, the last island per method name wins.  ``sec_ord``/``ord`` keep the
    first-appearance order of section and method names.  Class-doc islands
    (section null, sec = mid = -1) pass through unchanged."""
    by_section = Window.partitionBy(*_KEYS, "section")
    by_method = Window.partitionBy(*_KEYS, "sec", "method")
    return (
        blocks.withColumn("last_sec", F.max("sec").over(by_section))
        .withColumn("sec_ord", F.min("sec").over(by_section))
        .filter(F.col("sec") == F.col("last_sec"))
        .withColumn("last_mid", F.max("mid").over(by_method))
        .withColumn("ord", F.min("start").over(by_method))
        .filter(F.col("mid") == F.col("last_mid"))
        .drop("last_sec", "last_mid")
    )


def parse_unified(help_df: DataFrame, num_partitions: int | None = None,
                  prepartitioned: bool = False) -> DataFrame:
    """TXT9 as one lineage: class-doc rows (``is_cdoc``) and surviving method
    rows ``(section, method, ord, doc, sec_ord)`` of every text."""
    src = distinct_texts(with_doc_id(help_df)) if prepartitioned \
        else partition_by_doc(help_df, num_partitions)
    marked = mark_methods(mark_lines(explode_lines(src)))
    return resolve_duplicates(islands(marked))


def parse_help(help_df: DataFrame, num_partitions: int | None = None,
               prepartitioned: bool = False) -> tuple[DataFrame, DataFrame]:
    """TXT9: help dump -> ``(class_docs, methods)``.

    ``methods`` is the flat form ``(module_name, class_name, _doc, section,
    method, ord, doc, sec_ord)``; ``_doc`` tells apart rows of one class with
    different texts.  Both come from one parse; use
    :func:`structured_docs` when both are needed together, which keeps them in
    one lineage (one scan, one shuffle).
    """
    u = parse_unified(help_df, num_partitions, prepartitioned)
    docs = u.filter("is_cdoc").select(*_KEYS, F.col("doc").alias("class_doc"))
    methods = u.filter("not is_cdoc").select(*_KEYS, "section", "method", "ord", "doc", "sec_ord")
    return docs, methods


_SECTION_VALUE = "struct<methods:map<string,string>,method_count:int>"


def nest_sections(unified: DataFrame) -> DataFrame:
    """TXT10: parse rows -> ``(module_name, class_name, class_doc, sections)``
    where ``sections`` is ``map<section, struct<methods map, method_count>>``
    in first-appearance order.  Both group-bys are keyed by the document key,
    so they reuse the parse's partitioning (no exchange)."""
    per_section = unified.groupBy(*_KEYS, "is_cdoc", "section", "sec_ord").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(
                    F.when(~F.col("is_cdoc"), F.struct("ord", "method", "doc")))),
                lambda x: F.struct(x["method"], x["doc"]),
            )
        ).alias("methods"),
        F.count(F.when(~F.col("is_cdoc"), F.lit(1))).cast("int").alias("method_count"),
        F.max(F.when(F.col("is_cdoc"), F.col("doc"))).alias("class_doc"),
        *_carried(unified),
    )
    by_sec_ord = lambda a, b: F.signum(a["sec_ord"] - b["sec_ord"]).cast("int")
    entries = F.filter(
        F.collect_list(
            F.struct("sec_ord", "section", "is_cdoc", F.struct("methods", "method_count").alias("v"))
        ),
        lambda x: ~x["is_cdoc"],
    )
    return per_section.groupBy(*_KEYS).agg(
        F.coalesce(F.max("class_doc"), F.lit("")).alias("class_doc"),
        F.map_from_entries(
            F.transform(F.array_sort(entries, by_sec_ord), lambda x: F.struct(x["section"], x["v"]))
        ).alias("sections"),
        *_carried(per_section),
    )


def structured_docs(help_df: DataFrame, num_partitions: int | None = None,
                    prepartitioned: bool = False) -> DataFrame:
    """Help dump -> ``(module_name, class_name, class_doc, structured_docs)``,
    one row per text (an empty ``sections`` map when it has no method), and its
    ``seq`` if the dump has one."""
    nested = nest_sections(parse_unified(help_df, num_partitions, prepartitioned))
    return nested.select(
        *DOC_KEYS,
        "class_doc",
        F.struct(F.col("class_doc"), F.col("sections")).alias("structured_docs"),
        *([SEQ] if SEQ in nested.columns else []),
    )


def methods_per_section(methods: DataFrame) -> DataFrame:
    """AGG3: method count of every surviving section (per parsed document)."""
    keys = [k for k in _KEYS if k in methods.columns]
    return methods.groupBy(*keys, "section").agg(F.count(F.lit(1)).alias("method_count")).drop(DOC_ID)
