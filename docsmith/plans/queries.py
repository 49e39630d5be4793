"""Registered queries: one per operator of the catalog library.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that reads the test
views (themselves derived from the driver's whole tables) and runs library
operators on them.  ``ORACLE[name]`` is the same computation in DuckDB SQL.
Column names and types agree between both (counts are BIGINT, scores DOUBLE).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.functions.text import clean_docstring
from docsmith.operators import helpparse as hp
from docsmith.plans import oracle as O
from docsmith.plans.views import duck_with, spark_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _help(spark, sf):
    return spark_view(spark, "v_help", sf)


def _marked(spark, sf):
    return hp.mark_lines(hp.explode_lines(hp.partition_by_doc(_help(spark, sf))))


# --------------------------------------------------------------------------
# TXT: help-text structure
# --------------------------------------------------------------------------

_PARSE = duck_with("v_help") + "," + O.parse_ctes("v_help")


@query("txt1_line_explode", _PARSE + "select module_name, class_name, pos, line from lines")
def txt1_line_explode(spark, sf):
    return hp.explode_lines(_help(spark, sf)).drop(hp.DOC_ID)


@query("txt2_class_doc_span", _PARSE + """
select module_name, class_name, pos, substring(line, 5) as text from m2
where is_p and not is_cls and cls_seen = 1 and mro_seen = 0""")
def txt2_class_doc_span(spark, sf):
    m = _marked(spark, sf)
    return m.filter(hp.class_doc_lines(m)).select(
        *hp.DOC_KEYS, "pos", F.substr(F.col("line"), F.lit(5)).alias("text"))


@query("txt3_section_headers", _PARSE + """
select module_name, class_name, pos, sec_name as section from m2 where is_hdr""")
def txt3_section_headers(spark, sf):
    return _marked(spark, sf).filter("is_hdr").select(
        *hp.DOC_KEYS, "pos", F.col("sec_name").alias("section"))


@query("txt4_section_islands", _PARSE + """
select module_name, class_name, cast(sec as bigint) as sec, any_value(sec_name) as section,
  cast(count(*) as bigint) as content_lines
from m3 where is_content group by module_name, class_name, sec""")
def txt4_section_islands(spark, sf):
    m = hp.mark_methods(_marked(spark, sf))
    return m.filter("is_content").groupBy(*hp._KEYS, "sec").agg(
        F.first("sec_name").alias("section"), F.count(F.lit(1)).alias("content_lines")).drop(hp.DOC_ID)


@query("txt5_method_islands", _PARSE + """
select module_name, class_name, cast(sec as bigint) as sec, cast(mid as bigint) as mid,
  any_value(mname) as method, min(pos) as start, cast(count(*) as bigint) as n_lines
from m4 where is_content and mid > 0 and sig_sec = sec and mname <> ''
group by module_name, class_name, sec, mid""")
def txt5_method_islands(spark, sf):
    m = hp.mark_methods(_marked(spark, sf))
    return m.filter("in_block").groupBy(*hp._KEYS, "sec", "mid").agg(
        F.first("mname").alias("method"), F.min("pos").alias("start"),
        F.count(F.lit(1)).alias("n_lines")).drop(hp.DOC_ID)


@query("txt6_method_docs", _PARSE + """
select module_name, class_name, cast(sec as bigint) as sec, cast(mid as bigint) as mid, section, method,
  start, doc from nb""")
def txt6_method_docs(spark, sf):
    b = hp.method_blocks(hp.mark_methods(_marked(spark, sf)))
    return b.select(*hp.DOC_KEYS, "sec", "mid", "section", "method", "start", "doc")


@query("txt7_duplicate_resolution", _PARSE + """
select module_name, class_name, section, method, cast(sec as bigint) as sec, cast(mid as bigint) as mid,
  cast(sec_ord as bigint) as sec_ord, ord from resolved""")
def txt7_duplicate_resolution(spark, sf):
    b = hp.method_blocks(hp.mark_methods(_marked(spark, sf)))
    return hp.resolve_duplicates(b).select(
        *hp.DOC_KEYS, "section", "method", "sec", "mid", "sec_ord", "ord")


@query("txt8_docstring_clean", duck_with("v_records") + f"""
select class_name, seq, {O.clean_doc('class_doc')} as doc from v_records""")
def txt8_docstring_clean(spark, sf):
    r = spark_view(spark, "v_records", sf)
    return r.select("class_name", "seq", clean_docstring("class_doc").alias("doc"))


@query("txt9_help_parse", _PARSE + """
select module_name, class_name, section, method, ord, doc from resolved""")
def txt9_help_parse(spark, sf):
    _, methods = hp.parse_help(_help(spark, sf))
    return methods.select(*hp.DOC_KEYS, "section", "method", "ord", "doc")


@query("txt9_class_docs", _PARSE + "select module_name, class_name, class_doc from cdocs")
def txt9_class_docs(spark, sf):
    docs, _ = hp.parse_help(_help(spark, sf))
    return docs.select(*hp.DOC_KEYS, "class_doc")


@query("txt10_nested_assembly", _PARSE + f""",
sec_agg as (
  select module_name, class_name, section, sec_ord, count(*) as n,
    string_agg(method, {O.NL} order by ord) as names
  from resolved group by module_name, class_name, section, sec_ord)
select c.module_name, c.class_name, c.class_doc,
  coalesce(string_agg(s.section, {O.NL} order by s.sec_ord), '') as section_names,
  cast(coalesce(sum(s.n), 0) as bigint) as method_total,
  coalesce(string_agg(s.names, {O.NL} order by s.sec_ord), '') as method_names
from cdocs c left join sec_agg s on s.module_name = c.module_name and s.class_name = c.class_name
group by c.module_name, c.class_name, c.class_doc""")
def txt10_nested_assembly(spark, sf):
    sd = hp.structured_docs(_help(spark, sf))
    secs = F.col("structured_docs.sections")
    return sd.select(
        *hp.DOC_KEYS, "class_doc",
        F.array_join(F.map_keys(secs), "\n").alias("section_names"),
        F.aggregate(F.map_values(secs), F.lit(0).cast("bigint"),
                    lambda acc, s: acc + s["method_count"]).alias("method_total"),
        F.array_join(F.transform(F.map_values(secs),
                                 lambda s: F.array_join(F.map_keys(s["methods"]), "\n")), "\n")
        .alias("method_names"),
    )


@query("agg3_methods_per_section", _PARSE + """
select module_name, class_name, section, cast(count(*) as bigint) as method_count
from resolved group by module_name, class_name, section""")
def agg3_methods_per_section(spark, sf):
    _, methods = hp.parse_help(_help(spark, sf))
    return hp.methods_per_section(methods)
