"""Catalog build and catalog queries (JOB1, JOB7-JOB9, AGG1, AGG2, AGG4,
SET2, ORD3, JN1).

``build_catalog`` turns a help dump plus catalog tables into records of the
RECORD schema.  The parse (one shuffle on the document key) feeds the record
rows; the profile is computed over the catalog's own class names (never from
the parsed records, so the parse runs once) and joined on ``class_name``
together with the labels.  Both joins are on the same key, so the records
are exchanged once for both; AQE turns either into a broadcast join when the
profile or label table is small at run time, and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.functions.text import bare_module
from docsmith.operators import helpparse as hp
from docsmith.operators import hierarchy as hy
from docsmith.operators.filters import cacheable, inventory_filter, search_predicate
from docsmith.operators.labelling import apply_labels
from docsmith.schema import DEFAULT_VISIBILITY, RECORD, SEARCH_DEFAULT_LIMIT

RECORD_COLS = [f.name for f in RECORD.fields]


def catalog_profile(classes: DataFrame, class_bases: DataFrame, ports: DataFrame,
                    class_methods: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """CLS6 over every class the catalog tables know."""
    names = classes.select("class_name").unionByName(class_methods.select("class_name")).distinct()
    flags = flags if flags is not None else hy.isa_flags(class_bases)
    return hy.profile(names, classes, flags, ports, class_methods)


def attach_profile(records: DataFrame, prof: DataFrame) -> DataFrame:
    """JN1: every record kept; unknown classes get ``utility, "", "", []``."""
    return (
        records.join(prof, "class_name", "left")
        .withColumn("role", F.coalesce(F.col("role"), F.lit(hy.DEFAULT_ROLE)))
        .withColumn("input_datatype", F.coalesce(F.col("input_datatype"), F.lit("")))
        .withColumn("output_datatype", F.coalesce(F.col("output_datatype"), F.lit("")))
        .withColumn("semantic_methods",
                    F.coalesce(F.col("semantic_methods"), F.array().cast("array<string>")))
    )


def build_catalog(help_dump: DataFrame, profile: DataFrame | None, labels: DataFrame | None = None,
                  num_partitions: int | None = None, prepartitioned: bool = False) -> DataFrame:
    """JOB1: help dump -> catalog records (RECORD schema, plus ``matched``, and
    ``seq`` if the dump has it).
    Without a profile every class gets the unknown-class defaults.
    ``prepartitioned``: the dump is bucketed on the document key and its
    module names are already bare (see ``io.write_help_dump_bucketed``)."""
    if prepartitioned:
        docs = hp.structured_docs(help_dump, prepartitioned=True)
    else:
        hd = help_dump.withColumn("module_name", bare_module("module_name"))
        docs = hp.structured_docs(hd, num_partitions)
    if profile is None:  # no join: every class gets the unknown-class defaults
        recs = docs.select(
            "*", F.lit(hy.DEFAULT_ROLE).alias("role"), F.lit("").alias("input_datatype"),
            F.lit("").alias("output_datatype"), F.array().cast("array<string>").alias("semantic_methods"))
    else:
        recs = attach_profile(docs, profile)
    if labels is None:
        recs = (recs.withColumn("synopsis", F.lit("")).withColumn("action_phrase", F.lit(""))
                .withColumn("visibility_score", F.lit(DEFAULT_VISIBILITY)).withColumn("matched", F.lit(False)))
    else:
        recs = apply_labels(recs, labels)
    return recs.select(*RECORD_COLS, "matched", *([hp.SEQ] if hp.SEQ in recs.columns else []))


def record_method_count():
    """Number of methods of a record over all its sections."""
    return F.aggregate(
        F.map_values(F.coalesce(F.col("structured_docs.sections"),
                                F.create_map().cast("map<string,struct<methods:map<string,string>,method_count:int>>"))),
        F.lit(0).cast("bigint"),
        lambda acc, s: acc + F.coalesce(F.size(s["methods"]), F.lit(0)).cast("bigint"),
    )


def stats(records: DataFrame) -> DataFrame:
    """AGG4: records, distinct modules, methods over all sections.
    A global aggregate: partial per task, one tiny final merge."""
    return records.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.coalesce(F.col("module_name"), F.lit("unknown"))).alias("modules"),
        F.coalesce(F.sum(record_method_count()), F.lit(0)).cast("bigint").alias("total_methods"),
    )


def help_stats(help_dump: DataFrame, prepartitioned: bool = False) -> DataFrame:
    """AGG4 of a help dump: the counts of :func:`stats` from the flat parse,
    which nests no sections only to count their methods."""
    rows = hp.parse_unified(help_dump, prepartitioned=prepartitioned)
    return rows.agg(
        F.count_if(F.col("is_cdoc")).alias("total_records"),
        F.count_distinct(F.coalesce(F.col("module_name"), F.lit("unknown"))).alias("modules"),
        F.count_if(~F.col("is_cdoc")).alias("total_methods"),
    )


def database_size_mib(spark: SparkSession, path: str) -> DataFrame:
    """AGG5: ``(size_mib, files)`` of the files of a database, from the file
    listing (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    return files.agg((F.coalesce(F.sum("length"), F.lit(0)) / 1048576.0).alias("size_mib"), F.count(F.lit(1)).alias("files"))


def database_stats(records: DataFrame, path: str) -> DataFrame:
    """JOB8: :func:`stats` of ``records`` with the size of their files under
    ``path``."""
    size = database_size_mib(records.sparkSession, path).select("size_mib").scalar()
    return stats(records).withColumn("size_mib", size)


def distinct_modules(records: DataFrame) -> DataFrame:
    """SET2."""
    return records.select(F.coalesce(F.col("module_name"), F.lit("unknown")).alias("module_name")).distinct()


def search(records: DataFrame, query: str, field: str = "class_name",
           limit: int = SEARCH_DEFAULT_LIMIT, order_col: str = "seq") -> DataFrame:
    """JOB7/ORD3: hits of FLT7, the first ``limit`` in file order, each with
    the total hit count.  The total is a scalar subquery (a global count with
    partial aggregation); the page is a per-task top-k merged once.  File
    order is ``order_col`` (see ``io.read_records(with_seq=True)``); records
    without it are paged in (module, class) order."""
    hits = records.filter(search_predicate(records, field, query))
    total = hits.select(F.count(F.lit(1))).scalar()
    order = [order_col] if order_col in records.columns else ["module_name", "class_name"]
    cols = [c for c in (order_col, "class_name", "module_name", "synopsis") if c in records.columns]
    return hits.orderBy(*order).limit(limit).select(*cols, total.alias("total_hits"))


def export_label_cache(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """JOB9: label-cache rows from records with a synopsis or action phrase;
    a missing score becomes 0.3."""
    return cacheable(records).select(
        "class_name", *keep, "synopsis", "action_phrase",
        F.coalesce(F.col("visibility_score"), F.lit(DEFAULT_VISIBILITY)).alias("visibility_score"),
    )


def classes_per_module(inventory: DataFrame, prefix: str = "vtk") -> DataFrame:
    """AGG1: ``(module_name, classes)`` over the filtered inventory."""
    return inventory_filter(inventory, prefix).groupBy("module_name").agg(F.count(F.lit(1)).alias("classes"))


def discovery_totals(inventory: DataFrame, prefix: str = "vtk") -> DataFrame:
    """AGG1 totals: modules with classes and classes found."""
    return inventory_filter(inventory, prefix).agg(
        F.count_distinct("module_name").alias("modules"), F.count(F.lit(1)).alias("classes"))
