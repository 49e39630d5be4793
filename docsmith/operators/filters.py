"""Row filters (FLT1-FLT8) as Column predicates and DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsmith.functions.text import col_, py_strip
from docsmith.schema import BOILERPLATE_METHODS


def inventory_filter(inventory: DataFrame, prefix: str = "vtk",
                     excluded_prefixes: tuple[str, ...] = ("vtk_", "vtkm")) -> DataFrame:
    """FLT1: library classes: name starts with ``prefix`` but none of the
    excluded prefixes, is a class, and lives in a module starting with
    ``prefix``."""
    name = F.col("class_name")
    cond = name.startswith(prefix) & F.col("is_class") & F.col("module_name").startswith(prefix)
    for p in excluded_prefixes:
        cond = cond & ~name.startswith(p)
    return inventory.filter(cond)


def is_boilerplate(method: Column | str, extra: tuple[str, ...] = ()) -> Column:
    """FLT2: dunder or private (leading underscore) or a fixed infrastructure
    name.  The name set is small and fixed, so ``isin`` (a hash set lookup in
    codegen) replaces a join."""
    m = col_(method)
    return m.startswith("_") | m.isin(list(BOILERPLATE_METHODS) + list(extra))


def drop_boilerplate(class_methods: DataFrame) -> DataFrame:
    return class_methods.filter(~is_boilerplate("method_name"))


def cacheable(records: DataFrame) -> DataFrame:
    """FLT5: records worth caching: a non-empty synopsis or action phrase."""
    return records.filter(
        (F.coalesce(F.col("synopsis"), F.lit("")) != "")
        | (F.coalesce(F.col("action_phrase"), F.lit("")) != "")
    )


def is_labelable(doc: Column | str) -> Column:
    """FLT6: a docstring with some non-whitespace text."""
    d = col_(doc)
    return d.isNotNull() & (py_strip(d) != "")


def search_predicate(df: DataFrame, field: str, query: str) -> Column:
    """FLT7: case-blind substring test on ``field``.

    A field the table does not have reads as ``""`` (so only an empty query
    matches); a non-string field never matches; a null value never matches.
    """
    q = query.lower()
    fields = {f.name: f.dataType for f in df.schema.fields}
    if field not in fields:
        return F.lit(q == "")
    if not isinstance(fields[field], T.StringType):
        return F.lit(False)
    return F.coalesce(F.lower(F.col(field)).contains(F.lit(q)), F.lit(False))


def annotatable(records: DataFrame) -> DataFrame:
    """FLT8: records with a non-empty class docstring."""
    return records.filter(F.col("class_doc").isNotNull() & (F.col("class_doc") != ""))
