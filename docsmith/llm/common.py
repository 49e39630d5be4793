"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship_by_value(module_name: str) -> None:
    """Send the functions of a module to Python workers by value, so that the
    executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    ``body`` (or a lambda inside it) refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
