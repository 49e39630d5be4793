"""Labels: cache lookup, the pluggable batch labeller, and applying labels
(JN2-JN4, SET1, UDF1, AGG6, AGG7, SRC3's last-wins rule).

A label is keyed by ``class_name`` only.  Cache rows are looked up first; only
classes without a cache row and with a non-blank docstring reach the
labeller, once per class.  The labeller is the single Python step: a
caller-supplied function run by ``mapInPandas`` over Arrow batches, with the
degree of parallelism (= concurrent calls to a rate-limited service) set by
repartitioning the *deduplicated misses*, never the whole catalog.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.functions.labels import parse_label, prompt
from docsmith.functions.text import truncate_doc
from docsmith.operators.filters import is_labelable
from docsmith.schema import DEFAULT_VISIBILITY, LABEL, MAX_DOC_CHARS

LABEL_COLS = ("synopsis", "action_phrase", "visibility_score")


def latest_per_key(df: DataFrame, keys: list[str] | tuple[str, ...], order_col: str | None) -> DataFrame:
    """Last row per key by ``order_col`` (SRC3, AGG2: "last wins").  A null
    order is the earliest; ties (and no order column) go to the row with the
    greatest hash, so the choice never depends on the row order.

    ``max_by`` over a struct of the other columns is a plain aggregate, so
    Spark pre-aggregates per partition before the shuffle: a hot key sends
    one partial row per map task, not all its rows."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    hashed = [c for c in rest if "map<" not in df.schema[c].dataType.simpleString()]
    # a struct is never null: max_by would skip a row with a null order
    order = F.struct(*([F.col(order_col)] if order_col else []), F.xxhash64(F.lit(0), *hashed))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("_last"))
        .select(*keys, *[F.col("_last." + c).alias(c) for c in rest])
    )


def dedupe_label_cache(cache: DataFrame, order_col: str = "seq") -> DataFrame:
    """SRC3: one cache row per class, the last one in file order; a field the
    row lacks (or holds as null) takes its default."""
    return latest_per_key(cache, ["class_name"], order_col).select(
        "class_name",
        F.coalesce(F.col("synopsis"), F.lit("")).alias("synopsis"),
        F.coalesce(F.col("action_phrase"), F.lit("")).alias("action_phrase"),
        F.coalesce(F.col("visibility_score"), F.lit(DEFAULT_VISIBILITY)).alias("visibility_score"),
    )


def cache_hits(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """JN2: requests whose class has a cache row."""
    return requests.join(cache.select("class_name"), "class_name", "left_semi")


def cache_misses(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """JN3: requests whose class has no cache row."""
    return requests.join(cache.select("class_name"), "class_name", "left_anti")


def apply_labels(records: DataFrame, labels: DataFrame) -> DataFrame:
    """JN4: copy ``synopsis, action_phrase, visibility_score`` from the label
    of the record's class, with per-field defaults ``"", "", 0.3``; records
    without a label get all defaults.  Adds ``matched``."""
    lab = labels.select(
        "class_name",
        *[F.col(c).alias("_l_" + c) for c in LABEL_COLS],
        F.lit(True).alias("_l_hit"),
    )
    base = records.drop(*[c for c in LABEL_COLS if c in records.columns])
    hit = F.col("matched")
    return (
        base.join(lab, "class_name", "left")
        .withColumn("matched", F.coalesce(F.col("_l_hit"), F.lit(False)))
        # a label's fields are copied as they are (its producer applied the
        # defaults for absent fields); records without a label get the defaults
        .withColumn("synopsis", F.when(hit, F.col("_l_synopsis")).otherwise(F.lit("")))
        .withColumn("action_phrase", F.when(hit, F.col("_l_action_phrase")).otherwise(F.lit("")))
        .withColumn("visibility_score",
                    F.when(hit, F.col("_l_visibility_score")).otherwise(F.lit(DEFAULT_VISIBILITY)))
        .drop("_l_hit", *["_l_" + c for c in LABEL_COLS])
    )


def label_coverage(labelled: DataFrame) -> DataFrame:
    """AGG6: ``(classified, total)``."""
    return labelled.agg(
        F.count_if(F.col("matched")).alias("classified"), F.count(F.lit(1)).alias("total")
    )


def cache_usage(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """AGG7: distinct classes served from cache, requests and distinct classes
    left to label."""
    c = cache.select("class_name").distinct().withColumn("_hit", F.lit(True))
    # one row per class before the join: partial counts, so a hot class is one row
    r = requests.groupBy("class_name").agg(F.count(F.lit(1)).alias("_n")).join(c, "class_name", "left")
    missed = F.col("_hit").isNull()
    return r.agg(
        F.count_if(~missed).alias("cached_classes"),
        F.coalesce(F.sum(F.when(missed, F.col("_n"))), F.lit(0)).alias("uncached_requests"),
        F.count_if(missed & F.col("class_name").isNotNull()).alias("uncached_classes"),
    )


# --------------------------------------------------------------------------
# UDF1: the batch labeller
# --------------------------------------------------------------------------

Labeller = Callable[[pd.DataFrame], "pd.Series | list"]
"""Takes a batch with columns ``class_name, class_doc, prompt``; returns the
raw response text per row (same length and order).  It may raise: the batch
is then retried row by row and a row that still fails gets no label."""


def default_labeller(batch: pd.DataFrame) -> list[str]:
    """Deterministic stand-in for a model, for tests and dry runs: names the
    class and scores its docstring length."""
    out = []
    for name, doc in zip(batch["class_name"], batch["class_doc"]):
        score = (len(doc) % 100) / 100
        out.append(json.dumps({"synopsis": f"{name} docs", "action_phrase": "reading",
                               "visibility_score": score}))
    return out


def _call_safely(labeller: Labeller, pdf: pd.DataFrame) -> list:
    try:
        res = list(labeller(pdf))
        if len(res) == len(pdf):
            return res
    except Exception:  # noqa: BLE001 - one bad batch must not fail the job
        pass
    out = []
    for i in range(len(pdf)):
        try:
            r = list(labeller(pdf.iloc[i:i + 1]))
            out.append(r[0] if r else None)
        except Exception:  # noqa: BLE001
            out.append(None)
    return out


def _ship_by_value() -> None:
    """Pickle this library's functions by value when they are sent to Python
    workers, so a labeller batch runs on executors that do not have the
    package installed (the caller's own labeller module is theirs to ship)."""
    from pyspark import cloudpickle

    import docsmith

    cloudpickle.register_pickle_by_value(docsmith)


def run_labeller(misses: DataFrame, labeller: Labeller, concurrency: int | None = None,
                 max_doc_chars: int = MAX_DOC_CHARS) -> DataFrame:
    """UDF1: ``misses(class_name, class_doc)`` -> ``(class_name, content)``.

    Docstrings are truncated (SCL1) and the prompt built (SCL2) JVM-side; the
    labeller sees Arrow batches.  ``concurrency`` bounds how many batches run
    at once (one per partition); ``max_doc_chars`` is the docstring's limit."""
    _ship_by_value()
    req = misses.select(
        "class_name",
        truncate_doc("class_doc", max_doc_chars).alias("class_doc"),
        prompt("class_name", "class_doc", max_doc_chars).alias("prompt"),
    )
    if concurrency:
        req = req.repartition(concurrency, "class_name")

    def _map(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            content = _call_safely(labeller, pdf)
            yield pd.DataFrame({"class_name": pdf["class_name"],
                                "content": pd.Series(content, dtype="object")})

    return req.mapInPandas(_map, "class_name string, content string")


def parse_responses(responses: DataFrame) -> DataFrame:
    """SCL3-SCL6 over ``(class_name, content)``: rows that yield a label, as
    ``(class_name, synopsis, action_phrase, visibility_score)`` (absent fields
    null; :func:`apply_labels` fills the defaults).

    Rows without a label are dropped by exploding a zero-or-one element
    array instead of a ``Filter``: a filter would be pushed below the parse
    projections with the whole parse inlined into its condition (evaluated
    twice, and too large for one generated method)."""
    p = parse_label(responses.select("class_name", "content"), "content")
    label = F.struct(
        F.col("synopsis").alias("synopsis"),
        F.when(F.col("has_action"), F.col("action_phrase")).otherwise(F.lit("")).alias("action_phrase"),
        F.col("visibility_score").alias("visibility_score"),
    )
    return p.select("class_name", F.explode(F.when(F.col("is_label"), F.array(label))).alias("l")).select(
        "class_name", F.coalesce("l.synopsis", F.lit("")).alias("synopsis"), "l.action_phrase",
        "l.visibility_score")


def unique_requests(requests: DataFrame, order_col: str | None = None) -> DataFrame:
    """One request per class (labels are keyed by class name): the last by
    ``order_col`` when given, else the greatest docstring."""
    if order_col:
        return latest_per_key(requests.select("class_name", "class_doc", order_col),
                              ["class_name"], order_col).select("class_name", "class_doc")
    return requests.groupBy("class_name").agg(F.max("class_doc").alias("class_doc"))


def label_classes(requests: DataFrame, cache: DataFrame | None,
                  labeller: Labeller | None = None, responses: DataFrame | None = None,
                  order_col: str | None = None, concurrency: int | None = None,
                  max_doc_chars: int = MAX_DOC_CHARS) -> DataFrame:
    """JOB2: labels for the requested classes: cache rows for cached classes
    (SET1) unioned with fresh labels for the rest.

    Fresh labels come from ``labeller`` (UDF1) or, for replay and tests, from
    a ``responses(class_name, content)`` table.  With neither, misses stay
    unlabelled and later get the defaults."""
    req = requests.select("class_name", "class_doc", *([order_col] if order_col else []))
    parts = []
    if cache is not None:
        cached = cache.select("class_name", *LABEL_COLS).join(
            req.select("class_name"), "class_name", "left_semi")
        parts.append(cached)
        misses = cache_misses(req, cache)
    else:
        misses = req
    todo = unique_requests(misses, order_col).filter(is_labelable("class_doc"))
    if labeller is not None:
        parts.append(parse_responses(run_labeller(todo, labeller, concurrency, max_doc_chars)))
    elif responses is not None:
        parts.append(parse_responses(responses.join(todo.select("class_name"), "class_name", "left_semi")))
    if not parts:
        return requests.sparkSession.createDataFrame([], LABEL)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
