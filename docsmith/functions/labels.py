"""Column expressions for label requests and label responses.

A label is ``(synopsis, action_phrase, visibility_score)`` for one class.  The
request side builds a prompt from the class docstring (SCL1, SCL2); the
response side turns the raw text a labeller returned into a typed label
(SCL3-SCL6).  JSON is parsed once into a VARIANT with ``try_parse_json`` and
read with typed ``try_variant_get`` calls, so no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsmith.functions.text import col_, py_strip, truncate_doc
from docsmith.schema import DEFAULT_VISIBILITY, MAX_DOC_CHARS

# Our own prompt wording; the labeller fills in the class and its docstring.
PROMPT_HEAD = (
    "Describe one class of a C++ visualization library for an API catalog.\n"
    "Answer with a JSON object holding three keys:\n"
    '- "synopsis": one sentence of at most twenty words saying what the class does, '
    "not starting with the class name;\n"
    '- "action_phrase": a noun phrase of at most five words naming its main action;\n'
    '- "visibility_score": a number from 0.0 to 1.0, how often users would name the class '
    "(0.9 everyday readers and filters, 0.5 common pipeline parts, 0.1 internal bases).\n\n"
    "Class: "
)
PROMPT_MID = "\n\nDocumentation:\n"
PROMPT_TAIL = "\n\nJSON object only:"

_FENCE = "```"


def prompt(class_name: Column | str, class_doc: Column | str, max_doc_chars: int = MAX_DOC_CHARS) -> Column:
    """SCL2 (+SCL1): the request text.  Built with ``concat`` rather than
    placeholder replacement so a docstring that itself contains a placeholder
    is left alone.  ``max_doc_chars``: the docstring's length limit (SCL1)."""
    return F.concat(
        F.lit(PROMPT_HEAD), col_(class_name), F.lit(PROMPT_MID),
        truncate_doc(col_(class_doc), max_doc_chars), F.lit(PROMPT_TAIL),
    )


def strip_code_fence(content: Column | str) -> Column:
    """SCL3: strip; drop a leading fence with the rest of its line (only the
    three backticks when there is no newline); drop a trailing fence; strip."""
    s = py_strip(col_(content))
    nl = F.instr(s, "\n")
    no_head = F.when(
        s.startswith(_FENCE),
        F.when(nl > 0, F.substr(s, nl + 1)).otherwise(F.substr(s, F.lit(4))),
    ).otherwise(s)
    no_tail = F.when(
        no_head.endswith(_FENCE), F.substring(no_head, 1, F.length(no_head) - 3)
    ).otherwise(no_head)
    return py_strip(no_tail)


def _kind(v: Column) -> Column:
    """Type name of a VARIANT value; SQL null when the key is absent,
    ``VOID`` for a JSON null."""
    return F.schema_of_variant(v)


def _is_number_kind(kind: Column) -> Column:
    return (
        kind.isin("BOOLEAN", "BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
        | kind.startswith("DECIMAL")
    )


def _truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held in a VARIANT."""
    kind = _kind(v)
    as_json = F.to_json(v)
    return (
        F.when(v.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(_is_number_kind(kind), F.try_variant_get(v, "$", "double") != 0)
        .when(kind == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .otherwise(~as_json.isin("[]", "{}"))
    )


def parse_label(df: DataFrame, content: str = "content") -> DataFrame:
    """SCL4-SCL6: add ``is_label, synopsis, action_phrase, visibility_score,
    has_synopsis, has_action`` parsed from the raw labeller text in
    ``content``.

    * empty text, bad JSON (including text after the value) or a JSON value
      that is not an object: no label;
    * ``synopsis`` present but not a string: no label; a string is stripped,
      its surrounding quote characters removed, and a period added if missing;
    * ``visibility`` wins over ``visibility_score`` when truthy; a number or
      boolean is clamped to [0, 1]; anything else gives 0.3;
    * ``action_phrase`` is copied (absent -> ``""``).

    Built as successive projections so the JSON is parsed once per row and
    each extracted value is computed once (Spark does not merge projections
    that would duplicate a non-trivial expression).
    """
    raw = F.col(content)
    # the whole body must be exactly one JSON value: parsed inside brackets,
    # text after the value makes the array invalid or longer than one
    wrapped = F.try_parse_json(F.concat(F.lit("["), strip_code_fence(raw), F.lit("]")))
    j = df.withColumn("_w", wrapped).withColumn(
        "_j", F.when(F.try_variant_get("_w", "$[1]", "variant").isNull(),
                     F.try_variant_get("_w", "$[0]", "variant"))).drop("_w")
    v = j.select(
        "*",
        F.try_variant_get("_j", "$.synopsis", "variant").alias("_syn"),
        F.try_variant_get("_j", "$.visibility", "variant").alias("_vis"),
        F.try_variant_get("_j", "$.visibility_score", "variant").alias("_vsc"),
        F.try_variant_get("_j", "$.action_phrase", "variant").alias("_act"),
        F.coalesce(_kind(F.col("_j")).startswith("OBJECT"), F.lit(False)).alias("_obj"),
    )
    k = v.select(
        "*",
        _kind(F.col("_syn")).alias("_syn_k"),
        _kind(F.col("_act")).alias("_act_k"),
        F.when(_truthy(F.col("_vis")), F.col("_vis")).otherwise(F.col("_vsc")).alias("_ch"),
        F.regexp_replace(py_strip(F.try_variant_get("_syn", "$", "string")), r"""\A["']+|["']+\z""", "")
        .alias("_syn_c"),
    )
    is_label = raw.isNotNull() & (raw != "") & F.col("_j").isNotNull() & F.col("_obj") & (
        F.col("_syn").isNull() | (F.col("_syn_k") == "STRING"))
    syn_c = F.col("_syn_c")
    synopsis = (
        F.when(F.col("_syn").isNull(), F.lit(None).cast("string"))
        .when((syn_c != "") & ~syn_c.endswith("."), F.concat(syn_c, F.lit(".")))
        .otherwise(syn_c)
    )
    ch = F.col("_ch")
    score = F.when(
        ch.isNotNull() & _is_number_kind(_kind(ch)),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_variant_get(ch, "$", "double"))),
    ).otherwise(F.lit(DEFAULT_VISIBILITY))
    act, act_k = F.col("_act"), F.col("_act_k")
    action = (
        F.when(act.isNull() | (act_k == "VOID"), F.lit(None).cast("string"))
        .when(act_k == "STRING", F.try_variant_get(act, "$", "string"))
        .otherwise(F.to_json(act))
    )
    out = k.withColumn("is_label", is_label)
    lab = F.col("is_label")
    return out.select(
        *df.columns,
        "is_label",
        F.when(lab, synopsis).alias("synopsis"),
        F.when(lab, action).alias("action_phrase"),
        F.when(lab, score).alias("visibility_score"),
        F.when(lab, F.col("_syn").isNotNull()).alias("has_synopsis"),
        F.when(lab, act.isNotNull()).alias("has_action"),
    )
