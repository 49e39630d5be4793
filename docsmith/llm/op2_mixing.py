"""Mixing sources to target weights by iterative proportional fitting.

Token totals of the (source, language, topic) cells are raked until their
marginals meet the targets; documents are then sampled with the calibrated
probability of their cell.

The sample's expected size is a budget, a share of all tokens.  Targets that ask
a value for more tokens than it has cannot be met at that size: such a value
counts as reached when it is taken whole, and the others share what it lacks in
proportion to their targets (``reachable``).  Raking holds a cell's probability
at 1 inside the loop: a step scales the cells of a value that are below 1, so
that they and the full ones together make up its tokens.  Where the reachable
targets of different dimensions contradict each other, raking comes as near as
it does in ``rounds``; the budget is kept in any case (``calibrate``), and
``shares`` tells target, reachable and expected share of each value.

Documents are aggregated to cells once (map-side first, so a source with a
third of all rows is one partial row per task) and read once more to sample
them, with no shuffle of texts.  Up to ``FEW_CELLS`` cells are raked on the driver
(``few_probabilities``), which spares it thirty jobs' plans; more are raked by Spark
(``rake``): a round is one job over the cells, for each dimension in turn the
sums of its values, joined back to the cells, its result written to the shared
folder.  Both take the same steps.  Sums add the cells' doubles, in whatever order.

Defined results: null source, language or topic is a value of its own; a null
or empty text has no tokens and is sampled with its cell's probability; a cell
without tokens has probability 1; repeated rows share a draw, because the draw
is a hash of the id; a null id draws as an empty string would; an empty table
gives an empty result; extra columns pass ``sample_mix`` untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from docsmith.session import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: proportional to its tokens to this power, which
#: lifts small sources, languages and topics (1: as they are, 0: all alike).
FLATTEN = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Expected share of all tokens that the sample has.
BUDGET = 0.8
ROUNDS = 30
CAP_ROUNDS = 8
SEED = "mix-1"
#: A cell is full if its weight is above 1 by this; one that a step has put at 1 is not.
FULL = 1 + 1e-9
#: So many cells, one row each, are raked on the driver.
FEW_CELLS = 100_000
#: Weights stay within these, where targets contradict each other.
LEAST, MOST = 1e-9, 1e9

#: Topic -> pattern; the first that a text contains.  Else by size.
TOPICS = {
    "legal": r"(?i)licen[sc]e|copyright|all rights reserved",
    "contact": r"[\w.]@\w+\.\w",
    "table": r" \| ",
    "markup": r"[#*$%&<>]{2}",
}
LONG_CHARS = 2000


def topic_of(text: Column) -> Column:
    """A coarse topic of a text by its form."""
    out = F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit("none"))
    for name, pattern in TOPICS.items():
        out = out.when(text.rlike(pattern), F.lit(name))
    return out.when(F.length(text) > LONG_CHARS, F.lit("long prose")).otherwise(F.lit("short prose"))


def tokens_of(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")).cast("long")


def flattened_targets(cells: DataFrame, powers: dict[str, float] = FLATTEN) -> dict[str, DataFrame]:
    """Dimension -> (value, share): shares of tokens ** power."""
    out = {}
    for dim, power in powers.items():
        by = cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("t"))
        total = by.agg(F.sum("t")).first()[0]
        out[dim] = by.select(F.col(dim), (F.col("t") / float(total) if total else F.lit(0.0)).alias("share"))
    return out


def _flattened(cells: list[Row], dim: str, power: float) -> dict:
    sums: dict = {}
    for r in cells:
        sums[r[dim]] = sums.get(r[dim], 0) + r["tokens"]
    total = sum(t**power for t in sums.values())
    return {v: t**power / total if total else 0.0 for v, t in sums.items()}


def reachable(cells: DataFrame, dim: str, targets: DataFrame, want: float) -> DataFrame:
    """(value, tokens, share, wanted): of ``want`` tokens, those that each value
    is to give: its share of them, but no more than it has; what such values lack
    the others give in proportion.  A target of a value without a cell is left
    out; a value without a target gives nothing."""
    by = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens")).alias("b")
    same = F.col(f"b.{dim}").eqNullSafe(F.col(f"t.{dim}"))
    values = materialize(by.join(targets.alias("t"), same, "left").select(f"b.{dim}", F.col("tokens").cast("double").alias("tokens"), F.coalesce("share", F.lit(0.0)).alias("share")), f"targets-{dim}")
    scale = before = want
    while True:  # each time, more values are whole
        whole = F.col("share") * scale >= F.col("tokens")
        row = values.agg(F.sum(F.when(whole, F.col("tokens"))), F.sum(F.when(~whole, F.col("share")))).first()
        if not row[1]:
            break
        before, scale = scale, max(0.0, want - (row[0] or 0.0)) / row[1]
        if scale <= before * (1 + 1e-12):
            break
    return values.withColumn("wanted", F.least("tokens", F.col("share") * scale))


def rake(cells: DataFrame, targets: dict[str, DataFrame], want: float, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``weight``: the tokens times
    least(1, weight) have the marginals that ``reachable`` gives for ``targets``
    (dimension -> (value, share)) and ``want`` tokens."""
    out = cells.withColumn("weight", F.lit(1.0))
    for d, share in targets.items():
        wanted = reachable(cells, d, share, want).select(F.col(d).alias("_v"), F.col("wanted").alias(f"want_{d}"))
        out = out.join(wanted, F.col(d).eqNullSafe(F.col("_v"))).drop("_v")
    out = materialize(out, "raked")
    weight, tokens = F.col("weight"), F.col("tokens")
    full = weight > FULL
    for _ in range(rounds):
        for d in targets:
            sums = out.groupBy(F.col(d).alias("_v")).agg(F.sum(F.when(full, tokens).otherwise(0.0)).alias("_full"), F.sum(F.when(full, 0.0).otherwise(tokens * weight)).alias("_part"))
            wanted = F.col(f"want_{d}")
            more = (F.col("_part") > 0) & (wanted > F.col("_full"))
            step = F.when(more, (wanted - F.col("_full")) / F.col("_part")).when((wanted <= F.col("_full")) & (F.col("_full") + F.col("_part") > 0), wanted / (F.col("_full") + F.col("_part"))).otherwise(1.0)
            out = out.join(sums, F.col(d).eqNullSafe(F.col("_v"))).withColumn("weight", F.least(F.lit(MOST), F.greatest(F.lit(LEAST), weight * step))).drop("_v", "_full", "_part")
        out = materialize(out, "raked")
    return out.select(*cells.columns, "weight")


def calibrate(cells: DataFrame, want: float, rounds: int = CAP_ROUNDS) -> DataFrame:
    """``cells`` with ``p`` = least(1, c * least(1, weight)), c such that the
    expected tokens are ``want``; cells at 1 give what they lack to the rest."""
    own, c = F.least(F.lit(1.0), F.col("weight")), 1.0
    for _ in range(rounds):
        full = own * c > FULL
        row = cells.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("tokens") * own))).first()
        rest = want - float(row[0] or 0)
        if not row[1] or rest <= 0:
            break
        c = rest / row[1]
    return cells.withColumn("p", F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(F.lit(1.0), own * c)))


def few_probabilities(cells: list[Row], shares: dict[str, dict], want: float, rounds: int = ROUNDS) -> np.ndarray:
    """p of each of few cells (dimensions, tokens): the steps of ``reachable``,
    ``rake`` and ``calibrate`` in memory.  ``shares``: dimension -> value -> share."""
    tokens = np.array([r["tokens"] for r in cells], float)
    sides = []
    for d, share in shares.items():
        at = {v: i for i, v in enumerate(dict.fromkeys(r[d] for r in cells))}
        value = np.array([at[r[d]] for r in cells], np.int64)
        own, wants = np.bincount(value, tokens, len(at)), np.array([share.get(v, 0.0) for v in at])
        scale = before = want
        while (some := ~(whole := wants * scale >= own)).any() and wants[some].sum() > 0:
            before, scale = scale, max(0.0, want - own[whole].sum()) / wants[some].sum()
            if scale <= before * (1 + 1e-12):
                break
        sides.append((value, np.minimum(own, wants * scale)))
    weight = np.ones(len(cells))
    for _ in range(rounds):
        for value, wanted in sides:
            full = weight > FULL
            whole, part = (np.bincount(value, x, len(wanted)) for x in (np.where(full, tokens, 0), np.where(full, 0, tokens * weight)))
            step = np.ones(len(wanted))
            more, less = (part > 0) & (wanted > whole), (wanted <= whole) & (whole + part > 0)
            step[more] = (wanted[more] - whole[more]) / part[more]
            step[less] = wanted[less] / (whole[less] + part[less])
            weight = np.clip(weight * step[value], LEAST, MOST)
    own, c = np.minimum(1.0, weight), 1.0
    for _ in range(CAP_ROUNDS):
        full = own * c > FULL
        rest, part = want - tokens[full].sum(), (tokens * own)[~full].sum()
        if not part or rest <= 0:
            break
        c = rest / part
    return np.where(tokens == 0, 1.0, np.minimum(1.0, own * c))


def draw(id_col: Column, seed: str = SEED) -> Column:
    """A uniform number in [0, 1) that depends on the id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def mix_probabilities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: float = BUDGET,
                      powers: dict[str, float] = FLATTEN, targets: dict[str, DataFrame] | None = None, few: int = FEW_CELLS) -> tuple[DataFrame, DataFrame]:
    """(rows, cells): rows has (doc_id, source, lang, topic, tokens) of each
    row of ``docs``; cells has (source, lang, topic, tokens, ratio, p), ``ratio``
    being the factor by which a cell's share of tokens grows."""
    spark, text = docs.sparkSession, F.col(text_col)
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), "source", "lang", topic_of(text).alias("topic"), tokens_of(text).alias("tokens")), "mix-rows")
    cells = materialize(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    held = cells.limit(few + 1).collect()
    if len(held) <= few:
        total = sum(r["tokens"] for r in held)
        given = {d: {r[d]: r["share"] for r in t.join(cells.select(d).distinct(), d, "left_semi").collect()} for d, t in (targets or {}).items()}
        p = few_probabilities(held, given or {d: _flattened(held, d, power) for d, power in powers.items()}, budget * total) if held else []
        found = spark.createDataFrame([(*r, float(x)) for r, x in zip(held, p, strict=True)], cells.schema.add("p", "double"))
    else:
        want = budget * float(cells.agg(F.sum("tokens")).first()[0] or 0)
        found = calibrate(rake(cells, targets or flattened_targets(cells, powers), want), want).drop("weight")
    return rows, materialize(found.withColumn("ratio", F.col("p") / budget), "mix-p")


def _with_p(rows: DataFrame, cells: DataFrame) -> DataFrame:
    same = [F.col(f"r.{d}").eqNullSafe(F.col(f"k.{d}")) for d in DIMENSIONS]
    return rows.alias("r").join(cells.select(*DIMENSIONS, "ratio", "p").alias("k"), same, "left")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: float = BUDGET, seed: str = SEED) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, ratio, p, sampled) of each row."""
    rows, cells = mix_probabilities(docs, id_col, text_col, budget)
    return _with_p(rows, cells).select("r.*", "ratio", "p", (draw(F.col("doc_id"), seed) < F.col("p")).alias("sampled"))


def sample_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: float = BUDGET, seed: str = SEED) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns."""
    _, cells = mix_probabilities(docs, id_col, text_col, budget)
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_id"), "source", "lang", topic_of(F.col(text_col)).alias("topic"))
    return _with_p(own, cells).filter(draw(F.col("_id"), seed) < F.col("p")).select("_doc.*")


def shares(cells: DataFrame, budget: float = BUDGET, powers: dict[str, float] = FLATTEN) -> DataFrame:
    """(dimension, value, raw, target, reachable, expected): token shares of each
    value in all documents, in the targets, in as much of them as its tokens allow
    at ``budget``, and in the expected sample of ``cells`` (mix_probabilities)."""
    out = None
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    for d, share in flattened_targets(cells, powers).items():
        wanted = reachable(cells, d, share, budget * total).alias("w")
        by = cells.groupBy(d).agg(F.sum(F.col("tokens") * F.col("p")).alias("s")).alias("b")
        rows = wanted.join(by, F.col(f"w.{d}").eqNullSafe(F.col(f"b.{d}")))
        of = lambda x, n: (x / n if n else F.lit(0.0))
        part = rows.select(F.lit(d).alias("dimension"), F.col(f"w.{d}").cast("string").alias("value"), of(F.col("tokens"), total).alias("raw"), F.col("share").alias("target"),
                           of(F.col("wanted"), budget * total).alias("reachable"), of(F.col("s"), budget * total).alias("expected"))
        out = part if out is None else out.unionByName(part)
    return out
