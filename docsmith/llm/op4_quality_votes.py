"""Quality rules by weak supervision: rules vote or abstain, expectation
maximisation estimates how far each rule can be trusted, and the posterior
probability of good quality replaces all-must-pass filtering.

DataFrame and SQL functions only.  Features and votes are computed inside each
document's own row, with no shuffle of texts.  The EM never sees documents: it
runs over the counts of distinct vote patterns, at most 3 ** len(RULES) rows
whatever the input (partial aggregation first), and each round is one
aggregation of that table to a single row of parameters.

Defined results: a null text counts as empty (no words, base_failed, not kept);
repeated rows and repeated ids are judged row by row; an empty table gives an
empty result; other columns pass
``keep_good`` untouched whatever their names.  Texts of any
length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.llm.common import let
from docsmith.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW_WORDS = 3
PLAIN_WORD = r"^\p{L}+[.,;:!?]?$"

#: Frequent function words of the languages the corpus is expected in.
STOP_WORDS = (
    "a and are as at be by for from he in is it not of on or that the this to was with "
    "das dem den der des die ein eine ist mit nicht und von zu "
    "au de des du elle en est et la le les pas pour que qui sur un une "
    "al con del el en es la las los no por que se su un una y"
)

#: Name -> (condition of a vote for good, condition of a vote for bad); the
#: rule abstains if neither holds.  Over the columns of ``text_features``.
#: Thresholds are whole-number comparisons so that every engine agrees.
RULES = {
    "length": ("n_words >= 100", "n_words < 50"),
    "symbols": ("100 * n_symbols <= n_words AND n_words >= 20", "10 * n_symbols > n_words"),
    "plain_words": ("10 * n_plain_words >= 8 * n_words AND n_words >= 20", "2 * n_plain_words < n_words"),
    "stop_words": ("100 * n_stop_words >= 3 * n_words AND n_words >= 20", "n_stop_words = 0 AND n_words >= 50"),
    "dup_lines": ("n_dup_lines = 0 AND n_lines >= 3", "10 * n_dup_lines > 3 * n_lines"),
    "repeats": ("10 * n_repeat_words <= n_words AND n_words >= 20", "10 * n_repeat_words > 3 * n_words"),
    "shouting": ("20 * n_upper <= word_chars AND n_words >= 20", "4 * n_upper > word_chars"),
}
#: Beliefs before any vote is seen: how often a rule's vote is right on good
#: and on bad documents, the share of good documents, and the number of votes
#: that these beliefs count for.  Rules seldom fire on good documents, and a
#: bad document shows some kinds of faults, not all.
PRIOR_RIGHT = {1: 0.98, 0: 0.4}
PRIOR_GOOD, PRIOR_VOTES = 0.8, 20.0
ROUNDS = 20
KEEP_AT = 0.5


def text_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules read, as long columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    gap = F.lit(WINDOW_WORDS - 1)

    def repeated_words(w):
        """Words inside a window whose hash occurs twice: windows sorted by
        hash bring equal ones together, in O(n log n) for a text of any size."""
        windows = F.filter(
            F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))),
            lambda s: s["i"] < F.size(w) - gap)
        again = let(F.sort_array(windows), lambda s: F.filter(
            s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])))
        covered = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(covered))

    counts = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.size(F.filter(w, lambda x: x.rlike(PLAIN_WORD))).cast("long").alias("n_plain_words"),
        F.size(F.filter(w, lambda x: x.isin(*sorted(set(STOP_WORDS.split()))))).cast("long").alias("n_stop_words"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
    ))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    added = docs.withColumns({
        "_counts": counts, "_lines": line_counts,
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).cast("long"),
    })
    names = ["n_words", "n_plain_words", "n_stop_words", "n_repeat_words"]
    return added.withColumns({n: F.col(f"_counts.{n}") for n in names} | {n: F.col(f"_lines.{n}") for n in ("n_lines", "n_dup_lines")}).drop("_counts", "_lines")


def base_failed_sql() -> str:
    return f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"


def vote_sql(rule: str) -> str:
    good, bad = RULES[rule]
    return f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END"


def posterior_sql(p: dict[str, str]) -> str:
    """Probability of good quality given the votes v_<rule>; ``p`` maps
    parameter names (good; a1_<rule>, a0_<rule>: accuracy of the rule's votes
    on good and on bad documents) to SQL."""
    likely = lambda good: " * ".join(
        [p["good"] if good else f"(1 - {p['good']})"]
        + [f"(CASE v_{r} WHEN {good} THEN {p[f'a{good}_{r}']} WHEN {1 - good} THEN 1 - {p[f'a{good}_{r}']} ELSE 1 END)" for r in RULES])
    one, zero = likely(1), likely(0)
    return f"(({one}) / (({one}) + ({zero})))"


def step_sql(number: str) -> dict[str, str]:
    """Aggregates over patterns with counts ``n`` and posterior ``g`` that give
    the next parameters; ``number`` formats a constant ({} is its value)."""
    c = number.format
    votes = c(PRIOR_VOTES)
    out = {"good": f"(coalesce(sum(n * g), {c(0.0)}) + {c(PRIOR_GOOD * PRIOR_VOTES)}) / (coalesce(sum(n), 0) + {votes})"}
    for r in RULES:
        for cls, share in ((1, "g"), (0, f"({c(1.0)} - g)")):
            hit = f"coalesce(sum(CASE WHEN v_{r} = {cls} THEN n * {share} END), {c(0.0)})"
            any_ = f"coalesce(sum(CASE WHEN v_{r} IS NOT NULL THEN n * {share} END), {c(0.0)})"
            out[f"a{cls}_{r}"] = f"({hit} + {c(PRIOR_RIGHT[cls] * PRIOR_VOTES)}) / ({any_} + {votes})"
    return out


def start_parameters() -> dict[str, float]:
    return {"good": PRIOR_GOOD} | {f"a{c}_{r}": PRIOR_RIGHT[c] for r in RULES for c in (1, 0)}


def fit_votes(votes: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """EM over the columns v_<rule> (1, 0 or null) of ``votes``."""
    patterns = materialize(votes.groupBy(*[f"v_{r}" for r in RULES]).agg(F.count("*").alias("n")).coalesce(1), "votes")
    params = start_parameters()
    for _ in range(rounds):
        g = posterior_sql({k: f"{v!r}D" for k, v in params.items()})
        step = step_sql("{!r}D")
        row = patterns.withColumn("g", F.expr(g)).agg(*[F.expr(sql).alias(k) for k, sql in step.items()]).first()
        params = row.asDict()
    return params


def with_votes(features: DataFrame) -> DataFrame:
    return features.withColumn("base_failed", F.expr(base_failed_sql())).withColumns({f"v_{r}": F.expr(vote_sql(r)) for r in RULES})


def with_verdict(voted: DataFrame, params: dict[str, float], keep_at: float = KEEP_AT) -> DataFrame:
    quality = F.expr(posterior_sql({k: f"{v!r}D" for k, v in params.items()}))
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))


def quality_votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, keep_at: float = KEEP_AT) -> DataFrame:
    """Per row: the id, the features, base_failed, the votes v_<rule>,
    ``quality`` (posterior) and ``kept``.  The features are written to the
    shared folder first, so that texts are read once."""
    features = text_features(docs.select(F.col(id_col), F.col(text_col).alias("text"))).drop("text")
    voted = with_votes(materialize(features, "quality-features"))
    return with_verdict(voted, fit_votes(voted, rounds), keep_at)


def keep_good(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.  Texts are
    read twice instead of being joined back: fitting needs only their votes,
    and a join would shuffle every text.  Repeated rows stay repeated."""
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), F.col(text_col).alias("text"))
    params = fit_votes(with_votes(text_features(own.select("text"))), rounds)
    kept = with_verdict(with_votes(text_features(own)), params, keep_at).filter("kept")
    return kept.select("_doc.*")
