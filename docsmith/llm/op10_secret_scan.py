"""Secret scans: fixed patterns, plus character Markov models of random strings
and of ordinary identifiers compared by log-likelihood ratio.

DataFrame and SQL functions only.  Each text is searched inside its own row;
only matches leave it, with the length of the text before each, and their
positions are running sums within the document's matches (a window, linear in
the number of matches).  Training counts character transitions of all labelled
samples in the corpus; they are at most 2 * (len(ALPHABET) + 1) ** 2 rows
whatever the input, so the model is a small constant of the scoring expression.

Labelled samples: values of the fixed patterns and generated random strings
are random (1); generated identifiers and the corpus's candidate tokens whose
parts are all letters or all digits are ordinary (0).  Other candidates, among
them any undiscovered secrets, are scored but not trained on.

Defined results: null and empty texts have no spans; repeated rows are scanned
row by row; an empty table gives an empty result; texts of any length are
scanned whole; other columns pass ``redact`` untouched whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import let
from docsmith.session import materialize

#: Fixed patterns in the order in which ties are listed; the value is a group,
#: and a match whose value is shorter than the number given is dropped.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # runs are maximal: the same as runs of any length, then those of 24 and more
}
MARKOV = "markov"
MIN_TOKEN = 16
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
GENERATED_SAMPLES = 2000
#: A token that counts as ordinary: its parts are all letters or all digits.
ORDINARY = r"^(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*$"
#: Parts of generated identifiers.
IDENTIFIER_WORDS = (
    "account address array buffer cache client column config connection container content context count current data default "
    "description directory document element error event field file filter format function global group handler header image index input "
    "instance item label layout length level library list local manager message method model module name number object offset option "
    "output package page parameter parent path pattern position process project property query range record reference request resource "
    "response result sample schema server service session setting source state status stream string system table target template test "
    "text thread time title type update user value variable version view width window"
)
SMOOTHING = 0.5
#: Log odds of a candidate token being random before its characters are seen.
PRIOR_LOG_ODDS = -10.0
MASK = "[SECRET]"
#: Characters of the pieces in which a text is rewritten.
CHUNK = 4096


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """array<struct<kind, i, before, token, value>>: the i-th match, the length
    of the text between the match before it and itself, and its value."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    tokens, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.transform(F.arrays_zip(between.alias("b"), tokens.alias("t"), values.alias("v")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["b"].cast("long").alias("before"), x["t"].alias("token"), x["v"].alias("value")))
    found = F.filter(found, lambda x: x["token"].isNotNull())  # there is one piece more than matches
    none = F.array().cast("array<struct<kind:string,i:int,before:bigint,token:string,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _replaced(text: Column, pattern: str, by) -> Column:
    """``text`` with each match m replaced by ``by(m)``, in one pass."""
    between, tokens = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    glued = F.array_join(F.zip_with(between, tokens, lambda b, m: F.when(m.isNull(), b).otherwise(F.concat(b, by(m)))), "")
    return F.when(text.rlike(pattern), glued).otherwise(text)


def _counts(kind: str, token: Column) -> Column:
    pattern, group, least = PATTERNS[kind]
    return F.length(F.regexp_extract(token, pattern, group)) >= least


def without_base(text: Column, by) -> Column:
    """``text`` with the matches of the fixed patterns replaced."""
    for kind, (pattern, _, _) in PATTERNS.items():
        text = _replaced(text, pattern, lambda m, k=kind: F.when(_counts(k, m), by(m)).otherwise(m))
    return text


def found_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(rid, doc_id, *keep, kind, start, end, value): base spans and candidate
    tokens, and one row with a null kind for a row that has none.  ``rid``
    numbers the rows of ``docs``.  Positions are code points, end exclusive."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep)
    rest = without_base(F.col("text"), lambda m: F.repeat(F.lit("\n"), F.length(m)))  # positions stay
    rows = rows.withColumn("rest", rest)
    found = F.concat(*[_matches(F.col("text"), k, p, g) for k, (p, g, _) in PATTERNS.items()], _matches(F.col("rest"), MARKOV, CANDIDATE, 0))
    each = rows.select("rid", "doc_id", *keep, F.explode_outer(found).alias("m")).select("rid", "doc_id", *keep, "m.*").repartition("rid")
    order = W.partitionBy("rid", "kind").orderBy("i")
    size = F.length("token").cast("long")
    end = F.sum(F.col("before") + size).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    least = F.create_map(*[F.lit(x) for k, (_, _, n) in PATTERNS.items() for x in (k, n)], F.lit(MARKOV), F.lit(MIN_TOKEN))
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - size)
    fails = F.length("value") < least[F.col("kind")]
    kind = F.when(~fails, F.col("kind"))  # a failing match leaves its document's row
    return placed.select("rid", "doc_id", *keep, kind.alias("kind"), "start", "end", "value")


def generated_samples(spark: SparkSession, n: int = GENERATED_SAMPLES) -> DataFrame:
    """(value, label 1): random strings in the usual alphabets, from hashes."""
    bits = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    plain = F.regexp_replace(F.base64(bits), "[+/=]", "")
    forms = F.array(F.base64(bits), plain, F.upper(plain), F.lower(plain), F.lower(F.hex(bits)))
    return spark.range(n).select(F.explode(forms).alias("value"), F.lit(1).alias("label"))


def generated_identifiers(spark: SparkSession, n: int = GENERATED_SAMPLES) -> DataFrame:
    """(value, label 0): words joined as identifiers are, with some numbers."""
    words = F.split(F.lit(IDENTIFIER_WORDS), " ")
    k = len(IDENTIFIER_WORDS.split())
    one, two, three = (F.get(words, F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(k)).cast("int")) for i in range(3))
    number = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(3000)).cast("string")
    forms = F.array(F.concat_ws("_", one, two, three), F.concat(one, F.initcap(two), F.initcap(three)), F.upper(F.concat_ws("_", one, two, number)),
                    F.concat_ws("-", one, two, number), F.concat_ws("/", one, two, three), F.concat(one, two, three))
    return spark.range(n).select(F.explode(forms).alias("value"), F.lit(0).alias("label"))


def labelled_samples(found: DataFrame) -> DataFrame:
    """(value, label): 1 for base spans and generated random strings, 0 for
    ordinary tokens and generated identifiers."""
    spark, base = found.sparkSession, F.col("kind") != MARKOV
    own = found.filter(base | F.col("value").rlike(ORDINARY)).filter("kind IS NOT NULL").select("value", base.cast("int").alias("label"))
    return own.unionByName(generated_samples(spark)).unionByName(generated_identifiers(spark))


def _index(char: Column) -> Column:
    return F.call_function("locate", char, F.lit(ALPHABET))


def fit_markov(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratios of the transitions between characters, row by
    row; index 0 is a character outside the alphabet, and the start."""
    k = len(ALPHABET) + 1
    chars = F.transform(F.split("value", ""), _index)
    steps = samples.select("label", chars.alias("c")).select("label", F.explode(F.transform("c", lambda x, i: F.when(i == 0, x).otherwise(F.get("c", i - 1) * k + x))).alias("step"))
    counts = {(r["label"], r["step"]): r["n"] for r in steps.groupBy("label", "step").agg(F.count("*").alias("n")).collect()}  # at most 2 * k * k rows
    out = [0.0] * (k * k)
    rows = {y: [sum(counts.get((y, a * k + b), 0) for b in range(k)) for a in range(k)] for y in (0, 1)}
    for a in range(k):
        for b in range(k):
            p = [(counts.get((y, a * k + b), 0) + smoothing) / (rows[y][a] + smoothing * k) for y in (0, 1)]
            out[a * k + b] = round(math.log(p[1] / p[0]), 6)
    return out


def log_odds(token: Column, model: list[float], prior: float = PRIOR_LOG_ODDS) -> Column:
    """Log odds of a token being a random string."""
    k = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # folded to one constant
    first = F.struct(F.lit(prior).alias("odds"), F.lit(0).alias("at"))
    step = lambda s, c: F.struct((s["odds"] + F.get(table, s["at"] * k + _index(c))).alias("odds"), _index(c).alias("at"))
    return F.aggregate(F.split(token, ""), first, step, lambda s: s["odds"])


def _is_secret(model: list[float]) -> Column:
    return F.when(F.col("kind") == MARKOV, log_odds(F.col("value"), model) > 0).otherwise(F.col("kind").isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_<kind>, base_sha256, spans, n_markov."""
    found = materialize(found_tokens(docs, id_col, text_col), "secret-tokens")
    model = fit_markov(labelled_samples(found))
    secret = _is_secret(model)
    ranks = F.create_map(*[F.lit(x) for i, k in enumerate([*PATTERNS, MARKOV]) for x in (k, i)])
    span = F.struct("start", ranks[F.col("kind")].alias("rank"), "kind", "end")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in PATTERNS]
    per = (found.withColumn("secret", secret).withColumn("kind", F.when(F.col("secret"), F.col("kind")))
           .groupBy("rid", "doc_id").agg(*kinds, F.count_if(F.col("kind") == MARKOV).alias("n_markov"), F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), span))).alias("all")))
    base = F.filter("all", lambda s: s["kind"] != MARKOV)
    return per.select("doc_id", *[f"n_{k}" for k in PATTERNS], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("all")).alias("spans"), "n_markov")


def united_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, spans): the union of (start, end) of each key, as sorted spans
    without overlap.  Spans that touch stay two."""
    order = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = spans.select(*keys, "start", "end").distinct().withColumn("fresh", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    islands = fresh.withColumn("island", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    joined = islands.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _part(chunks: Column, first: Column, last: Column) -> Column:
    """Characters ``first`` to ``last`` of a text in chunks of CHUNK each, so that
    a cut costs a chunk, not the text before it."""
    i, j = F.floor(first / CHUNK).cast("int"), F.floor(last / CHUNK).cast("int")
    chunk = lambda k: F.coalesce(F.get(chunks, k), F.lit(""))
    at = (first - i * CHUNK + 1).cast("int")
    within = F.substr(chunk(i), at, (last - first).cast("int"))
    across = F.concat(F.substr(chunk(i), at), F.array_join(F.slice(chunks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), F.substr(chunk(j), F.lit(1), (last - j * CHUNK).cast("int")))
    return F.when(i == j, within).otherwise(across)


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with each of the disjoint, sorted spans replaced by ``mask``."""
    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    none = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    ends = F.struct(F.length(text).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    edges = F.concat(F.array(none), spans, F.array(ends))
    kept = lambda c: F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: _part(c, F.get(edges, i - 1)["end"], F.get(edges, i)["start"]))
    return let(chunks, lambda c: F.array_join(kept(c), mask))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every span that ``scan`` tells replaced by ``mask``, spans
    that overlap by one.  The spans are found once and joined back to the texts
    they are of, by two hashes of the text: copies share them."""
    text = F.col(text_col)
    own = docs.select("*", F.xxhash64(F.lit(1), text).alias("_k1"), F.xxhash64(F.lit(2), text).alias("_k2"))
    found = materialize(found_tokens(own, id_col, text_col, keep=("_k1", "_k2")), "secret-tokens")
    model = fit_markov(labelled_samples(found))
    spans = united_spans(found.filter(_is_secret(model)), ["_k1", "_k2"]).withColumnRenamed("spans", "_spans")
    clean = F.when(F.col("_spans").isNull(), text).otherwise(masked(text, F.col("_spans"), mask))
    return own.join(spans, ["_k1", "_k2"], "left").withColumn(text_col, clean).select(docs.columns)
