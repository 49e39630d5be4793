"""The query of each operator over its whole table, and DuckDB SQL where SQL
can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsmith.llm import op1_license_scan as license_scan
from docsmith.llm import op2_mixing as mixing
from docsmith.llm import op3_syncmers as syncmers
from docsmith.llm import op4_quality_votes as votes
from docsmith.llm import op5_preferences as preferences
from docsmith.llm import op6_toxicity_ssk as toxicity
from docsmith.llm import op7_simhash_trie as simhash
from docsmith.llm import op8_packing as packing
from docsmith.llm import op9_ordinal_quality as ordinal
from docsmith.llm import op10_secret_scan as secrets
from docsmith.llm import op11_decontamination as decontamination
from docsmith.llm import op12_alignment as alignment
from docsmith.llm import op13_lexical_search as lexical
from docsmith.llm.common import table

FOLDS = 5
#: Rounds of the SQL after which no more values are whole (the operator goes on until it is so).
WHOLE_ROUNDS = 10


def _held_out(doc_id):
    """A null id, which is never trained on, counts as held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def op1_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark, sf_dir):
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.withColumns({"ratio": F.round("ratio", 6), "p": F.round("p", 6)})


def op3_syncmer_fingerprints(spark, sf_dir):
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_quality_votes(spark, sf_dir):
    rows = votes.quality_votes(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op5_preference_format(spark, sf_dir):
    return preferences.format_preferences(preferences.pairs_by_neighbour(table(spark, sf_dir, "conversations")))


def op6_toxicity_ssk(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~_held_out(F.col("doc_id"))))
    rows = toxicity.score(docs, model)
    return rows.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_simhash_trie(spark, sf_dir):
    rows = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_ordinal_quality(spark, sf_dir):
    """Grades 0 to 3 from the labels: 2 for quality, 1 for not being toxic.
    Rows whose id falls into the first fold are not trained on."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = (2 * F.col("quality") - F.col("toxic") + 1).cast("int").alias("grade")
    ratings = labels.filter(~_held_out(F.col("doc_id"))).select("doc_id", grade)
    rows = ordinal.ordinal_quality(docs, ratings, grades=4, keep_grade=2)
    return rows.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail", "kept")


def op10_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_decontamination(spark, sf_dir):
    rows = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_token_alignment(spark, sf_dir):
    rows = alignment.alignment(table(spark, sf_dir, "documents"), digest=True)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_source_mixing, op3_syncmer_fingerprints, op4_quality_votes, op5_preference_format,
    op6_toxicity_ssk, op7_simhash_trie, op8_best_fit_packing, op9_ordinal_quality, op10_secret_scan, op11_decontamination, op12_token_alignment, op13_lexical_search)}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _op2_sql() -> str:
    topic = "CASE WHEN coalesce(length(text), 0) = 0 THEN 'none' " + " ".join(
        f"WHEN regexp_matches(text, {_text(p)}) THEN {_text(n)}" for n, p in mixing.TOPICS.items())
    topic += f" WHEN length(text) > {mixing.LONG_CHARS} THEN 'long prose' ELSE 'short prose' END"
    dims = list(mixing.DIMENSIONS)
    parts = [
        f"r AS MATERIALIZED (SELECT doc_id, source, lang, {topic} AS topic, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents)",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM r GROUP BY ALL)",
    ]
    want = f"({mixing.BUDGET} * (SELECT sum(tokens) FROM cells))"
    for d, power in mixing.FLATTEN.items():
        parts.append(f"v_{d} AS MATERIALIZED (SELECT {d} AS v, sum(tokens) AS tokens, pow(sum(tokens), {power}) / (SELECT sum(t) FROM (SELECT pow(sum(tokens), {power}) AS t FROM cells GROUP BY {d})) AS share FROM cells GROUP BY {d})")
        parts.append(f"s_{d}0 AS MATERIALIZED (SELECT {want} AS scale)")
        for k in range(WHOLE_ROUNDS):
            whole = f"share * (SELECT scale FROM s_{d}{k}) >= tokens"
            parts.append(f"s_{d}{k + 1} AS MATERIALIZED (SELECT CASE WHEN b > 0 THEN greatest(0, {want} - coalesce(a, 0)) / b ELSE (SELECT scale FROM s_{d}{k}) END AS scale FROM "
                         f"(SELECT sum(CASE WHEN {whole} THEN tokens END) AS a, sum(CASE WHEN NOT ({whole}) THEN share END) AS b FROM v_{d}))")
        parts.append(f"w_{d} AS MATERIALIZED (SELECT v, least(tokens, share * (SELECT scale FROM s_{d}{WHOLE_ROUNDS})) AS wanted FROM v_{d})")
    wants = ", ".join(f"w_{d}.wanted AS want_{d}" for d in dims)
    joins = " ".join(f"JOIN w_{d} ON cells.{d} IS NOT DISTINCT FROM w_{d}.v" for d in dims)
    parts.append(f"x AS MATERIALIZED (SELECT cells.*, 1::DOUBLE AS weight, {wants} FROM cells {joins})")
    last = "x"
    for k in range(mixing.ROUNDS):
        for d in dims:
            full = f"weight > {mixing.FULL!r}"
            sums = (f"SELECT *, sum(CASE WHEN {full} THEN tokens ELSE 0 END) OVER (PARTITION BY {d}) AS f, "
                    f"sum(CASE WHEN {full} THEN 0 ELSE tokens * weight END) OVER (PARTITION BY {d}) AS part FROM {last}")
            step = f"CASE WHEN part > 0 AND want_{d} > f THEN (want_{d} - f) / part WHEN want_{d} <= f AND f + part > 0 THEN want_{d} / (f + part) ELSE 1 END"
            parts.append(f"x{k}_{d} AS MATERIALIZED (SELECT * EXCLUDE (f, part) REPLACE (least({mixing.MOST!r}::DOUBLE, greatest({mixing.LEAST!r}::DOUBLE, weight * {step})) AS weight) FROM ({sums}))")
            last = f"x{k}_{d}"
    parts.append("c0 AS MATERIALIZED (SELECT 1::DOUBLE AS c)")
    for k in range(mixing.CAP_ROUNDS):
        full, rest = f"least(1, weight) * (SELECT c FROM c{k}) > {mixing.FULL!r}", f"({want} - coalesce(a, 0))"
        parts.append(f"c{k + 1} AS MATERIALIZED (SELECT CASE WHEN coalesce(b, 0) = 0 OR {rest} <= 0 THEN (SELECT c FROM c{k}) ELSE {rest} / b END AS c FROM "
                     f"(SELECT sum(CASE WHEN {full} THEN tokens END) AS a, sum(CASE WHEN NOT ({full}) THEN tokens * least(1, weight) END) AS b FROM {last}))")
    parts.append(f"k AS MATERIALIZED (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE least(1, least(1, weight) * (SELECT c FROM c{mixing.CAP_ROUNDS})) END AS p FROM {last})")
    same = " AND ".join(f"r.{d} IS NOT DISTINCT FROM k.{d}" for d in dims)
    draw = f"('0x' || substr(md5({_text(mixing.SEED + ':')} || coalesce(r.doc_id::VARCHAR, '')), 1, 12))::BIGINT / {1 << 48}.0"
    return "WITH " + ",\n".join(parts) + f"\nSELECT r.doc_id, r.source, r.lang, r.topic, r.tokens::BIGINT AS tokens, round((p / {mixing.BUDGET})::DOUBLE, 6) AS ratio, round(p::DOUBLE, 6) AS p, {draw} < p AS sampled FROM r LEFT JOIN k ON {same}"


def _op4_sql() -> str:
    space = r"[\x20\x09-\x0D]"
    stop = ", ".join(_text(w) for w in sorted(set(votes.STOP_WORDS.split())))
    rules = ", ".join(f"{votes.vote_sql(r)} AS v_{r}" for r in votes.RULES)
    patterns = ", ".join(f"v_{r}" for r in votes.RULES)
    names = list(votes.start_parameters())
    parts = [
        f"t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS w, "
        f"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents)",
        "g AS (SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: {'i': i, 'x': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]})) AS s FROM t)",
        "again AS (SELECT r, s.i AS i FROM (SELECT r, s, count(*) OVER (PARTITION BY r, s.x) AS n FROM g) WHERE n > 1)",
        "rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS d(k) GROUP BY r)",
        f"f AS MATERIALIZED (SELECT doc_id, len(w)::BIGINT AS n_words, len(list_filter(w, lambda x: regexp_matches(x, {_text(votes.PLAIN_WORD)})))::BIGINT AS n_plain_words, "
        f"len(list_filter(w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, "
        f"(len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, length(regexp_replace(text, '{space}+', '', 'g'))::BIGINT AS word_chars, "
        "(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_upper "
        "FROM t LEFT JOIN rep USING (r))",
        f"v AS MATERIALIZED (SELECT *, {votes.base_failed_sql()} AS base_failed, {rules} FROM f)",
        f"pat AS MATERIALIZED (SELECT {patterns}, count(*) AS n FROM v GROUP BY ALL)",
        "p0 AS MATERIALIZED (SELECT " + ", ".join(f"{x!r}::DOUBLE AS {k}" for k, x in votes.start_parameters().items()) + ")",
    ]
    posterior = votes.posterior_sql({k: f"p.{k}" for k in names})
    step = ", ".join(f"{sql} AS {k}" for k, sql in votes.step_sql("{!r}::DOUBLE").items())
    parts += [f"p{k + 1} AS MATERIALIZED (SELECT {step} FROM (SELECT pat.*, {posterior} AS g FROM pat, p{k} AS p))" for k in range(votes.ROUNDS)]
    return ("WITH " + ",\n".join(parts) + "\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
            f"(NOT base_failed AND q >= {votes.KEEP_AT}) AS kept, round(q, 6) AS quality FROM (SELECT v.*, {posterior} AS q FROM v, p{votes.ROUNDS} AS p)")


def _op5_sql() -> str:
    start, end = _text(preferences.START), f"{_text(preferences.END.strip())} || chr(10)"
    render = f"{start} || t.role || chr(10) || t.text || {end}"
    size = f"{len(preferences.START) + 1 + len(preferences.END)} + length(t.role) + length(t.text)"

    def text(x: str) -> str:
        return f"coalesce(array_to_string(list_transform({x}, lambda t: {render}), ''), '')"

    def mask(x: str) -> str:
        at = f"coalesce(list_sum(list_transform({x}[1:i - 1], lambda t: {size})), 0)::BIGINT"
        first = f"({at} + {len(preferences.START) + 1} + length({x}[i].role))"
        spans = f"list_transform(list_filter(range(1, len({x}) + 1), lambda i: {x}[i].role = 'assistant'), lambda i: {first}::VARCHAR || ':' || ({first} + length({x}[i].text) + {len(preferences.END)})::VARCHAR)"
        return f"coalesce(array_to_string({spans}, ','), '')"

    return f"""WITH own AS (SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, max(turn) AS last FROM own GROUP BY 1),
m AS (SELECT * FROM own JOIN last USING (pair_id)),
pairs AS (
 SELECT pair_id, 'chosen' AS side, turn, role, text FROM m
 UNION ALL SELECT pair_id, 'rejected', turn, role, text FROM m WHERE turn IS NULL OR turn < last
 UNION ALL SELECT last.pair_id, 'rejected', last.last, m.role, m.text FROM m JOIN last ON xor(m.pair_id, 1) = last.pair_id WHERE m.turn = m.last),
sides AS (SELECT pair_id, side, list_sort(list_distinct(list({{'numbered': turn IS NOT NULL, 'turn': turn, 'role': role, 'text': text}}))) AS turns FROM pairs GROUP BY ALL),
j AS (SELECT pair_id, coalesce(max(turns) FILTER (side = 'chosen'), []) AS c, coalesce(max(turns) FILTER (side = 'rejected'), []) AS r FROM sides GROUP BY 1),
d AS (SELECT *, list_position(list_transform(range(1, greatest(len(c), len(r)) + 1), lambda i: coalesce(c[i].role = r[i].role AND c[i].text = r[i].text, false)), false) AS differs FROM j),
n AS (SELECT *, CASE WHEN len(c) = 0 OR len(r) = 0 THEN greatest(len(c), len(r)) WHEN differs > 0 THEN differs - 1 ELSE len(c) END AS n FROM d),
s AS (SELECT pair_id, n, CASE WHEN len(c) > 0 THEN c[1:n] ELSE r[1:n] END AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM n)
SELECT pair_id, n::BIGINT AS n_prompt_turns, {text('p')} AS prompt, {text('c')} AS chosen, {mask('c')} AS chosen_mask,
 {text('r')} AS rejected, {mask('r')} AS rejected_mask, len(c) = 0 AND len(r) = 0 AS degenerate FROM s"""


PLAIN_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


def _op11_sql() -> str:
    words = PLAIN_WORDS
    size = decontamination.WINDOW
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
b AS MATERIALIZED (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark),
pat AS MATERIALIZED (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM (SELECT item, w, least(len(w), {size}) AS k, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM pat),
g AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS x FROM (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS MATERIALIZED (SELECT r, k, i, item FROM g JOIN pat USING (k, x)),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, list_sort(list_distinct(list(item))) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def _op13_sql() -> str:
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS w FROM documents),
i AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, {PLAIN_WORDS} AS w FROM benchmark),
total AS MATERIALIZED (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM df, total),
m AS MATERIALIZED (SELECT r, doc_id, (75 + (25 * len(w) * n_docs) // n_terms)::BIGINT AS m FROM d, total),
q AS (SELECT q, item_id, term, count(*) AS repeats FROM (SELECT q, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
s AS (SELECT q, item_id, r, doc_id, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= {lexical.TOP}"""


ORACLE = {"op2_source_mixing": _op2_sql(), "op4_quality_votes": _op4_sql(), "op5_preference_format": _op5_sql(), "op11_decontamination": _op11_sql(), "op13_lexical_search": _op13_sql()}
