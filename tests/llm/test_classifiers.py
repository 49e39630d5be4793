"""Scores of the two classifiers against plain Python, and on held-out rows."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsmith.llm import op6_toxicity_ssk as o6
from docsmith.llm import op9_ordinal_quality as o9
from docsmith.llm import queries
from tests.llm.test_operators import TEXTS, brute_kernel, docs, empty  # noqa: F401

LARGE = "/root/testdata/sf0.1"


# 6 -----------------------------------------------------------------------
def plain_score(text, model):
    """The score of one text by loops over its sentences, words and letters."""
    text = re.sub(r"(?<!\S)\S(?:\s\S){2,}(?!\S)", lambda m: re.sub(r"\s", "", m[0]), text or "")
    margins, sentence = [], []
    words = text.lower().split()
    for i, w in enumerate(words):
        sentence.append(w)
        if i + 1 == len(words) or w.rstrip("\"')]")[-1:] in (".", "!", "?") or len(sentence) == o6.SENTENCE_WORDS:
            margins.append(plain_margin(sentence, model))
            sentence = []
    top = max(margins, default=model.bias)
    return 1 / (1 + math.exp(-max(-30, min(30, model.slope * top + model.shift))))


def plain_margin(words, model):
    pieces = set()
    for w in words:
        for view in (o6.plain_view(w.strip(o6.PUNCTUATION)),):
            pieces |= {view} if len(view) <= o6.PIECE_CHARS else {view[i : i + o6.PIECE_CHARS] for i in range(0, len(view) - o6.PIECE_CHARS + o6.PIECE_STEP, o6.PIECE_STEP)}
    out = model.bias
    for piece in pieces:
        for mark, weight in zip(model.landmarks, model.weights, strict=True):
            if len(piece) >= o6.LENGTH and {ord(c) % 64 for c in mark} <= {ord(c) % 64 for c in piece}:
                like = brute_kernel(piece, mark, o6.LENGTH, o6.DECAY) / brute_kernel(mark, mark, o6.LENGTH, o6.DECAY)
                out += weight * min(like, 1.0) ** o6.POWER
    return out


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(6)
    vocab = ["".join(rng.choice(list("abcdefghiklmnoprstuv"), 6)) for _ in range(200)]
    texts, toxic = [], []
    for i in range(240):
        words = list(rng.choice(vocab, 30))
        if i % 3 == 0:
            words.insert(int(rng.integers(0, 30)), ("zwooble", "grumpfx", "idiot")[i // 3 % 3])
        texts.append(" ".join(words) + ".")
        toxic.append(int(i % 3 == 0))
    return o6.fit(texts, np.array(toxic))


def test_scores_equal_plain_python(spark, model, docs, empty):  # noqa: F811
    texts = [t for _, t in TEXTS if len(t or "") < 5000] + [
        "abc zwooble def. other words here! zwo-oble gru*mpfx", "z*w*o*o*b*l*e", "iiddiioott and ggrruummppffxx", "i d i o t", "word " * 60 + "zwooble",
        "an-averylongwordwithzwoobleinside.", "idiot idiot idiot", "(\"idiot!\") 'grumpfx'...", "IDIOT \U0001f600\U0001f600\U0001f600\U0001f600"]
    got = o6.probabilities(texts, model)
    assert got == pytest.approx([plain_score(t, model) for t in texts], abs=1e-4)
    rows = o6.score(docs, model).collect()
    assert len(rows) == len(TEXTS)
    assert {(r.doc_id, round(r.score, 3)) for r in rows if r.doc_id in (3, 4, 6)} == {(i, round(plain_score(t, model), 3)) for i, t in TEXTS if i in (3, 4, 6)}
    alike = [r.score for r in o6.score(spark.createDataFrame([(1, "an idiot here")] * 5, "doc_id long, text string").repartition(3), model).collect()]
    assert len(set(alike)) == 1
    assert o6.score(empty, model).collect() == []


@pytest.mark.parametrize("gap", ["", "*", "..", "-_-", "####", "*.*.*", " "])
def test_gapped_insults(model, gap):
    """Any number of signs, or blanks, between the letters."""
    score = float(o6.probabilities([f"abc def {gap.join('idiot')} ghi."], model)[0])
    assert score == pytest.approx(float(o6.probabilities(["abc def idiot ghi."], model)[0]), abs=0.01) and score >= 0.5


def test_inserted_and_doubled_letters(model):
    scores = o6.probabilities([f"abc def {w} ghi." for w in ("idiot", "idxiot", "ixdxiot", "iiddiioott", "iiidddiiiooottt", "i-diot", "id1iot")], model)
    assert (scores >= 0.5).all(), scores
    clean = o6.probabilities([f"abc def {w} ghi." for w in ("ballad", "book-keeper", "a.b.c.d", "1.2.3.4", "aabbcc", "mother-in-law")], model)
    assert (clean < 0.5).all(), clean


def test_plain_view():
    assert [o6.plain_view(w) for w in ("s*t*u*p*i*d", "ssttuuppiidd", "id1iot", "stu-pid", "balloon", "", "***", "a.b.c", "1.2.3.4")] == ["stupid", "stupid", "id1iot", "stu-pid", "balloon", "", "*", "abc", "1.2.3.4"]


def test_one_row_is_read_for_an_id(spark):
    texts = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("an idiot "), F.col("id") % 700).alias("text")).unionByName(
        spark.createDataFrame([(i, f"plain words {i}") for i in range(2, 40)], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic long")
    seen = []
    was, o6.fit = o6.fit, lambda t, y: seen.append((t, y.tolist())) or was(t, y)
    try:
        o6.train(texts, labels, per_class=10)
    finally:
        o6.fit = was
    assert len(seen[0][0]) == 11 and sum(seen[0][1]) == 1
    ratings = labels.select("doc_id", F.col("toxic").cast("int").alias("grade"))
    assert o9.rated_sample(texts, ratings, most=10_000).count() == 39
    assert o9.rated_sample(texts, ratings, most=10).count() <= 10


@pytest.mark.skipif(not os.path.exists(LARGE), reason="test data not present")
def test_held_out_toxicity(spark):
    rows = queries.op6_toxicity_ssk(spark, LARGE).filter("held_out").join(spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == y] for y in (1, 0))
    assert len(toxic) > 90 and np.mean(toxic) >= 0.87 and np.mean(clean) <= 0.1, (np.mean(toxic), np.mean(clean))


# 9 -----------------------------------------------------------------------
def plain_loss(w, cuts, x, y, grades, l2):
    share = Counter(y.tolist())
    weight = [1 / (share[g] + 1) for g in y.tolist()]
    total = 0.0
    for row, g, k in zip(x, y.tolist(), weight, strict=True):
        above = [1.0] + [1 / (1 + math.exp(c - sum(a * b for a, b in zip(row, w, strict=True)))) for c in cuts] + [0.0]
        total -= k / sum(weight) * math.log(above[g] - above[g + 1])
    return total + l2 / 2 * sum(v * v for v in w)


def test_ordinal_fit_is_the_least_loss():
    """No step in any parameter lowers the loss, computed row by row."""
    rng = np.random.default_rng(19)
    x = rng.normal(size=(80, 2))
    y = np.digitize(x @ [1.5, -1.0] + rng.logistic(size=80), [-1.0, 0.3, 2.0])
    w, cuts = o9.fit_ordinal(x, y, 4, epochs=6000, rate=0.01)
    best = plain_loss(w, cuts, x, y, 4, o9.L2)
    for k in range(2 + 3):
        for step in (-0.01, 0.01):
            p = np.concatenate([w, cuts])
            p[k] += step
            assert plain_loss(p[:2], p[2:], x, y, 4, o9.L2) >= best - 1e-6
            gradient = (plain_loss(p[:2], p[2:], x, y, 4, o9.L2) - best) / step
            assert abs(gradient) < 0.01
    assert (np.diff(cuts) > 0).all()


def plain_vector(text, buckets):
    text = text or ""
    words, half = text.lower().split(), buckets // 2
    counts = [0.0] * buckets
    for w in words:
        counts[zlib.crc32(w.encode()) % half] += 1
        counts[half + (min(len(w.encode()), 15) * 512 + w.encode()[-1] * 2 + w.isalpha()) * 2654435761 % (half - 8)] += 1
    counts = [math.log1p(c) for c in counts]
    norm = max(math.sqrt(sum(c * c for c in counts)), 1e-9)
    counts = [c / norm for c in counts]
    n, chars = max(len(words), 1), max(len(text), 1)
    rates = (math.log1p(len(words)) / 8, len(set(words)) / n, min(chars / n, 20) / 10, sum(c.isupper() for c in text) / chars, 5 * sum(c in "#*$%&|<>" for c in text) / chars, len(words) < 50)
    for k, r in enumerate(rates):
        counts[buckets - 8 + k] = float(r)
    return counts


def test_ordinal_scores_equal_plain_python(spark, docs, empty):  # noqa: F811
    rng = np.random.default_rng(91)
    w, cuts = rng.normal(size=o9.BUCKETS), np.array([-0.5, 0.2, 1.1])
    texts = [t for _, t in TEXTS]
    assert o9.text_vectors(pa.array(texts, pa.string())) == pytest.approx(np.array([plain_vector(t, o9.BUCKETS) for t in texts]), abs=1e-5)
    want = []
    for i, t in TEXTS:
        z = float(np.dot(plain_vector(t, o9.BUCKETS), w))
        above = [1 / (1 + math.exp(c - z)) for c in cuts]
        want.append((i, round(sum(above), 3), round(above[1], 3)))
    got = [(r.doc_id, round(r.expected_grade, 3), round(r.tail, 3)) for r in o9.score(docs, w, cuts, 2).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=2e-3)
    assert o9.score(empty, w, cuts, 2).collect() == []


@pytest.mark.skipif(not os.path.exists(LARGE), reason="test data not present")
def test_held_out_quality(spark):
    rows = queries.op9_ordinal_quality(spark, LARGE).filter("held_out").join(spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == y] for y in (1, 0))
    assert np.mean(good) >= 0.9 and np.mean(bad) <= 0.2, (np.mean(good), np.mean(bad))
