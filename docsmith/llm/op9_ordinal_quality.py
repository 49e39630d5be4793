"""Quality by ordinal (cumulative-link) regression on graded ratings.

Words, word pairs' shapes and a few rates of a text are hashed into one vector;
shared weights and ordered thresholds give P(grade > j) = sigmoid(w.x - t_j).
A document gets its expected grade and a tail probability for selection.

Training uses a bounded sample of rated rows (``MAX_TRAIN_ROWS``, those with
the smallest hashes of their ids): their vectors are made in tasks and only
these, of fixed size, reach the driver.  Scoring reads every whole text in the
task that scans it, with no shuffle.

Defined results: a null or empty text has the empty vector and a score like
any other; repeated rows are scored alike; without any rating every grade is
equally likely; an empty table gives an empty result; other columns are
ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value
from docsmith.llm.words import batch_words

BUCKETS = 1024
MAX_TRAIN_ROWS = 4000
EPOCHS = 300
LEARNING_RATE = 0.05
L2 = 1e-4


def text_vectors(texts: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    """One vector per text: hashed words, hashed shapes of words, and rates."""
    import zlib

    owner, distinct, code = batch_words(texts)
    names = [w.encode() for w in distinct.to_pylist()]
    half = buckets // 2
    word = np.fromiter((zlib.crc32(w) % half for w in names), np.int64, len(names))
    letters = np.fromiter((w.isalpha() for w in distinct.to_pylist()), bool, len(names))
    size = np.fromiter((min(len(w), 15) for w in names), np.int64, len(names))
    last = np.fromiter((w[-1] if w else 0 for w in names), np.int64, len(names))
    shape = half + (size * 512 + last * 2 + letters) * 2654435761 % (half - 8)
    n = len(texts)
    counts = np.zeros((n, buckets), np.float32)
    for ids in (word, shape):
        flat = np.bincount(owner * buckets + ids[code], minlength=n * buckets) if len(code) else np.zeros(n * buckets)
        counts += flat.reshape(n, buckets)
    total = np.bincount(owner, minlength=n) if len(code) else np.zeros(n)
    seen = np.bincount(np.unique(owner * len(names) + code) // len(names), minlength=n) if len(code) else np.zeros(n)
    counts = np.log1p(counts)
    norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
    counts /= np.maximum(norm, 1e-9)
    filled = pc.fill_null(texts, "")
    chars = np.maximum(pc.utf8_length(filled).to_numpy(zero_copy_only=False), 1)
    upper = pc.count_substring_regex(filled, r"\p{Lu}").to_numpy(zero_copy_only=False)
    marks = pc.count_substring_regex(filled, r"[#*$%&|<>]").to_numpy(zero_copy_only=False)
    rates = (np.log1p(total) / 8, seen / np.maximum(total, 1), np.minimum(chars / np.maximum(total, 1), 20) / 10, upper / chars, 5 * marks / chars, total < 50)
    for k, r in enumerate(rates):
        counts[:, buckets - 8 + k] = r
    return counts


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, epochs: int = EPOCHS, rate: float = LEARNING_RATE, l2: float = L2) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ascending thresholds) by Adam on the negative log-likelihood
    of grades 0..grades-1; grades weigh alike however frequent."""
    k = grades - 1
    if not len(y):
        return np.zeros(x.shape[1]), np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1))
    share = np.bincount(y, minlength=grades) + 1.0
    weight = (1 / share)[y]
    weight /= weight.sum()
    w = np.zeros(x.shape[1])
    gaps = np.array([-1.0, *[0.0] * (k - 1)])  # first threshold, then logs of the steps
    moments = [np.zeros(len(w) + k), np.zeros(len(w) + k)]
    for t in range(1, epochs + 1):
        cuts = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
        z = x @ w
        above = 1 / (1 + np.exp(np.clip(cuts[None] - z[:, None], -40, 40)))  # P(y > j)
        up = np.concatenate([np.ones((len(y), 1)), above], axis=1)[np.arange(len(y)), y]
        down = np.concatenate([above, np.zeros((len(y), 1))], axis=1)[np.arange(len(y)), y]
        p = np.maximum(up - down, 1e-9)
        slope = above * (1 - above)
        d_up = np.concatenate([np.zeros((len(y), 1)), slope], axis=1)[np.arange(len(y)), y]
        d_down = np.concatenate([slope, np.zeros((len(y), 1))], axis=1)[np.arange(len(y)), y]
        gz = -weight * (d_up - d_down) / p
        g_cut = np.zeros(k)
        np.add.at(g_cut, y[y > 0] - 1, (weight * d_up / p)[y > 0])
        np.add.at(g_cut, y[y < k], -(weight * d_down / p)[y < k])
        tail = np.cumsum(g_cut[::-1])[::-1]
        g = np.concatenate([x.T @ gz + l2 * w, [tail[0]], tail[1:] * np.exp(gaps[1:])])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.999 * moments[1] + 0.001 * g * g
        move = rate * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-9)
        w, gaps = w - move[: len(w)], gaps - move[len(w) :]
    return w, np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))


def rated_sample(docs: DataFrame, ratings: DataFrame, most: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, grade) of at most ``most`` rated ids; ids with several grades
    take the smallest, and of rows that share an id the one with the smallest text
    hash is read."""
    ids = ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # `most` ids at most
    return rows.groupBy("doc_id", "grade").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "grade")


def train(docs: DataFrame, ratings: DataFrame, grades: int, buckets: int = BUCKETS, most: int = MAX_TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = text_vectors(b.column(1), buckets)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary())], names=["doc_id", "grade", "x"])

    got = rated_sample(docs, ratings, most).mapInArrow(run, "doc_id long, grade int, x binary").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), "<f4").reshape(-1, buckets)
    return fit_ordinal(x.astype(np.float64), got.column("grade").to_numpy(), grades)


def score(docs: DataFrame, weights: np.ndarray, cuts: np.ndarray, keep_grade: int, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, expected_grade, tail: P(grade >= keep_grade)) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # vectors of a bounded block at a time
                b = batch.slice(at, 1024)
                z = text_vectors(b.column(1), buckets) @ weights
                above = 1 / (1 + np.exp(np.clip(cuts[None] - z[:, None], -40, 40)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, keep_grade - 1])], names=["doc_id", "expected_grade", "tail"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail double")


def ordinal_quality(docs: DataFrame, ratings: DataFrame, grades: int, keep_grade: int, keep_at: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail, kept) for every row of ``docs``;
    ``ratings``: (doc_id, grade 0..grades-1)."""
    weights, cuts = train(docs, ratings, grades)
    return score(docs, weights, cuts, keep_grade).withColumn("kept", F.col("tail") >= keep_at)


ship_by_value(__name__)
