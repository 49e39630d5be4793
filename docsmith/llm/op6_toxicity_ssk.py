"""Toxicity by a support vector machine with a subsequence string kernel.

Two strings are alike by the subsequences of characters that they share, each
counted less the longer it stretches (``decay`` per character), so that gapped
and inserted-character insults stay close to the plain ones.  Landmarks (stems
that mark labelled toxic texts) give a Nyström map of the kernel; a sentence is
the sum of its distinct words, and a text is as toxic as its worst sentence.  Labels are of whole texts: training alternates between
picking the sentences that make a toxic text toxic and fitting the machine.

Training uses a bounded sample of labelled rows (``MAX_TRAIN_PER_CLASS`` per
label with the smallest id hashes, of texts up to ``MAX_TRAIN_CHARS``).  Scoring
reads every whole text in the task that scans it, with no shuffle; a word's
kernel values are computed once per batch, and only against landmarks all of
whose letters it has: the others count as unlike, zero.

A word with signs between its letters, or whose letters are doubled, is taken
without them (``plain_view``), however many there are.  Other words are
compared as they stand, those longer than ``PIECE_CHARS`` piece by piece: a long
word would contain most stems somehow, its letters far apart.  So one to three
foreign letters inside an insult are tolerated, one after each letter is not.

Defined results: a null or empty text has no sentence and gets the score of an
empty sentence; repeated rows score alike; without labels of both kinds every
score is the share of label 1 (0 without any label); an empty table gives an
empty result; other columns are ignored; a run of words without a sentence end
counts as sentences of ``SENTENCE_WORDS`` words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value
from docsmith.llm.words import batch_words

LENGTH, DECAY, POWER = 4, 0.9, 2
MAX_LANDMARKS = 32
STEM_SIZES = (4, 5, 6)
#: Training texts with the same first or last so many words count as copies.
COPY_WORDS = 8
MAX_LANDMARK = 6
#: Share of the toxic texts that a stem must occur in, and how many times its
#: share of the others, to be a landmark.
MIN_SHARE, MIN_LIFT = 0.015, 8.0
MAX_TRAIN_PER_CLASS = 1500
MAX_TRAIN_CHARS = 20_000
SENTENCE_WORDS = 25
#: Texts scored together in a task; a longer text is scored alone.
BLOCK_BYTES = 3_000_000
#: Longer words are cut into pieces that overlap by a landmark's length.
PIECE_CHARS, PIECE_STEP = 10, 4
#: Share of a word's characters that stay if repeated ones count once, for it to be doubled.
ONCE = 0.6
ROUNDS = 8
PUNCTUATION = ".,;:!?\"'()[]"


class Model(NamedTuple):
    landmarks: list[str]
    weights: np.ndarray  # per landmark: of a word's scaled kernel value
    bias: float
    slope: float  # of the probability of label 1 in the worst sentence's margin
    shift: float


def subsequence_kernel(words: np.ndarray, marks: np.ndarray, length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """Kernel values of pairs: ``words`` and ``marks`` are code points, one
    pair per column, padded by 0 and by -1."""
    n_mark, pairs = marks.shape
    two = np.float32(decay * decay)
    partial = [np.ones((n_mark + 1, pairs), np.float32)] + [np.zeros((n_mark + 1, pairs), np.float32) for _ in range(length - 1)]
    total = np.zeros(pairs, np.float32)
    for char in words:
        same = (marks == char) * two
        total += (same * partial[-1][:-1]).sum(axis=0)
        for i in range(length - 1, 0, -1):
            run = np.zeros(pairs, np.float32)
            partial[i] *= np.float32(decay)
            for j in range(n_mark):
                run = run * np.float32(decay) + same[j] * partial[i - 1][j]
                partial[i][j + 1] += run
    return total


def _codes(words: list[str], width: int, pad: int) -> np.ndarray:
    """(width, words): code points of words of at most ``width`` characters."""
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    out = flat.reshape(len(words), width).T.copy()
    out[out == 0] = pad
    return out


def _letters(codes: np.ndarray) -> np.ndarray:
    bits = np.where(codes > 0, np.uint64(1) << (codes % 64).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=0)


def kernel_values(words: list[str], landmarks: list[str]) -> np.ndarray:
    """(words, landmarks): (kernel / the landmark's kernel with itself, 1 at
    most) to the ``POWER``, which is sharper between alike and unlike."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    if not words:
        return out
    marks = _codes(landmarks, MAX_LANDMARK, -1)
    own = subsequence_kernel(_codes(landmarks, MAX_LANDMARK, 0), marks)
    mark_letters = _letters(marks)
    need = np.bitwise_count(mark_letters)
    size = np.fromiter(map(len, words), np.int64, len(words))
    for low, width in ((LENGTH - 1, 7), (7, PIECE_CHARS)):
        rows = np.flatnonzero((size > low) & (size <= width))
        for at in range(0, len(rows), 1 << 15):
            some = rows[at : at + (1 << 15)]
            codes = _codes([words[i] for i in some], width, 0)
            letters = _letters(codes)
            for m in range(len(landmarks)):
                close = np.flatnonzero(np.bitwise_count(letters & mark_letters[m]) == need[m])
                if len(close):
                    mark = marks[: len(landmarks[m]), m : m + 1]
                    k = subsequence_kernel(codes[:, close], np.broadcast_to(mark, (mark.shape[0], len(close))))
                    out[some[close], m] = np.minimum(k / own[m], 1.0) ** POWER
    return out


def _joined(text: str) -> str:
    """Runs of single characters (s p e l l e d) become one word."""
    return re.sub(r"(?<!\S)\S(?:\s\S){2,}(?!\S)", lambda m: re.sub(r"\s", "", m[0]), text)


def plain_view(word: str) -> str:
    """The word without signs, if these cut its letters into more than two runs,
    and with repeated letters once, if most are repeated."""
    runs = re.findall(r"[^\W\d_]+", word)
    if len(runs) > 2:
        word = "".join(runs)
    once = re.sub(r"(.)\1+", r"\1", word)
    return once if len(once) <= ONCE * len(word) else word


def _pieces(word: str) -> list[str]:
    if len(word) <= PIECE_CHARS:
        return [word]
    return [word[i : i + PIECE_CHARS] for i in range(0, len(word) - PIECE_CHARS + PIECE_STEP, PIECE_STEP)]


class Sentences(NamedTuple):
    words: list[str]  # distinct, without punctuation, long ones in pieces
    word: np.ndarray  # entries: which of ``words``
    sentence: np.ndarray  # entries: which sentence
    owner: np.ndarray  # sentences: which text


def sentences(texts: list[str | None]) -> Sentences:
    owner, distinct, code = batch_words(pa.array([_joined(t or "") for t in texts], pa.string()))
    raw = distinct.to_pylist()
    ends = np.fromiter((w.rstrip("\"')]")[-1:] in (".", "!", "?") if w else False for w in raw), bool, len(raw))
    n = len(code)
    if not n:
        return Sentences([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    fresh = np.ones(n, bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | ends[code[:-1]]
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    fresh |= (np.arange(n) - start) % SENTENCE_WORDS == 0
    number = np.cumsum(fresh) - 1
    pieces: dict[str, int] = {}
    parts: list[list[int]] = []
    for w in raw:
        w = (w or "").strip(PUNCTUATION)
        cuts = _pieces(plain_view(w))
        parts.append([pieces.setdefault(c, len(pieces)) for c in cuts])
    many = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.fromiter((i for p in parts for i in p), np.int64, int(many.sum()))
    times = many[code]
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    word = flat[np.repeat((np.cumsum(many) - many)[code], times) + nth]
    sentence = np.repeat(number, times)
    return Sentences(list(pieces), word, sentence, owner[fresh])


def _counting(s: Sentences, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, sentence) of the entries whose words count, once each."""
    some = counts[s.word]
    once = np.unique(s.sentence[some] * max(1, len(s.words)) + s.word[some])
    return once % max(1, len(s.words)), once // max(1, len(s.words))


def pick_landmarks(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Stems that mark the toxic texts most, no two alike at the start."""
    seen = (Counter(), Counter())
    for text, y in zip(texts, toxic, strict=True):
        words = {w.strip(PUNCTUATION) for w in _joined(text or "").lower().split()}
        stems = {w[:k] for w in words for k in STEM_SIZES if len(w) >= k}
        seen[int(y)].update(stems)
    n = (max(1, int((toxic == 0).sum())), max(1, int((toxic == 1).sum())))
    best: dict[str, tuple[float, str]] = {}  # of the stems with a common start
    for stem, c in seen[1].items():
        yes, no = (c + 0.5) / n[1], (seen[0][stem] + 0.5) / n[0]
        if yes > MIN_LIFT * no and c >= max(3, MIN_SHARE * n[1]):
            worth = yes * np.log(yes / no) ** 2 * len(stem)  # of nearly equal ones the longest
            best[stem[:4]] = max(best.get(stem[:4], (0.0, "")), (worth, stem))
    chosen = [stem for _, stem in sorted(best.values(), reverse=True)[:MAX_LANDMARKS]]
    return chosen


def distinct_texts(texts: list[str]) -> list[int]:
    """Places of texts that share neither their first nor their last words
    with one before: copies would make any word of theirs a mark."""
    seen: set[tuple] = set()
    out = []
    for i, text in enumerate(texts):
        words = text.split()
        ends = {(0, *words[:COPY_WORDS]), (1, *words[-COPY_WORDS:])}
        if not ends & seen:
            out.append(i)
        seen |= ends
    return out


def _fit_svm(x: np.ndarray, y: np.ndarray, epochs: int = 200, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine, classes weighing alike, by Adam."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(x.shape[1] + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, epochs + 1):
        slack = np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])) * weight * y
        g = np.concatenate([l2 * w[:-1] - 2 * (x.T @ slack), [-2 * slack.sum()]])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return w[:-1], float(w[-1])


def _worst(s: Sentences, margins: np.ndarray, texts: int, none: float) -> np.ndarray:
    out = np.full(texts, -np.inf)
    np.maximum.at(out, s.owner, margins)
    out[np.isinf(out)] = none
    return out


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Both labels weigh alike, in the machine and in the probability."""
    toxic = np.asarray(toxic, np.int64)
    if len(set(toxic.tolist())) < 2:
        p = min(max(float(toxic.mean()) if len(toxic) else 0.0, 1e-6), 1 - 1e-6)
        return Model([], np.zeros(0), 0.0, 0.0, float(np.log(p / (1 - p))))
    own = distinct_texts(texts)
    texts, toxic = [texts[i] for i in own], toxic[own]
    landmarks = pick_landmarks(texts, toxic)
    gram = kernel_values(landmarks, landmarks).astype(np.float64)
    size, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(size, 1e-3))) @ vectors.T  # Nyström map
    s = sentences(texts)
    alike = kernel_values(s.words, landmarks)
    word, sentence = _counting(s, alike.any(axis=1))
    values = alike @ root
    x = np.zeros((len(s.owner), len(landmarks)))
    for d in range(len(landmarks)):
        x[:, d] = np.bincount(sentence, values[word, d], len(s.owner))
    of_toxic = toxic[s.owner] == 1
    guess = np.bincount(sentence, alike.max(axis=1, initial=0)[word], len(s.owner))
    margin, chosen = guess - 0.5, np.zeros(len(s.owner), bool)
    for _ in range(ROUNDS):  # sentences once chosen stay: of clean texts those that look worst, of toxic ones those that are
        chosen |= margin >= _worst(s, margin, len(texts), 0.0)[s.owner]
        use = chosen | (of_toxic & (margin > 0))
        w, b = _fit_svm(x[use], np.where(of_toxic[use], 1.0, -1.0))
        margin = x @ w + b
    top = _worst(s, margin, len(texts), b)
    weight = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (toxic == 0).sum()))
    slope, shift = 1.0, 0.0
    for _ in range(100):  # Newton steps of a logistic fit, damped by a weak prior on the slope
        p = 1 / (1 + np.exp(-np.clip(slope * top + shift, -30, 30)))
        g = np.array([(weight * (p - toxic) * top).sum() + 1e-3 * (slope - 1), (weight * (p - toxic)).sum()])
        r = weight * p * (1 - p)
        h = np.array([[(r * top * top).sum() + 1e-3, (r * top).sum()], [(r * top).sum(), r.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, shift = slope - move[0], shift - move[1]
    return Model(landmarks, root @ w, b, float(max(slope, 1e-3)), float(shift))


def probabilities(texts: list[str | None], model: Model) -> np.ndarray:
    s = sentences(texts)
    worth = kernel_values(s.words, model.landmarks) @ model.weights if model.landmarks else np.zeros(len(s.words))
    word, sentence = _counting(s, worth != 0)
    margins = np.bincount(sentence, worth[word], len(s.owner)) + model.bias if len(s.owner) else np.zeros(0)
    top = _worst(s, margins, len(texts), model.bias)
    return 1 / (1 + np.exp(-np.clip(model.slope * top + model.shift, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = MAX_TRAIN_PER_CLASS, max_chars: int = MAX_TRAIN_CHARS) -> Model:
    """``labels``: (doc_id, toxic); ids with several labels take the largest, and
    of rows that share an id the one with the smallest text hash is read."""
    ids = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = [ids.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    picked = F.broadcast(some[0].unionByName(some[1]))  # 2 * per_class rows at most
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.filter(F.length(text) <= max_chars).select("doc_id", text.alias("text")).join(picked, "doc_id")
    got = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(got.column("text").to_pylist(), got.column("toxic").to_numpy())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            block = np.cumsum(size) // BLOCK_BYTES  # texts of a bounded size together at a time
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            for at, end in zip(starts, [*starts[1:], len(block)], strict=True):
                b = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(probabilities(b.column(1).to_pylist(), model))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


ship_by_value(__name__)
