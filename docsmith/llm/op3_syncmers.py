"""Document fingerprints from closed syncmers.

A k-mer of characters is chosen if the smallest hash among its inner s-mers is
at its first or its last place.  That depends on the k-mer alone, not on its
neighbours, so that equal passages give equal anchors wherever they stand.  A
fingerprint lists every anchor of a document, in the order of their places, each
with its place; two fingerprints are alike as far as they share anchors of
passages: places that agree up to a shift which others have too, so that text
inserted or cut between passages does not part them.  The number of anchors grows with the text
(about 2 in 15 characters of prose).  Consecutive anchors overlap, so an edit
changes the list wherever it stands, except in the up to 14 characters before
the first anchor and after the last one.

``fingerprint`` works inside each text's own row.  ``with_next`` brings every
document together with the one after it in descending id: documents are dealt
into ranges of ids (cut points from a quantile sketch, as many as the texts'
bytes need), and each range also gets the first document of the range below, so
no task holds more than a range.  An id on a large share of the rows, and null
ids, are cut further by the texts' hashes; only rows equal in id and text stay
together.

Defined results: a null text counts as empty and has the empty fingerprint; two
empty fingerprints are alike (1), an empty and another are not (0); a text
without a closed syncmer, as any shorter than a k-mer, has one anchor, its whole
self; an anchor that occurs again is listed again, and its n-th occurrence in
one text meets its n-th in the other; rows that repeat an id
follow each other in the order of their texts' hashes; null ids come last; a
single document follows itself; an empty table gives an empty result; other
columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value

K, S = 20, 6
#: Places agree if their shifts differ by no more characters than this.
SHIFT_BAND = 32
#: Shared anchors whose shifts agree that make a passage, or half of the anchors
#: of the shorter text, if these are fewer.
PASSAGE = 8
#: Bytes of texts of a range of ids, and ranges at most.
RANGE_BYTES, MOST_RANGES = 64 << 20, 100_000
#: Characters of fingerprints that a task gathers before it hands them on.
BLOCK_CHARS = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_HEX = np.array([list(b"%02x" % i) for i in range(256)], np.uint8)

Anchors = np.ndarray  # rows of (hash, place), in the order of places


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(chars: np.ndarray, at: np.ndarray | None, size: int) -> np.ndarray:
    """Hashes of the grams of ``size`` at the places ``at`` (None: all)."""
    n = len(chars) - size + 1
    out = np.zeros(n if at is None else len(at), np.uint64)
    for i in range(size):
        out *= _BASE
        out += chars[i : i + n] if at is None else chars[at + i]
    return _mix(out + np.uint64(size))


def closed_syncmers(chars: np.ndarray, k: int = K, s: int = S) -> np.ndarray:
    """Places of the closed syncmers of a sequence of code points (uint64)."""
    inner, width = _grams(chars, None, s), k - s + 1
    low, span = inner, 1
    while 2 * span <= width:  # smallest of `span` neighbours, doubled
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    n = len(inner) - width + 1
    least = np.minimum(low[:n], low[width - span : width - span + n])
    return np.flatnonzero((inner[:n] == least) | (inner[width - 1 :] == least))


def anchors(text: str, k: int = K, s: int = S) -> Anchors:
    if not text:
        return np.empty((0, 2), np.int64)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    at = closed_syncmers(chars, k, s) if len(chars) >= k else np.empty(0, np.int64)
    if not len(at):
        at, k = np.zeros(1, np.int64), len(chars)
    return np.stack([(_grams(chars, at, k) >> np.uint64(24)).astype(np.int64), at]).T


def written(a: Anchors) -> str:
    """``hash:place`` of each anchor, ten hexadecimal digits and a number."""
    if not len(a):
        return ""
    tens = 10 ** np.arange(len(str(a[-1, 1])) - 1, -1, -1)
    out = np.empty((len(a), 12 + len(tens)), np.uint8)
    out[:, :10] = _HEX[a[:, 0].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]].reshape(-1, 10)
    out[:, 10], out[:, -1] = ord(":"), ord(" ")
    keep = np.ones(out.shape, bool)
    for i, ten in enumerate(tens, 11):
        out[:, i] = a[:, 1] // ten % 10 + ord("0")
        keep[:, i] = a[:, 1] >= ten if ten > 1 else True
    return out[keep][:-1].tobytes().decode("ascii")


def _by_hash(a: Anchors) -> tuple[np.ndarray, ...]:
    """Distinct hashes; places by hash; where a hash's places begin; how many they are."""
    order = np.argsort(a[:, 0], kind="stable")
    hashes = a[order, 0]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[first], a[order, 1], first, np.diff(first, append=len(hashes))


def _shifts(a: Anchors, b: Anchors) -> np.ndarray:
    """Shifts from ``a`` to ``b`` of the anchors that both have, ascending."""
    (ha, at, ia, na), (hb, bt, ib, nb) = _by_hash(a), _by_hash(b)
    j = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = hb[j] == ha
    j = j[both]
    ia, ib, n = ia[both], ib[j], np.minimum(na[both], nb[j])
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.sort(bt[np.repeat(ib, n) + nth] - at[np.repeat(ia, n) + nth])


def likeness(a: Anchors, b: Anchors, band: int = SHIFT_BAND) -> float:
    """0 to 1: of the anchors of either, those that both have in a passage,
    counted in both (Dice)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shifts = _shifts(a, b)
    if not len(shifts):
        return 0.0
    alike = np.searchsorted(shifts, shifts + band, "right") - np.searchsorted(shifts, shifts - band)
    both = int((alike >= min(PASSAGE, max(1, min(len(a), len(b)) // 2))).sum())
    share = both / (len(a) + len(b) - len(shifts))
    return 2 * share / (1 + share)


def _place(cuts: list[int], id_col: Column) -> Column:
    """How many of the ascending ``cuts`` are below an id, by halving."""
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    at = lambda n: F.get(F.lit(cuts).cast("array<bigint>"), n - 1)
    below = lambda n, step: F.when((n + step <= len(cuts)) & (at(n + step) < id_col), n + step).otherwise(n)
    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), below) if cuts else F.lit(0)


def range_of(rows: DataFrame, ranges: int) -> Column:
    """The range of a row (doc_id, tie), ascending with id, null ids first, and
    with the tie."""
    row = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], max(10_000, 20 * ranges)), F.count("*"), F.count("doc_id")).first()
    cuts = row[0] or []
    times = Counter(cuts)
    heavy = {v: n for v, n in times.items() if n > 1}  # an id on as many ranges' rows
    nulls = -(-(row[1] - row[2]) * ranges // max(row[1], 1))
    inside = F.col("tie").cast("double") / float(1 << 64) + 0.5  # of 0 to 1
    pieces = F.when(F.col("doc_id").isNull(), F.lit(max(1, nulls)))
    for v, n in heavy.items():  # at most half as many as ranges
        pieces = pieces.when(F.col("doc_id") == v, F.lit(n))
    own = F.floor(inside * pieces.otherwise(F.lit(1)))
    first = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_place(sorted({*cuts, *(v - 1 for v in heavy)}), F.col("doc_id")) + 1)
    return first.cast("long") * (ranges + 1) + own


def with_next(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): the next row in descending id; after the
    last, the first."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ranges is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = min(MOST_RANGES, max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES))
    tie = F.xxhash64("text")
    tied = rows.withColumn("tie", tie)
    rows = tied.withColumn("part", range_of(tied.select("doc_id"), ranges)).drop("tie")
    heads = rows.select("part", "doc_id", tie.alias("tie")).groupBy("part").agg(F.max_by(F.struct("doc_id", "tie"), F.struct(F.coalesce("doc_id", F.lit(0)), "tie")).alias("head")).collect()  # one row per range
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    heads = sorted(((r["part"], r["head"]["doc_id"], r["head"]["tie"]) for r in heads), reverse=True)
    after = [(heads[(i + 1) % len(heads)][1:], h[0]) for i, h in enumerate(heads)]  # head of the next range -> range
    wanted = spark.createDataFrame([(i, t, p) for (i, t), p in after], "head_id long, head_tie long, into long")
    edge = rows.filter(F.col("doc_id").isNull() | F.col("doc_id").isin([h[1] for h in heads if h[1] is not None])).withColumn("tie", tie)
    edge = edge.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
    edge = edge.dropDuplicates(["into"]).select("doc_id", "text", F.col("into").alias("part"), F.lit(True).alias("edge"))
    both = rows.select("doc_id", "text", "part", F.lit(False).alias("edge")).unionByName(edge)
    order = W.partitionBy("part").orderBy("edge", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    return both.withColumn("next_text", F.lead("text").over(order)).filter(~F.col("edge")).select("doc_id", "text", "next_text")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def edited_anchors(text: str, a: Anchors, following: str, f: Anchors, k: int = K, s: int = S) -> Anchors:
    """``anchors(edited(text, following))`` from the anchors ``a`` and ``f`` of
    both: only the k-mers across the seam are new."""
    n = min(len(text) // 3, len(following))
    cut = len(text) - len(text) // 3
    if min(n, cut) < 2 * k:  # from there on, each text has closed syncmers
        return anchors(edited(text, following), k, s)
    seam = text[cut - k + 1 : cut] + following[: k - 1]
    chars = np.frombuffer(seam.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    at = closed_syncmers(chars, k, s)
    new = np.stack([(_grams(chars, at, k) >> np.uint64(24)).astype(np.int64), at + cut - k + 1])
    left, right = a[: np.searchsorted(a[:, 1], cut - k, "right")], f[: np.searchsorted(f[:, 1], n - k, "right")]
    return np.concatenate([left.T, new, right.T + [[0], [cut]]], axis=1).T


FINGERPRINTED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_pairs(rows: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of ``text`` and of its edited form, and likenesses, from
    (doc_id, text, next_text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = [f.split()[0] for f in FINGERPRINTED.split(", ")]

        def block(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        ahead: tuple[str, Anchors] = ("", anchors(""))  # rows come in order: the next text is often the next row's own
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for doc_id, own, following in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                own, following = own.as_py() or "", following.as_py() or ""
                a = ahead[1] if ahead[0] == own else anchors(own, k, s)
                ahead = (following, anchors(following, k, s))
                other = edited(own, following)
                b = edited_anchors(own, a, following, ahead[1], k, s)
                out.append((doc_id, len(own), hashlib.sha256(other.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, ahead[1])))
                size += len(out[-1][3]) + len(out[-1][4])
                if size >= BLOCK_CHARS:
                    yield block(out)
                    out, size = [], 0
            if out:
                yield block(out)

    return rows.select("doc_id", "text", "next_text").mapInArrow(run, FINGERPRINTED)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return fingerprint_pairs(with_next(docs, None, id_col, text_col))


ship_by_value(__name__)
