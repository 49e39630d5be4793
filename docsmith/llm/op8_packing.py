"""Best-fit packing by a plan over the length histogram.

1. Texts are tokenised in the tasks that scan them; a document becomes pieces
   (length, checksum) of at most ``max_tokens`` tokens, which are written once.
2. The plan is best-fit decreasing over *counts*: the driver sees one row per
   length (at most ``max_tokens``), and places whole runs of equal pieces into
   runs of equal sequences.  It never sees a document.
3. Pieces take the planned slots by their rank within their length.  Ranks
   are two-level: a rank inside (length, bucket) plus the sizes of the buckets
   before, so that a length held by a third of all pieces is no single group;
   buckets are drawn by the rows' own numbers, so that equal rows spread too.

The plan has a run per length and per group of sequences that it opens or
splits, which depends on the lengths present and not on the documents; its size
is checked before it is broadcast.

Defined results: a null or empty text is one piece of the end token; repeated
rows and ids are packed row by row; ties of length are ranked by bucket and row
number; an empty table gives an empty result; other columns are ignored;
texts of any length are tokenised whole.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.byte_bpe import byte_bpe_encoder
from docsmith.llm.common import ship_by_value
from docsmith.session import materialize

MAX_TOKENS = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Largest plan that is broadcast, in rows.
MAX_PLAN_ROWS = 200_000
BUCKETS = 64
TOKENS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        encode = byte_bpe_encoder(tokenizer, special=True)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                cuts = [0, *range(len(ids) % max_tokens or max_tokens, len(ids) + 1, max_tokens)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for c, v in zip(out, (doc_id, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())), strict=True):
                        c.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, TOKENS)


class Run(NamedTuple):
    """Pieces of ``length`` with ranks from ``first`` on, ``per`` of them in
    each sequence from ``sequence`` on, the first of these at ``offset``."""

    length: int
    first: int
    count: int
    sequence: int
    per: int
    offset: int


def plan_best_fit(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[Run]:
    """Best-fit decreasing over counts.  Sequences with equal room are runs
    [first, last); a run is split only where the pieces of a length end."""
    runs: list[Run] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences
    rooms: list[int] = []  # its keys, sorted
    opened = 0

    def give_back(left: int, first: int, last: int) -> None:
        if left and first < last:
            if left not in room:
                insort(rooms, left)
                room[left] = []
            heapq.heappush(room[left], (first, last))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)  # the tightest room that fits
            if at < len(rooms):
                space = rooms[at]
                first, last = heapq.heappop(room[space])
                if not room[space]:
                    del room[space], rooms[at]
            else:
                space, first = max_tokens, opened
                last = opened = opened + -(-left // (max_tokens // length))
            per = space // length  # a filled sequence stays the tightest until no more fits
            whole = min(last - first, left // per)
            if whole:
                runs.append(Run(length, rank, whole * per, first, per, max_tokens - space))
                give_back(space - per * length, first, first + whole)
                rank, left, first = rank + whole * per, left - whole * per, first + whole
            if left and first < last:  # fewer pieces than one more sequence takes
                runs.append(Run(length, rank, left, first, left, max_tokens - space))
                give_back(space - left * length, first, first + 1)
                rank, left, first = rank + left, 0, first + 1
            give_back(space, first, last)
    return runs


def ranked(parts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``parts``, whose rows are numbered by ``row``, with ``rank``: 0, 1, ...
    within each length."""
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    sizes = parts.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("length", "bucket").orderBy("row")) - 1
    return parts.withColumn("own", own).join(offsets, ["length", "bucket"]).withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "bucket")


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    spark = docs.sparkSession
    parts = materialize(pieces(docs, max_tokens, tokenizer, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most max_tokens rows
    runs = plan_best_fit(histogram, max_tokens)
    if len(runs) > MAX_PLAN_ROWS:
        raise ValueError(f"a plan of {len(runs)} rows is too large to broadcast")
    schema = "length long, first long, count long, sequence long, per long, base long"
    plan = spark.createDataFrame([tuple(r) for r in runs], schema)
    buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = ranked(parts, buckets).alias("r").join(
        F.broadcast(plan).alias("p"),
        (F.col("r.length") == F.col("p.length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count")))
    nth = F.col("rank") - F.col("first")
    return rows.select("doc_id", "piece", "start", F.col("r.length").alias("length"), "ids_crc32",
                       (F.col("sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
                       (F.col("base") + (nth % F.col("per")) * F.col("r.length")).cast("long").alias("offset"))


ship_by_value(__name__)
