"""Ranked lexical search over norm buckets, exact in integers.

A document's impact vector has, for each term of the queries that it holds,
weight times saturated frequency; a query's vector has the term's repeats, so a
score is an inner product.

1. Tasks count the query terms of every text; frequencies, lengths and document
   frequencies come from these narrow rows, which are written once.
2. Spark orders all vectors by their length (range partitions, so that no task
   holds more than a range) and writes them; buckets are consecutive vectors.
3. The first bucket of every partition is scored whole; a query's k-th best score
   there is its first threshold.
4. Tasks go through their buckets.  Cauchy-Schwarz prunes a bucket: length of the
   query times greatest length of the bucket.  Inside, terms whose greatest
   coordinates together stay below the threshold need not be looked at to find
   candidates; a candidate's bound is what its other terms give, plus the lesser
   of those greatest coordinates and Cauchy-Schwarz over the rest of its vector.
   Survivors are rescored in 64-bit integers, and the task's own k-th best raises
   the threshold.
5. What tasks keep, at most k rows a query each, is ranked.

Bounds are prunes only: equal scores at the threshold stay, and the result is
that of scoring all documents.  Queries go in blocks of about ``max_terms``
words, each a pass of its own, so that what is broadcast (the block's terms and
vectors) and collected (one weight a term) is bounded.

Defined results: a null or empty text has no terms and is no document of N; a
null or empty query has no rows; rows of queries that repeat an id are ranked
each; equal scores go by ascending doc_id, null ids last, then by row; an empty
table gives an empty result; other columns are ignored; texts of any length are
read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value
from docsmith.llm.plain_words import folded, words_of
from docsmith.session import materialize

TOP = 20
#: Vectors of a bucket.
BUCKET = 2048
#: Words of a block of queries.
MAX_TERMS = 1_000_000
#: Bounds are doubles; a bound counts as greater by this share.
SLACK = 1 + 1e-9
COUNTED = "doc_id long, n long, terms array<int>, tfs array<int>"


def counted(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """COUNTED of every row: its terms with repeats, and of the vocabulary
    (broadcast: word -> number) those it holds and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for batch in batches:
            sizes, terms, tfs, ends = [], [], [], [0]
            for text in batch.column(1):
                words = folded(text.as_py()).split()
                held, n = np.unique(np.array([t for t in map(get, words) if t is not None], np.int32), return_counts=True)
                sizes.append(len(words))
                terms.append(held)
                tfs.append(n)
                ends.append(ends[-1] + len(held))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x) if x else [], pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, COUNTED)


class Queries:
    """Query vectors and term weights; what a task needs to score."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, all_terms: int):
        self.vectors, self.weights, self.n_docs, self.all_terms = vectors, weights, n_docs, all_terms
        self.norms = np.array([math.sqrt(float((r * r).sum())) for _, r in vectors])

    def impacts(self, rows: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Coordinates, int64: rows[i] is the vector of terms[i]."""
        m = 75 + 25 * n * self.n_docs // max(self.all_terms, 1)
        return self.weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * m[rows]))


class Vectors:
    """A batch of COUNTED rows as flat arrays."""

    def __init__(self, batch: pa.RecordBatch, queries: Queries):
        self.n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
        lists = batch.column("terms")
        self.terms = lists.flatten().to_numpy(zero_copy_only=False)
        tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.rows = lists.value_parent_indices().to_numpy(zero_copy_only=False) if len(self.terms) else np.empty(0, np.int64)
        self.impacts = queries.impacts(self.rows, self.terms, tfs, self.n)
        self.norms = np.sqrt(np.bincount(self.rows, self.impacts.astype(float) ** 2, len(self.n)))


def by_length(vectors: DataFrame, queries, bucket: int = BUCKET) -> DataFrame:
    """Vectors that hold a term, ordered by length, longest first, and written:
    COUNTED, norm, tie (a row's own number), head (in its partition's first bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("norm", pa.array(Vectors(batch, queries.value).norms))

    held = vectors.filter(F.size("terms") > 0)
    lengths = held.withColumn("tie", F.monotonically_increasing_id()).mapInArrow(run, COUNTED + ", tie long, norm double")
    ordered = lengths.repartitionByRange(F.desc("norm"), "tie").sortWithinPartitions(F.desc("norm"), "tie")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return materialize(ordered.withColumn("head", place < bucket), "by-length")


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., then those of first[1], ..."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


class Bucket:
    """Vectors of similar length by term, with their greatest coordinates."""

    def __init__(self, v: Vectors):
        self.norms, self.count = v.norms, len(v.n)
        order = np.argsort(v.terms, kind="stable")
        self.rows, self.x = v.rows[order], v.impacts[order]
        self.terms, self.first = np.unique(v.terms[order], return_index=True)
        self.size = np.diff(self.first, append=len(order))
        self.most = np.maximum.reduceat(self.x, self.first) if len(order) else np.empty(0, np.int64)

    def _postings(self, at: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, coordinate, coordinate times the query's) over the terms ``at``."""
        idx = _ranges(self.first[at], self.size[at])
        return self.rows[idx], self.x[idx], self.x[idx] * np.repeat(repeats, self.size[at])

    def survivors(self, terms: np.ndarray, repeats: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, exact scores) of at least ``least`` and above 0."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.searchsorted(self.terms, terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == terms[here]
        at, repeats = at[here], repeats[here]
        gives = repeats * self.most[at]
        if gives.sum() < max(least, 1):
            return none
        order = np.argsort(gives, kind="stable")
        at, repeats, gives = at[order], repeats[order], np.cumsum(gives[order])
        rest = int(np.searchsorted(gives, max(least, 1)))  # so many terms together stay below the threshold
        rows, x, part = self._postings(at[rest:], repeats[rest:])
        known = np.bincount(rows, part, self.count)
        left = np.maximum(self.norms**2 - np.bincount(rows, x.astype(float) ** 2, self.count), 0)
        bound = known + np.minimum(float(gives[rest - 1]) if rest else 0.0, math.sqrt(float((repeats[:rest] ** 2).sum())) * np.sqrt(left) * SLACK + 1e-3)
        found = np.flatnonzero((known > 0) & (bound * SLACK >= least))
        if not len(found):
            return none
        number = np.full(self.count, -1)
        number[found] = np.arange(len(found))
        rows, _, part = self._postings(at, repeats)
        rows = number[rows]
        scores = np.zeros(len(found), np.int64)
        np.add.at(scores, rows[rows >= 0], part[rows >= 0])
        keep = (scores >= least) & (scores > 0)
        return found[keep], scores[keep]


FOUND = "query int, doc_id long, score long, tie long"


def best(vectors: DataFrame, queries, least: dict[int, int], top: int = TOP, bucket: int = BUCKET) -> DataFrame:
    """FOUND: what each task keeps of its rows, at most ``top`` a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = queries.value
        held: list[list[tuple]] = [[] for _ in own.vectors]  # (-score, id is null, id, tie), best first
        floor = np.array([least.get(i, 0) for i in range(len(held))], np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, bucket):
                part = batch.slice(lo, bucket)
                here = Bucket(Vectors(part, own))
                ids, ties = part.column("doc_id").to_pylist(), part.column("tie").to_pylist()
                for i in np.flatnonzero(own.norms * here.norms.max() * SLACK >= floor):
                    rows, scores = here.survivors(*own.vectors[i], int(floor[i]))
                    if not len(rows):
                        continue
                    if len(rows) > top:  # ties with the last of them stay
                        lowest = np.partition(scores, -top)[-top]
                        rows, scores = rows[scores >= lowest], scores[scores >= lowest]
                    more = [(-s, ids[r] is None, ids[r] or 0, ties[r]) for r, s in zip(rows.tolist(), scores.tolist(), strict=True)]
                    held[i] = sorted(held[i] + more)[:top]
                    if len(held[i]) == top:
                        floor[i] = max(floor[i], -held[i][-1][0])
        out = [(i, None if x[1] else x[2], -x[0], x[3]) for i, kept in enumerate(held) for x in kept]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = zip(*out, strict=True) if out else ([],) * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["query", "doc_id", "score", "tie"])

    return vectors.select("doc_id", "n", "terms", "tfs", "tie").mapInArrow(run, FOUND)


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "tie")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def weights_of(vectors: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term, documents with a term, their terms with repeats)."""
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most n_terms rows
    out = np.zeros(n_terms, np.int64)
    for r in df:
        out[r["term"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * r["count"] + 1)))
    return out, total["docs"], total["terms"]


def _search_block(spark: SparkSession, docs: DataFrame, block: list[list[str]], top: int, bucket: int, id_col: str, text_col: str) -> DataFrame:
    """(query, rank, doc_id, score) for queries given by their words."""
    words = {w: i for i, w in enumerate(sorted({w for words in block for w in words}))}
    vocabulary = spark.sparkContext.broadcast({w.encode(): i for w, i in words.items()})
    vectors = materialize(counted(docs, vocabulary, id_col, text_col), "term-counts")
    repeats = [sorted(Counter(words[w] for w in q).items()) for q in block]
    pairs = [tuple(np.array(x, np.int64).reshape(-1, 2).T) for x in repeats]
    queries = spark.sparkContext.broadcast(Queries(pairs, *weights_of(vectors, len(words))))
    ordered = by_length(vectors, queries, bucket)
    heads = ranked(best(ordered.filter("head"), queries, {}, top, bucket), top).filter(F.col("rank") == top)
    least = {r["query"]: r["score"] for r in heads.select("query", "score").collect()}  # one row a query
    return ranked(best(ordered, queries, least, top, bucket), top).select("query", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, max_terms: int = MAX_TERMS, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each row of ``items``."""
    spark = docs.sparkSession
    rows = items.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("words")).filter(F.size("words") > 0)
    rows = materialize(rows.withColumn("item", F.monotonically_increasing_id()), "queries")
    blocks = -(-(rows.agg(F.sum(F.size("words"))).first()[0] or 0) // max_terms)
    kind = rows.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for k in range(blocks):
        block = rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item").collect()  # about max_terms words
        if not block:
            continue
        found = _search_block(spark, docs, [r["words"] for r in block], top, bucket, id_col, text_col)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"query int, item_id {kind}")
        found = found.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if blocks == 1 else out.unionByName(found)
    return out


ship_by_value(__name__)
