"""SimHash near-duplicates by a binary-trie self-join.

1. ``fingerprints``: one 64-bit SimHash per document.  No shuffle: whole texts
   are read once, in the tasks that scan them.
2. ``trie_links``: the distinct fingerprints form a binary trie, which is
   joined with itself.  Spark expands *node pairs* level by level: a pair
   carries the differing bits of its two prefixes and goes when they exceed the
   budget.  A pair whose two subtries are small enough becomes one group, in
   which a task walks both subtries together bit by bit with the same pruning.
   A hot prefix is expanded further until its subtries are small, so that no
   task gets an unbounded group.  A group returns a spanning forest of the
   links it found: no link between two texts is lost and a group of copies
   never becomes all its pairs.
3. ``components``: connected components of those links by alternating
   large-star and small-star rounds, each written to the shared checkpoint
   folder.  Links and fingerprints never reach the driver.

Copies share a fingerprint and are collapsed before step 2 by an aggregation
with a map-side part, so a group of copies that holds a third of all rows
counts as one fingerprint.

Defined results: a null or empty text has fingerprint zero and links like any
other; a text with fewer words than a shingle has the hash of all its words;
rows that repeat a ``doc_id`` are separate rows with the same id; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value
from docsmith.session import materialize

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 2
#: Fingerprints that two subtries may have together to be joined in one task.
LEAF_FINGERPRINTS = 32768
#: Bits by which a node pair grows in one Spark round.
STEP_BITS = 4


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: majority of the bits of its shingles' XXH64."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # on bytes both are ASCII only
    if not words:
        return 0
    if len(words) < shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    rolling = zip(*(words[i:] for i in range(shingle_words)), strict=False)
    n = len(words) - shingle_words + 1
    hashes = np.fromiter((digest(join(s), HASH_SEED) for s in rolling), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # a bounded block of bits at a time
        block = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp long: the 64 bits as a signed number, *keep) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((simhash(t.as_py(), shingle_words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *keep])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *[f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep]]))


def _prefix(fp, bits: int):
    return F.shiftrightunsigned(fp, 64 - bits) if bits else F.lit(0).cast("long")


def _walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted ``a`` and ``b`` (subtries of ``depth`` common
    bits each) at no more than ``max_bits``, by walking both tries together.
    ``same``: a is b, and only pairs i < j are wanted."""
    one = np.uint64(1)
    alo, ahi = np.array([0]), np.array([len(a)])
    blo, bhi = np.array([0]), np.array([len(b)])
    err = np.array([int(a[0] >> np.uint64(64 - depth) ^ b[0] >> np.uint64(64 - depth)).bit_count() if depth else 0])
    for bit in range(depth, 65):
        area = (ahi - alo) * (bhi - blo)
        small = (area <= 16) | (bit == 64)
        if small.any():  # too few leaves below for another level to pay: compare them
            s_alo, s_blo, wide, size = alo[small], blo[small], (bhi - blo)[small], area[small]
            pair = np.repeat(np.arange(len(size)), size)
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            i, j = s_alo[pair] + k // wide[pair], s_blo[pair] + k % wide[pair]
            near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
            if same:
                near &= i < j
            yield i[near], j[near]
        alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            return
        shift = np.uint64(63 - bit)
        high = ~np.uint64(0) << shift
        amid = np.clip(np.searchsorted(a, (a[alo] & high) | one << shift), alo, ahi)
        bmid = np.clip(np.searchsorted(b, (b[blo] & high) | one << shift), blo, bhi)
        mirrored = same & (alo == blo) & (ahi == bhi)  # its (1, 0) child repeats its (0, 1) child
        parts = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
                 (amid, np.where(mirrored, amid, ahi), blo, bmid, err + 1)]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts, strict=True))
        keep = (ahi > alo) & (bhi > blo) & (err <= max_bits)
        alo, ahi, blo, bhi, err = (x[keep] for x in (alo, ahi, blo, bhi, err))


def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (smallest index of the component) after adding the links u-v."""
    while True:
        x, y = label[u], label[v]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up


def trie_links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF_FINGERPRINTS, step: int = STEP_BITS) -> DataFrame:
    """(u, v): links that join the same fingerprints as all pairs at no more
    than ``max_bits`` do.  ``fps``: distinct ``fp``, read several times."""
    spark, n = fps.sparkSession, fps.count()
    pairs = spark.createDataFrame([(0, 0, 0, n, n)], "a long, b long, err int, na long, nb long")
    load = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
    depth, levels = 0, []
    while depth < 64 and (n > leaf << depth or (pairs.agg(F.max(load)).first()[0] or 0) > leaf):
        levels.append((depth, pairs.filter(load <= leaf)))
        deeper = min(64, depth + step)
        grown = deeper - depth
        nodes = fps.groupBy(_prefix(F.col("fp"), deeper).alias("p")).agg(F.count("*").alias("n"))
        up = F.shiftrightunsigned("p", grown)
        pairs = (
            pairs.filter(load > leaf).drop("na", "nb")
            .join(nodes.select(up.alias("a"), F.col("p").alias("ca"), F.col("n").alias("na")), "a")
            .join(nodes.select(up.alias("b"), F.col("p").alias("cb"), F.col("n").alias("nb")), "b")
            .filter((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb")))
            .withColumn("err", F.col("err") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << grown) - 1))))
            .filter(F.col("err") <= max_bits)
            .select(F.col("ca").alias("a"), F.col("cb").alias("b"), F.col("err").cast("int").alias("err"), "na", "nb")
        )
        pairs, depth = materialize(pairs, "trie-pairs"), deeper
    levels.append((depth, pairs))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        at, left, right = int(pdf["depth"].iloc[0]), int(pdf["a"].iloc[0]), int(pdf["b"].iloc[0])
        fp = np.sort(pdf["fp"].to_numpy().view(np.uint64))
        a = b = fp
        if left != right:
            side = fp >> np.uint64(64 - at) == np.uint64(left % (1 << 64))
            a, b = fp[side], fp[~side]
        both = a if left == right else np.concatenate([a, b])
        label = np.arange(len(both))
        for i, j in _walk(a, b, left == right, at, max_bits):
            label = _merge(label, i, j if left == right else j + len(a))
        child = np.flatnonzero(label != np.arange(len(both)))
        return pd.DataFrame({"u": both[child].view(np.int64), "v": both[label[child]].view(np.int64)})

    members = None
    for at, level in levels:
        if at == 0:  # the root alone: few fingerprints, one group
            members = fps.select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "fp") if n <= leaf else None
            continue
        by_node = level.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
        rows = by_node.join(fps.select("fp", _prefix(F.col("fp"), at).alias("node")), "node").select(F.lit(at).alias("depth"), "a", "b", "fp")
        members = rows if members is None else members.unionByName(rows)
    return members.groupBy("depth", "a", "b").applyInPandas(join, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node with a link, the smallest node of its
    component, by alternating large-star and small-star rounds."""
    edges = materialize(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u <> v").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state


def rooted(rows: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF_FINGERPRINTS) -> DataFrame:
    """(fp, first_id, root): the group of each fingerprint of ``rows`` (doc_id,
    fp), and the smallest id that has it."""
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    nodes = components(trie_links(fps.select("fp"), max_bits, leaf))
    return fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   leaf: int = LEAF_FINGERPRINTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): each row with its fingerprint and the
    smallest doc_id that it reaches over fingerprints ``max_bits`` apart."""
    rows = materialize(fingerprints(docs, shingle_words, id_col, text_col), "simhash")
    groups = rooted(rows, max_bits, leaf)
    named = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = groups.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp", "left").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group, with all its columns: that with the
    smallest id (null ids last), of those that share the id the one with the
    smallest text hash, and of rows that share both one.  Rows that repeat an id
    with texts that are not alike are of different groups: each stays."""
    tag = F.xxhash64(F.lit(7), F.col(text_col)).alias("_text")
    own = docs.select("*", tag)
    rows = materialize(fingerprints(own, shingle_words, id_col, text_col, keep=("_text",)), "simhash")
    keyed = rows.join(rooted(rows, max_bits).select("fp", "root"), "fp").groupBy("root", "doc_id", "_text").agg(F.count("*").alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "_text")
    keyed = materialize(keyed.withColumn("place", place), "simhash-rows")
    first = keyed.groupBy("root").agg(F.min("place").alias("first"))
    keyed = keyed.join(first, "root").select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "n", (F.col("place") == F.col("first")).alias("stays"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    left = own.join(keyed.filter("NOT stays"), same, "left_anti")
    twice = materialize(keyed.filter("stays AND n > 1"), "repeated")
    if twice.isEmpty():
        return left.select(docs.columns)
    again = left.join(twice, same, "left_semi").groupBy(F.col(id_col).alias("_id"), F.col("_text").alias("_hash")).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_doc"))
    return left.join(twice, same, "left_anti").select(docs.columns).unionByName(again.select("_doc.*"))


def hex16(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


ship_by_value(__name__)
