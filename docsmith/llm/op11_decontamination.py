"""Benchmark decontamination by one Aho-Corasick automaton.

Every window of ``size`` consecutive words of the normalised test questions and
answers is a pattern (an item of fewer words is one window).  A word is one
symbol of the automaton, so that it has a node for each word of a window, not
for each character; words that no item has are one symbol more.  A task
normalises a text, runs the automaton over it once, unites the windows found to
spans of words, and maps these to code points of the original text.

Spark cuts the items into windows and deals them into blocks of about
``max_windows`` (window, item) pairs.  One block's automaton is broadcast at a
time, so its size is bounded whatever the benchmark has; a benchmark of several
blocks reads the documents once for each, and their finds meet by row, of which
only those with a find are shuffled.

Defined results: a null or empty text has no words and no span; a null or empty
item has no window; a null item id hits but is not listed; rows that repeat an
item id are one item; rows that repeat id and text get the same result each; an
empty benchmark hits nothing; an empty table gives an empty result; other
columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value
from docsmith.llm.plain_words import folded, words_of
from docsmith.session import materialize

WINDOW = 10
#: (window, item) pairs of one automaton, which has at most WINDOW nodes for each.
MAX_WINDOWS = 100_000
SPAN = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
SCANNED = "doc_id long, text_hash long, n_words long, n_hit long, spans array<struct<first_word:long,last_word:long,start:long,end:long>>, items array<string>"


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, item): distinct windows, words joined by spaces, of each item."""
    own = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("words", i, size), " "))
    return own.select("item", F.explode(F.array_distinct(cut)).alias("window")).distinct()


class Patterns:
    """The automaton of windows, and of each window its words and items."""

    def __init__(self, pairs: list[tuple[str, str | None]]):
        import ahocorasick

        by_window: dict[str, list[str]] = {}
        for window, item in pairs:
            by_window.setdefault(window, []).extend([] if item is None else [item])
        self.symbols: dict[bytes, str] = {}
        self.items = [sorted(set(x)) for x in by_window.values()]
        self.sizes = [w.count(" ") + 1 for w in by_window]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, window in enumerate(by_window):
            self.automaton.add_word("".join([self._symbol(w) for w in window.encode().split(b" ")]), k)
        self.automaton.make_automaton()

    def _symbol(self, word: bytes) -> str:
        if word not in self.symbols:
            n = len(self.symbols) + 1  # 0: any other word
            self.symbols[word] = chr(n if n < 0xD800 else n + 0x800)  # surrogates are no characters
        return self.symbols[word]

    def find(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """(intervals of hit words, disjoint and in order, last exclusive; items found)."""
        if not self.items:
            return np.empty((0, 2), np.int64), []
        get = self.symbols.get
        found = list(self.automaton.iter("".join([get(w, "\0") for w in words])))
        if not found:
            return np.empty((0, 2), np.int64), []
        last, which = np.array(found, np.int64).T
        spans = united(last + 1 - np.array(self.sizes)[which], last + 1)
        return spans, sorted(set().union(*[self.items[k] for k in np.unique(which)]))


def united(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The union of intervals as disjoint ones, those that touch joined."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    return np.stack([first[new], last[np.append(new[1:], True)]], axis=1)


def original_offsets(bytes_folded: bytes, spans: np.ndarray) -> np.ndarray:
    """(start, end) in code points of the original text of intervals of words.
    Folding keeps each byte at its place, so that places need no second text."""
    raw = np.frombuffer(bytes_folded, np.uint8)
    inside = np.concatenate([[False], raw != 0x20, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # word starts and ends in turn
    char = np.cumsum(np.append((raw & 0xC0) != 0x80, True)) - 1  # code point of a byte
    return np.stack([char[edges[0::2][spans[:, 0]]], char[edges[1::2][spans[:, 1] - 1]]], axis=1)


def _scan(rows: DataFrame, patterns, every: bool) -> DataFrame:
    """SCANNED of ``rows`` (doc_id, text_hash, text); not ``every``: of those with a find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = patterns.value
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(SPAN), pa.list_(pa.string()))
        names = ["doc_id", "text_hash", "n_words", "n_hit", "spans", "items"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = folded(text.as_py())
                words = text.split()
                spans, items = own.find(words)
                if not every and not len(spans):
                    continue
                places = np.hstack([spans, original_offsets(text, spans)]).tolist() if len(spans) else []
                row = (doc_id, text_hash, len(words), int((spans[:, 1] - spans[:, 0]).sum()), [dict(zip(SPAN.names, s, strict=True)) for s in places], items)
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return rows.mapInArrow(run, SCANNED)


def _unite_spans(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch joined."""
    def step(done, s):
        end = F.element_at(done, -1)
        longer = F.struct(end["first_word"].alias("first_word"), F.greatest(end["last_word"], s["last_word"]).alias("last_word"),
                          end["start"].alias("start"), F.greatest(end["end"], s["end"]).alias("end"))
        joins = (F.size(done) > 0) & (s["first_word"] <= F.try_element_at(done, F.lit(-1))["last_word"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    none = F.array().cast("array<struct<first_word:bigint,last_word:bigint,start:bigint,end:bigint>>")
    return F.aggregate(F.array_sort(spans), none, step)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_windows: int = MAX_WINDOWS, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_words, n_hit, spans, items).  A span is a run of hit
    words: its words, from 0, and its code points, ends exclusive."""
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.lit(11), text).alias("text_hash"), text.alias("text"))
    pairs = materialize(windows(benchmark, size, item_col, item_text_col), "benchmark-windows")
    blocks = max(1, -(-pairs.count() // max_windows))
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    found: list[DataFrame] = []
    for k in range(blocks):
        block = [(r["window"], r["item"]) for r in dealt.filter(F.col("block") == k).select("window", "item").collect()]  # about max_windows rows
        scanned = _scan(rows, spark.sparkContext.broadcast(Patterns(block)), every=k == 0)
        found.append(scanned if blocks == 1 else materialize(scanned, "contamination"))
    if blocks == 1:
        return found[0].drop("text_hash")
    every, hits = found[0], found[0].filter("n_hit > 0")
    for more in found[1:]:
        hits = hits.unionByName(more)
    key = ["doc_id", "text_hash"]
    hits = hits.select(*key, "spans", "items").distinct().groupBy(*key).agg(
        _unite_spans(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    same = F.col("e.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("e.text_hash") == F.col("h.text_hash"))
    n_hit = F.aggregate("h.spans", F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"])
    return every.alias("e").join(hits.alias("h"), same, "left").select(
        "e.doc_id", "n_words", F.coalesce(n_hit, F.lit(0)).alias("n_hit"), F.coalesce("h.spans", "e.spans").alias("spans"), F.coalesce("h.items", "e.items").alias("items"))


ship_by_value(__name__)
