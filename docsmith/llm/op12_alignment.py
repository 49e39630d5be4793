"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes differently.  Merging the ends of A's tokens
with those of B's, both ascending, tells which tokens overlap and where both end
together; there the text falls into groups, the smallest runs of A and B tokens
that cover the same bytes.

1. A task tokenises texts whole and lays the ends of a batch's tokens end to end.
   The merge of A's and B's ends is a path through a grid; a binary search on
   each of its diagonals cuts it into pieces of equal work, however long one text
   or token is.  A piece reads only its own ends and emits its overlaps.  Where
   a diagonal falls between two equal ends, the stitching of neighbouring pieces
   joins the halves; groups are cut at the links of the stitched overlaps.
2. A link is an overlap whose tokens end together.  The shorter one's bytes are
   then the end of the longer one's, so that the vocabularies alone bound the id
   pairs that can be linked (``linkable``, about half a million), and a link is
   written as the number of its pair.
3. Pairs are counted per task, the counts summed by Spark; the table of counts,
   bounded as said, goes back to the tasks, which read the written links.

Defined results: a text that is null or empty, or whose tokens do not give back
its bytes (the piece model normalises some characters), has no tokens: zeros and
no groups; repeated rows count each; null ids pass; an empty table gives an empty
result; other columns are ignored; texts of any length are tokenised whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsmith.llm.byte_bpe import byte_bpe_encoder, byte_ranks
from docsmith.llm.common import ship_by_value
from docsmith.session import materialize

A_TOKENS = "byte_bpe_50k.json"
B_TOKENS = "piece_bpe_32k.model"
#: Merge steps of a piece.
WORK = 1 << 16
#: Characters of texts that a task aligns at once.
BLOCK_CHARS = 1 << 18
SPACE = "▁"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups string, links array<int>"


# Merging ------------------------------------------------------------------
def split_points(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first d of the merge of ``a`` and ``b``
    (ascending; of equal ones, a's first), for each d of ``diagonals``: a binary
    search along each diagonal, all at once."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        i, j = np.minimum(middle, len(a) - 1), np.clip(diagonals - middle - 1, 0, len(b) - 1)
        further = open_ & (a[i] <= b[j])
        low = np.where(further, middle + 1, low)
        high = np.where(open_ & ~further, middle, high)
    return low


class Overlaps(NamedTuple):
    """Token numbers that overlap, in the order of the merge; ``both``: they
    end together."""

    a: np.ndarray
    b: np.ndarray
    both: np.ndarray


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, j0: int) -> Overlaps:
    """Overlaps of a piece of the merge, from its own ends only: each step ends
    a token of one side within the open token of the other.  ``i0``, ``j0``:
    tokens before the piece.  What belongs to its borders is stitched later."""
    at = np.searchsorted(b, a, "left")  # B's token open where A's ends
    both = at < len(b)
    both[both] = b[at[both]] == a[both]
    open_a = np.searchsorted(a, b, "right")
    alone = np.ones(len(b), bool)  # a B end that is also A's was emitted with A's
    some = open_a > 0
    alone[some] = a[open_a[some] - 1] != b[some]
    tokens_a = np.concatenate([np.arange(len(a)), open_a[alone]])
    tokens_b = np.concatenate([at, np.flatnonzero(alone)])
    order = np.argsort(np.concatenate([a, b[alone]]), kind="stable")
    return Overlaps(tokens_a[order] + i0, tokens_b[order] + j0, np.concatenate([both, np.zeros(alone.sum(), bool)])[order])


def stitch(pieces: list[Overlaps], torn: list[bool]) -> Overlaps:
    """One list of overlaps.  ``torn[k]``: the end of A that is last in piece k
    is also the end of B that is first in piece k + 1."""
    for k, cut in enumerate(torn):
        if cut:
            pieces[k].both[-1] = True
            pieces[k + 1] = Overlaps(*(x[1:] for x in pieces[k + 1]))
    return Overlaps(*(np.concatenate(x) for x in zip(*pieces, strict=True))) if pieces else Overlaps(*(np.empty(0, np.int64),) * 2, np.empty(0, bool))


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> Overlaps:
    """All overlaps of tokens with ends ``a`` and ``b`` over the same bytes."""
    diagonals = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    i = split_points(a, b, diagonals)
    j = diagonals - i
    pieces = [piece_overlaps(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]], i[k], j[k]) for k in range(len(i) - 1)]
    torn = [bool(0 < i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]) for k in range(1, len(i) - 1)]
    return stitch(pieces, torn)


# Tokens -------------------------------------------------------------------
def a_bytes(tokenizer: str = A_TOKENS) -> list[bytes]:
    """Bytes of each id of A."""
    by_id = {i: token for token, i in byte_ranks(tokenizer).items()}
    return [by_id.get(i, b"") for i in range(max(by_id) + 1)]


def b_bytes(model: str = B_TOKENS) -> list[bytes]:
    """Bytes of each id of B."""
    sp = _pieces(model)
    names = [sp.id_to_piece(i) for i in range(len(sp))]
    return [bytes([int(x[1:-1], 16)]) if sp.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(names)]


def _pieces(model: str):
    import public_tokenizers as public
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public.path(model))


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Keys a * len(b) + b, ascending, of all id pairs that can end together:
    one's bytes are the end of the other's."""
    by_a: dict[bytes, list[int]] = {}
    by_b: dict[bytes, list[int]] = {}
    for by, tokens in ((by_a, a), (by_b, b)):
        for i, x in enumerate(tokens):
            by.setdefault(x, []).append(i)
    keys = {i * len(b) + j for i, x in enumerate(a) for k in range(len(x)) for j in by_b.get(x[k:], ())}
    keys |= {i * len(b) + j for j, x in enumerate(b) for k in range(len(x)) for i in by_a.get(x[k:], ())}
    return np.array(sorted(keys), np.int64)


class Tokenized(NamedTuple):
    """Tokens of some texts laid end to end; ``n``: tokens of each text."""

    ids: np.ndarray
    ends: np.ndarray
    n: np.ndarray


def _laid(ids: list[np.ndarray], sizes: np.ndarray) -> Tokenized:
    flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
    return Tokenized(flat, np.cumsum(sizes[flat]), np.array([len(x) for x in ids], np.int64))


def _group_texts(a: Tokenized, b: Tokenized, link_a: np.ndarray, link_b: np.ndarray, names: list[str]) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text: every token is written with the sign
    after it (``names``: id * 3 + sign), A's of a group before B's."""
    after_a, after_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    after_a[link_a], after_b[link_b] = 1, 2
    group_a = np.cumsum(after_a) - after_a  # links before a token
    group_b = (np.cumsum(after_b) - after_b) // 2
    out = np.empty(len(a.ids) + len(b.ids), np.int64)
    out[np.arange(len(a.ids)) + np.append(0, link_b + 1)[group_a]] = 3 * a.ids + after_a
    out[np.arange(len(b.ids)) + link_a[group_b] + 1] = 3 * b.ids + after_b
    ends = np.cumsum(a.n + b.n)
    return ["".join([names[c] for c in out[lo:hi].tolist()])[:-1] for lo, hi in zip(np.append(0, ends), ends, strict=False)]


def align(docs: DataFrame, a_tokens: str = A_TOKENS, b_tokens: str = B_TOKENS, digest: bool = False, work: int = WORK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """ALIGNED of every row: token counts, groups as text (``digest``: its
    sha256; no tokens: empty), and the numbers of its links' pairs in ``linkable``."""
    first, second = a_bytes(a_tokens), b_bytes(b_tokens)
    tables = docs.sparkSession.sparkContext.broadcast((first, second, linkable(first, second)))  # bounded by the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        first, second, keys = tables.value
        sizes_a, sizes_b = (np.array([len(x) for x in t], np.int64) for t in (first, second))
        names = [str(i) + sign for i in range(max(len(first), len(second))) for sign in ",|;"]
        encode, pieces = byte_bpe_encoder(a_tokens, special=False), _pieces(b_tokens)
        types = (*[pa.int64()] * 6, pa.string())

        def block(ids: list, texts: list[str]) -> pa.RecordBatch:
            full = [i for i, t in enumerate(texts) if t]
            tokens_b = [np.array(x, np.int64) for x in pieces.encode([texts[i] for i in full], num_threads=1)]
            same = [k for k, i in enumerate(full) if b"".join([second[t] for t in tokens_b[k].tolist()]) == b" " + texts[i].encode()]
            tokens_a = [encode(" " + texts[full[k]]).astype(np.int64) for k in same]  # byte-level: always gives back its bytes
            at = np.array([full[k] for k in same], np.int64)
            a, b = _laid(tokens_a, sizes_a), _laid([tokens_b[k] for k in same], sizes_b)
            found = merge_path(a.ends, b.ends, work)
            link_a, link_b = found.a[found.both], found.b[found.both]
            links_before = np.searchsorted(link_a, np.append(0, np.cumsum(a.n)))
            overlaps_before = np.searchsorted(found.a, np.append(0, np.cumsum(a.n)))
            counts = np.zeros((5, len(texts)), np.int64)
            counts[:, at] = a.n, b.n, np.diff(links_before), np.diff(links_before), np.diff(overlaps_before)
            groups = [""] * len(texts)
            for i, text in zip(at.tolist(), _group_texts(a, b, link_a, link_b, names), strict=True):
                groups[i] = hashlib.sha256(text.encode()).hexdigest() if digest else text
            pairs = np.searchsorted(keys, a.ids[link_a] * len(second) + b.ids[link_b]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts[3])), pa.int32()), pa.array(pairs))
            columns = [pa.array(c, t) for c, t in zip((ids, *counts, groups), types, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, lists], names=[f.split()[0] for f in ALIGNED.split(", ")])

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BLOCK_CHARS:
                    yield block(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield block(ids, texts)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, n_pairs: int) -> DataFrame:
    """(pair, n): links of each pair in all rows, summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_pairs, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_pairs)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], names=["pair", "n"])

    return aligned.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, a_tokens: str = A_TOKENS, b_tokens: str = B_TOKENS, digest: bool = False, work: int = WORK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups, n_best
    (links whose pair is the most linked of its B id, ties included) and
    count_sum (links of all rows of its links' pairs)."""
    aligned = materialize(align(docs, a_tokens, b_tokens, digest, work, id_col, text_col), "aligned")
    second = b_bytes(b_tokens)
    keys = linkable(a_bytes(a_tokens), second)
    counts = np.zeros(len(keys), np.int64)
    summed = pair_counts(aligned, len(keys)).toPandas()  # at most len(keys) rows
    counts[summed["pair"]] = summed["n"]
    most = np.zeros(len(second), np.int64)
    np.maximum.at(most, keys % len(second), counts)
    table = docs.sparkSession.sparkContext.broadcast((counts, counts == most[keys % len(second)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = table.value
        for batch in batches:
            lists = batch.column("links")
            pairs = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            sums = [np.diff(np.append(0, np.cumsum(x[pairs].astype(np.int64)))[ends]) for x in (best, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, sums)], names=[*batch.schema.names[:-1], "n_best", "count_sum"])

    return aligned.mapInArrow(run, ALIGNED.rpartition(", ")[0] + ", n_best long, count_sum long")


ship_by_value(__name__)
