"""Operators 11 to 13 against plain Python, on the awkward rows of the other
operators' tests and on rows that meet each bound of theirs."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsmith.llm import op11_decontamination as o11
from docsmith.llm import op12_alignment as o12
from docsmith.llm import op13_lexical_search as o13
from tests.llm.test_operators import PROSE, TEXTS, bag, docs, empty  # noqa: F401


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# 11 ----------------------------------------------------------------------
ITEMS = [
    (1, "The ser of the nation; and the land was OVER. It is"),  # ten words and two more
    (2, "nation and the land was over it is for the man that on the hill"),
    (3, "gnu general"),  # one short window
    (4, None),
    (5, "... --- ..."),
    (6, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11"),
    (6, "word2990 word2991 word2992 word2993 word2994 word2995 word2996 word2997 word2998 word2999"),
    (None, "\U0001f600 wörds äöü"),
    (7, "Ünicode"),
    (8, "nothing of this is in any text whatever it may be there"),
    (9, "one two"),
    (9, "one two"),
    (10, "wörds äöü Ünicode"),
]


def plain_contamination(text, size):
    words, hit, found, own = plain_words(text), set(), set(), text or ""
    for item, t in ITEMS:
        w = plain_words(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            x = w[i : i + size]
            for at in range(len(words) - len(x) + 1):
                if words[at : at + len(x)] == x:
                    hit |= set(range(at, at + len(x)))
                    found.add(item)
    ends = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", own)]
    spans = []
    for at in sorted(hit):
        if spans and spans[-1][1] == at:
            spans[-1][1], spans[-1][3] = at + 1, ends[at][1]
        else:
            spans.append([at, at + 1, *ends[at]])
    return len(words), len(hit), tuple(map(tuple, spans)), tuple(sorted(str(x) for x in found if x is not None))


@pytest.mark.parametrize("max_windows", [100_000, 4])
def test_contamination(spark, docs, empty, max_windows):  # noqa: F811
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit("x") for c in ("window", "item", "words", "block")})
    got = o11.contamination(docs, items, max_windows=max_windows).collect()
    assert bag((r.doc_id, r.n_words, r.n_hit, tuple(map(tuple, r.spans)), tuple(r["items"])) for r in got) == bag((i, *plain_contamination(t, o11.WINDOW)) for i, t in TEXTS)
    assert {r.doc_id for r in got if r.n_hit} >= {1, 2, 6, 7, 9, 10}
    assert o11.contamination(empty, items, max_windows=max_windows).collect() == []


def test_contamination_by_nothing(spark, docs):  # noqa: F811
    none = spark.createDataFrame([], "item_id long, text string")
    rows = o11.contamination(docs, none).collect()
    assert len(rows) == len(TEXTS) and not any(r.n_hit or r.spans or r["items"] for r in rows)


def test_united_intervals():
    rng = np.random.default_rng(11)
    for _ in range(200):
        first = rng.integers(0, 30, rng.integers(1, 9))
        last = first + rng.integers(1, 6, len(first))
        got = o11.united(first, last)
        assert {x for a, b in got for x in range(a, b)} == {x for a, b in zip(first, last, strict=True) for x in range(a, b)}
        assert (got[1:, 0] > got[:-1, 1]).all()


# 12 ----------------------------------------------------------------------
def plain_merge(a, b):
    """Overlaps of tokens with the given ends, by two pointers."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        out.append((i, j, a[i] == b[j]))
        i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
    return out


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_merge_path_is_the_merge(work):
    rng = np.random.default_rng(work)
    for size in (1, 2, 5, 40, 200):
        for share in (0.1, 0.5, 0.9):
            a, b = (np.append(np.flatnonzero(rng.random(size) < share) + 1, size + 1) for _ in range(2))
            found = o12.merge_path(a, b, work)
            assert list(zip(found.a.tolist(), found.b.tolist(), found.both.tolist(), strict=True)) == plain_merge(a.tolist(), b.tolist())
    assert len(o12.merge_path(np.empty(0, np.int64), np.empty(0, np.int64), work).a) == 0


def test_pieces_have_equal_work():
    rng = np.random.default_rng(12)
    a, b = np.arange(1, 10_001), np.unique(rng.integers(1, 10_000, 300))  # one long side
    diagonals = np.arange(0, len(a) + len(b), 128)
    i = o12.split_points(a, b, diagonals)
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    assert i.tolist() == [sum(1 for x in merged[:d] if x[1] == 0) for d in diagonals]
    assert (np.diff(i) + np.diff(diagonals - i) == 128).all()


MORE = [
    (50, "<|endoftext|> is text, <s> and </s> and <unk> and <0x41> too"),
    (51, "a piece sign ▁ in the text"),
    (52, "ﬁ ligature, full　width Ａ and é"),
    (53, " leading and trailing  "),
    (54, "same words same words same words"),
    (55, "same words same words same words"),
    (56, "\n"),
    (57, "日本語のテキスト ελληνικά кириллица"),
    (58, "x" + " " * 3000 + "y" + "\n" * 3000),
]


@pytest.fixture(scope="module")
def tokens():
    """id lists of both tokenizers from their own files, and bytes of each id."""
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    a = Tokenizer.from_file(public.path(o12.A_TOKENS))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path(o12.B_TOKENS))
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves in the file
    byte = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
    assert set(byte) == set(pre_tokenizers.ByteLevel.alphabet())
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}
    b_bytes = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in range(len(b)))]
    return lambda t: a.encode(t, add_special_tokens=False).ids, b.encode, a_bytes, b_bytes


def plain_alignment(rows, tokens):
    a_ids, b_ids, a_bytes, b_bytes = tokens
    counts, out = Counter(), []
    for i, t in rows:
        a, b = (a_ids(" " + t), b_ids(t)) if t else ([], [])
        if t and not b"".join(a_bytes[x] for x in a) == b"".join(b_bytes[x] for x in b) == (" " + t).encode():
            a, b = [], []
        ends_b = {e: j for j, e in enumerate(np.cumsum([len(b_bytes[x]) for x in b]).tolist())}
        groups, links, x, y = [], [], 0, 0
        for k, e in enumerate(np.cumsum([len(a_bytes[x]) for x in a]).tolist()):
            if e in ends_b:
                j = ends_b[e]
                groups.append(",".join(map(str, a[x : k + 1])) + "|" + ",".join(map(str, b[y : j + 1])))
                links.append((a[k], b[j]))
                x, y = k + 1, j + 1
        counts.update(links)
        out.append((i, len(a), len(b), len(groups), ";".join(groups), links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(i, a, b, n, len(links), a + b - len(links), text, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links)) for i, a, b, n, text, links in out]


@pytest.mark.parametrize("work", [o12.WORK, 5])
def test_alignment(spark, docs, empty, tokens, work):  # noqa: F811
    rows = [*TEXTS, *MORE]
    both = docs.select("doc_id", "text", F.lit("x").alias("links"), F.lit("x").alias("groups")).unionByName(
        spark.createDataFrame([(i, t, "x", "x") for i, t in MORE], "doc_id long, text string, links string, groups string"))
    got = o12.alignment(both, work=work).collect()
    want = plain_alignment(rows, tokens)
    assert bag(got) == bag(want)
    zero = {i for i, *x in want if not x[0]}
    assert {3, 4, 51} <= zero and not {50, 53, 54, 57, 58} & zero
    digests = {r.doc_id: r.groups for r in o12.align(both.filter("doc_id >= 50"), digest=True).collect()}
    assert digests == {i: hashlib.sha256(x[5].encode()).hexdigest() if x[0] else "" for i, *x in want if i is not None and i >= 50}
    assert o12.alignment(empty).collect() == []


def test_linked_tokens_are_linkable(tokens):
    _, _, a, b = tokens
    first = [a.get(i, b"") for i in range(max(a) + 1)]
    assert o12.a_bytes()[: len(first)] == first and o12.b_bytes() == b
    keys = o12.linkable(o12.a_bytes(), b)
    assert (np.diff(keys) > 0).all() and len(keys) <= sum(map(len, first)) * 2 + sum(map(len, b)) * 2
    some = set(keys.tolist())
    rng = np.random.default_rng(3)
    for i, j in zip(rng.integers(0, 50_000, 30_000).tolist(), rng.integers(3, 32_000, 30_000).tolist(), strict=True):
        ends = first[i] and b[j] and (first[i].endswith(b[j]) or b[j].endswith(first[i]))
        assert bool(ends) == (i * len(b) + j in some)


# 13 ----------------------------------------------------------------------
def plain_search(rows, queries, top):
    own = [(k, i, Counter(plain_words(t)), len(plain_words(t))) for k, (i, t) in enumerate(rows)]
    n_docs, n_terms = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    df = Counter(w for *_, c, _ in own for w in c)
    out = []
    for item, t in queries:
        scored = []
        for _, i, c, n in own:
            score = 0
            for w in plain_words(t):
                if c[w]:
                    m = 100 - 25 + (25 * n * n_docs) // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if x[1] else x[2], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return out


@pytest.mark.parametrize(("bucket", "max_terms", "top"), [(o13.BUCKET, o13.MAX_TERMS, 20), (3, o13.MAX_TERMS, 4), (2, 9, 3)])
def test_search(spark, docs, empty, bucket, max_terms, top):  # noqa: F811
    queries = [*ITEMS, (11, PROSE), (12, "the the the land"), (13, "unheard"), (14, "it is")]
    items = spark.createDataFrame(queries, "item_id long, text string").withColumns({c: F.lit("x") for c in ("words", "item", "query", "rank", "score")})
    got = o13.search(docs, items, top=top, max_terms=max_terms, bucket=bucket)
    assert bag(got.collect()) == bag(plain_search(TEXTS, queries, top))
    assert o13.search(empty, items, top=top).collect() == [] and o13.search(docs, items.filter("false")).collect() == []


@pytest.mark.parametrize("bucket", [16, 200])
def test_search_prunes_nothing_that_counts(spark, bucket):
    """Many texts of all lengths, with ties: bounds and thresholds are at work."""
    rng = np.random.default_rng(bucket)
    words = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    share /= share.sum()
    texts = [" ".join(rng.choice(words, int(n), p=share)) for n in rng.lognormal(3.5, 1, 700)]
    texts += texts[:60] * 3  # copies: equal scores
    rows = [(i, t) for i, t in enumerate(texts)]
    queries = [(i, " ".join(rng.choice(words, 12, p=share))) for i in range(12)] + [(20, " ".join(texts[5].split()[:30]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    got = o13.search(df, spark.createDataFrame(queries, "item_id long, text string"), bucket=bucket).collect()
    assert bag(got) == bag(plain_search(rows, queries, o13.TOP))


def test_survivors_are_few():
    """A threshold near the best score leaves few vectors to rescore, and none of
    the best is lost."""
    import pyarrow as pa

    rng = np.random.default_rng(7)
    n, terms = 500, 60
    lists = [sorted(rng.choice(terms, int(rng.integers(1, 20)), replace=False).tolist()) for _ in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(rng.integers(20, 400, n)), pa.array(lists, pa.list_(pa.int32())), pa.array([[int(rng.integers(1, 4)) for _ in x] for x in lists], pa.list_(pa.int32()))], names=["n", "terms", "tfs"])
    query = (np.arange(0, 60, 6), np.ones(10, np.int64))
    queries = o13.Queries([query], rng.integers(100, 5000, terms), n, int(np.sum(batch.column("n").to_numpy())))
    here = o13.Bucket(o13.Vectors(batch, queries))
    rows, scores = here.survivors(*query, 0)
    for k in (1, 5, 20):
        least = int(np.sort(scores)[-k])
        found, exact = here.survivors(*query, least)
        assert set(found.tolist()) == set(rows[scores >= least].tolist()) and sorted(exact) == sorted(scores[scores >= least])
    assert len(here.survivors(*query, int(scores.max()) + 1)[0]) == 0
