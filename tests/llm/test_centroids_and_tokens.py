"""Centroid search, token counts by merging and token alignment against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from resalelake.llm import alignment, centroids, token_counts
from resalelake.llm.common import written

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["a", "b", " ", "  ", "\n", "'s", "<s>", "<|endoftext|>", "é", "1", "\x1c", "　", "▁", "!", "the", " the", "日本", "\x85", "\t", "ﬁ", "\x00"]
CLASH = ("v", "n", "s0", "cluster", "distance", "chunk", "pair", "copy", "unit", "label", "lang")


# Centroids


@pytest.mark.parametrize("reach", [1, 20, 10**6, centroids.LARGEST])
@pytest.mark.parametrize("k", [1, 7, 150])
def test_search_finds_the_nearest_and_skips_some(reach, k):
    rng = np.random.default_rng(k)
    points = rng.integers(-reach, reach + 1, (1500, 8))
    centres = np.concatenate([points[:k], points[: k // 2]])
    search = centroids.Search(centres)
    number, distance = search.nearest(points)
    every = ((points[:, None] - centres[None]) ** 2).sum(axis=-1)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    assert k < 100 or search.exact < 0.8 * len(points) * len(centres)


def clusters_by_hand(rows, k, rounds, dims):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) and abs(64 * x) <= centroids.LARGEST for x in vector):
            kept.append((vec_id, [math.floor(64 * x) for x in vector]))
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centres = [v for _, v in first]

    def assigned():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assigned()
        for n in range(len(centres)):
            own = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if own:
                centres[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assigned()
    sums = collections.Counter()
    for d, n in found:
        sums[n] += d
    return sorted((str(i), n, d, sums[n], sum(sums.values()), centres[n]) for (i, _), (d, n) in zip(kept, found))


@pytest.mark.parametrize("dims, k", [(4, 3), (64, 16), (4, 500)])
def test_clusters(spark, dims, k):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dims)]) for i in range(150)]
    rows += [(i % 3, rows[0][1]) for i in range(60)] + [(None, rows[1][1]), (-7, [-0.001] * dims), (900, [0.0] * dims), (901, [1e3] * dims)]
    rows += [(1, None), (2, []), (3, [1.0] * (dims - 1)), (4, [None] + [1.0] * (dims - 1)), (5, [math.nan] * dims), (6, [math.inf] * dims), (7, [1e300] * dims)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).withColumns({c: F.lit(-1) for c in CLASH})
    found = centroids.clustered(df, k=k, dims=dims).collect()
    got = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in found)
    assert got == clusters_by_hand(rows, k, centroids.ROUNDS, dims)
    assert centroids.clustered(df.limit(0)).count() == 0


# Token counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(A)


def test_cuts_agree_for_every_character(library):
    texts = [f"a{chr(c)}b {chr(c)}1 {chr(c)}" for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    counter = token_counts.MergeCounter(A)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.one_of(st.sampled_from(WORDS), st.text(max_size=4)), max_size=25).map("".join))
def test_any_text_counts_as_the_library_encodes(library, text):
    assert _COUNTER.count(text) == len(library.encode(text, add_special_tokens=False).ids)


_COUNTER = token_counts.MergeCounter(A)


def test_token_counts(spark, library, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices(WORDS, k=rng.randrange(40))) for _ in range(300)] + [None, "", "a" * 30_000, "ab " * 9_000, " " * 2_000, "x" * 513]
    rows = [(None if i == 7 else i % 290, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(-1) for c in CLASH})
    want = sorted((str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.counted(df, A).collect()) == want
    assert token_counts.counted(df.limit(0), A).count() == 0
    monkeypatch.setattr(token_counts, "KEPT", 3)  # tables that start anew all the time
    counter = token_counts.MergeCounter(A)
    assert [counter.count(t or "") for _, t in rows] == [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]


# Alignment


def tokens_by_hand(text):
    """(id, start, end) of either side, or nothing."""
    a = Tokenizer.from_file(A) if not _TOKENIZERS else _TOKENIZERS[0]
    b = SentencePieceProcessor(model_file=B) if not _TOKENIZERS else _TOKENIZERS[1]
    if not _TOKENIZERS:
        a.encode_special_tokens = True
        _TOKENIZERS[:] = [a, b, alignment.Aligner(A, B)]
    aligner, out = _TOKENIZERS[2], []
    for ids, table in ((a.encode(" " + text, add_special_tokens=False).ids, aligner.a_bytes), (b.encode(text), aligner.b_bytes)) if text else ():
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return [], []
        at, side = 0, []
        for i in ids:
            side.append((i, at, at := at + len(table[i])))
        out.append(side)
    return tuple(out) or ([], [])


_TOKENIZERS: list = []


def alignment_by_hand(texts):
    rows, count = [], collections.Counter()
    for text in texts:
        a, b = tokens_by_hand(text or "")
        pairs = [(i, j) for i, _, end in a for j, _, other in b if end == other] if len(a) < 400 else [(i, dict((e, j) for j, _, e in b)[end]) for i, _, end in a if end in {e for _, _, e in b}]
        ends, groups = {e for _, _, e in a} & {e for _, _, e in b}, []
        for low, high in zip([0, *sorted(ends)], sorted(ends)):
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)))
        count.update(pairs)
        rows.append((len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = collections.Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(a, b, g, len(p), sum(count[x] == most[x[1]] for x in p), sum(count[x] for x in p), h) for a, b, g, p, h in rows]


@pytest.mark.parametrize("chunk", [300, 1 << 20])
def test_alignment(spark, chunk):
    rng = random.Random(9)
    texts = ["".join(rng.choices([*WORDS, "word ", "Wörter "], k=rng.randrange(14))) for _ in range(400)]
    texts += [None, "", "the same words", "the same words", "日本語 " * 20, "ab " * 60, " " * 90, "x" * 300, "<s></s><unk> [PAD] ▁"]
    rows = [(None if i == 3 else i % 390, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(-1) for c in CLASH})
    names = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    got = sorted((str(r.doc_id), *(r[c] for c in names)) for r in alignment.aligned(df, A, B, chunk=chunk).collect())
    assert got == sorted((str(i), *found) for (i, _), found in zip(rows, alignment_by_hand(texts)))
    assert sum(r[1] == 0 for r in got) > 20 and sum(r[5] < r[4] for r in got) > 20
    assert alignment.aligned(df.limit(0), A, B).count() == 0


def test_chunks_are_moved_in_small_parts(spark, monkeypatch):
    """One long text, and many texts with as many units: no row holds a whole chunk, and results are those of chunks of few texts."""
    rng, seen = random.Random(5), []
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(40_000)]
    texts = [" ".join(words), *(" ".join(words[i : i + 400]) for i in range(0, 40_000, 400)), None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def kept(frame, label):
        seen.append(written(frame, label))
        return seen[-1]

    monkeypatch.setattr(alignment, "written", kept)
    got, apart = (sorted(map(tuple, alignment.aligned(df, A, B, chunk=chunk).collect())) for chunk in (10 << 20, 1 << 13))
    assert got == apart and len(got) == len(texts) and got[0][4] > 40_000
    whole = seen[0].groupBy("chunk").agg(F.count("part").alias("parts"), F.sum(F.length("units")).alias("bytes")).collect()
    assert [(r.parts > 2, r.bytes) for r in whole] == [(True, 4 * 80_000)]  # a unit of every word, once in the long text and once in the short ones
    sizes = seen[0].select(sum(F.length(c) for c in ("doc_units", "units", "unit_links", "links")) + 16 * F.size("pairs")).collect()
    assert max(r[0] for r in sizes) <= alignment.PART


def test_links_by_bytes_and_by_groups(spark):
    texts = ["unbelievably long words, 1234567!", "日本語テキスト x", "", None, "a\tb  c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for kind in ("bytes", "groups"):
        want = set()
        for n, text in enumerate(texts):
            a, b = tokens_by_hand(text or "")
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            for p, (i, s, e) in enumerate(a):
                for q, (j, t, f) in enumerate(b):
                    shared = max(0, min(e, f) - max(s, t)) if kind == "bytes" else int(sum(c < e for c in cuts) == sum(c < f for c in cuts))
                    if shared:
                        want.add((n, p, q, i, j, s, e, t, f, shared))
        rows = alignment.links(df, A, B, kind).collect()
        assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    with pytest.raises(ValueError):
        alignment.links(df, A, B, "other")


def test_products_equal_dense_ones_in_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    for most in (1 << 22, 7):
        monkeypatch.setattr(alignment, "BLOCK_LINKS", most)
        for rows, inner, width in ((9, 7, 5), (1, 1, 1), (30, 12, 40)):
            dense = [rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((rows, inner), (inner, width))]
            sparse = []
            for m in dense:
                r, c = np.nonzero(m)
                sparse.append(alignment.Csr(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(m)))]), c, m[r, c], m.shape[1]))
            out = np.zeros((rows, width), int)
            for i, j, value in sparse[0].times(sparse[1]):
                out[i, j] += value
            assert (out == dense[0] @ dense[1]).all()
            back = sparse[0].transposed()
            assert (np.repeat(np.arange(inner), np.diff(back.starts)) == np.nonzero(dense[0].T)[0]).all() and (back.columns == np.nonzero(dense[0].T)[1]).all()
