"""Helpers: word spans, span hashes, slices of batches, connected components, packed ids, best fit, tokens."""

import random
import time
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from resalelake.llm import bitpack, common, packing, tokens
from resalelake.llm.components import components, joined_labels

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z9é\n\t ", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_spans_are_the_words_of_each_text(texts):
    raw, offsets = common.text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = common.spans(common.LOWER[raw], offsets, common.ALNUM)
    found = [[common.LOWER[raw][a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first, first[1:])]
    want = [re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower()) for t in texts]
    assert found == want


def test_equal_spans_hash_alike_anywhere():
    raw = np.frombuffer(b"one two one twoone", np.uint8)
    a = common.span_hashes(raw, np.array([0, 8, 15, 4]), np.array([3, 11, 18, 7]))
    b = common.span_hashes(np.frombuffer(b"xone", np.uint8), np.array([1]), np.array([4]))
    assert a[0] == a[1] == a[2] == b[0] != a[3]


def test_slices_bound_bytes_and_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 900, 3, None or 0, 40)] + [None]})
    parts = list(common.slices(iter([batch]), "text", 50))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column("text").to_pylist()) <= 50 for p in parts)


def union_find(n, edges):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_joined_labels(seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(50)]
    got = joined_labels(np.arange(60), np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
    assert got.tolist() == union_find(60, edges)


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(40)]
    rng.shuffle(chain)
    edges = chain + [(50, k) for k in range(51, 60)] + [(70, 70), (61, 60), (60, 61)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = union_find(71, edges)
    assert {r.node: r.root for r in rows} == {n: w for n, w in enumerate(want) if n != w}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("width", [1, 7, 8, 13, 16, 17, 32])
def test_packing_bits_is_exact_and_tight(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 999).astype("<u4")
    data = bitpack.packed(ids, width)
    assert len(data) == -(-999 * width // 8)
    assert (bitpack.unpacked(data, width, 999) == ids).all()
    assert bitpack.width_of(1 << width) == width


def test_id_file_random_access(tmp_path):
    rng = np.random.default_rng(0)
    documents = [rng.integers(0, 49408, n).astype("<u4") for n in (3, 70_000, 1, 140_000, 5)]
    out = bitpack.Writer(f"{tmp_path}/x.ids", 16)
    for n, ids in enumerate(documents):
        out.add(None if n == 0 else n, ids)
    out.close()
    reader, whole = bitpack.Reader(f"{tmp_path}/x.ids"), np.concatenate(documents)
    for start, stop in ((0, 1), (65_535, 65_537), (1000, 200_000), (len(whole) - 1, len(whole)), (7, 7)):
        assert (reader.read(start, stop) == whole[start:stop]).all()
    got = list(reader.documents())
    assert [g[0] for g in got] == [None, 1, 2, 3, 4]
    assert all((g[2] == d).all() for g, d in zip(got, documents))
    with pytest.raises(ValueError):
        (tmp_path / "bad").write_bytes(b"\0" * 64)
        bitpack.Reader(f"{tmp_path}/bad")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 8))
def test_best_fit_never_overfills_and_picks_the_tightest(lengths, open_bins):
    fit, used = packing.BestFit(64, open_bins), {}
    for length in lengths:
        rooms = [room for room, bins in enumerate(fit.by_room) if bins and room >= length]
        bin_, offset = fit.place(length)
        assert used.get(bin_, 0) == offset
        if rooms:
            assert 64 - offset == min(rooms)
        used[bin_] = offset + length
        assert used[bin_] <= 64 and fit.open <= open_bins


def test_pieces():
    assert packing.pieces(1, 4) == [(0, 1)]
    assert packing.pieces(8, 4) == [(0, 4), (4, 4)]
    assert packing.pieces(9, 4) == [(0, 1), (1, 4), (5, 4)]


HARD = ["x<|endoftext|>", "a.<|endoftext|>. b<|endoftext|", "rock'n.. it's, 1,2;3. é. —.. a—. x\u0301. ok?!#", "", " ", "  ", "a", " a", "a ", "a  b", "a   b \n c", "\n\n x\t y  \n", "it's 'll don't  'm", "<|endoftext|> a <|startoftext|>b", "\x1c b \x1cc\x85", "Ünï İI ΑΣ Σ σς", "a　 b \xa0c", " \r\n a", "x́ ́y é"]


@pytest.mark.parametrize("name,leading", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_encoding_equals_whole_texts(name, leading):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(name))
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("aé'9.  \n \xa0Z") for _ in range(40)) for _ in range(300)]
    want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    encode = tokens.Encoder(public_tokenizers.path(name), leading)
    for _ in range(2):
        assert encode.encode([t.encode() for t in texts]) == want
        encode.kept = tokens.CACHE_BYTES + 1  # the cache starts anew


@pytest.mark.parametrize("name,leading", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_special_tokens_as_the_library_encodes_them(name, leading):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(name))
    rng = random.Random(2)
    parts = ["<|endoftext|>", "<|startoftext|>", " ", "  ", "a", " b", "\n", "\xa0", "é."]
    texts = HARD + ["".join(rng.choice(parts) for _ in range(12)) for _ in range(300)]
    want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    with tokens.encoding(public_tokenizers.path(name), leading) as encoder:
        assert encoder.encode([t.encode() for t in texts]) == want
    assert encoder.inner  # for a task that follows at once
    with tokens.encoding(public_tokenizers.path(name), leading) as again:
        assert again is encoder
        time.sleep(1.5 * tokens.IDLE)
        assert encoder.inner
    time.sleep(2 * tokens.IDLE)
    assert not encoder.inner and not encoder.kept


def test_byte_level_units_are_encoded_side_by_side(monkeypatch):
    """What the library gets is no longer than the units and their spaces, and tokens that do not cover the bytes are noticed."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(4)
    texts = HARD + [" ".join("".join(rng.choice("aeé9'.,\nß") for _ in range(rng.randint(1, 9))) for _ in range(200)) for _ in range(20)]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    sent, ids = [], tokens.Encoder._ids
    monkeypatch.setattr(tokens.Encoder, "_ids", lambda self, text: sent.append(text) or ids(self, text))
    encoder = tokens.Encoder(path, True)
    encoder.encode([b""] + [t.encode() for t in texts[len(HARD) :]])
    units = {u for t in texts[len(HARD) :] for u in t.encode().split(b" ")}
    assert sum(map(len, sent)) < sum(len(u) + 1 for u in units) + sum(len(encoder.between) + len(u) for u in [*encoder.first, *encoder.endings])
    assert encoder.encode([t.encode() for t in texts]) == want
    other = tokens.Encoder(path, True)
    other.bytes_of += np.arange(len(other.bytes_of)) % 2
    assert other._side_by_side([b"one", b"two", "é".encode()], b" ") is None
    assert other.encode([t.encode() for t in texts]) == want


@pytest.mark.parametrize("name,leading", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_units_of_letters_go_to_the_model_as_pieces(monkeypatch, name, leading):
    """Neither line feeds nor punctuation make a word new, and only what is not made of letters meets normalizer and pattern."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    rng = random.Random(5)
    words = ["".join(rng.choice("aeBZéÀßØÿ") for _ in range(rng.randint(3, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", ".", ",", ".\n" + rng.choice(words), "\n" + rng.choice(words)]) for _ in range(99)) for _ in range(30)]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    sent, ids = [], tokens.Encoder._ids
    monkeypatch.setattr(tokens.Encoder, "_ids", lambda self, text: sent.append(text) or ids(self, text))
    encoder = tokens.Encoder(path, leading)
    assert encoder.encode([t.encode() for t in texts]) == want
    assert len(sent) <= 2 and sum(map(len, sent)) < 100
    assert encoder.units <= 2 * len(words) + 3  # after a space and after none, and ".", "," and a line feed
    other = tokens.Encoder(path, leading)
    other.bytes_of += 1
    other.closes[:] = False
    assert other.encode([t.encode() for t in texts]) == want  # ends that the tokens do not show are noticed


_PARTS = st.sampled_from([*"aZ9é÷×ÀÿßσΣİJ.'=<>|-_ \n\t\r\x1c\x85\xa0\u2003\u3000\u0301\u030c\u0338—字🙂", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "word", "  ", ".\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(_PARTS, max_size=25).map("".join), max_size=4))
def test_any_texts_are_encoded_as_the_library_does(texts):
    from tokenizers import Tokenizer

    for name, leading in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        if name not in _ENCODERS:
            path = public_tokenizers.path(name)
            _ENCODERS[name] = Tokenizer.from_file(path), tokens.Encoder(path, leading)
        whole, encoder = _ENCODERS[name]
        want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
        assert encoder.encode([t.encode() for t in texts]) == want


_ENCODERS: dict = {}


def test_probed_lists_find_nearly_every_pair():
    """Pairs just above the threshold, in 400 lists: found when either side probes the other's list."""
    from resalelake.llm import pq

    rng = np.random.default_rng(3)
    points = rng.normal(size=(400 * 50, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    a = points[:2000]
    aside = rng.normal(size=a.shape)
    aside -= (aside * a).sum(axis=1, keepdims=True) * a
    b = 0.931 * a + np.sqrt(1 - 0.931**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    index, reach = pq.Index(points, 400), np.sqrt(2 - 2 * pq.COSINE)
    (own_a, _, _, probes_a), (own_b, _, _, probes_b) = index.coded(a, reach, pq.PROBES), index.coded(b, reach, pq.PROBES)
    found = [x in q or y in p for x, y, p, q in zip(own_a, own_b, probes_a, probes_b)]
    assert np.mean(found) >= 0.99
    every = index.coded(a, reach, 400)[3], index.coded(b, reach, 400)[3]  # the exact way
    assert all(x in q and y in p for x, y, p, q in zip(own_a, own_b, *every))
