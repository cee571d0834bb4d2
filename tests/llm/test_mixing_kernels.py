"""The fast steps of the language model against plain ones."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from resalelake.llm import lm_mixing

ODD = [None, "", " \t\n", "a", "  A\x0bb\x1cC \x85d\xa0E\t\nf\x0c\rg ", "İ İ ÀB àb", "the THE of\nthe", "x" * 5000, "\x00 a\x00 a"]


def test_words_are_those_of_the_lower_cased_bytes():
    words, tokens, sizes = lm_mixing.words_of(pa.array(ODD, pa.string()))
    plain = [(t or "").encode().lower().split() for t in ODD]
    assert sizes.tolist() == [len(p) for p in plain]
    listed = words.to_pylist()
    assert [listed[t] for t in tokens] == [w for p in plain for w in p]
    assert listed == [*dict.fromkeys(w for p in plain for w in p)]
    for some in ([], [None], ["", " "]):
        words, tokens, sizes = lm_mixing.words_of(pa.array(some, pa.string()))
        assert (len(words), len(tokens), sizes.tolist()) == (0, 0, [0] * len(some))


def test_classes_follow_the_most_frequent_short_word():
    rng = random.Random(3)
    vocabulary = [b"a", b"of", b"in", b"the", b"and", b"word", b"longer", b"words"]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(9))] for _ in range(200)] + [[b"a", b"longer"]]
    tokens = np.array([vocabulary.index(w) for t in texts for w in t], np.uint32)
    found = lm_mixing.document_classes(tokens, np.array([len(t) for t in texts]), np.array([len(w) for w in vocabulary]), np.array([zlib.crc32(w) for w in vocabulary], np.uint32))
    for text, kind in zip(texts, found):
        short = collections.Counter(w for w in text if 2 <= len(w) <= 4)
        assert kind == (max((c, zlib.crc32(w)) for w, c in short.items())[1] % lm_mixing.CLASSES if short else 0)


def test_counts_by_class_come_back():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, lm_mixing.CLASSES + 1, 500)
    kinds = np.concatenate([np.arange(n) for n in sizes])
    counted = 1 << rng.integers(0, 59, len(kinds))
    counted[:200] %= 100
    counted[5] = 0
    column = lm_mixing.pairs(kinds, counted, sizes)
    for begin in (0, 17):
        part = column.slice(begin)
        owner, k, n = lm_mixing.from_pairs(part)
        at = sizes[:begin].sum()
        assert (owner == np.repeat(np.arange(500 - begin), sizes[begin:])).all() and (k == kinds[at:]).all() and (n == counted[at:]).all()
    assert len(lm_mixing.pairs(kinds[:0], counted[:0], sizes[:0])) == 0


def plainly_predicted(counts, events, own):
    zero, one = counts[events.slots][..., 0], counts[events.slots][..., 1]
    if own:
        zero, one = np.maximum(zero - (events.bits == 0), 0).astype(np.float32), np.maximum(one - (events.bits == 1), 0).astype(np.float32)
    stretched = np.clip(np.log((one + np.float32(0.4)) / (zero + np.float32(0.4))), -lm_mixing.REACH, lm_mixing.REACH)
    return stretched, np.minimum(np.log2(zero + one + 1).astype(int), lm_mixing.SEEN_LEVELS - 1)


@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("distinct", [1 << 20, 3])
def test_tables_predict_what_the_counts_do(monkeypatch, own, distinct):
    """By numbered pairs of counts, and where too many pairs differ, by slot."""
    monkeypatch.setattr(lm_mixing, "DISTINCT", distinct)
    code = lm_mixing.Code(np.arange(lm_mixing.SYMBOLS))
    counts = np.zeros((lm_mixing.SLOTS, 2), np.float32)
    events = lm_mixing.word_events(code, [b"then", b"there", b"the", b"t", "é".encode()])
    lm_mixing.add_counts(counts, events, np.array([1, 70, 3000, 5, 1], np.float32))
    tables = lm_mixing.Packed(counts).tables(own)
    assert (tables.codes is None) == (distinct == 3)
    stretched, levels = tables.predicted(events, (1, 6))
    want, seen = plainly_predicted(counts, events, own)
    assert (stretched == want).all() and (levels[0] == seen[1]).all() and (levels[1] == seen[6]).all()


def test_pieces_are_the_events_of_all_symbols(monkeypatch):
    monkeypatch.setattr(lm_mixing, "SYMBOLS_AT_ONCE", 5)
    code = lm_mixing.Code(np.arange(lm_mixing.SYMBOLS))
    words = [b"then", b"there", b"a", "é".encode()]
    whole, parts = lm_mixing.word_events(code, words), [*lm_mixing._pieces(code, *lm_mixing._symbols(words))]
    assert len(parts) == 3
    for name, axis in (("slots", 1), ("bits", 0), ("owner", 0)):
        assert (np.concatenate([getattr(p, name) for p in parts], axis=axis) == getattr(whole, name)).all()
    assert not [*lm_mixing._pieces(code, *lm_mixing._symbols([]))]


def test_scores_of_texts_are_those_of_a_plain_loop(monkeypatch):
    """Texts longer than a block, empty ones, and ones that begin with a block."""
    monkeypatch.setattr(lm_mixing, "TOKENS_AT_ONCE", 7)
    rng = np.random.default_rng(5)
    n, sizes = 30, np.array([0, 7, 3, 0, 0, 20, 1, 5, 0])
    tokens, keys = rng.integers(0, n, sizes.sum()).astype(np.uint32), rng.integers(0, 1 << 32, n, dtype=np.uint32)
    by = rng.integers(0, 5, (n, lm_mixing.CLASSES)) * (rng.random((n, 1)) < 0.8)
    c, logs = by.sum(axis=1), np.log10(rng.random((n, lm_mixing.CLASSES)) / 50)
    corpus = lm_mixing.Corpus(int(c.sum()) + 9, int((c > 0).sum()) + 1, 9, 0.7, by.sum(axis=0), (by > 0).sum(axis=0), np.arange(lm_mixing.CLASSES) + 1.0)
    masses = np.bincount(keys % lm_mixing.WORD_CODES, weights=c, minlength=lm_mixing.WORD_CODES)
    code = lm_mixing.Code(masses)
    model = lm_mixing.Words(code, lm_mixing.first_word_weights(), np.linspace(0.1, 0.9, lm_mixing.GATES), rng.integers(0, 9, (lm_mixing.WORD_SLOTS, 2)).astype(np.float32))
    found = lm_mixing.text_scores(model, corpus, masses, logs, c, keys, tokens, sizes)
    want, start = [], 0
    for size in sizes:
        weights, total = 10 ** corpus.shares(), 0.0
        for at in range(start, start + size):
            word = tokens[at]
            p = weights @ 10 ** logs[word] / weights.sum()
            if c[word]:
                symbol = np.array([keys[word] % lm_mixing.WORD_CODES], np.int64)
                foreseen, share = model.predicted(symbol, lm_mixing.histories(keys, tokens, np.array([start]), np.array([at])))
                p = (1 - share[0]) * p + share[0] * (weights @ corpus.known() / weights.sum()) * 10 ** foreseen[0] * c[word] / masses[symbol[0]]
            total += np.log10(p)
            weights = weights * 10 ** logs[word]
        want.append(total)
        start += size
    assert found == pytest.approx(want, rel=1e-9)
