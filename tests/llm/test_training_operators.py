"""Each operator against brute force on small tables with nulls, ties, repeated rows, empty tables and clashing names."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from resalelake.llm import bitpack, line_dedup, lm_mixing, packing, pq, sharding, simhash, toxicity, warc, winnow

DOCS = "doc_id long, text string"
#: Columns named like those that operators use themselves.
CLASH = {"fp": 1, "k1": 2, "shard": 3, "block": 4, "bytes": 5, "start": 6, "hash": 7, "n": 8, "text_crc32": 9}


def frame(spark, rows, schema=DOCS, clash=True):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}) if clash else df


def texts_with_everything(seed=0, words=12, docs=40):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for k in range(docs)]
    rows += [(100, None), (101, ""), (102, rows[3][1]), (102, rows[3][1]), (None, "w1 w2 w3"), (103, rows[5][1] + " É x"), (104, "w1 " * 3000)]
    return rows


# Line dedup


def lines_by_hand(rows):
    """First occurrences in (id, text, position) order; rows repeated in full are one."""
    seen, out = {}, {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] if r[0] is not None else -(1 << 63), str(r[1]))):
        lines = [] if text is None else text.split("\n")
        filled = [k for k, line in enumerate(lines) if line]
        gone = set()
        for at in range(len(filled) - 2):
            window = tuple(lines[k] for k in filled[at : at + 3])
            if seen.setdefault(window, (doc_id, text, at)) != (doc_id, text, at):
                gone |= set(filled[at : at + 3])
        out[doc_id, text] = (None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def test_line_dedup(spark):
    a = "one\ntwo\nthree\nfour"
    rows = [(1, a), (2, "zero\n" + a + "\nfive"), (3, "one\n\ntwo\nthree"), (4, "one\ntwo"), (5, None), (6, ""), (7, "x\n" * 9), (8, "two\nthree\nfour\nnew")]
    rows += [(9, "\n".join(str(k) for k in range(3000))), (10, "\n".join(str(k) for k in range(2990, 3010))), (None, a), (2, "zero\n" + a + "\nfive")]
    found = line_dedup.dedup_lines(frame(spark, rows)).collect()
    want = lines_by_hand(rows)
    assert len(found) == len(rows)
    by_id = collections.defaultdict(set)
    for (doc_id, _), result in want.items():
        by_id[doc_id].add(result)
    for r in found:
        assert (r.text, r["__n_lines"], r["__n_removed"]) in by_id[r.doc_id]
        assert r.fp == 1
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_keeps_every_line_somewhere(spark):
    rng = random.Random(3)
    rows = [(k, "\n".join(rng.choice("abcde") for _ in range(rng.randrange(30)))) for k in range(60)]
    kept = {line for r in line_dedup.dedup_lines(frame(spark, rows)).collect() for line in r.text.split("\n")}
    assert kept >= {line for _, t in rows for line in t.split("\n")}


# Sharding


def smallest_capacity(sizes, shards):
    def fits(capacity):
        used, n = 0, 1
        for s in sizes:
            if used + s > capacity:
                used, n = 0, n + 1
            used += s
        return n <= shards and max(sizes) <= capacity

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("hot", [0, 5, 400])
def test_sharding_is_minimax(spark, hot):
    rows = texts_with_everything(hot, docs=120) + [(1000 + k, "copied text here") for k in range(hot)]
    found = sharding.assign(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    groups = collections.Counter()
    for _, text in rows:
        groups["0" * 64 if text is None else hashlib.sha256(text.encode()).hexdigest()] += len((text or "").encode()) + 1
    loads, slots, place = collections.Counter(), collections.defaultdict(list), {}
    for r in found:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert place.setdefault(r.digest, r.shard) == r.shard
    assert max(loads.values()) == smallest_capacity([n for _, n in sorted(groups.items())], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    crc = {i: {zlib.crc32((t or "").encode()) for j, t in rows if j == i} for i, _ in rows}
    assert all(r.text_crc32 in crc[r.doc_id] for r in found)


def test_sharding_of_nothing_and_of_one_group(spark):
    assert sharding.assign(frame(spark, [])).count() == 0
    assert {r.shard for r in sharding.assign(frame(spark, [(1, "a"), (2, "a"), (3, "a")])).collect()} == {0}


def test_written_shards_hold_whole_rows(spark, tmp_path):
    rows = texts_with_everything(1)
    sharding.write_shards(frame(spark, rows), f"{tmp_path}/s", 4)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == len(rows) and back.select("__shard").distinct().count() <= 4
    assert back.groupBy("text").agg(F.countDistinct("__shard").alias("n")).where("n > 1").count() == 0


# Winnowing


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def contamination_by_hand(rows, items):
    out = []
    for doc_id, text in rows:
        words, hit, ids = words_of(text), set(), set()
        for item_id, item in items:
            other = words_of(item)
            k = min(10, len(other))
            windows = {tuple(other[i : i + k]) for i in range(len(other) - k + 1)} if k else set()
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    ids.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(words), len(hit), ",".join(sorted(ids))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_winnowing_finds_every_window(spark, seed):
    rng = random.Random(seed)
    rows = texts_with_everything(seed, words=3 if seed == 2 else 6)
    long = next(t for _, t in rows if t and len(words_of(t)) > 30)
    items = [(k, " ".join(words_of(rng.choice(rows)[1] or "w0")[n].decode() if False else f"w{rng.randrange(6)}" for n in range(rng.randrange(1, 16)))) for k in range(12)]
    cut = [w.decode() for w in words_of(long)]
    items += [(20, " ".join(cut[5:15]).upper()), (21, "! ".join(cut[:30])), (22, "w1 w2"), (23, "w1 w2"), (24, None), (25, ""), (26, "É"), (None, " ".join(cut[8:19]))]
    found = winnow.contamination(frame(spark, rows), frame(spark, items, "item_id long, text string"))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in found.collect()), key=str)
    assert got == contamination_by_hand(rows, items)


def test_winnowing_cleans_and_takes_empty_tables(spark):
    docs, item = frame(spark, [(1, "a b c d e f g h i j k"), (2, "nothing"), (3, None)]), "b c d e f g h i j k"
    kept = winnow.clean(docs, frame(spark, [(1, item)], "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == docs.columns
    empty = frame(spark, [], "item_id long, text string")
    assert [r.n_hit for r in winnow.contamination(docs, empty).collect()] == [0, 0, 0]
    assert winnow.contamination(frame(spark, []), frame(spark, [(1, item)], "item_id long, text string")).count() == 0


# SimHash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closest_components(values, radius):
    values = np.array(values, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None]) <= radius
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None], 1 << 60).min(axis=1)
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_bit_sliced_links_are_exact(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(5)])
    ends = np.where(np.arange(len(values)) < 130, 130, len(values))
    got = {p for i, j in simhash.links(values, ends, radius) for p in zip(i.tolist(), j.tolist())}
    near = np.bitwise_count(values[:, None] ^ values[None]) <= radius
    assert got == {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near))) if i < j < ends[i]}


def test_every_pair_within_the_radius_shares_a_mask():
    rng = random.Random(0)
    masks = simhash.first_masks(3)
    assert all(m.bit_count() == 28 for m in masks)
    for _ in range(500):
        difference = sum({1 << rng.randrange(64) for _ in range(3)})
        assert any(difference & m == 0 for m in masks)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_simhash_components(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rows = [r for r in texts_with_everything(2, words=40) if r[0] is not None]
    base = " ".join(f"v{k}" for k in range(400))
    rows += [(200 + k, base.replace(f"v{k * 7}", "other")) for k in range(20)]
    found = simhash.near_duplicates(frame(spark, rows).select("doc_id", "text")).collect()
    values = {r.doc_id: r.fp % (1 << 64) for r in found}
    ids = sorted(values)
    assert values == {i: fingerprint(t) for i, t in rows}
    label = closest_components([values[i] for i in ids], 3)
    assert {r.doc_id: r.component_id for r in found} == {i: ids[label[n]] for n, i in enumerate(ids)}
    assert len(found) == len(rows)


def test_simhash_keeps_one_of_each_group(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, None), (8, "  "), (None, "q r s t u"), (None, "q r s t u"), (None, "l m n o p"), (1, "A B c d")]
    kept = simhash.representatives(frame(spark, rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 8, None, None]
    assert kept.columns == frame(spark, rows).columns
    assert simhash.representatives(frame(spark, [])).count() == 0


# Packing and id files

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def encoded(path, text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    return np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_packing_covers_every_id_once(spark):
    rows = [*texts_with_everything(6), (200, "a <|endoftext|>b<|endoftext|> c"), (201, "<|startoftext|>")]
    found = packing.pack(frame(spark, rows), BYTES, with_ids=True).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        assert r.length <= 1024 and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id in {i for i, _ in rows}:
        want = sorted(encoded(BYTES, t).tobytes() for i, t in rows if i == doc_id)
        copies = len(want)
        pieces = sorted(by_doc[doc_id], key=lambda r: (r.piece, r.sequence_id, r.offset))
        assert sum(r.length for r in pieces) * 4 == sum(map(len, want))
        if copies == 1:
            assert b"".join(r.ids for r in pieces) == want[0]
            assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
            assert all(r.length == 1024 for r in pieces[1:])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(frame(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("tasks", [8, 64, 256])
def test_packing_needs_no_more_sequences_with_many_tasks(spark, tasks):
    rng = random.Random(5)
    docs = frame(spark, [(k, " b" * min(1500, int(rng.expovariate(1 / 250)))) for k in range(8000)])

    def sequences(df):
        found = packing.pack(df, BYTES).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
        assert all(r.n <= 1024 for r in found)
        return len(found), -(-sum(r.n for r in found) // 1024)

    found, least = sequences(docs.repartition(tasks))
    assert found <= 1.015 * max(least, sequences(docs.coalesce(1))[0])


def test_later_rounds_keep_every_piece(spark, monkeypatch):
    monkeypatch.setattr(packing, "AGAIN", 40)
    rows = [(k % 200, " b" * (k % 900)) for k in range(300)]
    found = packing.pack(frame(spark, rows).repartition(20), BYTES, open_bins=4).collect()
    assert sum(r.length for r in found) == sum(len(encoded(BYTES, t)) for _, t in rows)
    by_sequence = collections.defaultdict(list)
    for r in found:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        ends = [o + n for o, n in sorted(places)]
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_id_files_round_trip(spark):
    rows = [r for r in texts_with_everything(7) if r[0] != 102] + [(200, "a <|endoftext|>b<|endoftext|> c"), (201, "<|startoftext|>"), (-1, "minus one"), (-77, "less")]
    found = bitpack.read_digests(bitpack.write_ids(frame(spark, rows), WORDS)).collect()
    at, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0]):
        ids = encoded(WORDS, text)
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == want
    assert bitpack.read_digests(bitpack.write_ids(frame(spark, []), WORDS)).count() == 0


# WARC

PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é" + "x" * 2000
    rows = [(1, "http://a/ b\r\nc", big), (2, None, big), (3, "http://é", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (9, "u", big), (9, "u", big)]
    rows += [(7, "u", "y" * 999), (8, "u", "y" * 999), (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 60), (11, "u", "z" * 300_000)]
    frame(spark, rows, PAGES).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    found = warc.read_archives(warc.normalise(warc.write_archives(pages))).collect()
    want = duckdb.sql(warc.ORACLE.format(pages=f"'{tmp_path}/pages/*.parquet'")).fetchall()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert warc.read_archives(warc.normalise(warc.write_archives(frame(spark, [], PAGES)))).count() == 0


def test_warc_null_ids(spark):
    big = "q" * 1500
    found = warc.read_archives(warc.normalise(warc.write_archives(frame(spark, [(None, "u", big), (3, "u", big), (None, "u", "r" * 1500)], PAGES)))).collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in found), key=str) == sorted([(None, "revisit", 3), (3, "response", None), (None, "response", None)], key=str)


def test_warc_streams_of_one_and_many_members(tmp_path):
    import gzip
    import io

    records = [warc.record(k, "http://x", b"abc" * k, "d", k % 3 == 2, 7) for k in range(200)]
    one, many = gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))
    for data in (one, many, many[:40] and one + many):
        assert list(warc.records(warc.inflated(io.BytesIO(data)))) == (records if data is not one + many and len(data) in (len(one), len(many)) else records * 2)
    with pytest.raises(EOFError):
        list(warc.records(warc.inflated(io.BytesIO(one[:-20]))))
    with pytest.raises(EOFError):
        list(warc.records(iter([records[3][:-6]])))


# Product quantisation

VECTORS = "vec_id long, embedding array<float>, label int"


def links_by_hand(rows):
    n = len(rows)
    sound = [e is not None and label is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e) for _, e, label in rows]
    unit = [np.array(e, np.float32).astype(float) / np.linalg.norm(np.array(e, np.float32).astype(float)) if s else None for s, (_, e, _) in zip(sound, rows)]
    edges = [(a, b) for a in range(n) for b in range(n) if a != b and sound[a] and sound[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    out = []
    for k, (vec_id, _, _) in enumerate(rows):
        component = min((rows[m][0] for m in range(n) if label[m] == label[k]), default=None)
        out.append((vec_id, sum(a == k for a, _ in edges), component, vec_id == component))
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_product_quantisation_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(pq, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows, centres = [], rng.normal(size=(12, 24))
    for k in range(150):
        rows.append((k, (centres[k % 12] + rng.normal(size=24) * rng.choice([0.05, 0.2, 0.28, 0.4])).astype(np.float32).tolist(), int(k % 5 == 0)))
    one = rows[0][1]
    rows += [(200, one, 1), (201, one, 1), (202, one, None), (203, None, 1), (204, [0.0] * 24, 1), (205, [float("nan")] + one[1:], 1), (206, [None] + one[1:], 1)]
    rows += [(207, [float("inf")] + one[1:], 1), (208, [], 1), (209, one[:5], 1), (210, one[:5], 1), (211, [-x for x in one], 1), (212, [x * 1e-30 for x in one], 1), (213, [-0.0] + [1.0] * 23, 1), (214, [0.0] + [1.0] * 23, 1)]
    found = pq.near_duplicates(frame(spark, rows, VECTORS)).collect()
    assert sorted(map(tuple, found)) == links_by_hand(rows)


def test_product_quantisation_of_nothing_and_repeats(spark):
    assert pq.near_duplicates(frame(spark, [], VECTORS)).count() == 0
    found = pq.near_duplicates(frame(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (7, None, 0)], VECTORS)).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (7, 0, 7, True)], key=str)


def test_code_errors_bound_distances():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(500, 16)) + rng.normal(size=(8, 16))[rng.integers(0, 8, 500)] * 2
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = pq.Index(points, 20, 4)
    own, codes, error, probes = index.coded(index.padded(points), 0.4, 20)
    for a, b in zip(*np.nonzero(np.linalg.norm(points[:, None] - points[None], axis=2) <= 0.4)):
        assert own[b] in probes[a]
        assert index.distances(points[[a]], own[b], codes[[b]])[0, 0] <= 0.4 + error[b] + pq.SLACK


@pytest.mark.parametrize("probes,least", [(40, 1.0), (6, 0.9)])
def test_many_lists_count_each_link_once(spark, monkeypatch, probes, least):
    monkeypatch.setattr(pq, "LIST_CODES", 10)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 32))
    rows = [(k, (centres[k % 60] + rng.normal(size=32) * rng.choice([0.05, 0.15, 0.22])).astype(np.float32).tolist(), 1) for k in range(400)]
    found = sorted(map(tuple, pq.near_duplicates(frame(spark, rows, VECTORS), probes=probes).collect()))
    want = links_by_hand(rows)
    assert all(f[1] <= w[1] for f, w in zip(found, want))
    assert sum(f[1] for f in found) >= least * sum(w[1] for w in want) > 0
    assert least < 1 or found == want


# Toxicity


def toxic_corpus(n=1500):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.15
        for _ in range(rng.randrange(2, 5) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vileness", "grimword", "foulterm"]) + rng.choice(["", "s", "ing"]))
        rows.append((k, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((k, 1, int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    rows += [(9000, None), (9001, ""), (None, "grimword foulterm"), (9002, "GRIMWORD, foulterms! vileness"), (9003, "a1 " * 50_000)]
    docs, marks = frame(spark, rows), frame(spark, labels + [(5, 1, None), (None, 1, 1)], LABELS)
    model = toxicity.train(docs, marks)
    score = {r.doc_id: r["__score"] for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
    held = [(score[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((s >= 0.7) == t for s, t in held) >= 0.97 * len(held)
    assert score[9000] == score[9001] < 0.5 < 0.7 <= score[9002] and score[9003] < 0.5
    kept = toxicity.keep_clean(docs, marks)
    assert kept.columns == docs.columns and 9002 not in {r.doc_id for r in kept.collect()}


def test_toxicity_learns_no_held_out_labels(spark):
    rows, labels = toxic_corpus(400)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a, b = (toxicity.train(frame(spark, rows), frame(spark, x, LABELS)) for x in (labels, turned))
    assert a.base == b.base and (a.weights == b.weights).all()


def test_toxicity_counts_copies_of_a_text_once(spark):
    """A toxic text copied into a third of the rows changes nothing but its own weight as one more text."""
    rows, labels = toxic_corpus()
    text = "grimword foulterm vileness a1 b2 c3"
    one = 100_000 + next(k for k in range(10) if zlib.crc32(str(100_000 + k).encode()) % 3 != 1)
    copies = [(k, text) for k in range(one, one + 800)]
    once = toxicity.train(frame(spark, rows + copies[:1]), frame(spark, labels + [(one, 1, 1)], LABELS))
    often = toxicity.train(frame(spark, rows + copies), frame(spark, labels + [(k, 1, 1) for k, _ in copies], LABELS))
    assert (once.place == often.place).all() and often.base == pytest.approx(once.base) and often.weights == pytest.approx(once.weights)
    scores = {r.doc_id: r["__score"] for r in toxicity.scored(frame(spark, [(1, "grimword"), (2, "a1 b2"), (3, text)]), often, ["doc_id"]).collect()}
    assert scores[1] > 0.5 > scores[2] and scores[3] >= 0.7


def test_toxicity_without_positives(spark):
    model = toxicity.train(frame(spark, [(1, "a"), (2, None)]), frame(spark, [], LABELS))
    scores = [r["__score"] for r in toxicity.scored(frame(spark, [(1, "a"), (2, None)]), model, ["doc_id"]).collect()]
    assert scores == pytest.approx([toxicity.DEFAULT_PRIOR] * 2)
    assert toxicity.keep_clean(frame(spark, []), frame(spark, [], LABELS)).count() == 0


def test_risk_never_goes_negative_by_memorising():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 300, 4)) for _ in range(120)]
    weights, base = toxicity.fit(rows[:20], rows, np.ones(300), 0.15)
    z = np.array([base + weights[r].sum() for r in rows])
    s = 1 / (1 + np.exp(-z))
    assert s.mean() - 0.15 * s[:20].mean() >= -0.02


# Language model


def test_huffman_bits_give_a_distribution():
    code = lm_mixing.Code(np.arange(lm_mixing.SYMBOLS) ** 2)
    counts = np.zeros((lm_mixing.SLOTS, 2), np.float32)
    words = [b"the", b"then", b"there", b"a", "é".encode()]
    lm_mixing.add_counts(counts, lm_mixing.word_events(code, words), np.array([5, 2, 1, 9, 1], np.float32))
    model = lm_mixing.Model(code, counts, lm_mixing.first_weights())
    events = lm_mixing.first_events(code)
    total = 10 ** np.bincount(events.owner, weights=model.cost(events))
    assert total.sum() == pytest.approx(1)
    known, new = (lm_mixing.word_events(code, [w]) for w in (b"then", b"tqxz"))
    assert model.cost(known).sum() > model.cost(new).sum()


def base_by_hand(rows):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    counts = collections.Counter()
    for i, t in rows:
        if not held[i]:
            counts.update([*(t or "").encode().lower().split(), None])
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        out.append((i, held[i], len(tokens), sum(counts[w] > 0 for w in tokens), total, sum(np.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)))
    return out


def test_scores_and_base(spark):
    rows = texts_with_everything(9, words=60, docs=150) + [(500, "W1 W2\x1cx \xa0"), (501, "neverseenbefore")]
    found = lm_mixing.score(frame(spark, rows)).collect()
    want = base_by_hand(rows)
    key = lambda r: str(r[:5]) + f"{r[5]:.6f}"
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found]
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(r.score < 0 and np.isfinite(r.score) for r in found)
    held = [r for r in found if r.held_out and r.n_tokens > 5]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    same = {r.score for r in found if r.n_tokens == 1}
    assert len(same) == 1


def test_scores_learn_nothing_from_held_out_rows(spark):
    rows = texts_with_everything(3, docs=60)
    other = [(i, "changed words entirely" if i is not None and zlib.crc32(str(i).encode()) % 7 == 2 else t) for i, t in rows]
    a, b = ({(r.doc_id, r.n_tokens): r.score for r in lm_mixing.score(frame(spark, x)).where("not held_out").collect()} for x in (rows, other))
    assert a == pytest.approx(b)


def test_scores_of_nothing_and_without_training_rows(spark):
    assert lm_mixing.score(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = lm_mixing.score(frame(spark, [(held, "ab c")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and np.isfinite(r.score)


def test_scores_follow_the_words_before(spark):
    """Words of a fixed cycle: in order they are foreseen, shuffled they are not."""
    rng = random.Random(4)
    cycle = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join(cycle[(k * 7 + i) % 40] for i in range(60))) for k in range(300)]
    kept = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    words = [cycle[i % 40] for i in range(39)]
    rows += [(kept, " ".join(words)), (kept, " ".join([*rng.sample(words[:-1], 38), words[-1]]))]
    ordered, shuffled = sorted((r.score for r in lm_mixing.score(frame(spark, rows)).where(f"doc_id = {kept}").collect()), reverse=True)
    assert ordered > 0.5 * shuffled


def test_words_before_give_a_distribution():
    rng = np.random.default_rng(2)
    words = [f"w{k}".encode() for k in range(50)]
    keys = np.array([zlib.crc32(w) for w in words], np.uint32)
    tokens, sizes = rng.integers(0, 50, 4000).astype(np.uint32), np.array([4000])
    masses = np.bincount(keys[tokens] % lm_mixing.WORD_CODES, minlength=lm_mixing.WORD_CODES).astype(float)
    code = lm_mixing.Code(masses)
    model = lm_mixing.Words(code, lm_mixing.first_word_weights(), np.full(lm_mixing.GATES, 0.7), np.zeros((lm_mixing.WORD_SLOTS, 2), np.float32))
    at = np.arange(4000)
    before = lm_mixing.histories(keys, tokens, np.zeros(4000, np.int64), at)
    lm_mixing.add_counts(model.counts, lm_mixing.code_events(code, (keys[tokens] % lm_mixing.WORD_CODES).astype(np.int64), before), np.ones(4000, np.float32))
    every = np.arange(lm_mixing.WORD_CODES)
    logs, _ = model.predicted(every, [np.full(len(every), b[77]) for b in before])
    assert (10**logs).sum() == pytest.approx(1)


#: Names that operators use for columns of their own.
OWN_NAMES = ("__k1", "__k2", "__marks", "__lines", "__filled", "__gone", "__n_lines", "__n_removed", "__score", "__shard", "__digest", "__x")


@pytest.mark.parametrize("operator", ["clean", "representatives", "dedup_lines", "keep_clean", "write_shards"])
def test_columns_of_any_name_keep_their_values(spark, tmp_path, operator):
    toxic = "awful hate words here " * 3
    rows = [(k, f"document {k} about things {k % 7}\nline {k % 3}\nand a last one {k}") for k in range(40)] + [(100 + k, toxic + str(k)) for k in range(20)]
    rows += [(None, "no id"), (-1, "minus one"), (-5, None)]
    values = {c: F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-99)).cast("string")) for c in OWN_NAMES}
    docs = spark.createDataFrame(rows, DOCS).withColumns(values)
    if operator == "write_shards":
        sharding.write_shards(docs, str(tmp_path / "s"), 3)
        out = spark.read.parquet(*map(str, (tmp_path / "s").glob("__shard_=*")))
        assert out.count() == len(rows)
    else:
        items = spark.createDataFrame([("i", "document 3 about things 3"), ("j", None)], "item_id string, text string")
        labels = spark.createDataFrame([(k, 1 if 100 <= k else 0) for k in [*range(40), *range(100, 120)]], "doc_id long, toxic int")
        out = {
            "clean": lambda: winnow.clean(docs, items), "representatives": lambda: simhash.representatives(docs),
            "dedup_lines": lambda: line_dedup.dedup_lines(docs), "keep_clean": lambda: toxicity.keep_clean(docs, labels),
        }[operator]()
        assert out.columns[: len(docs.columns)] == docs.columns if operator != "dedup_lines" else set(docs.columns) < set(out.columns)
    found = out.collect()
    assert found and all(r[c] == f"{c}{-99 if r.doc_id is None else r.doc_id}" for r in found for c in OWN_NAMES)
    if operator == "dedup_lines":
        assert {"__n_lines_", "__n_removed_"} <= set(out.columns)
