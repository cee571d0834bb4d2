"""Benchmark decontamination by winnowing.

Texts become words (A-Z lowered, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``). Every run of ``W`` consecutive hashes of ``K``
words keeps its smallest (the rightmost of equals), so any shared span of ``W + K - 1`` = 10 words keeps the same
fingerprint on both sides. Fingerprints are joined on the hash and each hit is extended word by word: a run of at least
10 equal words is a hit, so hash collisions never count. An item of 1 to 9 words is one window of its own length; for
each such length the windows have one hash each (``W`` = 1), which keeps the same guarantee.

Fingerprints of documents that no item has are dropped before the shuffle with a bitmap of fixed size
(``BITMAP_BITS``); where a huge benchmark fills it, everything just goes through the join. Items of equal words
are matched once and expanded at the end.

Defined cases: null and empty texts have no words and no hits; null item ids count as the empty text ''; rows repeated in
full get the same result; items without words match nothing; empty tables give no rows or no hits; other columns are not
read, and pass through ``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import ALNUM, KEY, LOWER, mixed, names_kept, slices, span_hashes, spans, text_bytes, with_key, written

WINDOW = 10
K = 6
W = WINDOW - K + 1
BITMAP_BITS = 23
_BASE = 0x9FB21C651E98DF25
#: Kind of the fingerprints of 10-word windows; kinds 1 to 9 are whole items of so many words.
LONG = 0

_FOUND = pa.list_(pa.struct([("hash", pa.int64()), ("kind", pa.int32()), ("at", pa.int32()), ("left", pa.int32()), ("near", pa.list_(pa.string()))]))
_FOUND_SQL = "array<struct<hash: bigint, kind: int, at: int, left: int, near: array<string>>>"


def gram_hashes(words: np.ndarray, k: int, kind: int) -> np.ndarray:
    """A hash of the ``k`` words from each place on; kinds never share hashes by construction of their inputs."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, kind, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + words[j : j + n]
    return mixed(out)


def winnowed(hashes: np.ndarray, text_end: np.ndarray, k: int, w: int) -> np.ndarray:
    """Places whose hash is the smallest of some run of ``w``; ``text_end``: for each word, where its text ends."""
    if len(hashes) < w:
        return np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(hashes, w)
    whole = np.flatnonzero(np.arange(len(runs)) + w + k - 1 <= text_end[: len(runs)])
    best = w - 1 - np.argmin(runs[whole][:, ::-1], axis=1)
    return np.unique(whole + best)


class Words:
    """The words of a slice of texts, over all texts one after another."""

    def __init__(self, column: pa.Array):
        raw, offsets = text_bytes(column)
        self.raw = LOWER[raw]
        self.starts, self.ends, self.first = spans(self.raw, offsets, ALNUM)
        self.hashes = span_hashes(self.raw, self.starts, self.ends)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(self.counts)), self.counts)
        self.text_end = self.first[1:][self.text_of]

    def strings(self, start: int, stop: int) -> list[str]:
        return [self.raw[a:b].tobytes().decode() for a, b in zip(self.starts[start:stop], self.ends[start:stop])]

    def long(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the winnowed fingerprints."""
        hashes = gram_hashes(self.hashes, K, LONG)
        places = winnowed(hashes, self.text_end, K, W)
        return places, hashes[places]

    def short(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all runs of ``length`` words."""
        hashes = gram_hashes(self.hashes, length, length)
        places = np.flatnonzero(np.arange(len(hashes)) + length <= self.text_end[: len(hashes)])
        return places, hashes[places]

    def found(self, picked: list[tuple[int, np.ndarray, np.ndarray]]) -> list[list[dict]]:
        """For each text its fingerprints with the words around them: all that a window over them can hold."""
        out: list[list[dict]] = [[] for _ in self.counts]
        for kind, places, hashes in picked:
            before, width = (WINDOW - K, WINDOW) if kind == LONG else (0, kind)
            for at, h in zip(places.tolist(), hashes.view(np.int64).tolist()):
                text = self.text_of[at]
                low, high = int(self.first[text]), int(self.first[text + 1])
                begin = max(low, at - before)
                out[text].append({"hash": h, "kind": kind, "at": at - low, "left": at - begin, "near": self.strings(begin, min(high, at + width))})
        return out


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        picked = [(LONG, *words.long())]
        for length in range(1, WINDOW):
            places, hashes = words.short(length)
            own = words.counts[words.text_of[places]] == length
            picked.append((length, places[own], hashes[own]))
        classes = [hashlib.sha256(" ".join(words.strings(a, b)).encode()).digest() for a, b in zip(words.first[:-1], words.first[1:])]
        columns = [batch.column("item_id"), pa.array(classes, pa.binary()), pa.array(words.found(picked), _FOUND)]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "class", "found"])


def _document_rows(bitmap: np.ndarray, lengths: list[int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            picked = []
            for kind, (places, hashes) in ((k, words.short(k) if k else words.long()) for k in [LONG, *lengths]):
                slots = hashes >> np.uint64(64 - BITMAP_BITS)
                known = (bitmap[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1
                picked.append((kind, places[known], hashes[known]))
            columns = [batch.column(c) for c in ("doc_id", *KEY)]
            columns += [pa.array(words.counts, pa.int64()), pa.array(words.found(picked), _FOUND)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *KEY, "n_words", "found"])

    return rows


def _bitmap(prints: DataFrame) -> np.ndarray:
    """One bit per leading hash bits of any fingerprint; 2^BITMAP_BITS bits whatever the benchmark's size."""
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    words = (
        prints.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in words:
        out[r.word] = r.bits
    return out.view(np.uint64)


def _hit() -> tuple[Column, Column]:
    """Start and end, in words from the fingerprint, of the run of equal words around it."""
    start = F.least("left", "item_left")
    size = start + F.least(F.size("near") - F.col("left"), F.size("item_near") - F.col("item_left"))
    same = F.zip_with(F.slice("near", F.col("left") - start + 1, size), F.slice("item_near", F.col("item_left") - start + 1, size), lambda a, b: a == b)
    return start, same


def hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their word counts; hit intervals with item classes; members of the classes."""
    spark = docs.sparkSession
    schema = f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, class binary, found {_FOUND_SQL}"
    items = written(benchmark.select("item_id", "text").mapInArrow(_item_rows, schema), "winnow-items")
    prints = written(
        items.dropDuplicates(["class"]).select("class", F.inline("found")).select("hash", "kind", F.col("left").alias("item_left"), F.col("near").alias("item_near"), "class").distinct(),
        "winnow-prints",
    )
    lengths = sorted(r.kind for r in prints.where(F.col("kind") != LONG).select("kind").distinct().collect())  # 9 at most
    bitmap = spark.sparkContext.broadcast(_bitmap(prints))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (lambda shared: lambda batches: _document_rows(shared.value, lengths)(batches))(bitmap)
    read = written(
        with_key(docs.select("doc_id", "text")).mapInArrow(rows, f"doc_id {id_type}, __k1 bigint, __k2 bigint, n_words bigint, found {_FOUND_SQL}"),
        "winnow-documents",
    )
    start, same = _hit()
    kind_words = F.when(F.col("kind") == LONG, K).otherwise(F.col("kind"))
    joined = (
        read.where(F.size("found") > 0)
        .select(*KEY, F.inline("found"))
        .join(prints, ["hash", "kind"])
        .withColumns({"start": start, "same": same, "words": kind_words})
        # Equal words to the left of the fingerprint, itself, and to its right.
        .withColumn("before", F.expr("CASE WHEN start = 0 THEN 0 ELSE coalesce(nullif(array_position(reverse(slice(same, 1, start)), false), 0) - 1, start) END"))
        .withColumn("ahead", F.expr("slice(same, start + 1, size(same))"))
        .withColumn("after", F.expr("coalesce(nullif(array_position(ahead, false), 0) - 1, size(ahead))"))
        .where("after >= words AND before + after >= CASE WHEN kind = 0 THEN 10 ELSE kind END")
        .select(*KEY, (F.col("at") - F.col("before")).alias("from"), (F.col("at") + F.col("after")).alias("to"), "class")
        .distinct()
    )
    return read, joined, items.select("class", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, keys, n_words, n_hit, hit spans (word intervals) and the ids of occurring items, one row per row of ``docs``."""
    read, joined, members = hits(docs, benchmark)
    joined = written(joined, "winnow-hits")
    intervals = joined.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("from", "to"))).alias("spans"))
    ids = (
        joined.select(*KEY, "class")
        .distinct()
        .join(members.select("class", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct(), "class")
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    merged = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'reach', 0L), "
        "(a, s) -> named_struct('n', a.n + greatest(0L, s.`to` - greatest(a.reach, CAST(s.`from` AS BIGINT))), 'reach', greatest(a.reach, CAST(s.`to` AS BIGINT)))).n"
    )
    out = read.drop("found").join(intervals, KEY, "left").join(ids, KEY, "left")
    return out.withColumns(
        {
            "n_hit": F.when(F.col("spans").isNull(), F.lit(0).cast("long")).otherwise(merged.cast("long")),
            "items": F.coalesce("items", F.array().cast("array<string>")),
        }
    )


@names_kept
def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold any window of the benchmark."""
    _, joined, _ = hits(docs, benchmark)
    bad = joined.select(*KEY).distinct()
    return with_key(docs).join(bad, KEY, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same rule on DuckDB, from the windows as strings.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {docs}
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {items}
), sized AS (
  SELECT item_id, words, least(len(words), 10) AS k FROM b WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM sized)
), doc_windows AS (
  SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM sized) WHERE len(words) >= k)
), hit AS (
  SELECT doc_id, i, k, item_id FROM doc_windows JOIN item_windows USING (k, win)
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest(range(0, k)) AS j FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
