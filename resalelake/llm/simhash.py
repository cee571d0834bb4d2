"""SimHash near-dedup with bit-sliced comparison.

A fingerprint is the majority, bit by bit, of the XXH64 (seed 42) hashes of all three-word shingles. Fingerprints that
differ in at most ``RADIUS`` of 64 bits link. Linked pairs agree on at least one of four 16-bit blocks, and on at least one
quarter of the other 48 bits, so 16 masks of 28 bits bring every linked pair together in some bucket. A bucket of more
than ``BUCKET`` fingerprints is divided again by quarters of its free bits, as often as needed; with 20, then 15 free
bits left a bucket of distinct fingerprints is bounded by itself, so nothing is capped and no pair is lost.

Within buckets, 64 fingerprints stand side by side as 64 vertical bit planes. One query is compared with 64 at once by
adding the differing planes into carry-save counters, and a block is abandoned when all of its distances are beyond the radius.
Tasks return a spanning forest of the links they found, never all pairs.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other; fewer words than a
shingle are one shingle; repeated rows each get the component of their text; a component whose ids are all null has id
null; an empty table gives no rows; other columns are not read, and pass through ``representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import KEY, names_kept, slices, with_key, written
from resalelake.llm.components import components, joined_labels

SHINGLE = 3
RADIUS = 3
#: Fingerprints of a bucket that are compared in one go.
BUCKET = 4096
ALL = (1 << 64) - 1


def fingerprint_values(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    hashes: list[int] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for n, text in enumerate(texts):
        words = text.lower().split()  # of bytes: A-Z, and \x20 \x09-\x0D
        if len(words) >= shingle:
            hashes += map(digest, map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
        elif words:
            hashes.append(digest(b" ".join(words)))
        ends[n + 1] = len(hashes)
    out = np.zeros(len(texts), np.uint64)
    filled = np.flatnonzero(ends[1:] > ends[:-1])
    if len(filled):
        values = np.array(hashes, np.uint64)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals = np.add.reduceat(bits, ends[filled], axis=0, dtype=np.int32)
        major = totals * 2 > (ends[filled + 1] - ends[filled])[:, None]
        out[filled] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint_rows(shingle: int, names: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            values = fingerprint_values(texts, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(values)], [*names, "fp"])

    return rows


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The id columns of ``docs`` (all but text) with ``fp``, the 64 bits as a long."""
    ids = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids) + ", fp bigint"
    return docs.mapInArrow(_fingerprint_rows(shingle, ids), schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def divided(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` as so many masks of nearly equal size."""
    bits = [b for b in range(64) if free >> b & 1]
    cut = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[low:high]) for low, high in zip(cut, cut[1:])]


def first_masks(radius: int) -> list[int]:
    parts = radius + 1
    return [one | two for one in divided(ALL, parts) for two in divided(ALL & ~one, parts)]


def links(values: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j < ends[i] whose values differ in at most ``radius`` bits; rows of a bucket stand together."""
    n = len(values)
    blocks = -(-n // 64)
    padded = np.zeros(blocks * 64, np.uint64)
    padded[:n] = values
    bytes_ = padded.view(np.uint8).reshape(-1, 8)
    planes = np.empty((64, blocks), np.uint64)
    for b in range(64):
        planes[b] = np.packbits((bytes_[:, b >> 3] >> np.uint8(b & 7)) & np.uint8(1), bitorder="little").view(np.uint64)
    counters = radius.bit_length()
    spare = (1 << counters) - 1 - radius
    ones = np.uint64(ALL)
    step = 0
    queries = np.flatnonzero(ends > np.arange(n) + 1)
    while len(queries):
        block = queries // 64 + step
        inside = block * 64 < ends[queries]
        queries, block = queries[inside], block[inside]
        if not len(queries):
            return
        low = np.maximum(queries + 1 - block * 64, 0)
        high = np.minimum(ends[queries] - block * 64, 64)
        lanes = np.where(low < high, (ones >> (64 - np.maximum(high, 1)).astype(np.uint64)) & (ones << np.minimum(low, 63).astype(np.uint64)), np.uint64(0))
        alive = np.flatnonzero(lanes)
        own, at, lanes = queries[alive], block[alive], lanes[alive]
        value = values[own]
        count = [np.full(len(own), ones if spare >> c & 1 else 0, np.uint64) for c in range(counters)]
        for b in range(64):
            carry = planes[b][at] ^ (np.uint64(0) - ((value >> np.uint64(b)) & np.uint64(1)))
            for c in range(counters):
                count[c], carry = count[c] ^ carry, count[c] & carry
            lanes &= ~carry
            if b % 8 == 7:
                keep = np.flatnonzero(lanes)
                if len(keep) < 0.75 * len(lanes):
                    own, at, lanes, value = own[keep], at[keep], lanes[keep], value[keep]
                    count = [c[keep] for c in count]
        keep = np.flatnonzero(lanes)
        if len(keep):
            who, lane = np.nonzero(np.unpackbits(lanes[keep].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield own[keep][who], at[keep][who] * 64 + lane
        step += 1


def _forest(radius: int, rows_at_once: int = 1 << 17):
    """Rows sorted by (mask, key); gives a spanning forest of the links within buckets."""

    def edges(values: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        labels = np.arange(len(values))
        for i, j in links(values, ends, radius):
            labels = joined_labels(labels, i, j)
        moved = np.flatnonzero(labels != np.arange(len(values)))
        signed = values.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[labels[moved]])], ["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_rows = 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, held_rows
            if not held:
                return
            data = np.concatenate(held)
            new = np.flatnonzero((data[1:, :2] != data[:-1, :2]).any(axis=1)) + 1
            starts = np.concatenate([[0], new])
            stop = len(data) if last else starts[-1]
            ends = np.repeat(np.concatenate([new, [len(data)]]), np.diff(np.concatenate([starts, [len(data)]])))
            several = ends[:stop] - np.repeat(starts, np.diff(np.concatenate([starts, [len(data)]])))[:stop] > 1
            if several.any():
                kept = np.flatnonzero(several)
                shift = np.cumsum(several)
                yield edges(np.ascontiguousarray(data[kept, 2]).view(np.uint64), shift[ends[kept] - 1])
            held, held_rows = [data[stop:]] if stop < len(data) else [], len(data) - stop

        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp")], axis=1))
            held_rows += batch.num_rows
            if held_rows >= rows_at_once:
                yield from cut(False)
        yield from cut(True)

    return rows


def _bucketed(rows: DataFrame) -> DataFrame:
    return rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def near_links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect all linked fingerprints of ``values`` (distinct ``fp``)."""
    masks = first_masks(radius)
    rows = _bucketed(values.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")))
    found = None
    while True:
        large = written(rows.groupBy("mask", "key").count().where(F.col("count") > BUCKET), "simhash-buckets")
        free = {r.mask: ALL & ~(r.mask & ALL) for r in large.select("mask").distinct().collect()}  # masks, at most 4^level
        children = {m: [_signed((m & ALL) | part) for part in divided(bits, radius + 1)] for m, bits in free.items() if bits.bit_count() > 15}
        whole = rows
        if children:
            hot = large.where(F.col("mask").isin(list(children))).select("mask", "key")
            whole = rows.join(hot, ["mask", "key"], "left_anti")
        some = whole.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_forest(radius), "a bigint, b bigint")
        found = some if found is None else found.unionAll(some)
        if not children:
            return found
        table = F.create_map(*[x for m, c in children.items() for x in (F.lit(m), F.array(*map(F.lit, c)))])
        rows = written(_bucketed(rows.join(hot, ["mask", "key"], "left_semi").select("fp", F.explode(table[F.col("mask")]).alias("mask"))), "simhash-refined")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The id columns of ``docs`` with ``fp`` and ``component_id``, the smallest doc_id reachable by links."""
    marked = written(fingerprints(docs, shingle), "simhash")
    values = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-values")
    roots = components(near_links(values, radius))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(classes, "fp")


@names_kept
def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest id; of rows that repeat that id, one."""
    keyed = with_key(docs)
    found = near_duplicates(keyed.select("doc_id", "text", *KEY), shingle, radius)
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("component_id").isNull().alias("none"), F.when(F.col("component_id").isNull(), F.col("fp")).otherwise(F.col("component_id")).alias("group"))
        .agg(F.min("__k1").alias("__k1"), F.min("__k2").alias("__k2"))
        .select(*KEY)
    )
    return keyed.join(kept, KEY, "left_semi").dropDuplicates(KEY).select(*[F.col(f"`{c}`") for c in docs.columns])
