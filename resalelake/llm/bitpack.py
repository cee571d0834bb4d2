"""Token ids in files of fixed-width bit-packed blocks.

File: the packed blocks one after another, each of ``BLOCK`` ids (the last may be shorter) at the smallest width that holds the
vocabulary, least significant bit first; then an index of little-endian 64-bit integers: byte offsets of the blocks and their
end, ids before each document and their end, document ids, and whether an id is null; last a trailer of 8 such integers
(magic, version, width, BLOCK, ids, documents, offset of the index, 0). Any range of ids is read by seeking its blocks and unpacking
them with numpy.

Documents are spread by ranges of (doc_id, text hash) and sorted within a task, which encodes them and writes one file;
the range step looks at ids only, so texts are encoded once. The manifest names the files, in order, with their ids.

Defined cases: null and empty texts are the end id alone; null ids come first; repeated rows are written one by one; an empty table gives an
empty manifest; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resalelake.llm import files
from resalelake.llm.common import KEY, slices, with_key, written
from resalelake.llm.tokens import encoding
from resalelake.session import shared_folder

BLOCK = 1 << 16
END_ID = 2
MAGIC = 0x4B4E444944495350
VERSION = 1
TRAILER = 64
MANIFEST = "path string, n_docs bigint, n_ids bigint, first_id bigint, first_hash bigint"


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def packed(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


def unpacked(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype("<u4")
    bits = np.zeros((count, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=count * width).reshape(count, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


class Writer:
    def __init__(self, uri: str, width: int):
        self.out, self.width = files.writer(uri), width
        self.held: list[np.ndarray] = []
        self.held_ids = 0
        self.offsets, self.starts, self.ids = [0], [0], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        stop = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, stop, BLOCK):
            data = packed(ids[at : min(at + BLOCK, stop)], self.width)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.held, self.held_ids = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self._flush(True)
        index = [self.offsets, self.starts, [i if i is not None else 0 for i in self.ids], [int(i is None) for i in self.ids]]
        for part in index:
            self.out.write(np.array(part, "<i8").tobytes())
        trailer = [MAGIC, VERSION, self.width, BLOCK, self.starts[-1], len(self.ids), self.offsets[-1], 0]
        self.out.write(np.array(trailer, "<i8").tobytes())
        self.out.close()


class Reader:
    def __init__(self, uri: str):
        self.file = files.reader(uri)
        size = self.file.size()
        self.file.seek(size - TRAILER)
        magic, version, self.width, self.block, self.n_ids, n_docs, index, _ = (int(x) for x in np.frombuffer(self.file.read(TRAILER), "<i8"))
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError(f"not a packed id file: {uri}")
        n_blocks = -(-self.n_ids // self.block)
        self.file.seek(index)
        parts = np.frombuffer(self.file.read(size - TRAILER - index), "<i8")
        self.offsets, self.starts, self.ids, self.null = np.split(parts, np.cumsum([n_blocks + 1, n_docs + 1, n_docs]))

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` of the file, from the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, "<u4")
        low, high = start // self.block, -(-stop // self.block)
        self.file.seek(int(self.offsets[low]))
        out = []
        for b in range(low, high):
            data = self.file.read(int(self.offsets[b + 1] - self.offsets[b]))
            out.append(unpacked(data, self.width, min(self.block, self.n_ids - b * self.block)))
        return np.concatenate(out)[start - low * self.block : stop - low * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) in order, reading a few blocks at a time."""
        at, held = 0, np.zeros(0, "<u4")
        for n in range(len(self.ids)):
            start, stop = int(self.starts[n]), int(self.starts[n + 1])
            if stop > at + len(held):
                until = min(self.n_ids, max(stop, -(-stop // self.block) * self.block))
                held, at = np.concatenate([held[start - at :], self.read(at + len(held), until)]), start
            yield (None if self.null[n] else int(self.ids[n])), start, held[start - at : stop - at]


def _written_files(folder: str, path: str, leading: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = uri = None
        first = (0, 0)
        with encoding(path, leading) as encoder:
            for batch in slices(batches, "text"):
                if out is None:
                    uri = files.own_name(folder, TaskContext.get().partitionId(), ".ids")
                    out = Writer(uri, width_of(encoder.vocabulary))
                    first = (batch.column(KEY[0])[0].as_py(), batch.column(KEY[1])[0].as_py())
                texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                    out.add(doc_id, np.frombuffer(ids + END_ID.to_bytes(4, "little"), "<u4"))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": uri, "n_docs": len(out.ids), "n_ids": out.starts[-1], "first_id": first[0], "first_hash": first[1]}])

    return rows


def write_ids(docs: DataFrame, path: str, leading: bool = False) -> DataFrame:
    """Write all ids in ascending (doc_id, text hash) order; gives the manifest: one row per file, with ``start``, the ids before it."""
    folder = shared_folder(docs.sparkSession, "token-ids")
    ordered = with_key(docs.select("doc_id", "text")).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    manifest = written(ordered.mapInArrow(_written_files(folder, path, leading), MANIFEST), "token-manifest")
    before = Window.orderBy("first_id", "first_hash").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            out: list[tuple] = []
            for doc_id, start, ids in Reader(row["path"]).documents():
                out.append((doc_id, row["start"] + start, len(ids), zlib.crc32(ids.tobytes())))
                if len(out) == 10_000:
                    yield _digests(out)
                    out = []
            yield _digests(out)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    one_each = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")
    return one_each.mapInArrow(_read_files, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
