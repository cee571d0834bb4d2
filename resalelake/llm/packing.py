"""Packing of documents into sequences by bounded-space online best fit.

A document's ids (with an end id) are one piece, or, where they are too long, a shorter piece first and then whole
sequences. Each task places its pieces in the order of its input into at most ``OPEN_BINS`` open sequences: the one with
least free room that still fits, found in a bitset with one bit per amount of free room. When none fits and all are open,
the fullest closes. Nothing is shuffled; a task leaves at most ``OPEN_BINS`` sequences unfilled, and sequence ids hold the
task's number. Input that is read from files keeps its order when a task is repeated, so results repeat too; write
other input first.

Defined cases: null and empty texts are the end id alone; null ids and repeated rows are packed row by row; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from resalelake.llm.common import slices, written
from resalelake.llm.tokens import encoding

SEQUENCE = 1024
OPEN_BINS = 1024
#: Pieces of open sequences that a task of a later round places.
AGAIN = 200_000
END_ID = 2


class BestFit:
    """Open bins by free room. ``place`` gives (bin number, offset within the bin); ``closed`` lists bins that take no more."""

    def __init__(self, size: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self.size, self.open_bins = size, open_bins
        self.by_room: list[list[int]] = [[] for _ in range(size + 1)]
        self.rooms = 0
        self.open = 0
        self.made = 0
        self.closed: list[int] = []

    def _take(self, room: int) -> int:
        bins = self.by_room[room]
        found = bins.pop()
        if not bins:
            self.rooms &= ~(1 << room)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(room)
        else:
            room, bin_ = self.size, self.made
            self.made += 1
        left = room - length
        if left and self.open == self.open_bins:
            fullest = (self.rooms & -self.rooms).bit_length() - 1
            if fullest <= left:
                self.closed.append(self._take(fullest))
            else:
                left = 0
        if left:
            self.by_room[left].append(bin_)
            self.rooms |= 1 << left
            self.open += 1
        else:
            self.closed.append(bin_)
        return bin_, self.size - room


def pieces(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only longer ones are cut, and the first takes the rest."""
    if length <= size:
        return [(0, length)]
    short = length % size
    return ([(0, short)] if short else []) + [(at, size) for at in range(short, length, size)]


ROWS = "piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Sequences:
    """Pieces by the bin they were placed in, handed out once their bin is closed."""

    def __init__(self, task: int, size: int, open_bins: int):
        self.fit, self.task, self.size = BestFit(size, open_bins), task, size
        self.held: dict[int, list[tuple]] = {}
        self.closed: list[tuple] = []

    def place(self, piece: tuple, length: int) -> None:
        """``piece`` is doc_id, piece, start, length, ids_crc32 and, on request, ids."""
        bin_, offset = self.fit.place(length)
        self.held.setdefault(bin_, []).append((*piece[:5], self.task + bin_, offset, *piece[5:]))
        for done in self.fit.closed:
            self.closed += self.held.pop(done, ())
        self.fit.closed.clear()

    def take(self, last: bool = False) -> tuple[list[tuple], list[tuple]]:
        """Pieces of closed bins so far, and at the end those of open ones."""
        done, self.closed = self.closed, []
        return done, [row for rows in self.held.values() for row in rows] if last else []


def _batches(sequences: Sequences, schema: pa.Schema, last: bool = False) -> Iterator[pa.RecordBatch]:
    for rows, open_ in zip(sequences.take(last), (False, True)):
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*zip(*part), [open_] * len(part)], schema)], schema=schema)


def _task(round_: int) -> int:
    return round_ << 56 | TaskContext.get().partitionId() << 32


def _placed(path: str, leading: bool, size: int, open_bins: int, schema: pa.Schema):
    """The first round: pieces of texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, with_ids = END_ID.to_bytes(4, "little"), "ids" in schema.names
        sequences = Sequences(_task(0), size, open_bins)
        with encoding(path, leading) as encoder:
            for batch in slices(batches, "text"):
                texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
                for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                    found += end
                    for k, (start, length) in enumerate(pieces(len(found) // 4, size)):
                        part = found[4 * start : 4 * (start + length)]
                        sequences.place((doc_id, k, start, length, zlib.crc32(part), *([part] if with_ids else [])), length)
                yield from _batches(sequences, schema)
        yield from _batches(sequences, schema, last=True)

    return rows


def _again(round_: int, size: int, open_bins: int, schema: pa.Schema):
    """A later round, in an order that depends on the pieces alone: however they reach the task, a repeated task places them alike.
    With a fixed number of open sequences mixed lengths fill best; by length, long pieces would close them before short ones come."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = [row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in schema.names if c not in ("sequence_id", "offset", "open")))]
        sequences = Sequences(_task(round_), size, open_bins)
        for row in sorted(left, key=lambda r: (zlib.crc32(f"{r[0]} {r[1]} {r[4]}".encode()), str(r[0]), *r[1:5])):
            sequences.place(row, row[3])
        yield from _batches(sequences, schema, last=True)

    return rows


def pack(docs: DataFrame, path: str, leading: bool = True, size: int = SEQUENCE, open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and on request its ids."""
    layout = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ROWS}" + ", ids binary" * with_ids
    kept = T.StructType.fromDDL(layout)
    whole = T.StructType([*kept.fields, T.StructField("open", T.BooleanType())])
    schema = to_arrow_schema(whole)
    found = written(docs.select("doc_id", "text").mapInArrow(_placed(path, leading, size, open_bins, schema), whole), "packed")
    out = found.where("NOT open")
    left = found.where("open")
    n, round_ = left.count(), 1
    while n:
        tasks = -(-n // AGAIN)
        found = written(left.repartition(tasks).mapInArrow(_again(round_, size, open_bins, schema), whole), f"packed-{round_}")
        more = found.where("open")
        before, n = n, more.count()
        # One task has what is left, or another round would not help: open sequences stay as they are.
        if tasks == 1 or n >= before:
            return out.unionByName(found).select(*kept.names)
        out, left, round_ = out.unionByName(found.where("NOT open")), more, round_ + 1
    return out.select(*kept.names)
