"""Links between the tokens that two tokenizers make of the same bytes.

Tokens are rows of sparse token-byte incidence matrices in compressed rows (``Csr``), built from token lengths. Gustavson's
product of one with the transpose of the other, row by row, links tokens that overlap and says by how many bytes. Offsets
where tokens of both sides end cut the bytes into groups; products of token-group incidences link tokens of one group. The links
whose ends agree are those of the overlap product that end at a cut.

Both tokenizers cut before a single space between two characters that are not white: A by its rule of cuts, B because no
piece holds a space after another character (checked when it is loaded). So a text is a list of units, and a slice of
documents is one block-diagonal matrix with one block for each distinct unit.

``aligned`` works in three steps. Tasks encode chunks of documents; a chunk keeps its distinct units (links, numbers of
tokens), its documents as lists of unit numbers, and its count of each id pair. Counts of pairs are summed over all chunks, with
the highest per B id. The pairs of a chunk then meet its units and documents again. What is shuffled is the distinct id pairs
of each chunk and, once, its lists of unit numbers; a pair of which every chunk has some is split by chunk. A chunk is written
and moved in parts, so no row is of a chunk's size.

Defined cases: texts that are null, empty or not given back byte by byte by both tokenizers have no tokens, and count for nothing; null ids,
repeated rows and ties are rows of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import given_back, slices, written
from resalelake.llm.token_counts import byte_letters

#: Bytes of text in a chunk.
CHUNK = 10 << 20
#: Bytes of a row that is part of a chunk; arrays of half a region or more lie apart in the JVM's heap.
PART = 1 << 18
#: Bytes of new units that are linked at a time, and encoded as one text.
AT_ONCE = 1 << 18
TOGETHER = 1 << 13
#: Copies of a pair's sum, so that a pair of every chunk is not one task's.
COPIES = 8
#: Products whose links would be more than this are made in blocks of rows.
BLOCK_LINKS = 1 << 22


@dataclass(frozen=True)
class Csr:
    """A sparse matrix in compressed rows: row r has the columns ``columns[starts[r]:starts[r + 1]]``, each once."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def intervals(cls, lengths: np.ndarray) -> Csr:
        """Row r holds ones in ``lengths[r]`` columns, right of those of row r - 1: tokens by bytes."""
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return cls(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64), int(starts[-1]))

    @classmethod
    def labels(cls, label: np.ndarray, width: int) -> Csr:
        """Row r holds a one in column ``label[r]``: tokens by groups."""
        return cls(np.arange(len(label) + 1), label.astype(np.int64), np.ones(len(label), np.int64), width)

    def transposed(self) -> Csr:
        row = np.repeat(np.arange(self.rows), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, row[order], self.values[order], self.rows)

    def _blocks(self, other: Csr) -> Iterator[tuple[int, int]]:
        """Ranges of rows whose products have about ``BLOCK_LINKS`` terms, one row at least."""
        terms = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])[self.starts]
        at = 0
        while at < self.rows:
            stop = max(at + 1, int(np.searchsorted(terms, terms[at] + BLOCK_LINKS, "right")) - 1)
            yield at, stop
            at = stop

    def times(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Gustavson: each row is the sum of the rows of ``other`` that its columns name. Blocks of (row, column, value) in order."""
        sizes = np.diff(other.starts)
        for first, stop in self._blocks(other):
            low, high = self.starts[first], self.starts[stop]
            named = self.columns[low:high]
            n = sizes[named]
            ends = np.cumsum(n)
            take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(other.starts[named] - (ends - n), n)
            row = np.repeat(np.repeat(np.arange(first, stop), np.diff(self.starts[first : stop + 1])), n)
            column = other.columns[take]
            value = np.repeat(self.values[low:high], n) * other.values[take]
            key = row * other.width + column
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, row, column, value = key[order], row[order], column[order], value[order]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            yield row[new], column[new], np.add.reduceat(value, new) if len(new) else value


@dataclass(frozen=True)
class Linked:
    """Tokens of some units side by side, and their matrices."""

    a: np.ndarray
    b: np.ndarray
    a_lengths: np.ndarray
    b_lengths: np.ndarray

    @property
    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_lengths), np.cumsum(self.b_lengths)

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, shared bytes)."""
        return Csr.intervals(self.a_lengths).times(Csr.intervals(self.b_lengths).transposed())

    def ending(self) -> tuple[np.ndarray, np.ndarray]:
        """Overlapping tokens that end together."""
        a_ends, b_ends = self.ends
        found = []
        for i, j, _ in self.overlaps():
            same = a_ends[i] == b_ends[j]
            found.append((i[same], j[same]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def groups(self) -> tuple[Csr, Csr]:
        """Tokens by groups, of each side; a group is what lies between two ends that both sides have."""
        a_ends, b_ends = self.ends
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        return Csr.labels(np.searchsorted(cuts, a_ends), len(cuts)), Csr.labels(np.searchsorted(cuts, b_ends), len(cuts))

    def grouped(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, 1) of one group, in blocks."""
        a, b = self.groups()
        return a.times(b.transposed())


#: White space of either tokenizer, and the end; and a space before one.
_WHITE_AT_START = re.compile(rb"[\t-\r \x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2[\x80\x81]|\xe3\x80\x80|\Z")
#: A unit that cannot stand beside others: white space or its mark at an end.
_WHITE_AT_EDGE = re.compile(rb"\A(?:[\t-\r \x1c-\x1f]|[\xc2\xe1\xe2\xe3])|(?:[\t-\r \x1c-\x1f]|[\x80-\x8a\xa8\xa9\xaf\x85\xa0\x9f\x81])\Z")
_RUN = re.compile(rb"(?:\A| )(?:[\t-\r \x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2[\x80\x81]|\xe3\x80\x80|\Z)")


def units_of(text: bytes) -> list[bytes]:
    """Space and text, cut where both tokenizers cut; units are without their first space."""
    parts = text.split(b" ")
    if not _RUN.search(text):
        return parts
    units = parts[:1]
    for part in parts[1:]:
        if not units[-1] or units[-1].endswith(b" ") or _WHITE_AT_START.match(part):
            units[-1] += b" " + part
        else:
            units.append(part)
    return units


def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..most, left-aligned, and their number."""
    digits = len(str(most))
    numbers = np.char.encode(np.arange(most + 1).astype(str)).astype(f"S{digits}")
    return numbers.view(np.uint8).reshape(-1, digits), np.char.str_len(numbers).astype(np.int64)


class Aligner:
    """Both tokenizers, their token bytes, and units linked at a time."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        with open(a_path, encoding="utf-8") as file:
            described = json.load(file)
        by_id = {i: bytes(letters[c] for c in t) for t, i in described["model"]["vocab"].items()}
        by_id.update({t["id"]: t["content"].encode() for t in described["added_tokens"] if t["id"] not in by_id})
        self.a_bytes = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"{b_path}: a piece holds a space after another character, so texts cannot be cut at spaces")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = tuple(np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.pools = tuple((np.frombuffer(b"".join(t), np.uint8), np.cumsum(n) - n) for t, n in zip((self.a_bytes, self.b_bytes), self.sizes))
        self.digits, self.n_digits = _decimals(max(len(self.a_bytes), len(self.b_bytes)))

    def _bytes(self, side: int, ids: np.ndarray) -> bytes:
        """What the tokens spell."""
        pool, starts = self.pools[side]
        sizes = self.sizes[side][ids]
        ends = np.cumsum(sizes)
        return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[ids] - (ends - sizes), sizes)].tobytes()

    def _together(self, units: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of units encoded as one text, and how many each has; None where a side does not give the text back unit by unit."""
        text = b" " + b" ".join(units)
        ends, out = np.cumsum([len(u) + 1 for u in units]), []
        for side, ids in enumerate((self.a.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, self.b.encode(text[1:].decode()))):
            ids = np.array(ids, np.int64)
            stops = np.cumsum(self.sizes[side][ids])
            at = np.searchsorted(stops, ends)
            if not len(ids) or stops[-1] != ends[-1] or (stops[at] != ends).any() or self._bytes(side, ids) != text:
                return None
            out.append((ids, np.diff(at + 1, prepend=0)))
        return out

    def _apart(self, unit: bytes) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """The ids of one unit, or None where a side does not give it back."""
        text, out = unit.decode(), []
        for side, ids in enumerate((self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text))):
            ids = np.array(ids, np.int64)
            if self._bytes(side, ids) != b" " + unit:
                return None
            out.append((ids, np.array([len(ids)])))
        return out

    def encoded(self, units: list[bytes]) -> tuple[Linked, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the units side by side, their numbers per unit on either side, and whether both sides give the unit back;
        one that they do not has no tokens. Runs of units without white space at their ends are encoded as one text."""
        parts: list[list[np.ndarray]] = [[], [], [], []]
        good = np.ones(len(units), bool)
        at = 0
        while at < len(units):
            stop, size = at, 0
            while stop < len(units) and size < TOGETHER and units[stop] and not _WHITE_AT_EDGE.search(units[stop]):
                size += len(units[stop])
                stop += 1
            found = self._together(units[at:stop]) if stop > at else None
            if found is None:
                stop = max(stop, at + 1)
                each = [self._apart(u) for u in units[at:stop]]
                none = [(np.zeros(0, np.int64), np.zeros(1, np.int64))] * 2
                good[at:stop] = [x is not None for x in each]
                found = [tuple(np.concatenate(x) for x in zip(*side)) for side in zip(*[x or none for x in each])]
            for part, values in zip(parts, (v for side in found for v in side)):
                part.append(values)
            at = stop
        a, unit_a, b, unit_b = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
        return Linked(a, b, self.sizes[0][a], self.sizes[1][b]), unit_a, unit_b, good

    def written(self, linked: Linked, unit_a: np.ndarray, unit_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Text of the groups of all units, ``a1,a2|b1;``..., and where each unit's text begins; units hold whole groups."""
        in_a, in_b = linked.groups()
        by_a, by_b = in_a.transposed(), in_b.transposed()
        width = in_a.width
        # Group g writes its A tokens, then its B tokens: as many tokens as come before it, on either side.
        place_a = by_b.starts[:width].repeat(np.diff(by_a.starts)) + np.arange(len(linked.a))
        place_b = by_a.starts[1:].repeat(np.diff(by_b.starts)) + np.arange(len(linked.b))
        total = len(linked.a) + len(linked.b)
        ids, stop = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[place_a[by_a.columns]], ids[place_b[by_b.columns]] = linked.a[by_a.columns], linked.b[by_b.columns]
        stop[place_a[by_a.starts[1:] - 1]] = ord("|")
        stop[place_b[by_b.starts[1:] - 1]] = ord(";")
        sizes = self.n_digits[ids]
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.zeros(starts[-1], np.uint8)
        for d in range(self.digits.shape[1]):
            has = np.flatnonzero(sizes > d)
            out[starts[has] + d] = self.digits[ids[has], d]
        out[starts[1:] - 1] = stop
        return out.tobytes(), starts[np.concatenate([[0], np.cumsum(unit_a + unit_b)])]


class Chunk:
    """Distinct units of some documents, numbered as they come, with their tokens and links."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.numbers: dict[bytes, int] = {}
        self.new: list[bytes] = []
        self.good: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.texts: list[bytes] = []
        self.ids: list = []
        self.docs: list[np.ndarray] = []
        self.bytes = 0

    def _learn(self, units: list[bytes]) -> None:
        at = 0
        while at < len(units):
            stop, size = at, 0
            while stop < len(units) and (stop == at or size + len(units[stop]) < AT_ONCE):
                size += len(units[stop])
                stop += 1
            linked, unit_a, unit_b, good = self.aligner.encoded(units[at:stop])
            i, j = linked.ending()
            of_unit = np.repeat(np.arange(stop - at), unit_a)[i]
            n_links = np.bincount(of_unit, minlength=stop - at)
            text, starts = self.aligner.written(linked, unit_a, unit_b)
            groups, _ = linked.groups()
            last = np.cumsum(unit_a) - 1
            before = np.where(last >= 0, groups.columns[np.maximum(last, 0)] + 1, 0) if len(linked.a) else np.zeros(stop - at, np.int64)
            self.good.append(good)
            self.counts.append(np.stack([unit_a, unit_b, np.diff(before, prepend=0), n_links], axis=1).astype(np.int32))
            self.links.append(linked.a[i] << 32 | linked.b[j])
            self.texts += [text[s:e] for s, e in zip(starts, starts[1:])]
            at = stop

    def add(self, doc_id, text: bytes) -> None:
        units = units_of(text) if text else []
        numbers = self.numbers
        new = [u for u in dict.fromkeys(units) if u not in numbers]
        for unit in new:
            numbers[unit] = len(numbers)
        self.new += new
        self.ids.append(doc_id)
        self.docs.append(np.fromiter(map(numbers.__getitem__, units), np.int32, len(units)))
        self.bytes += len(text)

    def row(self) -> dict:
        """What is kept of the chunk, which is used up: arrays as little-endian bytes."""
        # Units that are encoded as one text come first.
        odd = np.array([bool(_WHITE_AT_EDGE.search(u)) or not u for u in self.new], bool)
        order = np.argsort(odd, kind="stable")
        new, self.new, self.numbers = [self.new[n] for n in order], [], {}
        self._learn(new)
        del new
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.docs = [place[units] for units in self.docs]
        good = np.concatenate(self.good) if self.good else np.zeros(0, bool)
        counts = np.concatenate(self.counts) if self.counts else np.zeros((0, 4), np.int32)
        links = np.concatenate(self.links) if self.links else np.zeros(0, np.int64)
        self.good, self.counts, self.links = [], [], []
        hashes, sums = [], []
        for n, units in enumerate(self.docs):
            if not good[units].all():
                self.docs[n] = units = units[:0]
            sums.append(counts[units].sum(axis=0, dtype=np.int64))
            hashes.append(hashlib.sha256(b"".join(map(self.texts.__getitem__, units.tolist()))[:-1]).hexdigest() if len(units) else "")
        self.texts = []
        used = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int32)
        uses = np.bincount(used, minlength=len(good))
        sums = np.stack(sums) if sums else np.zeros((0, 4), np.int64)
        of_unit = np.repeat(np.arange(len(good)), counts[:, 3])
        pairs, number = np.unique(links, return_inverse=True)
        times = np.bincount(number, weights=uses[of_unit], minlength=len(pairs)).astype(np.int64)
        return {
            "doc_ids": self.ids,
            **{name: sums[:, n].tolist() for n, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "groups_sha256": hashes,
            "doc_units": np.array([len(u) for u in self.docs], np.int64).tobytes(),
            "units": used.tobytes(),
            "unit_links": counts[:, 3].astype(np.int32).tobytes(),
            "links": number.astype(np.int32).tobytes(),
            "pairs": pairs.tolist(),
            "times": times.tolist(),
        }


def _parts(row: dict) -> Iterator[dict]:
    """A chunk's row dealt out in order to rows of about ``PART`` bytes; lists of documents are cut alike, bytes anywhere."""
    size = sum(len(v) for v in row.values() if isinstance(v, bytes)) + 16 * len(row["pairs"]) + 128 * len(row["doc_ids"])
    n = max(1, -(-size // PART))
    for part in range(n):
        yield {"part": part} | {name: v[len(v) * part // n : len(v) * (part + 1) // n] for name, v in row.items()}


def _chunks(a_path: str, b_path: str, limit: int, schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        task = TaskContext.get().partitionId() << 32
        made, chunk = 0, Chunk(aligner)

        def batches_of(done: Chunk) -> Iterator[pa.RecordBatch]:
            for part in _parts(done.row()):
                yield pa.RecordBatch.from_pylist([{"chunk": task + made} | part], schema)
            given_back()

        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                chunk.add(doc_id, text)
                if chunk.bytes >= limit:
                    yield from batches_of(chunk)
                    made, chunk = made + 1, Chunk(aligner)
        if chunk.ids:
            yield from batches_of(chunk)
        del aligner, chunk
        given_back()

    return rows


def _with_counts(kind: pa.DataType):
    """Sums of a chunk's documents from the corpus-wide counts of its pairs."""

    def rows(chunks: pa.Table, counts: pa.Table) -> pa.Table:
        counts = counts.sort_by("pair")
        total, best = counts["n"].to_numpy(), counts["best"].to_numpy().astype(np.int64)
        chunks = chunks.sort_by("part")
        row = {name: b"".join(chunks[name].to_pylist()) for name in ("doc_units", "units", "unit_links", "links")}
        place, unit_links = np.frombuffer(row["links"], np.int32), np.frombuffer(row["unit_links"], np.int32)
        of_unit = np.repeat(np.arange(len(unit_links)), unit_links)
        units, sizes = np.frombuffer(row["units"], np.int32), np.frombuffer(row["doc_units"], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for values in (best, total):
            each = np.zeros(len(unit_links), np.int64)
            np.add.at(each, of_unit, values[place])
            run = np.concatenate([[0], np.cumsum(each[units])])
            out.append(pa.array(run[ends[1:]] - run[ends[:-1]], pa.int64()))
        names = ["doc_ids", "n_a", "n_b", "n_groups", "n_links"]
        columns = [chunks[c].combine_chunks().flatten() for c in names]
        columns[0] = columns[0].cast(kind)
        return pa.table([*columns, *out, chunks["groups_sha256"].combine_chunks().flatten()], ["doc_id", *names[1:], "n_best", "count_sum", "groups_sha256"])

    return rows


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, n: links of all documents that hold the id pair (A id << 32 | B id); best: no pair of its B id has more."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    # An id of B has at most as many pairs as A has ids.
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, copies: int = COPIES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"
    layout = f"chunk long, part int, doc_ids array<{kind}>, {lists}, doc_units binary, units binary, unit_links binary, links binary, pairs array<long>, times array<long>"
    schema = to_arrow_schema(StructType.fromDDL(layout))
    chunks = written(docs.select("doc_id", "text").mapInArrow(_chunks(a_path, b_path, chunk, schema), layout), "aligned-chunks")
    counts = written(pair_counts(chunks), "pair-counts")
    copied = counts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    asked = chunks.select("chunk", F.pmod(F.xxhash64("chunk"), F.lit(copies)).cast("int").alias("copy"), F.explode("pairs").alias("pair"))
    found = asked.join(copied, ["pair", "copy"]).select("chunk", "pair", "n", "best")
    kept = chunks.drop("pairs", "times").withColumnRenamed("chunk", "number")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    doc_kind = schema.field("doc_ids").type.value_type
    return kept.groupBy("number").cogroup(found.groupBy("chunk")).applyInArrow(_with_counts(doc_kind), out)


def _links(a_path: str, b_path: str, kind: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            for n, text in enumerate(texts):
                linked, _, _, good = aligner.encoded(units_of(text) if text else [])
                if not good.all():
                    continue
                a_ends, b_ends = linked.ends
                for i, j, value in linked.overlaps() if kind == "bytes" else linked.grouped():
                    columns = [batch.column("doc_id").take(pa.array(np.full(len(i), n))), *map(pa.array, (i, j, linked.a[i], linked.b[j]))]
                    columns += [pa.array(x) for x in (a_ends[i] - linked.a_lengths[i], a_ends[i], b_ends[j] - linked.b_lengths[j], b_ends[j], value)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_at", "b_at", "a", "b", "a_start", "a_end", "b_start", "b_end", "shared"])

    return rows


def links(docs: DataFrame, a_path: str, b_path: str, kind: str = "bytes") -> DataFrame:
    """One row per link of two tokens: their places, ids and byte spans in space and text, and the bytes (``kind`` "bytes") or groups
    ("groups") they share."""
    if kind not in ("bytes", "groups"):
        raise ValueError("kind is bytes or groups")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, a_at long, b_at long, a long, b long, a_start long, a_end long, b_start long, b_end long, shared long"
    return docs.select("doc_id", "text").mapInArrow(_links(a_path, b_path, kind), schema)
