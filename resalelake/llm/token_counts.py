"""Token counts of whole texts by byte-pair merging, without making token ids.

A text is cut into pieces as the vocabulary's tokenizer cuts it. A piece starts as one symbol per byte; symbols are
a doubly linked list, and a heap holds the adjacent pairs that can merge, by rank and then place. The least pair is merged as
long as there is one; entries whose pair is gone are passed over. The piece's count is its bytes minus its merges. A special
token's string is one token, found before the text is cut.

Nothing is shuffled: each task counts its own texts. Units between single spaces, and the pieces in them, are counted once
per task and kept in tables of at most ``KEPT`` entries, which end with the task.

Defined cases: a null text is empty; an empty text has no tokens; null ids, repeated rows and ties are counted row by row; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from resalelake.llm.common import slices

LIMIT = 512
#: Entries of a task's tables of units and of pieces, after which one starts anew.
KEPT = 300_000
#: Longer units and pieces are counted each time, so that tables stay small.
LONGEST = 64

# White space, and the cuts of the public byte-level tokenizer.
_WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUTS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"


def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class MergeCounter:
    """``count`` gives the number of tokens of a text under a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, letters = described["model"], byte_letters()
        vocabulary: dict[str, int] = model["vocab"]
        self.symbol = [0] * 256
        for letter, byte in letters.items():
            self.symbol[byte] = vocabulary[letter]
        self.bits = max(vocabulary.values()).bit_length()
        #: (left symbol, right symbol) in one number -> (rank, merged symbol).
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[left] << self.bits | vocabulary[right]] = (rank, vocabulary[left + right])
        special = sorted((t["content"] for t in described["added_tokens"] if t["special"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.cuts = regex.compile(_CUTS)
        self.white = regex.compile(rf"\x20(?:[{_WHITE}]|\Z)")
        self.units: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def merged(self, piece: bytes) -> int:
        """Tokens of one piece: its symbols minus the merges."""
        symbols = [self.symbol[b] for b in piece]
        n = len(symbols)
        if n < 2:
            return n
        merges, bits = self.merges, self.bits
        heap = []
        for at in range(n - 1):
            found = merges.get(symbols[at] << bits | symbols[at + 1])
            if found:
                heap.append((found[0], at, found[1]))
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            rank, at, made = heappop(heap)
            right = after[at]
            if symbols[at] < 0 or right >= n:
                continue
            now = merges.get(symbols[at] << bits | symbols[right])
            if not now or now[0] != rank:
                continue
            symbols[at], symbols[right] = made, -1
            left -= 1
            follows = after[at] = after[right]
            if follows < n:
                before[follows] = at
                found = merges.get(made << bits | symbols[follows])
                if found:
                    heappush(heap, (found[0], at, found[1]))
            leads = before[at]
            if leads >= 0:
                found = merges.get(symbols[leads] << bits | made)
                if found:
                    heappush(heap, (found[0], leads, found[1]))
        return left

    def _piece(self, piece: str) -> int:
        found = self.pieces.get(piece)
        if found is None:
            found = self.merged(piece.encode())
            if len(piece) <= LONGEST:
                if len(self.pieces) >= KEPT:
                    self.pieces.clear()
                self.pieces[piece] = found
        return found

    def _unit(self, unit: str) -> int:
        found = self.units.get(unit)
        if found is None:
            found = sum(map(self._piece, self.cuts.findall(unit)))
            if len(unit) <= LONGEST:
                if len(self.units) >= KEPT:
                    self.units.clear()
                self.units[unit] = found
        return found

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        if self.white.search(text):
            # The tokenizer cuts before a space that a character follows which is not white.
            units, parts = [], text.split(" ")
            for part in parts:
                if units and (not part or part[0].isspace()):
                    units[-1] += " " + part
                else:
                    units.append(part)
        else:
            units = text.split(" ")
        get, count = self.units.get, self._unit
        total = count(units[0])
        for unit in units[1:]:
            unit = " " + unit
            found = get(unit)
            total += count(unit) if found is None else found
        return total

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


def _counted(path: str, limit: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = MergeCounter(path)
        for batch in slices(batches, "text"):
            texts = batch.column("text").fill_null("")
            sizes = pc.binary_length(texts.cast(pa.binary())).cast(pa.int64())
            counts = [counter.count(t) for t in texts.to_pylist()]
            columns = [batch.column("doc_id"), sizes, pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows


def counted(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_counted(path, limit), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
