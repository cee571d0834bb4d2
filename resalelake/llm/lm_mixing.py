"""Language-model scoring by logistic mixing of hashed-context bit predictors.

A text is a run of tokens (words, then one end). Each word is spelled as bytes and a close, each symbol as the bits of
a Huffman code. A bit is predicted in several contexts: none, the last 1, 2, 3, 4 and 6 symbols of the word, and all of the
word so far. Every context and code node hashes to a slot with two counts. The predictions are mixed in the logistic domain by
weights that a gate (how often the two longest contexts were seen) selects, learned online by descent on coding cost, and an
adaptive probability map then corrects the mix.

Slots of fixed number cannot hold every word of a growing corpus, but the distributed vocabulary does. So two more
predictions join at the word: its discounted count in the whole corpus, and in the documents of a class, a document's class
being the hash of its most frequent short word. What a discount frees goes to the wider prediction, in the end to spelling. While a
text is read, the classes' weights follow how well each has predicted it so far (so its probability is the weighted sum over classes).
Whether a text ends depends on how the token before ended. The log of all this is the score; in bits, over the text's bytes, it is the rate.

Words also follow from the words before them. A word has one of ``WORD_CODES`` Huffman codes (by its crc32), and each bit of it
is predicted in three contexts: none, the word before, and the two words before, again hashed to slots with two counts, summed over
every occurrence in training texts, mixed in the logistic domain by gated weights. Within a code, words share by their counts. For
words that training has, this prediction of the next word and that of the classes are added with a share that a gate selects (how
often the two contexts were seen); it is learned together with the weights, each occurrence taken out of its own counts. For words
that training lacks the classes and the spelling stand alone, and their mass is left out of what the contexts divide.

At scale the unit of work of the spelling is a distinct word, that of the contexts an occurrence. Chunks of documents list their distinct words; the vocabulary is summed over
chunks by a shuffle, trains the spelling model, and is scored once per word; results go back to the chunks that have the word.
So the gathered vocabulary grows with the corpus, while slots, weights and map have fixed sizes set by parameters (about
24 MB, broadcast once). While weights and map are learned, a word's own occurrence is taken out of its counts, so they are fit for
words that were never seen.

Learning uses only rows whose id's crc32 mod 7 is not 2; counts and weights do not change while scoring.

Defined cases: null and empty texts are the end token alone; null ids count as an empty id for the fold; repeated rows count each time;
without training rows every bit costs one bit; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import byte_class, crc32_of_id, mixed, released, slices, span_hashes, span_sums, text_bytes, written

FOLDS = 7
HELD_OUT = 2
#: Text bytes of a chunk; a longer text is a chunk by itself.
CHUNK_BYTES = 12 << 20
#: Distinct words that one task trains on.
TASK_WORDS = 1_200_000
WORDS_AT_ONCE = 4096
CLOSE, END, START = 256, 257, 258
SYMBOLS = 258
#: How the token before ended: start of text, sentence mark, other mark, anything else.
ENDINGS = 4
ORDERS = (1, 2, 3, 4, 6)
#: Classes of documents, and the bytes of the short words that tell them apart.
CLASSES = 8
SHORT = (2, 4)
#: log2 of the slots for no context, each order, and the whole word so far.
SLOT_BITS = (9, 16, 18, 19, 19, 19, 20)
BLOCK_SLOTS = 1 << 14
#: Codes of words, log2 of the slots for the word before and for the two before, and the tokens that one task learns from.
WORD_CODES = 1 << 14
HISTORY_BITS = (21, 21)
TASK_TOKENS = 16_000_000
TOKENS_AT_ONCE = 1 << 15
#: Symbols whose bits are made at once.
SYMBOLS_AT_ONCE = 1 << 11
#: Levels of the log of how much better the contexts predict a word than its code's count.
RATIO_LEVELS = 65
#: Different pairs of counts that are numbered; with more, slots have tables of their own.
DISTINCT = 1 << 20
RATE = 0.1
#: Steps of descent for each batch of words.
STEPS = 16
PRIOR = 0.4
REACH = 8.0
SEEN_LEVELS = 12
MAP_LEVELS = 33

_ending = np.full(256, 3, np.uint8)
_ending[byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))] = 2
_ending[[0x21, 0x2E, 0x3F]] = 1

_offsets = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])])
SLOTS = int(_offsets[-1])
GATES = SEEN_LEVELS * SEEN_LEVELS
_word_offsets = np.cumsum([0, WORD_CODES, *(1 << b for b in HISTORY_BITS)])
WORD_SLOTS = int(_word_offsets[-1])


def first_weights() -> np.ndarray:
    """Where learning starts: the more often the word so far was seen, the more its own prediction counts."""
    out = np.zeros((GATES, len(SLOT_BITS)))
    share = 1 - 0.5 ** np.repeat(np.arange(SEEN_LEVELS), SEEN_LEVELS)
    out[:, -1] = share
    out[:, 2:-1] = (1 - share)[:, None] * 1.2 / (len(SLOT_BITS) - 3)
    return out


def held_out() -> Column:
    return crc32_of_id() % FOLDS == HELD_OUT


class Code:
    """A Huffman code: for each symbol the nodes it passes and the bit taken at each."""

    def __init__(self, weights: np.ndarray):
        heap = [(float(w) + 1, s, s) for s, w in enumerate(weights)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        symbols = node = len(weights)
        while len(heap) > 1:
            (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            parent[left], parent[right] = (node, 0), (node, 1)
            heapq.heappush(heap, (a + b, node, node))
            node += 1
        nodes, bits, sizes = [], [], []
        for symbol in range(symbols):
            path, at = [], symbol
            while at in parent:
                at, bit = parent[at]
                path.append((at - symbols, bit))
            nodes += [n for n, _ in reversed(path)]
            bits += [b for _, b in reversed(path)]
            sizes.append(len(path))
        # Of each symbol's path: twice the node, and the bit.
        self.path, self.sizes = np.array(nodes, np.int64) * 2 + np.array(bits, np.int64), np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes


@dataclass
class Events:
    """Bits to code: the slots of each (contexts x bits) and the bit; how many bits a symbol has, and the number of its owner."""

    slots: np.ndarray
    bits: np.ndarray
    sizes: np.ndarray
    owners: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """Of each bit."""
        return np.repeat(self.owners, self.sizes)

    @property
    def starts(self) -> np.ndarray:
        """Each symbol's first bit."""
        return np.cumsum(self.sizes) - self.sizes


def _events(code: Code, symbols: np.ndarray, contexts: list[np.ndarray], owner: np.ndarray, slot_bits: tuple = SLOT_BITS[1:], offsets: np.ndarray = _offsets) -> Events:
    sizes = code.sizes[symbols]
    at = np.repeat(code.starts[symbols] - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(len(at))
    path = code.path.take(at)
    slots = np.empty((len(slot_bits) + 1, len(at)), np.int64)
    node = np.right_shift(path, 1, out=slots[0])
    salt = (node + 1).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k, (context, bits) in enumerate(zip(contexts, slot_bits), 1):
        hashed = np.repeat(context, sizes)
        hashed ^= salt
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed >>= np.uint64(64 - bits)
        np.add(hashed.view(np.int64), offsets[k], out=slots[k])
    path &= 1
    return Events(slots, path, sizes, owner)


def _pieces(code: Code, symbols: np.ndarray, contexts: list[np.ndarray], owner: np.ndarray, *kind) -> Iterator[Events]:
    """The events of some symbols at a time, few enough for their arrays to stay in a core's cache."""
    for begin in range(0, len(symbols), SYMBOLS_AT_ONCE):
        some = slice(begin, begin + SYMBOLS_AT_ONCE)
        yield _events(code, symbols[some], [c[some] for c in contexts], owner[some], *kind)


def _order_contexts(history: list[np.ndarray], prefix: np.ndarray) -> list[np.ndarray]:
    """``history[k]``: the symbol k+1 back."""
    out, value = [], np.zeros(len(prefix), np.uint64)
    for k, symbol in enumerate(history, 1):
        value = mixed(value + symbol.astype(np.uint64) + np.uint64(1000 * k))
        if k in ORDERS:
            out.append(value)
    return [*out, prefix]


def _symbols(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of the words after their first byte, with the close: the symbols, their contexts and the words they belong to."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    # Position p of a word's symbols 1..size: the symbol at p, or the close at p = size.
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(owner)) - np.repeat(starts, sizes) + 1
    at = starts[owner] + place
    closes = place == sizes[owner]
    symbols = np.where(closes, CLOSE, raw[np.minimum(at, len(raw) - 1)]).astype(np.int64)
    history = [np.where(place >= k, raw[np.maximum(at - k, 0)], START).astype(np.int64) for k in range(1, max(ORDERS) + 1)]
    prefix = span_hashes(raw, starts[owner], at, span_sums(raw))
    return symbols, _order_contexts(history, prefix), owner


def word_events(code: Code, words: list[bytes]) -> Events:
    """Bits of the words after their first byte, with the close."""
    return _events(code, *_symbols(words))


def first_events(code: Code) -> Events:
    """Bits of each symbol as a first one; owner: the symbol."""
    symbols = np.arange(SYMBOLS)
    start = np.full(SYMBOLS, START)
    return _events(code, symbols, _order_contexts([start] * max(ORDERS), np.full(SYMBOLS, 12345, np.uint64)), symbols)


def add_counts(counts: np.ndarray, events: Events, weight: np.ndarray | None = None, first: int = 0) -> None:
    """``counts``: (SLOTS, 2); ``weight``: of each owner, one without it; ``first``: the first context that is counted."""
    flat = counts.reshape(-1)
    some = np.float32(1) if weight is None else weight[events.owner]
    for slots in events.slots[first:]:
        at = slots * 2
        at += events.bits
        np.add.at(flat, at, some)


def _level(seen: np.ndarray) -> np.ndarray:
    # The exponent of a 32-bit float is its log2, rounded down.
    exponent = (np.maximum(seen, 0) + np.float32(1)).astype(np.float32).view(np.int32) >> 23
    return np.minimum(exponent - 127, SEEN_LEVELS - 1).astype(np.uint8)


def coded(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """The different pairs of counts that slots hold, and the number of each slot's pair; all pairs and None where too many differ."""
    pairs = counts.reshape(-1).view(np.uint64)
    seen = np.unique(pairs)
    if len(seen) > DISTINCT:
        return counts, None
    codes = np.searchsorted(seen, pairs).astype(np.uint16 if len(seen) <= 1 << 16 else np.uint32)
    return seen.view(np.float32).reshape(-1, 2), codes


class Tables:
    """What counts predict: the stretched prediction, and the level of what was seen; with ``own`` by bit, one occurrence of that bit
    taken out. Made once for each pair of counts (``seen``, ``codes``: of slots), they spare a logarithm for every bit that is read,
    and what is read at random is small."""

    def __init__(self, seen: np.ndarray, codes: np.ndarray | None, own: bool = False):
        self.codes, self.own = codes, own
        kinds = 2 if own else 1
        wide = codes is not None
        self.stretched = np.empty((len(seen), kinds), np.float64 if wide else np.float32)
        self.levels = np.empty((len(seen), kinds), np.int64 if wide else np.uint8)
        for begin in range(0, len(seen), BLOCK_SLOTS):
            some = slice(begin, begin + BLOCK_SLOTS)
            for bit in range(kinds):
                zero, one = seen[some, 0], seen[some, 1]
                if own:
                    zero, one = (np.maximum(x - np.float32(taken), 0) for x, taken in ((zero, bit == 0), (one, bit == 1)))
                self.stretched[some, bit] = np.clip(np.log((one + np.float32(PRIOR)) / (zero + np.float32(PRIOR))), -REACH, REACH)
                self.levels[some, bit] = _level(zero + one)
        self.stretched, self.levels = self.stretched.reshape(-1), self.levels.reshape(-1)

    def places(self, slots: np.ndarray, bits: np.ndarray) -> np.ndarray:
        at = slots if self.codes is None else self.codes.take(slots).astype(np.int64)
        if self.own:
            at = at * 2
            at += bits
        return at

    def predicted(self, events: Events, gating: tuple) -> tuple[np.ndarray, list[np.ndarray]]:
        """Stretched predictions (contexts x bits), and of the contexts ``gating`` the levels."""
        at = self.places(events.slots, events.bits)
        return self.stretched.take(at), [self.levels.take(at[k]).astype(np.int64, copy=False) for k in gating]


def _tables(counts) -> Tables:
    return counts if isinstance(counts, Tables) else Tables(*coded(counts))


#: The contexts whose levels select: the gate by the longest of all and the longest fixed order but one, the map's row by order 3.
GATING = (6, 4, 3)


def _inputs(tables: Tables, events: Events) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretched predictions, gates, and the map's row."""
    stretched, (longest, fixed, row) = tables.predicted(events, GATING)
    return stretched, _gates(longest, fixed), row


def _gates(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    out = first * SEEN_LEVELS
    out += second
    return out


def _mix(stretched: np.ndarray, gates: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``weights``: (gates, contexts)."""
    z = None
    for x, w in zip(stretched, np.ascontiguousarray(weights.T)):
        own = w.take(gates)
        own *= x
        z = own if z is None else np.add(z, own, out=z)
    return z


@dataclass
class Model:
    """``counts``, or their tables, are put in where the model is used."""

    code: Code
    counts: np.ndarray | None
    weights: np.ndarray
    map: np.ndarray | None = None

    def cost(self, events: Events) -> np.ndarray:
        """log10 probability of each bit."""
        stretched, gates, row = _inputs(_tables(self.counts), events)
        return _log_sigmoid(self.refined(_mix(stretched, gates, self.weights), row), events.bits) / np.log(10)

    def refined(self, z: np.ndarray, row: np.ndarray) -> np.ndarray:
        z = np.clip(z, -REACH * 1.5, REACH * 1.5)
        if self.map is None:
            return z
        low, share = _map_place(z)
        flat, at = self.map.reshape(-1), row * MAP_LEVELS + low
        corrected = flat.take(at) * (1 - share) + flat.take(at + 1) * share
        return (z + corrected) / 2


def _map_place(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = (np.clip(z, -REACH, REACH) + REACH) / (2 * REACH) * (MAP_LEVELS - 1)
    low = np.minimum(at.astype(np.int64), MAP_LEVELS - 2)
    return low, at - low


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, WORDS_AT_ONCE):
            batch = whole.slice(at, WORDS_AT_ONCE)
            yield batch.column("word").to_pylist(), batch.column("c").to_numpy()


def planes(tokens: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: the last are mostly zero and compress."""
    return tokens.view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def shrunk(tokens: np.ndarray) -> bytes:
    return pa.compress(planes(tokens), codec="zstd", asbytes=True)


def from_shrunk(data: pa.Buffer, size: int) -> np.ndarray:
    return from_planes(pa.decompress(data, 4 * size, codec="zstd"))


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(planes(np.ascontiguousarray(counts).reshape(-1).view(np.uint32)), 1)


def unpacked(data: bytes) -> np.ndarray:
    return from_planes(zlib.decompress(data)).view(np.float32)


class Packed:
    """Counts that are unpacked, and made into tables, once per process."""

    def __init__(self, counts: np.ndarray):
        self.seen, codes = coded(counts)
        self.kind = None if codes is None else (codes.dtype, codes.nbytes)
        self.codes = None if codes is None else pa.compress(codes.tobytes(), codec="zstd", asbytes=True)

    def __getstate__(self):
        return {"seen": self.seen, "kind": self.kind, "codes": self.codes}

    def tables(self, own: bool) -> Tables:
        if "found" not in self.__dict__ or self.found.own != own:
            codes = None if self.kind is None else np.frombuffer(pa.decompress(self.codes, self.kind[1], codec="zstd"), self.kind[0])
            self.found = Tables(self.seen, codes, own)
        return self.found


class Shared:
    """Counts as a broadcast, packed: Spark writes one file of it on each machine."""

    def __init__(self, sc, counts: np.ndarray):
        self.broadcast = sc.broadcast(Packed(counts))

    def tables(self, own: bool = False) -> Tables:
        return self.broadcast.value.tables(own)


def _count_blocks(code):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((SLOTS, 2), np.float32)
        for words, c in _batches(batches):
            for events in _pieces(code.value, *_symbols([w for w, n in zip(words, c.tolist()) if n])):
                add_counts(counts, events)
        yield from _blocks(counts)

    return rows


def _blocks(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for block in range(0, len(counts), BLOCK_SLOTS):
        part = counts[block : block + BLOCK_SLOTS]
        if part.any():
            yield pa.RecordBatch.from_pylist([{"block": block, "task": task, "counts": packed(part)}])


def _added(table: pa.Table) -> pa.Table:
    total = sum(unpacked(x).astype(np.float64) for x in table.column("counts").to_pylist())
    return pa.table({"block": table.column("block")[:1], "counts": pa.array([packed(total.astype(np.float32))], pa.binary())})


BLOCK = "block bigint, task bigint, counts binary"


def _gathered(blocks: DataFrame, tasks: int, slots: int) -> np.ndarray:
    """The counts of all tasks, summed."""
    fan = int(np.ceil(tasks**0.5))
    halfway = blocks.groupBy("block", F.pmod("task", F.lit(fan)).alias("part")).applyInArrow(_added, "block bigint, counts binary")
    total = halfway.groupBy("block").applyInArrow(_added, "block bigint, counts binary").toArrow()
    counts = np.zeros((slots, 2), np.float32)
    for block, part in zip(total.column("block").to_pylist(), total.column("counts")):
        values = unpacked(part.as_py()).reshape(-1, 2)
        counts[block : block + len(values)] = values
    return counts


def _descend(weights: np.ndarray, squares: np.ndarray, mass: np.ndarray, stretched: np.ndarray, gates: np.ndarray, bits: np.ndarray, weight: np.ndarray | None = None) -> None:
    """Moves ``weights`` down the coding cost of the bits; ``mass``: what each gate has seen; ``weight``: of each bit, one without it."""
    size, more = divmod(len(gates), STEPS)
    for step in range(STEPS):
        begin = step * size + min(step, more)
        part = slice(begin, begin + size + (step < more))
        x, g = stretched[:, part], gates[part]
        p = _mix(x, g, weights)
        np.negative(p, out=p)
        np.exp(p, out=p)
        p += 1
        np.reciprocal(p, out=p)
        error = np.subtract(bits[part], p, out=p)
        if weight is None:
            seen = np.bincount(g, minlength=GATES).astype(float)
        else:
            error *= weight[part]
            seen = np.bincount(g, weights=weight[part], minlength=GATES)
        some = seen > 0
        slope = np.stack([np.bincount(g, weights=error * row, minlength=GATES) for row in x], axis=1)[some] / seen[some, None]
        squares[some] += slope**2
        weights[some] += RATE * slope / np.sqrt(squares[some]) * np.minimum(1, seen[some] / 100)[:, None]
        mass += seen


def _joined(pieces: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(x, axis=-1) for x in zip(*pieces)]


def _learned(model: Model, counts):
    """Descends on the coding cost over a task's words; gives its weights and what each gate has seen."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = counts.tables(own=True)
        weights = model.weights.copy()
        squares, mass = np.full(weights.shape, 1e-6), np.zeros(GATES)
        for words, c in _batches(batches):
            if not c.any():
                continue
            known = (c > 0).astype(np.float64)
            pieces = [(*_inputs(tables, e)[:2], e.bits, known[e.owner]) for e in _pieces(model.code, *_symbols(words))]
            _descend(weights, squares, mass, *_joined(pieces))
        out = np.concatenate([(weights * mass[:, None]).ravel(), mass])
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["sums"])

    return rows


def _mapped(model: Model, counts):
    """Sums for the probability map: weight, and weight of ones, by row and level of the mix."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = counts.tables(own=True)
        size = SEEN_LEVELS * MAP_LEVELS
        sums = np.zeros((2, size))
        for words, c in _batches(batches):
            for events in _pieces(model.code, *_symbols([w for w, n in zip(words, c.tolist()) if n])):
                stretched, gates, row = _inputs(tables, events)
                low, share = _map_place(_mix(stretched, gates, model.weights))
                row *= MAP_LEVELS
                row += low
                for place, part in ((row, 1 - share), (row + 1, share)):
                    sums[0] += np.bincount(place, weights=part, minlength=size)
                    sums[1] += np.bincount(place, weights=part * events.bits, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])

    return rows


def _summed(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sums by place of an array column; ``size`` rows reach the driver."""
    found = rows.select(F.posexplode(column).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["at"]] = r.x
    return out


def histories(keys: np.ndarray, tokens: np.ndarray, starts: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For the tokens at places ``at``, in texts that begin at ``starts``: hashes of the word before, and of the two before."""
    out, value = [], np.zeros(len(at), np.uint64)
    for back in range(1, len(HISTORY_BITS) + 1):
        word = np.where(at - back >= starts, keys[tokens[np.maximum(at - back, 0)]].astype(np.uint64) + np.uint64(1), np.uint64(0))
        value = mixed(value + word * np.uint64(8) + np.uint64(back))
        out.append(value)
    return out


def code_events(code: Code, symbols: np.ndarray, before: list[np.ndarray]) -> Events:
    """Bits of the words' codes."""
    return _events(code, symbols, before, np.arange(len(symbols)), HISTORY_BITS, _word_offsets)


def _code_pieces(code: Code, symbols: np.ndarray, before: list[np.ndarray]) -> Iterator[Events]:
    return _pieces(code, symbols, before, np.arange(len(symbols)), HISTORY_BITS, _word_offsets)


@dataclass
class Words:
    """Predicts a word's code from the words before it. ``share``: what a gate leaves to it; ``counts``, or their tables, are put in where it is used."""

    code: Code
    weights: np.ndarray
    share: np.ndarray
    counts: np.ndarray | None = None

    def predicted(self, symbols: np.ndarray, before: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each code, and its share."""
        tables = _tables(self.counts)
        found, first = [np.zeros(0)], [np.zeros(0, np.int64)]
        for events in _code_pieces(self.code, symbols, before):
            stretched, seen = tables.predicted(events, (1, 2))
            gates, starts = _gates(*seen), events.starts
            found.append(np.add.reduceat(_costs(stretched, gates, self.weights, events.bits), starts))
            first.append(gates[starts])
        return np.concatenate(found) / np.log(10), self.share[np.concatenate(first)]


def _costs(stretched: np.ndarray, gates: np.ndarray, weights: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Log probability of each bit."""
    return _log_sigmoid(np.clip(_mix(stretched, gates, weights), -REACH * 1.5, REACH * 1.5), bits)


def _log_sigmoid(z: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Log probability of bits whose stretched prediction is ``z``, of small size."""
    y = 1 - 2 * bits
    y = np.exp(y * z)
    y += 1
    np.log(y, out=y)
    return np.negative(y, out=y)


def first_word_weights() -> np.ndarray:
    """Where learning starts: the longer context that was seen counts most."""
    near, far = (1 - 0.5 ** x for x in (np.repeat(np.arange(SEEN_LEVELS), SEEN_LEVELS), np.tile(np.arange(SEEN_LEVELS), SEEN_LEVELS)))
    return np.stack([1 - near, near * (1 - far / 2), near * far / 2], axis=1)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple[np.ndarray, list[np.ndarray]]]]:
    """For each chunk the codes of all words in training texts, and the words before them."""

    def some(keys, tokens, starts, learned) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        for at in range(0, len(learned), TOKENS_AT_ONCE):
            places = learned[at : at + TOKENS_AT_ONCE]
            yield (keys[tokens[places]] % WORD_CODES).astype(np.int64), histories(keys, tokens, starts[places], places)

    for batch in batches:
        for row in range(batch.num_rows):
            sizes = batch.column("words")[row].values.to_numpy()
            keys, tokens = np.frombuffer(batch.column("keys")[row].as_buffer(), np.uint32), from_shrunk(batch.column("tokens")[row].as_buffer(), int(sizes.sum()))
            learned = np.repeat(batch.column("train")[row].values.to_numpy(zero_copy_only=False), sizes)
            yield some(keys, tokens, np.repeat(np.cumsum(sizes) - sizes, sizes), np.flatnonzero(learned))


def _count_histories(code):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, masses = np.zeros((WORD_SLOTS, 2), np.float32), np.zeros(WORD_CODES)
        for chunk in _occurrences(batches):
            for symbols, before in chunk:
                masses += np.bincount(symbols, minlength=WORD_CODES)
                for events in _code_pieces(code.value, symbols, before):
                    add_counts(counts, events, first=1)
        # Without context a bit is as frequent as the codes that pass it.
        counts.reshape(-1)[: 2 * WORD_CODES] = np.bincount(code.value.path, weights=np.repeat(masses, code.value.sizes), minlength=2 * WORD_CODES)
        yield from _blocks(counts)

    return rows


def _learned_words(code, counts):
    """Descends on the coding cost of the codes of a chunk's words, so that the order of chunks does not matter; gives weights,
    what each gate has seen, and how often the contexts predicted a word by how much better than its code's count, by the gate of
    the word's first bit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = counts.tables(own=True)
        nodes = np.arange(2 * WORD_CODES)
        without = _log_sigmoid(tables.stretched.take(tables.places(nodes >> 1, nodes & 1)), nodes & 1)
        total, ratios = np.zeros(GATES * (len(HISTORY_BITS) + 2)), np.zeros(GATES * RATIO_LEVELS)
        for chunk in _occurrences(batches):
            weights = first_word_weights()
            squares, mass = np.full(weights.shape, 1e-6), np.zeros(GATES)
            for symbols, before in chunk:
                pieces = []
                for events in _code_pieces(code.value, symbols, before):
                    stretched, seen = tables.predicted(events, (1, 2))
                    gates, starts = _gates(*seen), events.starts
                    gain = _costs(stretched, gates, weights, events.bits)
                    gain -= without.take(events.slots[0] * 2 + events.bits)
                    gain = np.add.reduceat(gain, starts)
                    level = np.rint((np.clip(gain, -REACH, REACH) + REACH) / (2 * REACH) * (RATIO_LEVELS - 1)).astype(np.int64)
                    ratios += np.bincount(gates[starts] * RATIO_LEVELS + level, minlength=len(ratios))
                    pieces.append((stretched, gates, events.bits))
                _descend(weights, squares, mass, *_joined(pieces))
            total += np.concatenate([(weights * mass[:, None]).ravel(), mass])
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([total, ratios]).tolist()], pa.list_(pa.float64()))], ["sums"])

    return rows


def shares_of(ratios: np.ndarray) -> np.ndarray:
    """For each gate the share of the contexts that makes its words most likely, by expectation and maximisation."""
    better = np.exp(np.linspace(-REACH, REACH, RATIO_LEVELS))
    share = np.full(len(ratios), 0.5)
    for _ in range(100):
        part = share[:, None] * better / (1 - share[:, None] + share[:, None] * better)
        share = ((ratios * part).sum(axis=1) + 1) / (ratios.sum(axis=1) + 2)
    return share


def trained_words(chunks: DataFrame, masses: np.ndarray, tokens: int):
    """The model of words from those before them, and its counts as a broadcast."""
    sc = chunks.sparkSession.sparkContext
    tasks = max(1, -(-tokens // TASK_TOKENS))
    some = chunks.select("keys", "tokens", "words", "train").coalesce(tasks)
    code = Code(masses)
    shared_code = sc.broadcast(code)
    shared = Shared(sc, _gathered(some.mapInArrow(_count_histories(shared_code), BLOCK), tasks, WORD_SLOTS))
    size = GATES * (len(HISTORY_BITS) + 1)
    sums = _summed(some.mapInArrow(_learned_words(shared_code, shared), "sums array<double>"), "sums", size + GATES + GATES * RATIO_LEVELS)
    mass = sums[size : size + GATES, None]
    weights = np.where(mass > 0, sums[:size].reshape(GATES, -1) / np.maximum(mass, 1e-9), first_word_weights())
    return Words(code, weights, shares_of(sums[size + GATES :].reshape(GATES, -1))), shared


def pairs(kinds: np.ndarray, counted: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Counts by class of words that have ``sizes`` of them, one at least: a byte that says how many bytes a number has, and the numbers."""
    values = (counted << 3 | kinds).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    most = np.maximum.reduceat(values, starts) if len(sizes) else values
    widths = 1 << np.searchsorted(np.array([1 << 8, 1 << 16, 1 << 32], np.uint64), most, "right")
    ends = np.cumsum(1 + widths * sizes)
    begins = ends - (1 + widths * sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[begins] = widths
    at, width = _numbers(begins, widths, sizes)
    for byte in range(int(widths.max()) if len(widths) else 0):
        some = width > byte
        out[at[some] + byte] = (values[some] >> np.uint64(8 * byte)).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(out.tobytes())])


def _numbers(begins: np.ndarray, widths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each number begins and how many bytes it has."""
    width = np.repeat(widths, sizes)
    step = np.arange(len(width)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(begins + 1, sizes) + step * width, width


def from_pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each number in ``pairs``: its word, its class and its count."""
    data, at = text_bytes(column)
    widths = data[at[:-1]].astype(np.int64)
    sizes = (np.diff(at) - 1) // widths
    place, width = _numbers(at[:-1], widths, sizes)
    values = np.zeros(len(place), np.int64)
    for byte in range(int(widths.max()) if len(widths) else 0):
        some = np.flatnonzero(width > byte)
        values[some] |= data[place[some] + byte].astype(np.int64) << (8 * byte)
    return np.repeat(np.arange(len(sizes)), sizes), values & 7, values >> 3


def _scored(model: Model, counts):
    """word, log10 probability of its spelling after the first byte, and its counts by class in bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = replace(model, counts=counts.tables())
        for whole in batches:
            for at in range(0, whole.num_rows, WORDS_AT_ONCE):
                batch = whole.slice(at, WORDS_AT_ONCE)
                words = batch.column("word").to_pylist()
                rest = np.zeros(len(words))
                for events in _pieces(m.code, *_symbols(words)):
                    rest += np.bincount(events.owners, weights=np.add.reduceat(m.cost(events), events.starts), minlength=len(words))
                lists = batch.column("by")
                found = lists.flatten()
                data = pairs(found.field("k").to_numpy(), found.field("n").to_numpy(), lists.value_lengths().to_numpy().astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(rest.astype(np.float32)), data], ["word", "rest", "by"])

    return rows


#: A chunk is one large row, so a few make a row group.
CHUNK_FILES = {"compression": "zstd", "parquet.block.size": str(32 << 20)}
CHUNK = "chunk bigint, listed array<binary>, entries array<struct<word: binary, k: int, n: bigint>>, first array<bigint>, spelled array<bigint>, heads binary, tails binary, keys binary, classes array<bigint>, train array<boolean>, words array<bigint>, bytes array<bigint>, tokens binary"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts as they come, lower-cased; the number of each text's words in turn, and how many a text has."""
    # Of bytes: A-Z, and \x20 \x09-\x0D. White space at the ends of a text leaves empty parts.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    parts = lists.flatten()
    some = np.asarray(pc.not_equal(pc.binary_length(parts), 0))
    before = np.concatenate([[0], np.cumsum(some)])
    sizes = np.diff(before[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])])
    if not some.all():
        parts = parts.filter(pa.array(some))
    coded = parts.dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy().astype(np.uint32), sizes.astype(np.int64)


def document_classes(tokens: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The class of each text: the crc32 of its most frequent short word; 0 without short words."""
    out = np.zeros(len(sizes), np.int64)
    short = np.flatnonzero(((lengths >= SHORT[0]) & (lengths <= SHORT[1]))[tokens])
    if len(short):
        n = len(lengths)
        kinds, counts = np.unique(np.repeat(np.arange(len(sizes)), sizes)[short] * n + tokens[short], return_counts=True)
        texts = kinds // n
        begin = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
        most = np.maximum.reduceat((counts << 32) + keys[kinds % n], begin)
        out[texts[begin]] = (most & 0xFFFFFFFF) % CLASSES
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() << 32
    for n, batch in enumerate(slices(batches, "text", CHUNK_BYTES)):
        texts = batch.column("text")
        train = batch.column("train").to_numpy(zero_copy_only=False)
        lengths = pc.binary_length(texts).fill_null(0).cast(pa.int64())
        listed, tokens, sizes = words_of(texts)
        del texts
        raw, at = text_bytes(listed)
        letters = np.diff(at)
        heads, tails = raw[at[:-1]], _ending[raw[at[1:] - 1]]
        keys = np.fromiter(map(zlib.crc32, listed.to_pylist()), np.uint32, len(listed))
        learned = tokens[np.repeat(train, sizes)]
        counts = np.bincount(learned, minlength=len(listed))
        kinds = document_classes(tokens, sizes, letters, keys)
        by_class = np.bincount(learned * np.int64(CLASSES) + np.repeat(kinds[train], sizes[train]), minlength=len(listed) * CLASSES)
        pairs = np.flatnonzero(by_class)
        n_pairs = by_class[pairs]
        del by_class
        # A word that no training row has is listed once with nothing.
        absent = np.flatnonzero(counts == 0)
        at = np.concatenate([pairs // CLASSES, absent])
        k = np.concatenate([pairs % CLASSES, np.zeros(len(absent), np.int64)])
        before, last = endings(tokens, sizes, tails)
        first = np.bincount(before[np.repeat(train, sizes)].astype(np.int64) * SYMBOLS + heads[learned], minlength=ENDINGS * SYMBOLS)
        first += np.bincount(last[train].astype(np.int64) * SYMBOLS + END, minlength=ENDINGS * SYMBOLS)
        del learned, before
        spelled = np.bincount(raw, weights=np.repeat(counts, letters), minlength=SYMBOLS).astype(np.int64)
        spelled[CLOSE], spelled[END] = counts.sum(), train.sum()
        entries = pa.StructArray.from_arrays([listed.take(pa.array(at)), pa.array(k, pa.int32()), pa.array(np.concatenate([n_pairs, 0 * absent]), pa.int64())], ["word", "k", "n"])
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([task + n], pa.int64()),
                one(listed),
                one(entries),
                *(one(pa.array(x)) for x in (first, spelled)),
                *(pa.array([x.tobytes()], pa.binary()) for x in (heads, tails, keys)),
                one(pa.array(np.bincount(kinds[train], minlength=CLASSES))),
                one(pa.array(train)),
                one(pa.array(sizes)),
                one(lengths),
                pa.array([shrunk(tokens)], pa.binary()),
                one(batch.column("doc_id")),
            ],
            ["chunk", "listed", "entries", "first", "spelled", "heads", "tails", "keys", "classes", "train", "words", "bytes", "tokens", "ids"],
        )


def endings(tokens: np.ndarray, sizes: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How the token before each token ended, and how each text's last one did."""
    own = tails[tokens]
    before = np.zeros(len(tokens), np.uint8)
    before[1:] = own[:-1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    before[starts[sizes > 0]] = 0
    last = np.zeros(len(sizes), np.uint8)
    last[sizes > 0] = own[ends[sizes > 0] - 1]
    return before, last


@dataclass
class Corpus:
    """What the training rows hold: tokens, distinct ones and ends, the discount of a count, and by class
    words, distinct words and documents."""

    tokens: int
    distinct: int
    ends: int
    discount: float
    class_words: np.ndarray
    class_kinds: np.ndarray
    class_documents: np.ndarray

    def words(self, by: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 probability of words in each class, from counts by class and the log10 probability of spelling them."""
        words, kinds = self.tokens - self.ends, self.distinct - (self.ends > 0)
        wide = 10**spelled
        if words:
            wide = (np.maximum(by.sum(axis=1) - self.discount, 0) + self.discount * kinds * wide) / words
        own = self.class_words > 0
        near = (np.maximum(by - self.discount, 0) + self.discount * self.class_kinds * wide[:, None]) / np.maximum(self.class_words, 1)
        return np.log10(np.maximum(np.where(own, near, wide[:, None]), 1e-300))

    def known(self) -> np.ndarray:
        """What each class leaves at least to words that training has."""
        words, kinds = self.tokens - self.ends, self.distinct - (self.ends > 0)
        free = self.discount * kinds / words if words else 1.0
        return 1 - free * np.where(self.class_words > 0, self.discount * self.class_kinds / np.maximum(self.class_words, 1), 1)

    def shares(self) -> np.ndarray:
        """log10 of the classes' weights before a text is read."""
        return np.log10((self.class_documents + 0.5) / (self.class_documents.sum() + 0.5 * CLASSES))


LOG10 = np.log(10)


def text_scores(words: Words, corpus: Corpus, masses: np.ndarray, logs: np.ndarray, c: np.ndarray, keys: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each text's words. ``logs``: of each word in each class; ``c``: its count; ``masses``: counts by code."""
    out = np.zeros(len(sizes))
    starts, texts = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    shares, known = corpus.shares(), corpus.known()
    opening = 10**shares
    # By class: the log of its weight times what it has predicted of the text so far; of all classes: the log of the sum, and what they leave to known words.
    carried, begun, left_begun = shares, np.log10(opening.sum()), opening @ known / opening.sum()
    so_far_carried, left_carried = begun, left_begun
    for begin in range(0, len(tokens), TOKENS_AT_ONCE):
        own, text = tokens[begin : begin + TOKENS_AT_ONCE], texts[begin : begin + TOKENS_AT_ONCE]
        at = np.arange(begin, begin + len(own))
        opens = starts[text]
        # What the classes have predicted so far is their weight for the next word; a text may go on from the block before.
        by = np.ascontiguousarray(logs[own].T)
        after = np.cumsum(by, axis=1)
        before = after - by
        after -= before.take(np.maximum(opens, begin) - begin, axis=1)
        going = int(np.searchsorted(opens, begin))
        after[:, :going] += carried[:, None]
        after[:, going:] += shares[:, None]
        carried = after[:, -1].copy()
        top = after.max(axis=0)
        after -= top
        after *= LOG10
        weights = np.exp(after, out=after)
        total = weights.sum(axis=0)
        sums = top + np.log(total) / LOG10
        so_far, left = np.empty(len(own)), np.empty(len(own))
        so_far[0], left[0], so_far[1:] = so_far_carried, left_carried, sums[:-1]
        leaves = known @ weights / total
        left[1:] = leaves[:-1]
        so_far_carried, left_carried = sums[-1], leaves[-1]
        first = at == opens
        so_far[first], left[first] = begun, left_begun
        found = sums - so_far
        some = np.flatnonzero(c[own])
        if len(some):
            symbols = (keys[own[some]] % WORD_CODES).astype(np.int64)
            code, share = words.predicted(symbols, histories(keys, tokens, opens[some], at[some]))
            found[some] = np.log((1 - share) * np.exp(found[some] * LOG10) + share * left[some] * np.exp(code * LOG10) * c[own[some]] / masses[symbols]) / LOG10
        out += np.bincount(text, weights=found, minlength=len(sizes))
    return out


def _documents(first, corpus: Corpus, model_of_words: Words, counts, masses):
    def rows(chunk: pa.Table, words: pa.Table) -> pa.Table:
        row = {c: chunk.column(c)[0] for c in chunk.column_names}
        sizes = row["words"].values.to_numpy()
        tokens = from_shrunk(row["tokens"].as_buffer(), int(sizes.sum()))
        heads, tails = (np.frombuffer(row[c].as_buffer(), np.uint8) for c in ("heads", "tails"))
        keys = np.frombuffer(row["keys"].as_buffer(), np.uint32)
        heads_after, ends_after = first.value
        by, rest = np.zeros((len(heads), CLASSES), np.int64), np.zeros(len(heads))
        packed = words.column("by").combine_chunks() if words.num_rows else None
        if packed is not None:
            place = words.column("at").to_numpy()
            rest[place] = words.column("rest").to_numpy()
            owner, kinds, counted = from_pairs(packed)
            by[place[owner], kinds] = counted
        before, last = endings(tokens, sizes, tails)
        of = np.repeat(np.arange(len(sizes)), sizes)
        logs = corpus.words(by, rest + heads_after[heads])
        c = by.sum(axis=1)
        model = text_scores(replace(model_of_words, counts=counts.tables()), corpus, masses.value, logs, c, keys, tokens, sizes)
        model += np.bincount(of, weights=np.log10(1 - ends_after)[before], minlength=len(sizes)) + np.log10(ends_after[last])
        rate = corpus.tokens + corpus.distinct + 1
        base = np.log10((c + 1) / rate)
        base = np.bincount(of, weights=base[tokens], minlength=len(sizes)) + np.log10((corpus.ends + 1) / rate)
        known = np.bincount(of, weights=(c > 0)[tokens], minlength=len(sizes)).astype(np.int64) + (corpus.ends > 0)
        size = np.array(row["bytes"].as_py(), np.int64)
        return pa.table(
            {
                "doc_id": row["ids"].values,
                "held_out": pa.array(~np.array(row["train"].as_py(), bool)),
                "n_tokens": sizes + 1,
                "n_known": known,
                "train_tokens": np.full(len(sizes), corpus.tokens),
                "base_score": base,
                "score": model,
                "bits_per_byte": -model * np.log2(10) / np.maximum(size, 1),
            }
        )

    return rows


def _first_scores(model: Model, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of a word's first byte, and by ending the probability that the text ends after it."""
    events = first_events(model.code)
    costs = np.bincount(events.owner, weights=model.cost(events), minlength=SYMBOLS)
    seen = first.reshape(ENDINGS, SYMBOLS)
    heads = costs - np.log10(1 - 10 ** costs[END] - 10 ** costs[CLOSE])
    return heads, (seen[:, END] + 0.5) / (seen.sum(axis=1) + 1)


def trained(vocabulary: DataFrame, first: np.ndarray, code: Code, words: int):
    """The spelling model from the vocabulary (word, c) and the counts of first symbols, and its counts as a broadcast."""
    sc = vocabulary.sparkSession.sparkContext
    tasks = max(1, -(-words // TASK_WORDS))
    some = vocabulary.coalesce(tasks)
    counts = _gathered(some.mapInArrow(_count_blocks(sc.broadcast(code)), BLOCK), tasks, SLOTS)
    add_counts(counts, first_events(code), first.reshape(ENDINGS, SYMBOLS).sum(axis=0).astype(np.float32))
    shared = Shared(sc, counts)
    model = Model(code, None, first_weights())
    sums = _summed(some.mapInArrow(_learned(model, shared), "sums array<double>"), "sums", GATES * (len(SLOT_BITS) + 1))
    mass = sums[-GATES:, None]
    found = sums[:-GATES].reshape(GATES, -1) / np.maximum(mass, 1e-9)
    model = Model(code, None, np.where(mass > 0, found, model.weights))
    sums = _summed(some.mapInArrow(_mapped(model, shared), "sums array<double>"), "sums", 2 * SEEN_LEVELS * MAP_LEVELS).reshape(2, SEEN_LEVELS, MAP_LEVELS)
    centre = 1 / (1 + np.exp(-np.linspace(-REACH, REACH, MAP_LEVELS)))
    share = (sums[1] + 50 * centre) / (sums[0] + 50)
    model.map = np.log(share / (1 - share))
    return model, shared


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row."""
    sc = docs.sparkSession.sparkContext
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", (~held_out()).alias("train"))
    chunks = written(rows.mapInArrow(_chunks, f"{CHUNK}, ids array<{id_type}>"), "lm-chunks", **CHUNK_FILES)
    entries = chunks.select(F.inline("entries")).repartition("word")
    by_class = entries.groupBy("word", "k").agg(F.sum("n").alias("n"))
    vocabulary = written(by_class.groupBy("word").agg(F.sum("n").alias("c"), F.collect_list(F.struct("k", "n")).alias("by")), "lm-vocabulary")
    del entries, by_class
    released(docs.sparkSession)
    kinds = [F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2)]
    sums = vocabulary.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), *kinds).first()
    of_class = {r.k: r for r in vocabulary.select(F.inline("by")).where("n > 0").groupBy("k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}  # CLASSES rows
    first = _summed(chunks, "first", ENDINGS * SYMBOLS)
    ends = int(first.reshape(ENDINGS, SYMBOLS)[:, END].sum())
    corpus = Corpus(
        tokens=sums.n + ends,
        distinct=sums.v + (ends > 0),
        ends=ends,
        discount=sums.n1 / (sums.n1 + 2 * sums.n2) if sums.n1 else 0.5,
        class_words=np.array([of_class[k].n if k in of_class else 0 for k in range(CLASSES)]),
        class_kinds=np.array([of_class[k].v if k in of_class else 0 for k in range(CLASSES)]),
        class_documents=_summed(chunks, "classes", CLASSES),
    )
    model, shared = trained(vocabulary.select("word", "c"), first, Code(_summed(chunks, "spelled", SYMBOLS)), sums.words)
    masses = np.zeros(WORD_CODES)
    for r in vocabulary.groupBy(F.pmod(F.crc32("word"), F.lit(WORD_CODES)).alias("code")).agg(F.sum("c").alias("c")).collect():  # WORD_CODES rows
        masses[r.code] = r.c
    words, seen = trained_words(chunks, masses, corpus.tokens)
    released(docs.sparkSession)
    after = sc.broadcast(_first_scores(replace(model, counts=shared.tables()), first))
    scored = vocabulary.select("word", "by").mapInArrow(_scored(model, shared), "word binary, rest float, by binary")
    listed = chunks.select("chunk", F.posexplode("listed").alias("at", "word"))
    back = listed.join(scored, "word").select("chunk", "at", "rest", "by")
    again = chunks.select(F.col("chunk").alias("key"), "heads", "tails", "keys", "train", "words", "bytes", "tokens", "ids")
    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"
    return again.groupBy("key").cogroup(back.groupBy("chunk")).applyInArrow(_documents(after, corpus, words, seen, sc.broadcast(masses)), schema)
