"""Token ids of whole texts with the ``tokenizers`` library, one distinct unit at a time.

Encoding is cut where the tokenizer cuts anyway, so ids equal those of the whole text: at added tokens, which the library
finds first; where white space begins for a tokenizer that drops white space (``leading=False``), and before a space that a non-space
follows and around a single line feed for a byte-level one whose words take one leading space (``leading=True``); and between a
letter or digit and punctuation. Arrow finds the distinct units of a batch of texts, and numpy puts the ids of their occurrences
together. Units met before come from a cache of bounded size that a worker keeps from task to task while it has such tasks; new
ones are encoded many at a time, as one text. A unit of letters alone is one piece, so it goes to the library's model without
normalizer and pattern; of others, the bytes of the tokens tell where each unit ends for a byte-level tokenizer, otherwise a special
token stands between them.
"""

from __future__ import annotations

import os
import re
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import compress, pairwise, repeat

import numpy as np
import pyarrow as pa

from resalelake.llm.common import byte_class, text_bytes

#: Bytes, about, of cached units and ids after which a cache starts anew.
CACHE_BYTES = 128 << 20
#: Seconds that a cache is kept for the next task.
IDLE = 1.0
#: New units that are encoded as one text.
TOGETHER = 512
#: Bytes, about, of an entry besides what it holds.
_ENTRY = 200
#: White space of one byte that starts a new unit where the tokenizer drops it.
_DROPPED = byte_class((0x09, 0x0D), (0x20, 0x20))
#: White space of one byte, and the first and second bytes of longer white space (of other characters too: no cut there).
_SPACE = byte_class((0x09, 0x0D), (0x1C, 0x20))
_SPACE_PAIRS = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))
#: ASCII punctuation that never joins a letter or digit before it, as an apostrophe can.
_ENDING = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;<=?@[\\]^_`{|}~"))
#: What a unit begins with: a space 2, punctuation 1, anything else 0.
_KIND = _ENDING.astype(np.int8) + 2 * byte_class((0x20, 0x20))
#: Dropped white space as spaces, other bytes as they are.
_ONE_SPACE = np.where(_DROPPED, 0x20, np.arange(256)).astype(np.uint8)
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_ALNUM = _LETTER | byte_class((0x30, 0x39))
#: Second bytes of the letters from U+00C0 to U+00FF; their first byte is 0xC3, which no other character holds elsewhere.
_LATIN = byte_class((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))


def _alphabet() -> np.ndarray:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = byte_class((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
    out = np.arange(256)
    out[~plain] = 256 + np.arange((~plain).sum())
    return out.astype("<u2")


def _joined(units: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units with a line feed after each, as bytes, and where each starts and ends."""
    sizes = np.fromiter(map(len, units), np.int64, len(units)) + 1
    ends = np.cumsum(sizes)
    return np.frombuffer(b"\n".join([*units, b""]), np.uint8), ends - sizes, ends - 1


def _of_letters(units: Sequence[bytes]) -> np.ndarray:
    """Whether each unit is one or more letters up to U+00FF, after at most one space."""
    raw, starts, ends = _joined(units)
    good = _LETTER[raw]
    first = np.flatnonzero(raw == 0xC3)
    first = first[_LATIN[raw[first + 1]]]
    good[first] = good[first + 1] = True
    letters = np.concatenate([[0], np.cumsum(good)])
    lead = raw[starts] == 0x20
    wanted = ends - starts - lead
    return (letters[ends] - letters[starts] == wanted) & (wanted > 0)


def _groups(units: list[bytes]) -> list[list[bytes]]:
    return [units[at : at + TOGETHER] for at in range(0, len(units), TOGETHER)]


class Encoder:
    """``encode`` gives, for each text as UTF-8 bytes, its ids as little-endian unsigned 32-bit integers; the string of a
    special token is its one id, as the library does by itself."""

    def __init__(self, path: str, leading: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.leading = leading
        self.vocabulary = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder()
        special = {t.content: i for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word)}
        text = max(special, key=special.get)
        self.between, self.mark = text.encode(), special[text]
        # Byte-level tokens have a character for each byte; added ones are plain text.
        own = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(1 + max(self.tokenizer.get_vocab().values()), np.int64)
        for token, i in own.items():
            self.bytes_of[i] = len(token)
        for i, token in added.items():
            self.bytes_of[i] = len(token.content.encode())
        self.spaced = any(" " in t.content for t in added.values())
        self.special = {t.encode(): i.to_bytes(4, "little") for t, i in special.items()}
        self.specials = re.compile(b"(" + b"|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + b")")
        # Pieces as the model gets them, with a space between.
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = WhitespaceSplit()
        self.characters = _alphabet()
        if leading:
            self.characters[0x0A] = 0x20
        else:
            small = np.arange(256) + 32 * byte_class((0x41, 0x5A), (0x80, 0x96), (0x98, 0x9E))  # of letters up to U+00FF
            self.characters = self.characters[small]
            self.characters[[0x0A, 0x20]] = 0x20
        close = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.zeros(len(self.bytes_of), bool)
        self.closes[[i for token, i in own.items() if close and token.endswith(close)]] = True
        self.forget()

    def forget(self) -> None:
        """Units by what they begin with: a space, punctuation or neither; and where the ids of each are."""
        self.inner: dict[bytes, int] = {}
        self.endings: dict[bytes, int] = {}
        self.first: dict[bytes, int] = {}
        self.ids, self.stops, self.units = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64), 0
        self.kept = 0

    def _ids(self, text: bytes) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def _together(self, units: list[bytes], lead: bytes) -> list[bytes]:
        """The library cuts a text at special tokens first, so what stands between two of them is encoded by itself."""
        ids = self._ids(lead + (self.between + lead).join(units))
        marks = (np.flatnonzero(ids == self.mark) * 4).tolist()
        data = ids.tobytes()
        return [data[start:end] for start, end in zip([0, *[m + 4 for m in marks]], [*marks, len(data)])]

    def _stops(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
        """Tokens up to the end of each unit, from the bytes of both. None unless the tokens end where the units do."""
        at, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(sizes)
        last = np.searchsorted(at, ends)
        return last + 1 if len(at) and at[-1] == ends[-1] and (at[last] == ends).all() else None

    def _side_by_side(self, units: list[bytes], lead: bytes) -> list[bytes] | None:
        """Units that the tokenizer cuts apart by itself, as one text. None unless the tokens end where the units do."""
        ids = self._ids(lead + lead.join(units))
        stops = self._stops(ids, np.fromiter(map(len, units), np.int64, len(units)) + len(lead))
        if stops is None:
            return None
        data, stops = ids.tobytes(), (4 * stops).tolist()
        return [data[start:end] for start, end in zip([0, *stops], stops)]

    def _of_pieces(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of units of letters, each one piece to the tokenizer, and where those of each end. None unless the tokens show the ends."""
        raw, starts, ends = _joined(units)
        (found,) = self.pieces.encode_batch_fast([self.characters[raw].tobytes().decode("utf-16-le")], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        stops = self._stops(ids, ends - starts) if self.leading else np.flatnonzero(self.closes[ids]) + 1
        return (ids, stops) if stops is not None and len(stops) == len(units) and stops[-1] == len(ids) else None

    def _grouped(self, units: list[bytes]) -> list[bytes]:
        """Ids of any units."""
        lead = b" " if self.leading and not self.spaced and all(u.startswith(b" ") for u in units) else b""
        found = self._side_by_side([u[1:] for u in units], lead) if lead else None
        found = found or self._together(units, b"")
        return found if len(found) == len(units) else [self._ids(u).tobytes() for u in units]

    def _keep(self, ids: np.ndarray, stops: np.ndarray) -> None:
        used, n = int(self.stops[self.units]), len(stops)
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.zeros(used + len(ids), "<u4")])
        if self.units + n >= len(self.stops):
            self.stops = np.concatenate([self.stops[: self.units + 1], np.zeros(self.units + n + 1, np.int64)])
        self.ids[used : used + len(ids)] = ids
        self.stops[self.units + 1 : self.units + 1 + n] = used + stops
        self.units += n

    def _learn(self, units: list[bytes]) -> dict[bytes, int]:
        """Encode new units; the number of each."""
        letters = _of_letters(units)
        alone = list(compress(units, letters))
        others = sorted(compress(units, ~letters), key=lambda u: u[:1] == b" ")  # those with a space before stand side by side
        split = sum(u[:1] != b" " for u in others)
        before = self.units
        order: list[bytes] = []
        for group in _groups(alone):
            found = self._of_pieces(group)
            if found is None:
                others = [*others, *group]
                continue
            self._keep(*found)
            order += group
        for group in (*_groups(others[:split]), *_groups(others[split:])):
            found = self._grouped(group)
            self._keep(np.frombuffer(b"".join(found), "<u4"), np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4)
            order += group
        self.kept += _ENTRY * len(units) + sum(map(len, units)) + 4 * int(self.stops[self.units] - self.stops[before])
        return dict(zip(order, range(before, self.units)))

    def _numbers(self, cache: dict[bytes, int], units: np.ndarray) -> np.ndarray:
        """The numbers under which the ids of distinct units are kept."""
        found = np.fromiter(map(cache.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = units[missing].tolist()
            cache.update(learned := self._learn(new))
            found[missing] = np.fromiter(map(learned.__getitem__, new), np.int64, len(new))
        return found

    def _cuts(self, raw: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where units begin within texts; ``first`` tells where a text begins, and the end of all."""
        letter = _ALNUM[raw]
        second = np.flatnonzero(raw == 0xC3) + 1
        letter[second] = _LATIN[raw[second]]
        cut = np.zeros(len(raw), bool)
        cut[1:] = _ENDING[raw[1:]] & letter[:-1]
        if not self.leading:
            space = _DROPPED[raw]
            cut[1:] |= space[1:] & ~space[:-1]
            return cut
        at = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
        padded = np.concatenate([raw, np.zeros(2, np.uint8)])
        after, next_ = padded[at + 1], padded[at + 2]
        solid = ~(_SPACE[after] | first[at + 1])
        for one, two in _SPACE_PAIRS:
            solid &= (after != one) | (next_ != two)
        at = at[solid]
        feed = raw[at] == 0x0A
        cut[at[~feed]] = True
        feeds = at[feed & (at > 0)]
        before = raw[feeds - 1]
        feeds = feeds[letter[feeds - 1] | ((before < 0x80) & ~_SPACE[before])]
        cut[feeds] = cut[feeds + 1] = True
        return cut

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts without special tokens."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        if not len(raw):
            return [b""] * len(texts)
        edges = np.cumsum(np.fromiter(map(len, [b"", *texts]), np.int64, len(texts) + 1))
        first = np.zeros(len(raw) + 1, bool)
        first[edges] = True
        starts = np.flatnonzero(first[:-1] | self._cuts(raw, first))
        data = raw if self.leading else _ONE_SPACE[raw]
        buffers = [None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        heads, offsets = text_bytes(coded.dictionary)
        units, kinds = coded.dictionary.to_numpy(zero_copy_only=False), _KIND[heads[offsets[:-1]]]
        numbers = np.zeros(len(units), np.int64)
        for kind, cache in enumerate((self.first, self.endings, self.inner)):
            at = np.flatnonzero(kinds == kind)
            numbers[at] = self._numbers(cache, units[at])
        begins, sizes = self.stops[numbers], self.stops[numbers + 1] - self.stops[numbers]
        each = coded.indices.to_numpy()
        lengths = sizes[each]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(begins[each] - ends[:-1], lengths)
        places += np.arange(len(places))
        out = self.ids[places].tobytes()
        bounds = (4 * ends[np.searchsorted(starts, edges)]).tolist()
        return [out[start:end] for start, end in pairwise(bounds)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.kept > CACHE_BYTES:
            self.forget()
        if not any(s in t for t in texts for s in self.special):
            return self._plain(texts)
        parts = [self.specials.split(t) for t in texts]  # every other one is a special token
        found = iter(self._plain([p for ps in parts for p in ps[::2]]))
        return [b"".join([self.special[p] if n % 2 else next(found) for n, p in enumerate(ps)]) for ps in parts]


_encoders: dict[tuple[str, bool], Encoder] = {}
_lock = threading.Lock()
_users: dict[tuple[str, bool], int] = {}
_timers: dict[tuple[str, bool], threading.Timer] = {}


def _release(key: tuple[str, bool]) -> None:
    with _lock:
        if not _users.get(key):
            _encoders[key].forget()


@contextmanager
def encoding(path: str, leading: bool) -> Iterator[Encoder]:
    """An encoder for the length of a task. The tokenizer stays in the worker process; what it has met is kept for a task that
    follows at once and let go after ``IDLE`` seconds without one, so it does not stand beside the work of another stage."""
    key = path, leading
    with _lock:
        if key in _timers:
            _timers.pop(key).cancel()
        if key not in _encoders:
            _encoders[key] = Encoder(path, leading)
        _users[key] = _users.get(key, 0) + 1
    try:
        yield _encoders[key]
    finally:
        with _lock:
            _users[key] -= 1
            if not _users[key]:
                _timers[key] = threading.Timer(IDLE, _release, [key])
                _timers[key].daemon = True
                _timers[key].start()
