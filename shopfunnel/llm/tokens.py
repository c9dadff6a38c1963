"""Token ids of whole texts by a public byte-level BPE vocabulary.

The library splits a text where white space begins before anything else it does, so a text's ids
are those of its pieces (white space and what follows up to the next white space), one after the
other. Texts are cut in numpy on their UTF-8 bytes, Arrow finds the distinct pieces of a chunk, and
each worker remembers the ids of the pieces it has met, so the library sees a piece once.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shopfunnel.llm.common import keeps
from shopfunnel.llm.words import chunks, hashes_of, utf8

#: Pieces a worker remembers; beyond that it forgets all and starts again.
MEMO_PIECES = 2_000_000
#: Bytes of texts looked up together, which takes some sixty times as much, and of new pieces the library is given as
#: one text.
_CHUNK_BYTES = 1 << 20
_JOINED_BYTES = 1 << 16
#: Bytes of texts the library is given at once: what it returns takes some hundred times as much until it is read.
_CALL_BYTES = 1 << 18
#: White space of one byte. Fixed values.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that end a white space character, and other characters too. No cut is made behind one:
#: white space that goes on must stay whole, and a piece may be longer than it has to. Fixed values.
_MAY_END_SPACE = _IS_SPACE.copy()
_MAY_END_SPACE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


def vocabulary_path() -> str:
    """The default vocabulary, where the package that brings it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at each text, and at white space behind what is none."""
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = _IS_SPACE[data[1:]] & ~_MAY_END_SPACE[data[:-1]]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


class Encoder:
    """Encodes texts to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Bytes of text each id stands for; the vocabulary writes a byte as one character.
        names = (self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size()))
        self.sizes = np.array([len(name or "") for name in names])
        self.memo = _Memo()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return list(self._each(pa.array(texts, pa.large_string()), b""))

    def documents(self, texts: pa.Array, end: int) -> Iterator[bytes]:
        """Ids of each text with ``end`` after them; a null text is empty."""
        return self._each(texts, array("I", [end]).tobytes())

    def _each(self, texts: pa.Array, last: bytes) -> Iterator[bytes]:
        data, offsets = utf8(texts)
        for first, after in chunks(offsets, _CHUNK_BYTES):
            at = offsets[first : after + 1]
            ids, bounds = self.flat(data[at[0] : at[-1]], at - at[0])
            flat, bounds = ids.tobytes(), (4 * bounds).tolist()
            for low, high in zip(bounds[:-1], bounds[1:]):
                yield flat[low:high] + last

    def flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts; text i has those from ``bounds[i]`` to ``bounds[i + 1]``."""
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        _, places, distinct = pieces.dictionary.buffers()
        places = np.frombuffer(places, np.int64)[: len(pieces.dictionary) + 1]
        ids, low, sizes = self._look_up(np.frombuffer(distinct, np.uint8)[: places[-1]], places)
        number = pieces.indices.to_numpy()
        sizes = sizes[number]
        after = np.cumsum(sizes)
        found = ids[_ragged(low[number], sizes)]
        return found, np.concatenate([[0], after])[np.searchsorted(starts, offsets)]

    def _look_up(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and for each of some distinct pieces where its ids lie there and how many."""
        if len(self.memo) + len(places) > MEMO_PIECES:
            self.memo = _Memo()
        hashes = hashes_of(data, places)
        number = self.memo.find(hashes, data, places)
        new = np.flatnonzero(number < 0)
        if len(new):
            own, sizes = self._encode(data, places, new)
            number[new] = self.memo.add(hashes[new], data, places, new, own, sizes)
        low = self.memo.low[number]
        return self.memo.ids, low, self.memo.low[number + 1] - low

    def _encode(self, data: np.ndarray, places: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the ``wanted`` pieces end to end, and how many each has.

        Pieces that the library would cut from each other are given to it joined.
        """
        low, high = places[wanted], places[wanted + 1]
        joinable = _IS_SPACE[data[low]] & ~_MAY_END_SPACE[data[high - 1]]
        runs = np.where(joinable, np.cumsum(high - low) // _JOINED_BYTES, -1 - np.arange(len(wanted)))
        cuts = np.flatnonzero(np.diff(runs, prepend=runs[0] - 1))
        texts = [data[_ragged(low[a:b], (high - low)[a:b])].tobytes() for a, b in zip(cuts, [*cuts[1:], len(runs)])]
        ids, sizes = [], []
        for text, found, a, b in zip(texts, self._call(texts), cuts, [*cuts[1:], len(runs)]):
            own, counts = self._shared_out(text, np.array(found, np.uint32), (high - low)[a:b])
            ids.append(own)
            sizes.append(counts)
        return np.concatenate(ids), np.concatenate(sizes)

    def _shared_out(self, text: bytes, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of joined pieces of the given sizes in bytes, and how many each has."""
        if len(sizes) == 1:
            return ids, np.array([len(ids)])
        reached, ends = np.cumsum(self.sizes[ids]), np.cumsum(sizes)
        after = np.searchsorted(reached, ends) + 1
        if after[-1] == len(ids) and (reached[after - 1] == ends).all():
            return ids, np.diff(after, prepend=0)
        each = self._call([text[a:b] for a, b in zip(ends - sizes, ends)])  # an id reached across two
        return np.array(sum(each, []), np.uint32), np.array([len(x) for x in each])

    def _call(self, texts: list[bytes]) -> list[list[int]]:
        found, some, size = [], [], 0
        for text in texts:
            some.append(text.decode())
            size += len(text)
            if size >= _CALL_BYTES:
                found += self._ids(some)
                some, size = [], 0
        return found + self._ids(some)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class _Memo:
    """The ids of pieces met before, in flat arrays; pieces are found by hash and compared whole."""

    def __init__(self) -> None:
        self.keys, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int32)  # by key
        self.data, self.places = _Flat(np.uint8), _Flat(np.int64, [0])
        self._ids, self._low = _Flat(np.uint32), _Flat(np.int64, [0])

    def __len__(self) -> int:
        return len(self.places) - 1

    @property
    def ids(self) -> np.ndarray:
        return self._ids.values

    @property
    def low(self) -> np.ndarray:
        return self._low.values

    def find(self, hashes: np.ndarray, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, -1 for those not known."""
        number = np.full(len(hashes), -1, np.int64)
        if not len(self.keys):
            return number
        order, at = np.argsort(hashes), np.empty(len(hashes), np.int64)
        at[order] = np.searchsorted(self.keys, hashes[order])  # in order: near places are at hand
        at = np.minimum(at, len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == hashes)
        known = self.numbers[at[hit]].astype(np.int64)
        low, sizes = places[hit], places[hit + 1] - places[hit]
        own = self.places.values[known]
        alike = sizes == self.places.values[known + 1] - own
        hit, known, low, sizes, own = (x[alike] for x in (hit, known, low, sizes, own))
        wrong = np.flatnonzero(data[_ragged(low, sizes)] != self.data.values[_ragged(own, sizes)])
        known[np.searchsorted(np.cumsum(sizes), wrong, side="right")] = -1
        number[hit] = known
        return number

    def add(
        self, hashes: np.ndarray, data: np.ndarray, places: np.ndarray, new: np.ndarray, ids: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        """Remember the pieces ``new`` of ``data``; returns their numbers.

        Of pieces with one hash only the first can be found again.
        """
        numbers = len(self) + np.arange(len(new))
        low, lengths = places[new], places[new + 1] - places[new]
        self.places.extend(len(self.data) + np.cumsum(lengths))
        self.data.extend(data[_ragged(low, lengths)])
        self._low.extend(len(self._ids) + np.cumsum(sizes))
        self._ids.extend(ids)
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.keys, hashes[order])
        self.keys = np.insert(self.keys, at, hashes[order])
        self.numbers = np.insert(self.numbers, at, numbers[order])
        return numbers


class _Flat:
    """An array that grows at its end."""

    def __init__(self, kind: type, first: list[int] | None = None) -> None:
        self.room, self.n = np.zeros(1 << 16, kind), 0
        self.extend(np.array(first or [], kind))

    def __len__(self) -> int:
        return self.n

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.n]

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            longer = np.zeros(max(self.n + len(more), 3 * len(self.room) // 2), self.room.dtype)
            longer[: self.n] = self.values
            self.room = longer
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)


def _ragged(low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of stretches that begin at ``low``, one after the other."""
    after = np.cumsum(sizes)
    return np.repeat(low - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0)


_encoders: dict[str, Encoder] = {}
keeps("tokens", _encoders.clear)


def encoder(path: str) -> Encoder:
    """The encoder of this worker for the vocabulary at ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
