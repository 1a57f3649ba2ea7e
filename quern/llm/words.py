"""Word and shingle hashes of many texts at once, over their UTF-8 bytes.

A word is a run of bytes outside space and 0x09-0x0D, with A-Z lower-cased. Every space
is one ASCII byte, so working on bytes equals working on code points. Hashes have 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BITS = np.random.default_rng(20_240_601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_HASH = _BITS[_LOWER]
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_ORDER = [pow(0xD6E8FEB86659FD93, i + 1, 2**64) for i in range(64)]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, length: int) -> np.ndarray:
    found = _powers.get(base)
    if found is None or len(found) < length:
        found = np.empty(max(length, 1 << 16), np.uint64)
        found[0] = 1
        found[1:] = base
        np.multiply.accumulate(found, out=found)
        _powers[base] = found
    return found[:length]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray = _BITS) -> np.ndarray:
    """A hash of each span's bytes; ``code`` gives the value of a byte."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(code[data] * _power(_STEP, len(data)), out=sums[1:])
    return mixed((sums[end] - sums[start]) * _power(_BACK, len(data) + 1)[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Word hashes; text i owns ``hashes[first[i]:first[i + 1]]``. Places are byte offsets."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def hashed_words(column: pa.Array) -> Words:
    data, offsets = raw(column)
    size = len(data)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none, data, offsets)
    inside = ~_SPACE[data]
    edge = np.ones(size + 1, bool)
    edge[1:-1] = ~inside[:-1]
    edge[offsets[(offsets > 0) & (offsets < size)]] = True
    start = np.flatnonzero(inside & edge[:-1])
    edge[1:-1] = ~inside[1:]
    edge[offsets[(offsets > 0) & (offsets < size)]] = True
    end = np.flatnonzero(inside & edge[1:]) + 1
    hashes = span_hashes(data, start, end, _BYTE_HASH)
    return Words(hashes, np.searchsorted(start, offsets), start, end, data, offsets)


def hashed_shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words, repeats included, and where each text's begin.

    A text of fewer words has its whole sequence as one; one without words has none.
    """
    count = np.diff(words.first)
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(first[-1], np.uint64)
    whole = len(words.hashes) - size + 1
    if whole > 0:
        sums = np.zeros(whole, np.uint64)
        for j in range(size):
            sums += words.hashes[j : j + whole] * np.uint64(_ORDER[j])
        text = np.repeat(np.arange(len(count)), made)
        at = words.first[text] + np.arange(len(out)) - first[text]
        full = count[text] >= size
        out[full] = sums[at[full]]
    for i in np.flatnonzero((count > 0) & (count < size)):
        a, b = words.first[i], words.first[i + 1]
        total = int(b - a) << 56
        for j, h in enumerate(words.hashes[a:b]):
            total += int(h) * _ORDER[j + 8]
        out[first[i]] = np.uint64(total & (2**64 - 1))
    return mixed(out), first


class SpanTable:
    """What a worker has learned of spans it met: the ids of each, by the span's hash.

    Spans are looked up, and their ids gathered, as arrays; only new ones are passed on to
    ``learn``, which returns their ids one after the other and how many each has. Beyond
    ``kept`` spans the table starts anew, so its memory is bounded.
    """

    def __init__(self, learn, dtype, kept: int = 1_500_000):
        self.learn, self.dtype, self.kept = learn, np.dtype(dtype), kept
        self._empty()

    def _empty(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.pool, self.used = np.zeros(0, np.int64), np.zeros(1 << 20, self.dtype), 0

    def _add(self, keys: np.ndarray, spellings: list[bytes]) -> None:
        ids, count = self.learn(spellings)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(count) - count
        self.used += len(ids)
        order = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, order, keys)
        self.at, self.count = np.insert(self.at, order, at), np.insert(self.count, order, count)

    def gather(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray):
        """The ids of all spans in turn, and the number of ids of each span."""
        if len(self.keys) > self.kept:
            self._empty()
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inner = place < len(self.keys)
        known[inner] = self.keys[place[inner]] == keys[inner]
        if not known.all():
            new = first[~known]
            whole = data.tobytes()
            self._add(keys[~known], [whole[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            place = np.searchsorted(self.keys, keys)
        count = self.count[place][back]
        total = np.cumsum(count)
        ids = np.repeat(self.at[place][back] - (total - count), count)
        ids += np.arange(len(ids))
        return self.pool[ids], count
