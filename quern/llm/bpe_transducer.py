"""Byte-level BPE as a lazily determinised transducer, and its streaming inverse.

A sequence of tokens is what the merges give exactly when every two neighbours stay two under
the merges, so each prefix of a text has one last token. A state holds the last token that is
settled and the bytes read since. Reading a byte finds the last token of the longer prefix;
places where no token can begin any more are dropped, and what all others have in common is
emitted. No token is longer than the longest of the vocabulary, which bounds the lookahead.
States are made when first reached; a bounded table keeps the first ones.

Decoding concatenates bytes; a state machine over them tells where characters end, so text can
be emitted while ids arrive, with U+FFFD for what is not UTF-8.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from bisect import insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import prepare, text_slices
from quern.llm.words import SpanTable, raw, span_hashes

#: States a transducer keeps; those beyond are made when needed and not kept.
MOST_STATES = 60_000
#: Matches of the pattern whose ids a worker keeps.
MOST_PIECES = 600_000


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 60) -> list[int]:
    """The merges as defined: always the pair of least rank, leftmost first; ranks under ``below`` only."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        #: Every prefix of a token: its own id or None, and whether a longer token begins so.
        self.prefixes: dict[bytes, tuple[int | None, bool]] = {t: (i, False) for t, i in ranks.items()}
        for t in ranks:
            for k in range(1, len(t)):
                self.prefixes[t[:k]] = (ranks.get(t[:k]), True)
        self.apart: dict[tuple[int, int], bool] = {}
        self.halves = {i: self._halves(t) for t, i in ranks.items()}
        self.joined = {halves: i for i, halves in self.halves.items() if len(self.token[i]) > 1}
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.steps: list[dict[int, tuple[int, list[int]]]] = []
        self.rest: list[list[int]] = []
        #: Of each state: the bytes read since the settled token, and for each place in
        #: them that still counts the token that ends there and where that one begins.
        self.states: list[tuple[bytes, dict[int, tuple[int, int]]]] = []
        self._state(-1, b"", {0: (-1, -1)}, [])

    def _halves(self, token: bytes) -> tuple[int, int]:
        """The two tokens whose merge made this one; a single byte is its own halves."""
        own = self.ranks[token]
        if len(token) == 1:
            return own, own
        parts = merge_by_rank(token, self.ranks, own)
        if len(parts) != 2:
            raise ValueError("The vocabulary holds a token that no merge makes.")
        return parts[0], parts[1]

    def _state(self, settled: int, pending: bytes, ends: dict, rest: list[int]) -> int:
        number = self.numbers[settled, pending] = len(self.states)
        self.states.append((pending, ends))
        self.steps.append({})
        self.rest.append(rest)
        return number

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, stay two under the merges."""
        if left < 0:
            return True
        found = self.apart.get((left, right))
        if found is None:
            if len(self.apart) > 1_000_000:
                self.apart.clear()
            found = self.apart[left, right] = self._no_earlier_merge(left, right)
        return found

    def _no_earlier_merge(self, a: int, b: int) -> bool:
        """Undo the merges of both tokens, latest first: none across the border may precede them."""
        halves, joined, limit = self.halves, self.joined.get, 1 << 60
        while True:
            if joined((a, b), limit) < limit:
                return False
            first_a = a > b
            for side_a in (first_a, not first_a):
                if side_a:
                    limit, part = a, halves[a][1]
                    if part != a:
                        a = part
                        break
                else:
                    limit, part = b + 1, halves[b][0]
                    if part != b:
                        b = part
                        break
            else:
                return True

    def _step(self, state: int, byte: int) -> tuple[int, list[int]]:
        pending, before = self.states[state]
        pending += bytes([byte])
        size = len(pending)
        prefixes, apart = self.prefixes.get, self.apart.get
        found, live = None, [size]
        for place, (left, _) in before.items():
            entry = prefixes(pending[place:])
            if entry is None:
                continue
            token, opens = entry
            if opens:
                live.append(place)
            if found is None and token is not None:
                fits = apart((left, token))
                if self._stay_apart(left, token) if fits is None else fits:
                    found = (token, place)
        if found is None:
            raise ValueError("The vocabulary lacks single bytes.")
        # Walk back from all places where a token may still begin to where they meet.
        ends = {**before, size: found}
        base, kept = _meeting(live, ends)
        emitted = _walk(ends, base)
        settled = ends[base][0]
        number = self.numbers.get((settled, pending[base:]))
        if number is None:
            after = {0: (settled, -1)}
            for place in reversed(kept):
                token, begins = ends[place]
                after[place - base] = (token, begins - base)
            rest, place = [], size
            while place > base:
                token, place = ends[place]
                rest.append(token)
            number = self._state(settled, pending[base:], after, rest[::-1])
        made = self.steps[state][byte] = (number, emitted)
        return made

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the splitting pattern."""
        state, out, steps = 0, [], self.steps
        for at, byte in enumerate(piece):
            step = steps[state].get(byte)
            if step is None:
                if len(self.states) >= MOST_STATES:
                    return out + self._unkept(state, piece[at:])
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        return out + self.rest[state]

    def _unkept(self, state: int, more: bytes) -> list[int]:
        """Read on from a state without keeping the states beyond it.

        What all live places have in common is emitted whenever twice the longest token has been
        read since, so what is held does not grow with the piece.
        """
        pending, before = self.states[state]
        text, ends, live = pending + more, dict(before), list(before)
        prefixes, apart = self.prefixes.get, self.apart.get
        out: list[int] = []
        start, limit = 0, len(pending) + 2 * self.longest
        for size in range(len(pending) + 1, len(text) + 1):
            found, still = None, []
            for place in live:
                entry = prefixes(text[place:size])
                if entry is None:
                    continue
                token, opens = entry
                if opens:
                    still.append(place)
                if found is None and token is not None:
                    left = ends[place][0]
                    fits = apart((left, token))
                    if self._stay_apart(left, token) if fits is None else fits:
                        found = (token, place)
            if found is None:
                raise ValueError("The vocabulary lacks single bytes.")
            ends[size] = found
            still.append(size)
            live = still
            if size >= limit:
                base, between = _meeting(live, ends)
                out += _walk(ends, base, start)
                ends = {place: ends[place] for place in {base, *between, *live}}
                start, limit = base, size + 2 * self.longest
        return out + _walk(ends, len(text), start)


def _meeting(live: list[int], ends: dict[int, tuple[int, int]]) -> tuple[int, list[int]]:
    """Where the tokens before all live places meet, and the places walked over on the way."""
    left, between = sorted(live), []
    while len(left) > 1:
        place = left.pop()
        begins = ends[place][1]
        between.append(place)
        if begins not in left:
            insort(left, begins)
    return left[0], between


def _walk(ends: dict[int, tuple[int, int]], place: int, start: int = 0) -> list[int]:
    """The tokens that end at a place, back to the settled one that ends at ``start``."""
    out = []
    while place > start:
        token, place = ends[place]
        out.append(token)
    return out[::-1]


#: All paths of the machine through whole characters, back to its first state.
_WHOLE = re.compile(
    rb"(?:[\x00-\x7f]+|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})++"
)


class Utf8Machine:
    """Incremental UTF-8: bytes in, characters out as soon as they are whole."""

    def __init__(self) -> None:
        self.need, self.held = 0, b""
        self.low, self.high = 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out, at = [], 0
        while at < len(data):
            byte = data[at]
            if self.need:
                if not self.low <= byte <= self.high:
                    out.append(self.finish())  # and the byte is read again
                    continue
                self.low, self.high = 0x80, 0xBF
                self.held += data[at : at + 1]
                self.need -= 1
                if not self.need:
                    out.append(self.held.decode())
                    self.held = b""
            elif whole := _WHOLE.match(data, at):
                out.append(whole[0].decode())
                at = whole.end()
                continue
            elif 0xC2 <= byte <= 0xF4:
                self.need = 1 + (byte >= 0xE0) + (byte >= 0xF0)
                self.held = data[at : at + 1]
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("\ufffd")
            at += 1
        return "".join(out)

    def finish(self) -> str:
        """What an unfinished character becomes."""
        held, self.held, self.need = self.held, b"", 0
        self.low, self.high = 0x80, 0xBF
        return "�" if held else ""


def stream_decode(ids: Iterable[int], token: dict[int, bytes]) -> Iterator[str]:
    """Text of ids as they arrive."""
    machine = Utf8Machine()
    for i in ids:
        if text := machine.feed(token[i]):
            yield text
    if text := machine.finish():
        yield text


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


class ByteTokens:
    """Encodes and decodes whole columns; new chunks go through the transducer."""

    def __init__(self, path: str, pattern: str):
        import regex

        ranks = read_ranks(path)
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.transducer = Transducer(ranks)
        top = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if top <= 1 << 16 else "<u4")
        self.length = np.zeros(top, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)
        ordered = sorted(ranks, key=ranks.get)
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.place = np.cumsum(self.length) - self.length
        self.decimal = [str(i) for i in range(top)]
        self.pieces: dict[str, list[int]] = {}
        self.table = SpanTable(self._learn, self.dtype)

    def encode_text(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.pattern.findall(text):
            ids = self.pieces.get(match)
            if ids is None:
                piece = match.encode()
                whole = self.ranks.get(piece)
                ids = self.pieces[match] = self.transducer.encode(piece) if whole is None else [whole]
            out += ids
        return out

    def _learn(self, chunks: list[bytes]):
        if len(self.pieces) > MOST_PIECES:
            self.pieces.clear()
        gc.disable()  # tables that only grow: collecting them again and again costs more than learning
        try:
            made = [self.encode_text(chunk.decode()) for chunk in chunks]
            ids = np.fromiter((i for ids in made for i in ids), self.dtype)
            return ids, np.fromiter(map(len, made), np.int64, len(made))
        finally:
            gc.freeze()
            gc.enable()

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for a, b in text_slices(column, 4 << 20):
            out += self._slice(column.slice(a, b - a))
        return out

    def _slice(self, column: pa.Array) -> list[np.ndarray]:
        # The pattern never matches across the start of a space that a visible character
        # follows, so the text is cut there. Where another kind of white space could
        # follow (C2, E1-E3 begin all of those), the text is not cut at that place.
        data, offsets = raw(column)
        size = len(data)
        if size == 0:
            return [np.zeros(0, self.dtype)] * len(column)
        after = np.append(data[1:], 0x20)
        cut = np.zeros(size + 1, bool)
        cut[:-1] = (data == 0x20) & ~_SPACES[after] & (after != 0xC2) & ((after < 0xE1) | (after > 0xE3))
        inner = offsets[1:-1]
        cut[inner[inner > 0] - 1] &= data[inner[inner > 0] - 1] != 0x20  # a text's last space
        cut[offsets] = True
        place = np.flatnonzero(cut)
        start, end = place[:-1], place[1:]
        ids, count = self.table.gather(data, start, end, span_hashes(data, start, end))
        edges = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(place, offsets)]
        return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def characters(self, ids: np.ndarray, step: int = 4096) -> Iterator[str]:
        """The text of ids as they arrive, ``step`` at a time, through the UTF-8 machine."""
        machine = Utf8Machine()
        for at in range(0, len(ids), step):
            yield machine.feed(self.decode(ids[at : at + step]))
        yield machine.finish()

    def decode(self, ids: np.ndarray) -> bytes:
        length = self.length[ids]
        total = np.cumsum(length)
        at = np.repeat(self.place[ids] - (total - length), length)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()


_loaded: dict[tuple[str, str], ByteTokens] = {}


def byte_tokens(path: str, pattern: str) -> ByteTokens:
    """One per worker process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteTokens(path, pattern)
    return _loaded[path, pattern]


def encode_decode(documents: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) of ``documents`` (doc_id, text).

    A null text counts as empty: no ids, no bytes. Rows stay as they are, repeats included.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_tokens(ranks_file, pattern)
        for batch in batches:
            ids = coder.encode(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([coder.decode(x) for x in ids], pa.binary()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def _decoded_digest(coder: ByteTokens, ids: np.ndarray) -> str:
    digest = hashlib.sha256()
    for characters in coder.characters(ids):
        digest.update(characters.encode())
    return digest.hexdigest()


def round_trip(documents: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """As ``encode_decode``, with digests in place of ids and bytes.

    The ids are decoded as a stream; what is hashed are the characters that the UTF-8 machine emits.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_tokens(ranks_file, pattern)
        decimal = coder.decimal.__getitem__
        for batch in batches:
            ids = coder.encode(batch.column(1))
            listed = [" ".join(map(decimal, x.tolist())).encode() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in listed]),
                    pa.array([_decoded_digest(coder, x) for x in ids]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
