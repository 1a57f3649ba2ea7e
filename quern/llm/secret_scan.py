"""Secret scans: rules, and a character convolutional network over every other candidate.

The rules find assignments, access keys and long hexadecimal strings. A candidate is any run of at
least 8 of ``A-Za-z0-9+/_.=-``. The network (numpy) reads a candidate
with the text around it, in windows that cover it whole; its best window counts. It learns from every
window of every text, of three sorts that weigh alike on their side: candidates that a
rule confirms, unconfirmed ones that hold a letter, and unconfirmed ones without any, which are
ordinary numbers (card and phone numbers, addresses, dates). The last are few among all
unconfirmed ones but the hardest, so they are a sort of their own. One window in four, by a hash of
it, is kept from training: all of those calibrate
the output, set the threshold and give ``report``. The highest that still finds the demanded share of the confirmed ones
is the constraint; the threshold lies halfway between it and the best score of an unconfirmed one, if
that is lower. Candidates above it that touch no rule's
span are added as kind ``model``.

Training goes in rounds. Each round takes texts not taken before, about eight times as many windows as the round
before it, until none is left; its tasks start from the same network, learn from all their windows and their networks are
averaged by the number of windows. The first round is one task, so that the later ones start from a common trained
network. Small tables are one round and are read several times. A batch is filled up with windows
of the rarer sorts that the task has met already; at first these are 64 of each sort, which
stand in for a sort until a task meets one of its own.

A null or empty text has no spans. Without findings of both sorts nothing is learned and
nothing added. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.common import partitions, plain, prepare, text_slices
from quern.llm.words import mixed, raw

KINDS = ("assign", "access", "hex", "model")
# The rules, over UTF-8; all they take is ASCII.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_NAMES = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")

#: Sorts of labelled findings.
NUMBER, OTHER, CONFIRMED = 0, 1, 2

BEFORE, INSIDE, AFTER = 24, 32, 8
WINDOW = BEFORE + INSIDE + AFTER

#: Windows of the first round, and how many times more each later one has.
FIRST, GROWTH = 250_000, 8
#: Windows of each sort in a training step.
STEP = {NUMBER: 32, OTHER: 448, CONFIRMED: 32}
#: Characters of a candidate that is judged alone in a shorter window.
SHORT = 16
#: Windows that a task holds at once, that it remembers of each sort for later steps, and that it starts with.
HELD, REMEMBERED, STAND_INS = 1 << 18, 8_192, 64
#: Logits are counted in steps of 1 / FINE.
FINE = 1024
#: Places of windows that pass the convolution at once in training: what they need stays in the caches.
TOGETHER = 1 << 14


def _table(characters: str) -> bytes:
    """1 for these bytes, 0 for others."""
    return bytes(i in characters.encode() for i in range(256))


_LETTER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_RUN = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def _places(whole: bytes, names: Sequence[bytes]) -> list[int]:
    """Where the names begin, ascending."""
    out = []
    for name in names:
        at = whole.find(name)
        while at >= 0:
            out.append(at)
            at = whole.find(name, at + 1)
    return sorted(out)


def _runs(member: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the runs of at least ``least`` member bytes; none crosses texts."""
    inside = np.zeros(len(member) + 2, bool)
    inside[1:-1] = member
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    keep = end - start >= least
    start, end = start[keep], end[keep]
    if not len(start):
        return start, end
    inner = offsets[1:-1]
    k = np.searchsorted(start, inner, side="right") - 1
    crossed = (k >= 0) & (start[np.maximum(k, 0)] < inner) & (inner < end[np.maximum(k, 0)])
    k, cut = k[crossed], inner[crossed]
    start, end = np.insert(start, k + 1, cut), np.insert(end, k, cut)
    keep = end - start >= least
    return start[keep], end[keep]


class Candidates:
    """Candidates of a slice of texts, and the rules' spans, in byte places of the slice."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = raw(column)
        self.whole = self.data.tobytes()
        self.start, self.end = _runs(np.frombuffer(self.whole.translate(_RUN), bool), self.offsets, 8)
        self.text = np.searchsorted(self.offsets, self.start, side="right") - 1
        #: (text, start, end, kind) of what the rules find.
        self.found = self._rules()
        reached = np.zeros(len(self.start) + 1, np.int64)
        if self.found:
            first, last = np.array([f[1:3] for f in self.found]).T
            np.add.at(reached, np.searchsorted(self.end, first, side="right"), 1)
            np.add.at(reached, np.searchsorted(self.start, last, side="left"), -1)
        self.confirmed = np.cumsum(reached)[:-1] > 0

    def _rules(self) -> list[tuple[int, int, int, str]]:
        # A rule is tried only where its first letters stand, and hexadecimal strings only in candidates of their length.
        whole, ends, out = self.whole, self.offsets.tolist(), []
        for kind, rule, places in (("assign", _ASSIGN, _places(whole.lower(), _NAMES)), ("access", _ACCESS, _places(whole, [b"AKIA"]))):
            done = 0
            for at in places:
                if at < done:
                    continue
                row = bisect_right(ends, at) - 1
                match = rule.match(whole, at, ends[row + 1])
                if match:
                    done = match.end()
                    if len(match[2]) >= 8 if kind == "assign" else done - at >= 16:
                        out.append((row, at, done, kind))
        for i in np.flatnonzero(self.end - self.start >= 32).tolist():
            row = int(self.text[i])
            out += [(row, m.start(), m.end(), "hex") for m in _HEX.finditer(whole, int(self.start[i]), int(self.end[i]))]
        return out

    def spans(self, added: np.ndarray) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) in code points of what the rules find and of the candidates ``added``, by start, then kind."""
        out: list[list[tuple[int, int, str]]] = [[] for _ in range(len(self.offsets) - 1)]
        found = self.found + [(int(self.text[i]), int(self.start[i]), int(self.end[i]), "model") for i in added.tolist()]
        if found:
            before = np.zeros(len(self.data) + 1, np.int64)
            np.cumsum((self.data & 0xC0) != 0x80, out=before[1:])
            for row, a, b, kind in found:
                start = int(before[a] - before[self.offsets[row]])
                out[row].append((start, start + b - a, kind))
        return [sorted(s, key=lambda s: (s[0], KINDS.index(s[2]))) for s in out]

    def sorts(self) -> np.ndarray:
        """The sort of each candidate."""
        letters = np.zeros(len(self.data) + 1, np.int32)
        np.cumsum(np.frombuffer(self.whole.translate(_LETTER), np.uint8), dtype=np.int32, out=letters[1:])
        unconfirmed = np.where(letters[self.end] > letters[self.start], OTHER, NUMBER)
        return np.where(self.confirmed, CONFIRMED, unconfirmed)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes around each candidate, 0 beyond its text, in as many windows as cover it.

        A candidate's own bytes, all ASCII, count 128 more; other bytes beyond ASCII are 128.
        """
        parts = (self.end - self.start + INSIDE - 1) // INSIDE
        owner = np.repeat(np.arange(len(self.start)), parts)
        part = np.arange(len(owner)) - (np.cumsum(parts) - parts)[owner]
        begin = self.start[owner] + part * INSIDE - BEFORE
        padded = np.zeros(len(self.data) + BEFORE + WINDOW, np.uint8)
        np.minimum(self.data, 128, out=padded[BEFORE : BEFORE + len(self.data)])
        seen = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[begin + BEFORE]
        seen += _OWN[(part > 0).astype(int), np.minimum(self.end[owner] - begin, WINDOW)]
        low, high = self.offsets[self.text[owner]], self.offsets[self.text[owner] + 1]
        edge = np.flatnonzero((begin < low) | (begin + WINDOW > high))
        at = begin[edge, None] + np.arange(WINDOW)
        seen[edge] *= (at >= low[edge, None]) & (at < high[edge, None])
        return seen, owner


#: 128 where a window's own candidate lies: whether it began in an earlier window, and where it ends.
_OWN = np.array([[[128 * (a <= i < b) for i in range(WINDOW)] for b in range(WINDOW + 1)] for a in (BEFORE, 0)], np.uint8)


def keys(windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each window."""
    parts = np.ascontiguousarray(windows).view(np.uint64)
    out = np.zeros(len(parts), np.uint64)
    for i in range(parts.shape[1]):
        out = mixed(out ^ parts[:, i]) + np.uint64(i)
    return out


def kept_back(key: np.ndarray) -> np.ndarray:
    """Whether a window is kept from training."""
    return key % np.uint64(4) == 3


class Network:
    """Embedding, one convolution with max-pooling, one logistic unit."""

    SYMBOLS, WIDTH = 256, 5
    NAMES = ("embed", "kernel", "bias", "out", "base")

    def __init__(self, width: int = 12, filters: int = 32, seed: int = 11):
        random = np.random.default_rng(seed)
        self.embed = random.normal(0, 0.3, (self.SYMBOLS, width)).astype(np.float32)
        self.kernel = random.normal(0, 0.15, (self.WIDTH * width, filters)).astype(np.float32)
        self.bias = np.zeros(filters, np.float32)
        self.out = random.normal(0, 0.1, filters).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.slope, self.shift, self.threshold = 1.0, 0.0, 1.0
        #: Of the findings kept from training: how many of each sort there are and how many lie above the threshold.
        self.report: dict[str, tuple[int, int]] = {}

    def _tables(self) -> np.ndarray:
        """What each symbol adds to each filter, by its place in the convolution."""
        tables = self.embed @ self.kernel.reshape(self.WIDTH, self.embed.shape[1], -1)
        tables[0] += self.bias
        return tables

    def _forward(self, x: np.ndarray):
        """The best value of each filter, its place in the window and the logits."""
        return next(self._forwards([x]))

    def _forwards(self, parts: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part of windows the best value of each filter, its place in the window and the logits.

        Pairs of symbols are looked up together, in tables of those that occur. Values are whole numbers, ``one`` stands
        for 1; any sum has 25 bits with its sign, so that the place rides in 6 lower bits.
        """
        tables, filters = self._tables(), len(self.out)
        most = max(float(np.abs(tables).max((1, 2)).sum()), 1e-30)
        one = np.float32(2.0 ** (24 - np.ceil(np.log2(most))))
        tables = np.rint(tables * one).astype(np.int32) << 6
        turned = [np.ascontiguousarray(x.T) for x in parts]
        two = np.concatenate([((t[:-1].astype(np.uint16) << 8) | t[1:]).ravel() for t in turned])
        known = np.flatnonzero(np.bincount(two, minlength=self.SYMBOLS**2) > 0)
        number = np.zeros(self.SYMBOLS**2, np.intp)
        number[known] = np.arange(len(known))
        pairs = [tables[j].take(known >> 8, 0) + tables[j + 1].take(known & 255, 0) for j in range(0, self.WIDTH - 1, 2)]
        all_pairs, done = number.take(two), 0
        for symbols in turned:
            pair = all_pairs[done : done + symbols[1:].size].reshape(-1, symbols.shape[1])
            done += pair.size
            length = len(symbols) - self.WIDTH + 1
            size = max(1, min(symbols.shape[1], TOGETHER // length))
            held = np.empty((2, length * size * filters), np.int32)
            ranked = np.empty((symbols.shape[1], filters), np.int32)
            for i in range(0, len(ranked), size):
                part = slice(i, i + size)
                seen, more = held[:, : length * len(ranked[part]) * filters].reshape(2, length, -1, filters)
                np.take(tables[-1], symbols[self.WIDTH - 1 :, part], axis=0, mode="clip", out=seen)
                for j, table in enumerate(pairs):
                    np.take(table, pair[2 * j : 2 * j + length, part], axis=0, mode="clip", out=more)
                    seen += more
                seen += np.arange(length, dtype=np.int32)[:, None, None]
                seen.max(0, out=ranked[part])
            pooled = np.maximum((ranked >> 6) / one, 0, dtype=np.float32)
            yield pooled, ranked & 63, pooled @ self.out + self.base[0]

    def logits(self, x: np.ndarray, key: np.ndarray | None = None) -> np.ndarray:
        """Logits of windows; ``key`` are their keys, if known."""
        if not len(x):
            return np.zeros(0, np.float32)
        # Equal windows are scored once; pairs of symbols are looked up together.
        _, first, back = np.unique(keys(x) if key is None else key, return_index=True, return_inverse=True)
        tables, pairs = self._scoring()
        length = x.shape[1] - self.WIDTH + 1
        out = np.empty(len(first), np.float32)
        for i in range(0, len(first), 256):
            symbols = np.ascontiguousarray(x[first[i : i + 256]].T).astype(np.intp)
            two = symbols[:-1] * self.SYMBOLS + symbols[1:]
            seen = np.take(tables[-1], symbols[self.WIDTH - 1 :], axis=0, mode="clip")
            for j, table in enumerate(pairs):
                seen += np.take(table, two[2 * j : 2 * j + length], axis=0, mode="clip")
            out[i : i + 256] = np.maximum(seen.max(0), 0) @ self.out + self.base[0]
        return out[back]

    def _scoring(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The tables, and those of pairs, made once for one set of parameters."""
        held = getattr(self, "_held", None)
        if held is None or any(a is not b for a, b in zip(held[0], self.parameters(), strict=True)):
            tables = self._tables()
            pairs = [(tables[j][:, None] + tables[j + 1][None]).reshape(-1, len(self.out)) for j in range(0, self.WIDTH - 1, 2)]
            self._held = held = (self.parameters(), tables, pairs)
        return held[1], held[2]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_held"}

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def assign(self, flat: np.ndarray) -> None:
        """Parameters from ``flat``."""
        for name, old in zip(self.NAMES, self.parameters(), strict=True):
            setattr(self, name, flat[: old.size].astype(np.float32).reshape(old.shape))
            flat = flat[old.size :]

    def _descend(self, parts: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], state: dict, rate: float) -> None:
        """One step of Adam on the weighted logistic loss over parts (windows of one length, labels, weights)."""
        width, filters = self.embed.shape[1], len(self.out)
        grads = {name: np.zeros_like(p) for name, p in zip(self.NAMES, self.parameters(), strict=True)}
        amounts, cells, begin = [], [], 0
        for (x, y, weight), (pooled, best, logit) in zip(parts, self._forwards([x for x, _, _ in parts]), strict=True):
            error = ((1 / (1 + np.exp(-logit)) - y) * weight).astype(np.float32)
            # Where no value is above 0 nothing is learned.
            back = error[:, None] * self.out * (pooled > 0)
            moved = np.flatnonzero(back != 0)
            amounts.append(back.ravel()[moved])
            row, mine = np.divmod(moved, filters)
            cells.append((begin + row * x.shape[1] + best.ravel()[moved], mine))
            begin += x.size
            grads["bias"] += back.sum(0)
            grads["out"] += pooled.T @ error
            grads["base"] += error.sum(keepdims=True)
        symbols = np.concatenate([x.ravel() for x, _, _ in parts]).astype(np.intp) * filters
        amount = np.concatenate(amounts).astype(float)
        at, mine = (np.concatenate(c) for c in zip(*cells, strict=True))
        pull = np.array([np.bincount(symbols[at + j] + mine, amount, self.SYMBOLS * filters) for j in range(self.WIDTH)], np.float32)
        pull = pull.reshape(self.WIDTH, self.SYMBOLS, filters)
        kernel = self.kernel.reshape(self.WIDTH, width, filters)
        grads["kernel"] = (self.embed.T @ pull).reshape(self.kernel.shape)
        grads["embed"] = (pull @ kernel.transpose(0, 2, 1)).sum(0)
        state["step"] = step = state.get("step", 0) + 1
        pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for name in self.NAMES:
            first, second = state.get(name, (0, 0))
            first, second = 0.9 * first + 0.1 * grads[name], 0.999 * second + 0.001 * grads[name] ** 2
            state[name] = first, second
            setattr(self, name, (getattr(self, name) - pace * first / (np.sqrt(second) + 1e-8)).astype(np.float32))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 5) -> None:
        """Adam on the logistic loss; both sorts weigh alike."""
        random = np.random.default_rng(seed)
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        state: dict = {}
        for _ in range(epochs):
            order = random.permutation(len(x))
            for i in range(0, len(x), 128):
                rows = order[i : i + 128]
                self._descend([(x[rows], y[rows], weight[rows] / len(rows))], state, rate)

    def learn(self, new: dict[int, np.ndarray], memory: dict[int, np.ndarray], state: dict, random: np.random.Generator, rate: float) -> None:
        """Every window of ``new`` (by sort) at least once, with and without the text around it.

        A step has the same number of windows of a sort; where a sort has too few new ones, all of it that is
        known, in ``new`` and in ``memory``, is drawn from.
        """
        steps = max(-(-len(new[sort]) // STEP[sort]) for sort in STEP)
        known = {sort: np.concatenate([new[sort], memory[sort]]) for sort in STEP}
        known = {sort: x for sort, x in known.items() if len(x)}
        order = {}
        for sort, x in known.items():
            more = random.integers(len(x), size=steps * STEP[sort] - len(new[sort]))
            order[sort] = random.permutation(np.concatenate([random.permutation(len(new[sort])), more]))
        others = max(1, sum(sort != CONFIRMED for sort in known))
        for i in range(steps):
            batch = [x[order[sort][i * STEP[sort] : (i + 1) * STEP[sort]]] for sort, x in known.items()]
            # Weights: half for the confirmed ones, and half of each for a window without the text around it.
            weight = np.concatenate([np.full(STEP[s], 0.25 / STEP[s] / (1 if s == CONFIRMED else others)) for s in known])
            y = np.concatenate([np.full(STEP[s], float(s == CONFIRMED)) for s in known])
            x = np.concatenate(batch)
            bare = np.where(x >= 128, x, 0).astype(np.uint8)
            # A short one alone is nothing but 0 outside these places.
            short = ~(bare[:, :BEFORE].any(1) | bare[:, BEFORE + SHORT :].any(1))
            near = bare[short, BEFORE - self.WIDTH : BEFORE + SHORT + self.WIDTH]
            parts = [(x, y, weight), (near, y[short], weight[short]), (bare[~short], y[~short], weight[~short])]
            self._descend([p for p in parts if len(p[0])], state, rate)

    def calibrate(self, logit: np.ndarray, y: np.ndarray, recall: float, n: np.ndarray | None = None) -> None:
        """Slope and shift that fit the chances, and a threshold with at least that recall.

        ``n`` says how often each pair of logit and label occurs; once if not given.
        """
        n = np.ones(len(y)) if n is None else n
        ones, rest = n[y > 0].sum(), n[y == 0].sum()
        goal = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (rest + 2))
        self.slope, self.shift = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(self.slope * logit + self.shift)))
            w = n * np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(w * logit * logit).sum(), (w * logit).sum()], [(w * logit).sum(), w.sum()]]) + 1e-6 * np.eye(2)
            miss = n * (p - goal)
            move = np.linalg.solve(h, [(miss * logit).sum(), miss.sum()])
            self.slope, self.shift = self.slope - np.clip(move[0], -1, 1), self.shift - np.clip(move[1], -1, 1)
        order = np.argsort(-self.chance(logit[y > 0]), kind="stable")
        upto = np.cumsum(n[y > 0][order])
        most = float(self.chance(logit[y > 0])[order][np.searchsorted(upto, min(ones, np.ceil(recall * ones)))])
        best_other = float(self.chance(logit[y == 0]).max())
        self.threshold = min(most, (most + best_other) / 2)

    def chance(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logit + self.shift)))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(windows, sorts, keys) of slices of texts."""
    for batch in batches:
        for a, b in text_slices(batch.column(0)):
            found = Candidates(batch.column(0).slice(a, b - a))
            windows, owner = found.windows()
            yield windows, found.sorts()[owner], keys(windows)


def _survey(rows: DataFrame) -> tuple[dict[tuple[int, bool], int], dict[int, np.ndarray]]:
    """How many windows there are of each sort, in training and kept back; and the ``STAND_INS`` of least key of each sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.zeros(2 * len(STEP), np.int64)
        least: dict[int, list] = {sort: [np.zeros(0, np.uint64), np.zeros((0, WINDOW), np.uint8)] for sort in STEP}
        for windows, sorts, key in _windows(batches):
            back = kept_back(key)
            number += np.bincount(2 * sorts + back, minlength=len(number))
            for sort, held in least.items():
                mine = np.flatnonzero((sorts == sort) & ~back)
                mine = mine[np.argsort(key[mine], kind="stable")[:STAND_INS]]
                every = np.concatenate([held[0], key[mine]])
                every, at = np.unique(every, return_index=True)
                held[:] = every[:STAND_INS], np.concatenate([held[1], windows[mine]])[at[:STAND_INS]]
        for sort, (key, windows) in least.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([sort], pa.int32()), pa.array([number[2 * sort]]), pa.array([number[2 * sort + 1]]),
                 pa.array([key.tobytes()], pa.binary()), pa.array([windows.tobytes()], pa.binary())],
                ["sort", "here", "back", "keys", "windows"],
            )

    counts = {(sort, back): 0 for sort in STEP for back in (False, True)}
    first: dict[int, dict[int, bytes]] = {sort: {} for sort in STEP}
    # Three small rows a task.
    for r in rows.mapInArrow(run, "sort int, here long, back long, keys binary, windows binary").collect():
        counts[r["sort"], False] += r["here"]
        counts[r["sort"], True] += r["back"]
        held = first[r["sort"]]
        held.update((k, r["windows"][i * WINDOW : (i + 1) * WINDOW]) for i, k in enumerate(np.frombuffer(r["keys"], np.uint64).tolist()))
        first[r["sort"]] = dict(sorted(held.items())[:STAND_INS])
    return counts, {s: np.frombuffer(b"".join(held.values()), np.uint8).reshape(-1, WINDOW) for s, held in first.items()}


def _trained(rows: DataFrame, network: Network, memory: dict[int, np.ndarray], passes: int, rate: float) -> Network:
    """``network`` after training on all windows of ``rows``: one copy a task, averaged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, state, known = Network(), {}, dict(memory)
        mine.assign(network.flat())
        random = np.random.default_rng(5)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        total = held = 0

        def learn() -> None:
            x, sorts = (np.concatenate(c) for c in zip(*parts, strict=True))
            new = {sort: x[sorts == sort] for sort in STEP}
            for _ in range(passes):
                mine.learn(new, known, state, random, rate)
            for sort, found in new.items():
                known[sort] = np.concatenate([known[sort], found[-REMEMBERED:]])[-REMEMBERED:]
            parts.clear()

        for windows, sorts, key in _windows(batches):
            take = ~kept_back(key)
            parts.append((windows[take], sorts[take]))
            held += int(take.sum())
            total += int(take.sum())
            if held >= HELD:
                learn()
                held = 0
        if held:
            learn()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([mine.flat().tobytes()], pa.binary())], ["n", "network"])

    total, mean = 0, np.zeros(len(network.flat()))
    for r in rows.mapInArrow(run, "n long, network binary").collect():  # one network a task
        total += r["n"]
        mean += (np.frombuffer(r["network"], np.float32) - mean) * (r["n"] / total)
    made = Network()
    made.assign(mean if total else network.flat())
    return made


def _measured(rows: DataFrame, network: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logit, sort, n) of all windows kept back; logits are rounded down to steps of 1 / FINE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for windows, sorts, key in _windows(batches):
            back = kept_back(key)
            step = np.floor(np.clip(network.logits(windows[back], key[back]), -128, 128) * FINE).astype(np.int64)
            found, n = np.unique(np.stack([sorts[back], step], axis=1), axis=0, return_counts=True)
            for (sort, at), count in zip(found.tolist(), n.tolist(), strict=True):
                total[sort, at] = total.get((sort, at), 0) + count
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()), pa.array(list(total.values()), pa.int64())],
            ["sort", "step", "n"],
        )

    # At most 3 * 256 * FINE rows, of which few occur.
    steps = rows.mapInArrow(run, "sort int, step int, n long").groupBy("sort", "step").agg(F.sum("n").alias("n")).orderBy("sort", "step").toPandas()
    return steps["step"].to_numpy() / FINE, steps["sort"].to_numpy(), steps["n"].to_numpy().astype(float)


def fit(documents: DataFrame, recall: float = 0.98) -> Network | None:
    """Train on all findings of all texts; one in four is kept for calibration."""
    spark = prepare(documents.sparkSession)
    rows = documents.select(F.col("text").cast("string").alias("text"))
    counts, memory = _survey(rows)
    if not all(counts[CONFIRMED, b] and counts[NUMBER, b] + counts[OTHER, b] for b in (False, True)):
        return None
    # Copies of a text are dealt apart by the other columns.
    place = F.pmod(F.xxhash64(*[c for c in documents.columns if not dict(documents.dtypes)[c].startswith("map")]), F.lit(1 << 20))
    dealt = documents.select(F.col("text").cast("string").alias("text"), place.alias("place"))
    total = sum(n for (_, back), n in counts.items() if not back)
    made, done, size, rate = Network(), 0, FIRST, 0.01
    while done < 1 << 20:
        upto = 1 << 20 if done / (1 << 20) * total + 2 * size >= total else done + max(1, int(size / total * (1 << 20)))
        share = (upto - done) / (1 << 20)
        tasks = max(1, min(partitions(spark), round(share * total / FIRST)))
        part = dealt.where(_between(F.col("place"), done, upto))
        if tasks == 1 or share < 0.5:
            part = part.repartition(tasks, "place").sortWithinPartitions("place", "text")
        else:
            part = part.coalesce(tasks)
        made = _trained(part.select("text"), made, memory, max(1, min(32, FIRST // total)), rate)
        done, size, rate = upto, size * GROWTH, rate / 2
    logit, sort, n = _measured(rows, made)
    made.calibrate(logit, (sort == CONFIRMED).astype(float), recall, n)
    above = made.chance(logit) >= made.threshold
    for name, number in (("number", NUMBER), ("other", OTHER), ("confirmed", CONFIRMED)):
        made.report[name] = (int(n[sort == number].sum()), int(n[above & (sort == number)].sum()))
    return made


def _between(place: Column, low: int, high: int) -> Column:
    return (place >= low) & (place < high)


def spans_of(column: pa.Array, network: Network | None) -> list[list[tuple[int, int, str]]]:
    """All spans of each text, by start, then kind."""
    out: list[list[tuple[int, int, str]]] = []
    for a, b in text_slices(column):
        found = Candidates(column.slice(a, b - a))
        added = np.zeros(0, np.int64)
        if network is not None and len(found.start):
            windows, owner = found.windows()
            best = np.zeros(len(found.start))
            np.maximum.at(best, owner, network.chance(network.logits(windows)))
            added = np.flatnonzero((best >= network.threshold) & ~found.confirmed)
        out += found.spans(added)
    return out


def scan(documents: DataFrame, network: Network | None) -> DataFrame:
    """All columns of ``documents`` and ``secrets``: an array of (kind, start, end), by start, then kind."""
    prepare(documents.sparkSession)
    rows, names = plain(documents, "secrets")
    at = names.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of(batch.column(at).cast(pa.string()), network)
            listed = pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in s] for s in found], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "secrets"])

    added = StructType.fromDDL("secrets array<struct<kind: string, start: bigint, end: bigint>>")
    return rows.mapInArrow(run, StructType(rows.schema.fields + added.fields)).toDF(*names, "secrets")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts per kind, base_sha256 over the rules' spans, and all spans as text."""

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "model")
    return scanned.select(
        "doc_id", *[number(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans")
    )


def redact(scanned: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``scanned`` with every span of text replaced by ``mark``, overlapping spans by one; n_chars follows."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))

    def cover(done, span):
        before = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        more = F.when(span["start"] >= done["at"], F.concat(before, F.lit(mark))).otherwise("")
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["text"], more).alias("text"))

    def rest(done):
        return F.concat(done["text"], F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.length("text")))

    covered = F.aggregate("secrets", start, cover, rest)
    rows = scanned.withColumn("text", F.when(F.size("secrets") > 0, covered).otherwise(F.col("text"))).drop("secrets")
    if "n_chars" not in rows.columns:
        return rows
    length = F.length("text").cast(scanned.schema["n_chars"].dataType)
    return rows.withColumn("n_chars", F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))
