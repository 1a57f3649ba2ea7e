"""Mixture-controlled packing: documents of many sources cut into full training sequences.

Each source is a queue. A deficit round-robin gives every window of ``length`` ids its
share of each queue, in proportion to the targets (by default the queues' own sizes, so that
all end together). What rounding withholds from a queue is its deficit and is carried to the
next window. The round-robin runs over a binary tree of queues: a node that has handed
out t ids has given floor(t * left / all) of them to its left side and the rest to its right,
so a queue's deficit stays below the depth of the tree, and the state after any number of
windows is known in closed form. Each partition therefore starts with the deficits
its windows inherit, without waiting for other partitions. When a queue runs dry, the
others go on with their own proportions.

Every id lies in exactly one piece; sequences have no gaps; only the last may be short, and
is padded to the next power of two. The order within a queue is that of the table's
partitions. A null source is a queue of its own; a null text counts as empty and still has its
end id. An empty table gives no pieces. Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import prepare, written
from quern.llm.word_tokens import word_tokens


@dataclass
class Split:
    """A node above a queue: the weights of both sides, and whether the queue is left."""

    left: int
    both: int
    goes_left: bool


@dataclass
class Phase:
    """A stretch of the id stream in which the same queues are served."""

    start: int
    stop: int
    paths: dict[int, list[Split]]
    taken: dict[int, int]

    def served(self, queue: int, t: int) -> int:
        """Ids of the queue among the phase's first t."""
        for node in self.paths[queue]:
            left = t * node.left // node.both
            t = left if node.goes_left else t - left
        return t

    def before(self, queue: int, t: int) -> int:
        """Ids of the queues that stand before this one, among the phase's first t."""
        total = 0
        for node in self.paths[queue]:
            left = t * node.left // node.both
            if not node.goes_left:
                total += left
            t = left if node.goes_left else t - left
        return total

    def when(self, queue: int, x: int) -> int:
        """The place t in the phase at which id x of the queue's share is handed out."""
        for node in reversed(self.paths[queue]):
            if node.goes_left:
                x = -(-(x + 1) * node.both // node.left) - 1
            else:
                x = x * node.both // (node.both - node.left)
        return x


def _paths(queues: list[int], weight: dict[int, int]) -> dict[int, list[Split]]:
    if len(queues) == 1:
        return {queues[0]: []}
    half = len(queues) // 2
    left, right = queues[:half], queues[half:]
    a, b = sum(weight[q] for q in left), sum(weight[q] for q in right)
    out = {}
    for side, goes_left in ((left, True), (right, False)):
        for queue, path in _paths(side, weight).items():
            out[queue] = [Split(a, a + b, goes_left), *path]
    return out


def phases(sizes: dict[int, int], weight: dict[int, int]) -> list[Phase]:
    """The round-robin's course; ``sizes`` are ids per queue, ``weight`` whole-number targets."""
    rest = {q: n for q, n in sizes.items() if n > 0}
    taken = dict.fromkeys(rest, 0)
    at, out = 0, []
    while rest:
        queues = sorted(q for q in rest if weight.get(q, 0) > 0) or sorted(rest)
        own = {q: weight.get(q, 0) or rest[q] for q in queues}
        made = Phase(at, at, _paths(queues, own), dict(taken))
        span = min(made.when(q, rest[q]) for q in queues)
        span = min(span, sum(rest[q] for q in queues))
        made.stop = at + span
        for q in queues:
            served = made.served(q, span)
            taken[q] += served
            rest[q] -= served
            if rest[q] == 0:
                del rest[q]
        at = made.stop
        out.append(made)
    return out


def pieces(plan: list[Phase], queue: int, start: int, count: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first id, ids, sequence, place there) of the pieces of ids [start, start + count) of a queue."""
    at, stop = start, start + count
    for k, phase in enumerate(plan):
        if queue not in phase.paths:
            continue
        done = phase.taken[queue]
        has = phase.served(queue, phase.stop - phase.start)
        while at < stop and at < done + has:
            t = phase.when(queue, at - done)
            sequence = (phase.start + t) // length
            first = max(sequence * length, phase.start)
            last = min((sequence + 1) * length, phase.stop)
            a, b = first - phase.start, last - phase.start
            head, tail = phase.served(queue, a) + done, phase.served(queue, b) + done
            offset = first - sequence * length + phase.before(queue, b) - phase.before(queue, a) + at - head
            taken = min(stop, tail) - at
            yield at - start, taken, sequence, offset
            at += taken
        if at >= stop:
            return


def pack(
    documents: DataFrame,
    tokens_file: str,
    end_id: int = 1,
    length: int = 2048,
    targets: dict[str | None, int] | None = None,
) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text, source).

    ``targets`` weighs the sources by whole numbers; without it each window has the corpus's own mix.
    Returns doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset and padded
    (the sequence's length with padding). The ids are encoded once and kept in the shared
    folder; only one count per partition and source meets on the driver.
    """
    prepare(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, used = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids = [np.append(x, end_id).astype("<u4") for x in word_tokens(tokens_file).encode(batch.column(2))]
            small = all(len(x) == 0 or x.max() < 1 << 16 for x in ids)
            sources, starts = batch.column(1), []
            for source, x in zip(sources.to_pylist(), ids, strict=True):
                starts.append(used.get(source, 0))
                used[source] = starts[-1] + len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int64()),
                    batch.column(0),
                    sources,
                    pa.array(starts, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u2" if small else "<u4").tobytes() for x in ids], pa.binary()),
                ],
                ["part", "doc_id", "source", "first", "doc_tokens", "ids"],
            )

    layout = "part long, doc_id long, source string, first long, doc_tokens long, ids binary"
    encoded = written(rows.mapInArrow(encode, layout), "packing-ids", compression="zstd")
    part = encoded.groupBy("part", "source").agg(F.sum("doc_tokens").alias("total"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part = written(part.withColumn("base", F.coalesce(F.sum("total").over(ahead), F.lit(0))), "packing-parts")
    # One number per source: the mixture itself.
    total = {r["source"]: r["n"] for r in part.groupBy("source").agg(F.sum("total").alias("n")).collect()}
    names = sorted(total, key=lambda s: (s is not None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    sizes = {number[s]: n for s, n in total.items()}
    plan = phases(sizes, {number[s]: w for s, w in (targets or total).items() if s in number})
    all_ids = sum(sizes.values())
    last = all_ids // length
    short = all_ids % length
    padded_last = 1 << (short - 1).bit_length() if short else length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc, source, first, base, count, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = memoryview(np.frombuffer(blob, f"<u{len(blob) // count}").astype("<u4").tobytes())
                for start, size, sequence, offset in pieces(plan, number[source], first + base, count, length):
                    row = (doc, source, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), count,
                           sequence, offset, padded_last if sequence == last else length)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 7]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded"],
            )

    return (
        encoded.alias("e")
        .join(part.alias("p"), (F.col("e.part") == F.col("p.part")) & F.col("e.source").eqNullSafe(F.col("p.source")))
        .select("e.doc_id", "e.source", "e.first", "p.base", "e.doc_tokens", "e.ids")
        .mapInArrow(
            cut,
            "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
            "sequence_id long, offset long, padded long",
        )
    )
