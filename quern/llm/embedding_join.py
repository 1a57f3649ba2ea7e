"""Near-duplicate embeddings by a block nested loop over chunks, with a bound from a few rotated coordinates.

Equal vectors are one unit. The distinct vectors are written once, as chunks of at most ``chunk`` packed
vectors, and every two chunks meet in one task that reads both from the shared folder: no vector is
shuffled for a comparison, so disk grows with the vectors, not with the pairs. Of two unit vectors' cosine, the
share of some fixed orthonormal directions is a short product and the rest at most the product of the remaining lengths;
one matrix product gives that bound for all pairs of two chunks. Pairs that the bound lets through are
multiplied in full, and those within rounding of the threshold once more in double precision from the
given vectors, so every link is found and counted once. A task returns link counts and a forest of
links, never pairs. The work grows with the square of the distinct vectors.

Equal vectors' ids are all linked. Vectors that are null, zero or
hold null or non-finite components link with nothing, nor do rows with a null id, whose component is
null. Vectors of different lengths are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from quern.llm.common import partitions, prepare, written
from quern.llm.components import components
from quern.session import scratch_path

#: Bytes of vectors in a chunk at most; rows and columns of one matrix product; linked pairs kept until they are merged.
_CHUNK_BYTES, _TILE, _PENDING = 4 << 20, 512, 1 << 20
#: Chunks in one scan partition of a side, and bytes of prepared chunks a task keeps.
_SIDE, _KEPT = 16, 96 << 20


@lru_cache(4)
def directions(size: int, most: int, seed: int = 3) -> np.ndarray:
    """``most`` fixed orthonormal columns."""
    q, r = np.linalg.qr(np.random.default_rng(seed + size).normal(size=(size, most)))
    return q * np.sign(np.diag(r))


def leading(size: int, cosine: float) -> int:
    """How many directions let about one even pair in a thousand through; one less than a multiple of eight."""
    spread = 3.2 / sqrt(size)
    share = (spread + sqrt(spread * spread + 4 * max(0.0, 1 - cosine))) / 2
    return min(size, 8 * max(1, round(share * share * size / 8)) - 1)


@dataclass
class Chunk:
    """Vectors as given, their lengths, unit vectors and the short vectors whose product bounds the cosine."""

    given: np.ndarray
    norm: np.ndarray
    unit: np.ndarray
    short: np.ndarray

    @classmethod
    def of(cls, given: np.ndarray, cosine: float) -> Chunk:
        wide = given.astype("<f8")
        norm = np.sqrt(np.einsum("ij,ij->i", wide, wide))
        wide /= norm[:, None]
        lead = wide @ directions(given.shape[1], leading(given.shape[1], cosine))
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", lead, lead)))
        return cls(given, norm, wide.astype(np.float32), np.column_stack([lead, rest]).astype(np.float32))

    @property
    def bytes(self) -> int:
        return self.given.nbytes + self.norm.nbytes + self.unit.nbytes + self.short.nbytes


def reached(left: np.ndarray, right: np.ndarray, least: float, room: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Flat places where left @ right.T is ``least`` or more. Most are not, so flags are skipped by eights."""
    n = len(left) * len(right)
    product, flag = room[0][:n].reshape(len(left), len(right)), room[1][: n + -n % 8]
    np.matmul(left, right.T, out=product)
    flag[n:] = False
    np.greater_equal(product, least, out=flag[:n].reshape(product.shape))
    if 16 * np.count_nonzero(flag) > n:
        return np.flatnonzero(flag)
    some = np.flatnonzero(flag.view(np.uint64) != 0)
    at, rest = np.nonzero(flag.reshape(-1, 8)[some])
    return 8 * some[at] + rest


def compare_chunks(a: Chunk, b: Chunk, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of ``a`` with ``b`` as index arrays; each unordered pair once where both are the same chunk."""
    size, inner = a.given.shape[1], a is b
    slack = 1.2e-7 * (size + 8)  # more than single precision can err
    step = max(1, (1 << 20) // size)
    room = np.empty(_TILE * _TILE, np.float32), np.empty(_TILE * _TILE + 8, bool)

    def products(x: np.ndarray, y: np.ndarray, left: np.ndarray, right: np.ndarray, kind: str) -> np.ndarray:
        parts = [(x[at : at + step], y[at : at + step]) for at in range(0, len(x), step)]
        return np.concatenate([np.einsum("ij,ij->i", left[p].astype(kind), right[q].astype(kind)) for p, q in parts])

    for i in range(0, len(a.norm), _TILE):
        for j in range(i if inner else 0, len(b.norm), _TILE):
            left, right = slice(i, i + _TILE), slice(j, j + _TILE)
            found = reached(a.short[left], b.short[right], cosine - slack, room)
            if not len(found):
                continue
            across = len(b.norm[right])
            if 16 * len(found) > len(a.norm[left]) * across:  # as a matrix product
                found = reached(a.unit[left], b.unit[right], cosine - slack, room)
                near = room[0][found]
                x, y = found // across + i, found % across + j
            else:
                x, y = found // across + i, found % across + j
                near = products(x, y, a.unit, b.unit, "<f4")
            open_ = near >= cosine - slack
            if inner:
                open_ &= x < y
            x, y, near = x[open_], y[open_], near[open_]
            close = np.flatnonzero(near < cosine + slack)
            if len(close):
                p, q = x[close], y[close]
                linked = np.ones(len(x), bool)
                linked[close] = products(p, q, a.given, b.given, "<f8") >= cosine * (a.norm[p] * b.norm[q])
                x, y = x[linked], y[linked]
            if len(x):
                yield x, y


class Links:
    """Link counts and connected parts of the vectors that one task meets."""

    def __init__(self) -> None:
        self.rep, self.copies = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.count, self.root = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def admit(self, rep: np.ndarray, copies: np.ndarray) -> int:
        """The place of the first of these vectors."""
        first = len(self.rep)
        self.rep, self.copies = np.append(self.rep, rep), np.append(self.copies, copies)
        self.count = np.append(self.count, np.zeros(len(rep), np.int64))
        self.root = np.append(self.root, np.arange(first, first + len(rep)))
        return first

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        np.add.at(self.count, x, self.copies[y])
        np.add.at(self.count, y, self.copies[x])
        self.pending.append((x, y))
        self.waiting += len(x)
        if self.waiting >= _PENDING:
            self.merge()

    def merge(self) -> None:
        """Hooks every part to the least one it is linked with, until no link joins two parts."""
        if not self.pending:
            return
        x, y = (np.concatenate(side) for side in zip(*self.pending, strict=True))
        self.pending, self.waiting = [], 0
        while True:
            x, y = self.root[x], self.root[y]
            apart = x != y
            if not apart.any():
                return
            x, y = x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(above := self.root[self.root], self.root):
                self.root = above

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(a, null, links) of each linked vector and (a, b, null) for a star around each part."""
        self.merge()
        linked, leaves = np.flatnonzero(self.count), np.flatnonzero(self.root != np.arange(len(self.root)))
        for at, b, links in ((linked, None, self.count[linked]), (leaves, self.rep[self.root[leaves]], None)):
            nothing = pa.nulls(len(at), pa.int64())
            values = [pa.array(self.rep[at]), *(nothing if v is None else pa.array(v) for v in (b, links))]
            yield pa.RecordBatch.from_arrays(values, ["a", "b", "links"])


def packed_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, v) of rows (vec_id, e, ok): the bytes of a sound vector, without negative zeros."""
    for batch in batches:
        ids, e, ok = batch.column(0), batch.column(1), np.array(batch.column(2), dtype=bool)
        void = np.flatnonzero(~ok)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(void)), pa.nulls(len(void), pa.binary())], ["vec_id", "v"])
        places = np.array(e.offsets)
        length, flat = np.diff(places), e.values.to_numpy(zero_copy_only=False)
        for n in np.unique(length[ok]).tolist():
            at = np.flatnonzero(ok & (length == n))
            given = flat[places[at][:, None] + np.arange(n)] + flat.dtype.type(0)
            # Lengths beyond the range of squares: a power of two keeps the direction exactly.
            top = np.abs(given).max(1).astype("<f8")
            far = ~((top > 1e-140) & (top < 1e140))
            if far.any():
                given[far] = np.ldexp(given[far], -np.frexp(top[far])[1][:, None])
            given = np.ascontiguousarray(given, flat.dtype.newbyteorder("<"))
            width = pa.binary(n * flat.itemsize)
            made = pa.FixedSizeBinaryArray.from_buffers(width, len(at), [None, pa.py_buffer(given)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), made], ["vec_id", "v"])


def chunks_of(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows (v, rep, copies) as rows of many: width, and the bytes of vectors, reps and copies side by side."""
    held: dict[int, list[list[np.ndarray]]] = {}

    def made(width: int, most: int, least: int) -> Iterator[pa.RecordBatch]:
        """Chunks of ``most`` rows while ``least`` rows are there."""
        v, *numbers = (np.concatenate(parts) for parts in held[width])
        at = 0
        while len(v) - at >= least:
            cut = [x[at : at + most].tobytes() for x in (v, *numbers)]
            values = [pa.array([width], pa.int64()), *(pa.array([x], pa.binary()) for x in cut)]
            yield pa.RecordBatch.from_arrays(values, ["width", "v", "rep", "copies"])
            at += most
        held[width] = [[x[at:]] for x in (v, *numbers)]

    for batch in batches:
        column = batch.column(0).cast(pa.large_binary())
        places = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data, length = np.frombuffer(column.buffers()[2], np.uint8), np.diff(places)
        numbers = [np.array(batch.column(k)) for k in (1, 2)]
        for width in np.unique(length).tolist():
            at = np.flatnonzero(length == width)
            parts = held.setdefault(width, [[], [], []])
            for part, x in zip(parts, (data[places[at][:, None] + np.arange(width)], *(x[at] for x in numbers)), strict=True):
                part.append(x)
            most = max(1, min(chunk, _CHUNK_BYTES // width))
            if sum(len(x) for x in parts[1]) >= most:
                yield from made(width, most, most)
    for width in held:
        yield from made(width, max(1, min(chunk, _CHUNK_BYTES // width)), 1)


def near_components(embeddings: DataFrame, cosine: float = 0.95, chunk: int = 8192) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``embeddings`` (vec_id, embedding)."""
    spark = prepare(embeddings.sparkSession)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e"))
    single = getattr(rows.schema["e"].dataType, "elementType", None) == FloatType()
    rows = rows if single else rows.withColumn("e", F.col("e").cast("array<double>"))
    size = F.size("e")
    sound = F.col("e").isNotNull() & (size > 0) & F.forall("e", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    sound &= F.exists("e", lambda x: x != 0) & F.col("vec_id").isNotNull()
    packed = rows.select("vec_id", "e", F.coalesce(sound, F.lit(False)).alias("ok")).mapInArrow(packed_vectors, "vec_id long, v binary")
    # Later steps know a vector by two 64-bit hashes, so that its bytes travel once.
    name = {f"n{seed}": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(seed), "v")) for seed in (1, 2)}
    packed = written(packed.withColumns(name), "embeddings")
    units = packed.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    count = packed.count()
    few = max(1, ceil(count / chunk), min(partitions(spark), count // 1024))
    layout = "width long, v binary, rep binary, copies binary"
    path = scratch_path(spark, "embedding-chunks")
    chunks = units.coalesce(few).mapInArrow(lambda batches: chunks_of(batches, chunk), layout)
    chunks = chunks.select(F.monotonically_increasing_id().alias("id"), "*")
    chunks.write.option("maxRecordsPerFile", 8).parquet(path)
    chunks = spark.read.schema(chunks.schema).parquet(path)
    # Every task takes one partition of each side: enough of them for all cores, each of bounded size.
    sides = max(ceil(chunks.count() / _SIDE), ceil(4 * sqrt(spark.sparkContext.defaultParallelism)))
    left, right = (chunks.select(*[F.col(c).alias(f"{c}_{k}") for c in chunks.columns]).coalesce(sides) for k in "ab")
    # Two chunks meet once, in either order, so that no task is left without work.
    order = (F.col("id_a") < F.col("id_b")) == (F.pmod(F.hash(F.least("id_a", "id_b"), F.greatest("id_a", "id_b")), F.lit(2)) == 0)
    meet = (F.abs(F.col("width_a") - F.col("width_b")) < 1) & ((F.col("id_a") - F.col("id_b") == 0) | order)
    both = left.join(right.hint("shuffle_replicate_nl"), meet)
    kind = "<f4" if single else "<f8"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, place, kept = Links(), {}, {}

        def chunk_at(columns: list[pa.Array], row: int) -> tuple[int, Chunk]:
            known, width = columns[0][row].as_py(), columns[1][row].as_py()
            if known not in place:
                place[known] = links.admit(*(np.frombuffer(columns[k][row].as_buffer(), np.int64) for k in (3, 4)))
            if known not in kept:
                given = np.frombuffer(columns[2][row].as_buffer(), kind).reshape(-1, width // int(kind[2])).copy()
                while kept and sum(c.bytes for c in kept.values()) > _KEPT:
                    del kept[next(iter(kept))]
                kept[known] = Chunk.of(given, cosine)
            return place[known], kept[known]

        for batch in batches:
            columns = batch.columns
            for row in range(batch.num_rows):
                (i, a), (j, b) = chunk_at(columns[:5], row), chunk_at(columns[5:], row)
                for x, y in compare_chunks(a, b, cosine):
                    links.add(x + i, y + j)
        yield from links.rows()

    found = written(both.mapInArrow(compare, "a long, b long, links long"), "embedding-links")
    component = components(found.where("b IS NOT NULL").select("a", "b"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    names = [*name]
    known = packed.where("v IS NOT NULL").groupBy(*names).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    known = (
        known.join(component.withColumnRenamed("vertex", "rep"), "rep", "left")
        .join(links, "rep", "left")
        .select(*names, F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    return packed.select("vec_id", *names).join(known, names, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
