"""N-gram Jaccard join with a token-group matrix.

The set of a text is its distinct 5-word shingles (as 64-bit hashes). Texts of one set are one
unit. All shingles have one order: frequent ones (estimated on one text in ``one_in``) last, then by
hash; the order decides only how fast the join is. A unit's prefix holds the shingles beyond which
four fifths can no longer be reached: two linked units share a shingle of both prefixes.

Units with the same least hash and about the same size form a group of similar ones. The matrix holds each group's
union of prefixes; two groups whose unions share fewer shingles than any of their members would need
to link are never opened. Groups that open each other meet in one block, or, where their sets
are too large for one, pair by pair in blocks of about ``block`` units a side: a query whose shingles in the block's union are fewer than four fifths of its
own is skipped, all others are counted exactly. No pair of units becomes a row unless it links
and joins two parts of its block not yet linked.

Null or empty texts and texts without words have the empty set and link with nothing. A null id
takes no part: its component is null. Rows that share an id are one document there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import most_frequent, partitions, prepare, text_slices, written
from quern.llm.components import components
from quern.llm.words import hashed_shingles, hashed_words, mixed

#: At most so many frequent shingles are told to all tasks (8 bytes each).
FREQUENT = 100_000


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    for a, b in text_slices(column):
        hashes, first = hashed_shingles(hashed_words(column.slice(a, b - a)), size)
        for i in range(b - a):
            yield np.unique(hashes[first[i] : first[i + 1]])


def _unit(own: np.ndarray) -> int | None:
    """A name of the set; None for the empty set."""
    weights = np.arange(1, 2 * len(own), 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int((own * weights).sum().view(np.int64)) if len(own) else None


def _prefix(own: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles in the common order: all but four fifths, and one."""
    if len(own) and len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        late = frequent[at] == own
        own = np.concatenate([own[~late], own[late]])
    return own[: len(own) - (4 * len(own) + 4) // 5 + (len(own) > 0)].view(np.int64)


def _group(own: np.ndarray, frequent: np.ndarray) -> int | None:
    """A name shared by similar sets of about the same size.

    A set of mostly frequent shingles is one of many copies: its least frequent-shingle hash
    names it. Any other is named by its least hash among the rest, which no common passage shares.
    """
    if not len(own):
        return None
    late = np.zeros(len(own), bool)
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
    chosen = own[late] if 2 * late.sum() >= len(own) else own[~late]
    size = int(np.log(len(own)) / np.log(1.1))
    return int(mixed(chosen[:1] + np.uint64(size * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64)[0])


def _frequent(rows: DataFrame, size: int, one_in: int) -> np.ndarray:
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(0), size))
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["word"])

    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0).select("text")
    count = sample.mapInArrow(spread, "word long").groupBy("word").agg(F.count("*").alias("n")).where("n > 2")
    return most_frequent(written(count, "jaccard-frequent"), FREQUENT)[0].view(np.uint64)


def _pairs_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, grp) ascending, a token never across partitions: the pairs of groups of each token."""
    held = np.zeros((2, 0), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        rows = np.concatenate([held, rows], 1)
        done = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0
        held = rows[:, done:]
        yield from _matrix_rows(rows[:, :done])
    yield from _matrix_rows(held)


def _matrix_rows(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    if rows.shape[1] < 2:
        return
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
    token, group = rows[:, new]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    count = np.diff(np.append(first, len(token)))
    two = first[count == 2]
    left, right = [group[two]], [group[two + 1]]
    size = len(two)
    for a, n in zip(first[count > 2].tolist(), count[count > 2].tolist(), strict=True):
        for i in range(n - 1):
            left.append(np.full(n - 1 - i, group[a + i]))
            right.append(group[a + i + 1 : a + n])
            size += n - 1 - i
            if size > 200_000:
                yield _grouped(left, right)
                left, right, size = [], [], 0
    if size:
        yield _grouped(left, right)


def _grouped(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(left), np.concatenate(right)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    count = np.diff(np.append(first, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(count)], ["g", "h", "shared"])


class Forest:
    """Links within one block that join two parts not yet linked."""

    def __init__(self, size: int):
        self.above = list(range(size))

    def _root(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self._root(i), self._root(j)
        self.above[i] = j
        return i != j


def compare_block(units: list[int], sides: list[int], sets: list[np.ndarray]):
    """Counts of links per unit and (unit, unit) edges of a forest of them.

    Side 2 is a block compared with itself; otherwise each unit of side 1 asks the block of side 0.
    """
    inner = [i for i, s in enumerate(sides) if s != 1]
    asking = [i for i, s in enumerate(sides) if s != 0]
    links, edges = [0] * len(units), []
    if not inner or not asking:
        return links, edges
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate([sets[i] for i in inner])
    owner = np.repeat(np.arange(len(inner), dtype=np.int32), sizes[inner])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    union, first = np.unique(tokens, return_index=True)
    count = np.diff(np.append(first, len(tokens)))
    forest, of_inner = Forest(len(units)), sizes[inner]
    for place, i in enumerate(asking):
        own = sets[i]
        at = np.minimum(np.searchsorted(union, own), len(union) - 1)
        at = at[union[at] == own]
        if 5 * len(at) < 4 * len(own):  # the union bounds what any member can share
            continue
        n = count[at]
        total = np.cumsum(n)
        reached = owner[np.repeat(first[at] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        shared = np.bincount(reached, minlength=len(inner))
        linked = np.flatnonzero(100 * shared >= 80 * (len(own) + of_inner - shared))
        for k in linked.tolist():
            j = inner[k]
            if sides[i] == 2 and k >= place:
                continue
            links[i] += 1
            links[j] += 1
            if forest.join(i, j):
                edges.append((units[i], units[j]))
    return links, edges


def jaccard_components(
    documents: DataFrame, size: int = 5, one_in: int = 16, block: int = 512, table: int = 8_000_000
) -> DataFrame:
    """doc_id, n_shingles, component_id, linked_sets (other sets linked directly) and copies (other
    documents of the same set) of every row.

    ``table`` bounds the shingles a task holds at once, ``block`` the units of a side of a pair of groups.
    component_id is the smallest doc_id reachable by links of similarity 0.8 or more, itself included.
    """
    spark = prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(_frequent(rows, size, one_in))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        for batch in batches:
            found = [(len(own), _unit(own), _group(own, late)) for own in _sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([f[k] for f in found], pa.int64()) for k in range(3))],
                ["doc_id", "n_shingles", "unit", "g"],
            )

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, seen = frequent.value, set()
        for batch in batches:
            tokens, groups = [], []
            for own in _sets(batch.column(0), size):
                unit = _unit(own)
                if unit is None or unit in seen:  # copies within the task
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(unit)
                tokens.append(_prefix(own, late))
                groups.append(np.full(len(tokens[-1]), _group(own, late)))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, groups)], ["token", "g"])

    described = written(rows.mapInArrow(describe, "doc_id long, n_shingles long, unit long, g long"), "jaccard-sets")
    slim = (
        described.where("unit IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("unit")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("n_shingles").alias("n"), F.min("g").alias("g"))
    )
    slim = written(slim, "jaccard-units")
    groups = written(
        slim.groupBy("g").agg(F.count("*").alias("members"), F.min("n").alias("low"), F.max("n").alias("high"), F.sum("n").alias("weight")),
        "jaccard-groups",
    )
    matrix = (
        rows.where("doc_id IS NOT NULL")
        .select("text")
        .mapInArrow(prefixes, "token long, g long")
        .repartition(partitions(spark), "token")
        .sortWithinPartitions("token", "g")
    )
    meeting = matrix.mapInArrow(_pairs_of_groups, "g long, h long, shared long").groupBy("g", "h").agg(F.sum("shared").alias("shared"))
    # Fewest shared prefix shingles with which members of q and s shingles can link, over all
    # sizes the groups hold: 4/9 (q + s) less what lies beyond the longer prefix.
    def least(big: str, small: str):
        q = F.least(F.col(f"{big}.high"), F.floor(F.col(f"{small}.high") * 1.25))
        s = F.greatest(F.col(f"{small}.low").cast("double"), q * 0.8)
        return s * (4 / 9) - q * (0.8 - 4 / 9)

    one = groups.alias("a")
    other = groups.alias("b")
    opened = (
        meeting.alias("m")
        .join(one, F.col("m.g") == F.col("a.g"))
        .join(other, F.col("m.h") == F.col("b.g"))
        .where((F.col("a.low") * 4 <= F.col("b.high") * 5) & (F.col("b.low") * 4 <= F.col("a.high") * 5))
        .where(F.col("m.shared") >= F.least(least("a", "b"), least("b", "a")) - 1e-6)
        .select(F.col("m.g").alias("g"), F.col("m.h").alias("h"), F.col("a.members").alias("of_g"), F.col("b.members").alias("of_h"))
    )
    opened = written(opened, "jaccard-opened")
    # Groups that open each other, directly or not, form a circle. A circle of up to ``table``
    # shingles is one block; a larger one falls apart into stars, each group with
    # its most connected neighbour, and what is opened across stars is compared pair by pair.
    circle = components(opened.select(F.col("g").alias("a"), F.col("h").alias("b"))).withColumnRenamed("vertex", "g")
    circled = groups.join(circle, "g", "left").withColumn("circle", F.coalesce("component", "g")).drop("component")
    whole = circled.groupBy("circle").agg(F.sum("members").alias("all_members"), F.sum("weight").alias("all_weight"))
    circled = circled.join(whole.where("all_members > 1"), "circle")
    circled = written(circled.withColumn("whole", F.col("all_weight") <= table).drop("all_members", "all_weight"), "jaccard-circles")
    apart = circled.where("NOT whole").drop("circle", "whole")
    edges = opened.join(apart.select("g"), "g").select("g", "h")
    edges = edges.union(edges.select("h", "g")).union(apart.select("g", "g"))
    degree = edges.groupBy("g").agg(F.count("*").alias("degree"))
    star = edges.join(degree.select(F.col("g").alias("h"), "degree"), "h")
    star = star.groupBy("g").agg(F.max(F.struct("degree", "h")).alias("m")).select("g", F.col("m.h").alias("star"))
    apart = written(apart.join(star, "g"), "jaccard-stars")
    light = apart.groupBy("star").agg(F.sum("weight").alias("w")).select("star", (F.col("w") <= table).alias("light"))
    apart = apart.join(light, "star")
    # A star of more shingles than a block holds is compared pair by pair as well.
    apart = apart.withColumn("star", F.when(F.col("light"), F.col("star"))).drop("light")
    own = apart.where("star IS NULL AND members > 1").select(
        "g", F.col("g").alias("h"), F.col("members").alias("of_g"), F.col("members").alias("of_h")
    )
    across = opened.join(apart.select("g", F.col("star").alias("s")), "g").join(
        apart.select(F.col("g").alias("h"), F.col("star").alias("t")), "h"
    )
    across = across.where("NOT coalesce(s = t, false)").select("g", "h", "of_g", "of_h")

    def blocks(members):
        return F.ceil(members / block)

    def places(members):
        return F.explode(F.sequence(F.lit(0), blocks(F.col(members)).cast("int") - 1))

    large = across.unionByName(own)
    large = large.select("g", "h", places("of_g").alias("i"), "of_h").select("g", "h", "i", places("of_h").alias("j"))
    large = written(large.where("g <> h OR i <= j"), "jaccard-blocks")
    placed = slim.join(apart.select("g", "members"), "g").select(
        "unit", "rep", "g", F.pmod(F.hash("unit"), blocks(F.col("members")).cast("int")).alias("i")
    )
    alike = F.expr("g = h AND i = j")
    asked = large.join(placed, ["g", "i"]).select("g", "h", "i", "j", "unit", "rep", F.when(alike, 2).otherwise(0).alias("side"))
    asking = (
        large.where(~alike)
        .join(placed.select(F.col("g").alias("h"), F.col("i").alias("j"), "unit", "rep"), ["h", "j"])
        .select("g", "h", "i", "j", "unit", "rep", F.lit(1).alias("side"))
    )
    round_table = circled.where("whole").select("g", "circle", F.lit(-1).alias("kind")).union(
        apart.where("star IS NOT NULL").select("g", "star", F.lit(-2))
    )
    round_table = slim.join(round_table, "g").select(
        F.col("circle").alias("g"), F.col("circle").alias("h"), F.col("kind").alias("i"), F.col("kind").alias("j"), "unit", "rep", F.lit(2).alias("side")
    )
    seats = asked.unionByName(asking).unionByName(round_table)
    seats = seats.groupBy("unit", F.col("rep").alias("doc_id")).agg(F.collect_list(F.struct("g", "h", "i", "j", "side")).alias("seats"))
    seats = written(seats, "jaccard-seats")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(2), size))
            # Rows of one id may differ: only a text of this very unit counts.
            same = [_unit(own) == unit for own, unit in zip(sets, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select([0, 3]).filter(pa.array(same)).columns,
                    pa.array([own.tobytes() for own, ok in zip(sets, same, strict=True) if ok], pa.binary()),
                ],
                ["rep", "seats", "tokens"],
            )

    task = ["g", "h", "i", "j"]
    dealt = (
        # Texts are always dealt by id: a plan that broadcasts small tables would say nothing of large ones.
        rows.join(seats.hint("merge"), "doc_id")
        .select("doc_id", "unit", "text", "seats")
        .mapInArrow(spell, "rep long, seats array<struct<g:bigint,h:bigint,i:int,j:int,side:int>>, tokens binary")
        .select("rep", "tokens", F.explode("seats").alias("s"))
        .select(*[f"s.{k}" for k in task], "s.side", "rep", "tokens")
        .repartition(partitions(spark), *task)
        .sortWithinPartitions(*task, "side", "rep")
    )
    found = written(dealt.mapInArrow(_compare, "a long, b long, links long"), "jaccard-links")
    links = found.where("b IS NULL")
    edges = found.where("b IS NOT NULL").select("a", "b")
    component = components(edges)
    # A unit's links count the copies of the units it is linked with.
    totals = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("linked_units"))
    known = (
        slim.select("unit", "rep", "copies")
        .join(component.withColumnRenamed("vertex", "rep"), "rep", "left")
        .join(totals, "rep", "left")
        .select("unit", F.coalesce("component", "rep").alias("component"), F.coalesce("linked_units", F.lit(0)).alias("linked_units"), "copies")
    )
    return (
        described.join(known, "unit", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("linked_units", F.lit(0))).alias("linked_sets"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("copies", F.lit(1)) - 1).alias("copies"),
        )
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, h, i, j, side, rep, tokens), a task's rows together: links and a forest of edges."""
    key, units, sides, sets = None, [], [], []

    def finished() -> pa.RecordBatch:
        links, edges = compare_block(units, sides, sets)
        counted = [(u, None, n) for u, n in zip(units, links, strict=True) if n]
        rows = counted + [(a, b, None) for a, b in edges]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["a", "b", "links"])

    for batch in batches:
        names = zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
        for now, side, rep, blob in zip(names, *(batch.column(k).to_pylist() for k in (4, 5, 6)), strict=True):
            if now != key:
                if key is not None:
                    yield finished()
                key, units, sides, sets = now, [], [], []
            if units and units[-1] == rep and sides[-1] == side:  # a repeated row
                continue
            units.append(rep)
            sides.append(side)
            sets.append(np.frombuffer(blob, np.uint64))
    if key is not None:
        yield finished()
