"""Prefix trie of conversations by splitter-skeleton.

A conversation is a path of turn hashes (128 bits of role and text). Paths are dealt to shards by
sampled splitter paths and sorted. A node lies inside one shard unless its path is a prefix of a
splitter, so the prefixes of the splitters, broadcast with them, are the skeleton: each shard
finishes all its other nodes in one pass with a stack, and of skeleton nodes it hands on partial
counts, which are added by node and then summed along the skeleton alone. Splitters end in the
conversation's id, so copies of one conversation spread over shards like other paths.

Paths are cut into bands of ``band`` turns, so no row grows with a conversation. The last node
of a band is the root of a band below it, named by a hash of all turns before. What lies below
it is summed first and added to its smallest conversation's row in each band above.

Turns are ordered by turn (null first), then role, then text; null role or text is empty. Equal
rows are separate turns. Rows without conv_id belong to no conversation; other columns are not read.
An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import partitions, prepare, written

#: Bytes of a path's head (band, hash of the turns before it) and of a turn behind it.
_HEAD, _TURN = 20, 17
_ENDS, _GOES_ON = 0, 2
_SIGN = -(2**63)
#: Bytes of joined ids that a shard hands on at once for a skeleton node.
_PIECE = 64 << 10
_NODE, _PART, _ENDING, _TOP = range(4)
_SCANNED = (
    "kind int, shard int, seq long, depth long, conv_id long, n long, children long, leaves long, saved long, "
    "words long, ends string, key binary, next binary"
)
_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _base(conv: Column) -> Column:
    return conv - conv % 20


def _heads(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 4


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, d from 1, hash, words, _part) in order, and rows (conv_id, _part, n, total).

    Ranges of (conversation, turn, ...) are sorted, so one conversation may span many tasks.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("_copy"),
    )
    ordered = ("conv_id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.substring("text", 1, 64))
    dealt = turns.repartitionByRange(partitions(conversations.sparkSession), *ordered, "_copy")
    laid = dealt.sortWithinPartitions(*ordered, "role", "text", "_copy").select(
        "conv_id", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"),
        F.md5(F.concat(F.octet_length("role"), F.lit(":"), "role", "text").cast("binary")).alias("hash"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    turns = written(laid, "trie-turns")
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = turns.groupBy("conv_id", "_part").agg(F.count("*").alias("n")).select(
        "*", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("total"),
    )
    parts = written(parts, "trie-parts")
    inside = F.row_number().over(Window.partitionBy("conv_id", "_part").orderBy("_at"))
    return turns.withColumn("_in", inside).join(parts.select("conv_id", "_part", "_before"), ["conv_id", "_part"]).select(
        "conv_id", "_part", (F.col("_in") + F.col("_before")).alias("d"), "hash", "words"
    ), parts


def rebuilt(turns: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, d, hash, words) of the rebuilt conversations, and (conv_id, total) of all.

    The first h = crc32(id) % 4 turns come from the conversation of the next lower multiple of 20.
    """
    h = _heads(F.col("conv_id"))
    bases = parts.where("conv_id % 20 = 0").groupBy("conv_id").agg(F.least(F.first("total"), F.lit(3)).alias("_has"))
    parts = parts.withColumn("_base", _base(F.col("conv_id"))).join(
        bases.withColumnRenamed("conv_id", "_base"), "_base", "left"
    )
    taken = F.least(h, F.coalesce("_has", F.lit(0)))
    parts = parts.select("conv_id", "_part", "_base", "total", h.alias("_h"), taken.alias("_taken"))
    own = turns.join(parts, ["conv_id", "_part"]).where("d > _h")
    own = own.select("conv_id", (F.col("d") - F.col("_h") + F.col("_taken")).alias("d"), "hash", "words")
    convs = parts.groupBy("conv_id").agg(*[F.first(c).alias(c) for c in ("_base", "_h", "_taken", "total")])
    first = turns.where("conv_id % 20 = 0 AND d <= 3").select(F.col("conv_id").alias("_base"), "d", "hash", "words")
    lent = first.join(convs.select("conv_id", "_base", "_h"), "_base").where("d <= _h").select("conv_id", "d", "hash", "words")
    total = F.greatest(F.col("total") - F.col("_h"), F.lit(0)) + F.col("_taken")
    return own.unionByName(lent), convs.select("conv_id", total.alias("total"))


def bands(turns: DataFrame, convs: DataFrame, band: int) -> tuple[DataFrame, bool]:
    """One row per conversation and band: key, words of its turns and the band below (null at the end).

    Also whether any conversation is longer than one band.
    """
    spark = turns.sparkSession
    cut = F.floor((F.col("d") - 1) / band).cast("int")
    lists = turns.groupBy("conv_id", cut.alias("band")).agg(F.array_sort(F.collect_list(F.struct("d", "hash", "words"))).alias("t"))
    bare = convs.where("total = 0").select("conv_id", F.lit(0).alias("band"), F.lit(None).cast(lists.schema["t"].dataType).alias("t"))
    path = F.array_join(F.transform("t.hash", lambda x: F.concat(F.lit("01"), x)), "")
    rows = lists.unionByName(bare).select(
        "conv_id", "band", F.coalesce(path, F.lit("")).alias("path"), F.coalesce("t.words", F.array().cast("array<long>")).alias("words")
    )
    rows = written(rows, "trie-bands")
    deep = not rows.where("band > 0").isEmpty()
    head, below = F.lpad(F.lit(""), 2 * _HEAD, "0"), F.lit(None).cast("string")
    if deep:
        hashes = [F.xxhash64(F.lit(seed), "band", "path") for seed in (1, 2)]
        light = rows.select("conv_id", "band", *[x.alias(f"_{i}") for i, x in enumerate(hashes)])
        before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
        name = [F.coalesce(F.bit_xor(f"_{i}").over(before), F.lit(0).cast("long")) for i in (0, 1)]
        named = light.select("conv_id", "band", F.concat(F.lpad(F.hex("band"), 8, "0"), *[F.lpad(F.hex(x), 16, "0") for x in name]).alias("head"))
        named = named.withColumn("next", F.lead("head").over(Window.partitionBy("conv_id").orderBy("band")))
        rows, head, below = rows.join(named, ["conv_id", "band"]), F.col("head"), F.col("next")
    end = F.when(below.isNull(), f"{_ENDS:02x}").otherwise(f"{_GOES_ON:02x}")
    own = F.lpad(F.hex(F.col("conv_id").bitwiseXOR(F.lit(_SIGN))), 16, "0")
    keyed = rows.select(
        "conv_id", "band", F.unhex(F.concat(head, "path", end, own)).alias("key"), "words", F.unhex(below).alias("next")
    )
    return written(keyed, "trie-paths"), deep


def splitters(rows: DataFrame, shards: int, each: int = 16) -> list[bytes]:
    """At most ``shards`` - 1 ascending keys, from about ``each`` sampled rows a shard, each cut
    behind the byte that tells it from the sampled key before. They steer the load alone."""
    share = min(1.0, each * shards / max(1, rows.count()))
    picked = F.xxhash64(F.lit(7), "key") <= F.lit(min(int(_SIGN + share * 2**64), -_SIGN - 1))
    keys = sorted({bytes(r[0]) for r in rows.where(picked).select("key").collect()})
    found = []
    for at in sorted({i * len(keys) // shards for i in range(1, shards)} - {0}):
        before, key = keys[at - 1], keys[at]
        found.append(key[: next((i for i, (x, y) in enumerate(zip(before, key, strict=False)) if x != y), len(before)) + 1])
    return sorted(set(found))


class _Open:
    """A node on the stack."""

    __slots__ = ("children", "conv", "ends", "first", "leaves", "n", "next", "saved", "seq", "size", "split", "words")

    def __init__(self, seq: int, words: int, split: bool):
        self.seq, self.words, self.split = seq, words, split
        self.conv, self.n, self.children, self.leaves, self.saved = 2**63 - 1, 0, 0, 0, 0
        self.ends = self.next = self.first = None
        self.size = 0


def _shared_turns(a: bytes, b: bytes, most: int) -> int:
    """Turns that two keys begin with; -1 when their heads differ."""
    if a[:_HEAD] != b[:_HEAD]:
        return -1
    low = 0
    while low < most:
        middle = (low + most + 1) // 2
        end = _HEAD + _TURN * middle
        if a[_HEAD + _TURN * low : end] == b[_HEAD + _TURN * low : end]:
            low = middle
        else:
            most = middle - 1
    return low


def _scan_shard(rows: Iterator[tuple], low: bytes | None, high: bytes | None, band: int) -> Iterator[tuple]:
    """The nodes of one shard's sorted rows (shard, key, words, next, leaves and saved of bands below)."""
    stack: list[_Open] = []
    last, seq, shard = b"", 0, 0

    def spans(prefix: bytes) -> bool:
        return (low is not None and low.startswith(prefix)) or (high is not None and high.startswith(prefix))

    def piece(node: _Open, prefix: bytes) -> tuple:
        made = (_ENDING, shard, 0, 0, node.first, 0, 0, 0, 0, 0, ",".join(node.ends), prefix, None)
        node.ends, node.size = [], 0
        return made

    def close(down: int) -> Iterator[tuple]:
        while len(stack) > down:
            node, k = stack.pop(), len(stack)
            above = stack[-1] if stack else None
            prefix = last[: _HEAD + _TURN * k]
            depth = int.from_bytes(last[:4], "big") * band + k
            if above is not None:
                above.n += node.n
                above.conv = min(above.conv, node.conv)
            if node.split:
                if node.ends:
                    yield piece(node, prefix)
                yield (_PART, shard, node.seq, depth, node.conv, node.n, node.children, node.leaves, node.saved, node.words, None, prefix, node.next)
                continue
            if not node.children and node.next is None:
                node.leaves += 1
            node.saved += (node.n - 1) * node.words
            if above is not None:
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
            kind = _TOP if k == 0 and depth else _NODE
            ends = (node.ends or hashlib.sha256()).hexdigest()
            yield (kind, shard, node.seq, depth, node.conv, node.n, node.children, node.leaves, node.saved, node.words, ends, prefix if kind == _TOP else None, node.next)

    for shard, key, words, below, leaves, saved in rows:
        turns = (len(key) - _HEAD - 9) // _TURN
        shared = _shared_turns(last, key, min(turns, len(stack) - 1)) if stack else -1
        yield from close(shared + 1)
        last = key
        for k in range(shared + 1, turns + 1):
            stack.append(_Open(seq, words[k - 1] if k else 0, spans(key[: _HEAD + _TURN * k])))
            seq += 1
        node = stack[-1]
        conv = int.from_bytes(key[-8:], "big") + _SIGN
        node.n += 1
        node.conv = min(node.conv, conv)
        node.leaves += leaves
        node.saved += saved
        if below is not None:
            node.next = below
        elif node.split:
            if not node.ends:
                node.ends, node.first = [], conv
            node.ends.append(str(conv))
            node.size += len(node.ends[-1]) + 1
            if node.size >= _PIECE:
                yield piece(node, key[: _HEAD + _TURN * turns])
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv).encode())
        else:
            node.ends.update(f",{conv}".encode())
    yield from close(0)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def scan(rows: DataFrame, cuts: list[bytes], band: int) -> DataFrame:
    """Finished nodes, parts of skeleton nodes and pieces of their ends, as one written table."""
    spark = rows.sparkSession
    # The splitters are bounded by the number of shards.
    shared = spark.sparkContext.broadcast(cuts)
    schema = _arrow(_SCANNED)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            shard = [bisect_right(known, key) for key in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, source = shared.value, _tuples(batches)
        first = next(source, None)
        if first is None:
            return
        low, high = (known[first[0] - 1] if first[0] else None), (known[first[0]] if first[0] < len(known) else None)

        def all_rows() -> Iterator[tuple]:
            yield first
            yield from source

        yield from _batched(_scan_shard(all_rows(), low, high, band), schema)

    fields = "key binary, words array<long>, next binary, leaves long, saved long"
    routed = rows.select("key", "words", "next", "leaves", "saved").mapInArrow(route, "shard int, " + fields)
    dealt = routed.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("key")
    return written(dealt.mapInArrow(walk, _SCANNED), "trie-scanned")


def skeleton(scanned: DataFrame) -> DataFrame:
    """One row per skeleton node with its whole counts.

    Parts are added by node in Spark. Sums along the skeleton then take one small task: its nodes
    are prefixes of the splitters, at most one band of nodes for each.
    """
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    added = scanned.where(F.col("kind") == _PART).groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums, F.first("words").alias("words"),
        F.max("next").alias("next"), F.min(F.struct("shard", "seq")).alias("_place"),
    )
    ddl = "key binary, depth long, conv_id long, n long, children long, leaves long, saved long, next binary, shard int, seq long"
    schema = _arrow(ddl)

    def rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            # Keys descend, so every child comes before its parent and leaves its sums there.
            given: dict[bytes, list[int]] = {}
            for key, depth, conv, n, children, leaves, saved, words, below, shard, seq in _tuples(batches):
                more = given.pop(key, (0, 0, 0))
                children, leaves, saved = children + more[0], leaves + more[1], saved + more[2]
                leaves += not children and below is None
                saved += (n - 1) * words
                if len(key) > _HEAD:
                    sums = given.setdefault(key[:-_TURN], [0, 0, 0])
                    sums[0] += 1
                    sums[1] += leaves
                    sums[2] += saved
                yield key, depth, conv, n, children, leaves, saved, below, shard, seq

        yield from _batched(rows(), schema)

    order = ["key", "depth", "conv_id", "n", "children", "leaves", "saved", "words", "next", "_place.shard", "_place.seq"]
    ordered = added.select(*order).coalesce(1).sortWithinPartitions(F.desc("key"))
    return written(ordered.mapInArrow(rise, ddl), "trie-skeleton")


def _skeleton_ends(scanned: DataFrame) -> DataFrame:
    """(key, ends) of skeleton nodes at which conversations end: pieces hashed in order, as a stream."""
    schema = _arrow("key binary, ends string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at, state = None, None
            for key, text in _tuples(batches):
                if key != at:
                    if state is not None:
                        yield at, state.hexdigest()
                    at, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
            if state is not None:
                yield at, state.hexdigest()

        yield from _batched(rows(), schema)

    pieces = scanned.where(F.col("kind") == _ENDING).select("key", "ends", "conv_id")
    ordered = pieces.repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.select("key", "ends").mapInArrow(join, "key binary, ends string")


def _carried(rows: DataFrame, cuts: list[bytes], band: int) -> DataFrame:
    """Rows with the leaves and saved tokens that lie in bands below and are theirs to hand up."""
    deep = rows.where("band > 0")
    scanned = scan(deep.withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")}), cuts, band)
    columns = ["conv_id", (F.col("depth") / band).cast("int").alias("band"), "leaves", "saved"]
    tops = scanned.where(F.col("kind") == _TOP).select(*columns).unionByName(
        skeleton(scanned).where(F.length("key") == _HEAD).select(*columns)
    )
    # The smallest conversation of a band's root hands its sums to all its own bands above.
    upward = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    spread = rows.select("conv_id", "band").join(tops, ["conv_id", "band"], "left").select(
        "conv_id", "band", *[F.coalesce(F.sum(c).over(upward), F.lit(0)).alias(c) for c in ("leaves", "saved")]
    )
    return rows.join(spread, ["conv_id", "band"])


def _with_parents(rows: DataFrame, shards: int) -> DataFrame:
    """Adds each node's parent from the order in which its shard opened them; rows without ``shown`` are parents alone."""
    schema = _arrow(_NODES)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            path: dict[int, int] = {}
            for depth, conv, n, children, leaves, saved, ends, shown in _tuples(batches):
                path[depth] = conv
                if shown:
                    yield conv, depth, path[depth - 1] if depth else None, n, children, leaves, saved, ends

        yield from _batched(nodes(), schema)

    dealt = rows.repartitionById(shards, "shard").sortWithinPartitions("seq")
    return dealt.select("depth", "conv_id", "n", "children", "leaves", "saved", "ends", "shown").mapInArrow(walk, _NODES)


def prefix_trie(conversations: DataFrame, band: int = 512, shards: int | None = None) -> DataFrame:
    """Every node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256 (of the ids that end there, ascending).
    """
    spark = prepare(conversations.sparkSession)
    rows, deep = bands(*rebuilt(*numbered_turns(conversations)), band)
    cuts = splitters(rows, shards or partitions(spark))
    if deep:
        rows = _carried(rows, cuts, band)
    else:
        rows = rows.withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")})
    scanned = scan(rows, cuts, band)
    whole = skeleton(scanned)
    columns = ["shard", "seq", "depth", "conv_id", "n", "children", "leaves", "saved", "ends", "shown"]
    finished = scanned.where(F.col("kind") == _NODE).withColumn("shown", F.lit(True))
    ends = F.coalesce("ends", F.lit(hashlib.sha256().hexdigest()))
    # The skeleton is small: at most one band of nodes for each splitter.
    known = whole.join(_skeleton_ends(scanned), "key", "left").withColumns({"ends": ends, "_shard": F.col("shard"), "_seq": F.col("seq")})
    places = scanned.where(F.col("kind") == _PART).select("key", "shard", "seq")
    here = (F.col("shard") == F.col("_shard")) & (F.col("seq") == F.col("_seq"))
    split = places.join(known.drop("shard", "seq"), "key").withColumn("shown", here)
    if deep:
        bottoms = reduce(DataFrame.unionByName, (x.where("next IS NOT NULL").select(F.col("next").alias("key"), F.col("conv_id").alias("_conv")) for x in (finished, whole)))
        tops = scanned.where(F.col("kind") == _TOP).withColumn("shown", F.lit(False))
        roots = reduce(DataFrame.unionByName, (x.select(F.col("key").alias("next"), F.col("children").alias("_more")) for x in (tops, whole.where(F.length("key") == _HEAD))))
        counted = F.col("children") + F.coalesce("_more", F.lit(0))
        finished = finished.join(roots, "next", "left").withColumn("children", counted)
        split = split.join(roots, "next", "left").withColumn("children", counted)
        # A band's root stands for the node above it, which has members that end there.
        below = (F.length("key") == _HEAD) & (F.col("depth") > 0)
        split = split.join(bottoms, "key", "left").withColumns({"conv_id": F.coalesce("_conv", "conv_id"), "shown": F.col("shown") & ~below})
        finished = finished.select(*columns).unionByName(tops.join(bottoms, "key").withColumn("conv_id", F.col("_conv")).select(*columns))
    return _with_parents(finished.select(*columns).unionByName(split.select(*columns)), len(cuts) + 1)


#: The nodes in DuckDB's dialect. A node is named by the hash of its path; every subtree sum adds
#: what each node below hands, along its smallest conversation, to the nodes above it.
SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
           (4294967295 - list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
                LAMBDA c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
                                         LAMBDA v, y: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, t.d, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.d <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.d, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.d > c.h),
placed AS (
    SELECT conv_id, text, row_number() OVER w AS d,
           md5(string_agg(md5(strlen(role) || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING)) AS node
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, d)),
steps AS (
    SELECT conv_id, d, node, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM placed
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
lengths AS (SELECT conv_id, max(d) AS total FROM steps GROUP BY 1),
linked AS (
    SELECT s.*, l.total, lag(node) OVER (PARTITION BY s.conv_id ORDER BY d) AS parent FROM steps s JOIN lengths l USING (conv_id)),
nodes AS (
    SELECT node, min(d) AS depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = d), '')) AS ends_sha256
    FROM linked GROUP BY 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
known AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
sums AS (
    SELECT s.node, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves, sum((k.n_convs - 1) * k.words) AS saved_tokens
    FROM known k JOIN steps s ON s.conv_id = k.conv_id AND s.d <= k.depth GROUP BY 1)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM known k JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = k.parent AND k.depth > 0
"""
