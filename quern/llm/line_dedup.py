"""Line dedup: content-defined chunks of lines find repeats, which go from all but their first place.

A rolling hash runs over the hashes of two neighbouring lines. A chunk ends where it is least among
its neighbours, so the cut depends on the lines around it alone and resists shifts; two lines of
together ``long_line`` words are cut apart too. The two lines around a cut are the least chunk and
the seed of a match; a line of ``long_line`` words is a seed alone. A seed that occurs again is
compared byte by byte with its first place (least doc_id, null last; then table order; then
place) and grows line by line to both sides as long as both texts agree. What is removed is a run of
lines found whole at one earlier place: two lines and ``least_words`` words or more, or one line of
``long_line`` words. Where runs of different places overlap the longest goes and the rest stays
unless it is such a run itself.

Every repeated run of three lines or more holds a cut in all its places, whatever stands around it,
and so does one of two lines with ``long_line`` words; two shorter lines are found when the cut
between them is common to both places. Lines without words do not count as lines: they may differ
within a run, and go with it. Texts travel packed.

Texts without lines to remove stay as they are, null included. A text of which
everything was removed becomes empty. Repeated rows count as separate documents, so the
later ones lose their lines. The first place of every line stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.common import plain, prepare, text_slices, written
from quern.llm.words import mixed, raw, span_hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ROLL = np.uint64(0xD6E8FEB86659FD93)
#: Sets into which the documents that share their first place with one document are dealt.
_SETS = 32
#: A hash with more than this share of all seeds is sent to all tasks, so there are at most as many.
_HOT_SHARES = 20_000


def spoken_lines(data: np.ndarray, offsets: np.ndarray):
    """(text, start, end, words) of every line with words, by place; ends without the line end."""
    edge = np.zeros(len(data) + 1, bool)
    edge[1:] = data == 0x0A
    edge[offsets[:-1]] = True
    start = np.flatnonzero(edge[: len(data)])
    stop = np.append(start[1:], len(data))
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1 : len(data)]
    total = np.concatenate([[0], np.cumsum(begins)])
    words = total[stop] - total[start]
    kept = words > 0
    start, stop = start[kept], stop[kept]
    return np.searchsorted(offsets, start, side="right") - 1, start, stop - (data[stop - 1] == 0x0A), words[kept]


def seeds(column: pa.Array, long_line: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, line, hash) of the seeds; ``line`` counts the lines with words of the text."""
    data, offsets = raw(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, start, end, words = spoken_lines(data, offsets)
    line = np.arange(len(text)) - np.searchsorted(text, text)
    single = span_hashes(data, start, end)
    # One rolling step: the window holds two lines.
    rolled = mixed(single[:-1] * _ROLL + single[1:])
    within = text[1:] == text[:-1]
    most = np.uint64(2**64 - 1)
    left, right = np.full(len(rolled), most), np.full(len(rolled), most)
    left[1:] = np.where(within[:-1], rolled[:-1], most)
    right[:-1] = np.where(within[1:], rolled[1:], most)
    # Of every two neighbouring windows of a text the lesser is a cut; a lone window is one too.
    cut = (rolled < right) & (right < most) | (rolled <= left) & (left < most) | (left == most) & (right == most)
    pairs = np.flatnonzero(within & (cut | (words[1:] + words[:-1] >= long_line)))
    alone = np.flatnonzero(words >= long_line)
    at = np.concatenate([pairs, alone])
    hashes = np.concatenate([rolled[pairs], mixed(single[alone] ^ most)])
    order = np.argsort(at, kind="stable")
    return text[at][order], line[at][order], hashes[order]


def split_spoken(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()]


def matched_runs(lines: list[bytes], other: list[bytes], places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest runs of equal lines around each (line, line there), as (first, end)."""
    found: list[tuple[int, int]] = []
    reached: dict[int, int] = {}
    for line, there in sorted(places):
        shift = line - there
        if line < reached.get(shift, 0) or lines[line] != other[there]:
            continue
        first, end = line, line + 1
        while first > 0 and first > shift and lines[first - 1] == other[first - 1 - shift]:
            first -= 1
        while end < len(lines) and end - shift < len(other) and lines[end] == other[end - shift]:
            end += 1
        reached[shift] = end
        found.append((first, end))
    return found


def chosen_runs(runs: list[tuple[int, int]], words: list[int], least_words: int, long_line: int) -> list[tuple[int, int]]:
    """Runs that do not overlap, the longest first; what is left of another goes only if it is a run itself."""

    def counts(first: int, end: int) -> bool:
        held = sum(words[first:end])
        return held >= long_line if end - first == 1 else end - first > 1 and held >= least_words

    taken: list[tuple[int, int]] = []
    for first, end in sorted(set(runs), key=lambda r: (r[0] - r[1], r)):
        at = first
        for a, b in [*sorted(t for t in taken if t[0] < end and t[1] > first), (end, end)]:
            if at < a and counts(at, a):
                taken.append((at, a))
            at = max(at, b)
    return sorted(taken)


def without_lines(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without these runs of its lines with words, and their line ends."""
    spans, at = [], 0
    for line in text.split(b"\n"):
        if line.strip():
            spans.append((at, at + len(line)))
        at += len(line) + 1
    kept, at = [], 0
    for first, end in runs:
        kept.append(text[at : spans[first][0]])
        at = spans[end - 1][1]
        at += text[at : at + 1] == b"\n"
    kept.append(text[at:])
    left = b"".join(kept)
    return left[:-1] if at >= len(text) and left.endswith(b"\n") and not text.endswith(b"\n") else left


def _settled(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``written``, and the shuffle files of that write go at once: only the table is read again."""
    key, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", df.sparkSession.conf
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return written(df, label, compression)
    finally:
        conf.set(key, before)


def first_places(places: DataFrame) -> DataFrame:
    """(_row, line, first): every place of a repeated seed but its first, with the first."""
    place = F.struct(F.col("id").isNull().alias("none"), "id", "_row", "line")
    repeated = places.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    repeated = _settled(repeated.select("hash", "n", "first._row", "first.line").toDF("hash", "n", "_first", "_there"), "line-dedup-seeds")
    # Frequent seeds go to all tasks: they are few, as together they hold no more than all seeds.
    limit = (repeated.agg(F.sum("n")).first()[0] or 0) // _HOT_SHARES + 1024
    hot, rest = repeated.where(F.col("n") > limit).drop("n"), repeated.where(F.col("n") <= limit).drop("n")
    light = places.select("_row", "line", "hash")
    found = light.join(F.broadcast(hot), "hash").unionByName(light.join(rest, "hash"))
    return found.where("_row <> _first OR line <> _there")


def dedup_lines(documents: DataFrame, long_line: int = 50, least_words: int = 8) -> DataFrame:
    """All columns of ``documents``, text without repeated runs of lines, and n_removed (runs taken out).

    A whole-number n_chars column follows the text. A column called n_removed is replaced.
    """
    prepare(documents.sparkSession)
    rows, given = plain(documents, "n_removed")
    at, doc_id = given.index("text"), f"c{documents.columns.index('doc_id')}"
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("line", pa.int32())]))
    others = [f for i, f in enumerate(rows.schema.fields) if i != at]
    added = StructType.fromDDL("_row bigint, _packed binary, _seeds array<struct<hash: bigint, line: int>>")
    packed = StructType(others + added.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=6)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            column = batch.column(at).cast(pa.string())
            lists: list[list[dict]] = [[] for _ in range(len(batch))]
            for a, b in text_slices(column):
                for text, line, h in zip(*(x.tolist() for x in seeds(column.slice(a, b - a), long_line)), strict=True):
                    lists[a + text].append({"hash": h - (h >> 63 << 64), "line": line})
            blobs = [None if t is None else packer.compress(t.encode()) for t in column.to_pylist()]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            ids = pa.array(np.arange(row, row + len(batch)))
            row += len(batch)
            yield pa.RecordBatch.from_arrays([*kept, ids, pa.array(blobs, pa.binary()), pa.array(lists, kind)], packed.names)

    held = written(rows.mapInArrow(cut, packed), "line-dedup-texts", compression="uncompressed")
    places = held.select("_row", F.col(doc_id).cast("long").alias("id"), F.explode("_seeds").alias("s")).select("_row", "id", "s.*")
    # A pair of documents is compared once; a document that many repeat is dealt to sets.
    pairs = first_places(places).groupBy("_row", "_first").agg(F.collect_list(F.struct("line", "_there")).alias("_places"))
    pairs = _settled(pairs.withColumn("_set", F.pmod(F.xxhash64("_row"), F.lit(_SETS)).cast("int")), "line-dedup-pairs")
    firsts = held.select(F.col("_row").alias("_first"), F.col("_packed").alias("_other"))
    # Joins with texts are exchanges at every size, so that their cost grows with the input alone.
    asked = _settled(firsts.join(pairs.select("_first", "_set").distinct().hint("merge"), "_first"), "line-dedup-firsts", "uncompressed")
    matched = pairs.join(asked.hint("merge"), ["_first", "_set"]).hint("merge").join(held.select("_row", "_packed"), "_row")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for row, blob, other, where in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs = [(w["line"], w["_there"]) for w in where]
                lines = split_spoken(reader.decompress(blob))
                for first, end in matched_runs(lines, split_spoken(reader.decompress(other)), pairs):
                    for column, value in zip(out, (row, first, end), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["_row", "first", "end"])

    grown = matched.select("_row", "_packed", "_other", "_places").mapInArrow(grow, "_row long, first int, end int")
    gone = _settled(grown.groupBy("_row").agg(F.collect_set(F.struct("first", "end")).alias("_gone")), "line-dedup-gone")
    schema = StructType(list(rows.schema.fields)).add("n_removed", "integer")
    names = [f.name for f in others]
    length = f"c{documents.columns.index('n_chars')}" if "n_chars" in given else None
    if length and rows.schema[length].dataType.simpleString() not in ("bigint", "int"):
        length = None

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            texts, removed = [], []
            lists = batch.column(len(names) + 1).to_pylist()
            for blob, spans in zip(batch.column(len(names)).to_pylist(), lists, strict=True):
                text, runs = (None if blob is None else reader.decompress(blob)), []
                if spans:
                    words = [len(line.split()) for line in split_spoken(text)]
                    runs = chosen_runs([(s["first"], s["end"]) for s in spans], words, least_words, long_line)
                if runs:
                    text = without_lines(text, runs)
                texts.append(None if text is None else text.decode())
                removed.append(len(runs))
            columns = list(batch.columns[: len(names)])
            if length:
                k = names.index(length)
                old = columns[k].to_pylist()
                new = [len(t) if n else o for t, n, o in zip(texts, removed, old, strict=True)]
                columns[k] = pa.array(new, columns[k].type)
            columns.insert(at, pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32())], schema.names)

    return held.drop("_seeds").join(gone.hint("merge"), "_row", "left").select(*names, "_packed", "_gone").mapInArrow(apply, schema).toDF(*given, "n_removed")
