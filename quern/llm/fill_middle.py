"""Fill-in-middle: a text is cut into prefix, middle and suffix and written in another order.

Units are words with the white space before them; trailing white space is a unit of its own.
A learned rank index finds the cuts: line segments fitted to the places of all boundaries,
each within a fixed error, predict the place of a boundary from its rank, and a stored residual
of one byte a boundary makes it exact.

    plain   the text itself (nothing to cut, a mark in the text, or not drawn)
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

A null text is empty and so plain. A null id is drawn as an empty one. Equal rows get equal
results; equal texts with other ids are drawn anew. Draws depend on seed and doc_id alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.common import plain, prepare, text_slices
from quern.llm.words import raw

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_P, _S, _M = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Farthest a segment may pass from a boundary; with rounding, residuals fit a signed byte.
ERROR = 126


class RankIndex:
    """Ascending places by rank. Memory beside the segments: one byte a place."""

    def __init__(self, places: np.ndarray, error: int = ERROR):
        self.first, self.place, self.slope = _segments(places, error)
        self.residual = np.zeros(0, np.int8)
        self.residual = (places - self._predicted(np.arange(len(places)))).astype(np.int8)

    def _predicted(self, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, rank, side="right") - 1
        return self.place[at] + np.rint(self.slope[at] * (rank - self.first[at])).astype(np.int64)

    def places(self, rank: np.ndarray) -> np.ndarray:
        return self._predicted(rank) + self.residual[rank]


def _segments(places: np.ndarray, error: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rank, its place and the slope of segments, each as long as one slope serves it.

    A segment starts at a boundary; every further one narrows the slopes that pass within
    ``error`` of all, until none is left. Runs of doubling length are narrowed as arrays.
    """
    first, slopes = [], []
    start, count = 0, len(places)
    while start < count:
        low, high, at, run = -np.inf, np.inf, start + 1, 64
        while at < count:
            ranks = np.arange(at - start, min(at + run, count) - start)
            rise = places[at : at + run] - places[start]
            lows = np.maximum(np.maximum.accumulate((rise - error) / ranks), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / ranks), high)
            served = int(np.searchsorted(lows > highs, True))
            if served:
                low, high = lows[served - 1], highs[served - 1]
            at += served
            if served < len(ranks):
                break
            run *= 2
        first.append(start)
        slopes.append((low + high) / 2 if at > start + 1 else 0.0)
        start = at
    starts = np.array(first, np.int64)
    return starts, places[starts], np.array(slopes)


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in bytes) of all boundaries, each text's start included, and each text's number of units."""
    space = _SPACE[data]
    inner = np.flatnonzero(~space[:-1] & space[1:]) + 1
    inside = np.ones(len(data) + 1, bool)
    inside[offsets] = False
    inner = inner[inside[inner]]
    filled = np.diff(offsets) > 0
    units = np.diff(np.searchsorted(inner, offsets)) + filled
    return np.sort(np.concatenate([inner, offsets[:-1], offsets[1:][filled]]), kind="stable"), units


def _cut(column: pa.Array, draws: np.ndarray, rate: int, spm: int):
    """Units, form, code points of prefix and middle, and output of every text."""
    data, offsets = raw(column)
    places, units = boundaries(data, offsets)
    index = RankIndex(places)
    base = np.cumsum(units + 1) - (units + 1)
    ranks = np.sort(draws[:, :2] % (units + 1)[:, None], axis=1) + base[:, None]
    first, second = index.places(ranks[:, 0]), index.places(ranks[:, 1])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    before, between = points[first] - points[offsets[:-1]], points[second] - points[first]
    blob = data.tobytes()
    forms, outputs = [], []
    for start, a, b, end, chance, order in zip(
        *(x.tolist() for x in (offsets[:-1], first, second, offsets[1:], draws[:, 2], draws[:, 3])), strict=True
    ):
        text = blob[start:end]
        if not text or chance % 100 >= rate or _P in text or _S in text or _M in text:
            forms.append("plain")
            outputs.append(text)
        elif order % 100 < spm:
            forms.append("spm")
            outputs.append(b"".join((_S, blob[b:end], _P, blob[start:a], _M, blob[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((_P, blob[start:a], _S, blob[b:end], _M, blob[a:b])))
    return units, forms, before, between, outputs


def draws_of(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit draws from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def fill_middle(documents: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """All columns of ``documents``, then n (units), form, prefix_chars, middle_chars (code points) and output.

    ``rate`` of 100 texts are cut, ``spm`` of 100 of these start with the suffix. Columns
    called like a new one are replaced. An empty table gives an empty one.
    """
    prepare(documents.sparkSession)
    rows, given = plain(documents, "n", "form", "prefix_chars", "middle_chars", "output")
    at, doc_id = given.index("text"), F.col(f"c{documents.columns.index('doc_id')}")
    added = StructType.fromDDL("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    schema = StructType(rows.schema.fields + added.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.string())
            draws = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, 4)
            for a, b in text_slices(column):
                units, forms, before, between, outputs = _cut(column.slice(a, b - a), draws[a:b], rate, spm)
                whole = np.array([f == "plain" for f in forms], bool)
                made = [
                    pa.array(units, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64(), mask=whole),
                    pa.array(between, pa.int64(), mask=whole), pa.array(outputs, pa.binary()).cast(pa.string()),
                ]
                kept = batch.slice(a, b - a).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, *made], schema.names)

    return rows.withColumn("_draws", draws_of(doc_id, seed)).mapInArrow(cut, schema).toDF(*given, *added.names)


def restored(output: Column, form: Column) -> Column:
    """The exact text from output and form. Texts with marks are plain, so the first mark of each kind is the cut."""
    rest = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    front = F.split(rest, F.when(form == "psm", SUFFIX).otherwise(PREFIX), 2)
    back = F.split(front[1], MIDDLE, 2)
    cut = F.when(form == "psm", F.concat(front[0], back[1], back[0])).otherwise(F.concat(back[0], back[1], front[0]))
    return F.when(form == "plain", output).otherwise(cut)


def digest(made: DataFrame) -> DataFrame:
    """Per document: units, form, lengths, and hashes of the output and of the text rebuilt from it."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The digest in DuckDB's dialect.
SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents),
numbers AS (
    SELECT *, len(units) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
           CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4
    FROM drawn),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM numbers),
parts AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s
    FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
