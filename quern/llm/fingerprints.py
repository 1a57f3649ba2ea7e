"""Threshold-scaled document fingerprints.

A fingerprint keeps every distinct 5-word shingle hash below a fixed fraction of the hash range,
so its size follows the text and the fingerprint of a union is the union of fingerprints.
The share of one fingerprint found in another estimates containment however unequal both
texts are. It is written as the ascending hashes, 16 hexadecimal digits each.

A null text counts as empty. Texts too short to keep a hash have an empty fingerprint; two
of those are alike (1) when their words are the same and unlike (0) otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import partitions, prepare, range_cuts, range_of, text_slices
from quern.llm.words import hashed_shingles, hashed_words


class Fingerprints:
    """Kept hashes of many texts: text i owns ``hashes[first[i]:first[i + 1]]``, ascending."""

    def __init__(self, column: pa.Array, fraction: float, size: int):
        limit = np.uint64(min(int(fraction * 2.0**64), 2**64 - 1))
        kept, owner, whole = [], [], []
        for a, b in text_slices(column):
            words = hashed_words(column.slice(a, b - a))
            hashes, first = hashed_shingles(words, size)
            at = np.flatnonzero(hashes < limit)
            kept.append(hashes[at])
            owner.append(np.searchsorted(first, at, side="right") - 1 + a)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes)])
            whole.append(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))
        hashes = np.concatenate(kept or [np.zeros(0, np.uint64)])
        text = np.concatenate(owner or [np.zeros(0, np.int64)])
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        self.hashes, self.text = hashes[new], text[new]
        self.count = np.bincount(self.text, minlength=len(column)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        #: Tells apart texts that keep no hash.
        self.whole = np.concatenate(whole or [np.zeros(0, np.uint64)])

    def written(self) -> list[str]:
        digits = self.hashes.astype(">u8").tobytes().hex()
        return [digits[16 * a : 16 * b] for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)]

    def taken(self, rows: np.ndarray) -> Fingerprints:
        """The fingerprints of some texts, in the order asked for."""
        out = object.__new__(Fingerprints)
        out.count, out.whole = self.count[rows], self.whole[rows]
        out.first = np.concatenate([[0], np.cumsum(out.count)])
        at = np.repeat(self.first[rows] - out.first[:-1], out.count) + np.arange(out.first[-1])
        out.hashes, out.text = self.hashes[at], np.repeat(np.arange(len(rows)), out.count)
        return out

    def shared(self, other: Fingerprints) -> np.ndarray:
        hashes = np.concatenate([self.hashes, other.hashes])
        text = np.concatenate([self.text, other.text])
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        both = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        return np.bincount(text[1:][both], minlength=len(self.count))

    def likeness(self, other: Fingerprints) -> np.ndarray:
        """Estimated Jaccard similarity of text i here and text i there."""
        shared = self.shared(other)
        union = self.count + other.count - shared
        return np.where(union > 0, shared / np.maximum(union, 1), (self.whole == other.whole).astype(float))


def fingerprint(documents: DataFrame, fraction: float = 0.25, size: int = 5) -> DataFrame:
    """doc_id and hashes (array of long, unsigned order) of ``documents`` (doc_id, text)."""
    prepare(documents.sparkSession)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = Fingerprints(batch.column(1), fraction, size)
            lists = pa.ListArray.from_arrays(pa.array(made.first, pa.int32()), pa.array(made.hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "hashes"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, hashes array<long>")


def merged(fingerprints: DataFrame, *keys: str) -> DataFrame:
    """The fingerprint of all texts of a key: one row per key and hash, so that no key is too large."""
    return fingerprints.select(*keys, F.explode("hashes").alias("hash")).distinct()


def containment(inner: Column, outer: Column) -> Column:
    """Estimated share of ``inner``'s shingles that ``outer`` has; null without any hash."""
    return F.try_divide(F.size(F.array_intersect(inner, outer)), F.size(inner))


def compare_edited(documents: DataFrame, fraction: float = 0.25, size: int = 5) -> DataFrame:
    """Fingerprints of each text and of the text with its last third replaced.

    The replacement is as many first code points of the next document, by descending doc_id
    (null last, equal ids by descending text; the last one is followed by the first). Documents are dealt
    into id ranges; each range also gets the first row of the next one.
    """
    spark = prepare(documents.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    cuts = range_cuts(rows, "doc_id", 4 * partitions(spark))
    rows = rows.withColumn("part", range_of("doc_id", cuts))
    top = {r["part"]: r["top"] for r in rows.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    parts = sorted(top, reverse=True)
    follows = [(parts[i - 1], part, top[part]) for i, part in enumerate(parts)]  # the first follows the last
    heads = spark.createDataFrame(follows, "goes_to int, part int, top long")
    first = (
        rows.join(F.broadcast(heads), ["part"])  # one row per range
        .where(F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("goes_to", "doc_id")
        .agg(F.max("text").alias("text"))
        .select("doc_id", "text", F.col("goes_to").alias("part"), F.lit(True).alias("borrowed"))
    )
    dealt = (
        rows.withColumn("borrowed", F.lit(False))
        .unionByName(first)
        .repartition(partitions(spark), "part")
        .sortWithinPartitions("part", "borrowed", F.desc_nulls_last("doc_id"), F.desc("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            batch = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks().to_batches()[0]
            held = batch.slice(len(batch) - 1)
            if len(batch) < 2:
                continue
            own = np.flatnonzero(~np.array(batch.column(3).slice(0, len(batch) - 1)))
            texts = batch.column(1).to_pylist()
            edited = []
            for i in own.tolist():
                cut = len(texts[i]) // 3
                edited.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
            every = Fingerprints(batch.column(1), fraction, size)
            mine, following = every.taken(own), every.taken(own + 1)
            changed = Fingerprints(pa.array(edited, pa.string()), fraction, size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(own)),
                    pa.array([len(texts[i]) for i in own.tolist()], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    pa.array(mine.written(), pa.string()),
                    pa.array(changed.written(), pa.string()),
                    pa.array(mine.likeness(changed)),
                    pa.array(mine.likeness(following)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return dealt.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
