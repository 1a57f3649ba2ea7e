"""Binary token files: one zstandard frame per document, sharing a trained dictionary.

A set of files is a folder with ``dictionary`` and ``manifest`` (Parquet) and one shard per
range of documents:

    frames      one frame per document: its serialized ids, compressed with the dictionary
    index       four arrays of int64: document id, first id within the shard, place of the
                frame, number of ids; then one byte per document, 1 where its id is null
    footer      64 bytes: magic, documents, ids, place of the index, bytes per id, dictionary hash

One document is read from the footer, the index and its own frame. Documents ascend by id
(null first; equal ids by text), within and across shards. A null text is an empty one; every
document ends with ``end_id``, so none is without ids. An empty table gives an empty set.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import partitions, prepare
from quern.llm.word_tokens import word_tokens
from quern.sources.files import store_of

_FOOTER = "<8sqqqq16s8x"
_MAGIC = b"quernTOK"
#: Ids of a sample that go to the training of the dictionary as one piece.
_PIECE = 4096
#: Bytes of neighbouring frames that are read at once; a longer frame is read alone.
_BLOCK = 4 << 20


def _serialized(ids: np.ndarray, end_id: int, width: int) -> bytes:
    whole = np.append(ids.astype(np.int64), end_id)
    if whole.max() >= 1 << 8 * width:
        raise ValueError(f"An id of {whole.max()} does not fit into {width} bytes.")
    return whole.astype(f"<u{width}").tobytes()


def _width(tokens_file: str, end_id: int) -> int:
    """The least of 2 and 4 bytes that hold every id of the vocabulary and the end."""
    return 2 if max(word_tokens(tokens_file).top, end_id) < 1 << 16 else 4


def _dictionary(sample: DataFrame, tokens_file: str, end_id: int, width: int, size: int) -> bytes:
    """Train on a bounded sample, in one task; empty without documents."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pieces = []
        for batch in batches:
            for ids in word_tokens(tokens_file).encode(batch.column(0)):
                blob = _serialized(ids, end_id, width)
                pieces += [blob[i : i + _PIECE * width] for i in range(0, len(blob), _PIECE * width)]
        pieces.sort()
        made = b""
        if pieces:
            try:
                made = zstandard.train_dictionary(size, pieces).as_bytes()
            except zstandard.ZstdError:  # too few samples to train on: they serve as they are
                made = b"".join(pieces)[-size:]
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    return sample.repartition(1).mapInArrow(train, "dictionary binary").first()["dictionary"]


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` texts: all whose id's hash lies below a 64-bit limit, so some at every size."""
    below = min((most << 64) // max(1, rows.count()), 1 << 64) - (1 << 63)
    hashed = F.xxhash64("doc_id", F.lit("sample"))
    chosen = rows.where(hashed < F.lit(below)) if below < 1 << 63 else rows
    return chosen.orderBy(hashed, "doc_id", "text").limit(4 * most).select("text")


def write_token_files(
    documents: DataFrame,
    path: str,
    tokens_file: str,
    end_id: int = 1,
    width: int | None = None,
    sample_rows: int = 2_000,
    dictionary_bytes: int = 64 << 10,
    level: int = 3,
    shards: int | None = None,
) -> DataFrame:
    """Write ``documents`` (doc_id, text); returns the manifest, one row per shard.

    ``width`` is the number of bytes of a serialized id, by default what the vocabulary needs; an id
    that does not fit is an error. The dictionary is fitted on about ``sample_rows`` documents chosen
    by a hash of their id, at most four times as many where ids repeat; every document is written.
    A task writes its shard under a name of its own and reports it only when complete, so a
    repeated task cannot damage it.
    """
    spark = prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    width = width or _width(tokens_file, end_id)
    sample = _sample(rows, sample_rows)
    blob = _dictionary(sample, tokens_file, end_id, width, dictionary_bytes)
    digest = hashlib.md5(blob).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        task = TaskContext.get()
        name = f"{path}/shard-{task.partitionId():06d}-{task.taskAttemptId()}"
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(blob) if blob else None)
        index: list[tuple[int, int, int, int, int]] = []
        place = total = 0
        out = None
        for batch in batches:
            if out is None:
                store, inner = store_of(name)
                out = store.open_output_stream(inner)
            for doc, ids in zip(batch.column(0).to_pylist(), word_tokens(tokens_file).encode(batch.column(1)), strict=True):
                frame = packer.compress(_serialized(ids, end_id, width))
                out.write(frame)
                index.append((doc or 0, total, place, len(ids) + 1, doc is None))
                place += len(frame)
                total += len(ids) + 1
        if out is None:
            return
        arrays = np.array(index, np.int64).T
        out.write(arrays[:4].tobytes() + arrays[4].astype(np.uint8).tobytes())
        out.write(struct.pack(_FOOTER, _MAGIC, len(index), total, place, width, digest))
        out.close()
        row = [task.partitionId(), name, len(index), total]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["shard", "path", "documents", "tokens"])

    _make_folder(path)
    ranges = shards or partitions(spark)
    ordered = rows.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(write, "shard long, path string, documents long, tokens long").collect()
    listed, base = [], 0
    for row in sorted(made, key=lambda r: r["shard"]):
        listed.append((row["shard"], row["path"], row["documents"], row["tokens"], base))
        base += row["tokens"]
    spark.createDataFrame([(bytearray(blob), digest.hex())], "dictionary binary, hash string").write.parquet(f"{path}/dictionary")
    manifest = spark.createDataFrame(listed, "shard long, path string, documents long, tokens long, base long")
    manifest.coalesce(1).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def _make_folder(path: str) -> None:
    store, inner = store_of(path)
    store.create_dir(inner, recursive=True)


class Shard:
    """One shard: its index, and documents read by place."""

    def __init__(self, path: str, dictionary: bytes):
        import zstandard

        store, inner = store_of(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        magic, count, self.tokens, index, self.width, digest = struct.unpack(
            _FOOTER, self.file.read_at(64, size - 64)
        )
        if magic != _MAGIC or digest != hashlib.md5(dictionary).digest():
            raise ValueError(f"{path} was not written with this dictionary.")
        held = self.file.read_at(count * 33, index)
        self.doc_id, self.start, self.place, self.length = np.frombuffer(held[: count * 32], np.int64).reshape(4, count)
        self.missing = np.frombuffer(held[count * 32 :], np.uint8).astype(bool)
        self.stop = np.append(self.place[1:], index)
        self.reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, i: int) -> np.ndarray:
        frame = self.file.read_at(int(self.stop[i] - self.place[i]), int(self.place[i]))
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}")

    def all_ids(self) -> Iterator[np.ndarray]:
        """Ids of every document in turn; neighbouring frames are read in blocks."""
        first = 0
        while first < len(self.place):
            begin = int(self.place[first])
            last = max(first + 1, int(np.searchsorted(self.stop, begin + _BLOCK, side="right")))
            block = memoryview(self.file.read_at(int(self.stop[last - 1]) - begin, begin))
            for i in range(first, last):
                frame = block[int(self.place[i]) - begin : int(self.stop[i]) - begin]
                yield np.frombuffer(self.reader.decompress(frame), f"<u{self.width}")
            first = last

    def document(self, doc_id: int) -> np.ndarray:
        """Ids of one document, from its own frame alone."""
        known = int(self.missing.sum())  # null ids come first
        i = known + int(np.searchsorted(self.doc_id[known:], doc_id))
        if i == len(self.doc_id) or self.doc_id[i] != doc_id:
            raise KeyError(doc_id)
        return self.ids(i)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is over its ids as
    little-endian unsigned 32-bit integers.
    """
    prepare(spark)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(name, dictionary)
                every = shard.all_ids()
                for a in range(0, len(shard.doc_id), 4096):
                    part = slice(a, a + 4096)
                    sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in islice(every, 4096)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_id[part], mask=shard.missing[part]),
                            pa.array(shard.start[part] + base),
                            pa.array(shard.length[part]),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    manifest = spark.read.parquet(f"{path}/manifest").select("path", "base")
    return manifest.repartition(partitions(spark), "path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
