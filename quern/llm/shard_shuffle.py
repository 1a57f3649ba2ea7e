"""Sharding by a two-pass external shuffle.

Pass one scatters the rows by a seeded hash into buckets that fit a task's memory; pass two
reads one bucket at a time, shuffles it (Fisher-Yates, seeded by the bucket) and writes it. The
buckets in turn are a random order of all rows, cut into shards whose counts are at most one
apart (law ``rows``).

The order depends on the seed and the rows alone, not on files, tasks or retries: a row is
named by 128 bits of hash over all its columns, and rows equal in all columns are numbered, so
that their copies scatter like other rows. Such rows are counted before they travel and made
again behind the exchange, so a row with very many copies is no hot key. Null ids and texts are
values like others; a text may be longer than a bucket, which then holds little else. Columns
called ``shard`` or ``slot`` are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.common import partitions, plain, prepare, written

#: What a row counts beside its text.
ROW_BYTES = 16
#: Copies of one row that a task makes again.
_COPIES = 4096
#: Rows of (hash, hash) that may be broadcast: 16 MB.
_BROADCAST_ROWS = 1_000_000


def size_of(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _numbered(counted: DataFrame) -> DataFrame:
    """Each row of ``counted`` once per copy (``_n``), with the copy's number ``_copy``."""
    last = F.col("_n") - 1
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor(last / _COPIES)))).repartition("_a", "_block")
    low = F.col("_block") * _COPIES
    return blocks.withColumn("_copy", F.explode(F.sequence(low, F.least(low + _COPIES - 1, last)))).drop("_n", "_block")


def _told_apart(rows: DataFrame, repeated: DataFrame | None, small: bool) -> DataFrame:
    """All rows with the number of the copy; only rows of ``repeated`` keys are grouped."""
    if repeated is None:
        return rows.withColumn("_copy", F.lit(0).cast("long"))
    keys = F.broadcast(repeated) if small else repeated
    fresh = rows.join(keys, ["_a", "_b"], "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    again = rows.join(keys, ["_a", "_b"], "left_semi").groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    return fresh.unionByName(_numbered(again))


def _starts(counts: DataFrame) -> DataFrame:
    """(_bucket, _start): rows of all earlier buckets, summed inside groups of buckets and over the groups."""
    grouped = counts.withColumn("_group", F.floor(F.col("_bucket") / 1024))
    inside = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = grouped.groupBy("_group").agg(F.sum("_n").alias("_n"))
    totals = totals.select("_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = grouped.select("_group", "_bucket", F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_inside"))
    return local.join(totals, "_group").select("_bucket", (F.col("_before") + F.col("_inside")).alias("_start"))


def shard_of(place: np.ndarray, rows: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of places in the order of all rows; counts differ by one at most."""
    shard = place * shards // rows
    return shard, place - -(-shard * rows // shards)


def shuffle_to_shards(
    documents: DataFrame, path: str, shards: int = 40, seed: int = 42, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """Write ``documents`` in random order to ``path``; returns the manifest, one row a file.

    ``path/rows`` holds one folder a shard. The slots of a file follow each other, and its rows
    lie in their order. The manifest (shard, file, first_slot, rows) orders the files of a shard.
    """
    spark = prepare(documents.sparkSession)
    rows, given = plain(documents, "shard", "slot")
    text = F.col(f"c{documents.columns.index('text')}")
    keyed = rows.withColumns({"_a": F.xxhash64(F.lit(seed), *rows.columns), "_b": F.xxhash64(F.lit(seed + 1), *rows.columns)})
    keys = written(keyed.select("_a", "_b", size_of(text).alias("_size")), "shuffle-keys")
    count, size = keys.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    buckets = max(1, -(-size // bucket_bytes))
    many = written(keys.groupBy("_a", "_b").agg(F.count("*").alias("_n")).where("_n > 1"), "shuffle-copies")
    copies = many.count()
    repeated, small = (many.select("_a", "_b") if copies else None), copies <= _BROADCAST_ROWS
    bucket = F.pmod(F.xxhash64(F.lit(seed + 2), "_a", "_b", "_copy"), F.lit(buckets)).alias("_bucket")

    # Counted over the hashes alone, by the same expressions as the rows themselves.
    named = _told_apart(keys.select("_a", "_b"), repeated, small)
    counts = written(named.select(bucket).groupBy("_bucket").agg(F.count("*").alias("_n")), "shuffle-buckets")
    scattered = _told_apart(keyed, repeated, small).select("*", bucket)
    marked = scattered.unionByName(_starts(counts), allowMissingColumns=True)
    tasks = partitions(spark)
    # Each task takes neighbouring buckets, so what it writes of a shard is one run of slots.
    dealt = marked.repartitionById(tasks, F.floor(F.col("_bucket") * tasks / buckets).cast("int")).sortWithinPartitions(
        "_bucket", F.col("_start").isNull(), "_a", "_b", "_copy"
    )
    schema = StructType(list(rows.schema.fields)).add("shard", "integer").add("slot", "long")
    kept, total = len(rows.columns), int(count)

    def mixed(held: list[pa.RecordBatch], number: int, start: int) -> pa.Table:
        whole = pa.Table.from_batches(held)
        # numpy's permutation is the Fisher-Yates shuffle.
        whole = whole.take(pa.array(np.random.default_rng([seed & (2**63 - 1), number]).permutation(len(whole))))
        shard, slot = shard_of(start + np.arange(len(whole)), total, shards)
        return pa.table([*whole.columns, pa.array(shard, pa.int32()), pa.array(slot)], schema.names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = start = -1
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("_bucket")).to_numpy()
            first = batch.column(batch.schema.get_field_index("_start"))
            edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b > a and at[a] != number:
                    if held:
                        yield from mixed(held, number, start).to_batches(max_chunksize=512)
                    # A bucket's first row says where it starts, and is no row of the table.
                    held, number, start = [], int(at[a]), first[a].as_py()
                    a += 1
                if b > a:
                    held.append(batch.slice(a, b - a).select(list(range(kept))))
        if held:
            yield from mixed(held, number, start).to_batches(max_chunksize=512)

    order = [*rows.columns, "_a", "_b", "_copy", "_bucket", "_start"]
    shuffled = dealt.select(*order).mapInArrow(write, schema).sortWithinPartitions("shard", "slot")
    shuffled.write.partitionBy("shard").parquet(f"{path}/rows")
    spark.createDataFrame([(given, rows.schema.json())], "names array<string>, columns string").write.parquet(f"{path}/columns")
    files = spark.read.schema(schema).parquet(f"{path}/rows")
    manifest = files.groupBy("shard", F.col("_metadata.file_path").alias("file")).agg(
        F.min("slot").alias("first_slot"), F.count("*").alias("rows")
    )
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows as written, with their shard and slot."""
    told = spark.read.parquet(f"{path}/columns").first()
    schema = StructType.fromJson(json.loads(told["columns"])).add("slot", "long").add("shard", "integer")
    names = [*told["names"], "slot", "shard"]
    return spark.read.schema(schema).parquet(f"{path}/rows").toDF(*names)


def digest(made: DataFrame) -> DataFrame:
    """Per document: size, hash of the text, and its place under the law ``rows``."""
    return made.select(
        "doc_id", size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
