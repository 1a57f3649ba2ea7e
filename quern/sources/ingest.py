"""Source digests and the ingestion batch with its append-only event log."""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.contract import LINE, accepted_rows, rejected_payload_json, rejected_rows, row_fingerprint
from quern.sources.files import opened

_BLOCK = 1 << 20


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each listed file, read block by block inside the task."""
    for batch in batches:
        found = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            with opened(path, packed=True) as stream:
                while block := stream.read(_BLOCK):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "length": batch["length"], "sha256": found})


def source_manifest(
    spark: SparkSession, glob: str, expected: dict[str, str] | None = None
) -> DataFrame:
    """(path, length, sha256, ok): files hashed in parallel, one stream per file.

    ``expected`` maps a file name to its recorded digest; ``ok`` is NULL for a file
    without a record.
    """
    files = spark.read.format("binaryFile").load(glob).select("path", "length")
    hashed = files.repartition("path").mapInPandas(
        _digests, "path string, length long, sha256 string"
    )
    recorded = spark.createDataFrame(list((expected or {}).items()), "file string, recorded string")
    named = hashed.withColumn("file", F.element_at(F.split("path", "/"), -1))
    return named.join(recorded, "file", "left").select(
        "path", "length", "sha256", (F.col("sha256") == F.col("recorded")).alias("ok")
    )


def require_known_sources(manifest: DataFrame) -> None:
    """Raise when a file differs from its recorded digest or has none."""
    unknown = manifest.where(~F.coalesce("ok", F.lit(False))).count()
    if unknown:
        raise RuntimeError(f"{unknown} source files differ from their recorded digest.")


_EVENTS = (
    "ingestion_id long, event_seq long, status string, source_name string, source_sha256 string, content_digest string, "
    "source_rows long, accepted_rows long, rejected_rows long, happened_at timestamp"
)


def batch_events(spark: SparkSession, root: str) -> DataFrame:
    names = [part.split()[0] for part in _EVENTS.split(", ")]
    try:
        return spark.read.schema(_EVENTS).parquet(f"{root}/audit/ingestion_events").select(*names)
    except AnalysisException:
        return spark.createDataFrame([], _EVENTS)


def batch_state(spark: SparkSession, root: str) -> DataFrame:
    """Latest event of every batch."""
    latest = F.max_by(F.struct("*"), "event_seq").alias("e")
    return batch_events(spark, root).groupBy("ingestion_id").agg(latest).select("e.*")


def _record(spark: SparkSession, root: str, **values) -> None:
    values["happened_at"] = dt.datetime.now(dt.timezone.utc)
    names = [part.split()[0] for part in _EVENTS.split(", ")]
    row = tuple(values.get(n) for n in names)
    # A folder per event: writers of one folder would clear each other's unfinished files.
    spark.createDataFrame([row], _EVENTS).coalesce(1).write.mode("errorifexists").parquet(
        f"{root}/audit/ingestion_events/event={values['ingestion_id']}-{values['event_seq']}"
    )


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet; False when somebody else has.

    Exclusive on local disks and on every store whose creation without overwriting is, such as HDFS.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if system.getUri().getScheme() == "file":
        try:
            os.close(os.open(target.toUri().getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        system.create(target, False).close()
    except Py4JJavaError as error:
        if system.exists(target):
            return False
        raise error
    return True


def _claim_id(spark: SparkSession, root: str) -> int:
    """The lowest id above all recorded ones that nobody else has claimed."""
    wanted = (batch_events(spark, root).agg(F.max("ingestion_id")).first()[0] or 0) + 1
    while not claim(spark, f"{root}/audit/claims/id-{wanted:012d}"):
        wanted += 1
    return wanted


def repeated_content(accepted: DataFrame, fingerprint: str = "row_fingerprint") -> int:
    """Rows whose content repeats an earlier row; equal fingerprints are compared by their values."""
    content = [c for c in accepted.columns if c not in (LINE, fingerprint)]
    shared = accepted.groupBy(fingerprint).agg(F.count("*").alias("n")).where(F.col("n") > 1).select(fingerprint)
    groups = accepted.join(shared, fingerprint, "left_semi").groupBy(*content).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]


def _content_digest(accepted: DataFrame) -> Column:
    """A name of the set of rows, whatever their order, lines and files: their number and 128 bits."""
    content = [c for c in accepted.columns if c not in (LINE, "row_fingerprint")]
    halves = [F.lpad(F.hex(F.bit_xor(F.xxhash64(F.lit(i), *content))), 16, "0") for i in (1, 2)]
    return F.concat(F.count("*").cast("string"), F.lit("-"), *halves)


def ingest_batch(flagged: DataFrame, source_name: str, source_sha256: str, root: str) -> int:
    """Load one checked source (lines with their rejection reason) under a new id and return the id.

    The id and the source's digest are claimed by exclusive creation, so loads may run side by
    side. The checks are computed once, into a staging folder. Rows repeated within the batch, or a
    batch that holds the same rows as an earlier one, are refused before anything is published.
    Accepted rows carry their fingerprint and land in an ``ingestion_id=N`` folder of their own;
    readers see them with the ``completed`` event. The log only grows. A source whose load
    failed stays claimed, as its digest is in the log.
    """
    spark = flagged.sparkSession
    if not claim(spark, f"{root}/audit/claims/source-{source_sha256}"):
        raise ValueError("This source digest was ingested before.")
    ingestion_id = _claim_id(spark, root)
    common = {
        "ingestion_id": ingestion_id, "source_name": source_name, "source_sha256": source_sha256,
    }
    _record(spark, root, event_seq=1, status="started", **common)
    try:
        staging = f"{root}/staging/ingestion_id={ingestion_id}"
        flagged.write.mode("errorifexists").parquet(staging)
        staged = spark.read.schema(flagged.schema).parquet(staging)
        accepted, rejected = accepted_rows(staged), rejected_rows(staged)
        content = [c for c in accepted.columns if c != LINE]
        accepted = row_fingerprint(accepted, content).select(LINE, "row_fingerprint", *content)
        digest, n_accepted = accepted.agg(_content_digest(accepted), F.count("*")).first()
        if repeats := repeated_content(accepted):
            raise RuntimeError(f"{repeats} rows repeat the content of another row of this batch.")
        if n_accepted and not claim(spark, f"{root}/audit/claims/content-{digest}"):
            raise RuntimeError("A batch with the same rows was ingested before.")
        rejected_to = f"{root}/audit/rejected_rows/ingestion_id={ingestion_id}"
        rejected_payload_json(rejected, ingestion_id).drop("ingestion_id").write.mode("errorifexists").parquet(rejected_to)
        accepted.write.mode("errorifexists").parquet(f"{root}/raw/transactions/ingestion_id={ingestion_id}")
        n_rejected = rejected.count()
    except Exception:
        _record(spark, root, event_seq=2, status="failed", **common)
        raise
    _record(
        spark, root, event_seq=2, status="completed", source_rows=n_accepted + n_rejected,
        accepted_rows=n_accepted, rejected_rows=n_rejected, content_digest=digest, **common,
    )
    return ingestion_id


def completed_rows(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a layer (raw/transactions or audit/rejected_rows) from completed batches."""
    done = batch_state(spark, root).where(F.col("status") == "completed").select("ingestion_id")
    rows = spark.read.parquet(f"{root}/{table}")
    return rows.withColumn("ingestion_id", F.col("ingestion_id").cast("long")).join(
        done, "ingestion_id", "left_semi"
    )


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str) -> None:
    """Bulk load into a database, one connection per task."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_rows), **options).mode(
        "append"
    ).save()
