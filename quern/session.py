"""Session settings and the shared folder used for scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every operator was planned for. They only steer execution;
#: results do not depend on them.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more exchange: a hot
    # customer or station must not pin a single task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Per-group top-k keeps its partial limit in every task, whatever k is.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, for the few Arrow-batched functions."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quern-package-"), "quern.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.join("quern", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def build_session(app: str = "quern", master: str | None = None, **options: str) -> SparkSession:
    """Create a session; cluster sizing is left to the submitting environment."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **options}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    folder = tempfile.mkdtemp(prefix="quern-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/quern-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Compute a table once and cut its lineage; the copy in the shared folder outlives a lost executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let MLlib cut the lineage of long boosting runs."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
