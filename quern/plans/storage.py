"""Reader, writer, manifest and ingestion queries.

The files are written from the provided tables first, then read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import commerce, contract
from quern.plans.bindings import Bindings
from quern.plans.registry import oracle, register, rounded
from quern.plans.transactions import _FLAGGED
from quern.session import scratch_path
from quern.sources import csv, ingest, tables

_TXN_SCHEMA = (
    "source_row_number long, step int, type string, amount double, name_orig string, name_dest string, "
    "old_balance_orig double, old_balance_dest double, is_fraud int, probability double"
)
_PICKED = ("source_row_number", "step", "type", "amount", "is_fraud")


def _csv_copy(b: Bindings, label: str) -> str:
    path = scratch_path(b.spark, label)
    b["txn"].write.option("header", True).csv(path)
    return path


@register(
    "scan_csv_typed",
    oracle("txn", select="SELECT source_row_number, step, type, round(amount, 6) AS amount, is_fraud FROM txn"),
)
def _(b):
    return rounded(csv.scan_csv_typed(b.spark, _csv_copy(b, "typed"), _TXN_SCHEMA, _PICKED))


@register(
    "scan_csv_inferred",
    oracle("txn", select="SELECT source_row_number, CAST(step AS BIGINT) AS step, type, round(amount, 6) AS amount, CAST(is_fraud AS BIGINT) AS is_fraud FROM txn"),
)
def _(b):
    found = csv.scan_csv_inferred(b.spark, _csv_copy(b, "inferred")).select(*_PICKED)
    whole = ("source_row_number", "step", "is_fraud")
    return rounded(found.withColumns({c: F.col(c).cast("long") for c in whole}))


@register(
    "scan_csv_tolerant",
    oracle("txn", select="SELECT source_row_number, CASE WHEN source_row_number % 17 <> 0 THEN round(amount, 6) END AS amount, type, "
           "CASE WHEN source_row_number % 17 = 0 THEN source_row_number || ',n/a,' || type END AS line FROM txn"),
)
def _(b):
    path = scratch_path(b.spark, "tolerant")
    amount = F.when(F.col("source_row_number") % 17 == 0, "n/a").otherwise(
        F.col("amount").cast("string")
    )
    b["txn"].select("source_row_number", amount.alias("amount"), "type").write.option(
        "header", True
    ).csv(path)
    schema = b.spark.createDataFrame([], "source_row_number long, amount double, type string").schema
    good, bad = csv.scan_csv_tolerant(b.spark, path, schema)
    cell = lambda i: F.split("line", ",")[i]
    broken = bad.select(
        cell(0).cast("long").alias("source_row_number"), F.lit(None).cast("double").alias("amount"), cell(2).alias("type"), "line"
    )
    return rounded(good.withColumn("line", F.lit(None).cast("string")).unionByName(broken))


_SHARED = {"prvdr_id": "bigint", "state": "string", "smry_ctgry": "string", "pymt": "double"}


@register(
    "scan_csv_yearly_union",
    oracle("providers", select="SELECT prvdr_id, state, smry_ctgry, round(pymt, 4) AS pymt, year FROM providers"),
)
def _(b):
    root = scratch_path(b.spark, "yearly")
    years = sorted(r["year"] for r in b["providers"].select("year").distinct().collect())
    for year in years:  # odd years store their columns in another order
        frame = b["providers"].where(F.col("year") == year).drop("year")
        columns = frame.columns if year % 2 == 0 else list(reversed(frame.columns))
        frame.select(*columns).write.option("header", True).csv(f"{root}/{year}")
    return rounded(
        csv.scan_csv_yearly_union(b.spark, csv.yearly_paths(root, years), _SHARED), 4
    )


@register("source_row_number", oracle("txn", select="SELECT source_row_number - 2 AS event_id, source_row_number - 2 AS restored FROM txn"))
def _(b):
    # Files hold consecutive ids in order, so first id + line - 2 restores every id.
    path = scratch_path(b.spark, "lines")
    events = b["txn"].select((F.col("source_row_number") - 2).alias("event_id"), "amount")
    events.repartitionByRange("event_id").sortWithinPartitions("event_id").write.option(
        "header", True
    ).csv(path)
    raw = b.spark.read.schema("event_id long, amount double").option("header", True).csv(path)
    numbered = csv.with_line_number(raw, file_name="file")
    firsts = numbered.groupBy("file").agg(F.min("event_id").alias("first_id"))
    return numbered.join(firsts, "file").select(
        "event_id", (F.col("first_id") + F.col("source_row_number") - 2).alias("restored")
    )


@register("scan_parquet_parts", oracle("txn", select="SELECT source_row_number, step, type FROM txn"))
def _(b):
    path = scratch_path(b.spark, "parts")
    tables.sink_parquet_parts(b["txn"], path)
    return tables.scan_parquet_parts(b.spark, path, ["source_row_number", "step", "type"])


@register("sink_parquet_parts", oracle("txn", steps={"kept": "SELECT * FROM txn WHERE is_fraud = 1"}, select="SELECT * FROM kept"))
def _(b):
    path = scratch_path(b.spark, "overwrite")
    tables.sink_parquet_parts(b["txn"].where(F.col("is_fraud") == 0), path)
    tables.sink_parquet_parts(b["txn"].where(F.col("is_fraud") == 1), path, overwrite=True)
    return tables.scan_parquet_parts(b.spark, path)


@register("concat_parts", oracle("txn", select="SELECT source_row_number, step FROM txn"))
def _(b):
    slim = b["txn"].select("source_row_number", "step")
    return tables.concat_parts([slim.where(F.col("step") <= 360), slim.where(F.col("step") > 360)])


@register(
    "sink_csv_result",
    oracle("ecom", select="SELECT purchase_method, count(*) AS transactions FROM ecom GROUP BY 1"),
)
def _(b):
    path = scratch_path(b.spark, "result")
    tables.sink_csv_result(commerce.purchase_method_counts(b["ecom"]), path)
    return csv.scan_csv_typed(b.spark, path, "purchase_method string, transactions long")


@register(
    "sink_json_metrics",
    oracle("ecom", select="SELECT round(sum(gross_amount), 4) AS gross_revenue, round(sum(net_amount), 4) AS net_revenue, "
           "round(sum(gross_amount - net_amount), 4) AS discount_given FROM ecom"),
)
def _(b):
    path = scratch_path(b.spark, "metrics")
    tables.sink_json_metrics(commerce.revenue_before_after(b["ecom"]), path)
    schema = "gross_revenue double, net_revenue double, discount_given double"
    return rounded(b.spark.read.schema(schema).json(path), 4)


@register(
    "describe_schema",
    "SELECT column_name, non_null, CASE column_name WHEN 'event_id' THEN 'bigint' WHEN 'user_id' THEN 'bigint' WHEN 'value' THEN 'double' "
    "WHEN 'ts' THEN 'timestamp_ntz' ELSE 'string' END AS data_type FROM (SELECT count(event_id) AS event_id, count(ts) AS ts, count(user_id) AS user_id, "
    "count(event_type) AS event_type, count(value) AS value, count(props) AS props FROM events) "
    "UNPIVOT (non_null FOR column_name IN (event_id, ts, user_id, event_type, value, props))",
)
def _(b):
    return tables.describe_schema(b["events"])


@register("source_manifest")
def _(b):
    manifest = ingest.source_manifest(b.spark, f"{b.folder}/*.parquet")
    return manifest.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "sha256")


@register(
    "ingest_batch",
    oracle("txn_source", steps={
        **_FLAGGED,
        "kept": "SELECT source_row_number, rejection_reason FROM flagged",
    }, select="SELECT CAST(1 AS BIGINT) AS ingestion_id, 'completed' AS status, (SELECT count(*) FROM kept) AS source_rows, "
              "(SELECT count(*) FROM kept WHERE rejection_reason = '') AS accepted_rows, (SELECT count(*) FROM kept WHERE rejection_reason <> '') AS rejected_rows, "
              "source_row_number, nullif(rejection_reason, '') AS rejection_reason, rejection_reason = '' AS printed FROM kept"),
)
def _(b):
    """Every loaded line, from both published layers, with the state of its batch."""
    root = scratch_path(b.spark, "ingest")
    ingest.ingest_batch(contract.flag_transactions(b["txn_source"]), "events", "0" * 64, root)
    state = ingest.batch_state(b.spark, root).select(
        "ingestion_id", "status", "source_rows", "accepted_rows", "rejected_rows"
    )
    accepted = ingest.completed_rows(b.spark, root, "raw/transactions").select(
        "ingestion_id", "source_row_number", F.lit(None).cast("string").alias("rejection_reason"),
        F.col("row_fingerprint").rlike("^[0-9a-f]{16}$").alias("printed"),
    )
    rejected = ingest.completed_rows(b.spark, root, "audit/rejected_rows").select(
        "ingestion_id", "source_row_number", "rejection_reason", F.lit(False).alias("printed")
    )
    return accepted.unionByName(rejected).join(state, "ingestion_id")
