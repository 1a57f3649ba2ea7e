"""Streaming queries, run to completion over the provided event files."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quern.operators import contract
from quern.plans.registry import oracle, register, rounded
from quern.plans.transactions import _FLAGGED, _PSI, COSTS, _quantiles
from quern.session import scratch_path, written
from quern.streaming.validation import append_to, end_marker, split_sink, stream_daily_monitoring, stream_validate

#: An arrival, and so a micro-batch, is two files at least and one more for so many rows.
_FILES, _FILE_ROWS = 2, 100_000


def _replayed(b, frame, event_time, label):
    """A static frame as a stream that arrives in order of its column ``arrival``, closed by an end marker.

    A micro-batch is a number of files, so every arrival has as many as the largest one needs; where
    rows are too few to fill them, empty files make up the number.
    """
    path = scratch_path(b.spark, label)
    frame = written(frame, f"{label}-rows")
    schema = frame.drop("arrival").schema
    sizes = {r["arrival"]: r["count"] for r in frame.groupBy("arrival").count().collect()}
    files = max([_FILES, *[math.ceil(n / _FILE_ROWS) for n in sizes.values()]])
    for done, part in enumerate(sorted(sizes), 1):
        rows = frame.where(F.col("arrival") == part).drop("arrival")
        rows.repartition(files).write.mode("append").parquet(path)
        there = b.spark.read.schema(schema).parquet(path).inputFiles()
        for _ in range(done * files - len(there)):
            rows.limit(0).write.mode("append").parquet(path)
    end_marker(b.spark, schema, event_time).write.mode("append").parquet(path)
    return b.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def _drained(b, frame, label):
    """Run a stream over everything available and read its output."""
    root = scratch_path(b.spark, label)
    append_to(frame, f"{root}/rows", f"{root}/state").start().awaitTermination()
    return b.spark.read.schema(frame.schema).parquet(f"{root}/rows")


# Rows arrive up to four days out of order, in five batches; each is late when an earlier batch
# has carried the watermark, two days behind the newest row, past it.
_START = 1704067200  # midnight, so that stream days equal day indexes
_ARRIVAL = "CAST(floor((step + source_row_number * 7 % 96) / 180) AS INT)"
_ARRIVED = {
    "arrived": "SELECT *, " + _ARRIVAL + " AS arrival FROM {view}",
    "newest": "SELECT arrival, max(max(step)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 48 AS mark "
              "FROM arrived GROUP BY arrival",
}


def _timed(frame):
    return frame.withColumns(
        {"ts": F.timestamp_seconds((F.col("step") - 1) * 3600 + _START), "arrival": F.expr(_ARRIVAL)}
    )


_REASON_OF = _FLAGGED["flagged"].replace("FROM numbered", "FROM marked")
_LAYERED = {
    "arrived": _ARRIVED["arrived"].format(view="txn_source"),
    "newest": _ARRIVED["newest"],
    "placed": "SELECT a.*, coalesce(step < mark, FALSE) AS is_late FROM arrived a JOIN newest USING (arrival)",
    "marked": "SELECT * EXCLUDE (arrival), CASE WHEN is_late THEN 1 ELSE row_number() OVER (PARTITION BY is_late, "
              + ", ".join(contract.SOURCE_COLUMNS) + " ORDER BY arrival, source_row_number) END AS copy FROM placed",
    "flagged": _REASON_OF,
}


@register(
    "stream_validate",
    oracle("txn_source", steps=_LAYERED, select="SELECT source_row_number, rejection_reason, " + ", ".join(contract.SOURCE_COLUMNS)
           + ", CASE WHEN is_late THEN 'late' WHEN rejection_reason = '' THEN 'accepted' ELSE 'rejected' END AS layer FROM flagged"),
)
def _(b):
    root = scratch_path(b.spark, "validated")
    layers = ("accepted", "rejected", "late")
    store = lambda layer: lambda df, i: df.write.mode("overwrite").parquet(f"{root}/{layer}/batch={i}")
    checked = stream_validate(_replayed(b, _timed(b["txn_source"]), "ts", "source"), "ts", "2 days")
    query = (
        checked.writeStream.foreachBatch(split_sink(*map(store, layers)))
        .option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    source = {v: k for k, v in contract.CANONICAL_NAMES.items()}
    kinds = {f.name: f.dataType for f in b["txn_source"].schema.fields}
    found = []
    for layer in layers:
        rows = b.spark.read.parquet(f"{root}/{layer}").withColumnsRenamed(source).withColumn("layer", F.lit(layer))
        if layer == "accepted":
            rows = rows.withColumn(contract.REASON, F.lit(""))
        found.append(rows.select(
            contract.LINE, contract.REASON, "layer", *[F.col(c).cast(kinds[c]).alias(c) for c in contract.SOURCE_COLUMNS]
        ))
    return found[0].unionByName(found[1]).unionByName(found[2])


# A day is closed once the watermark has reached its end; Spark still counts rows of the batch that closes it.
_CLOSED = {
    "arrived": _ARRIVED["arrived"].format(view="txn"),
    "newest": _ARRIVED["newest"].replace("AND 1 PRECEDING", "AND 2 PRECEDING"),
    "scored": "SELECT *, is_fraud AS actual FROM txn",
    "days": "SELECT (step - 1) // 24 AS day_index, *, is_fraud AS actual, probability >= 5e-1 AS review "
            "FROM arrived JOIN newest USING (arrival) WHERE coalesce(((step - 1) // 24 + 1) * 24 > mark - 1, TRUE)",
    "quantiles": _quantiles("scored"),
    "cuts": "SELECT list_sort(list_distinct(q)) AS q FROM quantiles",
    "inner_cuts": "SELECT q[2:len(q) - 1] AS e FROM cuts",
    "placed": "SELECT d.*, list_sum([CAST(probability >= x AS INT) for x in e]) AS bin FROM days d, inner_cuts",
    "ref": "SELECT list_sum([CAST(probability >= x AS INT) for x in e]) AS bin, count(*) / CAST((SELECT count(*) FROM scored) AS DOUBLE) AS r "
           "FROM scored, inner_cuts GROUP BY 1",
    "sizes": "SELECT day_index, count(*) AS n FROM placed GROUP BY 1",
    "shares": "SELECT s.day_index, f.bin, greatest(r, 1e-6) AS r, count(p.bin) / CAST(s.n AS DOUBLE) AS c FROM sizes s CROSS JOIN ref f "
              "LEFT JOIN placed p ON p.day_index = s.day_index AND p.bin = f.bin GROUP BY 1, 2, 3, s.n",
    "drift": f"SELECT day_index, {_PSI} AS psi FROM shares GROUP BY 1",
    "volume": "SELECT day_index, count(*) AS transaction_count, count(*) FILTER (WHERE review) AS review_count, "
              "count(*) FILTER (WHERE actual = 1) AS observed_fraud_count, count(*) FILTER (WHERE review AND actual = 1) AS true_positive_count, "
              "round(avg(probability), 6) AS mean_probability, round(coalesce(sum(amount * 1e0 * 85e-2) FILTER (WHERE review AND actual = 1), 0), 4) "
              "AS loss_avoided FROM days GROUP BY 1",
}


@register(
    "stream_daily_monitoring",
    oracle("txn", steps=_CLOSED, select="SELECT CAST(v.day_index AS INT) AS day_index, v.* EXCLUDE (day_index), round(psi, 6) AS score_psi "
           "FROM volume v JOIN drift USING (day_index)"),
)
def _(b):
    scored = _timed(b["txn"]).select(
        "arrival", "ts", "amount", "probability", F.col("is_fraud").alias("actual"),
        (F.col("probability") >= 0.5).alias("review"),
    )
    days = stream_daily_monitoring(_replayed(b, scored, "ts", "scored"), b["txn"], COSTS, delay="2 days")
    closed = _drained(b, days, "monitored").withColumn(
        "day_start", F.floor((F.unix_seconds("day_start") - _START) / 86400).cast("int")
    )
    return rounded(closed.withColumnRenamed("day_start", "day_index"), special={"loss_avoided": 4})
