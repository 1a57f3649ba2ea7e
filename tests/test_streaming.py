"""Streams in several micro-batches: repeats, late rows, forgetting and closing."""

import datetime as dt
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quern.operators import contract
from quern.operators.policy import Costs
from quern.plans import streams
from quern.session import scratch_path
from quern.streaming.validation import (
    append_to,
    end_marker,
    late_rows,
    split_sink,
    stream_daily_monitoring,
    stream_validate,
)

SCHEMA = (
    "source_row_number long, step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
    "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int, ts timestamp"
)
START = dt.datetime(2024, 1, 1)


def row(line, hour, name="C1", amount=5.0):
    at = None if hour is None else START + dt.timedelta(hours=hour)
    return (line, 1, "DEBIT", amount, name, 0.0, 0.0, "M1", 0.0, 0.0, 0, 0, at)


def replay(spark, batches, schema=SCHEMA, close=True):
    path = scratch_path(spark, "stream-test")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    kind = spark.createDataFrame([], schema).schema
    if close:
        end_marker(spark, kind, "ts").write.mode("append").parquet(path)
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(path)


def drained(spark, frame):
    root = scratch_path(spark, "stream-test")
    append_to(frame, f"{root}/rows", f"{root}/state").start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{root}/rows")


def test_every_row_leaves_in_one_layer(spark):
    batches = [
        [row(9, 1, "C2"), row(4, 1, "C2"), row(5, 0, amount=-1.0), row(6, 10)],  # the lower line is first
        [row(7, 1, "C2"), row(8, 6, "C3"), row(10, 10), row(11, None)],
        [row(12, 30, "C9")],
        [row(13, 10, "C8"), row(14, 29, "C2"), row(15, 29, "C2"), row(16, 30, "C9", -1.0), row(16, 30, "C9", -1.0)],
    ]
    found = drained(spark, stream_validate(replay(spark, batches), "ts", "8 hours"))
    assert found.columns == [*[f.split()[0] for f in SCHEMA.split(", ")], "rejection_reason", "layer"]
    got = Counter((r.source_row_number, r.rejection_reason, r.layer) for r in found.collect())
    repeat = "duplicate_source_row"
    assert got == Counter(
        {
            (4, "", "accepted"): 1, (9, repeat, "rejected"): 1, (5, "invalid_amount", "rejected"): 1, (6, "", "accepted"): 1,
            (7, "", "late"): 1,  # ten hours seen, eight allowed
            (8, "", "accepted"): 1, (10, repeat, "rejected"): 1, (11, "", "late"): 1, (12, "", "accepted"): 1,
            (13, "", "late"): 1,
            (14, "", "accepted"): 1,  # its first was forgotten: the watermark is more than eight hours past it
            (15, repeat, "rejected"): 1, (16, "invalid_amount", "rejected"): 1, (16, f"invalid_amount|{repeat}", "rejected"): 1,
        }
    )


def test_memory_outlasts_the_delay(spark):
    batches = [[row(1, 0)], [row(2, 50, "C5")], [row(3, 49)]]
    layers = lambda **o: [(r.source_row_number, r.layer) for r in drained(spark, stream_validate(replay(spark, batches), "ts", "2 hours", **o)).orderBy("source_row_number").collect()]
    assert layers() == [(1, "accepted"), (2, "accepted"), (3, "accepted")]
    assert layers(memory="3 days") == [(1, "accepted"), (2, "accepted"), (3, "rejected")]


def test_hot_content_and_exact_values(spark):
    """Thousands of repeats are one entry of state; values pass through unchanged."""
    rows = [row(2**60 + i, 1, "C7", 0.1 + 0.2) for i in range(3_000)] + [row(1, 1, "C8", 1e-300)]
    found = drained(spark, stream_validate(replay(spark, [rows]), "ts", buckets=4))
    assert found.groupBy("layer").count().orderBy("layer").collect() == [("accepted", 2), ("rejected", 2_999)]
    first = found.where("layer = 'accepted'").orderBy("source_row_number").collect()
    assert [(r.source_row_number, r.amount) for r in first] == [(1, 1e-300), (2**60, 0.1 + 0.2)]


def test_sink_writes_three_layers(spark):
    written = {}
    keep = lambda name: lambda df, i: written.setdefault(name, []).extend(df.collect())
    batches = [[row(1, 0), row(2, 0), row(3, 9)], [row(4, 0)]]
    checked = stream_validate(replay(spark, batches), "ts", "1 hour")
    root = scratch_path(spark, "stream-test")
    sink = split_sink(keep("accepted"), keep("rejected"), keep("late"))
    checked.writeStream.foreachBatch(sink).option("checkpointLocation", root).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.source_row_number for r in written["accepted"]) == [1]
    assert sorted(r.source_row_number for r in written["rejected"]) == [2, 3]
    assert [r.source_row_number for r in written["late"]] == [4] and "name_orig" in written["accepted"][0].asDict()
    assert contract.REASON in written["rejected"][0].asDict()


def test_contents_in_many_pieces(spark):
    """The lowest line leads though it comes in a later piece of its bucket, and points in time stay exact."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    at = dt.datetime(2031, 5, 6, 7, 8, 9, 123457)
    rows = [(*row(30 - i, 1, f"C{i % 5}")[:-1], at) for i in range(20)]
    try:
        found = drained(spark, stream_validate(replay(spark, [rows]), "ts", buckets=1)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 20 and {r.ts for r in found} == {at}
    assert sorted(r.source_row_number for r in found if r.layer == "accepted") == [11, 12, 13, 14, 15]


def test_an_arrival_is_a_batch_of_as_many_files_as_it_needs(spark, monkeypatch):
    """Arrivals with fewer rows than files, too: their batch takes nothing from the next one."""
    monkeypatch.setattr(streams, "_FILE_ROWS", 100)
    arrivals = {0: 1, 1: 470, 2: 2, 3: 30}
    rows = [(i, a, START) for a, n in arrivals.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "i int, arrival int, ts timestamp").withColumn("part", F.col("arrival") + 0)
    stream = streams._replayed(SimpleNamespace(spark=spark), frame, "ts", "replay-test")
    seen, files = [], []

    def look(batch, _):
        seen.append({r[0]: r[1] for r in batch.groupBy("part").count().collect()})
        files.append(batch.where("part = 1").select(F.input_file_name()).distinct().count())

    root = scratch_path(spark, "stream-test")
    stream.writeStream.foreachBatch(look).option("checkpointLocation", root).trigger(availableNow=True).start().awaitTermination()
    assert seen == [{0: 1}, {1: 470}, {2: 2}, {3: 30}, {None: 1}]
    assert files == [0, 5, 0, 0, 0]


SCORED = "ts timestamp, amount double, probability double, actual int, review boolean"


def scored(hour, p=0.5):
    return (START + dt.timedelta(hours=hour), 10.0, p, 1, True)


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame([(i / 10,) for i in range(10)], "probability double")


def test_an_end_marker_closes_every_day(spark, reference):
    batches = [[scored(30), scored(1)], [scored(2), scored(75)]]
    days = lambda close: drained(spark, stream_daily_monitoring(replay(spark, batches, SCORED, close), reference, Costs(), delay="1 day"))
    counted = lambda df: sorted((r.day_start.day, r.transaction_count, r.loss_avoided) for r in df.collect())
    assert counted(days(True)) == [(1, 2, 17.0), (2, 1, 8.5), (4, 1, 8.5)]
    assert counted(days(False)) == [(1, 2, 17.0), (2, 1, 8.5)]


def test_rows_of_closed_days_are_audited(spark, reference):
    batches = [[scored(1), scored(100)], [scored(101)], [scored(2, 0.9), scored(99)]]
    stream = replay(spark, batches, SCORED)
    late = drained(spark, late_rows(stream, "ts", "1 day")).collect()
    assert [(r.probability, r.amount) for r in late] == [(0.9, 10.0)]
    days = drained(spark, stream_daily_monitoring(replay(spark, batches, SCORED), reference, Costs(), delay="1 day"))
    assert sum(r.transaction_count for r in days.collect()) + len(late) == 5
