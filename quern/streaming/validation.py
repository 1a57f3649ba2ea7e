"""Row validation and daily monitoring on a stream of transactions.

A bounded stream is closed by an end marker: a last row with an event time after all others,
which moves the watermark past every open day. Rows behind the watermark are not dropped but
leave as a layer of their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from quern.operators import contract
from quern.operators.monitoring import ReferenceBins
from quern.operators.policy import Costs

#: Event time of an end marker; no row of a source is as late.
END = dt.datetime(9000, 1, 1)
LAYER = "layer"
#: What a bucket remembers: content, and the event time (ms) up to which repeats are recognised.
_SEEN = np.dtype([("print", "S32"), ("until", "i8")])
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def end_marker(spark: SparkSession, schema: T.StructType, event_time: str) -> DataFrame:
    """One row with the event time ``END`` and nothing else, to be sent after the last row of a stream."""
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields}
    nothing[event_time] = F.lit(END).cast(schema[event_time].dataType).alias(event_time)
    return spark.range(1).select(*nothing.values())


def _millis(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {interval})").first()[0]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _marked_rows(
    rows: DataFrame, event_time: str, delay: str, closes: Column, kept_for: int | None, buckets: int
) -> DataFrame:
    """The rows of a stream with ``_late`` and, when contents are remembered, ``_repeat``.

    A row is late when the watermark has reached ``closes`` (ms). Contents (``_print``) live in keyed
    state, one array per bucket of contents, so a batch costs one Python call per bucket and not
    one per row, and a content that repeats without end is only looked up. An entry is forgotten
    once the watermark has passed its event time by ``kept_for`` ms. Rows travel as one JSON
    text, which keeps every type exact; short names and times as numbers make it quick to read.
    """
    fields = rows.drop("_print").schema.fields
    is_time = [isinstance(f.dataType, T.TimestampType) for f in fields]
    schema = T.StructType([T.StructField(f"c{i}", T.LongType() if t else f.dataType) for i, (f, t) in enumerate(zip(fields, is_time, strict=True))])
    printed = rows if "_print" in rows.columns else rows.withColumn("_print", F.lit(""))
    names = [f.name for f in fields]
    sent = [(F.unix_micros(n) if t else F.col(n)).alias(f"c{i}") for i, (n, t) in enumerate(zip(names, is_time, strict=True))]
    line = F.col(contract.LINE) if contract.LINE in names else F.lit(0)
    # The marker passes the watermark's node and moves it; behind it the marker is dropped.
    timed = printed.withWatermark(event_time, delay).where(F.coalesce(F.col(event_time) < F.lit(END), F.lit(True)))
    packed = timed.select(
        F.pmod(F.xxhash64("_print" if kept_for is not None else F.col(event_time)), F.lit(buckets)).alias("_bucket"),
        event_time, "_print",
        F.coalesce(F.unix_millis(event_time), F.lit(-(2**62))).alias("_at"),
        F.coalesce(closes, F.lit(-(2**62))).alias("_closes"),
        F.coalesce(line.cast("long"), F.lit(0)).alias("_line"),
        F.to_json(F.struct(*sent), _JSON).alias("_row"),
    )

    def mark(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        held = np.frombuffer(state.get[0], _SEEN) if state.exists else np.zeros(0, _SEEN)
        held = held[held["until"] > watermark]
        seen = np.sort(held["print"])  # sorted once, then searched by every chunk
        first: dict[bytes, tuple[int, int, str]] = {}
        for chunk in chunks:
            rows, closes = chunk["_row"].to_numpy(), chunk["_closes"].to_numpy()
            # A row without an event time has no place in the stream: it is late.
            late = (closes <= watermark) | (closes == -(2**62))
            leads, beaten = np.zeros(len(rows), bool), []
            if kept_for is not None:
                on_time = np.flatnonzero(~late)
                prints = chunk["_print"].to_numpy()[on_time].astype("S32")
                lines, times = (chunk[c].to_numpy()[on_time] for c in ("_line", "_at"))
                # Of contents new in this batch the lowest line is the first, wherever it comes.
                order = np.lexsort((lines, prints))
                ahead = np.ones(len(order), bool)
                ahead[1:] = prints[order][1:] != prints[order][:-1]
                order = order[ahead]
                order = order[~_among(prints[order], seen)]
                leads[on_time[order]] = True
                offers = zip(lines[order].tolist(), times[order].tolist(), rows[on_time[order]], strict=True)
                for content, offered in zip(prints[order].tolist(), offers, strict=True):
                    kept = first.setdefault(content, offered)
                    if kept is not offered:
                        first[content], other = min(kept, offered), max(kept, offered)
                        beaten.append(other[2])
            late = np.append(late[~leads], np.zeros(len(beaten), bool))
            repeat = np.zeros(len(late), bool) if kept_for is None else ~late
            yield pd.DataFrame({"_row": [*rows[~leads], *beaten], "_late": late, "_repeat": repeat})
        if first:
            yield pd.DataFrame({"_row": [row for _, _, row in first.values()], "_late": False, "_repeat": False})
            added = np.array([(p, at + kept_for) for p, (_, at, _) in first.items()], _SEEN)
            held = np.concatenate([held, added])
        if len(held):
            state.update((held.tobytes(),))
        elif state.exists:
            state.remove()

    marked = packed.groupBy("_bucket").applyInPandasWithState(
        mark, "_row string, _late boolean, _repeat boolean", "seen binary", "append", "NoTimeout"
    )
    found = [(F.timestamp_micros(f"r.c{i}") if t else F.col(f"r.c{i}")).alias(n) for i, (n, t) in enumerate(zip(names, is_time, strict=True))]
    return marked.select(F.from_json("_row", schema, _JSON).alias("r"), "_late", "_repeat").select(*found, "_late", "_repeat")


def stream_validate(
    stream: DataFrame, event_time: str, delay: str = "1 hour", memory: str | None = None, buckets: int = 256
) -> DataFrame:
    """Every row of the stream once, with its rejection reason and its ``layer``.

    accepted    no check fails and no earlier row of the stream holds the same values
    rejected    the ten checks of the batch form, ``duplicate_source_row`` included
    late        behind the watermark, or without event time; its reason tells of the nine row checks

    Repeats are recognised by 128 bits of a hash of the source columns while the watermark is less
    than ``memory`` (``delay`` if not given) past the first of them; of repeats in one batch the
    lowest line counts as the first. State is 40 bytes per remembered content.
    """
    kept_for = _millis(stream.sparkSession, memory or delay)
    printed = contract.row_fingerprint(stream, contract.SOURCE_COLUMNS, "_print", digits=32)
    marked = _marked_rows(printed, event_time, delay, F.unix_millis(event_time) + 1, kept_for, buckets)
    layer = F.when(F.col("_late"), "late").when(F.col(contract.REASON) == "", "accepted").otherwise("rejected")
    return contract.rejection_reasons(marked, F.col("_repeat")).withColumn(LAYER, layer).drop("_late", "_repeat")


def split_sink(
    accept: Callable[[DataFrame, int], None],
    reject: Callable[[DataFrame, int], None],
    late: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing accepted, rejected and late rows of each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            accept(contract.accepted_rows(kept.where(F.col(LAYER) == "accepted").drop(LAYER)), batch_id)
            reject(contract.rejected_rows(kept.where(F.col(LAYER) == "rejected")), batch_id)
            late(kept.where(F.col(LAYER) == "late").drop(LAYER), batch_id)
        finally:
            kept.unpersist()

    return write


def late_rows(stream: DataFrame, event_time: str = "ts", delay: str = "1 day", buckets: int = 256) -> DataFrame:
    """Rows whose day the watermark had passed when they came, so that they can be audited.

    A query of its own beside ``stream_daily_monitoring``: over the same source, with the same limit
    of input per batch, it sees the same watermarks. It holds every row that the days leave out, and
    also those of the batch that closes a day, which Spark still counts. It keeps no state.
    """
    closes = F.unix_millis(F.date_trunc("day", F.col(event_time)) + F.expr("INTERVAL 1 DAY"))
    return _marked_rows(stream, event_time, delay, closes, None, buckets).where("_late").drop("_late", "_repeat")


def stream_daily_monitoring(
    reviewed: DataFrame,
    reference: DataFrame,
    costs: Costs,
    event_time: str = "ts",
    delay: str = "1 day",
) -> DataFrame:
    """Daily volume, outcomes and drift, one row per day once its watermark has passed.

    State is one row of counts per open day; the reference bins are at most ten numbers. An
    ``end_marker`` after the last row closes all days; its own day stays open and is never
    returned. Rows of closed days are left out; ``late_rows`` returns them.
    """
    cut = ReferenceBins(reference)
    fraud, seen = F.col("actual") == 1, F.col("review")
    avoided = F.col("amount") * F.lit(costs.loss_rate) * F.lit(costs.recovery_rate)
    days = (
        reviewed.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("day"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_if(seen).alias("review_count"),
            F.count_if(fraud).alias("observed_fraud_count"),
            F.count_if(seen & fraud).alias("true_positive_count"),
            F.avg("probability").alias("mean_probability"),
            F.coalesce(F.sum(F.when(seen & fraud, avoided)), F.lit(0.0)).alias("loss_avoided"),
            *(cut.counts() if cut.usable else []),
        )
    )
    kept = [c for c in days.columns if c != "day" and not c.startswith("_bin")]
    return days.select(
        F.col("day.start").alias("day_start"), *kept, cut.index().alias("score_psi")
    )


def append_to(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Parquet writer in append mode that processes what is available and stops."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
