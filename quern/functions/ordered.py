"""Order-dependent computations without a single-task window.

A window without PARTITION BY sends all rows to one task, and a window on a hot
key sends that key to one task. The helpers below cut the *order column* into
ranges first, work inside each range, and add the totals of the earlier ranges.
The cut points come from one approximate percentile pass; they only balance the
work, the results are exact for any cut points.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.sources.literal import inline_table

_RANGE = "_range"
#: Ranges whose totals one task sums; more are summed as ranges of ranges.
_SPAN = 512


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join in which NULL keys match each other, as grouping treats them."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(
        *[f"_right_{key}" for key in keys]
    )


def order_key(df: DataFrame, column: str) -> Column:
    """The order column as a double; a monotone map, so ranges respect the order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise TypeError(f"Cannot cut {column} of type {kind.simpleString()} into ranges.")


def cut_points(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Roughly even cut points of a column, two ranges a shuffle partition if not said otherwise."""
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    ranges = max(2, ranges)
    probabilities = [i / ranges for i in range(1, ranges)]
    row = df.agg(
        F.percentile_approx(order_key(df, column), probabilities, ranges * 4).alias("cuts")
    ).first()
    return sorted({float(c) for c in row["cuts"] or [] if not math.isnan(c)})


def with_range(df: DataFrame, column: str, cuts: Sequence[float], name: str = _RANGE) -> DataFrame:
    """Number of cut points at or below the value (binary search, in the JVM)."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    keyed = df.withColumn("_key", order_key(df, column))
    ranged = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")],
        inputCol="_key",
        outputCol="_bucket",
        handleInvalid="keep",
    ).transform(keyed)
    return ranged.withColumn(name, F.col("_bucket").cast("int")).drop("_key", "_bucket")


def _before_each_range(
    totals: DataFrame, group: Sequence[str], names: Sequence[str], descending: bool
) -> DataFrame:
    """(group, range, _before_*): totals of all earlier ranges, by a prefix scan in two levels.

    Totals are summed inside spans of ranges and over the spans, so no task takes all ranges.
    """
    position = F.desc if descending else F.asc
    spans = totals.withColumn("_span", F.floor(F.col(_RANGE) / _SPAN))

    def earlier(*keys: str, order: str):
        return Window.partitionBy(*keys).orderBy(position(order)).rowsBetween(Window.unboundedPreceding, -1)

    def summed(frame: DataFrame, prefix: str, window, *kept: str) -> DataFrame:
        return frame.select(
            *kept, *[F.coalesce(F.sum(f"_total_{n}").over(window), F.lit(0)).alias(f"{prefix}{n}") for n in names]
        )

    inside = summed(spans, "_near_", earlier(*group, "_span", order=_RANGE), *group, "_span", _RANGE)
    whole = spans.groupBy(*group, "_span").agg(*[F.sum(f"_total_{n}").alias(f"_total_{n}") for n in names])
    over = summed(whole, "_far_", earlier(*group, order="_span"), *group, "_span")
    return inside.join(over, [*group, "_span"]).select(
        *group, _RANGE, *[(F.col(f"_near_{n}") + F.col(f"_far_{n}")).alias(f"_before_{n}") for n in names]
    )


def ordered_cumsum(
    df: DataFrame,
    order: str,
    sums: Mapping[str, Column | str],
    by: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Running sums (current row included) in the order of a unique column.

    ``sums`` maps a new column to the expression summed. ``order`` must be unique
    within ``by``. A hot ``by`` group is spread over the ranges of ``order``. ``cuts``
    may come from another frame, such as the raw rows behind ``df``.
    """
    ranged = with_range(df, order, cut_points(df, order, ranges) if cuts is None else cuts)
    # The group as one never-null column: NULL keys match themselves, and the join below
    # can keep the partitioning of the window instead of shuffling the rows again.
    group = ["_group"] if by else []
    if by:
        ranged = ranged.withColumn("_group", F.struct(*by))
    position = F.desc if descending else F.asc
    inside = (
        Window.partitionBy(*group, _RANGE)
        .orderBy(position(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    expressions = {name: F.col(e) if isinstance(e, str) else e for name, e in sums.items()}
    totals = ranged.groupBy(*group, _RANGE).agg(
        *[F.sum(e).alias(f"_total_{name}") for name, e in expressions.items()]
    )
    offsets = _before_each_range(totals, group, list(expressions), descending)
    local = ranged.select(
        "*", *[F.sum(e).over(inside).alias(f"_inside_{name}") for name, e in expressions.items()]
    )
    # Without groups the offsets are one row a range: a safe broadcast.
    joined = local.join(offsets if by else F.broadcast(offsets), [*group, _RANGE])
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_inside_{name}") + F.col(f"_before_{name}")).alias(name)
            for name in expressions
        ],
    )


def row_index(
    df: DataFrame, order: str, by: Sequence[str] = (), name: str = "row_index"
) -> DataFrame:
    """Dense position 0, 1, 2, ... in the order of a unique column."""
    counted = ordered_cumsum(df, order, {name: F.lit(1)}, by)
    return counted.withColumn(name, (F.col(name) - 1).cast("long"))


def sliding(
    df: DataFrame,
    index: str,
    before: int,
    after: int,
    expressions: Mapping[str, object],
    by: Sequence[str] = (),
    block_rows: int = 65_536,
) -> DataFrame:
    """Row-frame aggregates over a dense index, in parallel blocks.

    Each row is sent to its own block and, near an edge, to the neighbour whose
    frames reach it, so no block needs rows of another one. ``expressions`` maps a
    new column to a function of a window specification factory ``rows(a, b)``.
    """
    block = lambda shift: F.floor((F.col(index) + F.lit(shift)) / F.lit(block_rows))
    spread = df.withColumn("_own", block(0)).withColumn(
        "_block", F.explode(F.sequence(block(-after), block(before)))
    )
    base = Window.partitionBy(*by, "_block").orderBy(index)
    rows = lambda a, b: base.rowsBetween(a, b)
    framed = spread.select("*", *[make(rows).alias(name) for name, make in expressions.items()])
    return framed.where(F.col("_own") == F.col("_block")).drop("_own", "_block")


def keep_extreme(
    df: DataFrame, keys: Sequence[str], order: str, latest: bool = False
) -> DataFrame:
    """All rows holding the lowest (or highest) order value of their group, ties kept.

    The same rows as RANK() = 1, but built from a combinable aggregate and a join
    on (keys, value): a hot group never has to be sorted by one task.
    """
    best = df.groupBy(*keys).agg((F.max if latest else F.min)(order).alias(order))
    return join_null_safe(df, best, [*keys, order], "left_semi")


def best_of_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, parts: int | None = None
) -> DataFrame:
    """The first ``k`` rows of each group in each of ``parts`` sets of input tasks.

    A task keeps its own first ``k`` rows of a group before it sends them, and all of them go to one
    set, so that the number of rows left does not grow with the number of tasks.
    """
    if parts is None:
        parts = 8 * (math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1)
    window = Window.partitionBy(*keys, "_set").orderBy(*order)
    sets = df.withColumn("_set", F.pmod(F.spark_partition_id(), F.lit(parts)))
    return sets.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_set", "_rank")


def best_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", parts: int | None = None
) -> DataFrame:
    """The first ``k`` rows of each group with their rank: a top-k that is merged in two levels.

    A group with most of the rows meets its last task as ``parts * k`` rows at most.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    best = best_of_parts(df, keys, order, k, parts)
    return best.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


#: Relative rank error of the sketch that brackets a quantile is one over this.
_SKETCH = 4_096
#: Distinct values a single task may rank; larger brackets are split into ranges.
_TASK_ROWS = 5_000_000


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Linearly interpolated quantiles, exact, with only the answers on the driver.

    Scan 1 is a sketch that brackets every wanted position between two values; scan 2
    counts the rows between brackets and the distinct values inside them, which is all
    that has to be shuffled (about one row in a thousand per quantile). ``percentile``
    would instead gather every distinct value in one buffer.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    reach = 2.0 / _SKETCH
    asked = sorted({min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-reach, reach)})
    row = values.agg(
        F.percentile_approx("v", asked, _SKETCH).alias("at"), F.count("v").alias("n")
    ).first()
    total = row["n"]
    if total == 0:
        raise ValueError(f"No values in {column}.")
    sketch = dict(zip(asked, row["at"], strict=True))
    spots = [p * (total - 1) for p in probabilities]
    wanted = sorted({int(math.floor(s)) for s in spots} | {int(math.ceil(s)) for s in spots})

    brackets: list[list[float]] = []
    for p in sorted(set(probabilities)):
        low = -math.inf if p <= reach else sketch[p - reach]
        high = math.inf if p >= 1 - reach else sketch[p + reach]
        if brackets and low <= brackets[-1][1]:
            brackets[-1][1] = max(brackets[-1][1], high)
        else:
            brackets.append([low, high])
    found = _ranked_values(values, brackets, wanted)
    if len(found) < len(wanted):  # the sketch missed: rank every value instead
        found = _ranked_values(values, [[-math.inf, math.inf]], wanted)
    return [
        found[int(math.floor(s))]
        + (found[int(math.ceil(s))] - found[int(math.floor(s))]) * (s - math.floor(s))
        for s in spots
    ]


def _ranked_values(
    values: DataFrame, brackets: Sequence[Sequence[float]], wanted: Sequence[int]
) -> dict[int, float]:
    """Values at the wanted positions, as far as they lie inside the closed brackets."""
    cuts = []
    for low, high in brackets:
        cuts += [low, math.nextafter(high, math.inf)]
    opening = 0 if cuts[0] == -math.inf else 1  # parity of the ranges that are brackets
    inside = F.col(_RANGE) % 2 == opening
    counted = (
        with_range(values, "v", [c for c in cuts if math.isfinite(c)])
        .groupBy(_RANGE, F.when(inside, F.col("v")).alias("v"))
        .agg(F.count("*").alias("n"))
        .persist()
    )
    try:
        sizes = {
            r[_RANGE]: (r["n"], r["k"])
            for r in counted.groupBy(_RANGE)
            .agg(F.sum("n").alias("n"), F.count("*").alias("k"))
            .collect()
        }
        targets, start, position = [], 0, 0
        for range_id in sorted(sizes):
            end = start + sizes[range_id][0]
            while position < len(wanted) and wanted[position] < end:
                if range_id % 2 == opening:
                    targets.append((wanted[position], range_id, wanted[position] - start))
                position += 1
            start = end
        if not targets:
            return {}
        largest = max(k for _, k in sizes.values())
        bracketed = counted.where(inside & F.col(_RANGE).isin(sorted({t[1] for t in targets})))
        if largest > _TASK_ROWS:
            renamed = bracketed.withColumnRenamed(_RANGE, "_bracket")
            ranked = ordered_cumsum(renamed, "v", {"upto": "n"}, by=["_bracket"])
        else:
            running = Window.partitionBy(_RANGE).orderBy("v")
            ranked = bracketed.withColumn("upto", F.sum("n").over(running)).withColumnRenamed(
                _RANGE, "_bracket"
            )
        lookup = inline_table(
            values.sparkSession, "position long, _bracket int, rank long", targets
        )
        # Two rows per requested probability.
        hits = ranked.join(F.broadcast(lookup), "_bracket").where(
            (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
        )
        return {r["position"]: r["v"] for r in hits.select("position", "v").collect()}
    finally:
        counted.unpersist()


def even_probabilities(parts: int) -> list[float]:
    """0, 1/parts, ..., 1, computed as index times step."""
    step = 1.0 / parts
    return [i * step for i in range(parts)] + [1.0]


def hash_cutoff(
    df: DataFrame, id_column: str, size: int, seed: int, rows: int | None = None
) -> tuple[str, object] | None:
    """(hash, id) of the last row of an exact hash-ordered sample, or None for all rows.

    Hashes are uniform, so the wanted one lies within a few standard deviations of its share of
    their range. One pass counts the hashes below that bracket and keeps those inside, about
    16 square roots of the sample's size. ``rows`` saves the pass that counts the rows.
    """
    rows = df.count() if rows is None else rows
    if size >= rows:
        return None
    hashed = df.select(sample_hash(id_column, seed).alias("h"), F.col(id_column).alias("i"))
    share = size / rows
    reach = 8 * math.sqrt(share * (1 - share) / rows) + 8 / rows
    # Repeated ids are no uniform draws; should the bracket miss, the whole range is one.
    for low, high in ((share - reach, share + reach), (0.0, 1.0)):
        found = _kth_hash(hashed, size, max(low, 0.0), min(high, 1.0))
        if found is not None:
            return found
    raise ValueError(f"{id_column} has fewer than {size} rows.")


def _kth_hash(hashed: DataFrame, k: int, low: float, high: float) -> tuple[str, object] | None:
    """The k-th row by (hash, id) when it lies between two shares of the range of hashes."""
    place = F.conv(F.substring("h", 1, 12), 16, 10).cast("long")
    first, last = int(low * 16**12), math.ceil(high * 16**12)
    inside = place >= first
    counted = (
        hashed.where(place <= last)
        .groupBy(F.when(inside, F.col("h")).alias("h"), F.when(inside, F.col("i")).alias("i"))
        .agg(F.count("*").alias("n"))
    )
    running = Window.orderBy(F.col("h").asc_nulls_first(), "i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counted.withColumn("upto", F.sum("n").over(running)).where(F.col("upto") >= k)
    found = reached.orderBy("upto").limit(1).collect()
    return (found[0]["h"], found[0]["i"]) if found and found[0]["h"] is not None else None


def sample_hash(id_column: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")))


def hash_sample(
    df: DataFrame, id_column: str, size: int, seed: int, rows: int | None = None
) -> DataFrame:
    """Exactly ``min(size, rows)`` rows, the same ones on every run and layout."""
    if size <= 0:
        return df.where(F.lit(False))
    cutoff = hash_cutoff(df, id_column, size, seed, rows)
    if cutoff is None:
        return df
    h, last_hash, last_id = sample_hash(id_column, seed), *cutoff
    return df.where((h < last_hash) | ((h == last_hash) & (F.col(id_column) <= last_id)))
