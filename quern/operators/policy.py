"""From probabilities to review decisions under costs and a daily capacity.

Scored rows carry source_row_number, step, amount, probability and actual (0 / 1).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.ordered import best_rows, cut_points, even_probabilities, exact_quantiles, with_range
from quern.functions.scalar import safe_share
from quern.operators.features import day_index
from quern.session import written
from quern.sources.literal import inline_table


@dataclass(frozen=True)
class Costs:
    """Assumptions in currency units per transaction. The defaults."""

    capacity_per_day: int = 300
    review_cost: float = 4.0
    friction_cost: float = 12.0
    loss_rate: float = 1.0
    recovery_rate: float = 0.85

    def as_dict(self) -> dict[str, float | int]:
        return asdict(self)


def expected_net_value(costs: Costs) -> Column:
    """Loss prevented by a review, less its cost and the friction of a false alarm."""
    p = F.col("probability")
    prevented = p * F.col("amount") * F.lit(costs.loss_rate) * F.lit(costs.recovery_rate)
    return prevented - F.lit(costs.review_cost) - (1 - p) * F.lit(costs.friction_cost)


def with_value(scored: DataFrame, costs: Costs, threshold: float = 0.0) -> DataFrame:
    """Add day_index, expected_net_value and eligible (at the threshold, of positive value)."""
    if not 0 <= threshold <= 1:
        raise ValueError(f"A review threshold is a probability, not {threshold}.")
    return scored.withColumns(
        {"day_index": day_index(), "expected_net_value": expected_net_value(costs)}
    ).withColumn(
        "eligible",
        F.coalesce(
            (F.col("probability") >= threshold) & (F.col("expected_net_value") > 0), F.lit(False)
        ),
    )


#: Rows of a day that one task sweeps.
_SWEPT_ROWS = 50_000
_RANKED_BY = ("expected_net_value", "probability", "source_row_number")


def _best_first() -> list[Column]:
    return [F.desc("expected_net_value"), F.desc("probability"), F.asc("source_row_number")]


def capacity_top_k(valued: DataFrame, capacity: int, parts: int | None = None) -> DataFrame:
    """The eligible rows of highest value per day, with their ``day_rank``.

    Every task keeps its own best rows of a day, sets of tasks merge theirs, and a day's last
    task takes the best of ``parts`` sets, so a day with most rows costs no more than any other.
    """
    return best_rows(valued.where(F.col("eligible")), ["day_index"], _best_first(), capacity, "day_rank", parts)


def review_policy(scored: DataFrame, threshold: float, costs: Costs) -> DataFrame:
    """Add ``review``: eligible and among the day's best rows.

    Only the last accepted row of each day goes back to the data (one row a day), and
    each row compares itself with it. Spark sees that side's true size when it has run.
    """
    valued = with_value(scored, costs, threshold)
    sort_key = F.struct(
        (-F.col("expected_net_value")).alias("v"),
        (-F.col("probability")).alias("p"),
        F.col("source_row_number").alias("r"),
    )
    cutoffs = (
        capacity_top_k(valued.select(*_RANKED_BY, "day_index", "eligible"), costs.capacity_per_day)
        .groupBy("day_index")
        .agg(F.max(sort_key).alias("_cutoff"))
    )
    return (
        valued.join(cutoffs, "day_index", "left")
        .withColumn(
            "review", F.coalesce(F.col("eligible") & (sort_key <= F.col("_cutoff")), F.lit(False))
        )
        .drop("_cutoff")
        .select(*valued.columns, "review")
    )


def _outcome(costs: Costs) -> dict[str, Column]:
    """Totals of a policy from counts and amounts already aggregated."""
    col = F.col
    avoided = col("_caught_amount") * F.lit(costs.loss_rate) * F.lit(costs.recovery_rate)
    no_review = col("_fraud_amount") * F.lit(costs.loss_rate)
    false_positives = col("reviewed") - col("true_positives")
    cost = (
        no_review - avoided + col("reviewed") * F.lit(costs.review_cost)
        + false_positives * F.lit(costs.friction_cost)
    )
    return {
        "total_cost": cost,
        "loss_avoided": avoided,
        "net_benefit": no_review - cost,
        "reviewed": col("reviewed"),
        "true_positives": col("true_positives"),
        "false_positives": false_positives,
        "false_negatives": col("_fraud") - col("true_positives"),
        "true_negatives": col("_rows") - col("_fraud") - false_positives,
        "precision": safe_share(col("true_positives"), col("reviewed")),
        "recall": safe_share(col("true_positives"), col("_fraud")),
        "capacity_binding_days": col("capacity_binding_days"),
    }


def evaluate_policy(reviewed: DataFrame, costs: Costs) -> DataFrame:
    """Counts, money and rates of a reviewed frame as one row.

    One aggregate by day (combined before its shuffle), then a sum over days.
    """
    fraud, seen = F.col("actual") == 1, F.col("review")
    money = lambda c: F.coalesce(F.sum(F.when(c, F.col("amount"))), F.lit(0.0))
    days = reviewed.groupBy(day_index().alias("day_index")).agg(
        F.count("*").alias("_rows"),
        F.count_if(fraud).alias("_fraud"),
        F.count_if(seen).alias("reviewed"),
        F.count_if(seen & fraud).alias("true_positives"),
        money(fraud).alias("_fraud_amount"),
        money(seen & fraud).alias("_caught_amount"),
    )
    totals = days.agg(
        *[F.sum(c).alias(c) for c in days.columns if c != "day_index"],
        F.count_if(F.col("reviewed") >= costs.capacity_per_day).alias("capacity_binding_days"),
    )
    return totals.select(*[c.alias(name) for name, c in _outcome(costs).items()])


def candidate_thresholds(scored: DataFrame, grid_size: int = 201) -> list[float]:
    """Sorted union of even thresholds and score quantiles, at most 2 * grid_size numbers."""
    if grid_size < 3:
        raise ValueError("A threshold grid has three points or more.")
    even = even_probabilities(grid_size - 1)
    return sorted({*even, *exact_quantiles(scored, "probability", even)})


def eligible_by_threshold(
    scored: DataFrame, thresholds: Sequence[float], costs: Costs
) -> DataFrame:
    """Per threshold: eligible rows, their fraud and amount, capacity left aside.

    Each row is counted once, at the highest threshold it reaches; sums from the top
    down then give every threshold, so rows are never paired with thresholds.
    """
    reached = _reached(with_value(scored, costs), thresholds)
    per_level = reached.groupBy("level").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("actual") == 1).alias("fraud"),
        F.sum("amount").alias("amount"),
    )
    from_top = Window.orderBy(F.desc("level"))  # one row per threshold
    grid = _grid(scored, thresholds).join(per_level, "level", "left")
    return grid.select(
        "threshold",
        F.coalesce(F.sum("rows").over(from_top), F.lit(0)).alias("eligible_rows"),
        F.coalesce(F.sum("fraud").over(from_top), F.lit(0)).alias("eligible_fraud"),
        F.coalesce(F.sum("amount").over(from_top), F.lit(0.0)).alias("eligible_amount"),
    )


def _grid(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    rows = [(level, float(t)) for level, t in enumerate(sorted(set(thresholds)), start=1)]
    return inline_table(df.sparkSession, "level int, threshold double", rows)


def _reached(valued: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Rows of positive value with the number of thresholds they reach (``level`` >= 1)."""
    leveled = with_range(
        valued.where(F.col("expected_net_value") > 0), "probability", sorted(set(thresholds)), "level"
    )
    return leveled.where(F.col("level") >= 1)


def _places_left(capacity: int, levels: int):
    """Per-day function: for every part, best part first, the reviews each level has left for it.

    The state that parts of a day hand on is how many of their rows reach each level: a level
    is served by the first ``capacity`` of these, in whichever parts they are.
    """

    def left(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        parts = np.sort(counts["part"].unique())[::-1]
        reach = np.zeros((len(parts), levels + 1), dtype="int64")
        np.add.at(reach, (np.searchsorted(-parts, -counts["part"].to_numpy()), counts["level"].to_numpy()), counts["n"].to_numpy())
        reach = reach[:, ::-1].cumsum(axis=1)[:, ::-1]
        before = reach.cumsum(axis=0) - reach
        left = np.maximum(capacity - before, 0)[:, 1:]
        open_parts = left.any(axis=1)
        return pd.DataFrame({"day_index": key[0], "part": parts[open_parts], "left": list(left[open_parts])})

    return left


def _sweep_part(key: tuple, rows: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
    """Reviews, caught fraud and its amount at every level, of one part of a day."""
    if rows.empty or state.empty:
        return pd.DataFrame({c: [] for c in ("day_index", "level", "reviewed", "true_positives", "caught")})
    ordered = rows.sort_values(list(_RANKED_BY), ascending=[False, False, True])
    level, actual = ordered["level"].to_numpy(), ordered["actual"].to_numpy(dtype="int64")
    caught = ordered["amount"].to_numpy() * actual
    left = state["left"].iloc[0]
    found = []
    for at, places in enumerate(left, start=1):
        taken = np.flatnonzero(level >= at)[:places]
        found.append((key[0], at, len(taken), int(actual[taken].sum()), float(caught[taken].sum())))
    return pd.DataFrame(found, columns=["day_index", "level", "reviewed", "true_positives", "caught"])


def threshold_search(
    scored: DataFrame,
    costs: Costs,
    grid_size: int = 201,
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Policy outcome at every candidate threshold, cheapest first.

    Rows of one day and level are interchangeable but for their value, so beyond the
    best ``capacity`` of them none can ever be taken: that exact pruning runs before
    the shuffle and leaves at most capacity * thresholds rows a day, whatever the
    size of the day. These are cut into parts by value. Counts by level tell each part what
    better parts have left for it, and the parts are swept apart, so no day is one task.
    """
    if costs.capacity_per_day < 1:
        raise ValueError("The capacity must be at least one review a day.")
    cuts = sorted(set(thresholds)) if thresholds is not None else candidate_thresholds(scored, grid_size)
    capacity, levels = costs.capacity_per_day, len(cuts)
    able = _reached(with_value(scored, costs), cuts).select(
        *_RANKED_BY, "day_index", "level", "amount", F.col("actual").cast("int").alias("actual")
    )
    best = best_rows(able, ["day_index", "level"], _best_first(), capacity, "_rank").drop("_rank")
    best = written(best, "sweep")
    parts = -(-capacity * levels // _SWEPT_ROWS)
    split = cut_points(best, "expected_net_value", parts) if parts > 1 else []
    best = with_range(best, "expected_net_value", split, "part")
    state = best.groupBy("day_index", "part", "level").agg(F.count("*").alias("n")).groupBy("day_index").applyInPandas(
        _places_left(capacity, levels), "day_index int, part int, left array<long>"
    )
    swept = best.groupBy("day_index", "part").cogroup(state.groupBy("day_index", "part")).applyInPandas(
        _sweep_part, "day_index int, level int, reviewed long, true_positives long, caught double"
    )
    # Sums of decimals do not depend on their order, so equal reviews cost exactly the same.
    days = swept.groupBy("day_index", "level").agg(
        F.sum("reviewed").alias("reviewed"),
        F.sum("true_positives").alias("true_positives"),
        F.sum(F.col("caught").cast("decimal(38,10)")).alias("caught"),
    )
    per_level = days.groupBy("level").agg(
        F.sum("reviewed").alias("reviewed"),
        F.sum("true_positives").alias("true_positives"),
        F.sum("caught").cast("double").alias("_caught_amount"),
        F.count_if(F.col("reviewed") >= capacity).alias("capacity_binding_days"),
    )
    everything = scored.agg(
        F.struct(
            F.count("*").alias("rows"),
            F.count_if(F.col("actual") == 1).alias("fraud"),
            F.coalesce(F.sum(F.when(F.col("actual") == 1, F.col("amount"))), F.lit(0.0)).alias("amount"),
        ).alias("all")
    ).first()["all"]
    table = (
        _grid(scored, cuts)
        .join(per_level, "level", "left")
        .na.fill(0)
        .withColumns(
            {
                "_rows": F.lit(everything["rows"]),
                "_fraud": F.lit(everything["fraud"]),
                "_fraud_amount": F.lit(everything["amount"]),
            }
        )
    )
    return table.select(
        "threshold", *[c.alias(name) for name, c in _outcome(costs).items()]
    ).orderBy("total_cost", F.desc("threshold"))


def best_threshold(table: DataFrame) -> DataFrame:
    """Cheapest row of a threshold table; equal costs go to the higher threshold."""
    return table.orderBy("total_cost", F.desc("threshold")).limit(1)


def boundary_cases(reviewed: DataFrame, k: int = 100) -> DataFrame:
    """Legitimate rows the policy came closest to (or did) review."""
    return (
        reviewed.where(F.col("actual") == 0)
        .orderBy(F.desc("review"), F.desc("probability"), F.desc("amount"), "source_row_number")
        .limit(k)
    )


def prediction_table(reviewed: DataFrame, model_run_id: int) -> DataFrame:
    return reviewed.select(
        F.lit(model_run_id).cast("long").alias("model_run_id"),
        F.col("source_row_number").alias("transaction_id"),
        F.col("probability").alias("fraud_probability"),
        F.col("expected_net_value").cast("decimal(20,2)").alias("expected_net_value"),
        F.col("review").alias("review_decision"),
    )
