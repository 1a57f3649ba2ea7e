"""Ranking and calibration metrics of scored rows (probability, actual)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.ordered import even_probabilities, exact_quantiles, ordered_cumsum
from quern.functions.scalar import safe_share
from quern.operators.policy import Costs, best_threshold, threshold_search
from quern.session import written



def score_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: rows, positives, and both summed from the top score down.

    The distinct scores are counted once and written, and ranges are cut by that copy: what made
    the scores runs once.
    """
    per_score = scored.groupBy(*by, "probability").agg(
        F.count("*").alias("n"), F.sum(F.col("actual").cast("long")).alias("positives")
    )
    return ordered_cumsum(
        written(per_score, "scores"),
        "probability",
        {"n_upto": "n", "tp_upto": "positives"},
        by=by,
        descending=True,
    )


def _average_precision() -> Column:
    """Sum over scores of the recall gained times the precision there."""
    gained = F.col("positives") * F.col("tp_upto") / F.col("n_upto")
    return F.try_divide(F.sum(gained), F.sum("positives"))


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs ranked right, ties counting half."""
    negatives = F.col("n") - F.col("positives")
    above = F.col("tp_upto") - F.col("positives") / 2
    return F.try_divide(
        F.sum(negatives * above), F.sum("positives").cast("double") * F.sum(negatives)
    )


def average_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return score_curve(scored, by).groupBy(*by).agg(_average_precision().alias("average_precision"))


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return score_curve(scored, by).groupBy(*by).agg(_roc_auc().alias("roc_auc"))


def precision_recall_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score taken as threshold."""
    curve = score_curve(scored, by)
    totals = curve.groupBy(*by).agg(F.sum("positives").alias("_all"))
    joined = curve.join(totals, list(by)) if by else curve.withColumn("_all", totals.scalar())
    return joined.select(
        *by,
        F.col("probability").alias("threshold"),
        (F.col("tp_upto") / F.col("n_upto")).alias("precision"),
        F.try_divide(F.col("tp_upto").cast("double"), F.col("_all")).alias("recall"),
    )


def _best_recall(minimum: float) -> Column:
    """Lowest score still precise enough; recall only grows towards lower scores."""
    precise = F.col("tp_upto") >= F.lit(minimum) * F.col("n_upto")
    return F.min(
        F.when(precise, F.struct("probability", "tp_upto"))
    )


def recall_at_precision(scored: DataFrame, minimum: float) -> DataFrame:
    """Best recall at the wanted precision and its threshold; (0, 1) when out of reach."""
    return _recall_columns(
        score_curve(scored).agg(
            _best_recall(minimum).alias("best"), F.sum("positives").alias("positives")
        )
    ).select("recall", "threshold")


def _recall_columns(row: DataFrame) -> DataFrame:
    return row.withColumns(
        {
            "recall": safe_share(F.col("best.tp_upto"), F.col("positives")),
            "threshold": F.coalesce(F.col("best.probability"), F.lit(1.0)),
        }
    )


def brier_score(scored: DataFrame) -> DataFrame:
    return scored.agg(_brier().alias("brier_score"))


def _brier() -> Column:
    gap = F.col("probability") - F.col("actual")
    return F.avg(gap * gap)


def _edges_at_or_below(value: Column, edges: Sequence[float]) -> Column:
    return sum(((value >= F.lit(e)).cast("int") for e in edges), F.lit(0))


def _edges_below(value: Column, edges: Sequence[float]) -> Column:
    return sum(((value > F.lit(e)).cast("int") for e in edges), F.lit(0))


def _calibration_error(bins: int) -> Column:
    """Share-weighted gap over equal-width bins: sum of |bin total of (y - p)| / rows."""
    bin_of = _edges_at_or_below(F.col("probability"), even_probabilities(bins)[1:-1])
    gap = F.col("actual") - F.col("probability")
    totals = [F.abs(F.coalesce(F.sum(F.when(bin_of == i, gap)), F.lit(0.0))) for i in range(bins)]
    return F.try_divide(sum(totals[1:], totals[0]), F.count("*").cast("double"))


def calibration_error(scored: DataFrame, bins: int = 10) -> DataFrame:
    return scored.agg(_calibration_error(bins).alias("calibration_error"))


def calibration_table(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and observed rate per quantile bin (a, b]; empty bins are absent."""
    edges = exact_quantiles(scored, "probability", even_probabilities(bins))
    return (
        scored.groupBy(_edges_below(F.col("probability"), edges[1:-1]).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg("probability").alias("mean_probability"),
            F.avg(F.col("actual").cast("double")).alias("observed_rate"),
        )
        .orderBy("bin")
    )


def probability_metrics(scored: DataFrame, minimum_precision: float = 0.80) -> DataFrame:
    """Six numbers in one row: one pass over the score curve, one over the rows."""
    ranking = _recall_columns(
        score_curve(scored).agg(
            _average_precision().alias("pr_auc"),
            _roc_auc().alias("roc_auc"),
            _best_recall(minimum_precision).alias("best"),
            F.sum("positives").alias("positives"),
        )
    ).select(F.struct("pr_auc", "roc_auc", "recall", "threshold").alias("r"))
    return (
        scored.agg(_brier().alias("brier_score"), _calibration_error(10).alias("calibration_error"))
        .withColumn("r", ranking.scalar())
        .select(
            "r.pr_auc", "r.roc_auc", "brier_score", "calibration_error",
            F.col("r.recall").alias("recall_at_precision"),
            F.col("r.threshold").alias("threshold_at_precision"),
        )
    )


def confusion_by_segment(reviewed: DataFrame, segment: str) -> DataFrame:
    """Confusion counts, precision and recall per segment; NULL is a segment too."""
    fraud, seen = F.col("actual") == 1, F.col("review")
    return (
        reviewed.groupBy(F.col(segment).alias("segment"))
        .agg(
            F.count("*").alias("transactions"),
            F.count_if(fraud).alias("fraud"),
            F.count_if(seen & fraud).alias("true_positives"),
            F.count_if(seen & ~fraud).alias("false_positives"),
            F.count_if(~seen & fraud).alias("false_negatives"),
            F.count_if(~seen & ~fraud).alias("true_negatives"),
        )
        .withColumn(
            "precision",
            safe_share(F.col("true_positives"), F.col("true_positives") + F.col("false_positives")),
        )
        .withColumn("recall", safe_share(F.col("true_positives"), F.col("fraud")))
        .orderBy(F.desc("transactions"))
    )


def confusion_matrix(reviewed: DataFrame) -> DataFrame:
    """(actual, review, n) for all four cells, zero cells included."""
    cell = lambda a, r: F.count_if((F.col("actual") == a) & (F.col("review") == r))
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(r).alias("review"), cell(a, r).alias("n"))
        for a in (0, 1)
        for r in (False, True)
    ]
    return reviewed.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def choose_champion(table: DataFrame, rule: str = "cost") -> DataFrame:
    """Best candidate row: lowest cost then best ranking, or best ranking alone."""
    if rule not in ("cost", "ranking"):
        raise ValueError("rule must be 'cost' or 'ranking'.")
    ranking = [F.desc("validation_pr_auc"), "model"]
    return table.orderBy(*(["validation_policy_cost"] if rule == "cost" else []), *ranking).limit(1)


def candidate_comparison(
    scored_by_model: dict[str, DataFrame], costs: Costs, grid_size: int = 201
) -> DataFrame:
    """Per candidate: average precision, cheapest policy cost and its threshold.

    Candidates are the few declared models, each a lazy branch of one plan.
    """
    table = None
    for model, scored in scored_by_model.items():
        best = best_threshold(threshold_search(scored, costs, grid_size)).select(
            F.lit(model).alias("model"),
            average_precision(scored).scalar().alias("validation_pr_auc"),
            F.col("total_cost").alias("validation_policy_cost"),
            F.col("threshold").alias("selected_threshold"),
        )
        table = best if table is None else table.unionByName(best)
    if table is None:
        raise ValueError("There is nothing to compare without a candidate.")
    return table.orderBy("validation_policy_cost", F.desc("validation_pr_auc"))
