"""Score drift and the daily monitoring table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.ordered import even_probabilities, exact_quantiles
from quern.operators.features import day_index
from quern.operators.policy import Costs

#: Smallest share a bin is given, so that the logarithm stays finite.
_FLOOR = 1e-6


class ReferenceBins:
    """Quantile bins of reference scores; at most ``bins`` edges and shares."""

    def __init__(self, reference: DataFrame, column: str = "probability", bins: int = 10):
        edges = sorted(set(exact_quantiles(reference, column, even_probabilities(bins))))
        self.column = column
        self.inner: Sequence[float] = edges[1:-1]
        self.usable = len(edges) >= 3
        self.shares: list[float] = []
        if self.usable:
            row = reference.agg(*self.counts()).first()
            total = sum(row)
            self.shares = [max(n / total, _FLOOR) for n in row]

    def counts(self) -> list[Column]:
        """Rows per bin [a, b); the outer bins are open-ended."""
        value = F.col(self.column)
        bin_of = sum(((value >= F.lit(e)).cast("int") for e in self.inner), F.lit(0))
        return [F.count_if(bin_of == i).alias(f"_bin{i}") for i in range(len(self.inner) + 1)]

    def index(self) -> Column:
        """Stability index from the bin counts of an aggregated frame."""
        if not self.usable:
            return F.lit(0.0)
        names = [F.col(f"_bin{i}") for i in range(len(self.shares))]
        total = sum(names[1:], names[0])
        result = F.lit(0.0)
        for count, share in zip(names, self.shares, strict=True):
            current = F.greatest(F.try_divide(count.cast("double"), total), F.lit(_FLOOR))
            result = result + (current - F.lit(share)) * F.ln(current / F.lit(share))
        return result


def population_stability_index(
    reference: DataFrame, current: DataFrame, column: str = "probability", bins: int = 10
) -> DataFrame:
    """Drift of ``current`` against the quantile bins of ``reference``, as one row."""
    if current.isEmpty():
        raise ValueError("The current scores are empty.")
    cut = ReferenceBins(reference, column, bins)
    counted = current.agg(*cut.counts()) if cut.usable else current.agg(F.count("*").alias("n"))
    return counted.select(cut.index().alias("psi"))


def daily_monitoring(reviewed: DataFrame, reference: DataFrame, costs: Costs) -> DataFrame:
    """Volume, decisions, outcomes, avoided loss and drift per day, in one aggregate."""
    cut = ReferenceBins(reference)
    fraud, seen = F.col("actual") == 1, F.col("review")
    avoided = F.col("amount") * F.lit(costs.loss_rate) * F.lit(costs.recovery_rate)
    days = reviewed.groupBy(day_index().alias("day_index")).agg(
        F.count("*").alias("transaction_count"),
        F.count_if(seen).alias("review_count"),
        F.count_if(fraud).alias("observed_fraud_count"),
        F.count_if(seen & fraud).alias("true_positive_count"),
        F.count_if(seen & ~fraud).alias("false_positive_count"),
        F.count_if(~seen & fraud).alias("false_negative_count"),
        F.avg("probability").alias("mean_probability"),
        F.coalesce(F.sum(F.when(seen & fraud, avoided)), F.lit(0.0)).alias("loss_avoided"),
        *(cut.counts() if cut.usable else []),
    )
    kept = [c for c in days.columns if not c.startswith("_bin")]
    return days.select(*kept, cut.index().alias("score_psi")).orderBy("day_index")
