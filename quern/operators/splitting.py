"""Chronological splits on whole time steps, and exact negative sampling."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.ordered import hash_sample


class Boundaries(NamedTuple):
    train_end_step: int
    validation_end_step: int


def distinct_steps(df: DataFrame, step: str = "step") -> DataFrame:
    return df.select(step).where(F.col(step).isNotNull()).distinct().orderBy(step)


def _step_marks(df: DataFrame, step: str, **positions: Column) -> dict[str, int]:
    """Number of distinct steps and the steps at given 0-based positions, in one job.

    Steps are hours of the covered period, a few thousand rows at most, so the plain
    numbering is no bottleneck. A position may use the column ``n``.
    """
    whole = Window.orderBy(step)
    ordered = (
        df.select(step)
        .where(F.col(step).isNotNull())
        .distinct()
        .select(
            F.col(step).alias("s"),
            (F.row_number().over(whole) - 1).alias("i"),
            F.count("*").over(Window.partitionBy()).alias("n"),
        )
    )
    row = ordered.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        *[F.max(F.when(F.col("i") == p, F.col("s"))).alias(k) for k, p in positions.items()],
    ).first()
    return row.asDict()


def _whole(expression: Column) -> Column:
    """Integer part of a product of doubles."""
    return expression.cast("int")


def split_boundaries(
    df: DataFrame, train_fraction: float = 0.70, validation_fraction: float = 0.15, step: str = "step"
) -> Boundaries:
    """Last step of the training part and of the validation part."""
    if not (0 < train_fraction < 1 and 0 < validation_fraction < 1):
        raise ValueError("Both fractions must lie between 0 and 1.")
    if train_fraction + validation_fraction >= 1:
        raise ValueError("The fractions must leave a part for testing.")
    n = F.col("n")
    train = F.greatest(F.lit(0), _whole(n * F.lit(train_fraction)) - 1)
    both = _whole(n * F.lit(train_fraction + validation_fraction)) - 1
    marks = _step_marks(
        df, step, train=train, validation=F.least(F.greatest(train + 1, both), n - 2)
    )
    if marks["n"] < 3:
        raise ValueError("Three parts need three different time steps.")
    if marks["validation"] <= marks["train"]:
        raise ValueError("The fractions leave an empty part.")
    return Boundaries(int(marks["train"]), int(marks["validation"]))


def chronological_split(
    df: DataFrame, train_fraction: float = 0.70, validation_fraction: float = 0.15, step: str = "step"
) -> DataFrame:
    """Add ``split`` = train, validation or test; a step never falls into two parts."""
    ends = split_boundaries(df, train_fraction, validation_fraction, step)
    return with_split(df, ends, step)


def with_split(df: DataFrame, ends: Boundaries, step: str = "step") -> DataFrame:
    """The boundaries are literals: a filter on ``split`` reduces to a filter on the step."""
    return df.withColumn(
        "split",
        F.when(F.col(step) <= ends.train_end_step, "train")
        .when(F.col(step) <= ends.validation_end_step, "validation")
        .when(F.col(step).isNotNull(), "test"),
    )


def fit_calibration_split(
    train: DataFrame, calibration_fraction: float = 0.20, step: str = "step"
) -> DataFrame:
    """Add ``part``: the latest training steps are kept for probability calibration."""
    if not 0 < calibration_fraction < 1:
        raise ValueError("Calibration takes a true share of the training steps, more than none and less than all.")
    position = F.greatest(F.lit(0), _whole(F.col("n") * F.lit(1 - calibration_fraction)) - 1)
    marks = _step_marks(train, step, last=position, final=F.col("n") - 1)
    if marks["n"] < 2 or marks["last"] >= marks["final"]:
        raise ValueError("The calibration fraction leaves an empty part.")
    last = int(marks["last"])
    return train.withColumn(
        "part", F.when(F.col(step) <= last, "fit").when(F.col(step).isNotNull(), "calibration")
    )


def sample_negatives(
    df: DataFrame, ratio: int, seed: int, label: str = "is_fraud", row_id: str = "source_row_number"
) -> DataFrame:
    """All positives and exactly min(negatives, positives * ratio) negatives.

    Negatives are taken in the order of a seeded hash of their id. The last hash taken
    is found first, so the sample is one filter: no sort, no shuffle of the rows.
    """
    counts = df.agg(F.count_if(F.col(label) == 1).alias("one"), F.count_if(F.col(label) == 0).alias("zero")).first()
    negatives = hash_sample(df.where(F.col(label) == 0), row_id, counts["one"] * ratio, seed, counts["zero"])
    return df.where(F.col(label) == 1).unionByName(negatives)


def class_balance_weights(df: DataFrame, label: str = "is_fraud", name: str = "weight") -> DataFrame:
    """Add rows / (2 * rows of the class)."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    total = (F.col("n0") + F.col("n1")).cast("double")
    pairs = F.array(
        *[
            F.struct(F.lit(v).cast(df.schema[label].dataType).alias(label),
                     F.try_divide(total, 2 * F.col(f"n{v}")).alias(name))
            for v in (0, 1)
        ]
    )
    weights = counts.select(F.explode(pairs).alias("w")).select("w.*")  # always two rows
    return df.join(F.broadcast(weights), label)


def split_summary(df: DataFrame, label: str = "is_fraud", step: str = "step") -> DataFrame:
    """Rows and fraud rates overall and per part, and the part boundaries, as one row."""
    part = lambda name: F.col("split") == name
    names = ("train", "validation", "test")
    return df.agg(
        F.count("*").alias("source_rows"),
        *[F.count_if(part(p)).alias(f"{p}_rows") for p in names],
        F.max(F.when(part("train"), F.col(step))).alias("train_end_step"),
        F.max(F.when(part("validation"), F.col(step))).alias("validation_end_step"),
        F.avg(F.col(label).cast("double")).alias("overall_fraud_rate"),
        *[
            F.avg(F.when(part(p), F.col(label).cast("double"))).alias(f"{p}_fraud_rate")
            for p in names
        ],
    )
