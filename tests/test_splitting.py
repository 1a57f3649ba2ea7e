import pytest
from conftest import rows
from pyspark.sql import functions as F

from quern.operators import splitting


def steps(spark, n, repeat=2):
    return spark.range(n * repeat).select(
        F.col("id").alias("source_row_number"), (F.col("id") % n + 1).cast("int").alias("step"),
        (F.col("id") % 10 == 0).cast("int").alias("is_fraud"),
    )


def test_parts_are_ordered_and_disjoint(spark):
    df = splitting.chronological_split(steps(spark, 6), 0.5, 0.25)
    spans = {r["split"]: (r["a"], r["z"]) for r in df.groupBy("split").agg(F.min("step").alias("a"), F.max("step").alias("z")).collect()}
    assert spans["train"][1] < spans["validation"][0] <= spans["validation"][1] < spans["test"][0]


def test_boundaries_use_double_arithmetic(spark):
    assert splitting.split_boundaries(steps(spark, 720, 1)) == (503, 612)


def test_bad_requests(spark):
    for fractions in ((0.0, 0.2), (0.7, 0.3), (0.5, 1.0)):
        with pytest.raises(ValueError):
            splitting.split_boundaries(steps(spark, 6), *fractions)
    with pytest.raises(ValueError):
        splitting.split_boundaries(steps(spark, 2), 0.5, 0.25)
    with pytest.raises(ValueError):
        splitting.fit_calibration_split(steps(spark, 1))


def test_calibration_is_later(spark):
    df = splitting.fit_calibration_split(steps(spark, 10), 0.2)
    assert df.where("part = 'fit'").agg(F.max("step")).first()[0] == 8
    assert df.where("part = 'calibration'").agg(F.min("step")).first()[0] == 9


def test_exact_negative_sample(spark):
    df = steps(spark, 100, 10)
    for ratio, negatives in ((0, 0), (3, 300), (50, 900)):
        got = splitting.sample_negatives(df, ratio, 42)
        assert got.where("is_fraud = 1").count() == 100
        assert got.where("is_fraud = 0").count() == negatives


def test_weights_balance(spark):
    df = splitting.class_balance_weights(steps(spark, 10))
    assert rows(df.groupBy("is_fraud").agg(F.round(F.sum("weight"), 9))) == [(0, 10.0), (1, 10.0)]
