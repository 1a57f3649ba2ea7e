"""The logistic fit against a plain Newton loop, and its odd inputs."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quern.functions import logistic
from quern.operators import models

_ROWS = "x array<double>, y double, w double"


def plain(x, y, w, penalty):
    """All rows at once, fifty undamped steps."""
    x = np.column_stack([np.ones(len(x)), x])
    ridge = np.diag([0.0] + [penalty] * (x.shape[1] - 1))
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ b)))
        b = b - np.linalg.solve((x.T * (w * p * (1 - p))) @ x + ridge, x.T @ (w * (p - y)) + ridge @ b)
    return b


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3)) * [1, 10, 0.01]
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1.5, -0.2, 30] - 1)))).astype(float)
    return x, y, rng.random(500) + 0.5


def table(spark, x, y, w, parts=7):
    rows = [(a.tolist(), float(b), float(c)) for a, b, c in zip(x, y, w, strict=True)]
    return spark.createDataFrame(rows, _ROWS).repartition(parts)


@pytest.mark.parametrize("penalty", [0.0, 1.0])
def test_equals_a_plain_newton_loop(spark, data, penalty):
    found = logistic.fit(table(spark, *data), 3, penalty)
    assert found.converged and found.steps < 15
    assert found.terms == pytest.approx(plain(*data, penalty), rel=1e-8)


def test_gradient_and_curvature_are_derivatives(spark, data):
    rows, at = table(spark, *data), np.array([0.1, -0.3, 0.05, 2.0])
    loss, gradient, curvature = logistic.moments(rows, at)
    for i in range(4):
        step = np.zeros(4)
        step[i] = 1e-5
        up, low = (logistic.moments(rows, at + s) for s in (step, -step))
        assert (up[0] - low[0]) / 2e-5 == pytest.approx(gradient[i], rel=1e-5)
        assert (up[1] - low[1]) / 2e-5 == pytest.approx(curvature[i], rel=1e-4, abs=1e-3)
    assert loss > 0


def test_repeated_rows_and_weights_say_the_same(spark, data):
    x, y, _ = data
    twice = logistic.fit(table(spark, np.vstack([x, x]), np.tile(y, 2), np.ones(1000)), 3, 1.0)
    heavy = logistic.fit(table(spark, x, y, np.full(500, 2.0)), 3, 1.0)
    assert twice.terms == pytest.approx(heavy.terms, rel=1e-9)


def test_collinear_columns_share_the_slope(spark, data):
    x, y, w = data
    alone = logistic.fit(table(spark, x[:, :1], y, w), 1)
    both = logistic.fit(table(spark, x[:, [0, 0]], y, w), 2)
    assert both.terms[1] == pytest.approx(both.terms[2], rel=1e-8)
    assert both.terms[1] + both.terms[2] == pytest.approx(alone.terms[1], rel=1e-8)


def test_far_separated_classes_need_the_penalty(spark):
    x, y = np.array([[-1000.0], [-999.0], [999.0], [1000.0]]), np.array([0.0, 0, 1, 1])
    found = logistic.fit(table(spark, x, y, np.ones(4)), 1, 1.0)
    assert np.isfinite(found.terms).all() and found.terms[1] > 0


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0]])
def test_one_class_has_no_fit(spark, y):
    with pytest.raises(ValueError, match="both classes"):
        logistic.fit(spark.createDataFrame([([1.0], v, 1.0) for v in y], _ROWS), 1)


def test_iteration_limit(spark, data):
    found = logistic.fit(table(spark, *data), 3, max_iter=2)
    assert not found.converged and found.steps == 2


def test_stage_is_saved_with_its_pipeline(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, -4.0)], "a double, b double")
    encoder = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(df)
    score = logistic.LinearScore(inputCol="v", outputCol="margin", slopes=[0.5, 2.0], offset=-1.0)
    model = PipelineModel([*encoder.stages, score])
    model.save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert loaded.stages[-1].coefficients.toArray().tolist() == [0.5, 2.0] and loaded.stages[-1].intercept == -1.0
    got = loaded.transform(df)
    assert got.columns == ["a", "b", "v", "margin"]
    assert [r["margin"] for r in got.orderBy("a").collect()] == [3.5, -7.5]


def test_calibration_leaves_out_unknown_rows(spark):
    rows = [(float(i % 7), int(i % 7 + i % 3 > 4)) for i in range(90)]
    known = spark.createDataFrame(rows, "score double, label int")
    odd = known.unionByName(spark.createDataFrame([(None, 1), (2.0, None)], known.schema))
    assert models.sigmoid_calibration(odd) == pytest.approx(models.sigmoid_calibration(known), rel=1e-9)
    assert models.calibrated(known, *models.sigmoid_calibration(known)).where(F.col("probability").between(0, 1)).count() == 90
