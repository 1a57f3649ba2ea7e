"""Properties of fitted models; the numbers themselves depend on the solver."""

import math

import pytest
from pyspark.sql import functions as F

from quern.operators import features, models, policy, scoring


@pytest.fixture(scope="module")
def matrix(spark):
    """280 rows in which large amounts are fraud."""
    source = spark.range(280).select(
        F.col("id").alias("source_row_number"),
        (F.col("id") % 48 + 1).cast("int").alias("step"),
        F.element_at(F.array(*[F.lit(t) for t in ("CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")]), (F.col("id") % 4 + 1).cast("int")).alias("type"),
        (F.col("id") * 7919 % 10_000).cast("double").alias("amount"),
        F.concat(F.lit("M"), F.col("id")).alias("name_dest"),
        (F.col("id") * 31 % 5_000).cast("double").alias("old_balance_orig"),
        (F.col("id") * 17 % 5_000).cast("double").alias("old_balance_dest"),
        (F.col("id") * 7919 % 10_000 > 8_000).cast("int").alias("is_fraud"),
    )
    return features.decision_time_features(source, keep=["source_row_number"]).persist()


@pytest.mark.parametrize("kind", ["linear", "trees"])
def test_round_trip(spark, matrix, tmp_path, kind):
    train, held = matrix.where("source_row_number < 200"), matrix.where("source_row_number >= 200")
    if kind == "linear":
        model = models.fit_logistic(train, max_iter=30)
    else:
        model = models.fit_boosted_trees(
            train, {"learning_rate": 0.3, "num_leaves": 4, "n_estimators": 3, "min_child_samples": 2}
        )
    calibration = models.sigmoid_calibration(models.raw_score(model, train))
    assert calibration[0] < 0  # higher scores mean higher probability
    bundle = models.Bundle(model, kind, calibration, 0.5, policy.Costs(), 30, 40)
    folder = str(tmp_path / kind)
    models.save_bundle(bundle, folder)
    loaded = models.load_bundle(spark, folder)
    assert loaded.metadata() == bundle.metadata()
    scored = models.batch_score(held, loaded).withColumn("actual", F.col("label"))
    assert scored.count() == 80
    assert scored.where("probability BETWEEN 0 AND 1").count() == 80
    prevalence = held.agg(F.avg("label")).first()[0]
    assert scoring.average_precision(scored).first()[0] > prevalence + 0.3
    importance = models.feature_importance(model, held).collect()
    assert {r["feature"] for r in importance} == set(features.MODEL_FEATURES)
    assert importance[0]["feature"] in ("amount", "log_amount", "amount_to_orig_balance", "amount_to_dest_balance")
    own = models.model_importance(model, held)
    assert own.where("importance < 0").count() == 0
    record = models.model_run_record(loaded, 3, scoring.brier_score(scored)).first()
    assert (record["model_name"], record["train_end_step"]) == (kind, 30)


def test_unknown_type_is_all_zero(matrix):
    model = models.fit_logistic(matrix.where("type <> 'DEBIT'"), max_iter=5)
    assert models.raw_score(model, matrix.where("type = 'DEBIT'")).where("score IS NOT NULL").count() == 70


def test_foreign_folder_is_refused(spark, tmp_path):
    folder = str(tmp_path / "other")
    spark.createDataFrame([("{}",)], "value string").write.text(f"{folder}/metadata")
    with pytest.raises(TypeError):
        models.load_bundle(spark, folder)


def test_depth_of_the_declared_candidates():
    depths = [math.ceil(math.log2(c["num_leaves"])) for c in models.BOOSTED_CANDIDATES]
    assert depths == [5, 6]


def test_importance_of_a_known_score(spark):
    """Only features the score uses lose precision; every row keeps a partner's value of the same column."""
    rows = [(i, i % 2, i % 2, (i * 7919) % 50, i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "source_row_number long, label int, key int, noise int, other int").repartition(5)
    seen = []

    def score(frame):
        seen.append(frame)
        return frame.withColumn("score", F.col("key").cast("double"))

    found = {r["feature"]: r for r in models.permutation_importance(df, score, ("key", "noise", "other"), seeds=(1, 2)).collect()}
    assert found["key"]["importance"] == pytest.approx(0.5, abs=0.06) and 0 <= found["key"]["spread"] < 0.1
    assert found["noise"]["importance"] == found["other"]["importance"] == found["noise"]["spread"] == 0
    copies = seen[0]
    assert copies.count() == 2 * 4 * 600
    for c in ("key", "noise", "other"):
        counts = [copies.where(f"_shuffled = '{s}' AND _seed = 1").groupBy(c).count().orderBy(c).collect() for s in ("", c)]
        assert counts[0] == counts[1]
    moved = copies.where("_shuffled = 'noise'").groupBy("_seed").agg(F.sum(F.col("noise") * F.col("key")).alias("s")).collect()
    assert moved[0]["s"] != moved[1]["s"]


def test_every_copy_is_scored_once(spark):
    """The score of a row and copy is asked for once, whatever follows."""
    asked = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def key_of(key):
        asked.add(1)
        return float(key)

    df = spark.createDataFrame([(i, i % 2, i % 2, i % 3) for i in range(200)], "source_row_number long, label int, key int, other int")
    score = lambda frame: frame.withColumn("score", key_of("key"))
    found = {r["feature"]: r["importance"] for r in models.permutation_importance(df, score, ("key", "other"), seeds=(7, 7_000_000)).collect()}
    assert found["key"] > 0.3 and found["other"] == 0
    assert asked.value == 2 * 3 * 200
