"""The candidates, later-period calibration, the model bundle and importances."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import logistic
from quern.functions.ordered import row_index
from quern.operators.features import CATEGORICAL_FEATURES, MODEL_FEATURES, NUMERIC_FEATURES
from quern.operators.policy import Costs, with_value
from quern.operators.scoring import average_precision
from quern.operators.splitting import class_balance_weights
from quern.session import ensure_checkpoint_dir, written

# The two declared boosted-tree candidates.
BOOSTED_CANDIDATES = (
    {"learning_rate": 0.05, "num_leaves": 31, "n_estimators": 300, "min_child_samples": 100},
    {"learning_rate": 0.03, "num_leaves": 63, "n_estimators": 500, "min_child_samples": 200},
)


def encode_features(scale: bool) -> list:
    """Stages building ``model_input``: one-hot type (unknown types are all zero) and
    the numeric features, standardised for a linear model."""
    numeric = VectorAssembler(inputCols=list(NUMERIC_FEATURES), outputCol="_numeric")
    stages = [
        StringIndexer(
            inputCols=list(CATEGORICAL_FEATURES),
            outputCols=[f"_{c}_index" for c in CATEGORICAL_FEATURES],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"_{c}_index" for c in CATEGORICAL_FEATURES],
            outputCols=[f"_{c}_onehot" for c in CATEGORICAL_FEATURES],
        ),
        numeric,
    ]
    if scale:
        stages.append(
            StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True)
        )
    stages.append(
        VectorAssembler(
            inputCols=[f"_{c}_onehot" for c in CATEGORICAL_FEATURES]
            + ["_scaled" if scale else "_numeric"],
            outputCol="model_input",
        )
    )
    return stages


_OUTPUT = {"rawPredictionCol": "_margin", "probabilityCol": "_likelihood", "predictionCol": "_class"}


def fit_logistic(train: DataFrame, label: str = "label", max_iter: int = 1_000) -> PipelineModel:
    """Class-balanced ridge logistic regression on standardised features.

    The penalty is half the squared slopes against the summed loss; the intercept is free.
    """
    encoder = Pipeline(stages=encode_features(scale=True)).fit(train)
    encoded = encoder.transform(class_balance_weights(train, label)).select(
        vector_to_array("model_input").alias("x"), F.col(label).cast("double").alias("y"), F.col("weight").alias("w")
    )
    width = len(encoder.stages[0].labelsArray[0]) + len(NUMERIC_FEATURES)
    fit = logistic.fit(written(encoded, "encoded"), width, penalty=1.0, max_iter=max_iter)
    score = logistic.LinearScore(
        inputCol="model_input", outputCol=_OUTPUT["rawPredictionCol"],
        slopes=fit.terms[1:].tolist(), offset=float(fit.terms[0]),
    )
    return PipelineModel([*encoder.stages, score])


def fit_boosted_trees(
    train: DataFrame, parameters: Mapping[str, float], label: str = "label", seed: int = 42
) -> PipelineModel:
    """Class-balanced gradient boosting; leaves become a depth, trees grow level by level."""
    ensure_checkpoint_dir(train.sparkSession)
    estimator = GBTClassifier(
        featuresCol="model_input", labelCol=label, weightCol="weight",
        stepSize=float(parameters["learning_rate"]),
        maxIter=int(parameters["n_estimators"]),
        maxDepth=math.ceil(math.log2(parameters["num_leaves"])),
        minInstancesPerNode=int(parameters["min_child_samples"]),
        maxBins=255, seed=seed, predictionCol=_OUTPUT["predictionCol"],
    )
    estimator.setRawPredictionCol(_OUTPUT["rawPredictionCol"])
    estimator.setProbabilityCol(_OUTPUT["probabilityCol"])
    stages = [*encode_features(scale=False), estimator]
    return Pipeline(stages=stages).fit(class_balance_weights(train, label))


def raw_score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``score``: the margin of a linear model, the raw probability of trees."""
    linear = hasattr(model.stages[-1], "coefficients")
    source = F.col("_margin") if linear else vector_to_array("_likelihood")[1]
    scored = model.transform(df).withColumn("score", source)
    return scored.select(*df.columns, "score")


def sigmoid_calibration(scored: DataFrame, label: str = "label") -> tuple[float, float]:
    """(A, B) of 1 / (1 + exp(A * score + B)) with Platt's smoothed targets.

    Rows without a score or a label take no part.
    """
    known = scored.where(F.col("score").isNotNull() & F.col(label).isNotNull())
    counts = known.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).first()
    high = (counts["pos"] + 1.0) / (counts["pos"] + 2.0)
    low = 1.0 / (counts["neg"] + 2.0)
    target = F.when(F.col(label) == 1, F.lit(high)).otherwise(F.lit(low))
    rows = known.select(F.array(F.col("score").cast("double")).alias("x"), target.alias("y"), F.lit(1.0).alias("w"))
    fit = logistic.fit(written(rows, "scores"), 1)
    return -float(fit.terms[1]), -float(fit.terms[0])


def calibrated(scored: DataFrame, a: float, b: float) -> DataFrame:
    """Add ``probability`` from the raw score."""
    return scored.withColumn("probability", 1 / (1 + F.exp(F.lit(a) * F.col("score") + F.lit(b))))


@dataclass(frozen=True)
class Bundle:
    """A fitted pipeline and everything needed to repeat its decisions."""

    model: PipelineModel
    name: str
    calibration: tuple[float, float]
    threshold: float
    costs: Costs
    train_end_step: int
    validation_end_step: int
    version: str = "1.0.0"
    features: tuple[str, ...] = field(default=MODEL_FEATURES)

    def metadata(self) -> dict:
        values = {k: v for k, v in self.__dict__.items() if k not in ("model", "costs")}
        return {"kind": _KIND, **values, "costs": asdict(self.costs)}


_KIND = "quern-model-bundle"


def batch_score(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Calibrated probability, expected value and eligibility of feature rows."""
    scored = calibrated(raw_score(bundle.model, df), *bundle.calibration)
    return with_value(scored.drop("score", "day_index"), bundle.costs, bundle.threshold)


def save_bundle(bundle: Bundle, folder: str) -> None:
    """Write the pipeline and its metadata record; an existing bundle is not replaced."""
    spark = SparkSession.getActiveSession()
    bundle.model.write().save(f"{folder}/model")
    record = spark.createDataFrame([(json.dumps(bundle.metadata()),)], "value string")
    record.write.mode("errorifexists").text(f"{folder}/metadata")


def load_bundle(spark: SparkSession, folder: str) -> Bundle:
    values = json.loads(spark.read.text(f"{folder}/metadata").first()["value"])
    if values.pop("kind", None) != _KIND:
        raise TypeError(f"{folder} does not hold a model bundle.")
    values["costs"] = Costs(**values["costs"])
    for name in ("calibration", "features"):
        values[name] = tuple(values[name])
    return Bundle(model=PipelineModel.load(f"{folder}/model"), **values)


def model_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importances a model carries itself: split gains, or absolute coefficients."""
    final = model.stages[-1]
    linear = hasattr(final, "coefficients")
    values = [abs(v) for v in (final.coefficients if linear else final.featureImportances).toArray()]
    types = [f"type_{v}" for v in model.stages[0].labelsArray[0]]
    names = [*types, *NUMERIC_FEATURES]
    rows = [
        (n, float(v), "absolute_coefficient" if linear else "split_gain")
        for n, v in zip(names, values, strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, method string")


def _shuffled(
    df: DataFrame, features: Sequence[str], row_id: str, seeds: Sequence[int]
) -> DataFrame:
    """Every row once per seed, with the features of its partner as ``_other_*``.

    A row at place k of one seeded order is paired with the row at place k of another. Places are
    numbered by ranges of the order, so neither a sort nor the pairing takes one task.
    """
    draw = lambda shift: F.conv(
        F.substring(F.md5(F.concat(F.col(row_id).cast("string"), F.lit(":"), (F.col("_seed") + shift).cast("string"))), 1, 15), 16, 10
    ).cast("long")
    rounds = df.withColumn("_seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    own = row_index(rounds.withColumn("_draw", draw(0)), "_draw", by=["_seed"], name="_place").drop("_draw")
    other = row_index(
        rounds.select("_seed", draw(500_000).alias("_draw"), *[F.col(c).alias(f"_other_{c}") for c in features]),
        "_draw", by=["_seed"], name="_place",
    ).drop("_draw")
    return own.join(other, ["_seed", "_place"])


def permutation_importance(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    features: Sequence[str],
    row_id: str = "source_row_number",
    label: str = "label",
    seeds: Sequence[int] = (42, 43, 44),
) -> DataFrame:
    """Average precision lost when one feature is shuffled: its mean and spread over the seeds.

    ``score`` adds a column ``score``. All rows take part, and all shuffled copies are scored
    in one pass. The spread is NULL for a single seed.
    """
    rows = written(df.select(row_id, label, *features), "rows")
    paired = written(_shuffled(rows, features, row_id, seeds), "paired")
    names, draws = F.array(*[F.lit(c) for c in ("", *features)]), F.array(*[F.lit(s) for s in seeds])
    copies = paired.withColumn("_shuffled", F.explode(names))
    mixed = copies.select(
        "_seed", "_shuffled", label,
        *[F.when(F.col("_shuffled") == c, F.col(f"_other_{c}")).otherwise(F.col(c)).alias(c) for c in features],
    )
    # Every copy of a row is grouped and sorted by its score: one number names its seed and feature there.
    width = len(features) + 1
    round_of = (F.array_position(draws, F.col("_seed")) - 1) * width + F.array_position(names, F.col("_shuffled")) - 1
    scored = score(mixed).select(round_of.cast("int").alias("_round"), F.col("score").alias("probability"), F.col(label).alias("actual"))
    # One row per seed and feature.
    table = written(average_precision(scored, by=["_round"]), "precision").select(
        draws[F.floor(F.col("_round") / width).cast("int")].alias("_seed"), names[F.col("_round") % width].alias("_shuffled"), "average_precision"
    )
    whole = table.where(F.col("_shuffled") == "").select("_seed", F.col("average_precision").alias("_whole"))
    lost = table.where(F.col("_shuffled") != "").join(whole, "_seed").withColumn("_lost", F.col("_whole") - F.col("average_precision"))
    return (
        lost.groupBy(F.col("_shuffled").alias("feature"))
        .agg(F.avg("_lost").alias("importance"), F.stddev_samp("_lost").alias("spread"))
        .withColumn("method", F.lit("permutation"))
        .orderBy(F.desc("importance"), "feature")
    )


def feature_importance(
    model: PipelineModel,
    df: DataFrame,
    row_id: str = "source_row_number",
    label: str = "label",
    seeds: Sequence[int] = (42, 43, 44),
) -> DataFrame:
    """Permutation importance of a fitted model's features over all rows."""
    return permutation_importance(df, lambda rows: raw_score(model, rows), MODEL_FEATURES, row_id, label, seeds)


def model_run_record(
    bundle: Bundle, model_run_id: int, metrics: DataFrame
) -> DataFrame:
    """One row per model version: boundaries, threshold, assumptions and metrics as JSON."""
    return metrics.limit(1).select(
        F.lit(model_run_id).cast("long").alias("model_run_id"),
        F.lit(bundle.name).alias("model_name"),
        F.lit(bundle.version).alias("model_version"),
        F.lit(bundle.train_end_step).alias("train_end_step"),
        F.lit(bundle.validation_end_step).alias("validation_end_step"),
        F.lit(bundle.threshold).alias("probability_threshold"),
        F.lit(bundle.costs.capacity_per_day).alias("review_capacity_per_day"),
        F.lit(json.dumps(asdict(bundle.costs))).alias("assumptions"),
        F.to_json(F.struct(*metrics.columns)).alias("metrics"),
    )
