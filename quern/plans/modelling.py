"""Model fitting, calibration, scoring and importance queries.

Fitted trees depend on the solver, so those have no SQL twin; tests check their properties. Boosting runs few rounds here, the declared candidates remain the default.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quern.operators import contract, features, models, policy, splitting
from quern.plans.registry import oracle, register, rounded
from quern.plans.transactions import (
    _FEATURES,
    _SPLIT,
    _STEPS,
    COSTS,
    THRESHOLD,
    _reviewed_test,
)
from quern.session import scratch_path

QUICK_TREES = {"learning_rate": 0.1, "num_leaves": 8, "n_estimators": 5, "min_child_samples": 20}


def _parts(b):
    matrix = features.decision_time_features(b["txn"], keep=["source_row_number"])
    ends = splitting.split_boundaries(matrix)
    train = splitting.with_split(matrix, ends).where(F.col("split") == "train")
    inner = splitting.fit_calibration_split(train)
    fit = splitting.sample_negatives(inner.where(F.col("part") == "fit"), 20, 42, label="label")
    later = splitting.with_split(matrix, ends).where(F.col("split") == "validation")
    return ends, fit, inner.where(F.col("part") == "calibration"), later


def _bundle(b):
    ends, fit, calibration, later = _parts(b)
    model = models.fit_logistic(fit)
    a, c = models.sigmoid_calibration(models.raw_score(model, calibration))
    bundle = models.Bundle(model, "logistic_regression", (a, c), 0.01, COSTS, *ends)
    return bundle, later


# The fit part: earlier training steps, all fraud and the first hashes of the rest.
_FIT = {
    **_SPLIT,
    "train": "SELECT * FROM parts WHERE split = 'train'",
    "inner_steps": _STEPS.format(source="train"),
    "last": "SELECT max(step) AS last FROM inner_steps WHERE i = greatest(0, CAST(floor(n * (1 - 2e-1)) AS INT) - 1) + 1",
    "early": "SELECT t.* FROM train t, last WHERE step <= last",
    "hashed": "SELECT source_row_number, row_number() OVER (ORDER BY md5(CAST(source_row_number AS VARCHAR) || ':42'), source_row_number) AS r "
              "FROM early WHERE is_fraud = 0",
    "picked": "SELECT source_row_number FROM early WHERE is_fraud = 1 UNION ALL SELECT source_row_number FROM hashed "
              "WHERE r <= 20 * (SELECT count(*) FROM early WHERE is_fraud = 1)",
    "matrix": _FEATURES.replace("round(", "(").replace(", 6) AS", ") AS"),
    "fit": "SELECT m.* FROM matrix m SEMI JOIN picked USING (source_row_number)",
    "moments": "SELECT " + ", ".join(
        f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in features.NUMERIC_FEATURES) + " FROM fit",
}


@register(
    "encode_features",
    oracle("txn", steps=_FIT, select="SELECT source_row_number, "
           + ", ".join(f"CAST(type = '{t}' AS INT) AS type_{t}" for t in contract.TRANSACTION_TYPES) + ", "
           + ", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}" for c in features.NUMERIC_FEATURES)
           + " FROM matrix, moments WHERE step > (SELECT a FROM ends) AND step <= (SELECT z FROM ends)"),
)
def _(b):
    _, fit, _, later = _parts(b)
    encoder = Pipeline(stages=models.encode_features(scale=True)).fit(fit)
    vector = encoder.transform(later).select(
        "source_row_number", vector_to_array("model_input").alias("x")
    )
    types = contract.TRANSACTION_TYPES
    return rounded(
        vector.select(
            "source_row_number",
            *[F.col("x")[i].cast("int").alias(f"type_{t}") for i, t in enumerate(types)],
            *[F.col("x")[len(types) + i].alias(c) for i, c in enumerate(features.NUMERIC_FEATURES)],
        )
    )


def _margin(width: int, b: str = "b") -> str:
    return " + ".join([f"{b}[1]", *[f"{b}[{i + 1}] * x{i}" for i in range(1, width + 1)]])


def _solved(name: str, rows: str, width: int, penalty: float, rounds: int) -> dict[str, str]:
    """Newton steps over rows (x1.., y, w): sums per step, then the system by Gauss-Jordan."""
    terms = range(width + 1)
    x = lambda i: f" * x{i}" if i else ""
    sums = ", ".join(
        "[" + ", ".join([*[f"sum(w * p * (1 - p){x(i)}{x(j)}) + {penalty if i == j and i else 0:.1e}" for j in terms],
                         f"sum(w * (y - p){x(i)}) - {penalty if i else 0:.1e} * any_value(b)[{i + 1}]"]) + "]"
        for i in terms
    )
    size, wide = width + 2, width + 3
    pivots = ", ".join(f"[[{i + 1}e0]]" for i in terms)
    at = "CAST(k[1][1] AS BIGINT)"
    cell = f"CASE WHEN r = {at} THEN a[r][c] / a[{at}][{at}] ELSE a[r][c] - a[r][{at}] * a[{at}][c] / a[{at}][{at}] END"
    solved = (
        f"list_reduce(list_prepend(m, [{pivots}]), lambda a, k: list_transform(range(1, {size}), "
        f"lambda r: list_transform(range(1, {wide}), lambda c: {cell})))"
    )
    return {
        name: f"SELECT 0 AS i, [{', '.join(['0e0'] * len(terms))}] AS b UNION ALL "
        f"SELECT i + 1, list_transform(range(1, {size}), lambda q: b[q] + solved[q][{size}]) FROM (SELECT i, b, {solved} AS solved FROM ("
        f"SELECT any_value(i) AS i, any_value(b) AS b, [{sums}] AS m FROM (SELECT {name}.i, {name}.b, d.*, "
        f"1 / (1 + exp(-({_margin(width)}))) AS p FROM {rows} d, {name} WHERE {name}.i < {rounds}) HAVING count(*) > 0))",
    }


_WIDTH = len(contract.TRANSACTION_TYPES) + len(features.NUMERIC_FEATURES)
_ROUNDS = 16
_CODED = ", ".join(
    [f"CAST(type = '{t}' AS DOUBLE) AS x{i + 1}" for i, t in enumerate(contract.TRANSACTION_TYPES)]
    + [f"coalesce(({c} - {c}_m) / nullif({c}_s, 0), 0) AS x{len(contract.TRANSACTION_TYPES) + i + 1}"
       for i, c in enumerate(features.NUMERIC_FEATURES)]
)
_LOGISTIC = {
    **_FIT,
    "balance": "SELECT count(*) AS n, count_if(label = 1) AS n1 FROM fit",
    "coded": f"SELECT label AS y, n / (2e0 * CASE WHEN label = 1 THEN n1 ELSE n - n1 END) AS w, {_CODED} FROM fit, moments, balance",
    **_solved("slopes", "coded", _WIDTH, 1.0, _ROUNDS),
    "marked": f"SELECT m.*, {_CODED} FROM matrix m, moments",
    "margins": f"SELECT source_row_number, step, amount, label, {_margin(_WIDTH)} AS score FROM marked, slopes WHERE i = {_ROUNDS}",
    "later": "SELECT * FROM margins WHERE step > (SELECT a FROM ends) AND step <= (SELECT z FROM ends)",
}


@register("fit_logistic", oracle("txn", steps=_LOGISTIC, select="SELECT source_row_number, label, round(score, 6) AS score FROM later", recursive=True))
def _(b):
    _, fit, _, later = _parts(b)
    model = models.fit_logistic(fit)
    return rounded(models.raw_score(model, later).select("source_row_number", "label", "score"))


@register("fit_boosted_trees")
def _(b):
    _, fit, _, later = _parts(b)
    model = models.fit_boosted_trees(fit, QUICK_TREES)
    return models.raw_score(model, later).select("source_row_number", "label", "score")


def _newton(rounds: int) -> dict[str, str]:
    """Newton steps of the smoothed logistic fit on one score, one CTE per step."""
    steps = {
        "prior": "SELECT sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM txn",
        "aimed": "SELECT source_row_number, probability AS s, CASE WHEN is_fraud = 1 THEN (pos + 1e0) / (pos + 2e0) ELSE 1 / (neg + 2e0) END AS t "
                 "FROM txn, prior",
        "w0": "SELECT 0e0 AS w, ln(sum(t) / sum(1 - t)) AS c FROM aimed",
    }
    for i in range(rounds):
        steps[f"g{i}"] = (
            "SELECT sum(t - p) AS g0, sum((t - p) * s) AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * s) AS h01, "
            f"sum(p * (1 - p) * s * s) AS h11 FROM (SELECT s, t, 1 / (1 + exp(-(w * s + c))) AS p FROM aimed, w{i})"
        )
        steps[f"w{i + 1}"] = (
            "SELECT w + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS w, "
            f"c + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS c FROM w{i}, g{i}"
        )
    return steps


@register(
    "sigmoid_calibration",
    oracle("txn", steps=_newton(10), select="SELECT source_row_number, round(1 / (1 + exp(-(w * s + c))), 4) AS probability FROM aimed, w10"),
)
def _(b):
    scored = b["txn"].select(
        "source_row_number", F.col("is_fraud").alias("label"), F.col("probability").alias("score")
    )
    fitted = models.calibrated(scored, *models.sigmoid_calibration(scored))
    return rounded(fitted.select("source_row_number", "probability"), 4)


_SCORED = {
    **_LOGISTIC,
    "held": "SELECT m.* FROM margins m, last WHERE step > last AND step <= (SELECT a FROM ends)",
    "masses": "SELECT count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM held",
    "targets": "SELECT score AS x1, 1e0 AS w, CASE WHEN label = 1 THEN (pos + 1e0) / (pos + 2e0) ELSE 1 / (neg + 2e0) END AS y FROM held, masses",
    **_solved("curve", "targets", 1, 0.0, _ROUNDS),
    "chances": f"SELECT l.*, 1 / (1 + exp(-(b[1] + b[2] * score))) AS probability FROM later l, curve WHERE i = {_ROUNDS}",
    "valued": f"SELECT *, probability * amount * {COSTS.loss_rate} * {COSTS.recovery_rate} - {COSTS.review_cost} "
              f"- (1 - probability) * {COSTS.friction_cost} AS expected_net_value FROM chances",
}


@register(
    "batch_score",
    oracle("txn", steps=_SCORED, recursive=True,
           select="SELECT source_row_number, round(amount, 6) AS amount, round(probability, 6) AS probability, "
                  "round(expected_net_value, 4) AS expected_net_value, probability >= 1e-2 AND expected_net_value > 0 AS eligible FROM valued"),
)
def _(b):
    bundle, later = _bundle(b)
    scored = models.batch_score(later, bundle)
    return rounded(
        scored.select("source_row_number", "amount", "probability", "expected_net_value", "eligible"), special={"expected_net_value": 4}
    )


@register(
    "save_load_bundle",
    oracle("txn", steps=_SCORED, recursive=True, select="SELECT source_row_number, round(probability, 6) AS probability FROM chances"),
)
def _(b):
    bundle, later = _bundle(b)
    folder = scratch_path(b.spark, "bundle")
    models.save_bundle(bundle, folder)
    loaded = models.load_bundle(b.spark, folder)
    return rounded(models.batch_score(later, loaded).select("source_row_number", "probability"))


@register("model_run_record")
def _(b):
    bundle, _ = _bundle(b)
    metrics = policy.evaluate_policy(_reviewed_test(b), COSTS).withColumn(
        "threshold", F.lit(THRESHOLD)
    )
    return models.model_run_record(bundle, 1, metrics)


_FIXED = ("amount", "origin_balance_is_zero", "destination_is_merchant", "hour_of_day")
_FIXED_SCORE = "4 * CAST(amount > 50 AS INT) + 2 * destination_is_merchant + origin_balance_is_zero"
_SEEDS = (42, 43, 44)
_PLACED = ("CAST('0x' || substr(md5(CAST(source_row_number AS VARCHAR) || ':' || CAST(seed + {shift} AS VARCHAR)), 1, 15) AS BIGINT)")
_IMPORTANCE = {
    **_SPLIT,
    "matrix": _FEATURES.replace("round(", "(").replace(", 6) AS", ") AS"),
    "later": "SELECT * FROM matrix WHERE step > (SELECT a FROM ends) AND step <= (SELECT z FROM ends)",
    "rounds": f"SELECT l.*, seed FROM later l, (SELECT unnest({list(_SEEDS)}) AS seed)",
    "own": "SELECT *, row_number() OVER (PARTITION BY seed ORDER BY " + _PLACED.format(shift=0) + ") AS place FROM rounds",
    "other": "SELECT seed, " + ", ".join(f"{c} AS other_{c}" for c in _FIXED) + ", row_number() OVER (PARTITION BY seed ORDER BY "
             + _PLACED.format(shift=500000) + ") AS place FROM rounds",
    "copies": "SELECT seed, shuffled, label, " + ", ".join(f"CASE WHEN shuffled = '{c}' THEN other_{c} ELSE {c} END AS {c}" for c in _FIXED)
              + " FROM own JOIN other USING (seed, place), (SELECT unnest(['', " + ", ".join(f"'{c}'" for c in _FIXED) + "]) AS shuffled)",
    "counted": f"SELECT seed, shuffled, {_FIXED_SCORE} AS score, count(*) AS n, sum(label) AS y FROM copies GROUP BY 1, 2, 3",
    "summed": "SELECT *, sum(n) OVER w AS upto, sum(y) OVER w AS tp FROM counted WINDOW w AS (PARTITION BY seed, shuffled ORDER BY score DESC)",
    "precision": "SELECT seed, shuffled, sum(y * tp / CAST(upto AS DOUBLE)) / sum(y) AS ap FROM summed GROUP BY 1, 2",
    "lost": "SELECT p.shuffled, w.ap - p.ap AS lost FROM precision p JOIN precision w ON p.seed = w.seed AND w.shuffled = '' AND p.shuffled <> ''",
}


@register(
    "feature_importance",
    oracle("txn", steps=_IMPORTANCE, select="SELECT shuffled AS feature, round(avg(lost), 6) + 0e0 AS importance, "
           "round(stddev_samp(lost), 6) AS spread, 'permutation' AS method FROM lost GROUP BY 1"),
)
def _(b):
    """The features of a fixed score, so that the shuffling itself can be compared."""
    *_, later = _parts(b)
    score = lambda rows: rows.withColumn("score", F.expr(_FIXED_SCORE).cast("double"))
    return rounded(models.permutation_importance(later, score, _FIXED, seeds=_SEEDS)).withColumn(
        "importance", F.col("importance") + F.lit(0.0)
    )


@register("feature_importance_fitted")
def _(b):
    bundle, later = _bundle(b)
    return models.feature_importance(bundle.model, later)


@register("model_importance")
def _(b):
    bundle, later = _bundle(b)
    return models.model_importance(bundle.model, later)
