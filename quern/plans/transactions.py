"""Transaction contract, features, splits, policy, metrics and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.ordered import even_probabilities
from quern.operators import contract, features, monitoring, policy, scoring, splitting
from quern.plans.registry import oracle, register, rounded

COSTS = policy.Costs(capacity_per_day=20)
THRESHOLD = 0.5

# ---- contract ------------------------------------------------------------------

_ALL = ", ".join(contract.SOURCE_COLUMNS)
_TYPES = ", ".join(f"'{t}'" for t in contract.TRANSACTION_TYPES)
_FLAGGED = {
    "numbered": f"SELECT *, row_number() OVER (PARTITION BY {_ALL} ORDER BY source_row_number) AS copy FROM txn_source",
    "flagged": "SELECT * EXCLUDE (copy), concat_ws('|', "
    + ", ".join(
        f"CASE WHEN {condition} THEN '{reason}' END"
        for reason, condition in {
            "missing_required_value": " OR ".join(f"{c} IS NULL" for c in contract.SOURCE_COLUMNS),
            "invalid_step": "step < 1",
            "invalid_transaction_type": f"NOT coalesce(type IN ({_TYPES}), FALSE)",
            "invalid_amount": "amount < 0",
            "invalid_balance": " OR ".join(f"{c} < 0" for c in contract.BALANCES),
            "invalid_fraud_label": "NOT coalesce(isFraud IN (0, 1), FALSE)",
            "invalid_flag_label": "NOT coalesce(isFlaggedFraud IN (0, 1), FALSE)",
            "invalid_origin_id": "NOT coalesce(regexp_full_match(nameOrig, 'C[0-9]+'), FALSE)",
            "invalid_destination_id": "NOT coalesce(regexp_full_match(nameDest, '[CM][0-9]+'), FALSE)",
            "duplicate_source_row": "copy > 1",
        }.items()
    )
    + ") AS rejection_reason FROM numbered",
}
_RENAMED = ", ".join(f"{c} AS {contract.CANONICAL_NAMES.get(c, c)}" for c in contract.SOURCE_COLUMNS)


@register(
    "assert_source_columns",
    oracle("txn_source", select="SELECT count(*) AS source_rows FROM txn_source"),
)
def _(b):
    contract.assert_source_columns(b["txn_source"])
    return b["txn_source"].agg(F.count("*").alias("source_rows"))


@register(
    "validate_transactions",
    oracle("txn_source", steps=_FLAGGED, select=f"SELECT source_row_number, rejection_reason, {_ALL} FROM flagged WHERE rejection_reason <> ''"),
)
def _(b):
    return contract.validate_transactions(b["txn_source"]).rejected


@register(
    "validate_transactions_accepted",
    oracle("txn_source", steps=_FLAGGED, select=f"SELECT source_row_number, {_RENAMED} FROM flagged WHERE rejection_reason = ''".replace(
        "isFraud AS", "CAST(isFraud AS TINYINT) AS").replace("isFlaggedFraud AS", "CAST(isFlaggedFraud AS TINYINT) AS")),
)
def _(b):
    return contract.validate_transactions(b["txn_source"]).accepted


@register(
    "quality_summary",
    oracle("txn_source", steps=_FLAGGED, select="SELECT count(*) AS source_rows, count(*) FILTER (WHERE rejection_reason = '') AS accepted_rows, "
           "count(*) FILTER (WHERE rejection_reason <> '') AS rejected_rows, count(*) FILTER (WHERE rejection_reason = '' AND isFraud = 1) "
           "AS fraud_rows, count(*) FILTER (WHERE rejection_reason = '' AND isFlaggedFraud = 1) AS flagged_rows FROM flagged"),
)
def _(b):
    return contract.validate_transactions(b["txn_source"]).summary


@register(
    "rejection_reason_counts",
    oracle("txn_source", steps=_FLAGGED, select="SELECT reason, count(*) AS rejected FROM (SELECT unnest(string_split(rejection_reason, '|')) "
           "AS reason FROM flagged WHERE rejection_reason <> '') GROUP BY 1"),
)
def _(b):
    return contract.rejection_reason_counts(contract.validate_transactions(b["txn_source"]).rejected)


@register(
    "duplicate_source_rows",
    oracle("txn_source", steps=_FLAGGED, select="SELECT source_row_number, copy > 1 AS is_duplicate FROM numbered"),
)
def _(b):
    flagged = contract.duplicate_source_rows(b["txn_source"], contract.SOURCE_COLUMNS)
    return flagged.select("source_row_number", "is_duplicate")


@register("canonical_names", oracle("txn_source", select=f"SELECT source_row_number, {_RENAMED} FROM txn_source"))
def _(b):
    return contract.canonical_names(b["txn_source"])


@register(
    "rejected_payload_json",
    oracle("txn_source", steps=_FLAGGED, select="SELECT CAST(7 AS BIGINT) AS ingestion_id, source_row_number, rejection_reason, "
           f"{_ALL} FROM flagged WHERE rejection_reason <> ''"),
)
def _(b):
    rejected = contract.validate_transactions(b["txn_source"]).rejected
    types = ", ".join(f"{name} {kind}" for name, kind in rejected.select(*contract.SOURCE_COLUMNS).dtypes)
    payload = F.from_json("source_payload", types).alias("payload")
    audit = contract.rejected_payload_json(rejected, 7)
    return audit.select("ingestion_id", "source_row_number", "rejection_reason", payload).select(
        "ingestion_id", "source_row_number", "rejection_reason", "payload.*"
    )


_PRINTED = ("step", "type", "amount", "name_orig", "name_dest", "old_balance_orig", "old_balance_dest", "is_fraud")
# Engines print doubles differently, so the twin compares which rows print alike, and the length.


@register(
    "row_fingerprint",
    oracle("txn", select="SELECT source_row_number, CAST(16 AS INTEGER) AS digits, min(source_row_number) OVER "
           f"(PARTITION BY {', '.join(_PRINTED)}) AS first_alike FROM txn"),
)
def _(b):
    printed = contract.row_fingerprint(b["txn"], _PRINTED)
    first = printed.groupBy("row_fingerprint").agg(F.min("source_row_number").alias("first_alike"))
    return printed.join(first, "row_fingerprint").select(
        "source_row_number", F.length("row_fingerprint").alias("digits"), "first_alike"
    )


@register(
    "duplicate_content_gate",
    oracle("txn_source", select="SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_content_rows FROM "
           f"(SELECT count(*) AS n FROM txn_source GROUP BY {_ALL})"),
)
def _(b):
    printed = contract.row_fingerprint(b["txn_source"], contract.SOURCE_COLUMNS)
    return contract.duplicate_content_rows(printed)


_NAMED = {"named": f"SELECT source_row_number, {_RENAMED} FROM txn_source"}
_CHECK_SQL = {
    **{n: t.replace("RLIKE r", "SIMILAR TO ").replace("'^", "'").replace("\\z'", "'") for n, t in contract.ACCEPTED_CHECKS.items()},
}


@register(
    "constraint_violations",
    oracle("txn_source", steps=_NAMED, select=" UNION ALL ".join(
        [f"SELECT '{n}' AS constraint_name, count(*) FILTER (WHERE NOT ({t})) AS violations FROM named" for n, t in _CHECK_SQL.items()]
        + [f"SELECT '{c} not null', count(*) FILTER (WHERE {c} IS NULL) FROM named" for c in ("type", "amount")]
        + ["SELECT 'line unique', count(*) - count(DISTINCT source_row_number) FROM named",
           "SELECT 'origin known', count(*) FROM named WHERE name_orig NOT IN (SELECT name_orig FROM named WHERE step <= 24)"])),
)
def _(b):
    named = contract.canonical_names(b["txn_source"])
    return contract.constraint_violations(
        named,
        contract.ACCEPTED_CHECKS,
        required=("type", "amount"),
        unique={"line unique": ["source_row_number"]},
        references={
            "origin known": (["name_orig"], named.where(F.col("step") <= 24), ["name_orig"])
        },
    )


# ---- features and splits -------------------------------------------------------


@register(
    "staging_view",
    oracle("txn", select="SELECT *, (step - 1) // 24 AS day_index, (step - 1) % 24 AS hour_of_day FROM txn"),
)
def _(b):
    return features.staging_view(b["txn"])


_FEATURES = (
    "SELECT type, step, (step - 1) % 24 AS hour_of_day, (step - 1) // 24 AS day_index, round(amount, 6) AS amount, "
    "round(ln(1 + amount), 6) AS log_amount, round(old_balance_orig, 6) AS old_balance_orig, "
    "round(old_balance_dest, 6) AS old_balance_dest, round(amount / greatest(old_balance_orig, 1e0), 6) AS amount_to_orig_balance, "
    "round(amount / greatest(old_balance_dest, 1e0), 6) AS amount_to_dest_balance, "
    "CAST(old_balance_orig = 0 AS INT) AS origin_balance_is_zero, CAST(old_balance_dest = 0 AS INT) AS destination_balance_is_zero, "
    "CAST(amount > old_balance_orig AS INT) AS origin_has_insufficient_balance, "
    "CAST(starts_with(name_dest, 'M') AS INT) AS destination_is_merchant, is_fraud AS label, source_row_number FROM txn"
)


@register("decision_time_features", oracle("txn", select=_FEATURES))
def _(b):
    return rounded(features.decision_time_features(b["txn"], keep=["source_row_number"]))


@register(
    "leakage_guard",
    oracle("txn", select="SELECT count(*) AS matrix_rows, 14 AS matrix_columns FROM txn"),
)
def _(b):
    matrix = features.decision_time_features(b["txn"]).drop("label")
    features.leakage_guard(matrix.columns)
    return matrix.agg(
        F.count("*").alias("matrix_rows"), F.lit(len(matrix.columns)).alias("matrix_columns")
    )


_STEPS = "SELECT step, row_number() OVER (ORDER BY step) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT step FROM {source})"
_TRAIN_AT = "greatest(0, CAST(floor(n * 7e-1) AS INT) - 1)"
_VALID_AT = f"least(greatest({_TRAIN_AT} + 1, CAST(floor(n * (7e-1 + 15e-2)) AS INT) - 1), n - 2)"
_SPLIT = {
    "scored": "SELECT *, is_fraud AS actual FROM txn",
    "steps": _STEPS.format(source="txn"),
    "ends": f"SELECT max(step) FILTER (WHERE i = {_TRAIN_AT} + 1) AS a, max(step) FILTER (WHERE i = {_VALID_AT} + 1) AS z FROM steps",
    "parts": "SELECT s.*, CASE WHEN step <= a THEN 'train' WHEN step <= z THEN 'validation' ELSE 'test' END AS split FROM scored s, ends",
}


def _scored(b):
    return b["txn"].withColumn("actual", F.col("is_fraud"))


def _parts(b):
    ends = b.once("ends", lambda b: splitting.split_boundaries(_scored(b)))
    return splitting.with_split(_scored(b), ends)


@register("distinct_steps", oracle("txn", select="SELECT DISTINCT step FROM txn"))
def _(b):
    return splitting.distinct_steps(b["txn"])


@register("chronological_split", oracle("txn", steps=_SPLIT, select="SELECT source_row_number, step, split FROM parts"))
def _(b):
    return splitting.chronological_split(_scored(b)).select("source_row_number", "step", "split")


@register(
    "fit_calibration_split",
    oracle("txn", steps={
        **_SPLIT, "train": "SELECT * FROM parts WHERE split = 'train'", "inner_steps": _STEPS.format(source="train"),
        "last": "SELECT max(step) AS last FROM inner_steps WHERE i = greatest(0, CAST(floor(n * (1 - 2e-1)) AS INT) - 1) + 1",
    }, select="SELECT source_row_number, step, CASE WHEN step <= last THEN 'fit' ELSE 'calibration' END AS part FROM train, last"),
)
def _(b):
    train = _parts(b).where(F.col("split") == "train")
    return splitting.fit_calibration_split(train).select("source_row_number", "step", "part")


@register(
    "sample_negatives",
    oracle("txn", steps={
        "negatives": "SELECT source_row_number, row_number() OVER (ORDER BY md5(CAST(source_row_number AS VARCHAR) || ':42'), source_row_number) AS r "
                     "FROM txn WHERE is_fraud = 0",
    }, select="SELECT source_row_number, is_fraud FROM txn WHERE is_fraud = 1 OR source_row_number IN (SELECT source_row_number "
              "FROM negatives WHERE r <= 5 * (SELECT count(*) FROM txn WHERE is_fraud = 1))"),
)
def _(b):
    return splitting.sample_negatives(b["txn"], 5, 42).select("source_row_number", "is_fraud")


@register(
    "class_balance_weights",
    oracle("txn", select="SELECT source_row_number, is_fraud, round(count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY is_fraud)), 6) AS weight FROM txn"),
)
def _(b):
    return rounded(
        splitting.class_balance_weights(b["txn"]).select("source_row_number", "is_fraud", "weight")
    )


@register(
    "split_summary",
    oracle("txn", steps=_SPLIT, select="SELECT count(*) AS source_rows, "
           + ", ".join(f"count(*) FILTER (WHERE split = '{p}') AS {p}_rows" for p in ("train", "validation", "test"))
           + ", max(step) FILTER (WHERE split = 'train') AS train_end_step, max(step) FILTER (WHERE split = 'validation') AS validation_end_step, "
             "round(avg(is_fraud), 6) AS overall_fraud_rate, "
           + ", ".join(f"round(avg(is_fraud) FILTER (WHERE split = '{p}'), 6) AS {p}_fraud_rate" for p in ("train", "validation", "test"))
           + " FROM parts"),
)
def _(b):
    return rounded(splitting.split_summary(_parts(b)))


# ---- policy --------------------------------------------------------------------

_VALUE = "probability * amount * 1e0 * 85e-2 - 4e0 - (1 - probability) * 12e0"


def _policy_steps(source: str, threshold: str = "5e-1") -> dict[str, str]:
    return {
        "valued": f"SELECT *, (step - 1) // 24 AS day_index, {_VALUE} AS expected_net_value FROM {source}",
        "able": f"SELECT *, probability >= {threshold} AND expected_net_value > 0 AS eligible FROM valued",
        "ranked": "SELECT *, CASE WHEN eligible THEN row_number() OVER (PARTITION BY day_index, eligible ORDER BY expected_net_value DESC, "
                  "probability DESC, source_row_number) END AS day_rank FROM able",
        "reviewed": "SELECT * EXCLUDE (day_rank), coalesce(day_rank <= 20, FALSE) AS review FROM ranked",
    }


_REVIEWED = {"scored": _SPLIT["scored"], **_policy_steps("scored")}
_TEST = {**_SPLIT, "test": "SELECT * FROM parts WHERE split = 'test'", **_policy_steps("test")}


def _reviewed(b):
    return policy.review_policy(_scored(b), THRESHOLD, COSTS)


def _reviewed_test(b):
    test = _parts(b).where(F.col("split") == "test")
    return policy.review_policy(test, THRESHOLD, COSTS)


def _validation(b):
    return _parts(b).where(F.col("split") == "validation")


@register(
    "expected_net_value",
    oracle("txn", steps=_REVIEWED, select="SELECT source_row_number, round(expected_net_value, 9) AS expected_net_value FROM valued"),
)
def _(b):
    return rounded(
        policy.with_value(_scored(b), COSTS).select("source_row_number", "expected_net_value"), 9
    )


@register(
    "capacity_top_k",
    oracle("txn", steps=_REVIEWED, select="SELECT source_row_number, day_index, CAST(day_rank AS INT) AS day_rank FROM ranked WHERE day_rank <= 20"),
)
def _(b):
    valued = policy.with_value(_scored(b), COSTS, THRESHOLD)
    return policy.capacity_top_k(valued, COSTS.capacity_per_day).select(
        "source_row_number", "day_index", "day_rank"
    )


@register(
    "review_policy",
    oracle("txn", steps=_REVIEWED, select="SELECT source_row_number, day_index, eligible, review FROM reviewed"),
)
def _(b):
    return _reviewed(b).select("source_row_number", "day_index", "eligible", "review")


_FRAUD_AMOUNT = "coalesce(sum(amount) FILTER (WHERE actual = 1), 0)"
_CAUGHT_AMOUNT = "coalesce(sum(amount) FILTER (WHERE actual = 1 AND review), 0)"


def _outcome(days: str) -> str:
    return (
        "round(no_loss - avoided + reviewed * 4e0 + fp * 12e0, 4) AS total_cost, round(avoided, 4) AS loss_avoided, "
        "round(no_loss - (no_loss - avoided + reviewed * 4e0 + fp * 12e0), 4) AS net_benefit, reviewed, tp AS true_positives, "
        "fp AS false_positives, fn AS false_negatives, tn AS true_negatives, round(CASE WHEN reviewed > 0 THEN tp / reviewed ELSE 0 END, 6) AS precision, "
        f"round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, {days} AS capacity_binding_days"
    )


_COUNTS = (
    f"{_FRAUD_AMOUNT} * 1e0 AS no_loss, {_CAUGHT_AMOUNT} * 1e0 * 85e-2 AS avoided, count(*) FILTER (WHERE review) AS reviewed, "
    "count(*) FILTER (WHERE review AND actual = 1) AS tp, count(*) FILTER (WHERE review AND actual = 0) AS fp, "
    "count(*) FILTER (WHERE NOT review AND actual = 1) AS fn, count(*) FILTER (WHERE NOT review AND actual = 0) AS tn"
)


@register(
    "evaluate_policy",
    oracle("txn", steps={
        **_REVIEWED, "t": f"SELECT {_COUNTS} FROM reviewed",
        "d": "SELECT count(*) AS days FROM (SELECT day_index FROM reviewed WHERE review GROUP BY 1 HAVING count(*) >= 20)",
    }, select=f"SELECT {_outcome('days')} FROM t, d"),
)
def _(b):
    return rounded(
        policy.evaluate_policy(_reviewed(b), COSTS),
        special={"total_cost": 4, "loss_avoided": 4, "net_benefit": 4},
    )


def _search_steps(source: str, grid_size: int, score: str = "probability") -> dict[str, str]:
    """Every threshold against every row: fine for a check, not for the operator."""
    even = even_probabilities(grid_size - 1)
    listed = "[" + ", ".join(f"{p!r}::DOUBLE" for p in even) + "]"
    return {
        "grid": f"SELECT DISTINCT t FROM (SELECT unnest({listed}) AS t UNION ALL SELECT unnest(quantile_cont({score}, {listed})) FROM {source})",
        "worth": f"SELECT source_row_number, actual, amount, {score} AS probability, (step - 1) // 24 AS day_index, "
                 f"{_VALUE.replace('probability', score)} AS expected_net_value FROM {source}",
        "tried": "SELECT t, w.*, row_number() OVER (PARTITION BY t, day_index ORDER BY expected_net_value DESC, probability DESC, "
                 "source_row_number) AS r FROM worth w JOIN grid ON probability >= t WHERE expected_net_value > 0",
        "hits": "SELECT t, day_index, count(*) AS reviewed, sum(actual) AS tp, coalesce(sum(amount) FILTER (WHERE actual = 1), 0) AS caught "
                "FROM tried WHERE r <= 20 GROUP BY 1, 2",
        "sums": "SELECT t, sum(reviewed) AS reviewed, sum(tp) AS tp, sum(caught) AS caught, count(*) FILTER (WHERE reviewed >= 20) AS days FROM hits GROUP BY 1",
        "whole": f"SELECT count(*) AS n, sum(actual) AS fraud, {_FRAUD_AMOUNT} AS fraud_amount FROM {source}",
        "searched": "SELECT g.t AS threshold, fraud_amount * 1e0 AS no_loss, coalesce(caught, 0) * 1e0 * 85e-2 AS avoided, "
                    "CAST(coalesce(reviewed, 0) AS BIGINT) AS reviewed, CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(reviewed - tp, 0) AS BIGINT) AS fp, "
                    "CAST(fraud - coalesce(tp, 0) AS BIGINT) AS fn, CAST(n - fraud - coalesce(reviewed - tp, 0) AS BIGINT) AS tn, coalesce(days, 0) AS days "
                    "FROM grid g LEFT JOIN sums s ON s.t = g.t, whole",
    }


@register(
    "threshold_search",
    oracle("txn", steps={"scored": _SPLIT["scored"], **_search_steps("scored", 201)},
           select=f"SELECT round(threshold, 9) AS threshold, {_outcome('days')} FROM searched"),
)
def _(b):
    return rounded(
        policy.threshold_search(_scored(b), COSTS, 201),
        special={"threshold": 9, "total_cost": 4, "loss_avoided": 4, "net_benefit": 4},
    )


_TENTHS = even_probabilities(20)


@register(
    "join_cross_grid",
    oracle("txn", steps={
        **_REVIEWED, "grid": "SELECT unnest([" + ", ".join(f"{p!r}::DOUBLE" for p in _TENTHS) + "]) AS threshold",
    }, select="SELECT round(threshold, 9) AS threshold, count(source_row_number) AS eligible_rows, count(source_row_number) FILTER (WHERE actual = 1) AS eligible_fraud, "
              "round(coalesce(sum(amount), 0), 4) AS eligible_amount FROM grid LEFT JOIN valued ON probability >= threshold "
              "AND expected_net_value > 0 GROUP BY grid.threshold"),
)
def _(b):
    # The grid is summed from the top down; no row meets more than one threshold.
    return rounded(
        policy.eligible_by_threshold(_scored(b), _TENTHS, COSTS),
        special={"threshold": 9, "eligible_amount": 4},
    )


@register(
    "boundary_cases_top100",
    oracle("txn", steps=_TEST, select="SELECT source_row_number, step, type, round(amount, 6) AS amount, round(probability, 6) AS probability, review "
           "FROM reviewed WHERE actual = 0 ORDER BY review DESC, probability DESC, amount DESC, source_row_number LIMIT 100"),
)
def _(b):
    cases = policy.boundary_cases(_reviewed_test(b), 100)
    return rounded(cases.select("source_row_number", "step", "type", "amount", "probability", "review"))


@register(
    "prediction_table",
    oracle("txn", steps=_TEST, select="SELECT CAST(1 AS BIGINT) AS model_run_id, source_row_number AS transaction_id, round(probability, 6) AS fraud_probability, "
           "CAST(expected_net_value AS DECIMAL(20,2)) AS expected_net_value, review AS review_decision FROM reviewed"),
)
def _(b):
    return rounded(policy.prediction_table(_reviewed_test(b), 1))


# ---- metrics -------------------------------------------------------------------


def _curve(source: str, score: str = "probability") -> dict[str, str]:
    return {
        "per_score": f"SELECT {score} AS probability, count(*) AS n, CAST(sum(actual) AS BIGINT) AS pos FROM {source} GROUP BY 1",
        "curve": "SELECT *, sum(n) OVER (ORDER BY probability DESC) AS n_upto, sum(pos) OVER (ORDER BY probability DESC) AS tp_upto, "
                 "sum(pos) OVER () AS all_pos, sum(n) OVER () AS all_n FROM per_score",
    }


_SCORED = {"scored": _SPLIT["scored"]}
_SCORED_CURVE = {**_SCORED, **_curve("scored")}
_AP = "sum(pos * tp_upto / n_upto) / sum(pos)"
_AUC = "sum((n - pos) * (tp_upto - pos / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos))"
_BEST = "(SELECT {} FROM curve WHERE tp_upto / n_upto >= 5e-1)"
_RECALL = "coalesce(" + _BEST.format("arg_min(tp_upto / all_pos, probability)") + ", 0e0)"
_AT = "coalesce(" + _BEST.format("min(probability)") + ", 1e0)"


@register("average_precision", oracle("txn", steps=_SCORED_CURVE, select=f"SELECT round({_AP}, 6) AS average_precision FROM curve"))
def _(b):
    return rounded(scoring.average_precision(_scored(b)))


@register("roc_auc", oracle("txn", steps=_SCORED_CURVE, select=f"SELECT round({_AUC}, 6) AS roc_auc FROM curve"))
def _(b):
    return rounded(scoring.roc_auc(_scored(b)))


@register(
    "precision_recall_points",
    oracle("txn", steps=_SCORED_CURVE, select="SELECT round(probability, 9) AS threshold, round(tp_upto / n_upto, 9) AS precision, "
           "round(tp_upto / all_pos, 9) AS recall FROM curve"),
)
def _(b):
    return rounded(scoring.precision_recall_points(_scored(b)), 9)


@register(
    "recall_at_precision",
    oracle("txn", steps=_SCORED_CURVE, select=f"SELECT round({_RECALL}, 6) AS recall, round({_AT}, 6) AS threshold"),
)
def _(b):
    return rounded(scoring.recall_at_precision(_scored(b), 0.5))


_BRIER = "(SELECT avg(pow(probability - actual, 2)) FROM scored)"
_EDGES = even_probabilities(10)
_ECE_BIN = " + ".join(f"CAST(probability >= {e!r}::DOUBLE AS INT)" for e in _EDGES[1:-1])
_ECE = (
    f"(SELECT sum(n * abs(y - p)) / sum(n) FROM (SELECT {_ECE_BIN} AS bin, count(*) AS n, avg(actual) AS y, avg(probability) AS p FROM scored GROUP BY 1))"
)


@register("brier_score", oracle("txn", steps=_SCORED, select=f"SELECT round({_BRIER}, 6) AS brier_score"))
def _(b):
    return rounded(scoring.brier_score(_scored(b)))


@register("calibration_error", oracle("txn", steps=_SCORED, select=f"SELECT round({_ECE}, 6) AS calibration_error"))
def _(b):
    return rounded(scoring.calibration_error(_scored(b)))


def _quantiles(source: str, bins: int = 10) -> str:
    return f"SELECT quantile_cont(probability, [{', '.join(f'{p!r}::DOUBLE' for p in even_probabilities(bins))}]) AS q FROM {source}"


@register(
    "calibration_table",
    oracle("txn", steps={
        **_SCORED, "edges": _quantiles("scored"),
        "binned": "SELECT probability, actual, CAST(list_sum([CAST(probability > e AS INT) for e in q[2:10]]) AS INT) AS bin FROM scored, edges",
    }, select="SELECT bin, count(*) AS n, round(avg(probability), 6) AS mean_probability, round(avg(actual), 6) AS observed_rate FROM binned GROUP BY 1"),
)
def _(b):
    return rounded(scoring.calibration_table(_scored(b), 10))


@register(
    "probability_metrics",
    oracle("txn", steps=_SCORED_CURVE, select=f"SELECT round({_AP}, 6) AS pr_auc, round({_AUC}, 6) AS roc_auc, round({_BRIER}, 6) AS brier_score, "
           f"round({_ECE}, 6) AS calibration_error, round({_RECALL}, 6) AS recall_at_precision, round({_AT}, 6) AS threshold_at_precision FROM curve"),
)
def _(b):
    return rounded(scoring.probability_metrics(_scored(b), 0.5))


_SEGMENTS = (
    "SELECT {segment} AS segment, count(*) AS transactions, count(*) FILTER (WHERE actual = 1) AS fraud, "
    "count(*) FILTER (WHERE review AND actual = 1) AS true_positives, count(*) FILTER (WHERE review AND actual = 0) AS false_positives, "
    "count(*) FILTER (WHERE NOT review AND actual = 1) AS false_negatives, count(*) FILTER (WHERE NOT review AND actual = 0) AS true_negatives, "
    "round(coalesce(count(*) FILTER (WHERE review AND actual = 1) / nullif(count(*) FILTER (WHERE review), 0), 0), 6) AS precision, "
    "round(coalesce(count(*) FILTER (WHERE review AND actual = 1) / nullif(count(*) FILTER (WHERE actual = 1), 0), 0), 6) AS recall "
    "FROM reviewed GROUP BY 1"
)


@register("confusion_by_segment", oracle("txn", steps=_TEST, select=_SEGMENTS.format(segment="type")))
def _(b):
    return rounded(scoring.confusion_by_segment(_reviewed_test(b), "type"))


# Amount bands, right closed.
AMOUNT_EDGES = (float("-inf"), 100.0, 1_000.0, 10_000.0, 100_000.0, float("inf"))
AMOUNT_LABELS = ("<=100", "100-1k", "1k-10k", "10k-100k", ">100k")


@register(
    "confusion_by_amount_band",
    oracle("txn", steps=_TEST, select=_SEGMENTS.format(
        segment="CASE WHEN amount <= 100 THEN '<=100' WHEN amount <= 1000 THEN '100-1k' WHEN amount <= 10000 THEN '1k-10k' "
                "WHEN amount <= 100000 THEN '10k-100k' WHEN amount > 100000 THEN '>100k' END")),
)
def _(b):
    from quern.functions.scalar import right_closed_bin

    banded = _reviewed_test(b).withColumn(
        "band", right_closed_bin("amount", AMOUNT_EDGES, AMOUNT_LABELS)
    )
    return rounded(scoring.confusion_by_segment(banded, "band"))


@register(
    "confusion_matrix",
    oracle("txn", steps=_TEST, select=" UNION ALL ".join(
        f"SELECT {a} AS actual, {r} AS review, count(*) FILTER (WHERE actual = {a} AND review = {r}) AS n FROM reviewed"
        for a in (0, 1) for r in ("FALSE", "TRUE"))),
)
def _(b):
    return scoring.confusion_matrix(_reviewed_test(b))


_SCORE_B = "((source_row_number * 104729 % 1000) / 1e3 + is_fraud * 25e-2) / 125e-2"
_TWO = {"scored": f"SELECT *, is_fraud AS actual, {_SCORE_B} AS score_b FROM txn"}


def _suffixed(steps: dict[str, str], suffix: str, keep=("scored",)) -> dict[str, str]:
    import re

    names = "|".join(n for n in steps if n not in keep)
    rename = lambda text: re.sub(rf"\b(FROM|JOIN|,) ({names})\b", rf"\1 \2_{suffix}", text)
    return {(n if n in keep else f"{n}_{suffix}"): rename(t) for n, t in steps.items()}


def _candidate(suffix: str, model: str) -> str:
    return (
        f"SELECT '{model}' AS model, round((SELECT {_AP} FROM curve_{suffix}), 6) AS validation_pr_auc, round(cost, 4) AS validation_policy_cost, "
        f"round(threshold, 9) AS selected_threshold FROM (SELECT threshold, round(no_loss - avoided + reviewed * 4e0 + fp * 12e0, 6) AS cost "
        f"FROM searched_{suffix} ORDER BY cost, threshold DESC LIMIT 1)"
    )


_CANDIDATES = {
    **_TWO,
    **_suffixed({**_search_steps("scored", 201), **_curve("scored")}, "a"),
    **_suffixed({**_search_steps("scored", 201, "score_b"), **_curve("scored", "score_b")}, "b"),
    "candidates": f"SELECT * FROM ({_candidate('a', 'score_a')}) UNION ALL SELECT * FROM ({_candidate('b', 'score_b')})",
}


def _candidates(b):
    scored = _scored(b)
    second = scored.withColumn("probability", F.expr(_SCORE_B))
    table = scoring.candidate_comparison({"score_a": scored, "score_b": second}, COSTS, 201)
    return rounded(table, special={"validation_policy_cost": 4, "selected_threshold": 9})


@register("candidate_comparison", oracle("txn", steps=_CANDIDATES, select="SELECT * FROM candidates"))
def _(b):
    return _candidates(b)


@register(
    "choose_champion",
    oracle("txn", steps=_CANDIDATES, select="SELECT * FROM candidates ORDER BY validation_policy_cost, validation_pr_auc DESC, model LIMIT 1"),
)
def _(b):
    return scoring.choose_champion(_candidates(b))


# ---- monitoring ----------------------------------------------------------------

_REFERENCE = {
    "validation": "SELECT * FROM parts WHERE split = 'validation'",
    "quantiles": _quantiles("validation"),
    "cuts": "SELECT list_sort(list_distinct(q)) AS q FROM quantiles",
    "inner_cuts": "SELECT q[2:len(q) - 1] AS e FROM cuts",
    "bins": "SELECT unnest(range(0, len(e) + 1)) AS bin FROM inner_cuts",
    "ref_shares": "SELECT b.bin, greatest(count(v.step) / CAST((SELECT count(*) FROM validation) AS DOUBLE), 1e-6) AS r FROM bins b LEFT JOIN "
                  "(SELECT step, list_sum([CAST(probability >= x AS INT) for x in e]) AS bin FROM validation, inner_cuts) v ON v.bin = b.bin GROUP BY 1",
}
_PSI = "sum((greatest(c, 1e-6) - r) * ln(greatest(c, 1e-6) / r))"


@register(
    "population_stability_index",
    oracle("txn", steps={
        **_SPLIT, **_REFERENCE, "test": "SELECT * FROM parts WHERE split = 'test'",
        "shares": "SELECT s.bin, r, count(v.step) / CAST((SELECT count(*) FROM test) AS DOUBLE) AS c FROM ref_shares s LEFT JOIN "
                  "(SELECT step, list_sum([CAST(probability >= x AS INT) for x in e]) AS bin FROM test, inner_cuts) v ON v.bin = s.bin GROUP BY 1, 2",
    }, select=f"SELECT round({_PSI}, 6) AS psi FROM shares"),
)
def _(b):
    parts = _parts(b)
    test = parts.where(F.col("split") == "test")
    return rounded(monitoring.population_stability_index(_validation(b), test))


@register(
    "daily_monitoring",
    oracle("txn", steps={
        **_TEST, **_REFERENCE,
        "placed": "SELECT day_index, list_sum([CAST(probability >= x AS INT) for x in e]) AS bin FROM reviewed, inner_cuts",
        "sizes": "SELECT day_index, count(*) AS n FROM placed GROUP BY 1",
        "shares": "SELECT d.day_index, s.bin, r, count(p.bin) / CAST(d.n AS DOUBLE) AS c FROM sizes d CROSS JOIN ref_shares s LEFT JOIN placed p "
                  "ON p.day_index = d.day_index AND p.bin = s.bin GROUP BY 1, 2, 3, d.n",
        "drift": f"SELECT day_index, {_PSI} AS psi FROM shares GROUP BY 1",
        "volume": "SELECT day_index, count(*) AS transaction_count, count(*) FILTER (WHERE review) AS review_count, "
                  "count(*) FILTER (WHERE actual = 1) AS observed_fraud_count, count(*) FILTER (WHERE review AND actual = 1) AS true_positive_count, "
                  "count(*) FILTER (WHERE review AND actual = 0) AS false_positive_count, count(*) FILTER (WHERE NOT review AND actual = 1) AS false_negative_count, "
                  "round(avg(probability), 6) AS mean_probability, round(coalesce(sum(amount * 1e0 * 85e-2) FILTER (WHERE review AND actual = 1), 0), 6) "
                  "AS loss_avoided FROM reviewed GROUP BY 1",
    }, select="SELECT v.*, round(psi, 6) AS score_psi FROM volume v JOIN drift USING (day_index)"),
)
def _(b):
    return rounded(monitoring.daily_monitoring(_reviewed_test(b), _validation(b), COSTS))
