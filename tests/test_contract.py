import pytest
from conftest import rows
from pyspark.sql import functions as F

from quern.operators import contract, features

SCHEMA = (
    "source_row_number long, step int, type string, amount double, nameOrig string, oldbalanceOrg double, "
    "newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int"
)
FOUR = [
    (2, 1, "PAYMENT", 10.0, "C1", 100.0, 90.0, "M1", 0.0, 0.0, 0, 0),
    (3, 2, "TRANSFER", 500.0, "C2", 300.0, 0.0, "C10", 100.0, 600.0, 1, 0),
    (4, 25, "CASH_OUT", 400.0, "C3", 0.0, 0.0, "C11", 200.0, 600.0, 1, 0),
    (5, 26, "DEBIT", 20.0, "C4", 50.0, 30.0, "C12", 30.0, 50.0, 0, 0),
]


def changed(row, **values):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return tuple(values.get(n, v) for n, v in zip(names, row))


def test_clean_rows_are_accepted(spark):
    result = contract.validate_transactions(spark.createDataFrame(FOUR, SCHEMA))
    assert rows(result.summary) == [(4, 4, 0, 2, 0)]
    assert [r[0] for r in rows(result.accepted, "source_row_number")] == [2, 3, 4, 5]
    assert dict(result.accepted.dtypes)["is_fraud"] == "tinyint"
    assert result.rejected.count() == 0


def test_bad_amount_and_copy_are_rejected(spark):
    data = [changed(FOUR[0], amount=-1.0), *FOUR[1:], changed(FOUR[1], source_row_number=6)]
    result = contract.validate_transactions(spark.createDataFrame(data, SCHEMA))
    assert rows(result.rejected, "source_row_number", "rejection_reason") == [
        (2, "invalid_amount"), (6, "duplicate_source_row"),
    ]
    assert rows(result.rejected.where("source_row_number = 2"), "amount") == [(-1.0,)]


def test_reasons_keep_their_order(spark):
    data = [
        changed(FOUR[0], type=None), changed(FOUR[1], amount=None),
        changed(FOUR[2], step=0, type="WIRE", nameOrig="X1", nameDest="C1\n"),
        changed(FOUR[3], isFraud=2, isFlaggedFraud=None, newbalanceDest=-1.0),
    ]
    flagged = contract.flag_transactions(spark.createDataFrame(data, SCHEMA))
    assert [r[1] for r in rows(flagged, "source_row_number", "rejection_reason")] == [
        "missing_required_value|invalid_transaction_type",
        "missing_required_value",
        "invalid_step|invalid_transaction_type|invalid_origin_id|invalid_destination_id",
        "missing_required_value|invalid_balance|invalid_fraud_label|invalid_flag_label",
    ]


def test_hot_group_of_copies(spark):
    """A third of all rows are one and the same row, NULL included."""
    hot = changed(FOUR[0], type=None)
    data = [changed(hot, source_row_number=i) for i in range(2, 102)]
    data += [changed(FOUR[1], source_row_number=i, amount=float(i)) for i in range(102, 302)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    flagged = contract.duplicate_source_rows(df, contract.SOURCE_COLUMNS)
    assert flagged.where("is_duplicate").count() == 99
    assert rows(flagged.where("NOT is_duplicate AND type IS NULL"), "source_row_number") == [(2,)]


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="lacks.*isFraud"):
        contract.assert_source_columns(spark.createDataFrame(FOUR, SCHEMA).drop("isFraud"))
    with pytest.raises(ValueError, match="adds.*extra"):
        contract.assert_source_columns(
            spark.createDataFrame(FOUR, SCHEMA).withColumn("extra", F.lit(1))
        )


def test_content_gate(spark):
    accepted = contract.validate_transactions(spark.createDataFrame(FOUR, SCHEMA)).accepted
    columns = [c for c in accepted.columns if c != "source_row_number"]
    printed = contract.row_fingerprint(accepted, columns)
    assert all(len(r[0]) == 16 for r in printed.select("row_fingerprint").collect())
    contract.duplicate_content_gate(printed)
    with pytest.raises(RuntimeError, match="4 rows"):
        contract.duplicate_content_gate(printed.union(printed))


def test_features_of_the_four_rows(spark):
    accepted = contract.validate_transactions(spark.createDataFrame(FOUR, SCHEMA)).accepted
    matrix = features.decision_time_features(accepted, keep=["source_row_number"])
    assert tuple(matrix.columns[:14]) == features.MODEL_FEATURES
    got = rows(matrix, "source_row_number", "destination_is_merchant", "origin_has_insufficient_balance", "day_index")
    assert got == [(2, 1, 0, 0), (3, 0, 1, 0), (4, 0, 1, 1), (5, 0, 0, 1)]
    features.leakage_guard(matrix.columns[:14])
    with pytest.raises(ValueError, match="new_balance_orig"):
        features.leakage_guard([*features.MODEL_FEATURES, "new_balance_orig"])
    with pytest.raises(ValueError, match="lacks"):
        features.decision_time_features(accepted.drop("type"))


def test_fingerprints_tell_rows_apart(spark):
    made = [(1, 1.001, "p", "q|r"), (2, 1.004, "p", "q|r"), (3, 1.001, "p|q", "r"), (4, 1e19, None, "N"), (5, 1e19, "N", None),
            (6, 0.0, "1:a", ""), (7, -0.0, "1:a", ""), (8, 0.0, "~", None)]
    df = spark.createDataFrame(made, "source_row_number long, v double, a string, b string")
    printed = contract.row_fingerprint(df, ["v", "a", "b"])
    found = {r["source_row_number"]: r["row_fingerprint"] for r in printed.collect()}
    assert found[6] == found[7] and len(set(found.values())) == 7
    assert contract.duplicate_content_rows(printed).first()[0] == 1


def test_patterns_end_with_the_text(spark):
    df = spark.createDataFrame([("C1",), ("C1\n",), ("M2",)], "name_orig string")
    rule = {"name_orig pattern": contract.ACCEPTED_CHECKS["name_orig pattern"]}
    assert rows(contract.constraint_violations(df, rule)) == [("name_orig pattern", 2)]


def test_replaced_files_are_read_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    for values in ([(2, "a"), (3, "a"), (4, "b")], [(2, "a"), (3, "b"), (4, "b")]):
        spark.createDataFrame(values, "source_row_number long, v string").coalesce(1).write.mode("overwrite").parquet(path)
        flagged = contract.duplicate_source_rows(spark.read.parquet(path), ["v"])
        later = [k for k, v in values if any(w == v and j < k for j, w in values)]
        assert rows(flagged.where("is_duplicate").select("source_row_number")) == [(k,) for k in later]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
