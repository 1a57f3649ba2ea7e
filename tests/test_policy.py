import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quern.functions import ordered
from quern.operators import monitoring, policy, scoring

SCHEMA = "source_row_number long, step int, type string, amount double, probability double, actual int"


def scored(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], SCHEMA)


def test_capacity_goes_to_the_highest_value(spark):
    df = scored(spark, [(1, "T", 100.0, 0.9, 0), (1, "T", 1000.0, 0.8, 0), (1, "T", 10000.0, 0.7, 0)])
    costs = policy.Costs(1, 1.0, 1.0)
    reviewed = policy.review_policy(df, 0.5, costs)
    assert rows(reviewed, "source_row_number", "review") == [(0, False), (1, False), (2, True)]
    with pytest.raises(ValueError):
        policy.review_policy(df, 1.5, costs)


def test_cost_of_one_caught_fraud(spark):
    df = scored(spark, [(1, "T", 100.0, 0.9, 1), (1, "T", 50.0, 0.1, 0)])
    costs = policy.Costs(1, 4.0, 12.0, 1.0, 0.85)
    row = policy.evaluate_policy(policy.review_policy(df, 0.5, costs), costs).first()
    assert (row["reviewed"], row["loss_avoided"], row["total_cost"], row["net_benefit"]) == (1, 85.0, 19.0, 81.0)
    assert (row["precision"], row["recall"], row["capacity_binding_days"]) == (1.0, 1.0, 1)


def test_nothing_to_review(spark):
    df = scored(spark, [(1, "T", 1.0, 0.1, 0)])
    row = policy.evaluate_policy(policy.review_policy(df, 0.5, policy.Costs()), policy.Costs()).first()
    assert (row["reviewed"], row["precision"], row["recall"]) == (0, 0.0, 0.0)


@pytest.mark.parametrize("capacity", [1, 3, 7])
def test_search_equals_trying_every_threshold(spark, capacity):
    pick = random.Random(capacity)
    data = [
        (pick.choice([1, 2, 3, 30, 60]), "T", float(pick.choice([20, 100, 500])), pick.randrange(21) / 20, pick.randrange(2))
        for _ in range(150)
    ]
    df = scored(spark, data).persist()
    costs = policy.Costs(capacity)
    thresholds = [0.0, 0.05, 0.3, 0.33, 0.5, 0.9, 1.0]
    table = policy.threshold_search(df, costs, thresholds=thresholds)
    got = {r["threshold"]: r for r in table.collect()}
    assert sorted(got) == thresholds
    for t in thresholds:
        want = policy.evaluate_policy(policy.review_policy(df, t, costs), costs).first()
        for name in want.asDict():
            assert got[t][name] == pytest.approx(want[name]), (t, name)
    best = policy.best_threshold(table).first()
    lowest = min(r["total_cost"] for r in got.values())
    assert best["threshold"] == max(t for t, r in got.items() if r["total_cost"] == lowest)


def test_reviews_never_exceed_capacity_in_a_hot_day(spark):
    pick = random.Random(1)
    data = [(1 if i % 3 else 40, "T", pick.uniform(50, 900), pick.random(), 0) for i in range(900)]
    reviewed = policy.review_policy(scored(spark, data), 0.2, policy.Costs(25))
    per_day = reviewed.groupBy("day_index").agg(F.count_if("review").alias("n")).collect()
    assert [r["n"] for r in per_day] == [25, 25]


def test_rows_of_a_hot_day_do_not_grow_with_the_tasks(spark):
    """Sets of tasks merge their best rows, so the day's last task meets a fixed number."""
    pick = random.Random(2)
    data = [(1 if i % 10 else 40, "T", pick.uniform(50, 900), pick.random(), 0) for i in range(4_000)]
    costs, capacity, parts = policy.Costs(), 5, 4
    reached = []
    for tasks in (4, 64):
        valued = policy.with_value(scored(spark, data).repartition(tasks), costs, 0.2)
        able = valued.where("eligible")
        reached.append(ordered.best_of_parts(able, ["day_index"], policy._best_first(), capacity, parts).groupBy("day_index").count().orderBy("day_index").first()["count"])
        best = policy.capacity_top_k(valued, capacity, parts)
        plan = best._jdf.queryExecution().executedPlan().toString()
        # Ranked inside each task before either exchange.
        assert plan.count("WindowGroupLimit") == 4 and plan.count("Partial") >= 2
        got = [(r["source_row_number"], r["day_rank"]) for r in best.orderBy("day_index", "day_rank").collect()]
        want = [(r["source_row_number"], i % 5 + 1) for i, r in enumerate(x for day in (0, 1) for x in able.where(f"day_index = {day}").orderBy(*policy._best_first()).limit(5).collect())]
        assert got == want
    assert reached == [capacity * parts] * 2


def test_any_capacity_keeps_the_partial_limit(spark):
    valued = policy.with_value(scored(spark, [(1, "T", 100.0, 0.9, 0), (1, "T", 200.0, 0.9, 0)]), policy.Costs())
    plan = policy.capacity_top_k(valued, 50_000_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    assert policy.capacity_top_k(valued, 50_000_000).count() == 2


@pytest.mark.parametrize("swept", [3, 40])
def test_a_day_swept_in_parts(spark, monkeypatch, swept):
    """One hot day over many tasks gives what one task gives."""
    pick = random.Random(swept)
    data = [
        (1 if i % 20 else 30, "T", pick.choice([10.5, 33.1, 500.0, 77.7]), pick.randrange(41) / 40, pick.randrange(2))
        for i in range(600)
    ]
    df = scored(spark, data).persist()
    costs, thresholds = policy.Costs(17), [i / 10 for i in range(11)]
    table = lambda: [tuple(r) for r in policy.threshold_search(df, costs, thresholds=thresholds).collect()]
    whole = table()
    monkeypatch.setattr(policy, "_SWEPT_ROWS", swept)
    parted = table()
    assert len(parted) == len(whole) and all(a == pytest.approx(b) for a, b in zip(sorted(parted), sorted(whole), strict=True))
    at = {r[0]: r for r in parted}
    for t in (0.0, 0.3, 0.9):
        want = policy.evaluate_policy(policy.review_policy(df, t, costs), costs).first()
        assert at[t][1:] == pytest.approx(tuple(want))


def test_equal_reviews_cost_exactly_the_same(spark):
    """Thresholds that change no review tie, and the higher one is taken."""
    data = [(d, "T", 0.1 + i * 1e-7, 0.95, 1) for d in (1, 30, 60) for i in range(40)]
    data = [(d, t, a + 100, p, y) for d, t, a, p, y in data]
    table = policy.threshold_search(scored(spark, data), policy.Costs(25), thresholds=[0.1, 0.2, 0.5, 0.9])
    assert len({r["total_cost"] for r in table.collect()}) == 1
    assert policy.best_threshold(table).first()["threshold"] == 0.9


def test_perfect_ranking(spark):
    df = scored(spark, [(1, "T", 1.0, p, y) for p, y in ((0.01, 0), (0.1, 0), (0.9, 1), (0.99, 1))])
    row = scoring.probability_metrics(df, 1.0).first()
    assert (row["pr_auc"], row["roc_auc"]) == (1.0, 1.0)
    assert (row["recall_at_precision"], row["threshold_at_precision"]) == (1.0, 0.9)
    none = scoring.recall_at_precision(df.withColumn("actual", F.lit(0)), 0.5).first()
    assert tuple(none) == (0.0, 1.0)


def test_segments(spark):
    df = scored(
        spark,
        [(1, "TRANSFER", 1.0, 0.5, 1), (1, "TRANSFER", 1.0, 0.5, 0), (1, "PAYMENT", 1.0, 0.5, 1), (1, "PAYMENT", 1.0, 0.5, 0), (1, None, 1.0, 0.5, 0)],
    ).withColumn("review", F.col("type") == "TRANSFER").na.fill(False, ["review"])
    got = {r["segment"]: r for r in scoring.confusion_by_segment(df, "type").collect()}
    assert (got["TRANSFER"]["true_positives"], got["TRANSFER"]["false_positives"]) == (1, 1)
    assert got["PAYMENT"]["false_negatives"] == 1
    assert got[None]["true_negatives"] == 1
    cells = {(r["actual"], r["review"]): r["n"] for r in scoring.confusion_matrix(df).collect()}
    assert cells == {(0, False): 2, (0, True): 1, (1, False): 1, (1, True): 1}


def spread(spark, low, high, n=100):
    return spark.range(n).select((low + (high - low) * F.col("id") / (n - 1)).alias("probability"))


def test_stability_index(spark):
    whole = spread(spark, 0.0, 1.0)
    psi = lambda a, b: monitoring.population_stability_index(a, b).first()["psi"]
    assert psi(whole, whole) == pytest.approx(0.0, abs=1e-12)
    assert psi(spread(spark, 0.0, 0.2), spread(spark, 0.8, 1.0)) > 0.25
    flat = spread(spark, 0.5, 0.5)
    assert psi(flat, whole) == 0.0
    with pytest.raises(ValueError):
        psi(whole, whole.limit(0))


def test_daily_table(spark):
    df = scored(spark, [(1, "T", 100.0, 0.9, 1), (2, "T", 50.0, 0.2, 0), (25, "T", 200.0, 0.8, 1)])
    reviewed = df.withColumn("review", F.col("source_row_number") == 0)
    first = monitoring.daily_monitoring(reviewed, df, policy.Costs()).first()
    assert (first["day_index"], first["transaction_count"], first["true_positive_count"]) == (0, 2, 1)
    assert first["loss_avoided"] == pytest.approx(85.0)


def test_champion_rules(spark):
    table = spark.createDataFrame(
        [("a", 0.9, 10.0), ("b", 0.8, 5.0), ("c", 0.85, 5.0)],
        "model string, validation_pr_auc double, validation_policy_cost double",
    )
    assert scoring.choose_champion(table).first()["model"] == "c"
    assert scoring.choose_champion(table, "ranking").first()["model"] == "a"
