"""Ordering primitives against plain Python, with groups holding most of the rows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.functions import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one group holds nine in ten."""
    pick = random.Random(7)
    data = [(i, "hot" if pick.random() < 0.9 else f"g{i % 5}", pick.randint(1, 9)) for i in range(3_000)]
    pick.shuffle(data)
    return data, spark.createDataFrame(data, "id long, g string, x int").repartition(7)


def test_running_sums_by_group(skewed):
    data, df = skewed
    got = {
        r["id"]: r["s"]
        for r in ordered.ordered_cumsum(df, "id", {"s": "x"}, by=["g"], ranges=16).collect()
    }
    sums, want = {}, {}
    for i, g, x in sorted(data):
        sums[g] = want[i] = sums.get(g, 0) + x
    assert got == want


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_scan_over_ranges_of_ranges(skewed, monkeypatch, descending):
    data, df = skewed
    monkeypatch.setattr(ordered, "_SPAN", 4)
    for by in ([], ["g"]):
        made = ordered.ordered_cumsum(df, "id", {"s": "x"}, by=by, descending=descending, ranges=60)
        got = {r["id"]: r["s"] for r in made.collect()}
        sums, want = {}, {}
        for i, g, x in sorted(data, reverse=descending):
            key = g if by else None
            sums[key] = want[i] = sums.get(key, 0) + x
        assert got == want


def test_ranges_have_no_upper_bound(spark):
    df = spark.range(20_000).select("id", F.rand(3).alias("v"))
    assert len(ordered.cut_points(df, "v", 5_000)) == 4_999


def test_running_sums_descending_without_groups(skewed):
    data, df = skewed
    got = {r["id"]: r["s"] for r in ordered.ordered_cumsum(df, "id", {"s": "x"}, descending=True).collect()}
    total, want = 0, {}
    for i, _, x in sorted(data, reverse=True):
        want[i] = total = total + x
    assert got == want


def test_sliding_blocks_equal_one_window(spark):
    df = spark.range(1_000).select(F.col("id").alias("i"), (F.col("id") * 7 % 13).cast("double").alias("x"))
    got = ordered.sliding(
        df, "i", 6, 2, {"s": lambda w: F.sum("x").over(w(-6, 2))}, block_rows=50
    ).collect()
    x = [i * 7 % 13 for i in range(1_000)]
    assert len(got) == 1_000
    assert all(r["s"] == sum(x[max(0, r["i"] - 6) : r["i"] + 3]) for r in got)


def test_small_blocks_reach_several_neighbours(spark):
    df = spark.range(60).select(F.col("id").alias("i"), F.col("id").cast("double").alias("x"))
    got = ordered.sliding(df, "i", 15, 15, {"s": lambda w: F.sum("x").over(w(-15, 15))}, block_rows=4)
    assert all(r["s"] == sum(range(max(0, r["i"] - 15), min(60, r["i"] + 16))) for r in got.collect())


def test_extremes_keep_ties_and_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 3)], "k string, v int"
    )
    low = sorted(map(tuple, ordered.keep_extreme(df, ["k"], "v").collect()), key=str)
    high = sorted(map(tuple, ordered.keep_extreme(df, ["k"], "v", latest=True).collect()), key=str)
    assert low == [("a", 1), ("b", 3), (None, 4)]
    assert high == [("a", 2), ("a", 2), ("b", 3), (None, 5)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5, 0.75, 3.0, -2.0, 1e6]), min_size=1, max_size=60),
    parts=st.integers(2, 10),
)
def test_quantiles_are_exact(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probabilities = ordered.even_probabilities(parts)
    assert ordered.exact_quantiles(df, "v", probabilities) == pytest.approx(
        list(np.quantile(values, probabilities)), abs=1e-9
    )


def test_quantiles_of_many_values(spark):
    values = np.random.default_rng(3).normal(size=5_000)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]
    assert ordered.exact_quantiles(df, "v", probabilities) == pytest.approx(
        list(np.quantile(values, probabilities))
    )


def test_hash_sample_is_exact_and_stable(spark):
    df = spark.range(5_000)
    for size in (0, 1, 777, 4_999, 5_000, 9_000):
        first = ordered.hash_sample(df, "id", size, 5)
        again = ordered.hash_sample(df.repartition(3), "id", size, 5)
        ids = {r["id"] for r in first.collect()}
        assert len(ids) == min(size, 5_000)
        assert ids == {r["id"] for r in again.collect()}


def test_samples_with_repeated_ids(spark):
    """Hashes of few ids are not uniform; the sample is exact all the same."""
    df = spark.createDataFrame([(i % 3,) for i in range(300)] + [(i,) for i in range(10, 40)], "id long")
    order = sorted((hashlib.md5(f"{r.id}:5".encode()).hexdigest(), r.id) for r in df.collect())
    for size in (1, 29, 100, 329):
        cutoff = ordered.hash_cutoff(df, "id", size, 5)
        assert tuple(cutoff) == order[size - 1]
    assert ordered.hash_cutoff(df, "id", 330, 5) is None


def test_samples_take_two_scans(spark):
    ids = spark.range(200_000).withColumnRenamed("id", "i")
    order = sorted(hashlib.md5(f"{i}:1".encode()).hexdigest() for i in range(200_000))
    for size in (1, 7_000, 199_999):
        assert ordered.hash_cutoff(ids, "i", size, 1, rows=200_000)[0] == order[size - 1]
