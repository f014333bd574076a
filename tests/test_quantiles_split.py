import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbtable.operators import quantiles as Q
from plumbtable.operators import sketches as S
from plumbtable.operators.quantiles import order_statistics, quantiles
from plumbtable.operators.split import train_test_split, with_folds

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]


def linear(values, p):
    s = sorted(values)
    at = (len(s) - 1) * p
    lo, hi = math.floor(at), math.ceil(at)
    return s[lo] + (s[hi] - s[lo]) * (at - lo)


def column(spark, values, parts=3):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)


def test_matches_numpy(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 10) for _ in range(5000)] + [None] * 100 + [float("nan")] * 7
    got = quantiles(column(spark, values), ["x"], PROBS)["x"]
    real = [v for v in values if v is not None and not math.isnan(v)]
    assert got == [linear(real, p) for p in PROBS]
    np.testing.assert_allclose(got, np.quantile(real, PROBS), rtol=1e-12)


@pytest.mark.parametrize("limit", [10, 500])
def test_brackets_and_refinement_stay_exact(spark, monkeypatch, limit):
    """A third of the rows share one value, and every column is treated as too large to read whole."""
    monkeypatch.setattr(Q, "SHORT_COLUMN", 0)
    monkeypatch.setattr(Q, "RESOLVE_LIMIT", limit)
    monkeypatch.setattr(S, "SKETCH_K", 50)
    monkeypatch.setattr(Q, "BRACKET_MARGIN", 0.04)
    rng = random.Random(2)
    hot = [7.0] * 4000
    values = hot + [rng.uniform(0, 100) for _ in range(6000)] + [rng.choice([1.0, 2.0]) for _ in range(2000)]
    rng.shuffle(values)
    assert quantiles(column(spark, values), ["x"], PROBS)["x"] == [linear(values, p) for p in PROBS]


@pytest.mark.parametrize("limit", [100, 1_000_000])
def test_missed_bracket_falls_back_to_the_whole_column(spark, monkeypatch, limit):
    monkeypatch.setattr(Q, "SHORT_COLUMN", 0)
    monkeypatch.setattr(Q, "RESOLVE_LIMIT", limit)
    monkeypatch.setattr(Q, "BRACKET_MARGIN", 0.0)
    monkeypatch.setattr(S, "SKETCH_K", 8)
    values = [float(i) for i in range(3000)]
    probs = [0.1, 0.37, 0.61, 0.87]
    assert quantiles(column(spark, values), ["x"], probs)["x"] == [linear(values, p) for p in probs]


def test_constant_empty_and_infinite(spark):
    df = spark.createDataFrame([(3.0, None, float("inf"))] * 4 + [(3.0, None, 1.0)] * 4, "a double, b double, c double")
    got = quantiles(df, ["a", "b", "c"], [0.25, 0.5])
    assert got["a"] == [3.0, 3.0] and got["b"] == [None, None] and got["c"][0] == 1.0
    assert quantiles(df, [], [0.5]) == {}


def test_sketch_only_is_close(spark):
    values = [float(i) for i in range(1000)]
    assert abs(quantiles(column(spark, values), ["x"], [0.5], exact=False)["x"][0] - 500) <= 2


def test_order_statistics_of_whole_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 2**42).alias("x"))
    got = order_statistics(df, ["x"], [0.5], lambda n: [(n // 2, n // 2)])["x"]
    assert got.count == 1000 and got.values == {500: float(500 * 2**42)} and got.not_above == {500: 501}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=60))
def test_any_small_column(spark, values):
    real = [v for v in values if v is not None]
    got = quantiles(column(spark, values, 2), ["x"], [0.25, 0.5])["x"]
    assert got == ([linear(real, 0.25), linear(real, 0.5)] if real else [None, None])


def rank_key(key, seed=42):
    return hashlib.md5(f"{seed}|{len(str(key))}:{key}".encode()).hexdigest()[:13], str(key)


@pytest.mark.parametrize("n", [1, 7, 101, 1000])
def test_split_is_exact_and_stable(spark, n):
    df = spark.range(n).repartition(5)
    train, test = train_test_split(df, ["id"])
    want = sorted(sorted(range(n), key=rank_key)[: math.ceil(0.2 * n)])
    assert sorted(r["id"] for r in test.collect()) == want
    assert train.count() == n - len(want)
    again = train_test_split(df.coalesce(1), ["id"])[1]
    assert sorted(r["id"] for r in again.collect()) == want
    assert sorted(r["id"] for r in train_test_split(df, ["id"], seed=7)[1].collect()) != want or n < 10


def test_split_keeps_copies_of_a_key_together(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("id"))
    train, test = train_test_split(df, ["id"], 0.3)
    assert train.join(test, "id", "left_semi").count() == 0
    assert train.count() + test.count() == 300


def test_split_of_hash_ties_goes_by_key(spark, monkeypatch):
    from plumbtable.operators import split

    monkeypatch.setattr(split, "key_digest", lambda keys, seed: F.lit("0000000000005"))
    train, test = train_test_split(spark.range(10), ["id"], 0.25)
    assert sorted(r["id"] for r in test.collect()) == [0, 1, 2] and train.count() == 7


def test_hash_cut_is_about_right(spark):
    train, test = train_test_split(spark.range(20000), ["id"], exact=False)
    assert abs(test.count() - 4000) < 300 and train.count() + test.count() == 20000


def test_split_bounds_and_empty(spark):
    with pytest.raises(ValueError):
        train_test_split(spark.range(3), ["id"], 1.0)
    train, test = train_test_split(spark.range(0), ["id"])
    assert train.count() == 0 and test.count() == 0


def test_folds_are_even(spark):
    counts = with_folds(spark.range(103), ["id"], 5).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in counts) == [0, 1, 2, 3, 4]
    assert {r["count"] for r in counts} <= {20, 21}
    with pytest.raises(ValueError):
        with_folds(spark.range(3), ["id"], 1)


def test_split_of_many_rows_matches_ranks(spark, monkeypatch):
    """Large enough for brackets from the even spread; a third of the rows share one key in the second table."""
    monkeypatch.setattr(Q, "SHORT_COLUMN", 100)
    n = 3000
    df = spark.range(n)
    test = train_test_split(df, ["id"], 0.25)[1]
    assert sorted(r["id"] for r in test.collect()) == sorted(sorted(range(n), key=rank_key)[: math.ceil(0.25 * n)])
    hot = df.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    train, test = train_test_split(hot, ["id"], 0.25)
    assert train.join(test, "id", "left_semi").count() == 0 and train.count() + test.count() == n
    keys = sorted((rank_key(r["id"]) for r in hot.collect()))
    cut = keys[math.ceil(0.25 * n) - 1]
    assert test.count() == sum(k <= cut for k in keys)


def test_bracket_between_heavy_ties_is_cut(spark, monkeypatch):
    from plumbtable.operators import quantiles as Q

    monkeypatch.setattr(Q, "RESOLVE_LIMIT", 1_000)
    df = spark.range(100_000).select(
        F.when(F.col("id") < 60_000, 0.0).when(F.col("id") >= 63_000, 1.0).otherwise((F.col("id") - 59_999) / 3_001.0).alias("x")
    )
    wide = Q._Bracket("x", 60_030, 60_030, 0.0, 1.0, 100_000)
    (tight,) = Q._shrink(df, [wide], {"x": 100_000})
    assert df.filter((F.col("x") > tight.low) & (F.col("x") < tight.high)).count() <= 1_000
    assert tight.low <= 31 / 3_001.0 <= tight.high
    assert Q.quantiles(df, ["x"], [0.6003])["x"][0] == pytest.approx(30.7 / 3_001.0, rel=0.05)
