import math

import numpy as np
import pandas as pd
import pytest
from conftest import NUMERIC, by
from pyspark.sql import functions as F

from plumbtable.operators import profile as P
from plumbtable.operators.categories import category_difference, category_frequencies, category_shares, sorted_distinct
from plumbtable.operators.encode import FeatureEncoder, FeatureEncoderModel, category_positions, sparse_one_hot
from plumbtable.operators.reduce import principal_components
from plumbtable.plans.features import prepare_features, run_complete_workflow
from plumbtable.session import fresh_path


@pytest.fixture
def frame(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(5, 2, 400), "b": rng.uniform(0, 1, 400), "c": 1.5})
    pdf["d"] = pdf["a"] * 2 + rng.normal(0, 0.1, 400)
    pdf.loc[::7, "b"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double, d double")
    return df.repartition(3), pdf


def test_describe_matches_pandas(frame):
    df, pdf = frame
    got = by(P.describe(df, ["a", "b", "c"]), "column")
    for c in ("a", "b", "c"):
        want = pdf[c].describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[theirs], rel=1e-9, abs=1e-12)
        assert got[c]["skewness"] == pytest.approx(pdf[c].skew(), rel=1e-9, abs=1e-12)
        assert got[c]["kurtosis"] == pytest.approx(pdf[c].kurt(), rel=1e-9, abs=1e-12)


def test_correlation_matches_pandas(frame):
    df, pdf = frame
    got = {(r["x"], r["y"]): r["r"] for r in P.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    want = pdf[["a", "b", "c", "d"]].corr()
    for (x, y), r in got.items():
        if math.isnan(want.loc[x, y]):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[x, y], rel=1e-9)
    assert len(got) == 16
    assert [(r["x"], r["y"]) for r in P.correlated_pairs(df, ["a", "b", "c", "d"], 0.9).collect()] == [("a", "d")]


def test_histogram_matches_numpy(frame):
    df, pdf = frame
    got = P.histogram(df, "a").orderBy("bin").collect()
    counts, edges = np.histogram(pdf["a"], bins=30)
    assert [r["count"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["lower"] for r in got], edges[:-1], rtol=1e-9)
    constant = P.histogram(df, "c").filter("count > 0").collect()
    assert len(constant) == 1 and constant[0]["count"] == 400


def test_density_is_the_kernel_sum(frame):
    df, pdf = frame
    exact = {round(r["x"], 9): r["density"] for r in P.density(df, "a", grid=50).collect()}
    h = pdf["a"].std() * 400 ** (-0.2)
    for x, d in exact.items():
        want = np.exp(-0.5 * ((x - pdf["a"]) / h) ** 2).sum() / (400 * h * math.sqrt(2 * math.pi))
        assert d == pytest.approx(want, rel=1e-6)
    assert P.density(df, "c").count() == 0
    with pytest.raises(ValueError):
        P.density(df, "a", grid=1)


def test_box_stats(frame):
    df, pdf = frame
    got = by(P.box_stats(df, ["a"]), "column")["a"]
    q1, q3 = pdf["a"].quantile(0.25), pdf["a"].quantile(0.75)
    inside = pdf["a"][(pdf["a"] >= q1 - 1.5 * (q3 - q1)) & (pdf["a"] <= q3 + 1.5 * (q3 - q1))]
    assert (got["whisker_low"], got["whisker_high"]) == (inside.min(), inside.max())
    assert got["outliers"] == 400 - len(inside)


def test_null_table_and_invalid(mini):
    got = P.null_table(mini).collect()
    assert [r["column"] for r in got][:2] == ["X1", "X3"] and got[0]["null_percent"] == 11.11
    bad = by(P.invalid_entries(mini, mini.columns), "column")
    assert bad["X4"]["invalid_count"] == 9 and bad["X2"]["invalid_count"] == 0
    assert bad["X6"]["invalid_percent"] == 100.0 and "X1" not in bad


def test_column_profile(mini):
    got = by(P.column_profile(mini), "column")
    assert got["X6"]["distinct_count"] == 4 and got["X6"]["examples"] == "A; B; C; Z"
    assert got["X1"]["null_count"] == 1 and got["X1"]["examples"].startswith("-100.0000; 10.0000")
    assert got["X8"]["dtype"] == "int" and got["X8"]["examples"] == "1; 2; 3; 4"


def test_profile_of_an_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    got = by(P.column_profile(df), "column")["b"]
    assert (got["distinct_count"], got["null_count"], got["examples"]) == (0, 2, None)


def test_describe_text_and_minmax(mini):
    got = by(P.describe_text(mini, ["X6"]), "column")["X6"]
    assert (got["count"], got["unique"], got["top"], got["freq"]) == (9, 4, "A", 4)
    assert by(P.min_max(mini, ["X1"]), "column")["X1"]["max"] == 1000.0


def test_pair_bins_cover_all_rows(mini):
    got = P.pair_bins(mini, NUMERIC, "X5", bins=4)
    per_pair = {(r["x"], r["y"]): r["n"] for r in got.groupBy("x", "y").agg(F.sum("count").alias("n")).collect()}
    assert len(per_pair) == 6 and per_pair[("X5", "X7")] == 9 and per_pair[("X1", "X3")] == 7


def test_audit(mini):
    rows = P.audit_counts(mini, {"x1": F.col("X1") > 0, "x6": F.col("X6") == "A"}).collect()
    assert [(r["step"], r["rows_before"], r["rows_after"]) for r in rows] == [("x1", 9, 7), ("x6", 7, 4)]


def test_category_tables(mini):
    got = by(category_frequencies(mini, "X6"), "X6")
    assert got["A"]["count"] == 4 and got["A"]["share"] == pytest.approx(4 / 9)
    shares = category_shares(mini, ["X6", "X8"]).collect()
    assert sum(r["share"] for r in shares if r["column"] == "X8") == pytest.approx(1.0)
    assert [r["X6"] for r in sorted_distinct(mini, "X6").collect()] == ["A", "B", "C", "Z"]
    assert [r["X6"] for r in category_difference(mini, mini.filter("X6 <> 'C'"), "X6").collect()] == ["C"]


def test_encoder(spark):
    train = spark.createDataFrame([(0.0, 5.0, 2.0, "u"), (10.0, 5.0, 3.0, "v"), (4.0, 5.0, 4.0, "w")], "x double, k double, c double, y string")
    model = FeatureEncoder(["x", "k"], ["c"]).fit(train)
    assert model.feature_names == ["x", "k", "c_3", "c_4"]
    out = model.transform(train).orderBy("x").collect()
    assert [tuple(r) for r in out] == [(0.0, 0.0, 0.0, 0.0, "u"), (0.4, 0.0, 0.0, 1.0, "w"), (1.0, 0.0, 1.0, 0.0, "v")]
    new = spark.createDataFrame([(20.0, 6.0, 9.0), (None, 5.0, None)], "x double, k double, c double")
    rows = model.transform(new).collect()
    assert tuple(rows[0]) == (2.0, 1.0, 0.0, 0.0) and tuple(rows[1]) == (None, 0.0, 0.0, 0.0)
    path = fresh_path(spark, "encoder")
    model.write().overwrite().save(path)
    assert FeatureEncoderModel.load(path).transform(train).exceptAll(model.transform(train)).count() == 0


def test_wide_domains_become_sparse_vectors(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "k string")
    positions = category_positions(df.filter("k IS NULL OR k <> 'c'"), "k")
    got = {r["k"]: tuple(r["hot"]) for r in sparse_one_hot(df, "k", positions, "hot").collect()}
    assert got == {"a": (1, [], []), "b": (1, [0], [1.0]), None: (1, [], []), "c": (1, [], [])}


def test_encoder_keeps_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1.0, "0", 5), (3.0, "1", 6)], "X_1 double, X string, X__1 int")
    model = FeatureEncoder(["X_1"], ["X"]).fit(df)
    out = model.transform(df)
    assert out.columns == ["X_1", "X___1", "X__1"] and model.feature_names == ["X_1", "X___1"]
    assert sorted(map(tuple, out.collect())) == [(0.0, 0.0, 5), (1.0, 1.0, 6)]


def test_prepared_features_fit_on_train_only(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("c"), F.lit(1.0).alias("y"))
    sets = prepare_features(df, ["x"], ["c"], ["y"], keys=["id"], keep=["id"])
    lo, hi = sets.train.agg(F.min("x"), F.max("x")).first()
    assert (lo, hi) == (0.0, 1.0) and sets.test.count() == 20 and sets.prepared().count() == 100
    assert sets.features == ["x", "c_1", "c_2"]


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 0, 0], [1, 1, 0], [0, 0, 0.2]]) + 10
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    scores, ratios = principal_components(df, ["a", "b", "c"], keep=["id"])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    np.testing.assert_allclose(ratios, values[::-1][:2] / values.sum(), rtol=1e-9)
    want = np.abs((x - x.mean(0)) @ vectors[:, ::-1][:, :2])
    got = np.array([[abs(r["pc1"]), abs(r["pc2"])] for r in scores.orderBy("id").collect()])
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_complete_workflow(spark):
    raw = spark.range(200).select(
        F.when(F.col("id") % 20 == 0, "error").otherwise(F.col("id").cast("string")).alias("x"),
        (F.col("id") % 4).cast("string").alias("c"),
        (F.col("id") * 2).cast("string").alias("y"),
        F.lit("junk").alias("mixed"),
    )
    home = fresh_path(spark, "workflow")
    sets = run_complete_workflow(spark, raw, home, ["x", "y"], ["c"], ["x"], ["c"], ["y"], ["mixed"])
    assert sets.train.count() == 160 and sets.test.count() == 40
    assert sets.train.columns == ["x", "c_1", "c_2", "c_3", "y"]


def test_domains_beyond_the_bound_are_refused(spark):
    from plumbtable.operators.encode import learn_domains

    df = spark.createDataFrame([(str(k), k % 3) for k in range(30)], "wide string, small int")
    assert learn_domains(df, ["small"], most=3) == {"small": [0, 1, 2]}
    with pytest.raises(ValueError, match="wide.*sparse_one_hot"):
        learn_domains(df, ["small", "wide"], most=3)
