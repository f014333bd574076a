import pytest
from conftest import CATEGORICAL, MINI_ROWS, MINI_SCHEMA, NUMERIC, by, ids
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plumbtable.functions.columns import clamp, currency_to_number
from plumbtable.operators import categories as cat
from plumbtable.operators import outliers
from plumbtable.operators.categories import CategoricalCleaner, filter_valid_categories, valid_category_report
from plumbtable.operators.convert import (
    FeatureSelector,
    TypeConverter,
    category_codes,
    clean_currency,
    clip_constants,
    coerce_all,
    coerce_columns,
    detect_roles,
)
from plumbtable.operators.duplicates import DuplicateRemover, duplicate_report
from plumbtable.operators.missing import (
    MissingValueImputer,
    drop_any_null,
    drop_null_threshold,
    fill_categorical_with_mode,
    fill_continuous_with_median,
    split_versions,
)
from plumbtable.operators.outliers import OutlierModel, OutlierRemover, remove_outliers_sequential, sequential_report
from plumbtable.plans.cleaning import row_preserving, run_initial_cleaning, scoring_cleaner, training_cleaner
from plumbtable.session import fresh_path


def test_coerce_forms(spark):
    texts = ["5", " 5 ", "1e3", ".5", "5.", "+3", "5d", "5f", "1_000", "invalid", "", "nan", "inf", "-Infinity", None]
    got = coerce_columns(spark.createDataFrame([(t,) for t in texts], "x string"), ["x", "absent"])
    want = [5.0, 5.0, 1000.0, 0.5, 5.0, 3.0, None, None, None, None, None, None, float("inf"), float("-inf"), None]
    assert [r["x"] for r in got.collect()] == want


def test_coerce_invalid_becomes_null(mini):
    dirty = mini.withColumn("X1", F.when(F.col("row_id") == 0, "invalid").otherwise(F.col("X1").cast("string")))
    out = TypeConverter(NUMERIC, CATEGORICAL).transform(dirty)
    assert dict(out.dtypes)["X8"] == "double"
    assert by(out, "row_id")[0]["X1"] is None
    assert all(r["X6"] is None for r in out.collect())


def test_coerce_all_and_codes(mini):
    out = coerce_all(mini)
    assert {t for _, t in out.dtypes} == {"double"}
    codes = category_codes(mini.withColumn("X8", F.col("X8").cast("double")), ["X8"])
    assert dict(codes.dtypes)["X8"] == "int" and by(codes, "row_id")[7]["X8"] == 4


def test_currency(mini, spark):
    assert by(clean_currency(mini, "X4"), "row_id")[3]["X4"] == 40.0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("$x",)], "a string").select(currency_to_number(F.col("a"))).collect()


def test_clip_constants(mini):
    out = by(clip_constants(mini, "X1"), "row_id")
    assert out[5]["X1"] == 100.0 and out[6]["X1"] == 0.0 and out[7]["X1"] is None
    one_sided = by(clip_constants(mini, "X1", lower=0, upper=None), "row_id")
    assert one_sided[5]["X1"] == 1000.0 and one_sided[6]["X1"] == 0.0


def test_clip_is_idempotent(mini):
    once = mini.select("row_id", clamp(F.col("X1"), 0, 100).alias("X1"))
    twice = once.select("row_id", clamp(F.col("X1"), 0, 100).alias("X1"))
    assert once.exceptAll(twice).count() == 0


def test_null_threshold(mini):
    nulls = ["X1", "X3", "X5", "X6", "X8", "Y1"]
    df = mini.select(
        *[F.when(F.col("row_id") != 2, F.col(c)).alias(c) if c in nulls else c for c in mini.columns]
    )
    # Ten data columns; the row id rides along outside the threshold.
    data = df.drop("row_id")
    kept = drop_null_threshold(data, 0.7)
    assert kept.count() == 8
    assert kept.filter("X2 = '3'").count() == 0 and kept.filter("X2 = '1'").count() == 2


def test_any_null_drop_and_strategy(mini):
    table = mini.filter("row_id <> 8").withColumns(
        {
            "X1": F.when(F.col("row_id") != 0, F.col("X1")),
            "X6": F.when(F.col("row_id") != 1, F.col("X6")),
        }
    )
    assert ids(drop_any_null(table)) == [3, 4, 5, 6]
    model = MissingValueImputer(NUMERIC, CATEGORICAL, "drop").fit(table)
    assert ids(model.transform(table)) == [3, 4, 5, 6]
    filled = MissingValueImputer(NUMERIC, CATEGORICAL).fit(table).transform(table)
    rows = by(filled, "row_id")
    assert rows[0]["X1"] == 35.0 and rows[1]["X6"] == "A"
    with pytest.raises(ValueError):
        MissingValueImputer(strategy="mean")


def test_legacy_fills_and_versions(mini):
    x1 = sorted(r[1] for r in MINI_ROWS if r[1] is not None)
    median = (x1[3] + x1[4]) / 2
    assert by(fill_continuous_with_median(mini, ["X1"]), "row_id")[7]["X1"] == median
    no_x6 = mini.withColumn("X6", F.when(F.col("row_id") != 3, F.col("X6")))
    assert by(fill_categorical_with_mode(no_x6, ["X6"]), "row_id")[3]["X6"] == "A"
    dropped, filled = split_versions(mini, NUMERIC, CATEGORICAL)
    assert ids(dropped) == [0, 1, 3, 4, 5, 6, 8] and filled.count() == 9
    assert filled.filter("X1 IS NULL OR X3 IS NULL").count() == 0


def test_mode_takes_smallest_of_ties_and_skips_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "c string, d string")
    model = MissingValueImputer([], ["c", "d"]).fit(df)
    assert model.getOrDefault("fills") == {"c": "a"}
    assert model.transform(df).filter("d IS NOT NULL").count() == 0


def test_integer_column_takes_fractional_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    out = MissingValueImputer(["x"]).fit(df).transform(df)
    assert sorted(r["x"] for r in out.collect()) == [1.0, 1.5, 2.0]


def test_sequential_iqr(mini):
    kept, bounds = remove_outliers_sequential(mini, NUMERIC, 1.5)
    assert ids(kept) == [0, 1, 3, 4, 8]
    removed = sequential_report(mini, bounds).orderBy("step_no").collect()
    assert [r["column"] for r in removed] == NUMERIC and removed[0]["outliers"] == 2


def test_clip_bounds(mini):
    model = OutlierRemover(NUMERIC, 1.5, "clip").fit(mini)
    assert model.getOrDefault("bounds")["X1"] == [-38.75, 91.25]
    out = by(model.transform(mini), "row_id")
    assert len(out) == 9 and out[5]["X1"] == 91.25 and out[6]["X1"] == -38.75 and out[7]["X1"] is None
    assert by(model.report(mini), "column")["X1"]["clipped"] == 2


def test_remove_drops_nulls_and_reports(mini):
    model = OutlierRemover(["X1"], 1.5).fit(mini)
    assert ids(model.transform(mini)) == [0, 1, 2, 3, 4, 8]
    report = model.report(mini).first()
    assert (report["rows_before"], report["rows_after"], report["removed"]) == (9, 6, 3)
    assert report["removed_percent"] == 33.33


def test_outlier_modes(mini):
    with pytest.raises(ValueError, match="mode must be"):
        OutlierRemover(NUMERIC, mode="drop")
    with pytest.raises(ValueError, match="mode must be"):
        OutlierModel({"X1": [0, 1]}, "drop").transform(mini)


def test_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert OutlierRemover(["a", "b"]).fit(df).transform(df).count() == 0
    assert OutlierRemover(["a", "b"], mode="clip").fit(df).transform(df).count() == 2
    kept, bounds = remove_outliers_sequential(df, ["b", "a"])
    assert kept.count() == 0 and [r["outliers"] for r in sequential_report(df, bounds).collect()] == [0, 0]


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "a double")
    assert outliers.iqr_bounds(df, ["a"], 1.5)["a"] == [0.5, 2.5]
    assert OutlierRemover(["a"], 1.5).fit(df).transform(df).count() == 2
    filled = MissingValueImputer(["a"]).fit(df).transform(df)
    assert sorted(r["a"] for r in filled.collect()) == [1.0, 1.5, 2.0]


def test_rare_to_mode(mini):
    model = CategoricalCleaner(["X6"], 0.2).fit(mini.filter("row_id <> 8"))
    out = by(model.transform(mini), "row_id")
    assert out[3]["X6"] == "A" and out[6]["X6"] == "Z" and len(out) == 9
    assert by(model.replaced_report(mini), "column")["X6"]["replaced"] == 1
    assert [r["X6"] for r in model.unseen(mini, "X6").collect()] == ["C"]


def test_rare_to_mode_replaces_nulls_and_keeps_order(spark):
    fit = spark.createDataFrame([("a", 1)] * 3 + [("b", 2)], "c string, n int")
    new = spark.createDataFrame([(None, 1), ("z", 2), ("b", 9)], "c string, n int")
    out = CategoricalCleaner(["c", "n"], 0.25).fit(fit).transform(new)
    assert out.columns == ["c", "n"]
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("a", 2), ("b", 1)]


def test_wide_domain_is_saved_with_the_model(spark):
    df = spark.range(6000).select(F.col("id").alias("c")).union(spark.createDataFrame([(1,), (9999,)], "c bigint"))
    model = CategoricalCleaner(["c"], 0.0).fit(df.filter("c < 9000"))
    path = fresh_path(spark, "wide")
    model.write().overwrite().save(path)
    loaded = cat.CategoricalModel.load(path)
    assert by(loaded.replaced_report(df), "column")["c"]["replaced"] == 1
    assert [r["c"] for r in loaded.unseen(df, "c").collect()] == [9999]
    assert loaded.transform(df).filter("c = 1").count() == 3
    assert cat.CategoricalModel().replaced_report(df).count() == 0


def test_wide_domains_stay_a_table(spark):
    """No category of a domain without a small bound is in the params or the plan; rows and types stay."""
    rows = [(k, f"t{k}", k / 2, k % 3) for k in range(3000)]
    df = spark.createDataFrame(rows, "c bigint, s string, r double, category int")
    new = df.union(spark.createDataFrame([(None, None, float("nan"), None), (-7, "x", -0.25, 9), (5, "t5", 0.0, 1)], df.schema))
    model = CategoricalCleaner(df.columns, 0.0).fit(df)
    assert not any(model.getOrDefault("valid").values())
    path = fresh_path(spark, "wide")
    model.write().overwrite().save(path)
    loaded = cat.CategoricalModel.load(path)
    assert loaded.getOrDefault("domain").startswith(path)
    loaded.write().overwrite().save(path)
    for m in (model, loaded, cat.CategoricalModel.load(path)):
        out = m.transform(new)
        assert out.schema == new.schema
        assert sorted(map(tuple, out.collect())) == sorted([*rows, (0, "t0", 0.0, 0), (0, "t0", 0.0, 0), (5, "t5", 0.0, 1)])
        assert "t2999" not in out._jdf.queryExecution().toString()
        assert {c: r["replaced"] for c, r in by(m.replaced_report(new), "column").items()} == dict.fromkeys(df.columns, 2)
        assert [r["s"] for r in m.unseen(new, "s").collect()] == ["x"]
    other = new.select(F.col("c").cast("double"), F.col("r").cast("string"))
    assert model.transform(other).count() == new.count()
    assert by(model.replaced_report(other), "column")["c"]["replaced"] == 2


def test_valid_categories(mini):
    valid = {"X6": ["A", "B"], "X8": [1, 2], "absent": [1]}
    assert ids(filter_valid_categories(mini, valid)) == [0, 1, 2, 8]
    report = by(valid_category_report(mini, valid), "column")
    assert report["X6"]["removed"] == 3 and report["X8"]["removed"] == 2 and report["total"]["removed"] == 5


def test_dedup(mini):
    plain = mini.drop("row_id")
    assert DuplicateRemover().transform(plain).count() == 8
    row = duplicate_report(plain).first()
    assert (row["rows"], row["distinct_rows"], row["duplicates"]) == (9, 8, 1)


def test_selector_and_roles(mini):
    assert "X2" not in FeatureSelector(["X2", "absent"]).transform(mini).columns
    numeric, categorical = detect_roles(mini.drop("row_id"), ["Y1", "Y2"])
    assert numeric == ["X1", "X3", "X5", "X7", "X8"] and categorical == ["X2", "X4", "X6"]


@pytest.mark.parametrize("handling", ["clip", "none"])
def test_scoring_cleaner_keeps_rows(mini, handling):
    rows = mini.filter("row_id < 4")
    model = scoring_cleaner(NUMERIC, CATEGORICAL, handling).fit(rows)
    assert model.transform(rows).count() == 4


def test_scoring_cleaner_options(mini):
    with pytest.raises(ValueError, match="handle_outliers"):
        scoring_cleaner(NUMERIC, CATEGORICAL, "cap")
    table = mini.drop("row_id")
    assert scoring_cleaner(NUMERIC, CATEGORICAL, dedup=True).fit(table).transform(table).count() == 8
    assert scoring_cleaner(NUMERIC, CATEGORICAL, "remove", 1.5).fit(table).transform(table).count() < 9


def test_training_cleaner_persists(mini, spark):
    table = mini.drop("row_id")
    model = training_cleaner(NUMERIC, ["X8"], ["X2", "X4"], iqr_multiplier=1.5).fit(table)
    out = model.transform(table)
    assert "X2" not in out.columns and out.count() < 8
    path = fresh_path(spark, "cleaner")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(table)
    assert again.columns == out.columns and again.exceptAll(out).count() == 0 and out.exceptAll(again).count() == 0


def test_row_preserving(mini):
    table = mini.drop("row_id")
    model = training_cleaner(NUMERIC, ["X8"], iqr_multiplier=1.5).fit(table)
    for handling in ("none", "clip"):
        assert row_preserving(model, handling).transform(table).count() == 9
    # Rows without targets and with unknown codes are scored too.
    bare = table.drop("Y1", "Y2").withColumn("X8", F.lit(77))
    assert row_preserving(model).transform(bare).count() == 9
    dropping = training_cleaner(NUMERIC, ["X8"], imputation_strategy="drop").fit(table)
    assert row_preserving(dropping).transform(table).count() == 9


def test_run_initial_cleaning(mini, spark):
    out, state = fresh_path(spark, "out"), fresh_path(spark, "state")
    cleaned = run_initial_cleaning(spark, mini.drop("row_id"), out, state, NUMERIC, ["X8"], columns_to_drop=["X2"])
    assert cleaned.count() == 7 and "X2" not in cleaned.columns
    assert len(PipelineModel.load(state).stages) == 6


def test_refit_is_fresh(mini):
    imputer = MissingValueImputer(NUMERIC, [])
    first = imputer.fit(mini)
    second = imputer.fit(mini.drop("X1"))
    assert "X1" in first.getOrDefault("fills") and "X1" not in second.getOrDefault("fills")


def test_partitioning_does_not_matter(mini):
    table = mini.drop("row_id")
    one = training_cleaner(NUMERIC, ["X8"], iqr_multiplier=1.5).fit(table.coalesce(1)).transform(table.coalesce(1))
    many = training_cleaner(NUMERIC, ["X8"], iqr_multiplier=1.5).fit(table.repartition(7)).transform(table.repartition(7))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_mini_schema_matches(mini):
    assert len(mini.columns) == len(MINI_SCHEMA.split(","))
