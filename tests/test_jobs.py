import json
import os
from types import SimpleNamespace

import pytest
from conftest import by
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plumbtable.plans.cleaning import training_cleaner
from plumbtable.plans.features import prepare_features
from plumbtable.plans.scoring import MultiTargetPredictor, Predictor, batch_score, predict_table
from plumbtable.plans.training import (
    HpoConfig,
    ModelConfig,
    TrainConfig,
    create_estimator,
    grid_points,
    metrics_table,
    train_all_targets,
    train_single_target,
    translate_params,
)
from plumbtable.session import fresh_path, shared_dir
from plumbtable.sources import readers, state, writers
from plumbtable.sources.runs import flat_params, leaderboard, read_runs, run_metrics
from plumbtable.streaming.scoring import row_stream, score_stream

NUMERIC, CATEGORICAL = ["x1", "x2"], ["c"]
TARGETS = {"heating": "y1", "cooling": "y2"}
MODEL = ModelConfig("xgboost", "xgboost_sklearn", {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.4, "random_state": 42})


def write_text(spark, text, name):
    folder = fresh_path(spark, "text")
    os.makedirs(folder)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_csv_is_text_with_missing_markers(spark):
    path = write_text(spark, "a,b\n1,NA\nerror,\n 2 ,x\n", "t.csv")
    df = readers.load_csv(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", None), ("error", None), (" 2 ", "x")]
    assert readers.load_csv(spark, path, ["a", "b"]).count() == 3
    assert readers.load_positional_csv(spark, path, ["u", "v"]).columns == ["u", "v"]


def test_csv_and_parquet_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "col1 int, col2 string")
    path = fresh_path(spark, "deep") + "/x/y"
    for _ in range(2):
        writers.save_csv(df, path)
    back = readers.load_csv(spark, path).select(F.col("col1").cast("int"), "col2")
    assert back.exceptAll(df).count() == 0 and back.count() == 3
    writers.save_parquet(df, path + "-p")
    assert readers.load_parquet(spark, path + "-p").exceptAll(df).count() == 0


@pytest.mark.parametrize("document", ['{"rows": [{"x": 1, "y": 2.5}, {"x": 2, "y": null}]}', '[{"x": 1, "y": 2.5}, {"x": 2, "y": null}]'])
def test_json_documents(spark, document):
    path = write_text(spark, document, "rows.json")
    for schema in (None, "x bigint, y double"):
        assert [tuple(r) for r in readers.load_rows_json(spark, path, schema).collect()] == [(1, 2.5), (2, None)]
    assert readers.load_input(spark, json_path=path).count() == 2


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError):
        readers.load_rows_json(spark, write_text(spark, '{"rows": []}', "rows.json"))
    with pytest.raises(ValueError):
        readers.rows_to_table(spark, [])
    with pytest.raises(ValueError):
        readers.load_input(spark)
    assert readers.rows_to_table(spark, [{"x": 1}, {"x": 2}]).count() == 2


def test_prepared_roles(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, Y1 double, Y2 double")
    assert readers.split_roles(df, ["Y1", "Y2"]) == (["a"], ["Y1", "Y2"])
    with pytest.raises(ValueError):
        readers.split_roles(df, ["Y9"])


def test_prediction_envelopes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (3.0, 4.0)], "heating double, cooling double")
    row = writers.prediction_envelopes(df, "both", ["heating", "cooling"]).first()
    assert row["part"] == 0 and row["num_predictions"] == 3 and len(row["predictions"]) == 3
    parts = writers.prediction_envelopes(df, "both", ["heating"], rows=1).collect()
    assert sum(p["num_predictions"] for p in parts) == 3 and max(p["part"] for p in parts) <= 2
    assert writers.prediction_envelopes(df.limit(0), "both", ["heating"]).count() == 0
    path = fresh_path(spark, "predictions")
    writers.save_predictions(df, path, "both")
    assert spark.read.json(f"{path}/summary").first()["num_predictions"] == 3


def test_csv_cells_with_quotes_and_line_breaks(spark):
    text = 'a,b\n"say ""hi"", ok",2\n"line1\nline2",3\n'
    rows = [tuple(r) for r in readers.load_csv(spark, write_text(spark, text, "quoted.csv")).collect()]
    assert rows == [('say "hi", ok', "2"), ("line1\nline2", "3")]
    df = spark.createDataFrame([(' "x" ', "a\nb"), (None, "1,2")], "p string, q string")
    path = fresh_path(spark, "quoted")
    writers.save_csv(df, path)
    assert sorted(map(str, readers.load_csv(spark, path).collect())) == sorted(map(str, df.collect()))


def test_json_documents_per_line_lose_no_row(spark):
    lines = write_text(spark, '{"rows": [{"a": 1}, {"a": 2}]}\n\n{"rows": [{"a": 3}]}\n', "two.json")
    assert sorted(r["a"] for r in readers.load_rows_json(spark, lines, "a int").collect()) == [1, 2, 3]
    assert readers.load_input(spark, json_path=lines).count() == 3
    one = write_text(spark, '[\n {"a": 1},\n {"a": 2}\n]', "one.json")
    assert readers.load_rows_json(spark, one, "a int").count() == 2


def test_depth_leaf_and_sample_forms():
    forest, missing = translate_params("sklearn", {"max_depth": 60, "min_samples_leaf": 0.01, "max_samples": 100}, rows=400)
    assert forest == {"maxDepth": 30, "minWeightFractionPerNode": 0.01, "subsamplingRate": 0.25}
    assert missing == ["max_depth"]
    assert translate_params("sklearn", {"max_samples": 100})[1] == ["max_samples"]
    assert translate_params("xgboost_sklearn", {"max_depth": None})[0] == {"maxDepth": 6}
    with pytest.raises(ValueError, match="max_depth"):
        create_estimator(ModelConfig("rf", "sklearn", {"max_depth": 60}), strict=True)


def test_param_translation():
    forest, missing = translate_params(
        "sklearn",
        {"n_estimators": 750, "criterion": "absolute_error", "max_depth": None, "min_samples_split": 10, "min_samples_leaf": 5,
         "max_features": 0.6, "random_state": 42, "n_jobs": -1, "bootstrap": True, "max_samples": 0.7, "oob_score": False,
         "warm_start": True, "ccp_alpha": 0.001, "max_leaf_nodes": 200},
    )
    assert forest == {
        "numTrees": 750, "maxDepth": 30, "minInstancesPerNode": 5, "featureSubsetStrategy": "0.6", "seed": 42,
        "bootstrap": True, "subsamplingRate": 0.7,
    }
    assert sorted(missing) == ["ccp_alpha", "criterion", "max_leaf_nodes", "min_samples_split", "warm_start"]
    boosted, missing = translate_params(
        "xgboost_sklearn",
        {"objective": "reg:squarederror", "booster": "gbtree", "n_estimators": 400, "learning_rate": 0.02, "max_depth": 8,
         "min_child_weight": 1, "subsample": 0.9, "colsample_bytree": 0.8, "colsample_bylevel": 0.5, "gamma": 0.05,
         "reg_alpha": 0.0, "reg_lambda": 1.5, "tree_method": "hist", "verbosity": 1, "seed": 2025, "random_state": 42},
    )
    assert boosted["maxIter"] == 400 and boosted["stepSize"] == 0.02 and boosted["featureSubsetStrategy"] == "0.4"
    assert boosted["seed"] == 42 and boosted["minInfoGain"] == 0.05 and missing == ["reg_lambda"]
    with pytest.raises(ValueError, match="library must be"):
        translate_params("lightgbm", {})


def test_unmatched_settings_warn_or_raise(spark):
    config = ModelConfig("rf", "sklearn", {"ccp_alpha": 0.1, "monotonic_cst": [1]})
    with pytest.warns(UserWarning, match="monotonic_cst"):
        create_estimator(config)
    with pytest.raises(ValueError, match="monotonic_cst"):
        create_estimator(config, strict=True)


def test_grid_points():
    grid = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert len(grid_points(grid, None, 0)) == 6 and len(grid_points(grid, 99, 0)) == 6
    drawn = grid_points(grid, 4, 42)
    assert drawn == grid_points(grid, 4, 42) and len({tuple(d.items()) for d in drawn}) == 4


def test_config_from_dict():
    config = TrainConfig.from_dict(
        {"model": {"name": "rf", "library": "sklearn", "params": {"n_estimators": 3}}, "split": {"test_size": 0.3},
         "hpo": {"enabled": True, "search": "grid", "cv": 3, "param_grid": {"max_depth": [2]}}}
    )
    assert config.split.test_size == 0.3 and config.hpo.cv == 3 and config.model.params["n_estimators"] == 3


def test_leaderboard_of_published_runs(spark):
    rows = [
        ("1", "heating", "xgboost", 0.414, 0.369, 0.997, 8.5),
        ("4", "heating", "xgboost", 0.446, 0.551, 0.995, 9.1),
        ("6", "heating", "xgboost", 0.489, 0.827, 0.992, 9.0),
        ("8", "heating", "xgboost", 0.571, 0.905, 0.992, 7.3),
        ("2", "heating", "random_forest", 0.509, 0.888, 0.992, 16.6),
        ("5", "heating", "random_forest", 0.701, 1.489, 0.986, 11.7),
    ]
    runs = spark.createDataFrame(rows, "run_id string, target string, family string, mae double, rmse double, r2 double, duration_s double")
    got = by(leaderboard(runs), "family")["xgboost"]
    assert got["mae"] == pytest.approx(0.480) and got["rmse"] == pytest.approx(0.663) and got["r2"] == pytest.approx(0.994)
    assert got["duration_s"] == pytest.approx(8.475) and (got["best_run"], got["worst_run"]) == ("1", "8")


def test_flat_params_keep_scalars():
    got = flat_params({"a": 1, "b": [1], "c": None}, {"d": 2.0}, hpo_enabled=True)
    assert got == {"model__a": "1", "model__c": "None", "hpo_best__d": "2.0", "hpo_enabled": "True"}


@pytest.fixture(scope="module")
def raw(spark):
    base = spark.range(400).select(
        "id",
        F.when(F.col("id") % 40 == 7, "error").otherwise((F.col("id") % 37).cast("string")).alias("x1"),
        (F.col("id") % 23).cast("string").alias("x2"),
        F.when(F.col("id") % 50 != 9, (F.col("id") % 4 + 2).cast("string")).alias("c"),
    )
    x1 = F.col("x1").try_cast("double")
    return base.withColumn("y1", (F.coalesce(x1, F.lit(18.0)) * 2 + F.col("x2").cast("double")).cast("string")).withColumn(
        "y2", (F.col("x2").cast("double") * 3 + 1).cast("string")
    )


@pytest.fixture(scope="module")
def fitted(spark, raw):
    home = fresh_path(spark, "models")
    cleaner = training_cleaner(["x1", "x2", "y1", "y2"], CATEGORICAL).fit(raw)
    sets = prepare_features(cleaner.transform(raw), NUMERIC, CATEGORICAL, ["y1", "y2"], keys=["id"], keep=["id"])
    results = train_all_targets(
        sets.train, sets.test, sets.features, TARGETS, TrainConfig(MODEL), ["id"], models_dir=home, runs_path=f"{home}/runs"
    )
    state.save_pipeline(cleaner, f"{home}/cleaner")
    state.save_pipeline(sets.encoder, f"{home}/encoder")
    return home, cleaner, sets, results


def test_training_quality_runs_and_signature(spark, fitted):
    home, _, sets, results = fitted
    for r in results.values():
        assert r.metrics["r2"] > 0.9 and r.metrics["rmse"] == pytest.approx(r.metrics["mse"] ** 0.5)
    table = by(metrics_table(spark, results), "target")
    assert set(table) == {"heating", "cooling"}
    runs = read_runs(spark, f"{home}/runs")
    assert runs.count() == 2 and by(run_metrics(runs), "target")["cooling"]["mae"] == results["cooling"].metrics["mae"]
    params = runs.first()["params"]
    assert params["model__n_estimators"] == "8" and params["hpo_enabled"] == "False"
    signature = state.load_signature(spark, f"{home}/xgboost_heating_signature")
    assert signature["features"] == sets.features and len(signature["input_example"]) == 2
    state.check_signature(sets.test, signature)
    with pytest.raises(ValueError, match="lacks"):
        state.check_signature(sets.test.drop("x1"), signature)
    with pytest.raises(ValueError, match="not numeric"):
        state.check_signature(sets.test.withColumn("x1", F.col("x1").cast("string")), signature)


def test_failed_run_is_recorded(spark, fitted):
    _, _, sets, _ = fitted
    path = fresh_path(spark, "runs")
    bad = TrainConfig(ModelConfig("bad", "nolib", {}))
    with pytest.raises(ValueError):
        train_single_target(sets.train, sets.test, sets.features, "heating", "y1", bad, ["id"], runs_path=path)
    row = read_runs(spark, path).first()
    assert row["status"] == "error" and "library must be" in row["failure"]
    assert row["trace"].startswith("Traceback") and "translate_params" in row["trace"]


@pytest.mark.parametrize("search", ["grid", "random"])
def test_search(spark, fitted, search):
    _, _, sets, _ = fitted
    hpo = HpoConfig(True, search, cv=3, n_iter=2, param_grid={"max_depth": [1, 5]})
    config = TrainConfig(ModelConfig("rf", "sklearn", {"n_estimators": 4, "random_state": 1}), hpo=hpo)
    got = train_single_target(sets.train, sets.test, sets.features, "cooling", "y2", config, ["id"])
    assert got.best_cv_score < 0 and "max_depth" in got.best_params
    if search == "grid":
        assert got.best_params["max_depth"] == 5


def test_search_settings_are_checked(fitted):
    _, _, sets, _ = fitted
    for hpo in (HpoConfig(True, "halving", param_grid={"max_depth": [1]}), HpoConfig(True, "grid", scoring="f1", param_grid={"max_depth": [1]})):
        with pytest.raises(ValueError):
            train_single_target(
                sets.train, sets.test, sets.features, "cooling", "y2",
                TrainConfig(ModelConfig("rf", "sklearn"), hpo=hpo), ["id"],
            )


def test_scoring_keeps_every_row(spark, raw, fitted):
    home, _, _, results = fitted
    predictor = MultiTargetPredictor.load(
        f"{home}/cleaner", f"{home}/encoder", {t: r.model_path for t, r in results.items()}
    )
    dirty = raw.drop("y1", "y2").withColumn("x1", F.when(F.col("id") % 2 == 0, F.col("x1")))
    out = predict_table(predictor, dirty)
    assert out.count() == 400 and out.filter("prediction_heating IS NULL OR prediction_cooling IS NULL").count() == 0
    rows = predictor.predict([{"x1": "3", "x2": "4", "c": "2"}, {"x1": None, "x2": "junk", "c": "99"}])
    assert rows.select("heating", "cooling").count() == 2
    with pytest.raises(ValueError):
        predictor.predict([])


def test_null_feature_gives_null_score(spark, fitted):
    _, cleaner, sets, results = fitted
    from pyspark.ml import PipelineModel

    bare = Predictor(PipelineModel([cleaner.stages[0]]), sets.encoder, results["heating"].model)
    out = bare.predict([{"x1": "3", "x2": "4", "c": "2"}, {"x1": "error", "x2": "4", "c": "2"}])
    assert sorted(r["prediction"] is None for r in out.collect()) == [False, True]


@pytest.mark.parametrize("target", ["both", "cooling"])
def test_batch_score(spark, raw, fitted, target):
    home = fitted[0]
    source, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    writers.save_csv(raw.drop("y1", "y2"), source)
    got = batch_score(spark, home, home, out, csv_path=source, target=target)
    assert got.count() == 400 and got.columns == (["heating", "cooling"] if target == "both" else ["cooling"])
    assert spark.read.json(f"{out}/summary").first()["num_predictions"] == 400
    with pytest.raises(ValueError):
        batch_score(spark, home, home, out, csv_path=source, target="humidity")


def test_stream_equals_batch(spark, raw, fitted):
    _, cleaner, sets, results = fitted
    predictor = MultiTargetPredictor(cleaner, sets.encoder, {t: r.model for t, r in results.items()}, "clip")
    source, home = fresh_path(spark, "in"), fresh_path(spark, "stream")
    inputs = raw.drop("y1", "y2")
    inputs.repartition(5).write.json(source)

    def run():
        rows = row_stream(spark, source, inputs.schema, "json", files_per_trigger=2)
        score_stream(rows, predictor, f"{home}/out", f"{home}/checkpoint", ["id"]).awaitTermination()

    run()
    batch = predictor.predict_columns(inputs, ["id"])
    streamed = spark.read.parquet(f"{home}/out")
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == 400
    # A restart continues after what was done: new files only.
    inputs.filter("id < 10").withColumn("id", F.col("id") + 1000).write.mode("append").json(source)
    run()
    assert spark.read.parquet(f"{home}/out").count() == 410


def test_report_sink(spark):
    path = fresh_path(spark, "report")
    writers.save_report({"a": spark.range(2), "b": spark.range(3)}, path)
    assert spark.read.json(f"{path}/b").count() == 3


def test_entry_contract(spark, sf_dir):
    assert entry.entry(spark).count() > 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 90
    assert all(callable(q) for q in queries.values()) and all(isinstance(s, str) for s in oracle.values())


def test_signature_is_plain_json(spark, fitted):
    json.dumps(state.load_signature(spark, f"{fitted[0]}/xgboost_cooling_signature"))


def test_sessions_without_a_shared_folder(tmp_path):
    """A local one gets one folder of its own, a cluster's is refused, a given one is taken."""

    def session(master, given=None):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: given))

    own = shared_dir(session("local[2]"))
    assert os.path.isdir(own) and shared_dir(session("local[2]")) == own != shared_dir(session("local[4]"))
    assert shared_dir(session("spark://host", f"{tmp_path}/")) == str(tmp_path)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host"))
