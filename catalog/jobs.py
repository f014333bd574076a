"""Sources and sinks, persisted state, training, search, batch and stream scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.cleaning import NUMBERS, SCORE_SQL, SCORED_K, TRAIN_SQL
from catalog.features import PREPARED_SQL, ranked_sql
from catalog.monitoring import ALERTS_SQL, ROUND_METRICS, metrics_sql, monitored
from catalog.tables import PREDICTIONS_SQL, TARGETS, dirty, predictions, readings, rounded, table
from plumbtable.operators.compare import model_comparison, model_verdict
from plumbtable.operators.metrics import regression_metrics
from plumbtable.plans.cleaning import run_initial_cleaning, scoring_cleaner, training_cleaner
from plumbtable.plans.features import prepare_features, run_complete_workflow, run_feature_engineering
from plumbtable.plans.scoring import MultiTargetPredictor, batch_score, predict_table
from plumbtable.plans.ensembles import HistogramTrees, pruning_path
from plumbtable.plans.training import (
    HpoConfig,
    ModelConfig,
    TrainConfig,
    assemble,
    create_estimator,
    evaluate,
    metrics_table,
    score,
    score_all,
    train_all_targets,
)
from plumbtable.session import fresh_path, settle
from plumbtable.sources.readers import load_csv, load_positional_csv, load_prepared, load_rows_json
from plumbtable.sources.runs import leaderboard, read_runs, run_metrics
from plumbtable.sources.state import (
    load_model,
    load_pipeline,
    load_signature,
    make_signature,
    save_model,
    save_pipeline,
    save_signature,
)
from plumbtable.sources.writers import (
    prediction_envelopes,
    save_csv,
    save_csv_file,
    save_json,
    save_metrics,
    save_parquet,
    save_predictions,
    save_report,
)
from plumbtable.streaming.scoring import row_stream, score_stream, start_stream

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDER_TYPES = ["bigint", "bigint", "string", "double", "string"]


def _orders(spark, sf):
    return table(spark, sf, "orders").select(*ORDER_COLUMNS)


def _cast_orders(df, names=ORDER_COLUMNS):
    return df.select(*[F.col(n).cast(t).alias(o) for n, t, o in zip(names, ORDER_TYPES, ORDER_COLUMNS)])


@query(ORDERS_SQL)
def csv_roundtrip(spark, sf):
    path = fresh_path(spark, "orders-csv")
    save_csv(_orders(spark, sf), path)
    return _cast_orders(load_csv(spark, path, ORDER_COLUMNS))


@query(ORDERS_SQL)
def csv_positional(spark, sf):
    path = fresh_path(spark, "orders-csv")
    save_csv(_orders(spark, sf), path)
    names = ["key", "customer", "status", "price", "priority"]
    return _cast_orders(load_positional_csv(spark, path, names), names)


@query(ORDERS_SQL)
def parquet_roundtrip(spark, sf):
    path = fresh_path(spark, "orders")
    save_parquet(_orders(spark, sf), path)
    return spark.read.parquet(path)


@query(ORDERS_SQL)
def json_rows_scan(spark, sf):
    """A document of the shape ``{"rows": [...]}`` per line."""
    path = fresh_path(spark, "orders-json")
    orders = _orders(spark, sf)
    save_json(orders.select(F.array(F.struct(*ORDER_COLUMNS)).alias("rows")), path)
    schema = ", ".join(f"{n} {t}" for n, t in zip(ORDER_COLUMNS, ORDER_TYPES))
    return load_rows_json(spark, path, schema, lines=True)


TEXTS_SQL = "SELECT doc_id, text, source FROM documents"


@query(TEXTS_SQL)
def csv_quoted_texts(spark, sf):
    """Texts with quotes, commas and line breaks, written and read again."""
    path = fresh_path(spark, "texts-csv")
    save_csv(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    return load_csv(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query(TEXTS_SQL)
def csv_one_file_texts(spark, sf):
    """The same from one file, which several tasks write, and read where it has several splits."""
    path = fresh_path(spark, "texts-csv")
    save_csv_file(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    return load_csv(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query(TEXTS_SQL)
def json_line_texts(spark, sf):
    """A row per line, told from the text: nobody says that there is a document per line."""
    path = fresh_path(spark, "texts-json")
    save_json(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    return load_rows_json(spark, path, "doc_id bigint, text string, source string")


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT 'both' AS target, count(*) AS num_predictions, round(sum(p1), 2) AS total,
  ceil(count(*) / 1000)::BIGINT AS parts FROM predictions"""
)
def prediction_parts(spark, sf):
    """Envelopes of about 1,000 predictions: as many as needed, and every row in one."""
    rows = predictions(spark, sf).select(F.col("p1").alias("heating"), F.col("p2").alias("cooling"))
    parts = prediction_envelopes(rows, "both", ["heating", "cooling"], rows=1000)
    total = F.aggregate("predictions", F.lit(0.0), lambda s, p: s + p["heating"])
    return parts.groupBy("target").agg(
        F.sum("num_predictions").alias("num_predictions"),
        F.round(F.sum(total), 2).alias("total"),
        F.count_distinct("part").alias("parts"),
    )


@query(f"WITH {PREDICTIONS_SQL} SELECT 'both' AS target, count(*) AS num_predictions, round(sum(p1), 2) AS total FROM predictions")
def prediction_sink(spark, sf):
    path = fresh_path(spark, "predictions")
    rows = predictions(spark, sf).select(F.col("p1").alias("heating"), F.col("p2").alias("cooling"))
    save_predictions(rows, path, "both")
    total = spark.read.schema(rows.schema).json(f"{path}/rows").agg(F.round(F.sum("heating"), 2))
    return spark.read.schema("target string, num_predictions bigint").json(f"{path}/summary").select(
        "target", "num_predictions", total.scalar().alias("total")
    )


@query(f"WITH {PREDICTIONS_SQL} SELECT target, {ROUND_METRICS} FROM ({metrics_sql('predictions')})")
def metrics_sink(spark, sf):
    path = fresh_path(spark, "metrics")
    found = regression_metrics(predictions(spark, sf), TARGETS)
    save_metrics(found, path)
    return rounded(spark.read.schema(found.schema).json(path))


@query(f"{ALERTS_SQL} SELECT severity, kind, subject, metric, round(value, 4) AS value FROM alerts")
def report_sink(spark, sf):
    path = fresh_path(spark, "report")
    report = monitored(spark, sf)
    save_report(report, path)
    alerts = spark.read.schema(report["alerts"].schema).json(f"{path}/alerts")
    return rounded(alerts.drop("message"))


@query(f"WITH {SCORE_SQL} SELECT event_id, value, user_id, {SCORED_K} FROM imputed")
def state_roundtrip(spark, sf):
    """The fitted cleaner saved, loaded and applied."""
    df = readings(spark, sf).drop("ts", "event_type")
    path = fresh_path(spark, "cleaner")
    save_pipeline(scoring_cleaner(NUMBERS, ["k"]).fit(df), path)
    return load_pipeline(path).transform(df)


@query(f"WITH {TRAIN_SQL} SELECT value, user_id, k FROM trained")
def initial_cleaning_job(spark, sf):
    df = readings(spark, sf).drop("event_id", "ts")
    out, state = fresh_path(spark, "interim"), fresh_path(spark, "cleaner")
    return run_initial_cleaning(spark, df, out, state, NUMBERS, ["k"], columns_to_drop=["event_type"])


@query(PREPARED_SQL)
def feature_engineering_job(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_retailprice")
    out, state = fresh_path(spark, "processed"), fresh_path(spark, "encoder")
    run_feature_engineering(
        spark, df, out, state, ["p_size"], ["p_type"], ["p_retailprice"], keys=["p_partkey"], keep=["p_partkey"]
    )
    train, _ = load_prepared(spark, f"{out}/train", ["p_retailprice"])
    test, _ = load_prepared(spark, f"{out}/test", ["p_retailprice"])
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return rounded(both, 6)


# Documents: sizes of the whole text as features, letters and characters as targets.
DOC_NUMBERS = ["n_words", "n_lines"]
DOC_CATEGORIES = ["lang"]
DOC_TARGETS = {"heating": "n_chars", "cooling": "n_letters"}


def document_rows(spark, sf):
    """One small row per document; written once, so the texts are read once."""
    doc = table(spark, sf, "documents")
    return settle(
        doc.select(
            "doc_id",
            F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
            F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
            "lang",
            F.col("n_chars").cast("double").alias("n_chars"),
            F.length(F.regexp_replace("text", "[^A-Za-z]", "")).cast("double").alias("n_letters"),
        ),
        "documents",
    )


def _sets(spark, sf):
    return prepare_features(
        document_rows(spark, sf),
        DOC_NUMBERS,
        DOC_CATEGORIES,
        list(DOC_TARGETS.values()),
        keys=["doc_id"],
        keep=["doc_id"],
    )


FOREST = ModelConfig("random_forest", "sklearn", {"n_estimators": 20, "max_depth": 8, "random_state": 42})
BOOSTED = ModelConfig(
    "xgboost", "xgboost_sklearn", {"n_estimators": 20, "max_depth": 5, "learning_rate": 0.3, "random_state": 42}
)


def _train(spark, sf, config, targets=None, **options):
    sets = _sets(spark, sf)
    return train_all_targets(
        sets.train, sets.test, sets.features, targets or DOC_TARGETS, config, ["doc_id"], **options
    )


@query()
def train_rf(spark, sf):
    return metrics_table(spark, _train(spark, sf, TrainConfig(FOREST)))


@query()
def train_gbt(spark, sf):
    return metrics_table(spark, _train(spark, sf, TrainConfig(BOOSTED)))


def _search_result(spark, results):
    rows = [
        (t, float(r.best_cv_score), float(r.metrics["rmse"]), {k: str(v) for k, v in r.best_params.items()})
        for t, r in results.items()
    ]
    return spark.createDataFrame(
        rows, "target string, best_cv_score double, test_rmse double, best_params map<string,string>"
    )


@query()
def tune_grid(spark, sf):
    grid = {"max_depth": [3, 6], "min_samples_leaf": [1, 4]}
    model = ModelConfig("random_forest", "sklearn", {"n_estimators": 5, "random_state": 42})
    config = TrainConfig(model, hpo=HpoConfig(True, "grid", cv=3, param_grid=grid))
    return _search_result(spark, _train(spark, sf, config, {"heating": "n_chars"}))


@query()
def tune_random(spark, sf):
    grid = {"max_depth": [2, 4], "learning_rate": [0.1, 0.3], "subsample": [0.7, 1.0]}
    model = ModelConfig("xgboost", "xgboost_sklearn", {"n_estimators": 5, "random_state": 42})
    config = TrainConfig(model, hpo=HpoConfig(True, "random", cv=3, n_iter=3, param_grid=grid))
    return _search_result(spark, _train(spark, sf, config, {"heating": "n_chars"}))


@query()
def compare_trained_models(spark, sf):
    """A model trained on clean readings against one trained on the same readings after dirt and cleaning."""
    rows = document_rows(spark, sf)
    damaged = rows.withColumn("n_words", F.when(F.col("doc_id") % 17 != 0, F.col("n_words")))
    cleaner = scoring_cleaner(DOC_NUMBERS, []).fit(damaged)
    scored = []
    for df in (rows, cleaner.transform(damaged)):
        sets = prepare_features(df, DOC_NUMBERS, [], ["n_chars"], keys=["doc_id"], keep=["doc_id"])
        found = train_all_targets(
            sets.train, sets.test, sets.features, {"heating": "n_chars"}, TrainConfig(BOOSTED), ["doc_id"]
        )
        scored.append(metrics_table(spark, found))
    ranges = rows.agg(F.lit("heating").alias("target"), F.min("n_chars").alias("min"), F.max("n_chars").alias("max"))
    return model_verdict(model_comparison(*scored, ranges))


def _fitted(spark, sf, models_dir=None, runs=None):
    """Cleaner, encoder and a model per target, fitted on the documents."""
    rows = document_rows(spark, sf)
    cleaner = training_cleaner(DOC_NUMBERS, []).fit(rows)
    cleaned = settle(cleaner.transform(rows), "cleaned")
    sets = prepare_features(
        cleaned, DOC_NUMBERS, DOC_CATEGORIES, list(DOC_TARGETS.values()), keys=["doc_id"], keep=["doc_id"]
    )
    found = train_all_targets(
        sets.train, sets.test, sets.features, DOC_TARGETS, TrainConfig(FOREST), ["doc_id"],
        models_dir=models_dir, runs_path=runs,
    )
    return rows, cleaner, sets, found


@query()
def score_multi(spark, sf):
    """Every document scored for both targets with models loaded from their saved form."""
    home = fresh_path(spark, "models")
    rows, cleaner, sets, found = _fitted(spark, sf, home)
    save_pipeline(cleaner, f"{home}/cleaner")
    save_pipeline(sets.encoder, f"{home}/encoder")
    predictor = MultiTargetPredictor.load(
        f"{home}/cleaner", f"{home}/encoder", {t: r.model_path for t, r in found.items()}
    )
    return predict_table(predictor, rows.drop(*DOC_TARGETS.values())).select(
        "doc_id", "prediction_heating", "prediction_cooling"
    )


SCORED_ALL_SQL = "SELECT count(*) AS rows, count(*) AS heating, count(*) AS cooling FROM documents"


@query(SCORED_ALL_SQL)
def batch_score_rows(spark, sf):
    """The scoring job on a CSV of every document: as many predictions as rows, none null."""
    home = fresh_path(spark, "models")
    rows, cleaner, sets, _ = _fitted(spark, sf, home)
    save_pipeline(cleaner, f"{home}/cleaner")
    save_pipeline(sets.encoder, f"{home}/encoder")
    save_csv(rows.drop(*DOC_TARGETS.values()), f"{home}/input")
    out = batch_score(
        spark, home, home, f"{home}/output", csv_path=f"{home}/input", model_name="random_forest"
    )
    return out.agg(
        F.count(F.lit(1)).alias("rows"), F.count("heating").alias("heating"), F.count("cooling").alias("cooling")
    )


@query("SELECT count(*) AS rows, count(*) AS equal_predictions FROM part")
def model_roundtrip(spark, sf):
    """A forest saved and loaded predicts the same for every part."""
    part = table(spark, sf, "part").select(
        "p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"),
        F.col("p_partkey").cast("double").alias("key"),
    )
    model = create_estimator(FOREST).setLabelCol("p_retailprice").fit(
        assemble(part, ["p_size", "key"], ["p_retailprice"])
    )
    path = fresh_path(spark, "forest")
    save_model(model, path)
    both = score(load_model(path), score(model, part, ["p_size", "key"], "a"), ["p_size", "key"], "b")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") == F.col("b")).alias("equal_predictions")
    )


@query()
def run_log(spark, sf):
    """Runs recorded by training both targets, with their signatures."""
    home, runs = fresh_path(spark, "models"), fresh_path(spark, "runs")
    _, _, _, found = _fitted(spark, sf, home, runs)
    features = {
        t: len(load_signature(spark, r.model_path.removesuffix("_model") + "_signature")["features"])
        for t, r in found.items()
    }
    logged = run_metrics(read_runs(spark, runs)).select("target", "family", "mae", "rmse", "r2")
    count = F.create_map(*[e for t, n in features.items() for e in (F.lit(t), F.lit(n))])
    return logged.withColumn("features", count[F.col("target")])


def _run_rows_sql():
    families = {"scaled": "y1 * 0.97", "shifted": "y1 + 2"}
    return " UNION ALL ".join(
        f"""SELECT concat('{f}-', l_returnflag, '-', l_linenumber) AS run_id, l_returnflag AS target, '{f}' AS family,
avg(abs({e} - y1)) AS mae, sqrt(avg(pow({e} - y1, 2))) AS rmse, 1 - sum(pow({e} - y1, 2)) / (var_pop(y1) * count(*)) AS r2,
count(*)::DOUBLE AS duration_s FROM (SELECT *, l_extendedprice / 1000 AS y1 FROM lineitem) GROUP BY l_returnflag, l_linenumber"""
        for f, e in families.items()
    )


@query(
    f"""WITH r AS ({_run_rows_sql()})
SELECT target, family, count(*) AS runs, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse, round(avg(r2), 4) AS r2,
  round(avg(duration_s), 4) AS duration_s, first(run_id ORDER BY round(mae, 8), run_id) AS best_run,
  first(run_id ORDER BY round(mae, 8) DESC, run_id) AS worst_run FROM r GROUP BY target, family"""
)
def run_leaderboard(spark, sf):
    """Two formula families scored on every line number of every flag: one run each."""
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linenumber", (F.col("l_extendedprice") / 1000).alias("y1")
    )
    scored = lines.withColumns({"scaled": F.col("y1") * 0.97, "shifted": F.col("y1") + 2})
    found = regression_metrics(
        scored, {"scaled": ("y1", "scaled"), "shifted": ("y1", "shifted")}, ["l_returnflag", "l_linenumber"]
    )
    runs = found.select(
        F.concat_ws("-", "target", "l_returnflag", F.col("l_linenumber").cast("string")).alias("run_id"),
        F.col("l_returnflag").alias("target"),
        F.col("target").alias("family"),
        F.round("mae", 8).alias("mae"),
        "rmse",
        "r2",
        F.col("n").cast("double").alias("duration_s"),
    )
    return rounded(leaderboard(runs))


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query(f"WITH {SCORE_SQL} SELECT event_id, value, user_id, {SCORED_K} FROM imputed")
def stream_clean(spark, sf):
    """Events as a file stream through a cleaner fitted on the batch; the same rows as the batch query."""
    model = scoring_cleaner(NUMBERS, ["k"]).fit(readings(spark, sf).drop("ts", "event_type"))
    home = fresh_path(spark, "stream")
    # A pattern, since the file source takes a plain path only for a folder.
    rows = row_stream(spark, f"{sf}/events.parque[t]", EVENT_SCHEMA, "parquet")
    start_stream(
        rows, lambda df: model.transform(dirty(df).drop("ts", "event_type")), f"{home}/out", f"{home}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{home}/out")


@query("SELECT count(*) AS rows, count(*) AS scored, count(*) AS same_as_batch FROM documents")
def stream_score(spark, sf):
    """JSON files of documents scored as a stream: every row once, with the predictions of the batch path."""
    rows, cleaner, sets, found = _fitted(spark, sf)
    predictor = MultiTargetPredictor(cleaner, sets.encoder, {t: r.model for t, r in found.items()})
    home = fresh_path(spark, "stream")
    inputs = rows.drop(*DOC_TARGETS.values())
    save_json(inputs, f"{home}/in")
    stream = row_stream(spark, f"{home}/in", inputs.schema, "json")
    score_stream(stream, predictor, f"{home}/out", f"{home}/checkpoint", ["doc_id"]).awaitTermination()
    streamed = spark.read.parquet(f"{home}/out")
    batch = predictor.predict_columns(inputs, ["doc_id"]).select(
        "doc_id", F.col("heating").alias("bh"), F.col("cooling").alias("bc")
    )
    same = (F.col("heating") == F.col("bh")) & (F.col("cooling") == F.col("bc"))
    return streamed.join(batch, "doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("heating").alias("scored"), F.count_if(same).alias("same_as_batch")
    )


@query()
def complete_workflow_job(spark, sf):
    """Raw table to trained model: clean, split, encode, train, evaluate."""
    home = fresh_path(spark, "workflow")
    raw = document_rows(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in ("n_words", "n_lines", "n_chars")])
    sets = run_complete_workflow(
        spark, raw, home, ["n_words", "n_lines", "n_chars"], [], ["n_words", "n_lines"], [], ["n_chars"]
    )
    train, features = load_prepared(spark, f"{home}/processed/train", ["n_chars"])
    model = create_estimator(FOREST).setLabelCol("n_chars").fit(assemble(train, features, ["n_chars"]))
    found = evaluate(model, assemble(sets.test, features, ["n_chars"]), "heating", "n_chars")
    return spark.createDataFrame([(len(features), found["mae"], found["rmse"], found["r2"])], "features int, mae double, rmse double, r2 double")



ONE_TREE = ModelConfig(
    "random_forest", "sklearn",
    {"n_estimators": 1, "bootstrap": False, "max_features": None, "max_depth": 12, "min_samples_leaf": 1, "random_state": 1},
)
ONE_ROUND = ModelConfig("xgboost", "xgboost_sklearn", {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 12})
# One tree over one category predicts each category's mean of the training rows.
CELLS_SQL = f"""WITH {ranked_sql("p_partkey", "part")},
cells AS (SELECT {{c}} AS cell, avg(p_retailprice) AS price, avg(p_size) AS size FROM ranked WHERE rn > ceil(0.2 * n) GROUP BY 1),
scored AS (SELECT r.*, c.price, c.size FROM ranked r JOIN cells c ON r.{{c}} = c.cell)"""


def _trained_cells(spark, sf, model, home=None, runs=None, category="p_type"):
    """Parts, their feature sets by one category, and a model for each of two targets."""
    size = F.col("p_size").cast("double").alias("p_size")
    code = (F.col("p_partkey") % 7).alias("code")
    part = table(spark, sf, "part").select("p_partkey", "p_type", code, "p_retailprice", size)
    sets = prepare_features(part, [], [category], ["p_retailprice", "p_size"], keys=["p_partkey"], keep=["p_partkey"])
    targets = {"heating": "p_retailprice", "cooling": "p_size"}
    found = train_all_targets(
        sets.train, sets.test, sets.features, targets, TrainConfig(model), ["p_partkey"], models_dir=home, runs_path=runs
    )
    return part, sets, found


CELL_SCORES_SQL = f"{CELLS_SQL} SELECT p_partkey, round(price, 4) AS heating, round(size, 4) AS cooling FROM scored"
TYPE_SCORES_SQL = CELL_SCORES_SQL.format(c="p_type")


def _cell_scores(scored):
    return scored.select("p_partkey", F.round("heating", 4).alias("heating"), F.round("cooling", 4).alias("cooling"))


@query(TYPE_SCORES_SQL)
def train_tree_scores(spark, sf):
    """Both targets trained; the test and training rows scored with the trees."""
    _, sets, found = _trained_cells(spark, sf, ONE_TREE)
    return _cell_scores(score_all({t: r.model for t, r in found.items()}, sets.prepared(), sets.features))


@query(TYPE_SCORES_SQL)
def train_boosted_scores(spark, sf):
    """One boosting round with step 1."""
    _, sets, found = _trained_cells(spark, sf, ONE_ROUND)
    return _cell_scores(score_all({t: r.model for t, r in found.items()}, sets.prepared(), sets.features))


def _codes(spark, sf, codes, label):
    """One feature, a code, and a label that differs clearly between codes."""
    part = table(spark, sf, "part").select((F.col("p_partkey") % codes).cast("double").alias("code"), F.expr(label).alias("label"))
    return assemble(part, ["code"], ["code", "label"])


def _scores_by_code(model, df):
    scored = model.transform(df).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.max("prediction").alias("score"))
    return rounded(scored.select(F.col("code").cast("bigint").alias("code"), "n", "score"))


@query(
    """WITH p AS (SELECT p_partkey % 7 AS code, p_size + 100.0 * (p_partkey % 7) AS label FROM part), b AS (SELECT avg(label) AS base FROM p)
SELECT code::BIGINT AS code, count(*) AS n, round(any_value(base) + 0.5 * sum(label - base) / (count(*) + 20), 4) AS score FROM p, b GROUP BY code"""
)
def boosted_leaf_values(spark, sf):
    """One round with L2 regularisation: every code's leaf is its shrunk mean gradient."""
    df = _codes(spark, sf, 7, "p_size + 100.0 * (p_partkey % 7)")
    settings = {"n_estimators": 1, "learning_rate": 0.5, "reg_lambda": 20, "max_depth": 6, "subsample": 1.0, "colsample_bytree": 0.8}
    return _scores_by_code(HistogramTrees("xgboost_sklearn", settings).fit(df), df)


@query(
    """SELECT (p_partkey % 7)::BIGINT AS code, count(*) AS n, round(median(p_retailprice + 5000.0 * (p_partkey % 7)), 4) AS score
FROM part GROUP BY 1"""
)
def forest_leaf_medians(spark, sf):
    """A tree whose leaves predict medians."""
    df = _codes(spark, sf, 7, "p_retailprice + 5000.0 * (p_partkey % 7)")
    settings = {"n_estimators": 1, "bootstrap": False, "criterion": "absolute_error", "max_leaf_nodes": 7}
    return _scores_by_code(HistogramTrees("sklearn", settings).fit(df), df)


@query(
    """WITH g AS (SELECT p_partkey % 3 AS code, count(*)::DOUBLE AS n, avg(p_size + 40.0 * pow(p_partkey % 3, 2)) AS m FROM part GROUP BY 1),
c AS (SELECT a.n + b.n + c.n AS total, (a.n * (b.n + c.n) / (a.n + b.n + c.n)) * pow(a.m - (b.n * b.m + c.n * c.m) / (b.n + c.n), 2) AS first_off,
  (c.n * (a.n + b.n) / (a.n + b.n + c.n)) * pow(c.m - (a.n * a.m + b.n * b.m) / (a.n + b.n), 2) AS last_off,
  b.n * c.n / (b.n + c.n) * pow(b.m - c.m, 2) AS later, a.n * b.n / (a.n + b.n) * pow(a.m - b.m, 2) AS sooner
  FROM g a, g b, g c WHERE a.code = 0 AND b.code = 1 AND c.code = 2),
s AS (SELECT total, greatest(first_off, last_off) AS top, CASE WHEN first_off >= last_off THEN later ELSE sooner END AS below FROM c)
SELECT 1 AS step, round(below / total, 4) AS alpha, 2 AS leaves FROM s WHERE below <= top
UNION ALL SELECT 2, round(top / total, 4), 1 FROM s WHERE below <= top
UNION ALL SELECT 1, round((top + below) / 2 / total, 4), 1 FROM s WHERE below > top"""
)
def pruning_steps(spark, sf):
    """Weakest links of a tree with three leaves."""
    return rounded(pruning_path(_codes(spark, sf, 3, "p_size + 40.0 * pow(p_partkey % 3, 2)"), "features", "label", {"max_leaf_nodes": 3}))


@query(CELL_SCORES_SQL.format(c="p_partkey % 7").replace("r.p_partkey % 7", "(r.p_partkey % 7)"))
def score_saved_models(spark, sf):
    """Raw parts scored with cleaner, encoder and models loaded from their saved form."""
    home = fresh_path(spark, "models")
    part, sets, found = _trained_cells(spark, sf, ONE_TREE, home, category="code")
    save_pipeline(scoring_cleaner([], ["code"]).fit(part), f"{home}/cleaner")
    save_pipeline(sets.encoder, f"{home}/encoder")
    predictor = MultiTargetPredictor.load(
        f"{home}/cleaner", f"{home}/encoder", {t: r.model_path for t, r in found.items()}
    )
    return _cell_scores(predict_table(predictor, part.drop("p_retailprice", "p_size"), ""))


# Folds of the training rows; a tree over one code predicts the means of the other folds' rows, a tree without a cut the mean.
SEARCH_SQL = f"""WITH {ranked_sql("p_partkey", "part")},
t AS (SELECT p_partkey % 7 AS code, p_retailprice AS y, rn - ceil(0.2 * n) AS r, n - ceil(0.2 * n) AS n FROM ranked WHERE rn > ceil(0.2 * n)),
f AS (SELECT *, CASE WHEN r <= ceil(n / 3.0) THEN 0 WHEN r <= ceil(n * 2 / 3.0) THEN 1 ELSE 2 END AS fold FROM t),
m AS (SELECT *, (sum(y) OVER (PARTITION BY code) - sum(y) OVER (PARTITION BY code, fold))
    / (count(*) OVER (PARTITION BY code) - count(*) OVER (PARTITION BY code, fold)) AS cell,
  (sum(y) OVER () - sum(y) OVER (PARTITION BY fold)) / (count(*) OVER () - count(*) OVER (PARTITION BY fold)) AS mean FROM f),
e AS (SELECT fold, sqrt(avg(pow(y - cell, 2))) AS cell, sqrt(avg(pow(y - mean, 2))) AS mean FROM m GROUP BY fold),
s AS (SELECT avg(cell) AS cell, avg(mean) AS mean FROM e)"""


def _searched(spark, sf, model, hpo):
    """Best depth and score of a search over the codes of parts."""
    part = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 7).alias("code"), "p_retailprice")
    sets = prepare_features(part, [], ["code"], ["p_retailprice"], keys=["p_partkey"], keep=["p_partkey"])
    found = train_all_targets(
        sets.train, sets.test, sets.features, {"price": "p_retailprice"}, TrainConfig(model, hpo=hpo), ["p_partkey"]
    )["price"]
    rows = [(int(found.best_params["max_depth"]), float(found.best_cv_score))]
    return rounded(spark.createDataFrame(rows, "max_depth int, best_cv_score double"))


@query(
    f"""{SEARCH_SQL} SELECT CASE WHEN cell <= mean THEN 12 ELSE 0 END AS max_depth, round(-least(cell, mean), 4) AS best_cv_score FROM s"""
)
def tune_grid_best(spark, sf):
    """A grid over a tree with all cuts and one with none; three folds."""
    return _searched(spark, sf, ONE_TREE, HpoConfig(True, "grid", cv=3, param_grid={"max_depth": [0, 12]}))


@query(f"{SEARCH_SQL} SELECT round(-cell, 4) AS best_cv_score FROM s")
def tune_random_best(spark, sf):
    """Two points drawn from three that all cut every code off."""
    hpo = HpoConfig(True, "random", cv=3, n_iter=2, param_grid={"max_depth": [10, 11, 12]})
    return _searched(spark, sf, ONE_ROUND, hpo).select("best_cv_score")


@query(
    """WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS k FROM part)
SELECT 'p_size' AS feature, 'integer' AS kind, max(p_size) FILTER (k = 1)::VARCHAR AS first_value, max(p_size) FILTER (k = 2)::VARCHAR AS second_value FROM p
UNION ALL SELECT 'p_type', 'string', max(p_type) FILTER (k = 1), max(p_type) FILTER (k = 2) FROM p"""
)
def model_signature(spark, sf):
    """A model's signature saved and loaded: feature types and the example rows."""
    path = fresh_path(spark, "signature")
    save_signature(spark, make_signature(table(spark, sf, "part"), ["p_size", "p_type"], "p_retailprice", ["p_partkey"]), path)
    found = load_signature(spark, path)
    kinds = {f["name"]: f["type"] for f in found["schema"]["fields"]}
    rows = [(c, kinds[c], *[str(r[c]) for r in found["input_example"]]) for c in found["features"]]
    return spark.createDataFrame(rows, "feature string, kind string, first_value string, second_value string")


def _run_sql(label, score, target):
    return f"""SELECT '{target}' AS target, 'sklearn' AS family, round(avg(abs({score} - {label})), 4) AS mae,
round(sqrt(avg(pow({score} - {label}, 2))), 4) AS rmse,
round(1 - sum(pow({score} - {label}, 2)) / (var_pop({label}) * count(*)), 4) AS r2 FROM scored WHERE rn <= ceil(0.2 * n)"""


@query(
    f"{CELLS_SQL.format(c='p_type')} {_run_sql('p_retailprice', 'price', 'heating')} "
    f"UNION ALL {_run_sql('p_size', 'size', 'cooling')}"
)
def run_log_metrics(spark, sf):
    """Test metrics of both targets as the runs table records them."""
    runs = fresh_path(spark, "runs")
    _trained_cells(spark, sf, ONE_TREE, fresh_path(spark, "models"), runs)
    logged = run_metrics(read_runs(spark, runs)).select("target", F.lit("sklearn").alias("family"), "mae", "rmse", "r2")
    return rounded(logged)
