"""Per-target regression training: estimator mapping, cross-validated search, evaluation, run records."""

from __future__ import annotations

import math
import random
import time
import warnings
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.operators.metrics import regression_metrics
from plumbtable.operators.split import with_folds
from plumbtable.plans.ensembles import BOOSTING, FOREST, HistogramTrees
from plumbtable.session import shared_dir
from plumbtable.sources.runs import flat_params, log_run
from plumbtable.sources.state import make_signature, save_model, save_signature

# The deepest tree Spark builds, and the depth of boosted trees without a setting.
MAX_DEPTH = 30
BOOSTING_DEPTH = 6
FOLD = "__fold"
# The scorings a search accepts and the evaluator metric each stands for.
SCORING = {
    "neg_root_mean_squared_error": "rmse",
    "neg_mean_squared_error": "mse",
    "neg_mean_absolute_error": "mae",
    "r2": "r2",
}


@dataclass(frozen=True)
class ModelConfig:
    name: str
    library: str
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class SplitConfig:
    test_size: float = 0.2
    random_state: int = 42


@dataclass(frozen=True)
class HpoConfig:
    enabled: bool = False
    search: str = "random"
    cv: int = 5
    scoring: str = "neg_root_mean_squared_error"
    n_jobs: int = 4
    n_iter: int = 30
    param_grid: dict = field(default_factory=dict)


@dataclass(frozen=True)
class TrainConfig:
    model: ModelConfig
    split: SplitConfig = SplitConfig()
    hpo: HpoConfig = HpoConfig()

    @classmethod
    def from_dict(cls, raw: dict) -> TrainConfig:
        hpo = dict(raw.get("hpo") or {})
        hpo["param_grid"] = dict(hpo.get("param_grid") or {})
        return cls(
            ModelConfig(**raw["model"]),
            SplitConfig(**(raw.get("split") or {})),
            HpoConfig(**hpo),
        )


@dataclass(frozen=True)
class TrainedTarget:
    target: str
    model: object
    metrics: dict[str, float]
    best_params: dict | None
    best_cv_score: float | None
    run_id: str | None
    model_path: str | None


def _fraction(value) -> str:
    if value is None:
        return "all"
    if isinstance(value, str):
        try:
            value = float(value)
        except ValueError:
            return value
    return str(value)


# Hyper-parameter -> (Spark param, conversion).
FOREST_PARAMS = {
    "n_estimators": ("numTrees", int),
    "max_depth": ("maxDepth", lambda v: MAX_DEPTH if v is None else min(int(v), MAX_DEPTH)),
    "min_samples_leaf": ("minInstancesPerNode", int),
    "max_features": ("featureSubsetStrategy", _fraction),
    "max_samples": ("subsamplingRate", lambda v: 1.0 if v is None else float(v)),
    "bootstrap": ("bootstrap", bool),
    "random_state": ("seed", int),
}
BOOSTING_PARAMS = {
    "n_estimators": ("maxIter", int),
    "learning_rate": ("stepSize", float),
    "max_depth": ("maxDepth", lambda v: BOOSTING_DEPTH if v is None else min(int(v), MAX_DEPTH)),
    "min_child_weight": ("minInstancesPerNode", lambda v: max(1, math.ceil(v))),
    "subsample": ("subsamplingRate", float),
    "gamma": ("minInfoGain", float),
    "max_bin": ("maxBins", int),
    "random_state": ("seed", int),
}
COLUMN_SAMPLING = ("colsample_bytree", "colsample_bylevel", "colsample_bynode")
# Settings whose listed values are what Spark does anyway, or that only steer local execution.
NEUTRAL = {
    "criterion": ("squared_error",),
    "min_samples_split": (2,),
    "oob_score": (False,),
    "warm_start": (False,),
    "ccp_alpha": (0, 0.0),
    "max_leaf_nodes": (None,),
    "objective": ("reg:squarederror",),
    "booster": ("gbtree",),
    "tree_method": ("hist", "approx", "auto"),
    "reg_alpha": (0, 0.0),
    "reg_lambda": (0, 0.0),
}
EXECUTION_ONLY = ("n_jobs", "verbosity", "verbose", "seed")
# Every fit starts anew, so this has nothing to act on.
NO_EFFECT = ("warm_start",)


def translate_params(library: str, params: dict, rows: int | None = None) -> tuple[dict, list[str]]:
    """Spark params, and the settings that have no equivalent: unknown ones, and depths beyond ``MAX_DEPTH``.

    A whole number of samples per tree becomes a share of ``rows``; without that it has no equivalent.
    """
    table = {"sklearn": FOREST_PARAMS, "xgboost_sklearn": BOOSTING_PARAMS}.get(library)
    if table is None:
        raise ValueError(f"library must be 'sklearn' or 'xgboost_sklearn', got {library!r}")
    out, unmatched = {}, []
    sampled = 1.0
    if "seed" in params:
        out["seed"] = int(params["seed"])
    for name, value in params.items():
        if name == "max_depth" and value is not None and int(value) > MAX_DEPTH:
            unmatched.append(name)
        if name == "min_samples_leaf" and library == "sklearn" and isinstance(value, float) and value < 1:
            out["minWeightFractionPerNode"] = value
        elif name == "max_samples" and library == "sklearn" and isinstance(value, int):
            if rows:
                out["subsamplingRate"] = min(1.0, value / rows)
            else:
                unmatched.append(name)
        elif name in table:
            spark_name, convert = table[name]
            out[spark_name] = convert(value)
        elif library == "xgboost_sklearn" and name in COLUMN_SAMPLING:
            # Tree and level sampling multiply; Spark samples once per node.
            sampled *= float(value)
            out["featureSubsetStrategy"] = "all" if sampled >= 1.0 else str(sampled)
        elif value not in NEUTRAL.get(name, ()) and name not in EXECUTION_ONLY:
            unmatched.append(name)
    return out, unmatched


def create_estimator(config: ModelConfig, strict: bool = False, rows: int | None = None, searched: dict | None = None):
    """Forest (``sklearn``) or boosted trees (``xgboost_sklearn``).

    Spark's own trees where they have all settings, also those ``searched``, else ``HistogramTrees``, which yields
    Spark's models too. Settings that neither has warn, or raise if strict.
    """
    params, unmatched = translate_params(config.library, config.params, rows)
    for name, values in (searched or {}).items():
        if any(name in translate_params(config.library, {name: v}, rows)[1] for v in values):
            unmatched = [*unmatched, name]
    known = BOOSTING if config.library == "xgboost_sklearn" else FOREST
    if unmatched and any(n in known and n != "max_depth" for n in unmatched):
        # Settings beyond Spark's own trees.
        unmatched = [n for n in unmatched if n not in known and n not in EXECUTION_ONLY and n not in NO_EFFECT]
        _report(unmatched, config.library, strict)
        return HistogramTrees(config.library, {k: v for k, v in config.params.items() if k in known})
    unmatched = [n for n in unmatched if n not in NO_EFFECT]
    _report(unmatched, config.library, strict)
    kind = RandomForestRegressor if config.library == "sklearn" else GBTRegressor
    return kind(**params)


def _report(unmatched: list[str], library: str, strict: bool) -> None:
    if unmatched:
        message = f"no Spark equivalent for {sorted(unmatched)} of {library}"
        if strict:
            raise ValueError(message)
        warnings.warn(message, stacklevel=3)


def assemble(df: DataFrame, features: list[str], extra: list[str]) -> DataFrame:
    """Only the feature vector and the named columns: what training reads and caches."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    return assembler.transform(df).select("features", *extra)


def grid_points(grid: dict, n_iter: int | None, seed: int) -> list[dict]:
    """All combinations, or ``n_iter`` of them drawn without replacement."""
    names = list(grid)
    total = math.prod(len(grid[n]) for n in names)
    chosen = range(total) if n_iter is None or n_iter >= total else random.Random(seed).sample(range(total), n_iter)
    points = []
    for index in chosen:
        point = {}
        for n in names:
            index, i = divmod(index, len(grid[n]))
            point[n] = grid[n][i]
        points.append(point)
    return points


def tune(estimator, config: TrainConfig, train: DataFrame, fold_col: str):
    """Cross-validated search, refit on all rows: ``(model, best_params, best_cv_score)``."""
    hpo = config.hpo
    if hpo.search not in ("grid", "random"):
        raise ValueError(f"search must be 'grid' or 'random', got {hpo.search!r}")
    if hpo.scoring not in SCORING:
        raise ValueError(f"scoring must be one of {sorted(SCORING)}, got {hpo.scoring!r}")
    points = grid_points(
        hpo.param_grid, hpo.n_iter if hpo.search == "random" else None, config.split.random_state
    )
    maps, origin, unmatched = [], [], set()
    for point in points:
        if isinstance(estimator, HistogramTrees):
            maps.append({estimator.settings: {**estimator.getOrDefault(estimator.settings), **point}})
            origin.append(point)
            continue
        translated, missing = translate_params(config.model.library, {**config.model.params, **point})
        unmatched.update(n for n in missing if n in point)
        param_map = {estimator.getParam(k): v for k, v in translated.items()}
        # Points that differ only in settings without equivalent are one candidate.
        if param_map not in maps:
            maps.append(param_map)
            origin.append(point)
    if unmatched:
        warnings.warn(f"search settings without Spark equivalent: {sorted(unmatched)}", stacklevel=2)
    evaluator = RegressionEvaluator(
        labelCol=estimator.getLabelCol(), predictionCol="prediction", metricName=SCORING[hpo.scoring]
    )
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=evaluator,
        numFolds=hpo.cv,
        foldCol=fold_col,
        parallelism=max(1, hpo.n_jobs) if hpo.n_jobs > 0 else 4,
    )
    fitted = cv.fit(train)
    better = max if evaluator.isLargerBetter() else min
    best = fitted.avgMetrics.index(better(fitted.avgMetrics))
    score = fitted.avgMetrics[best] if evaluator.isLargerBetter() else -fitted.avgMetrics[best]
    return fitted.bestModel, origin[best], score


def evaluate(model, test: DataFrame, target: str, label_col: str) -> dict[str, float]:
    scored = model.transform(test)
    row = regression_metrics(scored, {target: (label_col, model.getPredictionCol())}).first()
    return {m: row[m] for m in ("mae", "mse", "rmse", "r2")}


def _vectors(train: DataFrame, features: list[str], labels: list[str], config: TrainConfig, keys: list[str]):
    """The persisted table all targets, candidates and folds read: vectors, labels and the fold.

    It spills to disk, and lost blocks are recomputed from the source.
    """
    table = assemble(train, features, [*labels, *[k for k in keys if k not in labels]])
    columns = ["features", *labels]
    if config.hpo.enabled and config.hpo.param_grid:
        table = with_folds(table, keys, config.hpo.cv, config.split.random_state, FOLD)
        columns.append(FOLD)
    return table.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)


def _fit_target(vectors: DataFrame, test: DataFrame, target: str, label: str, config: TrainConfig, strict: bool):
    """Fit or search on the training vectors and evaluate on the test vectors."""
    spark = vectors.sparkSession
    if config.model.library == "xgboost_sklearn" and spark.sparkContext.getCheckpointDir() is None:
        # Boosting checkpoints its residuals every few rounds, where there is a folder for them.
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/boosting")
    rows = vectors.count() if isinstance(config.model.params.get("max_samples"), int) else None
    searched = config.hpo.param_grid if FOLD in vectors.columns else None
    estimator = create_estimator(config.model, strict, rows, searched).setLabelCol(label)
    if FOLD in vectors.columns:
        model, best, cv_score = tune(estimator, config, vectors, FOLD)
    else:
        model, best, cv_score = estimator.fit(vectors), None, None
    return model, best, cv_score, evaluate(model, test, target, label)


def train_all_targets(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    target_mapping: dict[str, str],
    config: TrainConfig,
    keys: list[str],
    models_dir: str | None = None,
    runs_path: str | None = None,
    run_name: str | None = None,
    strict: bool = False,
    parallelism: int = 4,
) -> dict[str, TrainedTarget]:
    """An independent model per target (``{name: label column}``): fit or search, evaluate, record, save.

    ``keys`` identify a row: they fix the folds. Up to ``parallelism`` targets train at a time on one
    shared table. Every run is recorded, a failed one with its reason; the first failure is raised
    once all targets are through.
    """
    spark = train.sparkSession
    labels = list(dict.fromkeys(target_mapping.values()))
    family = config.model.name
    vectors = held = None
    failure = None
    results = {}
    try:
        vectors = _vectors(train, features, labels, config, keys)
        held = assemble(test, features, labels).persist(StorageLevel.MEMORY_AND_DISK)

        def work(item):
            started = time.time()
            try:
                outcome = _fit_target(vectors, held, *item, config, strict)
            except Exception as error:  # recorded with the run below
                outcome = error
            return (*item, started, time.time() - started, outcome)

        with ThreadPool(max(1, min(parallelism, len(target_mapping)))) as pool:
            # Runs are recorded by this thread alone: appends to one table must not overlap.
            for target, label, started, seconds, outcome in pool.imap(
                inheritable_thread_target(spark)(work), target_mapping.items()
            ):
                failed = isinstance(outcome, Exception)
                failure = failure or (outcome if failed else None)
                model, best, cv_score, metrics = (None, None, None, None) if failed else outcome
                model_path = None
                if models_dir and not failed:
                    model_path = f"{models_dir}/{family}_{target}_model"
                    save_model(model, model_path)
                    signature = make_signature(train, features, target, keys)
                    save_signature(spark, signature, f"{models_dir}/{family}_{target}_signature")
                run_id = None
                if runs_path:
                    extra = {} if cv_score is None else {"hpo_best_cv_score": cv_score}
                    run_id = log_run(
                        spark,
                        runs_path,
                        run_name=run_name or f"{family}-{target}",
                        target=target,
                        family=family,
                        params=flat_params(
                            config.model.params,
                            best,
                            test_size=config.split.test_size,
                            random_state=config.split.random_state,
                            hpo_enabled=config.hpo.enabled,
                        ),
                        metrics=None if failed else {**metrics, **extra},
                        tags={"model_library": config.model.library},
                        started_at=started,
                        duration_s=seconds,
                        failure=outcome if failed else None,
                    )
                if not failed:
                    results[target] = TrainedTarget(target, model, metrics, best, cv_score, run_id, model_path)
    finally:
        for table in (vectors, held):
            if table is not None:
                table.unpersist()
    if failure:
        raise failure
    return results


def train_single_target(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    target: str,
    label_col: str,
    config: TrainConfig,
    keys: list[str],
    **options,
) -> TrainedTarget:
    """One target of :func:`train_all_targets`."""
    return train_all_targets(train, test, features, {target: label_col}, config, keys, **options)[target]


def metrics_table(spark, results: dict[str, TrainedTarget]) -> DataFrame:
    """One row of ``mae, mse, rmse, r2`` per target."""
    rows = [(t, *[float(r.metrics[m]) for m in ("mae", "mse", "rmse", "r2")]) for t, r in results.items()]
    return spark.createDataFrame(rows, "target string, mae double, mse double, rmse double, r2 double")


def score_all(models: dict[str, object], df: DataFrame, features: list[str]) -> DataFrame:
    """Add one prediction column per model, named by its key; null where a feature is null."""
    assembler = VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="keep")
    complete = F.lit(True)
    for c in features:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    out = assembler.transform(df).withColumn("__complete", complete)
    for name, model in models.items():
        out = model.copy().setFeaturesCol("__features").setPredictionCol(name).transform(out)
    return out.withColumns({n: F.when(F.col("__complete"), F.col(n)) for n in models}).drop(
        "__features", "__complete"
    )


def score(model, df: DataFrame, features: list[str], name: str) -> DataFrame:
    return score_all({name: model}, df, features)
