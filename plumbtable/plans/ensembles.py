"""An estimator for the ensembles whose settings go beyond Spark's own trees; it yields Spark's models."""

from __future__ import annotations

import math

from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame

from plumbtable.operators.trees import MAX_BINS, Growth, Node, Tree, as_spark_model, binned, boost, cut_weakest_links, forest

#: Depth of trees that are to grow until nothing is left to cut.
DEEPEST = 30
#: Settings of either library that are taken as they are; those of local execution have no meaning here.
BOOSTING = {
    "n_estimators", "learning_rate", "max_depth", "min_child_weight", "subsample", "colsample_bytree", "colsample_bylevel",
    "colsample_bynode", "gamma", "reg_alpha", "reg_lambda", "max_bin", "random_state", "seed",
}
FOREST = {
    "n_estimators", "criterion", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "max_samples", "bootstrap",
    "ccp_alpha", "max_leaf_nodes", "random_state", "seed",
}
CRITERIA = ("squared_error", "absolute_error")


def _seed(params: dict) -> int:
    found = params.get("random_state", params.get("seed"))
    return 0 if found is None else int(found)


def _count(value, of: int, least: int) -> int:
    """A whole number, or a share of ``of`` rows."""
    return max(least, math.ceil(value * of)) if isinstance(value, float) else max(least, int(value))


def boosting_growth(params: dict) -> Growth:
    """Defaults are those of the library whose names the settings have: depth 6, L2 of 1, a child's hessian of 1."""
    return Growth(
        max_depth=min(int(6 if params.get("max_depth") is None else params["max_depth"]), DEEPEST),
        reg_lambda=float(params.get("reg_lambda", 1.0)),
        reg_alpha=float(params.get("reg_alpha", 0.0)),
        gamma=float(params.get("gamma", 0.0)),
        min_child_weight=float(params.get("min_child_weight", 1.0)),
        columns=tuple(float(params.get(f"colsample_by{k}", 1.0)) for k in ("tree", "level", "node")),
        sample=float(params.get("subsample", 1.0)),
        max_bin=int(params.get("max_bin", MAX_BINS)),
    )


def forest_growth(params: dict, rows: int, width: int) -> Growth:
    criterion = params.get("criterion", "squared_error")
    if criterion not in CRITERIA:
        raise ValueError(f"criterion must be one of {CRITERIA}, got {criterion!r}")
    wanted = params.get("max_features", 1.0)
    if isinstance(wanted, str) and wanted not in ("sqrt", "log2"):
        wanted = float(wanted)
    named = {"sqrt": math.sqrt(width), "log2": math.log2(width), None: width}
    features = named[wanted] if wanted in named else wanted * width if isinstance(wanted, float) else wanted
    bootstrap = bool(params.get("bootstrap", True))
    samples = params.get("max_samples")
    share = 1.0 if samples is None or not bootstrap else samples if isinstance(samples, float) else samples / rows
    depth = params.get("max_depth")
    return Growth(
        max_depth=DEEPEST if depth is None else min(int(depth), DEEPEST),
        min_samples_split=_count(params.get("min_samples_split", 2), rows, 2),
        min_samples_leaf=_count(params.get("min_samples_leaf", 1), rows, 1),
        max_leaf_nodes=params.get("max_leaf_nodes"),
        ccp_alpha=float(params.get("ccp_alpha", 0.0)),
        # Half a feature over, so that the share gives the whole number again.
        columns=(1.0, 1.0, min(1.0, (max(1, int(features)) + 0.5) / width) if int(features) < width else 1.0),
        sample=float(share),
        with_replacement=bootstrap,
    )


class HistogramTrees(Estimator, HasLabelCol, HasFeaturesCol, HasPredictionCol):
    """Boosted trees (``xgboost_sklearn``) or a forest (``sklearn``) from histograms, with the library's own settings.

    ``settings`` holds them by the library's names. With ``absolute_error`` cuts are chosen by the squared error and
    leaves predict medians. Rows of a sample are drawn by a hash, so the sample's size is right on average.
    """

    settings = Param(Params._dummy(), "settings", "the library's settings by name")

    def __init__(self, library: str, settings: dict):
        super().__init__()
        self.library = library
        self._set(settings=dict(settings))

    def setLabelCol(self, value: str) -> HistogramTrees:
        return self._set(labelCol=value)

    def _fit(self, df: DataFrame):
        params = self.getOrDefault(self.settings)
        label, features = self.getLabelCol(), self.getFeaturesCol()
        spark, seed = df.sparkSession, _seed(params)
        boosted = self.library == "xgboost_sklearn"
        bins = int(params.get("max_bin", MAX_BINS)) if boosted else MAX_BINS
        data, edges = binned(df.where(df[label].isNotNull()), features, label, bins)
        width = len(edges)
        count = int(params.get("n_estimators", 100))
        if boosted:
            rate = float(params.get("learning_rate", 0.3))
            base, trees = boost(data, width, bins, boosting_growth(params), count, rate, seed)
            trees, weights = [_constant(base), *trees], [1.0, *[rate] * count]
        else:
            growth = forest_growth(params, data.count(), width)
            trees = forest(data, width, bins, growth, count, seed, params.get("criterion") == "absolute_error")
            weights = [1.0] * count
        columns = {"featuresCol": features, "labelCol": label, "predictionCol": self.getPredictionCol()}
        return as_spark_model(spark, trees, weights, edges, boosted, columns)


def pruning_path(df: DataFrame, features: str, label: str, settings: dict | None = None) -> DataFrame:
    """``(step, alpha, leaves)``: the weakest links of one tree on all rows, from the whole tree to its root."""
    data, edges = binned(df.where(df[label].isNotNull()), features, label, MAX_BINS)
    growth = forest_growth({**(settings or {}), "bootstrap": False, "ccp_alpha": 0.0}, data.count(), len(edges))
    tree = forest(data, len(edges), MAX_BINS, growth, 1, 0, False)[0]
    steps = [(k, float(a), n) for k, (a, n) in enumerate(cut_weakest_links(tree, math.inf), 1)]
    return df.sparkSession.createDataFrame(steps, "step int, alpha double, leaves int")


def _constant(value: float) -> Tree:
    return Tree(-1, [], [Node(0.0, 0.0, 0, value=value)])
