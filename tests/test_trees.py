"""Histogram trees against a plain recursive search over every cut."""

import warnings

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from plumbtable.operators import trees as T
from plumbtable.plans.ensembles import HistogramTrees, boosting_growth, forest_growth, pruning_path
from plumbtable.plans.training import HpoConfig, ModelConfig, TrainConfig, create_estimator, tune
from plumbtable.sources.state import load_model, save_model
from plumbtable.session import fresh_path

RF = {
    "n_estimators": 750, "criterion": "absolute_error", "max_depth": 12, "min_samples_split": 10, "min_samples_leaf": 5, "max_features": 0.6,
    "random_state": 42, "n_jobs": -1, "bootstrap": True, "max_samples": 0.7, "oob_score": False, "warm_start": True, "ccp_alpha": 0.001,
    "max_leaf_nodes": 200,
}
XGB = {
    "objective": "reg:squarederror", "booster": "gbtree", "n_estimators": 400, "learning_rate": 0.02, "max_depth": 8, "min_child_weight": 1,
    "subsample": 0.9, "colsample_bytree": 0.8, "colsample_bylevel": 0.7, "gamma": 0.05, "reg_alpha": 0.0, "reg_lambda": 1.5,
    "tree_method": "hist", "verbosity": 1, "seed": 2025, "random_state": 42, "n_jobs": -1,
}


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(21)
    x = np.round(draw.normal(size=(110, 3)), 1)
    y = np.where(x[:, 0] > 0.3, 4.0, 0.0) + x[:, 1] ** 2 + draw.normal(size=110) * 0.3
    return x, y


@pytest.fixture(scope="module")
def table(spark, points):
    rows = [(Vectors.dense(a.tolist()), float(b)) for a, b in zip(*points)]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(3).persist()


def searched(x, g, growth, depth=0):
    """``(gain, feature, cut, left, right)`` or None for a leaf, by trying every cut."""
    def score(own):
        t = max(abs(g[own].sum()) - growth.reg_alpha, 0)
        return t * t / (own.sum() + growth.reg_lambda)

    best = None
    if depth < growth.max_depth and len(g) >= growth.min_samples_split:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                small = min(left.sum(), (~left).sum())
                if small < max(1, growth.min_samples_leaf) or small < growth.min_child_weight:
                    continue
                gain = score(left) + score(~left) - score(np.ones(len(g), bool))
                if gain > T.LEAST_GAIN and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut)
    if best is None:
        return None
    left = x[:, best[1]] <= best[2]
    below = [searched(x[m], g[m], growth, depth + 1) for m in (left, ~left)]
    if best[0] < growth.gamma and below == [None, None]:
        return None
    return (*best, *below)


def valued(tree, x, at, value):
    if tree is None:
        return np.full(len(x), value(at))
    left = x[:, tree[1]] <= tree[2]
    out = np.empty(len(x))
    for mask, below in ((left, tree[3]), (~left, tree[4])):
        out[mask] = valued(below, x[mask], at[mask], value)
    return out


def predicted(model, table, points):
    rows = model.transform(table).select("features", "prediction").collect()
    found = {tuple(r["features"].toArray()): r["prediction"] for r in rows}
    return np.array([found[tuple(a)] for a in points[0]])


@pytest.mark.parametrize("extra", [{}, {"reg_alpha": 3.0, "gamma": 2.0, "min_child_weight": 6, "max_depth": 5}])
def test_two_boosting_rounds_equal_a_search(spark, table, points, extra):
    settings = {"n_estimators": 2, "learning_rate": 0.4, "max_depth": 3, "reg_lambda": 1.5, **extra}
    got = predicted(HistogramTrees("xgboost_sklearn", settings).fit(table), table, points)
    x, y = points
    growth, margin = boosting_growth(settings), np.full(len(y), y.mean())
    for _ in range(2):
        g = margin - y
        tree = searched(x, g, growth)

        def value(at, g=g):
            total = g[at].sum()
            return -np.sign(total) * max(abs(total) - growth.reg_alpha, 0) / (len(at) + growth.reg_lambda)

        margin = margin + 0.4 * valued(tree, x, np.arange(len(y)), value)
    assert got == pytest.approx(margin, abs=1e-9)


@pytest.mark.parametrize("criterion", ["squared_error", "absolute_error"])
def test_one_tree_on_all_rows_equals_a_search(spark, table, points, criterion):
    settings = {"n_estimators": 1, "bootstrap": False, "criterion": criterion, "max_depth": 4, "min_samples_split": 10, "min_samples_leaf": 4}
    got = predicted(HistogramTrees("sklearn", settings).fit(table), table, points)
    x, y = points
    tree = searched(x, -y, forest_growth(settings, len(y), 3))
    middle = np.mean if criterion == "squared_error" else np.median
    assert got == pytest.approx(valued(tree, x, np.arange(len(y)), lambda at: middle(y[at])), abs=1e-9)


def _best_first(tree, most):
    """Gains in the order in which growth by the largest gain cuts."""
    queue, out = [tree] if tree else [], []
    while queue and len(out) < most - 1:
        queue.sort(key=lambda t: t[0])
        top = queue.pop()
        out.append(top[0])
        queue += [t for t in top[3:] if t]
    return out


def test_leaves_are_limited_in_the_order_of_gain(spark, table, points):
    data, edges = T.binned(table, "features", "label", T.MAX_BINS)
    x, y = points
    for most in (2, 5, 9):
        growth = forest_growth({"bootstrap": False, "max_leaf_nodes": most}, len(y), 3)
        tree = T.forest(data, 3, T.MAX_BINS, growth, 1, 0, False)[0]
        inner = [n.gain for n in tree.nodes if n.left >= 0]
        assert len(tree.leaves()) == most
        assert sorted(inner) == pytest.approx(sorted(_best_first(searched(x, -y, growth), most)))
    assert len(edges) == 3


def test_weakest_links_are_cut_first(spark, table, points):
    x, y = points
    path = pruning_path(table, "features", "label", {"max_leaf_nodes": 6}).collect()
    assert [r["leaves"] for r in path][-1] == 1
    assert all(a["alpha"] <= b["alpha"] + 1e-12 and a["leaves"] > b["leaves"] for a, b in zip(path, path[1:]))
    # The alphas of all steps, weighted by the leaves they take, are the squared error the tree saves.
    growth = forest_growth({"bootstrap": False, "max_leaf_nodes": 6}, len(y), 3)
    saved = sum(_best_first(searched(x, -y, growth), 6)) / len(y)
    taken = [b - a for a, b in zip([r["leaves"] for r in path], [6, *[r["leaves"] for r in path]])]
    assert sum(r["alpha"] * t for r, t in zip(path, taken)) == pytest.approx(saved)
    limit = path[2]["alpha"]
    model = HistogramTrees("sklearn", {"n_estimators": 1, "bootstrap": False, "max_leaf_nodes": 6, "ccp_alpha": limit}).fit(table)
    assert (model.trees[0].numNodes + 1) // 2 == path[2]["leaves"]


def test_published_files_train_without_a_warning_and_models_reload(spark, table, points):
    for library, params, few in (("sklearn", RF, 3), ("xgboost_sklearn", XGB, 2)):
        with warnings.catch_warnings():
            warnings.simplefilter("error", UserWarning)
            estimator = create_estimator(ModelConfig("m", library, {**params, "n_estimators": few, "max_depth": 3}), strict=True)
        model = estimator.setLabelCol("label").fit(table)
        path = fresh_path(spark, "model")
        save_model(model, path)
        again = load_model(path)
        assert predicted(again, table, points) == pytest.approx(predicted(model, table, points))
        assert np.std(predicted(model, table, points)) > 0


def test_samples_are_shares_on_average_and_the_same_for_everyone():
    rows = np.arange(200_000)
    for share in (0.3, 0.9):
        once = T.sample_weights(rows, 4, 7, share, False)
        assert abs(once.mean() - share) < 0.01 and set(np.unique(once)) == {0.0, 1.0}
        again = T.sample_weights(rows, 4, 7, share, True)
        assert abs(again.mean() - share) < 0.01 and abs(again.var() - share) < 0.02
        assert (again[500:600] == T.sample_weights(rows[500:600], 4, 7, share, True)).all()
        assert (once != T.sample_weights(rows, 5, 7, share, False)).any()


def test_search_over_settings_beyond_sparks_own(spark, table):
    hpo = HpoConfig(True, "grid", cv=2, n_jobs=1, param_grid={"max_leaf_nodes": [2, 6]})
    config = TrainConfig(ModelConfig("rf", "sklearn", {"n_estimators": 1, "bootstrap": False, "max_depth": 3}), hpo=hpo)
    estimator = create_estimator(config.model, True, None, hpo.param_grid).setLabelCol("label")
    folds = table.selectExpr("*", "cast(pmod(hash(label), 2) as int) as fold")
    model, best, score = tune(estimator, config, folds, "fold")
    assert best == {"max_leaf_nodes": 6} and score < 0 and model.trees[0].numNodes == 11
