import math
import random
from fractions import Fraction

import numpy as np
import pytest
from conftest import by
from pyspark.sql import functions as F

from plumbtable.operators import compare, drift, metrics, monitoring, residuals
from plumbtable.plans.monitoring import MonitorConfig, monitor

ONE = {"t": ("y", "p")}


def pairs(spark, truth, prediction):
    return spark.createDataFrame(list(zip(map(float, truth), map(float, prediction))), "y double, p double")


@pytest.mark.parametrize(
    "truth, prediction, mae, mse, r2",
    [
        ((10, 20, 30), (10, 20, 30), 0.0, 0.0, 1.0),
        ((10, 20, 30), (20, 20, 20), 20 / 3, 200 / 3, 0.0),
        ((5, 5, 5), (5, 5, 5), 0.0, 0.0, 1.0),
        ((5, 5, 5), (5, 5, 8), 1.0, 3.0, 0.0),
        ((0, 0), (3, 3), 3.0, 9.0, 0.0),
    ],
)
def test_metric_identities(spark, truth, prediction, mae, mse, r2):
    row = metrics.regression_metrics(pairs(spark, truth, prediction), ONE).first()
    assert row["mae"] == pytest.approx(mae) and row["mse"] == pytest.approx(mse)
    assert row["rmse"] == pytest.approx(math.sqrt(mse)) and row["r2"] == pytest.approx(r2, abs=1e-12)


def test_metrics_skip_incomplete_rows_and_group(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", None, 5.0), ("a", 3.0, float("nan")), ("b", 4.0, 4.0)], "g string, y double, p double"
    )
    got = by(metrics.regression_metrics(df, ONE, ["g"]), "g")
    assert got["a"]["n"] == 1 and got["a"]["mae"] == 1.0 and got["b"]["r2"] == 1.0
    assert metrics.drop_unscored(df, ONE).count() == 2
    check = metrics.null_prediction_check(df, ONE).first()
    assert (check["rows"], check["null_predictions"], check["status"]) == (4, 1, "failed")
    assert metrics.regression_metrics(df.filter("g = 'z'"), ONE).first()["r2"] is None


def test_report_and_thresholds(spark):
    df = pairs(spark, (0, 10, 20), (4, 18, 30))
    row = metrics.regression_report(df, ONE).first()
    assert row["mean_error"] == pytest.approx(22 / 3) and row["max_abs_error"] == 10.0
    assert row["mape"] == pytest.approx((0.8 + 0.5) / 2 * 100)
    tests = by(metrics.threshold_tests(df, ONE), "test")
    assert not tests["mean_error"]["passed"] and tests["rmse"]["passed"]
    assert by(metrics.threshold_tests(pairs(spark, (9, 9), (1, 1)), ONE), "test")["mean_error"]["passed"]


def test_residual_views(spark):
    df = pairs(spark, (0, 10, 20), (4, 18, 30))
    assert [r["residual_t"] for r in metrics.residuals(df, ONE).collect()] == [-4.0, -8.0, -10.0]
    assert metrics.residual_bins(df, "y", "p", 5).agg(F.sum("count")).first()[0] == 3
    assert metrics.predicted_vs_actual_bins(df, "y", "p", 5).count() == 3
    assert metrics.residual_bins(df.filter("y > 99"), "y", "p").count() == 0


def brute_ks(a, b):
    points = sorted(set(a) | set(b))
    a, b = np.sort(a), np.sort(b)
    gaps = [abs(np.searchsorted(a, v, "right") / len(a) - np.searchsorted(b, v, "right") / len(b)) for v in points]
    d = max(gaps)
    lam = d * math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    if lam < 0.2:
        return d, 1.0
    p = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    return d, min(1.0, max(0.0, p))


def table(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(3)


def ks(spark, a, b, alpha=0.05):
    return drift.ks_drift(table(spark, a), table(spark, b), ["x"], alpha).collect()


def test_ks_hand_cases(spark):
    same = ks(spark, [1, 2, 3], [1, 2, 3])[0]
    assert same["ks_statistic"] == 0.0 and same["p_value"] == 1.0 and not same["drift_detected"]
    assert ks(spark, [1, 2, 3], [7, 8, 9])[0]["ks_statistic"] == 1.0
    assert ks(spark, [1, 2, 3, 4], [3, 4, 5, 6])[0]["ks_statistic"] == 0.5
    assert ks(spark, [None, None], [1, 2]) == []


@pytest.mark.parametrize("kind", ["same", "shifted", "hot", "coarse", "outliers"])
def test_ks_matches_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(drift, "EXACT_VALUES", 0)
    rng = random.Random(kind)
    a = [rng.gauss(0, 1) for _ in range(3000)]
    b = [rng.gauss(0.5 if kind == "shifted" else 0, 1) for _ in range(2000)]
    if kind == "hot":
        a, b = a + [0.25] * 3000, b + [0.25] * 500
    if kind == "coarse":
        a, b = [round(v) for v in a], [round(v * 1.2) for v in b]
    if kind == "outliers":
        a, b = a + [1e9, float("inf")], b + [-1e9, -float("inf")]
    got = ks(spark, [*a, None], [*b, float("nan")])[0]
    d, p = brute_ks(a, b)
    assert got["ks_statistic"] == pytest.approx(d, abs=1e-12) and got["p_value"] == pytest.approx(p, abs=1e-9)
    assert got["drift_detected"] == (p < 0.05)


def counted_p(n, m, gap):
    """Share of the lattice paths that reach a gap, by whole numbers."""
    inside = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * m - j * n) < gap:
                inside[i][j] = 1 if i == j == 0 else (inside[i - 1][j] if i else 0) + (inside[i][j - 1] if j else 0)
    return Fraction(math.comb(n + m, n) - inside[n][m], math.comb(n + m, n))


def test_exact_p_values_equal_counted_paths():
    draw = random.Random(6)
    sizes = [(1, 1), (1, 5), (5, 5), (7, 5), (20, 30), (48, 16)]
    assert drift.exact_p_value(200, 150, 4000) == pytest.approx(float(counted_p(200, 150, 4000)), rel=1e-10)
    for n, m in sizes + [(draw.randint(2, 30), draw.randint(2, 30)) for _ in range(20)]:
        for gap in {0, 1, n * m, draw.randint(1, n * m), n * m // 3}:
            assert drift.exact_p_value(n, m, gap) == pytest.approx(float(counted_p(n, m, gap)), rel=1e-10)
    assert drift.exact_p_value(10_000, 9_999, 10_000 * 9_999 // 50) == pytest.approx(0.0366, abs=1e-3)


def test_small_sides_get_exact_p_values_and_flags_near_the_limits(spark, monkeypatch):
    seen = set()
    for n, m, shift in ((5, 8, 5), (12, 12, 6), (12, 12, 7), (30, 20, 11), (200, 180, 27), (9, 9, 7)):
        a, b = range(n), range(shift, m + shift)
        d = brute_ks(a, b)[0]
        p = float(counted_p(n, m, round(d * n * m)))
        for alpha in (0.05, 0.01):
            got = ks(spark, a, b, alpha)[0]
            assert got["p_value"] == pytest.approx(p, rel=1e-9) and got["drift_detected"] == (p < alpha)
            seen.add((alpha, p < alpha, brute_ks(a, b)[1] < alpha))
    assert {(0.05, True, True), (0.05, False, False)} <= seen
    monkeypatch.setattr(drift, "EXACT_VALUES", 8)
    assert ks(spark, range(9), range(4, 12))[0]["p_value"] == pytest.approx(brute_ks(range(9), range(4, 12))[1])


def test_ks_takes_more_cuts_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(drift, "ROWS_PER_CUT", 10)
    rng = random.Random(9)
    a, b = [rng.random() for _ in range(4000)], [rng.random() ** 1.1 for _ in range(4000)]
    both = drift.both_sides(table(spark, a), table(spark, b), ["x"])
    assert len(drift._cuts(both, ["x"])["x"]) > 500
    assert ks(spark, a, b)[0]["ks_statistic"] == pytest.approx(brute_ks(a, b)[0], abs=1e-12)


def test_moment_drift(spark):
    ref = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, 3.0)], "a double, b double, c double")
    cur = spark.createDataFrame([(9.0, 7.0, 1.1), (10.0, 8.0, 2.0), (11.0, 9.0, 3.0)], "a double, b double, c double")
    got = by(drift.moment_drift(ref, cur, ["a", "b", "c"]), "feature")
    assert got["a"]["mean_change"] == pytest.approx(8.0) and got["a"]["drift_detected"]
    assert got["b"]["mean_change"] == 0.0 and not got["b"]["drift_detected"]
    assert not got["c"]["drift_detected"]
    row = drift.overall_drift(drift.moment_drift(ref, cur, ["a", "b", "c"]), 3).first()
    assert (row["drift_count"], row["n_features"], row["overall_drift"]) == (1, 3, True)


def metric_rows(spark, rows):
    return spark.createDataFrame(rows, "target string, mae double, rmse double, r2 double")


def test_degradation_is_strict_and_signed(spark):
    ref = metric_rows(spark, [("h", 1.0, 1.0, 0.8), ("c", 1.0, 0.0, 0.0)])
    cur = metric_rows(spark, [("h", 1.25, 1.21, 0.4), ("c", 0.5, 3.0, 0.5)])
    got = {(r["target"], r["metric"]): r for r in monitoring.performance_degradation(ref, cur).collect()}
    assert not got["h", "mae"]["degraded"] and got["h", "rmse"]["degraded"] and got["h", "r2"]["degraded"]
    assert got["h", "r2"]["change_percent"] == pytest.approx(50.0)
    assert got["c", "rmse"]["change_percent"] is None and not got["c", "rmse"]["degraded"]


def sides(spark, shift, error):
    rows = [(float(i), float(i % 10), float(i), float(i) + (i % 3 - 1)) for i in range(300)]
    ref = spark.createDataFrame(rows, "f double, g double, y double, p double")
    cur = ref.withColumn("f", F.col("f") + shift).withColumn("p", F.col("p") + error)
    return ref, cur


CONFIG = MonitorConfig(["f", "g"], ONE)


def test_monitor_with_drift(spark):
    report = monitor(*sides(spark, 200.0, 50.0), CONFIG)
    alerts = [(r["severity"], r["kind"], r["subject"]) for r in report["alerts"].collect()]
    assert ("critical", "data_drift", "all") in alerts and ("warning", "feature_drift", "f") in alerts
    assert ("info", "drift_total", "all") in alerts and ("critical", "performance", "t") in alerts
    summary = report["summary"].first()
    assert summary["status"] == "act_now" and summary["warnings"] == 1
    assert summary["total_alerts"] == len(alerts)
    advice = [tuple(r) for r in report["recommendations"].collect()]
    assert advice == sorted(advice) and {p for p, _ in advice} == {1, 2, 3}
    assert (3, "trace f to where it is recorded") in advice
    assert {r["side"] for r in report["metrics"].collect()} == {"reference", "current"}


def test_monitor_all_clear(spark):
    report = monitor(*sides(spark, 0.0, 0.0), CONFIG)
    assert [r["kind"] for r in report["alerts"].collect()] == ["no_drift"]
    assert report["summary"].first()["status"] == "healthy" and report["summary"].first()["total_alerts"] == 0
    assert [tuple(r) for r in report["recommendations"].collect()] == [(5, "nothing to do")]
    assert report["scoring"].first()["status"] == "success"


def test_r2_advice_fires(spark):
    ref = metric_rows(spark, [("h", 1.0, 1.0, 0.8)])
    cur = metric_rows(spark, [("h", 1.0, 1.0, 0.1)])
    alerts = monitoring.performance_alerts(monitoring.performance_degradation(ref, cur))
    assert [tuple(r) for r in monitoring.recommendations(alerts).collect()] == [(1, "fit h again, its r2 lost 87.5%")]


def test_negative_r2_baseline_counts_by_its_size(spark):
    ref, cur = metric_rows(spark, [("h", 1.0, 1.0, -0.5)]), metric_rows(spark, [("h", 1.0, 1.0, -2.0)])
    got = by(monitoring.performance_degradation(ref, cur), "metric")["r2"]
    assert got["change_percent"] == 300.0 and got["degraded"]


def test_ks_without_features(spark):
    ref, cur = sides(spark, 0.0, 0.0)
    assert drift.ks_drift(ref, cur, []).count() == 0


def test_ks_refines_open_buckets(spark, monkeypatch):
    monkeypatch.setattr(drift, "FEW_ROWS", 0)
    monkeypatch.setattr(drift, "MIN_CUTS", 2)
    monkeypatch.setattr(drift, "MAX_CUTS", 2)
    draw = np.random.default_rng(8)
    a, b = draw.normal(size=4000), draw.normal(0.02, 1.0, size=3000)
    a[:500] = 0.25
    ref, cur = (spark.createDataFrame([(float(x),) for x in v], "x double") for v in (a, b))
    points = np.sort(np.concatenate([a, b]))
    want = np.abs(
        np.searchsorted(np.sort(a), points, "right") / len(a) - np.searchsorted(np.sort(b), points, "right") / len(b)
    ).max()
    assert drift.ks_statistics(ref, cur, ["x"]).first()["ks_statistic"] == pytest.approx(want, abs=1e-12)


def test_monitor_coerces_and_drops_incomplete_rows(spark):
    ref, cur = sides(spark, 0.0, 0.0)
    dirty = cur.withColumn("f", F.when(F.col("y") < 5, "error").otherwise(F.col("f").cast("string")))
    report = monitor(ref, dirty, CONFIG)
    assert by(report["metrics"], "side")["current"]["n"] == 295
    moments = monitor(ref, cur, MonitorConfig(["f", "g"], ONE, method="moments"))
    assert "mean_change" in moments["feature_drift"].columns
    with pytest.raises(ValueError):
        monitor(ref, cur, MonitorConfig(["f"], ONE, method="psi"))


def test_untestable_feature_is_reported(spark):
    ref, cur = sides(spark, 0.0, 0.0)
    found = drift.ks_drift(ref.withColumn("e", F.lit(None).cast("double")), cur.withColumn("e", F.lit(1.0)), ["f", "e"])
    alerts = monitoring.drift_alerts(found, drift.overall_drift(found, 2), ["f", "e"])
    assert [(r["kind"], r["subject"]) for r in alerts.filter("severity = 'warning'").collect()] == [("drift_error", "e")]


def test_error_drift_and_ratio(spark):
    ref, cur = sides(spark, 0.0, 5.0)
    errors = drift.error_drift(ref, cur, ONE)
    assert errors.first()["drift_detected"]
    m = metrics.regression_metrics
    assert monitoring.rmse_status(m(ref, ONE), m(cur, ONE), errors).first()["status"] == "drift"
    silent = errors.withColumn("drift_detected", F.lit(False))
    assert monitoring.rmse_status(m(ref, ONE), m(cur, ONE), silent).first()["status"] == "degraded"
    assert monitoring.rmse_status(m(ref, ONE), m(ref, ONE), silent).first()["status"] == "stable"


def test_quality_and_verdict(mini, spark):
    plain = mini.drop("row_id")
    row = compare.quality_comparison(plain, plain.dropDuplicates().na.drop()).first()
    assert (row["rows_original"], row["missing_original"], row["duplicates_original"]) == (9, 2, 1)
    assert (row["rows_cleaned"], row["missing_cleaned"], row["tier"]) == (6, 0, "low")
    dist = by(compare.distribution_comparison(plain, plain.limit(9), ["Y1"]), "column")["Y1"]
    assert dist["mean_abs_diff"] == 0.0
    a = spark.createDataFrame([("h", 1.0, 0.90), ("c", 1.0, 0.90)], "target string, mae double, r2 double")
    ranges = spark.createDataFrame([("h", 0.0, 10.0), ("c", 0.0, 20.0)], "target string, min double, max double")
    for r2, mae, tier, advice in [
        (0.91, 1.4, "excellent", "effective"),
        (0.94, 1.4, "good", "effective"),
        (0.91, 1.5, "excellent", "adequate"),
        (0.50, 1.0, "attention", "review"),
    ]:
        b = a.withColumns({"mae": F.lit(mae), "r2": F.lit(r2)})
        compared = compare.model_comparison(a, b, ranges)
        assert by(compared, "target")["c"]["mae_ref_percent"] == pytest.approx(5.0)
        verdict = compare.model_verdict(compared).first()
        assert (verdict["tier"], verdict["recommendation"]) == (tier, advice)


def test_normal_errors_lie_on_a_line_and_others_do_not(spark):
    rng = random.Random(12)
    rows = [(0.0, rng.gauss(1, 2), rng.expovariate(1)) for _ in range(2000)] + [(None, 1.0, 1.0), (1.0, float("nan"), None)]
    df = spark.createDataFrame(rows, "y double, p double, q double")
    got = by(residuals.error_normality(df, {"normal": ("y", "p"), "skewed": ("y", "q")}), "target")
    assert got["normal"]["points"] == 20 and got["normal"]["correlation"] > 0.995
    assert abs(got["normal"]["slope"] - 2) < 0.2 and abs(got["normal"]["intercept"] - 1) < 0.2
    assert got["skewed"]["correlation"] < 0.97


def test_few_errors_are_all_listed_and_none_give_no_rows(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (2.0, 2.5)], "y double, p double")
    got = residuals.error_quantiles(df, ONE).collect()
    assert [(r["rank"], r["observed"]) for r in got] == [(0, -1.0), (1, 0.5), (2, 2.0)]
    assert got[0]["theoretical"] == pytest.approx(-got[2]["theoretical"]) and got[1]["theoretical"] == pytest.approx(0, abs=1e-9)
    assert residuals.error_quantiles(df.limit(0), {"t": ("y", "p")}).count() == 0
    assert residuals.dummy_comparison(df.limit(0), {"t": ("y", "p")}).count() == 0


def test_best_constants_of_each_metric(spark):
    truth, model = [1.0, 2.0, 3.0, 10.0, 4.0], [1.0, 2.0, 3.0, 30.0, 4.0]
    got = by(residuals.dummy_comparison(pairs(spark, truth, model), {"t": ("y", "p")}), "metric")
    steps = [k / 100 for k in range(0, 1101)]
    best = {
        "rmse": min(math.sqrt(sum((y - c) ** 2 for y in truth) / 5) for c in steps),
        "mae": min(sum(abs(y - c) for y in truth) / 5 for c in steps),
        "max_abs_error": min(max(abs(y - c) for y in truth) for c in steps),
    }
    assert {m: got[m]["dummy"] for m in got} == pytest.approx(best) and got["mae"]["constant"] == 3.0
    assert not any(got[m]["better"] for m in got)
