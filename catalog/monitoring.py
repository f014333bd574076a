"""Model quality, drift, alerts and the comparison of cleaned with original data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.cleaning import NUMBERS, SCORE_SQL, SCORED_K
from catalog.tables import (
    FEATURES,
    PREDICTIONS_SQL,
    SIDES_SQL,
    TARGETS,
    TYPED_SQL,
    predictions,
    rounded,
    sides,
    table,
    typed,
)
from plumbtable.operators import compare, drift, metrics, monitoring, residuals
from plumbtable.operators.profile import min_max
from plumbtable.plans.cleaning import scoring_cleaner
from plumbtable.plans.monitoring import MonitorConfig, monitor

PAIRS = [("heating", "y1", "p1"), ("cooling", "y2", "p2")]


def _union(parts):
    return " UNION ALL ".join(parts)


def metrics_sql(source, by=""):
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return _union(
        f"""SELECT {keys}'{t}' AS target, count(*) AS n, avg(abs({p} - {y})) AS mae, avg(pow({p} - {y}, 2)) AS mse,
sqrt(avg(pow({p} - {y}, 2))) AS rmse, 1 - sum(pow({p} - {y}, 2)) / (var_pop({y}) * count(*)) AS r2 FROM {source}{group}"""
        for t, y, p in PAIRS
    )


ROUND_METRICS = "n, round(mae, 4) AS mae, round(mse, 4) AS mse, round(rmse, 4) AS rmse, round(r2, 4) AS r2"


@query(f"WITH {PREDICTIONS_SQL} SELECT target, {ROUND_METRICS} FROM ({metrics_sql('predictions')})")
def regression_metrics(spark, sf):
    return rounded(metrics.regression_metrics(predictions(spark, sf), TARGETS))


@query(
    f"WITH {PREDICTIONS_SQL} SELECT l_returnflag, target, {ROUND_METRICS} FROM ({metrics_sql('predictions', 'l_returnflag')})"
)
def regression_metrics_by_group(spark, sf):
    return rounded(metrics.regression_metrics(predictions(spark, sf), TARGETS, ["l_returnflag"]))


@query(
    f"WITH {SIDES_SQL}, sided AS (SELECT 'reference' AS side, * FROM ref UNION ALL SELECT 'current', * FROM cur) "
    + _union(
        f"""SELECT side, '{t}' AS target, count(*) AS n, round(avg({p} - {y}), 4) AS mean_error, round(avg(abs({p} - {y})), 4) AS mae,
round(max(abs({p} - {y})), 4) AS max_abs_error, round(avg(abs(({p} - {y}) / {y})) FILTER ({y} <> 0) * 100, 4) AS mape,
round(sqrt(avg(pow({p} - {y}, 2))), 4) AS rmse, round(1 - sum(pow({p} - {y}, 2)) / (var_pop({y}) * count(*)), 4) AS r2
FROM sided GROUP BY side"""
        for t, y, p in PAIRS
    )
)
def regression_report(spark, sf):
    ref, cur = sides(spark, sf)
    both = ref.withColumn("side", F.lit("reference")).unionByName(cur.withColumn("side", F.lit("current")))
    return rounded(metrics.regression_report(both, TARGETS, ["side"]))


# Wichura's rational approximation AS 241 of the normal quantile, coefficients from the highest power down.
_CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125,
     1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077,
     687.1870074920579083, 42.313330701600911252, 1.0),
)
_TAIL = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0),
)


def _ratio(parts, x):
    horner = lambda cs: "(" * (len(cs) - 1) + str(cs[0]) + "".join(f" * {x} + {c})" for c in cs[1:])
    return f"{horner(parts[0])} / {horner(parts[1])}"


def normal_quantile_sql(p):
    """The normal quantile of shares between 1e-10 and 1 - 1e-10."""
    q, tail = f"({p} - 0.5)", f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    centre = f"{q} * {_ratio(_CENTRE, f'(0.180625 - {q} * {q})')}"
    return f"CASE WHEN abs{q} <= 0.425 THEN {centre} ELSE sign{q} * ({_ratio(_TAIL, tail)}) END"


QQ_SQL = f"""WITH {PREDICTIONS_SQL}, errors AS (
  SELECT 'heating' AS target, p1 - y1 AS e FROM predictions UNION ALL SELECT 'cooling', p2 - y2 FROM predictions),
ranked AS (SELECT target, e, row_number() OVER (PARTITION BY target ORDER BY e) - 1 AS r, count(*) OVER (PARTITION BY target) AS n FROM errors),
picked AS (SELECT target, r, e, (r + 1 - 0.3175) / (n + 0.365) AS p FROM ranked
  WHERE r IN (SELECT CAST(floor((k + 0.5) / 20 * n) AS BIGINT) FROM range(0, 20) t(k))),
qq AS (SELECT target, r AS rank, {normal_quantile_sql('p')} AS theoretical, e AS observed FROM picked)"""


@query(f"{QQ_SQL} SELECT target, rank, round(theoretical, 6) AS theoretical, round(observed, 6) AS observed FROM qq")
def error_quantiles(spark, sf):
    """Errors at even ranks beside the normal values of these ranks."""
    return rounded(residuals.error_quantiles(predictions(spark, sf), TARGETS), 6)


@query(
    f"""{QQ_SQL} SELECT target, count(*) AS points, round(regr_slope(observed, theoretical), 5) AS slope,
  round(regr_intercept(observed, theoretical), 5) AS intercept, round(corr(observed, theoretical), 5) AS correlation FROM qq GROUP BY target"""
)
def error_normality(spark, sf):
    return rounded(residuals.error_normality(predictions(spark, sf), TARGETS), 5)


def _dummy_sql(t, y, p):
    s = f"(SELECT avg({y}) AS mean, median({y}) AS mid, (max({y}) + min({y})) / 2 AS centre FROM predictions) s"
    parts = (
        ("rmse", "mean", f"sqrt(avg(pow({y} - mean, 2)))", f"sqrt(avg(pow({p} - {y}, 2)))"),
        ("mae", "mid", f"avg(abs({y} - mid))", f"avg(abs({p} - {y}))"),
        ("max_abs_error", "centre", f"max(abs({y} - centre))", f"max(abs({p} - {y}))"),
    )
    return _union(
        f"SELECT '{t}' AS target, '{name}' AS metric, any_value({c}) AS constant, {dummy} AS dummy, {model} AS model FROM predictions, {s}"
        for name, c, dummy, model in parts
    )


@query(
    f"""WITH {PREDICTIONS_SQL}, d AS ({_union(_dummy_sql(*pair) for pair in PAIRS)})
SELECT target, metric, round(constant, 4) AS constant, round(dummy, 4) AS dummy, round(model, 4) AS model, model < dummy AS better FROM d"""
)
def dummy_comparison(spark, sf):
    """Each metric beside its value for the constant that is best for it."""
    return rounded(residuals.dummy_comparison(predictions(spark, sf), TARGETS))


def _bins_sql(x, y):
    return f"""WITH {PREDICTIONS_SQL}, v AS (SELECT {x} AS x, {y} AS y FROM predictions),
s AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM v)
SELECT CAST(least(floor((x - xl) / ((xh - xl) / 30)), 29) AS INTEGER) AS bin_x,
  CAST(least(floor((y - yl) / ((yh - yl) / 30)), 29) AS INTEGER) AS bin_y, count(*) AS "count" FROM v, s GROUP BY 1, 2"""


@query(_bins_sql("p1", "y1 - p1"))
def residual_bins(spark, sf):
    return metrics.residual_bins(predictions(spark, sf), "y1", "p1")


@query(_bins_sql("y2", "p2"))
def predicted_actual_bins(spark, sf):
    return metrics.predicted_vs_actual_bins(predictions(spark, sf), "y2", "p2")


@query(
    f"WITH {PREDICTIONS_SQL} SELECT l_orderkey, round(y1 - p1, 8) AS residual_heating, round(y2 - p2, 8) AS residual_cooling "
    "FROM predictions"
)
def residual_rows(spark, sf):
    out = metrics.residuals(predictions(spark, sf), TARGETS)
    return rounded(out.select("l_orderkey", "residual_heating", "residual_cooling"), 8)


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT l_orderkey, round(p1, 8) AS prediction_heating, round(p2, 8) AS prediction_cooling FROM predictions"""
)
def multi_target_columns(spark, sf):
    """One prediction column per target, side by side in the row they score."""
    return rounded(
        predictions(spark, sf).select(
            "l_orderkey", F.col("p1").alias("prediction_heating"), F.col("p2").alias("prediction_cooling")
        ),
        8,
    )


KS_SQL = """
long AS ({rows}),
cnt AS (SELECT feature, v, sum(r)::DOUBLE AS r, sum(c)::DOUBLE AS c FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS n,
  sum(c) OVER (PARTITION BY feature) AS m FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY v)),
d AS (SELECT feature, n, m, max(abs(cr / n - cc / m)) AS d FROM cum GROUP BY feature, n, m),
l AS (SELECT feature, n, m, d, n + m AS t, round(d * n * m) AS h, d * sqrt(n * m / (n + m)) AS lam FROM d),
series AS (SELECT feature, n, m, t, h, d, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
  (SELECT sum(CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * lam * lam)) FROM range(1, 101) u(j)))) END AS asymptotic FROM l),
exact AS (SELECT feature, list_reduce(
  [[s::DOUBLE] for s in range(1, t::BIGINT + 1)],
  lambda held, e: list_concat([greatest(0, e[1] - m, floor((e[1] * n - h) / t) + 1)], list_transform(
    range(greatest(0, e[1] - m, floor((e[1] * n - h) / t) + 1)::BIGINT, least(n, e[1], ceil((e[1] * n + h) / t) - 1)::BIGINT + 1),
    lambda i: i / e[1] * CASE WHEN i - 1 < held[1] THEN 1.0 ELSE coalesce(held[(i - held[1] + 1)::BIGINT], 1.0) END
      + (e[1] - i) / e[1] * CASE WHEN i < held[1] THEN 1.0 ELSE coalesce(held[(i - held[1] + 2)::BIGINT], 1.0) END)),
  [0.0::DOUBLE, 0.0])[2] AS p FROM l WHERE greatest(n, m) <= 10000 AND h > 0),
ks AS (SELECT s.feature, s.d AS ks_statistic, CASE WHEN greatest(s.n, s.m) > 10000 THEN asymptotic ELSE coalesce(e.p, 1.0) END AS p_value
  FROM series s LEFT JOIN exact e ON e.feature = s.feature)"""


def ks_sql(columns, ref="ref", cur="cur"):
    """``columns``: feature name -> SQL expression."""
    rows = _union(
        f"SELECT '{f}' AS feature, {e} AS v, {int(t == ref)} AS r, {int(t == cur)} AS c FROM {t}"
        for f, e in columns.items()
        for t in (ref, cur)
    )
    return KS_SQL.format(rows=rows)


FEATURE_KS_SQL = f"WITH {SIDES_SQL}, {ks_sql({f: f for f in FEATURES})}"
FEATURE_KS = "SELECT feature, round(ks_statistic, 8) AS ks_statistic, round(p_value, 6) AS p_value, p_value < {p} AS drift_detected FROM ks"


def _ks_rounded(df):
    return df.withColumns({"ks_statistic": F.round("ks_statistic", 8), "p_value": F.round("p_value", 6)})


@query(f"{FEATURE_KS_SQL} {FEATURE_KS.format(p=0.05)}")
def ks_feature_drift(spark, sf):
    return _ks_rounded(drift.ks_drift(*sides(spark, sf), FEATURES))


SMALL_KS_COLUMNS = ["c_acctbal", "c_custkey", "c_nationkey"]


@query(
    _union(
        f"""SELECT '{name}' AS sides, * FROM (WITH ref AS (SELECT * FROM customer WHERE c_custkey % 50 < {n}),
cur AS (SELECT * FROM customer WHERE c_custkey % 50 BETWEEN 20 AND {19 + m}), {ks_sql({c: c for c in SMALL_KS_COLUMNS})}
{FEATURE_KS.format(p=0.05)})"""
        for name, n, m in (("1 and 2", 1, 2), ("3 and 7", 3, 7), ("7 and 7", 7, 7))
    )
)
def ks_small_sides(spark, sf):
    """Sides of few customers: p-values of counted paths."""
    df = table(spark, sf, "customer")
    part = F.col("c_custkey") % 50
    found = [
        _ks_rounded(drift.ks_drift(df.where(part < n), df.where(part.between(20, 19 + m)), SMALL_KS_COLUMNS)).select(
            F.lit(name).alias("sides"), "*"
        )
        for name, n, m in (("1 and 2", 1, 2), ("3 and 7", 3, 7), ("7 and 7", 7, 7))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


PRICE_KS_SQL = f"""WITH ref AS (SELECT * FROM lineitem WHERE l_returnflag = 'A'), cur AS (SELECT * FROM lineitem WHERE l_returnflag <> 'A'),
{ks_sql({c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")})}"""


@query(f"{PRICE_KS_SQL} {FEATURE_KS.format(p=0.05)}")
def ks_without_drift(spark, sf):
    """Two parts of one distribution: the statistic is small and the exact step has the most to do."""
    df = table(spark, sf, "lineitem")
    flag = F.col("l_returnflag") == "A"
    return _ks_rounded(
        drift.ks_drift(df.filter(flag), df.filter(~flag), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    )


@query(
    f"""{FEATURE_KS_SQL} SELECT count(*) FILTER (p_value < 0.05) AS drift_count, 3::BIGINT AS n_features,
round(count(*) FILTER (p_value < 0.05) / 3.0, 4)::DOUBLE AS drift_share, count(*) FILTER (p_value < 0.05) / 3.0 > 0.3 AS overall_drift FROM ks"""
)
def drift_share(spark, sf):
    found = drift.ks_drift(*sides(spark, sf), FEATURES)
    return rounded(drift.overall_drift(found, len(FEATURES)))


def _moment(f):
    stat = "(SELECT {g}({f}) FROM {t})"
    s = {k: stat.format(g=g, f=f, t=t) for k, g, t in
         (("rm", "avg", "ref"), ("cm", "avg", "cur"), ("rs", "stddev_samp", "ref"), ("cs", "stddev_samp", "cur"))}
    return (
        f"SELECT '{f}' AS feature, abs({s['cm']} - {s['rm']}) / {s['rs']} AS mean_change, "
        f"abs({s['cs']} - {s['rs']}) / {s['rs']} AS std_change"
    )


MOMENTS_SQL = f"WITH {SIDES_SQL}, moments AS ({_union(_moment(f) for f in FEATURES)})"


@query(
    f"""{MOMENTS_SQL} SELECT feature, round(mean_change, 4) AS mean_change, round(std_change, 4) AS std_change,
mean_change > 2 OR std_change > 1 AS drift_detected FROM moments"""
)
def moment_drift(spark, sf):
    return rounded(drift.moment_drift(*sides(spark, sf), FEATURES))


DEGRADATION_SQL = f"""
rm AS ({metrics_sql("ref")}), cm AS ({metrics_sql("cur")}),
pairs AS (SELECT r.target, m.metric,
    CASE m.metric WHEN 'rmse' THEN r.rmse WHEN 'mae' THEN r.mae ELSE r.r2 END AS reference,
    CASE m.metric WHEN 'rmse' THEN c.rmse WHEN 'mae' THEN c.mae ELSE c.r2 END AS current,
    m.limit_percent FROM rm r JOIN cm c ON r.target = c.target,
  (VALUES ('rmse', 20.0::DOUBLE), ('mae', 25.0::DOUBLE), ('r2', 15.0::DOUBLE)) m(metric, limit_percent)),
degradation AS (SELECT *, CASE WHEN metric = 'r2' THEN reference - current ELSE current - reference END / reference * 100
  AS change_percent FROM pairs)"""


@query(
    f"""WITH {SIDES_SQL}, {DEGRADATION_SQL} SELECT target, metric, round(reference, 4) AS reference, round(current, 4) AS current,
round(change_percent, 4) AS change_percent, limit_percent, change_percent > limit_percent AS degraded FROM degradation"""
)
def perf_degradation(spark, sf):
    ref, cur = (metrics.regression_metrics(s, TARGETS) for s in sides(spark, sf))
    return rounded(monitoring.performance_degradation(ref, cur))


ALERTS_SQL = f"""{FEATURE_KS_SQL}, {DEGRADATION_SQL},
overall AS (SELECT count(*) FILTER (p_value < 0.05) AS dc, count(*) FILTER (p_value < 0.05) / 3.0::DOUBLE AS share FROM ks),
alerts AS (
  SELECT 'critical' AS severity, 'performance' AS kind, target AS subject, metric, change_percent AS value,
    printf('%s: %s is worse by %.2f%%, allowed are %.1f%%', target, metric, change_percent, limit_percent) AS message
  FROM degradation WHERE change_percent > limit_percent
  UNION ALL SELECT 'critical', 'data_drift', 'all', NULL, share,
    printf('%.2f%% of all columns changed, allowed are %.1f%%', share * 100, 30.0::DOUBLE) FROM overall WHERE share > 0.3
  UNION ALL SELECT 'warning', 'feature_drift', feature, NULL, p_value,
    printf('%s: another distribution, p = %.4f', feature, p_value) FROM ks WHERE p_value < 0.05
  UNION ALL SELECT CASE WHEN dc > 0 THEN 'info' ELSE 'ok' END, CASE WHEN dc > 0 THEN 'drift_total' ELSE 'no_drift' END, 'all', NULL, dc::DOUBLE,
    CASE WHEN dc > 0 THEN printf('%d of %d columns changed', dc, 3) ELSE 'no column changed' END FROM overall)"""


def monitored(spark, sf):
    ref, cur = sides(spark, sf)
    return monitor(ref, cur, MonitorConfig(FEATURES, TARGETS))


@query(f"{ALERTS_SQL} SELECT severity, kind, subject, metric, round(value, 4) AS value, message FROM alerts")
def drift_alerts(spark, sf):
    return rounded(monitored(spark, sf)["alerts"])


@query(
    f"""{ALERTS_SQL}
SELECT 1 AS position, printf('fit %s again, its %s lost %.1f%%', subject, metric, value) AS recommendation
FROM alerts WHERE kind = 'performance'
UNION ALL SELECT 2, printf('compare the two sources, %.1f%% of the columns differ', value * 100) FROM alerts WHERE kind = 'data_drift'
UNION ALL SELECT 3, printf('trace %s to where it is recorded', subject) FROM alerts WHERE kind = 'feature_drift'
UNION ALL SELECT 5, 'nothing to do' WHERE NOT EXISTS (SELECT 1 FROM alerts WHERE severity <> 'ok')"""
)
def recommendations(spark, sf):
    return monitored(spark, sf)["recommendations"]


@query(
    f"""{ALERTS_SQL} SELECT count(*) FILTER (severity <> 'ok') AS total_alerts, count(*) FILTER (severity = 'critical') AS critical_issues,
count(*) FILTER (severity = 'warning') AS warnings, CASE WHEN count(*) FILTER (severity = 'critical') > 0 THEN 'act_now'
WHEN count(*) FILTER (severity <> 'ok') > 0 THEN 'watch' ELSE 'healthy' END AS status FROM alerts"""
)
def report_summary(spark, sf):
    return monitored(spark, sf)["summary"]


@query(
    f"""WITH {SIDES_SQL}, m AS ({_union(f"SELECT '{t}' AS target, avg({p} - {y}) AS me, sqrt(avg(pow({p} - {y}, 2))) AS rmse FROM cur" for t, y, p in PAIRS)})
SELECT target, 'mean_error' AS test, round(me, 4) AS value, 5.0::DOUBLE AS "limit", me < 5 AS passed FROM m
UNION ALL SELECT target, 'rmse', round(rmse, 4), 10.0, rmse < 10 FROM m"""
)
def threshold_tests(spark, sf):
    return rounded(metrics.threshold_tests(sides(spark, sf)[1], TARGETS))


ERROR_KS_SQL = f"WITH {SIDES_SQL}, {ks_sql({'heating': 'p1 - y1', 'cooling': 'p2 - y2'})}"


@query(
    f"{ERROR_KS_SQL} SELECT feature AS target, round(ks_statistic, 8) AS ks_statistic, round(p_value, 6) AS p_value, "
    "p_value < 0.01 AS drift_detected FROM ks"
)
def error_drift(spark, sf):
    return _ks_rounded(drift.error_drift(*sides(spark, sf), TARGETS))


@query(
    f"""{ERROR_KS_SQL}, rm AS ({metrics_sql("ref")}), cm AS ({metrics_sql("cur")})
SELECT r.target, round(r.rmse, 4) AS rmse_ref, round(r.mae, 4) AS mae_ref, round(c.rmse, 4) AS rmse_cur, round(c.mae, 4) AS mae_cur,
  p_value < 0.01 AS drift_detected, round(c.rmse / r.rmse, 4) AS rmse_ratio,
  CASE WHEN p_value < 0.01 THEN 'drift' WHEN c.rmse > 1.2 * r.rmse THEN 'degraded' ELSE 'stable' END AS status
FROM rm r JOIN cm c ON r.target = c.target JOIN ks ON feature = r.target"""
)
def rmse_ratio(spark, sf):
    ref, cur = sides(spark, sf)
    errors = drift.error_drift(ref, cur, TARGETS)
    return rounded(
        monitoring.rmse_status(
            metrics.regression_metrics(ref, TARGETS), metrics.regression_metrics(cur, TARGETS), errors
        )
    )


@query(
    f"""WITH {TYPED_SQL}
SELECT 'heating' AS target, count(*) AS rows, count(*) - count(value) AS null_predictions,
  CASE WHEN count(*) > count(value) THEN 'failed' ELSE 'success' END AS status FROM typed
UNION ALL SELECT 'cooling', count(*), count(*) - count(event_id),
  CASE WHEN count(*) > count(event_id) THEN 'failed' ELSE 'success' END FROM typed"""
)
def null_prediction_check(spark, sf):
    targets = {"heating": ("k", "value"), "cooling": ("k", "event_id")}
    return metrics.null_prediction_check(typed(spark, sf), targets)


COMPARE_SQL = f"""WITH {SCORE_SQL}, a AS (SELECT value, user_id, k FROM typed),
c AS (SELECT DISTINCT value, user_id, {SCORED_K} FROM imputed)"""


def _versions(spark, sf):
    """The dirty table, and the same after filling, rare-to-mode and dedup."""
    df = typed(spark, sf).select("value", "user_id", "k")
    return df, scoring_cleaner(NUMBERS, ["k"], dedup=True).fit(df).transform(df)


def _missing(t):
    return f"(SELECT sum((value IS NULL)::INT + (user_id IS NULL)::INT + (k IS NULL)::INT)::BIGINT FROM {t})"


@query(
    f"""{COMPARE_SQL}, n AS (SELECT (SELECT count(*) FROM a) AS ra, (SELECT count(*) FROM c) AS rc),
d AS (SELECT ra - (SELECT count(*) FROM (SELECT DISTINCT * FROM a)) AS da FROM n)
SELECT ra AS rows_original, {_missing("a")} AS missing_original, da AS duplicates_original, rc AS rows_cleaned,
  {_missing("c")} AS missing_cleaned, 0::BIGINT AS duplicates_cleaned, round(rc * 100.0 / ra, 4)::DOUBLE AS recovery_percent,
  CASE WHEN rc * 100.0 / ra >= 95 THEN 'excellent' WHEN rc * 100.0 / ra >= 90 THEN 'good' ELSE 'low' END AS tier FROM n, d"""
)
def quality_compare(spark, sf):
    return rounded(compare.quality_comparison(*_versions(spark, sf)))


@query(
    f"{COMPARE_SQL} "
    + _union(
        f"""SELECT '{x}' AS "column", round((SELECT avg({x}) FROM a), 4) AS mean_ref, round((SELECT avg({x}) FROM c), 4) AS mean_cur,
round((SELECT stddev_samp({x}) FROM a), 4) AS std_ref, round((SELECT stddev_samp({x}) FROM c), 4) AS std_cur,
round((SELECT skewness({x}) FROM a), 4) AS skew_ref, round((SELECT skewness({x}) FROM c), 4) AS skew_cur,
round(abs((SELECT avg({x}) FROM a) - (SELECT avg({x}) FROM c)), 4) AS mean_abs_diff,
round(abs((SELECT stddev_samp({x}) FROM a) - (SELECT stddev_samp({x}) FROM c)), 4) AS std_abs_diff"""
        for x in NUMBERS
    )
)
def dist_compare(spark, sf):
    return rounded(compare.distribution_comparison(*_versions(spark, sf), NUMBERS))


@query(
    f"""WITH {SIDES_SQL}, rm AS ({metrics_sql("ref")}), cm AS ({metrics_sql("cur")})
SELECT r.target, round(r.rmse, 4) AS rmse_ref, round(c.rmse, 4) AS rmse_cur, round(c.rmse - r.rmse, 4) AS rmse_diff,
  r.n AS n_ref, c.n AS n_cur, c.n - r.n AS n_diff FROM rm r JOIN cm c ON r.target = c.target"""
)
def compare_sides(spark, sf):
    ref, cur = (metrics.regression_metrics(s, TARGETS) for s in sides(spark, sf))
    return rounded(compare.pair_sides(ref, cur, ["target"], ["rmse", "n"]))


COMPARISON_SQL = f"""WITH {SIDES_SQL}, rm AS ({metrics_sql("ref")}), cm AS ({metrics_sql("cur")}),
span AS (SELECT 'heating' AS target, max(y1) - min(y1) AS s FROM ref UNION ALL SELECT 'cooling', max(y2) - min(y2) FROM ref),
cmp AS (SELECT r.target, r.mae AS mae_ref, c.mae AS mae_cur, r.r2 AS r2_ref, c.r2 AS r2_cur, s AS range, r.mae / s * 100 AS mae_ref_percent,
  c.mae / s * 100 AS mae_cur_percent, abs((c.r2 - r.r2) / r.r2 * 100) AS r2_diff_percent
  FROM rm r JOIN cm c ON r.target = c.target JOIN span ON span.target = r.target)"""


def _comparison(spark, sf):
    ref, cur = sides(spark, sf)
    ranges = min_max(ref, ["y1", "y2"]).withColumn(
        "target", F.when(F.col("column") == "y1", "heating").otherwise("cooling")
    )
    return compare.model_comparison(
        metrics.regression_metrics(ref, TARGETS), metrics.regression_metrics(cur, TARGETS), ranges
    )


@query(
    f"{COMPARISON_SQL} SELECT target, "
    + ", ".join(
        f"round({c}, 4) AS {c}"
        for c in ("mae_ref", "mae_cur", "r2_ref", "r2_cur", "range", "mae_ref_percent", "mae_cur_percent", "r2_diff_percent")
    )
    + " FROM cmp"
)
def model_comparison(spark, sf):
    return rounded(_comparison(spark, sf))


@query(
    f"""{COMPARISON_SQL}, v AS (SELECT avg(r2_diff_percent) AS d, bool_and(mae_cur < 1.5) AS ok FROM cmp)
SELECT round(d, 4) AS r2_avg_diff, ok AS mae_acceptable, CASE WHEN d < 3 THEN 'excellent' WHEN d < 5 THEN 'good' ELSE 'attention' END AS tier,
  CASE WHEN d < 5 AND ok THEN 'effective' WHEN d < 5 THEN 'adequate' ELSE 'review' END AS recommendation FROM v"""
)
def model_verdict(spark, sf):
    return rounded(compare.model_verdict(_comparison(spark, sf)))
