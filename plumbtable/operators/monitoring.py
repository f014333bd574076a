"""Degradation, alerts, recommendations and the report summary, as small typed tables.

Every table here has a row per target, metric or feature: nothing in it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.operators.drift import DRIFT_SHARE

# Tolerated relative change per metric, and the RMSE ratio that warns.
DEGRADATION_LIMITS = {"rmse": 0.20, "mae": 0.25, "r2": 0.15}
RMSE_RATIO_LIMIT = 1.2

# What to do about an alert of a kind, in this order: ``%s`` stands for its subject, metric or share.
ADVICE_KINDS = ("performance", "data_drift", "feature_drift", "drift_error", "none")


def performance_degradation(
    reference: DataFrame, current: DataFrame, limits: dict[str, float] | None = None
) -> DataFrame:
    """Percent change of each metric, up = worse for errors and down = worse for R2, against its limit.

    Inputs are tables of :func:`regression_metrics`. A zero baseline has no percentage.
    """
    limits = limits or DEGRADATION_LIMITS

    def long(df: DataFrame, name: str) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name)) for m in limits]
        return df.select("target", F.inline(F.array(*cells)))

    # One row per target and metric on either side.
    pairs = long(reference, "reference").join(F.broadcast(long(current, "current")), ["target", "metric"])
    rise = F.col("current") - F.col("reference")
    worse = F.when(F.col("metric") == "r2", -rise).otherwise(rise)
    limit = F.create_map(*[e for m, v in limits.items() for e in (F.lit(m), F.lit(v * 100.0))])
    change = F.try_divide(worse, F.abs("reference")) * 100
    return (
        pairs.withColumn("change_percent", change)
        .withColumn("limit_percent", limit[F.col("metric")])
        .withColumn("degraded", F.coalesce(F.col("change_percent") > F.col("limit_percent"), F.lit(False)))
    )


def performance_alerts(degradation: DataFrame) -> DataFrame:
    return degradation.filter("degraded").select(
        F.lit("critical").alias("severity"),
        F.lit("performance").alias("kind"),
        F.col("target").alias("subject"),
        "metric",
        F.col("change_percent").alias("value"),
        F.format_string(
            "%s: %s is worse by %.2f%%, allowed are %.1f%%",
            "target",
            "metric",
            "change_percent",
            "limit_percent",
        ).alias("message"),
    )


def drift_alerts(
    feature_drift: DataFrame, overall: DataFrame, features: list[str], limit: float = DRIFT_SHARE
) -> DataFrame:
    """Overall drift, one row per drifted or untestable feature, and the total or the all-clear."""
    no_metric = F.lit(None).cast("string").alias("metric")
    whole = overall.filter("overall_drift").select(
        F.lit("critical").alias("severity"),
        F.lit("data_drift").alias("kind"),
        F.lit("all").alias("subject"),
        no_metric,
        F.col("drift_share").alias("value"),
        F.format_string(
            "%.2f%% of all columns changed, allowed are %.1f%%",
            F.col("drift_share") * 100,
            F.lit(limit * 100),
        ).alias("message"),
    )
    if "p_value" in feature_drift.columns:
        value = F.col("p_value")
        detail = F.format_string("%s: another distribution, p = %.4f", "feature", "p_value")
    else:
        value = F.col("mean_change")
        detail = F.format_string(
            "%s: mean moved by %.2f, spread by %.2f deviations",
            "feature",
            "mean_change",
            "std_change",
        )
    single = feature_drift.filter("drift_detected").select(
        F.lit("warning").alias("severity"),
        F.lit("feature_drift").alias("kind"),
        F.col("feature").alias("subject"),
        no_metric,
        value.alias("value"),
        detail.alias("message"),
    )
    spark = feature_drift.sparkSession
    named = spark.createDataFrame([(f,) for f in features], "feature string")
    untested = named.join(F.broadcast(feature_drift.select("feature")), "feature", "left_anti").select(
        F.lit("warning").alias("severity"),
        F.lit("drift_error").alias("kind"),
        F.col("feature").alias("subject"),
        no_metric,
        F.lit(None).cast("double").alias("value"),
        F.format_string("%s: not tested, a side has no values", "feature").alias("message"),
    )
    some = F.col("drift_count") > 0
    total = overall.select(
        F.when(some, "info").otherwise("ok").alias("severity"),
        F.when(some, "drift_total").otherwise("no_drift").alias("kind"),
        F.lit("all").alias("subject"),
        no_metric,
        F.col("drift_count").cast("double").alias("value"),
        F.when(
            some, F.format_string("%d of %d columns changed", "drift_count", "n_features")
        )
        .otherwise("no column changed")
        .alias("message"),
    )
    return whole.unionByName(single).unionByName(untested).unionByName(total)


def recommendations(alerts: DataFrame) -> DataFrame:
    """What to do, a row per alert that calls for something: ``(position, recommendation)``.

    Each names the alert's own target, column or share; ``position`` is the kind's place in ``ADVICE_KINDS``.
    """
    texts = {
        "performance": F.format_string("fit %s again, its %s lost %.1f%%", "subject", "metric", "value"),
        "data_drift": F.format_string("compare the two sources, %.1f%% of the columns differ", F.col("value") * 100),
        "feature_drift": F.format_string("trace %s to where it is recorded", "subject"),
        "drift_error": F.format_string("fill %s or leave it out", "subject"),
    }
    place = F.create_map(*[e for i, k in enumerate(ADVICE_KINDS) for e in (F.lit(k), F.lit(i + 1))])
    text = F.coalesce(*[F.when(F.col("kind") == k, t) for k, t in texts.items()])
    named = alerts.filter(F.col("kind").isin(list(texts))).select(place[F.col("kind")].alias("position"), text.alias("recommendation"))
    quiet = alerts.agg(F.count_if(F.col("severity") != "ok").alias("n")).filter("n = 0")
    quiet = quiet.select(F.lit(len(ADVICE_KINDS)).alias("position"), F.lit("nothing to do").alias("recommendation"))
    return named.unionByName(quiet).orderBy("position", "recommendation")


def report_summary(alerts: DataFrame) -> DataFrame:
    """Alert counts and the verdict; the all-clear row is not an alert."""
    total = F.count_if(F.col("severity") != "ok")
    critical = F.count_if(F.col("severity") == "critical")
    return alerts.agg(
        total.alias("total_alerts"),
        critical.alias("critical_issues"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.when(critical > 0, "act_now").when(total > 0, "watch").otherwise("healthy").alias("status"),
    )


def rmse_status(
    reference: DataFrame, current: DataFrame, errors: DataFrame, ratio: float = RMSE_RATIO_LIMIT
) -> DataFrame:
    """Per target: ``drift`` when the error test fires, ``degraded`` when RMSE grew past the ratio, else ``stable``."""
    ref = reference.select("target", F.col("rmse").alias("rmse_ref"), F.col("mae").alias("mae_ref"))
    cur = current.select("target", F.col("rmse").alias("rmse_cur"), F.col("mae").alias("mae_cur"))
    # One row per target on every side.
    return (
        ref.join(F.broadcast(cur), "target")
        .join(F.broadcast(errors.select("target", "drift_detected")), "target", "left")
        .withColumn("rmse_ratio", F.try_divide("rmse_cur", "rmse_ref"))
        .withColumn(
            "status",
            F.when(F.col("drift_detected"), "drift")
            .when(F.col("rmse_cur") > F.lit(ratio) * F.col("rmse_ref"), "degraded")
            .otherwise("stable"),
        )
    )

