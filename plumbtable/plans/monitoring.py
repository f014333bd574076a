"""The monitoring job: a reference table against a current one."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.operators.convert import coerce_columns
from plumbtable.operators.drift import DRIFT_SHARE, FEATURE_P, ks_drift, moment_drift, overall_drift
from plumbtable.operators.metrics import Targets, null_prediction_check, regression_metrics
from plumbtable.operators.missing import drop_any_null
from plumbtable.operators.monitoring import (
    DEGRADATION_LIMITS,
    drift_alerts,
    performance_alerts,
    performance_degradation,
    recommendations,
    report_summary,
)
from plumbtable.session import settle


@dataclass(frozen=True)
class MonitorConfig:
    features: list[str]
    targets: Targets
    feature_p: float = FEATURE_P
    drift_share: float = DRIFT_SHARE
    degradation_limits: dict[str, float] = field(default_factory=lambda: dict(DEGRADATION_LIMITS))
    method: str = "ks"


def prepare_side(df: DataFrame, config: MonitorConfig) -> DataFrame:
    """Project the expected columns, coerce them, and keep complete rows."""
    pairs = [c for pair in config.targets.values() for c in pair]
    columns = list(dict.fromkeys([*config.features, *pairs]))
    return drop_any_null(coerce_columns(df.select(*columns), columns))


def monitor(reference: DataFrame, current: DataFrame, config: MonitorConfig) -> dict[str, DataFrame]:
    """``metrics, degradation, feature_drift, overall_drift, alerts, recommendations, summary, scoring, thresholds``.

    The aggregates are a few rows; they are settled once so that the alert tables built on them
    do not scan the data again.
    """
    if config.method not in ("ks", "moments"):
        raise ValueError(f"method must be 'ks' or 'moments', got {config.method!r}")
    spark = reference.sparkSession
    scoring = settle(null_prediction_check(current, config.targets), "monitor")
    ref, cur = prepare_side(reference, config), prepare_side(current, config)

    def sides(df: DataFrame, name: str) -> DataFrame:
        return regression_metrics(df, config.targets).withColumn("side", F.lit(name))

    metrics = settle(sides(ref, "reference").unionByName(sides(cur, "current")), "monitor")
    degradation = performance_degradation(
        metrics.filter("side = 'reference'"), metrics.filter("side = 'current'"), config.degradation_limits
    )
    if config.method == "ks":
        drift = ks_drift(ref, cur, config.features, config.feature_p)
    else:
        drift = moment_drift(ref, cur, config.features)
    drift = settle(drift, "monitor")
    overall = overall_drift(drift, len(config.features), config.drift_share)
    alerts = settle(
        performance_alerts(degradation).unionByName(
            drift_alerts(drift, overall, config.features, config.drift_share)
        ),
        "monitor",
    )
    limits = [("performance", f"{m}_degradation", float(v)) for m, v in config.degradation_limits.items()]
    limits += [("drift", "share", config.drift_share), ("drift", "feature_p", config.feature_p)]
    return {
        "metrics": metrics,
        "degradation": degradation,
        "feature_drift": drift,
        "overall_drift": overall,
        "alerts": alerts,
        "recommendations": recommendations(alerts),
        "summary": report_summary(alerts),
        "scoring": scoring,
        "thresholds": spark.createDataFrame(limits, "group string, name string, value double"),
    }

