"""Cleaned against original: data quality, distributions and the verdict on models trained on both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.functions.columns import nan_to_null, sample_skewness

# Recovery tiers in percent, R2 difference tiers in percent, acceptable MAE.
RECOVERY_EXCELLENT, RECOVERY_GOOD = 95.0, 90.0
R2_EXCELLENT, R2_GOOD = 3.0, 5.0
MAE_ACCEPTABLE = 1.5


def pair_sides(reference: DataFrame, current: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Two small aggregate tables side by side: ``<value>_ref``, ``<value>_cur`` and their difference.

    Meant for one-row-per-key aggregates; Spark picks the join by size.
    """
    ref = reference.select(*keys, *[F.col(v).alias(f"{v}_ref") for v in values])
    cur = current.select(*keys, *[F.col(v).alias(f"{v}_cur") for v in values])
    return ref.join(cur, keys).withColumns({f"{v}_diff": F.col(f"{v}_cur") - F.col(f"{v}_ref") for v in values})


def _quality(df: DataFrame, side: str) -> DataFrame:
    """Rows, distinct rows and missing cells from one grouping of equal rows: ``(side, rows, ...)``."""
    nulls = sum(
        (nan_to_null(F.col(c), df.schema[c].dataType).isNull().cast("bigint") for c in df.columns), F.lit(0)
    )
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.lit(side).alias("side"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("__n") * nulls), F.lit(0)).alias("missing"),
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def quality_comparison(original: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows, missing cells and duplicates of both, the recovery percentage and its tier: one row."""
    both = _quality(original, "original").unionByName(_quality(cleaned, "cleaned"))
    cells = [
        F.max(F.when(F.col("side") == side, F.col(value))).alias(f"{value}_{side}")
        for side in ("original", "cleaned")
        for value in ("rows", "missing", "duplicates")
    ]
    rate = F.try_divide(F.col("rows_cleaned") * F.lit(100.0), F.col("rows_original"))
    return (
        both.agg(*cells)
        .withColumn("recovery_percent", rate)
        .withColumn(
            "tier",
            F.when(F.col("recovery_percent") >= RECOVERY_EXCELLENT, "excellent")
            .when(F.col("recovery_percent") >= RECOVERY_GOOD, "good")
            .otherwise("low"),
        )
    )


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    rows = []
    for c in columns:
        v = nan_to_null(F.col(c), df.schema[c].dataType).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                sample_skewness(v).alias("skew"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def distribution_comparison(original: DataFrame, cleaned: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, std and skew of both sides per column, with absolute mean and std differences."""
    return pair_sides(moments(original, columns), moments(cleaned, columns), ["column"], ["mean", "std", "skew"]).select(
        "column",
        *[f"{v}_{s}" for v in ("mean", "std", "skew") for s in ("ref", "cur")],
        F.abs("mean_diff").alias("mean_abs_diff"),
        F.abs("std_diff").alias("std_abs_diff"),
    )


def model_comparison(original: DataFrame, cleaned: DataFrame, ranges: DataFrame) -> DataFrame:
    """MAE and R2 of models trained on either table, MAE as percent of the target range, R2 difference in percent.

    ``original`` and ``cleaned`` are tables of :func:`regression_metrics`; ``ranges`` holds
    ``(target, min, max)``.
    """
    span = ranges.select("target", (F.col("max") - F.col("min")).alias("range"))
    return (
        pair_sides(original, cleaned, ["target"], ["mae", "r2"])
        .join(span, "target")
        .select(
            "target",
            "mae_ref",
            "mae_cur",
            "r2_ref",
            "r2_cur",
            "range",
            (F.try_divide("mae_ref", "range") * 100).alias("mae_ref_percent"),
            (F.try_divide("mae_cur", "range") * 100).alias("mae_cur_percent"),
            F.abs(F.try_divide(F.col("r2_diff"), F.col("r2_ref")) * 100).alias("r2_diff_percent"),
        )
    )


def model_verdict(comparison: DataFrame) -> DataFrame:
    """One row: mean R2 difference, its tier, whether every MAE is acceptable, and the recommendation."""
    diff = F.avg("r2_diff_percent")
    return (
        comparison.agg(
            diff.alias("r2_avg_diff"),
            F.bool_and(F.col("mae_cur") < MAE_ACCEPTABLE).alias("mae_acceptable"),
        )
        .withColumn(
            "tier",
            F.when(F.col("r2_avg_diff") < R2_EXCELLENT, "excellent")
            .when(F.col("r2_avg_diff") < R2_GOOD, "good")
            .otherwise("attention"),
        )
        .withColumn(
            "recommendation",
            F.when((F.col("r2_avg_diff") < R2_GOOD) & F.col("mae_acceptable"), "effective")
            .when(F.col("r2_avg_diff") < R2_GOOD, "adequate")
            .otherwise("review"),
        )
    )
