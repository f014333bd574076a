"""Regression quality as plain aggregates: every target in one pass, optionally per side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbtable.functions.columns import nan_to_null
from plumbtable.operators.profile import bin_index

# Target name -> (truth column, prediction column).
Targets = dict[str, tuple[str, str]]


def _pair(df: DataFrame, truth: str, prediction: str) -> tuple[Column, Column, Column]:
    """Truth, prediction and error (prediction - truth) on rows where both are present."""
    y = nan_to_null(F.col(truth), df.schema[truth].dataType).cast("double")
    p = nan_to_null(F.col(prediction), df.schema[prediction].dataType).cast("double")
    both = y.isNotNull() & p.isNotNull()
    return F.when(both, y), F.when(both, p), p - y


def r_squared(y: Column, error: Column) -> Column:
    """R2 as an aggregate; a constant truth scores 1 when matched exactly and 0 otherwise."""
    residual = F.sum(error * error)
    total = F.var_pop(y) * F.count(y)
    constant = F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(F.min(y) < F.max(y), 1 - residual / total).when(F.count(y) > 0, constant)


def _per_target(df: DataFrame, targets: Targets, by: list[str], build) -> DataFrame:
    rows = [F.struct(F.lit(t).alias("target"), *build(*_pair(df, y, p))) for t, (y, p) in targets.items()]
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(F.array(*rows).alias("rows")).select(*by, F.inline("rows"))


def regression_metrics(df: DataFrame, targets: Targets, by: list[str] = ()) -> DataFrame:
    """``n, mae, mse, rmse, r2`` per target (and per value of ``by``)."""

    def build(y, p, e):
        mse = F.avg(e * e)
        return [
            F.count(e).alias("n"),
            F.avg(F.abs(e)).alias("mae"),
            mse.alias("mse"),
            F.sqrt(mse).alias("rmse"),
            r_squared(y, e).alias("r2"),
        ]

    return _per_target(df, targets, list(by), build)


def regression_report(df: DataFrame, targets: Targets, by: list[str] = ()) -> DataFrame:
    """Mean error, MAE, largest absolute error, MAPE (percent, zero truths skipped), RMSE and R2."""

    def build(y, p, e):
        return [
            F.count(e).alias("n"),
            F.avg(e).alias("mean_error"),
            F.avg(F.abs(e)).alias("mae"),
            F.max(F.abs(e)).alias("max_abs_error"),
            (F.avg(F.abs(F.try_divide(e, y))) * 100).alias("mape"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            r_squared(y, e).alias("r2"),
        ]

    return _per_target(df, targets, list(by), build)


# Limits of the pass/fail tests on current data.
MEAN_ERROR_LIMIT = 5.0
RMSE_LIMIT = 10.0


def threshold_tests(
    df: DataFrame, targets: Targets, mean_error: float = MEAN_ERROR_LIMIT, rmse: float = RMSE_LIMIT
) -> DataFrame:
    """``(target, test, value, limit, passed)``: mean error and RMSE strictly below their limits."""

    def build(y, p, e):
        return [F.avg(e).alias("mean_error"), F.sqrt(F.avg(e * e)).alias("rmse")]

    tests = F.array(
        *[
            F.struct(F.lit(n).alias("test"), F.col(n).alias("value"), F.lit(float(limit)).alias("limit"))
            for n, limit in (("mean_error", mean_error), ("rmse", rmse))
        ]
    )
    return (
        _per_target(df, targets, [], build)
        .select("target", F.inline(tests))
        .withColumn("passed", F.coalesce(F.col("value") < F.col("limit"), F.lit(False)))
    )


def null_prediction_check(df: DataFrame, targets: Targets) -> DataFrame:
    """Null predictions per target; any null marks the scoring of that target as failed."""
    rows = []
    for t, (_, p) in targets.items():
        nulls = F.count_if(nan_to_null(F.col(p), df.schema[p].dataType).isNull())
        rows.append(
            F.struct(
                F.lit(t).alias("target"),
                F.count(F.lit(1)).alias("rows"),
                nulls.alias("null_predictions"),
                F.when(nulls > 0, "failed").otherwise("success").alias("status"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def residuals(df: DataFrame, targets: Targets) -> DataFrame:
    """Add ``residual_<target>`` (truth - prediction) per target."""
    return df.withColumns({f"residual_{t}": F.col(y) - F.col(p) for t, (y, p) in targets.items()})


def scatter_bins(df: DataFrame, x: Column, y: Column, bins: int, by: list[str] = ()) -> DataFrame:
    """Binned counts of two value expressions: chart data of bounded size."""
    points = df.select(*by, x.cast("double").alias("x"), y.cast("double").alias("y")).filter(
        "x IS NOT NULL AND y IS NOT NULL"
    )
    r = points.agg(
        F.min("x").alias("xl"), F.max("x").alias("xh"), F.min("y").alias("yl"), F.max("y").alias("yh")
    ).first()
    if r["xl"] is None:
        cells = (F.lit(0), F.lit(0))
    else:
        cells = bin_index(F.col("x"), r["xl"], r["xh"], bins), bin_index(F.col("y"), r["yl"], r["yh"], bins)
    return points.groupBy(*by, cells[0].alias("bin_x"), cells[1].alias("bin_y")).agg(
        F.count(F.lit(1)).alias("count")
    )


def residual_bins(df: DataFrame, truth: str, prediction: str, bins: int = 30, by: list[str] = ()) -> DataFrame:
    """Prediction against residual, binned."""
    return scatter_bins(df, F.col(prediction), F.col(truth) - F.col(prediction), bins, by)


def predicted_vs_actual_bins(
    df: DataFrame, truth: str, prediction: str, bins: int = 30, by: list[str] = ()
) -> DataFrame:
    return scatter_bins(df, F.col(truth), F.col(prediction), bins, by)


def drop_unscored(df: DataFrame, targets: Targets) -> DataFrame:
    """Rows with every truth and prediction present."""
    columns = [c for pair in targets.values() for c in pair]
    present = [nan_to_null(F.col(c), df.schema[c].dataType).isNotNull() for c in columns]
    return df.filter(reduce(lambda a, b: a & b, present, F.lit(True)))
