"""Interquartile-range outliers: learned bounds, removal, clipping and the column-by-column variant."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbtable.functions.columns import clamp, nan_to_null, percent
from plumbtable.operators.quantiles import quantiles
from plumbtable.operators.stages import HasRoles, Persisted, param

MODES = ("remove", "clip")


def iqr_bounds(
    df: DataFrame, columns: list[str], multiplier: float = 7.0, exact: bool = True
) -> dict[str, list[float]]:
    """``[Q1 - k*IQR, Q3 + k*IQR]`` per column, every column on the same rows.

    An all-null column (or one with infinite quartiles) has the bounds ``[None, None]``: nothing
    lies inside them.
    """
    bounds = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], exact).items():
        if q1 is None:
            bounds[c] = [None, None]
        else:
            reach = multiplier * (q3 - q1)
            bounds[c] = [None, None] if math.isnan(reach) else [q1 - reach, q3 + reach]
    return bounds


def _outside(df: DataFrame, column: str, lo: float | None, hi: float | None) -> Column:
    """Below or above the bounds; null for a null cell or unknown bounds."""
    value = nan_to_null(F.col(column), df.schema[column].dataType)
    return ~value.between(F.lit(lo).cast("double"), F.lit(hi).cast("double"))


def inside_bounds(df: DataFrame, bounds: dict[str, list[float]]) -> Column:
    """Inside every bound; false for a null cell."""
    # NaN sorts above every number, so it fails a finite upper bound without a test of its own.
    tests = [
        F.col(c).between(F.lit(lo).cast("double"), F.lit(hi).cast("double"))
        for c, (lo, hi) in bounds.items()
        if c in df.columns
    ]
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def remove_outliers(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    return df.filter(inside_bounds(df, bounds))


def clip_outliers(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    return df.withColumns(
        {
            c: clamp(nan_to_null(F.col(c), df.schema[c].dataType), lo, hi)
            for c, (lo, hi) in bounds.items()
            if c in df.columns
        }
    )


def removal_report(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """Rows before, kept and removed, and the removed percentage, in one aggregation."""
    kept = F.count_if(inside_bounds(df, bounds))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("rows_before"),
        kept.alias("rows_after"),
        (total - kept).alias("removed"),
        percent(total - kept, total).alias("removed_percent"),
    )


def clip_report(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """Clipped cells per column; a null cell is not a clipped one."""
    counts = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(_outside(df, c, lo, hi)).alias("clipped"),
        )
        for c, (lo, hi) in bounds.items()
        if c in df.columns
    ]
    return df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def remove_outliers_sequential(
    df: DataFrame, columns: list[str], multiplier: float = 1.5
) -> tuple[DataFrame, dict[str, list[float]]]:
    """Column after column, each with quartiles of the rows the previous columns left.

    Inherently one dependent fit per column. Nothing is cached: the filters so far are one
    conjunction, so each fit is a scan of the columns seen up to then, and the result is one
    filter over the source. :func:`iqr_bounds` with :func:`remove_outliers` needs a single fit.
    Returns the kept rows and the bounds; :func:`sequential_report` counts what each column removed.
    """
    bounds: dict[str, list[float]] = {}
    current = df
    for c in [c for c in columns if c in df.columns]:
        bounds[c] = iqr_bounds(current, [c], multiplier)[c]
        current = remove_outliers(df, bounds)
    return current, bounds


def sequential_report(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """Outliers each column removes from the rows the previous ones left, in one aggregation."""
    rows, kept = [], F.lit(True)
    for i, (c, (lo, hi)) in enumerate(bounds.items()):
        gone = F.count_if(kept & _outside(df, c, lo, hi))
        rows.append(F.struct(F.lit(i + 1).alias("step_no"), F.lit(c).alias("column"), gone.alias("outliers")))
        kept = kept & inside_bounds(df, {c: [lo, hi]})
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


class OutlierRemover(HasRoles, Estimator, Persisted):
    """Learn IQR bounds of the numeric columns."""

    iqrMultiplier = param("iqrMultiplier", "reach beyond the quartiles in IQRs", TypeConverters.toFloat)
    mode = param("mode", "remove rows or clip values", TypeConverters.toString)
    exact = param("exact", "exact quartiles (else sketched)", TypeConverters.toBoolean)

    def __init__(
        self,
        numericCols: list[str] = (),
        iqrMultiplier: float = 7.0,
        mode: str = "remove",
        exact: bool = True,
    ):
        super().__init__()
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        self._set(numericCols=list(numericCols), iqrMultiplier=float(iqrMultiplier), mode=mode, exact=exact)

    def _fit(self, dataset: DataFrame) -> OutlierModel:
        bounds = iqr_bounds(
            dataset,
            self._numeric(dataset),
            self.getOrDefault("iqrMultiplier"),
            self.getOrDefault("exact"),
        )
        return OutlierModel(bounds, self.getOrDefault("mode"))


class OutlierModel(Model, Persisted):
    """Remove rows outside the learned bounds, or clip the values to them."""

    bounds = param("bounds", "lower and upper bound per column")
    mode = param("mode", "remove rows or clip values", TypeConverters.toString)

    def __init__(self, bounds: dict | None = None, mode: str = "remove"):
        super().__init__()
        self._set(bounds=bounds or {}, mode=mode)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mode = self.getOrDefault("mode")
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        act = remove_outliers if mode == "remove" else clip_outliers
        return act(dataset, self.getOrDefault("bounds"))

    def report(self, dataset: DataFrame) -> DataFrame:
        act = removal_report if self.getOrDefault("mode") == "remove" else clip_report
        return act(dataset, self.getOrDefault("bounds"))
