"""Table and column profiles, and the data behind distribution charts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbtable.functions.columns import (
    is_numeric,
    is_plain_number,
    nan_to_null,
    pair_correlation,
    percent,
    sample_kurtosis,
    sample_skewness,
)
from plumbtable.operators.counts import value_counts
from plumbtable.operators.quantiles import quantiles

KERNEL_REACH = 9.0


def _value(df: DataFrame, column: str) -> Column:
    return nan_to_null(F.col(column), df.schema[column].dataType)


def _rows(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One aggregation whose per-column results come out as rows."""
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def audit_counts(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows left after each of a chain of row filters: ``(step, rows_before, rows_after)``, one scan."""
    kept: Column = F.lit(True)
    rows = []
    for i, (name, test) in enumerate(steps.items()):
        before = kept
        kept = kept & F.coalesce(test, F.lit(False))
        rows.append(
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(name).alias("step"),
                F.count_if(before).alias("rows_before"),
                F.count_if(kept).alias("rows_after"),
            )
        )
    return _rows(df, rows)


def null_table(df: DataFrame) -> DataFrame:
    """Null count, rows and null percentage per column, most nulls first."""
    total = F.count(F.lit(1))
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(_value(df, c).isNull()).alias("null_count"),
            total.alias("total_rows"),
            percent(F.count_if(_value(df, c).isNull()), total).alias("null_percent"),
        )
        for c in df.columns
    ]
    return _rows(df, rows).orderBy(F.col("null_percent").desc(), "column")


def invalid_entries(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null text cells that are no plain number, per text column."""
    total = F.count(F.lit(1))
    rows = []
    for c in columns:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            bad = F.count_if(F.col(c).isNotNull() & ~is_plain_number(F.col(c)))
            rows.append(
                F.struct(
                    F.lit(c).alias("column"),
                    bad.alias("invalid_count"),
                    total.alias("total_rows"),
                    percent(bad, total).alias("invalid_percent"),
                )
            )
    return _rows(df, rows)


def column_profile(df: DataFrame, columns: list[str] | None = None, examples: int = 10) -> DataFrame:
    """Type, distinct count, null count and the smallest distinct values of each column.

    Distinct values come from one grouped count over all columns. The example filter is a ranked
    limit that Spark applies before its shuffle, so a task passes on at most ``examples`` rows per column.
    """
    columns = columns or df.columns
    counts = value_counts(df, columns)
    shown = F.coalesce(
        "text", F.col("whole").cast("string"), F.format_string("%.4f", F.col("real"))
    )
    order = Window.partitionBy("column").orderBy("real", "whole", "text")
    first = (
        counts.withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") <= examples)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("rn", shown.alias("v")))).alias("e"))
        .select("column", F.array_join(F.transform("e", lambda s: s["v"]), "; ").alias("examples"))
    )
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_count"))
    base = _rows(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.count_if(_value(df, c).isNull()).alias("null_count"),
            )
            for c in columns
        ],
    )
    # All three sides hold one row per column of the table.
    return (
        base.join(sizes, "column", "left")
        .join(first, "column", "left")
        .select(
            "column",
            "dtype",
            F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
            "null_count",
            "examples",
        )
    )


def describe(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles, max, skewness and kurtosis per numeric column."""
    cuts = quantiles(df, columns, [0.25, 0.5, 0.75], exact)
    rows = []
    for c in columns:
        v = _value(df, c).cast("double")
        q1, q2, q3 = [F.lit(x).cast("double") for x in cuts[c]]
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                q1.alias("q25"),
                q2.alias("q50"),
                q3.alias("q75"),
                F.max(v).alias("max"),
                sample_skewness(v).alias("skewness"),
                sample_kurtosis(v).alias("kurtosis"),
            )
        )
    return _rows(df, rows)


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, unique, top (smallest of the most frequent) and its frequency per text column."""
    return (
        value_counts(df.select(*[F.col(c).cast("string").alias(c) for c in columns]), columns)
        .groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min_by("text", F.struct((-F.col("n")).alias("n"), "text")).alias("top"),
            F.max("n").alias("freq"),
        )
    )


def min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rows(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.min(_value(df, c)).cast("double").alias("min"),
                F.max(_value(df, c)).cast("double").alias("max"),
            )
            for c in columns
        ],
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Pearson r in long form ``(x, y, r)`` for every ordered pair, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    rows = []
    for a, b in pairs:
        x, y = _value(df, a).cast("double"), _value(df, b).cast("double")
        r = pair_correlation(x, y) if a != b else F.when(F.min(x) < F.max(x), F.lit(1.0))
        rows.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("r")))
    upper = _rows(df, rows)
    both = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y", "r"))).otherwise(
        F.array(F.struct("x", "y", "r"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    )
    return upper.select(F.inline(both))


def correlated_pairs(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """Unordered pairs with ``|r| >= threshold``: candidates for dropping one of the two."""
    return correlation_matrix(df, columns).filter((F.col("x") < F.col("y")) & (F.abs("r") >= threshold))


def _range(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    aggs = [f(_value(df, c).cast("double")).alias(f"{k}{c}") for c in columns for k, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo{c}"], row[f"hi{c}"]) for c in columns}


def bin_index(value: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1, the last one closed; null for null. A constant column gets a unit-wide range."""
    if hi <= lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    index = F.least(F.floor((value - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    return F.when(value.isNotNull(), index).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts of equal-width bins, empty ones included: ``(bin, lower, upper, count)``."""
    lo, hi = _range(df, [column])[column]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count bigint")
    lo, hi = (lo - 0.5, hi + 0.5) if hi <= lo else (lo, hi)
    width = (hi - lo) / bins
    value = _value(df, column).cast("double")
    counts = (
        df.filter(value.isNotNull())
        .groupBy(bin_index(value, lo, hi, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def density(df: DataFrame, column: str, grid: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid between min and max: ``(x, density)``, Scott's bandwidth.

    Each value adds to the grid points within ``KERNEL_REACH`` bandwidths, beyond which the kernel is below
    1e-17 of its peak; the sums are combined before the shuffle, so a row per point and task travels.
    """
    if grid < 2:
        raise ValueError(f"grid must be at least 2, got {grid}")
    value = _value(df, column).cast("double")
    row = df.agg(
        F.count(value).alias("n"), F.stddev_samp(value).alias("s"), F.min(value).alias("lo"), F.max(value).alias("hi")
    ).first()
    n, s, lo, hi = row["n"], row["s"], row["lo"], row["hi"]
    if n < 2 or not s or hi <= lo:
        return df.sparkSession.createDataFrame([], "x double, density double")
    h = s * n ** (-0.2)
    step = (hi - lo) / (grid - 1)
    reach = KERNEL_REACH * h
    first = F.greatest(F.ceil((F.col("v") - F.lit(lo + reach)) / F.lit(step)), F.lit(0))
    last = F.least(F.floor((F.col("v") - F.lit(lo - reach)) / F.lit(step)), F.lit(grid - 1))
    z = (F.lit(lo) + F.col("point") * F.lit(step) - F.col("v")) / F.lit(h)
    sums = (
        df.select(value.alias("v"))
        .where("v IS NOT NULL")
        .withColumns({"first": first, "last": last})
        .where("first <= last")
        .select("v", F.explode(F.sequence("first", "last")).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.exp(z * z * F.lit(-0.5))).alias("total"))
    )
    points = df.sparkSession.range(grid).select(F.col("id").alias("point"))
    scale = 1.0 / (n * h * math.sqrt(2 * math.pi))
    return points.join(sums, "point", "left").select(
        (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"),
        (F.coalesce("total", F.lit(0.0)) * F.lit(scale)).alias("density"),
    )


def box_stats(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Quartiles, whiskers at the farthest values within 1.5 IQR, and the outliers beyond."""
    cuts = quantiles(df, columns, [0.25, 0.5, 0.75], exact)
    rows = []
    for c in columns:
        q1, q2, q3 = cuts[c]
        v = _value(df, c).cast("double")
        if q1 is None:
            inside = F.lit(None).cast("boolean")
        else:
            inside = v.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(q1).cast("double").alias("q25"),
                F.lit(q2).cast("double").alias("q50"),
                F.lit(q3).cast("double").alias("q75"),
                F.min(F.when(inside, v)).alias("whisker_low"),
                F.max(F.when(inside, v)).alias("whisker_high"),
                F.count_if(~inside).alias("outliers"),
            )
        )
    return _rows(df, rows)


def pair_bins(df: DataFrame, columns: list[str], hue: str | None = None, bins: int = 30) -> DataFrame:
    """Binned scatter data of every unordered column pair: ``(x, y, bin_x, bin_y[, hue], count)``.

    Each row is first reduced to its bins; pairs are counted map-side, so the shuffle carries at
    most ``bins * bins`` rows per pair, task and hue value.
    """
    ranges = {c: r for c, r in _range(df, columns).items() if r[0] is not None}
    names = list(ranges)
    binned = df.select(
        *[bin_index(_value(df, c).cast("double"), *ranges[c], bins).alias(c) for c in names],
        *([F.col(hue).alias("__hue")] if hue else []),
    )
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(a).alias("bin_x"), F.col(b).alias("bin_y"))
        for i, a in enumerate(names)
        for b in names[i + 1 :]
    ]
    keys = ["x", "y", "bin_x", "bin_y"] + (["__hue"] if hue else [])
    out = (
        binned.select(*(["__hue"] if hue else []), F.inline(F.array(*cells)))
        .filter("bin_x IS NOT NULL AND bin_y IS NOT NULL")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return out.withColumnRenamed("__hue", "hue") if hue else out


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]
