"""Two-sample drift: Kolmogorov-Smirnov per feature, moment shifts and the overall share.

The KS statistic is exact, but most of a table never takes part in the exact step. Quantile cuts
split each feature into buckets; bucket totals give the distribution gap at every cut and an upper
limit for the gap inside every bucket. Only buckets whose limit exceeds the largest gap at a cut
are counted by value. With real drift that is a small part of the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbtable.functions.columns import nan_to_null
from plumbtable.operators.sketches import even_shares, merged_sketches, sketch_values
from plumbtable.session import settle

# Feature p-value, overall share, error p-value, moment limits in reference sigmas.
FEATURE_P = 0.05
DRIFT_SHARE = 0.30
ERROR_P = 0.01
MEAN_SHIFT_LIMIT = 2.0
STD_SHIFT_LIMIT = 1.0

# More cuts leave less for the exact step; fewer rows need fewer.
MIN_CUTS, MAX_CUTS = 50, 10_000
ROWS_PER_CUT = 1_000
# Even parts of a bucket that the cuts leave open, where these hold more than so many rows.
PARTS = 64
FEW_ROWS = 2_000_000
SERIES_TERMS = 100
# Sides of up to so many values get the exact p-value; as in the data model's own test.
EXACT_VALUES = 10_000


def both_sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Reference and current rows in one table with ``is_ref``; columns as doubles, NaN as null."""

    def side(df: DataFrame, flag: bool) -> DataFrame:
        return df.select(
            F.lit(flag).alias("is_ref"),
            *[nan_to_null(F.col(c), df.schema[c].dataType).cast("double").alias(c) for c in columns],
        )

    return side(reference, True).unionByName(side(current, False))


def exact_p_value(n: int, m: int, gap: int) -> float:
    """Chance that a random merge of ``n`` and ``m`` values has a gap as large as the one seen.

    A merge is a lattice path from (0, 0) to (n, m), its gap at (i, j) is |i m - j n|, and ``gap`` is the largest one
    seen. The chance to have left the band of smaller gaps is carried from diagonal to diagonal: the last step to
    (i, j) goes along i with chance i / (i + j). Only points inside the band are kept; all terms are positive, so
    small chances keep their digits.
    """
    total, low, left = n + m, 0, np.zeros(1)
    if gap <= 0:
        return 1.0
    for s in range(1, total + 1):
        first = max(0, s - m, (s * n - gap) // total + 1)
        last = min(n, s, -(-(s * n + gap) // total) - 1)
        if last < first:
            return 1.0
        i = np.arange(first, last + 1)
        around = np.concatenate([[1.0], left, [1.0]])[first - low :]
        left = (i * around[: len(i)] + (s - i) * around[1 : len(i) + 1]) / s
        low = first
    return float(left[0])


@F.pandas_udf(T.DoubleType())
def _exact_p_values(statistic: pd.Series, n: pd.Series, m: pd.Series, most: pd.Series) -> pd.Series:
    """One value per feature; null beyond the limit, where the series is used."""
    rows = zip(statistic, n.astype("int64"), m.astype("int64"), most)
    return pd.Series([exact_p_value(a, b, round(d * a * b)) if max(a, b) <= limit else None for d, a, b, limit in rows], dtype="float64")


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value: counted paths for sides of up to ``EXACT_VALUES`` values, else the asymptotic series
    ``2 * sum (-1)^(j-1) exp(-2 j^2 l^2)``, 1 where that is not usable."""
    lam = statistic * F.sqrt(n * m / (n + m))

    def term(acc, j):
        sign = F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        return acc + sign * F.exp(F.lit(-2.0) * j * j * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), F.lit(0.0), term)
    asymptotic = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return F.coalesce(_exact_p_values(statistic, n, m, F.lit(EXACT_VALUES)), asymptotic)


def _cuts(both: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """Distinct quantile cuts per feature; their number follows the row count, up to ``MAX_CUTS``.

    Any cuts give the same statistic: they only decide how well the buckets are balanced.
    """
    names = [f"s{i}" for i in range(len(features))]
    # Written, so that the sketches stay off the driver while the number of cuts is chosen.
    merged = settle(
        merged_sketches(
            both,
            {s: F.col(f) for s, f in zip(names, features)},
            {f"n{s}": F.count(f) for s, f in zip(names, features)},
        ),
        "drift",
    )
    most = max(merged.select(*[f"n{s}" for s in names]).first())
    points = even_shares(max(MIN_CUTS, min(MAX_CUTS, most // ROWS_PER_CUT)))
    row = merged.select(*[sketch_values(F.col(s), points).alias(s) for s in names]).first()
    # Edges are exclusive above; infinite values stay in the outer buckets.
    return {f: [v for v in sorted(set(row[s] or [])) if math.isfinite(v)] for s, f in zip(names, features)}


def _long(both: DataFrame, features: list[str], cuts: dict[str, list[float]]) -> DataFrame:
    """Rows ``(feature, bucket, value, ref, cur)``, nulls left out."""
    cells = []
    for i, f in enumerate(features):
        if cuts[f]:
            splits = [-math.inf, *cuts[f], math.inf]
            both = Bucketizer(
                splits=splits, inputCol=f, outputCol=f"__bucket{i}", handleInvalid="keep"
            ).transform(both)
            bucket = F.col(f"__bucket{i}").cast("int")
        else:
            bucket = F.lit(0)
        cells.append(F.struct(F.lit(f).alias("feature"), bucket.alias("bucket"), F.col(f).alias("value")))
    ref = F.col("is_ref").cast("bigint")
    return (
        both.select(ref.alias("ref"), (1 - ref).alias("cur"), F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
    )


def _gap(ref: Column, cur: Column) -> Column:
    return F.abs(ref / F.col("n_ref") - cur / F.col("n_cur"))


def _limit(ref_upto: str, cur_upto: str, ref_before: str, cur_before: str) -> Column:
    """The largest gap there can be between two points, from the counts up to either."""
    n_ref, n_cur = F.col("n_ref"), F.col("n_cur")
    return F.greatest(
        F.col(ref_upto) / n_ref - F.col(cur_before) / n_cur, F.col(cur_upto) / n_cur - F.col(ref_before) / n_ref
    )


def ks_statistics(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Exact two-sample KS statistic per feature: ``(feature, n_ref, n_cur, ks_statistic)``.

    Buckets between quantile cuts are counted first. A bucket that could hold a larger gap than those at the
    cuts is open. Where the open ones hold few rows these are counted by value; else they are divided into
    ``PARTS`` even parts and counted again, and only parts that are still open are counted by value.
    A feature without values on one side has no row.
    """
    if not features:
        return reference.sparkSession.createDataFrame(
            [], "feature string, n_ref bigint, n_cur bigint, ks_statistic double"
        )
    both = both_sides(reference, current, features)
    cuts = _cuts(both, features)
    long = _long(both, features, cuts)
    by_feature = Window.partitionBy("feature")
    running = by_feature.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum("ref").alias("ref"), F.sum("cur").alias("cur")]
    # At most one row per feature and bucket; settled, since three branches below read it.
    totals = settle(long.groupBy("feature", "bucket").agg(*sums), "drift")
    buckets = (
        totals.withColumns(
            {
                "n_ref": F.sum("ref").over(by_feature),
                "n_cur": F.sum("cur").over(by_feature),
                "ref_upto": F.sum("ref").over(running),
                "cur_upto": F.sum("cur").over(running),
            }
        )
        .filter("n_ref > 0 AND n_cur > 0")
        .withColumns({"ref_before": F.col("ref_upto") - F.col("ref"), "cur_before": F.col("cur_upto") - F.col("cur")})
        .withColumn("gap", _gap(F.col("ref_upto"), F.col("cur_upto")))
        .withColumn("best", F.max("gap").over(by_feature))
    )
    edges = []
    for f in features:
        ends = [-math.inf, *cuts[f], math.inf] if cuts[f] else [-math.inf, math.inf]
        edges += [(f, i, lo, hi) for i, (lo, hi) in enumerate(zip(ends, ends[1:]))]
    edges = both.sparkSession.createDataFrame(edges, "feature string, bucket int, lo double, hi double")
    # A row per feature and bucket: bounded by the number of cuts.
    open_buckets = settle(
        buckets.filter(_limit("ref_upto", "cur_upto", "ref_before", "cur_before") > F.col("best"))
        .select("feature", "bucket", "n_ref", "n_cur", "ref_before", "cur_before", (F.col("ref") + F.col("cur")).alias("rows"))
        .join(F.broadcast(edges), ["feature", "bucket"]),
        "drift",
    )
    seen = buckets.select("feature", "n_ref", "n_cur", "gap")
    if (open_buckets.agg(F.sum("rows")).first()[0] or 0) <= FEW_ROWS:
        return _largest_gap(seen, _counted_by_value(long, open_buckets, ["feature", "bucket"]))
    open_buckets = open_buckets.drop("rows")
    even = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS)
    finite = (F.col("lo") > -math.inf) & (F.col("hi") < math.inf)
    part = F.when(finite, F.least(even, F.lit(PARTS - 1))).otherwise(F.lit(0)).cast("int")
    divided = long.join(F.broadcast(open_buckets.select("feature", "bucket", "lo", "hi")), ["feature", "bucket"]).withColumn(
        "part", part
    )
    along = Window.partitionBy("feature", "bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = settle(
        divided.groupBy("feature", "bucket", "part")
        .agg(*sums)
        .join(F.broadcast(open_buckets.drop("lo", "hi")), ["feature", "bucket"])
        .withColumns(
            {
                "ref_upto": F.col("ref_before") + F.sum("ref").over(along),
                "cur_upto": F.col("cur_before") + F.sum("cur").over(along),
            }
        )
        .withColumns({"ref_before": F.col("ref_upto") - F.col("ref"), "cur_before": F.col("cur_upto") - F.col("cur")})
        .withColumn("gap", _gap(F.col("ref_upto"), F.col("cur_upto"))),
        "drift",
    )
    seen = seen.unionByName(parts.select("feature", "n_ref", "n_cur", "gap"))
    best = seen.groupBy("feature").agg(F.max("gap").alias("best"))
    open_parts = settle(
        parts.join(F.broadcast(best), "feature")
        .filter(_limit("ref_upto", "cur_upto", "ref_before", "cur_before") > F.col("best"))
        .select("feature", "bucket", "part", "n_ref", "n_cur", "ref_before", "cur_before"),
        "drift",
    )
    return _largest_gap(seen, _counted_by_value(divided, open_parts, ["feature", "bucket", "part"]))


def _counted_by_value(rows: DataFrame, opened: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps at every value inside the ``opened`` places, a row per place."""
    inside = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum("ref").alias("ref"), F.sum("cur").alias("cur")]
    return (
        # Bounded side: one row per place.
        rows.join(F.broadcast(opened.select(*keys)), keys, "left_semi")
        .groupBy(*keys, "value")
        .agg(*sums)
        .withColumns({"r": F.sum("ref").over(inside), "c": F.sum("cur").over(inside)})
        .join(F.broadcast(opened.select(*keys, "n_ref", "n_cur", "ref_before", "cur_before")), keys)
        .select("feature", "n_ref", "n_cur", _gap(F.col("ref_before") + F.col("r"), F.col("cur_before") + F.col("c")).alias("gap"))
    )


def _largest_gap(seen: DataFrame, within: DataFrame) -> DataFrame:
    return seen.unionByName(within).groupBy("feature", "n_ref", "n_cur").agg(F.max("gap").alias("ks_statistic"))


def ks_drift(
    reference: DataFrame, current: DataFrame, features: list[str], alpha: float = FEATURE_P
) -> DataFrame:
    """KS test per feature: ``(feature, ks_statistic, p_value, drift_detected)``, flag at ``p < alpha``."""
    p = ks_p_value(F.col("ks_statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return (
        ks_statistics(reference, current, features)
        .select("feature", "ks_statistic", p.alias("p_value"))
        .withColumn("drift_detected", F.col("p_value") < alpha)
    )


def moment_drift(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Mean and deviation shifts in reference sigmas; a constant reference counts as no shift."""
    rows = []
    for f in features:
        ref, cur = F.when(F.col("is_ref"), F.col(f)), F.when(~F.col("is_ref"), F.col(f))
        sigma = F.stddev_samp(ref)
        rows.append(
            F.struct(
                F.lit(f).alias("feature"),
                *[
                    F.when(sigma > 0, F.abs(stat(cur) - stat(ref)) / sigma).otherwise(0.0).alias(name)
                    for name, stat in (("mean_change", F.avg), ("std_change", F.stddev_samp))
                ],
            )
        )
    shifted = (F.col("mean_change") > MEAN_SHIFT_LIMIT) | (F.col("std_change") > STD_SHIFT_LIMIT)
    return (
        both_sides(reference, current, features)
        .agg(F.array(*rows).alias("rows"))
        .select(F.inline("rows"))
        .withColumn("drift_detected", F.coalesce(shifted, F.lit(False)))
    )


def overall_drift(feature_drift: DataFrame, n_features: int, limit: float = DRIFT_SHARE) -> DataFrame:
    """``(drift_count, n_features, drift_share, overall_drift)``; strict ``>`` against the limit."""
    drifted = F.count_if("drift_detected")
    share = drifted / F.lit(n_features)
    return feature_drift.agg(
        drifted.alias("drift_count"),
        F.lit(n_features).cast("bigint").alias("n_features"),
        share.alias("drift_share"),
        (share > limit).alias("overall_drift"),
    )


def error_drift(
    reference: DataFrame, current: DataFrame, targets: dict[str, tuple[str, str]], alpha: float = ERROR_P
) -> DataFrame:
    """KS test on the errors (prediction - truth) of each target."""

    def errors(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(p) - F.col(y)).alias(t) for t, (y, p) in targets.items()])

    return ks_drift(errors(reference), errors(current), list(targets), alpha).withColumnRenamed(
        "feature", "target"
    )
