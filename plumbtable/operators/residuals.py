"""Two further parts of a regression report: are the errors normal, and is the model better than a constant?"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.operators.metrics import Targets, _pair
from plumbtable.operators.quantiles import order_statistics, quantiles

#: Points of a Q-Q table.
QQ_POINTS = 20
QQ_SCHEMA = "target string, rank bigint, theoretical double, observed double"


def uniform_median(rank: int, n: int) -> float:
    """Median of the uniform order statistic with 0-based ``rank`` of ``n``, by Filliben's estimate."""
    if rank == n - 1:
        return 0.5 ** (1 / n)
    return 1 - 0.5 ** (1 / n) if rank == 0 else (rank + 1 - 0.3175) / (n + 0.365)


def error_quantiles(df: DataFrame, targets: Targets, points: int = QQ_POINTS) -> DataFrame:
    """``(target, rank, theoretical, observed)``: errors at even ranks beside the normal values of these ranks.

    The observed errors are exact order statistics of all errors; ranks are 0-based. A target without errors has
    no rows; with fewer errors than points every one is listed.
    """
    spark = df.sparkSession
    errors = df.select(*[_pair(df, y, p)[2].alias(t) for t, (y, p) in targets.items()])
    shares = [(k + 0.5) / points for k in range(points)]

    def wanted(n: int) -> list[tuple[int, int]]:
        return [(r, r) for r in (min(n - 1, int(s * n)) for s in shares)]

    ranked = order_statistics(errors, list(targets), shares, wanted)
    normal = NormalDist()
    rows = [
        (t, r, normal.inv_cdf(uniform_median(r, ranked[t].count)) if ranked[t].count > 1 else 0.0, v)
        for t in targets
        for r, v in sorted(ranked[t].values.items())
    ]
    return spark.createDataFrame(rows, QQ_SCHEMA)


def error_normality(df: DataFrame, targets: Targets, points: int = QQ_POINTS) -> DataFrame:
    """``(target, points, slope, intercept, correlation)`` of the line through each target's Q-Q table."""
    return (
        error_quantiles(df, targets, points)
        .groupBy("target")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.regr_slope("observed", "theoretical").alias("slope"),
            F.regr_intercept("observed", "theoretical").alias("intercept"),
            F.corr("observed", "theoretical").alias("correlation"),
        )
    )


def dummy_comparison(df: DataFrame, targets: Targets) -> DataFrame:
    """``(target, metric, constant, dummy, model, better)``: each metric beside its value for the best constant.

    The mean is best for the RMSE, the median for the MAE and the middle of the range for the largest absolute error.
    ``better`` is whether the model beats the constant. A target without pairs has no rows.
    """
    pairs = {t: _pair(df, y, p) for t, (y, p) in targets.items()}
    both = df.select(*[c.alias(f"{t}__{n}") for t, (y, _, e) in pairs.items() for n, c in (("y", y), ("e", e))])
    medians = quantiles(both, [f"{t}__y" for t in targets], [0.5])
    rows = []
    for t in targets:
        median = medians[f"{t}__y"][0]
        if median is None:
            continue
        y, e = F.col(f"{t}__y"), F.col(f"{t}__e")
        middle = (F.max(y) + F.min(y)) / 2
        found = (
            ("rmse", F.avg(y), F.stddev_pop(y), F.sqrt(F.avg(e * e))),
            ("mae", F.lit(median), F.avg(F.abs(y - F.lit(median))), F.avg(F.abs(e))),
            ("max_abs_error", middle, (F.max(y) - F.min(y)) / 2, F.max(F.abs(e))),
        )
        rows += [
            F.struct(
                F.lit(t).alias("target"),
                F.lit(name).alias("metric"),
                constant.alias("constant"),
                dummy.alias("dummy"),
                model.alias("model"),
                (model < dummy).alias("better"),
            )
            for name, constant, dummy, model in found
        ]
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "target string, metric string, constant double, dummy double, model double, better boolean"
        )
    return both.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
