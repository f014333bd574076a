"""Mergeable quantile sketches, combined in three steps.

Every task builds one sketch per column; groups of tasks merge theirs in parallel, groups of groups
merge those, and only the few last sketches meet in one place: with 800,000 tasks 12,500 groups of 64,
196 groups of groups, so no task reads more than 196 sketches a column. A sketch of ``SKETCH_K`` is about 200 KB whatever it has
seen, and its ranks are off by about 0.04 percent. Sketches draw random bits, so nothing exact may
rest on one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 8_000
MERGE_FAN_IN = 64


def merged_sketches(df: DataFrame, sketched: dict[str, Column], counted: dict[str, Column]) -> DataFrame:
    """One row: a sketch of each ``sketched`` double expression and the sum of each ``counted`` aggregate."""
    # Neighbouring tasks share a group: with n tasks there are at most n / MERGE_FAN_IN + 1 groups.
    group = F.floor(F.spark_partition_id() / MERGE_FAN_IN).alias("__group")
    merged = [F.kll_merge_agg_double(n).alias(n) for n in sketched]
    groups = df.groupBy(group).agg(
        *[F.kll_sketch_agg_double(e, F.lit(SKETCH_K)).alias(n) for n, e in sketched.items()],
        *[e.alias(n) for n, e in counted.items()],
    )
    wider = groups.groupBy(F.floor(F.col("__group") / MERGE_FAN_IN).alias("__group")).agg(
        *merged, *[F.sum(n).alias(n) for n in counted]
    )
    return wider.agg(*merged, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counted])


def sketch_values(sketch: Column, probs: Column) -> Column:
    """Values at the given shares of a sketch; null for an empty one."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, probs))


def shares(values: list[float]) -> Column:
    """A literal array of doubles as one parsed expression; thousands of separate literals are slow to build."""
    return F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")")


def even_shares(parts: int) -> Column:
    return shares([i / parts for i in range(parts + 1)])
