"""Exact duplicates over all columns."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.operators.stages import Persisted


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row per distinct row; nulls are equal. Copies are combined before the shuffle."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and duplicate rows, from one grouping."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    total = F.coalesce(F.sum("__n"), F.lit(0))
    return groups.agg(
        total.alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (total - F.count(F.lit(1))).alias("duplicates"),
    )


class DuplicateRemover(Transformer, Persisted):
    """Drop exact duplicates."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return drop_duplicates(dataset)
