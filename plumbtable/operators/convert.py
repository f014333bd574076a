"""Typing and projection: coercion to numbers, column selection, category codes."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbtable.functions.columns import (
    clamp,
    currency_to_number,
    is_numeric,
    nan_to_null,
    to_number,
)
from plumbtable.operators.stages import HasRoles, Persisted, param


def coerce_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coerce the listed columns to double; absent ones are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(F.col(c), df.schema[c].dataType) for c in present})


def coerce_all(df: DataFrame) -> DataFrame:
    return coerce_columns(df, df.columns)


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Normalise NaN to null in every floating column; run once at ingest."""
    floating = [f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({f.name: nan_to_null(F.col(f.name), f.dataType) for f in floating})


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric category codes as integers (2.0 -> 2); cells that are no number become null."""
    return coerce_columns(df, columns).withColumns(
        {c: F.col(c).cast("int") for c in columns if c in df.columns}
    )


def clean_currency(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, currency_to_number(F.col(column)))


def clip_constants(
    df: DataFrame, column: str, lower: float | None = 0, upper: float | None = 100
) -> DataFrame:
    return df.withColumn(column, clamp(F.col(column), lower, upper))


def detect_roles(df: DataFrame, targets: list[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature columns by dtype, targets left out."""
    numeric = [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in targets]
    rest = [c for c in df.columns if c not in numeric and c not in targets]
    return numeric, rest


class TypeConverter(HasRoles, Transformer, Persisted):
    """Coerce both role lists to numbers; a column named in both is numeric either way."""

    def __init__(self, numericCols: list[str] = (), categoricalCols: list[str] = ()):
        super().__init__()
        self._set(numericCols=list(numericCols), categoricalCols=list(categoricalCols))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return coerce_columns(
            dataset, self.getOrDefault("numericCols") + self.getOrDefault("categoricalCols")
        )


class FeatureSelector(Transformer, Persisted):
    """Drop the listed columns; absent ones are ignored."""

    columnsToDrop = param("columnsToDrop", "columns to drop", TypeConverters.toListString)

    def __init__(self, columnsToDrop: list[str] = ()):
        super().__init__()
        self._set(columnsToDrop=list(columnsToDrop))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault("columnsToDrop"))
