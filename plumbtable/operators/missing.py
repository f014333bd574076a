"""Missing values: learned fills, strict drops and the two-branch split."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.operators.convert import nulls_for_nan
from plumbtable.operators.counts import cell_value, column_modes, value_counts
from plumbtable.operators.quantiles import quantiles
from plumbtable.operators.stages import HasRoles, Persisted, param

STRATEGIES = ("median", "drop")


def drop_any_null(df: DataFrame) -> DataFrame:
    """Keep rows without any null, over all columns."""
    return df.na.drop("any")


def drop_null_threshold(df: DataFrame, threshold: float) -> DataFrame:
    """Keep rows with at least ``int(threshold * ncols)`` non-null cells."""
    return df.na.drop(thresh=int(threshold * len(df.columns)))


def learn_medians(df: DataFrame, columns: list[str], exact: bool = True) -> dict[str, float]:
    got = quantiles(df, columns, [0.5], exact)
    return {c: v[0] for c, v in got.items() if v[0] is not None}


def learn_modes(df: DataFrame, columns: list[str]) -> dict:
    """Smallest mode per column; an all-null column has none."""
    if not columns:
        return {}
    return {r["column"]: cell_value(r["mode"]) for r in column_modes(value_counts(df, columns)).collect()}


def fill_nulls(df: DataFrame, fills: dict) -> DataFrame:
    """Fill each column with its value, cast to the column's own type; NaN counts as null."""
    df = nulls_for_nan(df)
    present = {c: v for c, v in fills.items() if c in df.columns and v is not None}
    wide = {}
    for c, v in present.items():
        dtype = df.schema[c].dataType
        # A fractional median does not fit an integer column: widen to double, as pandas does.
        target = "double" if isinstance(v, float) and not v.is_integer() else dtype
        wide[c] = F.coalesce(F.col(c).cast(target), F.lit(v).cast(target))
    return df.withColumns(wide)


def fill_continuous_with_median(df: DataFrame, columns: list[str]) -> DataFrame:
    return fill_nulls(df, learn_medians(df, [c for c in columns if c in df.columns]))


def fill_categorical_with_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    return fill_nulls(df, learn_modes(df, [c for c in columns if c in df.columns]))


def split_versions(
    df: DataFrame, numeric_cols: list[str], categorical_cols: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Two branches of one base: rows without nulls, and all rows with nulls filled."""
    filled = fill_nulls(
        df,
        {
            **learn_medians(df, [c for c in numeric_cols if c in df.columns]),
            **learn_modes(df, [c for c in categorical_cols if c in df.columns]),
        },
    )
    return drop_any_null(df), filled


class MissingValueImputer(HasRoles, Estimator, Persisted):
    """Learn medians of numeric and smallest modes of categorical columns, or drop null rows."""

    strategy = param("strategy", "median or drop", TypeConverters.toString)
    exact = param("exact", "exact medians (else sketched)", TypeConverters.toBoolean)

    def __init__(
        self,
        numericCols: list[str] = (),
        categoricalCols: list[str] = (),
        strategy: str = "median",
        exact: bool = True,
    ):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
        self._set(
            numericCols=list(numericCols), categoricalCols=list(categoricalCols), strategy=strategy, exact=exact
        )

    def _fit(self, dataset: DataFrame) -> MissingValueModel:
        fills = {}
        if self.getOrDefault("strategy") == "median":
            fills.update(learn_medians(dataset, self._numeric(dataset), self.getOrDefault("exact")))
            fills.update(learn_modes(dataset, self._categorical(dataset)))
        return MissingValueModel(fills, self.getOrDefault("strategy"))


class MissingValueModel(Model, Persisted):
    """Fill nulls with learned values (``median``) or drop null rows (``drop``)."""

    fills = param("fills", "fill value per column")
    strategy = param("strategy", "median or drop", TypeConverters.toString)

    def __init__(self, fills: dict | None = None, strategy: str = "median"):
        super().__init__()
        self._set(fills=fills or {}, strategy=strategy)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.getOrDefault("strategy") == "drop":
            return drop_any_null(nulls_for_nan(dataset))
        return fill_nulls(dataset, self.getOrDefault("fills"))
