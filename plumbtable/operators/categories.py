"""Category domains: learned rare-to-mode replacement, valid-code filters, unseen values, frequencies."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbtable.functions.columns import CONTINUOUS, WHOLE, in_values, nan_to_null
from plumbtable.operators.counts import cell_value, column_modes, value_counts
from plumbtable.operators.stages import HasRoles, Persisted, param
from plumbtable.session import fresh_path

#: Most categories of a column that are literals of the plan; a domain that may be wider is a table.
LITERALS = 10_000


def category_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count and share among non-nulls per category: ``(column, real, whole, text, n, share)``."""
    counts = value_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    # One row per listed column: the broadcast side does not grow with the data.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "real", "whole", "text", "n", (F.col("n") / F.col("total")).alias("share")
    )


def category_frequencies(df: DataFrame, column: str) -> DataFrame:
    """``(column, count, share)`` of one column in its own type."""
    value = nan_to_null(F.col(column), df.schema[column].dataType)
    counts = df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("count")).filter(F.col(column).isNotNull())
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(column, "count", (F.col("count") / total).alias("share"))


def filter_valid_categories(df: DataFrame, valid: dict[str, list]) -> DataFrame:
    """Keep rows whose listed columns hold listed codes; null cells go."""
    for c, codes in valid.items():
        if c in df.columns:
            df = df.filter(in_values(F.col(c), list(codes)))
    return df


def valid_category_report(df: DataFrame, valid: dict[str, list]) -> DataFrame:
    """Rows each filter removes from what the previous ones left, and the total, in one aggregation."""
    kept: Column = F.lit(True)
    rows = []
    for c in [c for c in valid if c in df.columns]:
        passes = in_values(F.col(c), list(valid[c]))
        rows.append(F.struct(F.lit(c).alias("column"), F.count_if(kept & ~passes).alias("removed")))
        kept = kept & passes
    rows.append(F.struct(F.lit("total").alias("column"), F.count_if(~kept).alias("removed")))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def category_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of ``column`` in ``left`` that ``right`` lacks."""
    have = left.select(column).filter(F.col(column).isNotNull()).distinct()
    return have.join(right.select(column).distinct(), column, "left_anti")


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def _literal(value, dtype: T.DataType) -> Column:
    return F.lit(value).cast(dtype)


def _slot(dtype: T.DataType) -> str:
    """The value slot of :func:`value_counts` that holds a column of this type."""
    return "real" if isinstance(dtype, CONTINUOUS) else "whole" if isinstance(dtype, WHOLE) else "text"


class CategoricalCleaner(HasRoles, Estimator, Persisted):
    """Learn per column the categories with at least ``threshold`` of the non-nulls, and the mode.

    At most 1 / ``threshold`` categories of a column can pass. Up to ``LITERALS`` of them are literals of the model;
    with a smaller threshold they stay a table, which is written at fit, joined when applied and saved with the model.
    """

    threshold = param("threshold", "minimum share of a valid category", TypeConverters.toFloat)

    def __init__(self, categoricalCols: list[str] = (), threshold: float = 0.01):
        super().__init__()
        self._set(categoricalCols=list(categoricalCols), threshold=float(threshold))

    def _fit(self, dataset: DataFrame) -> CategoricalModel:
        columns = self._categorical(dataset)
        if not columns:
            return CategoricalModel({}, {})
        threshold = self.getOrDefault("threshold")
        # The counts answer two questions; lost blocks are recounted from the source.
        counts = value_counts(dataset, columns).persist(StorageLevel.MEMORY_AND_DISK)
        summary = {r["column"]: r for r in column_modes(counts).collect()}
        modes = {c: cell_value(r["mode"]) for c, r in summary.items()}
        valid: dict[str, list] = {c: [] for c in columns}
        wide, domain = {}, ""
        if summary:
            totals = F.create_map(
                *[e for c, r in summary.items() for e in (F.lit(c), F.lit(float(r["total"])))]
            )
            good = counts.filter(F.col("n") / totals[F.col("column")] >= F.lit(threshold))
            good = good.select("column", "real", "whole", "text")
            if threshold * LITERALS >= 1:
                for r in good.collect():
                    valid[r["column"]].append(cell_value(r))
            else:
                wide = {c: _slot(dataset.schema[c].dataType) for c in columns}
                domain = fresh_path(dataset.sparkSession, "categories")
                good.write.parquet(domain)
        counts.unpersist()
        return CategoricalModel({c: sorted(v) for c, v in valid.items()}, modes, wide, domain)


class _ModelWriter(DefaultParamsWriter):
    """The params, and the table of wide domains in the folder ``domain`` beside them."""

    def save(self, path: str) -> None:
        model = self.instance
        own = model.getOrDefault("domain")
        if own and f"{own}/".startswith(path.rstrip("/") + "/"):
            # Saved over itself: the table must not go with what is overwritten.
            model._set(domain=fresh_path(self.sparkSession, "categories"))
            self.sparkSession.read.parquet(own).write.parquet(model.getOrDefault("domain"))
        super().save(path)

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.getOrDefault("domain"):
            table = self.sparkSession.read.parquet(self.instance.getOrDefault("domain"))
            table.write.parquet(f"{path.rstrip('/')}/domain")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if model.getOrDefault("domain"):
            model._set(domain=f"{path.rstrip('/')}/domain")
        return model


class CategoricalModel(Model, Persisted):
    """Replace rare, unseen and null cells by the learned mode; the row count never changes.

    A loaded model reads the table of its wide domains from the folder it was loaded from.
    """

    valid = param("valid", "valid categories per column")
    modes = param("modes", "mode per column")
    wide = param("wide", "value slot per column whose valid categories are in the table")
    domain = param("domain", "folder of the table of valid categories, or empty")

    def __init__(
        self, valid: dict | None = None, modes: dict | None = None, wide: dict | None = None, domain: str = ""
    ):
        super().__init__()
        self._setDefault(wide={}, domain="")
        self._set(valid=valid or {}, modes=modes or {}, wide=wide or {}, domain=domain)

    def write(self) -> _ModelWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> _ModelReader:
        return _ModelReader(cls)

    def _columns(self, df: DataFrame) -> list[str]:
        """Columns the model changes: present, and with a mode learned."""
        modes = self.getOrDefault("modes")
        return [c for c in self.getOrDefault("valid") if c in df.columns and modes.get(c) is not None]

    def _keys(self, df: DataFrame, column: str, slot: str, name: str) -> tuple[Column, DataFrame]:
        """The cells of ``column`` as they are joined, and the table of its valid values ``name``, each once."""
        dtype = df.schema[column].dataType
        cell, own = nan_to_null(F.col(column), dtype), _slot(dtype)
        kinds = {"real": "double", "whole": "bigint", "text": "string"}
        table = df.sparkSession.read.parquet(self.getOrDefault("domain")).filter(F.col("column") == column)
        if own == slot:
            return cell.cast(kinds[slot]), table.select(F.col(slot).alias(name))
        kind = "string" if "text" in (own, slot) else "double"
        return cell.cast(kind), table.select(F.col(slot).cast(kind).alias(name)).distinct()

    def _marked(self, df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, Column]]:
        """``df``, wide domains joined, and for each column whether its cell is valid."""
        wide, valid = self.getOrDefault("wide"), {}
        out = df
        for c in columns:
            if c not in wide:
                cell = nan_to_null(F.col(c), df.schema[c].dataType)
                valid[c] = in_values(cell, self.getOrDefault("valid")[c])
                continue
            name = "category"
            while name in out.columns:
                name += "_"
            cell, keys = self._keys(df, c, wide[c], name)
            out = out.join(keys, cell == F.col(name), "left")
            valid[c] = F.col(name).isNotNull()
        return out, valid

    def _transform(self, dataset: DataFrame) -> DataFrame:
        modes, kept = self.getOrDefault("modes"), {}
        marked, valid = self._marked(dataset, self._columns(dataset))
        for c, holds in valid.items():
            mode = _literal(modes[c], dataset.schema[c].dataType)
            kept[c] = F.when(holds, F.col(c)).otherwise(mode).alias(c)
        return marked.select(*[kept.get(c, F.col(c)) for c in dataset.columns])

    def replaced_report(self, dataset: DataFrame) -> DataFrame:
        """Cells to be replaced per column."""
        columns = self._columns(dataset)
        if not columns:
            return dataset.sparkSession.createDataFrame([], "column string, replaced bigint")
        marked, valid = self._marked(dataset.select(*columns), columns)
        rows = [F.struct(F.lit(c).alias("column"), F.count_if(~valid[c]).alias("replaced")) for c in columns]
        return marked.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))

    def unseen(self, dataset: DataFrame, column: str) -> DataFrame:
        """Distinct non-null values of ``column`` that were not valid at fit."""
        marked, valid = self._marked(dataset.select(column), [column])
        return marked.filter(F.col(column).isNotNull() & ~valid[column]).select(column).distinct()
