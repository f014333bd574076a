"""Value counts of several columns at once: the base of modes, shares and category domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.functions.columns import CONTINUOUS, WHOLE, nan_to_null


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(column, real, whole, text, n)``, nulls left out; one of the three value slots is set.

    Counts are combined map-side before the shuffle, so a value that fills a third of the table
    costs one row per task.
    """
    values, cells = [], []
    for i, c in enumerate(columns):
        dtype = df.schema[c].dataType
        slot = "real" if isinstance(dtype, CONTINUOUS) else "whole" if isinstance(dtype, WHOLE) else "text"
        kind = {"real": "double", "whole": "bigint", "text": "string"}
        values.append(nan_to_null(F.col(c), dtype).cast(kind[slot]).alias(f"v{i}"))
        slots = [(F.col(f"v{i}") if s == slot else F.lit(None).cast(k)).alias(s) for s, k in kind.items()]
        cells.append(F.struct(F.lit(c).alias("column"), *slots))
    return (
        # Computed before the rows are exploded, where Spark compiles expressions.
        df.select(*values)
        .select(F.inline(F.array(*cells)))
        .filter("real IS NOT NULL OR whole IS NOT NULL OR text IS NOT NULL")
        .groupBy("column", "real", "whole", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_modes(counts: DataFrame) -> DataFrame:
    """Smallest most frequent value and the non-null total per column, from :func:`value_counts`."""
    smallest_of_most = F.min_by(
        F.struct("real", "whole", "text"), F.struct((-F.col("n")).alias("n"), "real", "whole", "text")
    )
    return counts.groupBy("column").agg(smallest_of_most.alias("mode"), F.sum("n").alias("total"))


def cell_value(cell):
    """The one set slot of a ``(real, whole, text)`` row."""
    for slot in ("real", "whole", "text"):
        if cell[slot] is not None:
            return cell[slot]
    return None
