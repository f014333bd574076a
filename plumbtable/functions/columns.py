"""Null-safe scalar expressions. Everything here is a JVM-side ``Column``; there are no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as a number, and texts counted as a valid number entry.
NUMBER_TEXT = r"^\s*([+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity)))\s*$"
PLAIN_NUMBER_TEXT = r"^-?\d+(\.\d+)?$"

CONTINUOUS = (T.DoubleType, T.FloatType, T.DecimalType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, CONTINUOUS + WHOLE)


def nan_to_null(col: Column, dtype: T.DataType) -> Column:
    """NaN is the one null of the data model; normalise it before any comparison.

    Mentions the column once, so a costly expression behind it is not repeated.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def to_number(col: Column, dtype: T.DataType) -> Column:
    """Coerce to double; whatever does not parse becomes null."""
    if isinstance(dtype, T.StringType):
        # One mention of the cell: its expression is not repeated where Spark inlines this one.
        return F.regexp_extract(col, NUMBER_TEXT, 1).try_cast("double")
    if isinstance(dtype, T.BooleanType) or is_numeric(dtype):
        return nan_to_null(col.cast("double"), T.DoubleType())
    return F.lit(None).cast("double")


def is_plain_number(col: Column) -> Column:
    """Whether the trimmed text is an integer or a decimal without exponent."""
    return F.trim(col).rlike(PLAIN_NUMBER_TEXT)


def currency_to_number(col: Column) -> Column:
    """Strip ``$`` and cast. Junk raises: the cast is strict on purpose."""
    return F.replace(col, F.lit("$"), F.lit("")).cast("double")


def clamp(col: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Clamp to constants and keep nulls (``least``/``greatest`` alone would turn null into a bound)."""
    out = col
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(col.isNotNull(), out)


def in_values(col: Column, values: list) -> Column:
    """``isin`` that is false, not null, for null cells and for an empty list."""
    if not values:
        return F.lit(False)
    return F.coalesce(col.isin(values), F.lit(False))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def sample_skewness(col: Column) -> Column:
    """Bias-adjusted skewness; null under three values, 0 for a constant column."""
    n = F.count(col)
    g1 = F.when(F.min(col) < F.max(col), F.skewness(col)).otherwise(F.lit(0.0))
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(col: Column) -> Column:
    """Bias-adjusted excess kurtosis; null under four values, 0 for a constant column."""
    n = F.count(col)
    varies = F.min(col) < F.max(col)
    g2 = F.when(varies, F.kurtosis(col))
    adjusted = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(n >= 4, F.when(varies, adjusted).otherwise(F.lit(0.0)))


def pair_correlation(a: Column, b: Column) -> Column:
    """Pearson r over pairwise-complete rows; null when either side is constant there.

    Two aggregates per pair. ``regr_r2`` is null for a constant ``a`` and 1 for a constant ``b``,
    which is the one case of a perfect fit without covariance.
    """
    r2, covariance = F.regr_r2(b, a), F.covar_pop(a, b)
    flat = (covariance == 0) & (r2 == 1)
    return F.when(~flat, F.signum(covariance) * F.sqrt(r2))


def key_text(keys: list[str]) -> Column:
    """The key's cells as one text, different for different keys: each with its length before it, a null as ``-``."""
    cells = []
    for k in keys:
        cell = F.col(k).cast("string")
        cells.append(F.coalesce(F.concat(F.length(cell).cast("string"), F.lit(":"), cell), F.lit("-")))
    return F.concat(*cells)


def key_digest(keys: list[str], seed: int) -> Column:
    """52 hash bits of the row key as 13 hex digits, whose text order is their numeric order."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key_text(keys))), 1, 13)


def digest_number(digest: Column) -> Column:
    """The digest as a whole number that a double holds exactly."""
    return F.conv(digest, 16, 10).cast("bigint")


def integral_label(value) -> str:
    """Category label for a generated column name: integral codes print without ``.0``."""
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)
