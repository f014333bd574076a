"""Min-max scaling and one-hot encoding, fitted on one table and applied to any."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.functions.columns import integral_label, nan_to_null
from plumbtable.operators.counts import cell_value, value_counts
from plumbtable.operators.stages import HasRoles, Persisted, param
from plumbtable.session import settle


def learn_ranges(df: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    if not columns:
        return {}
    aggs = []
    for c in columns:
        value = nan_to_null(F.col(c), df.schema[c].dataType).cast("double")
        aggs += [F.min(value).alias(f"lo_{c}"), F.max(value).alias(f"hi_{c}")]
    row = df.agg(*aggs).first()
    return {c: [row[f"lo_{c}"], row[f"hi_{c}"]] for c in columns}


#: Categories a column may have to become columns.
MOST_CATEGORIES = 10_000


def learn_domains(df: DataFrame, columns: list[str], most: int = MOST_CATEGORIES) -> dict[str, list]:
    """Sorted non-null categories per column.

    Each becomes a column and part of the fitted state, so a column with more than ``most`` is refused;
    :func:`sparse_one_hot` encodes a domain of any size.
    """
    if not columns:
        return {}
    domains: dict[str, list] = {c: [] for c in columns}
    # One row more than all columns may have tells a column that has too many.
    counts = value_counts(df, columns).select("column", "real", "whole", "text").limit(most * len(columns) + 1)
    for r in counts.collect():
        domains[r["column"]].append(cell_value(r))
    wide = [c for c, v in domains.items() if len(v) > most]
    if wide:
        raise ValueError(f"more than {most} categories in {wide}: encode them with sparse_one_hot")
    return {c: sorted(v) for c, v in domains.items()}


def min_max_columns(df: DataFrame, ranges: dict[str, list[float]]) -> dict:
    """``(x - min) / (max - min)``; a column constant at fit scales by 1, so its value maps to 0."""
    out = {}
    for c, (lo, hi) in ranges.items():
        if c not in df.columns:
            continue
        value = nan_to_null(F.col(c), df.schema[c].dataType).cast("double")
        if lo is None:
            out[c] = F.lit(None).cast("double")
        else:
            out[c] = (value - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0)
    return out


def one_hot_names(column: str, domain: list) -> list[str]:
    return [f"{column}_{integral_label(v)}" for v in domain[1:]]


def free_names(domains: dict[str, list], taken: list[str]) -> dict[str, list[str]]:
    """Names of the one-hot columns; where one is taken already, its column's names get one more ``_`` each."""
    used, out = set(taken), {}
    for c, domain in domains.items():
        prefix, names = c, one_hot_names(c, domain)
        while used & set(names) or len(set(names)) < len(names) and len(prefix) < len(c) + 3:
            prefix += "_"
            names = one_hot_names(prefix, domain)
        used.update(names)
        out[c] = names
    return out


def category_positions(df: DataFrame, column: str) -> DataFrame:
    """``(value, position, size)``: each non-null category's place in sorted order, from 0, and their number.

    The categories are sorted by ranges; a task numbers its own range, and the ranges' sizes, a row per task,
    give the offsets. The table is written to the shared folder.
    """
    cell = nan_to_null(F.col(column), df.schema[column].dataType).alias("value")
    values = df.select(cell).where("value IS NOT NULL").distinct()
    ranged = values.repartitionByRange("value").sortWithinPartitions("value")
    placed = settle(ranged.withColumn("place", F.monotonically_increasing_id()), "categories")
    span = F.shiftright("place", 33)
    sizes = sorted(placed.groupBy(span.alias("span")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for s in sizes:
        offsets.append((s["span"], total))
        total += s["n"]
    table = df.sparkSession.createDataFrame(offsets, "span bigint, offset bigint")
    return placed.withColumn("span", span).join(F.broadcast(table), "span").select(
        "value",
        (F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("position"),
        F.lit(total).cast("bigint").alias("size"),
    )


def sparse_one_hot(df: DataFrame, column: str, positions: DataFrame, name: str) -> DataFrame:
    """Add ``name``: a sparse 0/1 vector ``struct<size, indices, values>`` over all categories but the first.

    An unseen or null category is the empty vector. The categories are joined, so their number has no limit;
    they are unique, so that the adaptive skew join may divide a hot category.
    """
    size = positions.agg(F.max("size")).first()[0] or 1
    known = positions.select(F.col("value").alias("__value"), F.col("position").alias("__position"))
    joined = df.join(known, F.col(column) == F.col("__value"), "left")
    some = F.col("__position") > 0
    vector = F.struct(
        F.lit(size - 1).cast("bigint").alias("size"),
        F.when(some, F.array(F.col("__position") - 1)).otherwise(F.array().cast("array<bigint>")).alias("indices"),
        F.when(some, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    return joined.select(*[F.col(c) for c in df.columns], vector.alias(name))


def one_hot_columns(df: DataFrame, domains: dict[str, list], names: dict[str, list[str]] | None = None) -> dict:
    """One 0/1 column per category but the first; an unseen or null category is all zeros."""
    out = {}
    for c, domain in domains.items():
        if c not in df.columns:
            continue
        for name, v in zip((names or {}).get(c) or one_hot_names(c, domain), domain[1:]):
            hit = F.col(c) == F.lit(v).cast(df.schema[c].dataType)
            out[name] = F.coalesce(hit, F.lit(False)).cast("double")
    return out


class FeatureEncoder(HasRoles, Estimator, Persisted):
    """Learn ranges of the numeric and domains of the categorical columns."""

    def __init__(self, numericCols: list[str] = (), categoricalCols: list[str] = ()):
        super().__init__()
        self._set(numericCols=list(numericCols), categoricalCols=list(categoricalCols))

    def _fit(self, dataset: DataFrame) -> FeatureEncoderModel:
        domains = learn_domains(dataset, self._categorical(dataset))
        names = free_names(domains, [c for c in dataset.columns if c not in domains])
        return FeatureEncoderModel(learn_ranges(dataset, self._numeric(dataset)), domains, names)


class FeatureEncoderModel(Model, Persisted):
    """One projection: scaled numerics, one-hot categories, then every other column unchanged."""

    ranges = param("ranges", "minimum and maximum per numeric column")
    domains = param("domains", "sorted categories per categorical column")
    names = param("names", "names of the one-hot columns per categorical column")

    def __init__(self, ranges: dict | None = None, domains: dict | None = None, names: dict | None = None):
        super().__init__()
        self._set(ranges=ranges or {}, domains=domains or {}, names=names or {})

    @property
    def feature_names(self) -> list[str]:
        names = list(self.getOrDefault("ranges"))
        for c, domain in self.getOrDefault("domains").items():
            names += self.getOrDefault("names").get(c) or one_hot_names(c, domain)
        return names

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = min_max_columns(dataset, self.getOrDefault("ranges"))
        hot = one_hot_columns(dataset, self.getOrDefault("domains"), self.getOrDefault("names"))
        used = set(scaled) | set(self.getOrDefault("domains"))
        return dataset.select(
            *[e.alias(n) for n, e in {**scaled, **hot}.items()],
            *[F.col(c) for c in dataset.columns if c not in used],
        )
