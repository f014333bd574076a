"""The one-table cleaner: a chain of the single steps under one role configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from plumbtable.operators import categories, convert, missing, outliers

LEGACY_MULTIPLIER = 1.5


@dataclass(frozen=True)
class CleaningConfig:
    """Column roles, and the share of cells a row must have to stay."""

    numeric_cols: list[str] = field(default_factory=list)
    categorical_cols: list[str] = field(default_factory=list)
    threshold: float = 0.7

    def __post_init__(self):
        if not 0 <= self.threshold <= 1:
            raise ValueError(f"threshold must lie in [0, 1], got {self.threshold}")
        if not self.numeric_cols or not self.categorical_cols:
            raise ValueError("numeric_cols and categorical_cols must not be empty")


class DataCleaner:
    """Chainable steps on a table: ``DataCleaner(df).apply_config(cfg).coerce_numeric().get()``.

    Each step returns a new cleaner around a lazily derived table; steps that learn from the data
    (fills, outliers) run their fit when called.
    """

    def __init__(self, df: DataFrame, config: CleaningConfig | None = None):
        self._df = df
        self._config = config

    def _then(self, df: DataFrame) -> DataCleaner:
        return DataCleaner(df, self._config)

    @property
    def config(self) -> CleaningConfig:
        if self._config is None:
            raise ValueError("call apply_config first")
        return self._config

    def apply_config(self, config: CleaningConfig) -> DataCleaner:
        return DataCleaner(self._df, config)

    def coerce_numeric(self) -> DataCleaner:
        return self._then(
            convert.coerce_columns(self._df, [*self.config.numeric_cols, *self.config.categorical_cols])
        )

    def drop_missing_values(self) -> DataCleaner:
        return self._then(missing.drop_null_threshold(self._df, self.config.threshold))

    def clean_currency(self, column: str) -> DataCleaner:
        return self._then(convert.clean_currency(self._df, column))

    def clip_outliers(self, column: str, lower: float | None = 0, upper: float | None = 100) -> DataCleaner:
        return self._then(convert.clip_constants(self._df, column, lower, upper))

    def fill_continuous_with_median(self) -> DataCleaner:
        return self._then(missing.fill_continuous_with_median(self._df, self.config.numeric_cols))

    def fill_categorical_with_mode(self) -> DataCleaner:
        return self._then(missing.fill_categorical_with_mode(self._df, self.config.categorical_cols))

    def remove_outliers_iqr(self) -> DataCleaner:
        kept, _ = outliers.remove_outliers_sequential(
            self._df, self.config.numeric_cols, LEGACY_MULTIPLIER
        )
        return self._then(kept)

    def filter_valid_categories(self, valid: dict[str, list]) -> DataCleaner:
        return self._then(categories.filter_valid_categories(self._df, valid))

    def split_versions(self) -> tuple[DataFrame, DataFrame]:
        return missing.split_versions(self._df, self.config.numeric_cols, self.config.categorical_cols)

    def get(self) -> DataFrame:
        return self._df
