"""Leakage-safe feature preparation: split first, fit on the training side, apply to both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbtable.operators.encode import FeatureEncoder, FeatureEncoderModel
from plumbtable.operators.split import train_test_split
from plumbtable.plans.cleaning import run_initial_cleaning
from plumbtable.sources.state import save_pipeline
from plumbtable.sources.writers import save_parquet


@dataclass(frozen=True)
class FeatureSets:
    train: DataFrame
    test: DataFrame
    encoder: FeatureEncoderModel

    @property
    def features(self) -> list[str]:
        return self.encoder.feature_names

    def prepared(self) -> DataFrame:
        """Train and test together."""
        return self.train.unionByName(self.test)


def prepare_features(
    df: DataFrame,
    numeric_cols: list[str],
    categorical_cols: list[str],
    target_cols: list[str],
    keys: list[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    keep: list[str] = (),
) -> FeatureSets:
    """Split, fit the encoder on the training rows only, and encode both sides.

    ``keys`` identify a row for the split; by default every column does, which suits a
    deduplicated table. ``keep`` columns pass through unchanged.
    """
    train, test = train_test_split(df, keys or df.columns, test_size, seed)
    wanted = [c for c in [*numeric_cols, *categorical_cols, *target_cols, *keep] if c in df.columns]
    encoder = FeatureEncoder(numeric_cols, categorical_cols).fit(train)
    return FeatureSets(
        encoder.transform(train.select(*wanted)), encoder.transform(test.select(*wanted)), encoder
    )


def run_feature_engineering(
    spark: SparkSession,
    df: DataFrame,
    output: str,
    state: str,
    numeric_cols: list[str],
    categorical_cols: list[str],
    target_cols: list[str],
    **options,
) -> FeatureSets:
    """:func:`prepare_features`, written to ``output/train``, ``output/test`` and ``state``."""
    sets = prepare_features(df, numeric_cols, categorical_cols, target_cols, **options)
    for name, side in (("train", sets.train), ("test", sets.test)):
        save_parquet(side, f"{output}/{name}")
    save_pipeline(sets.encoder, state)
    read = spark.read.schema(sets.train.schema)
    return FeatureSets(read.parquet(f"{output}/train"), read.parquet(f"{output}/test"), sets.encoder)


def run_complete_workflow(
    spark: SparkSession,
    source: str | DataFrame,
    workdir: str,
    numeric_cols: list[str],
    categorical_cols: list[str],
    numeric_features: list[str],
    categorical_features: list[str],
    target_cols: list[str],
    columns_to_drop: list[str] = (),
    test_size: float = 0.2,
    seed: int = 42,
) -> FeatureSets:
    """Initial cleaning followed by feature engineering, everything under ``workdir``."""
    cleaned = run_initial_cleaning(
        spark,
        source,
        f"{workdir}/interim",
        f"{workdir}/state/cleaner",
        numeric_cols,
        categorical_cols,
        columns_to_drop=columns_to_drop,
    )
    return run_feature_engineering(
        spark,
        cleaned,
        f"{workdir}/processed",
        f"{workdir}/state/encoder",
        numeric_features,
        categorical_features,
        target_cols,
        test_size=test_size,
        seed=seed,
    )
