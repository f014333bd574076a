"""Training and scoring cleaners and the initial cleaning job."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from plumbtable.operators.categories import CategoricalCleaner
from plumbtable.operators.convert import FeatureSelector, TypeConverter
from plumbtable.operators.duplicates import DuplicateRemover
from plumbtable.operators.missing import MissingValueImputer, MissingValueModel
from plumbtable.operators.outliers import OutlierModel, OutlierRemover
from plumbtable.session import settle
from plumbtable.sources.readers import load_csv
from plumbtable.sources.state import save_pipeline
from plumbtable.sources.writers import save_parquet

OUTLIER_HANDLING = ("none", "clip", "remove")


def training_cleaner(
    numeric_cols: list[str],
    categorical_cols: list[str],
    columns_to_drop: list[str] = (),
    iqr_multiplier: float = 7.0,
    imputation_strategy: str = "median",
    categorical_threshold: float = 0.01,
    exact: bool = True,
) -> Pipeline:
    """Coerce, impute, remove outliers, rare to mode, dedup, drop columns; each fitted on the output before it.

    Dedup runs before the column drop, so it also looks at the columns to be dropped.
    """
    return Pipeline(
        stages=[
            TypeConverter(numeric_cols, categorical_cols),
            MissingValueImputer(numeric_cols, categorical_cols, imputation_strategy, exact),
            OutlierRemover(numeric_cols, iqr_multiplier, "remove", exact),
            CategoricalCleaner(categorical_cols, categorical_threshold),
            DuplicateRemover(),
            FeatureSelector(columns_to_drop),
        ]
    )


def scoring_cleaner(
    numeric_cols: list[str],
    categorical_cols: list[str],
    handle_outliers: str = "none",
    iqr_multiplier: float = 7.0,
    imputation_strategy: str = "median",
    categorical_threshold: float = 0.01,
    dedup: bool = False,
    exact: bool = True,
) -> Pipeline:
    """The scoring variant: every input row keeps its row unless removal or dedup is asked for."""
    if handle_outliers not in OUTLIER_HANDLING:
        raise ValueError(f"handle_outliers must be one of {OUTLIER_HANDLING}, got {handle_outliers!r}")
    stages = [
        TypeConverter(numeric_cols, categorical_cols),
        MissingValueImputer(numeric_cols, categorical_cols, imputation_strategy, exact),
    ]
    if handle_outliers != "none":
        stages.append(OutlierRemover(numeric_cols, iqr_multiplier, handle_outliers, exact))
    stages.append(CategoricalCleaner(categorical_cols, categorical_threshold))
    if dedup:
        stages.append(DuplicateRemover())
    return Pipeline(stages=stages)


def row_preserving(cleaner: PipelineModel, outliers: str = "none") -> PipelineModel:
    """The fitted training cleaner made safe for scoring: nothing in it drops a row.

    Outlier removal becomes clipping or nothing, dedup and null-row drops go.
    """
    if outliers not in ("none", "clip"):
        raise ValueError(f"outliers must be 'none' or 'clip', got {outliers!r}")
    stages = []
    for stage in cleaner.stages:
        if isinstance(stage, DuplicateRemover):
            continue
        if isinstance(stage, MissingValueModel) and stage.getOrDefault("strategy") == "drop":
            continue
        if isinstance(stage, OutlierModel):
            if outliers == "clip":
                stages.append(OutlierModel(stage.getOrDefault("bounds"), "clip"))
            continue
        stages.append(stage)
    return PipelineModel(stages)


def stage_typed(df: DataFrame, numeric_cols: list[str], categorical_cols: list[str]) -> DataFrame:
    """The coerced table, written once to the shared folder and read back.

    Fitting passes over the data several times. Over text those passes would parse every cell
    again; over this copy they read only the columns they need.
    """
    return settle(TypeConverter(numeric_cols, categorical_cols).transform(df), "typed")


def run_initial_cleaning(
    spark: SparkSession,
    source: str | DataFrame,
    output: str,
    state: str,
    numeric_cols: list[str],
    categorical_cols: list[str],
    **options,
) -> DataFrame:
    """Read, fit and apply the training cleaner, write the cleaned table and the fitted state.

    The returned table is read back from ``output``, so later steps do not repeat the cleaning.
    """
    raw = load_csv(spark, source) if isinstance(source, str) else source
    typed = stage_typed(raw, numeric_cols, categorical_cols)
    cleaner = training_cleaner(numeric_cols, categorical_cols, **options).fit(typed)
    cleaned = cleaner.transform(typed)
    save_parquet(cleaned, output)
    save_pipeline(cleaner, state)
    return spark.read.schema(cleaned.schema).parquet(output)
