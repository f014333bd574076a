"""Row-preserving scoring: clean, encode and predict as one projection, for batch and stream alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from plumbtable.operators.encode import FeatureEncoderModel
from plumbtable.plans.cleaning import row_preserving
from plumbtable.plans.training import score_all
from plumbtable.sources.readers import load_input, rows_to_table
from plumbtable.sources.state import check_signature, load_model, load_pipeline, load_signature
from plumbtable.sources.writers import save_predictions

TARGETS = ("heating", "cooling")


class MultiTargetPredictor:
    """Fitted cleaner, encoder and one model per target, loaded once."""

    def __init__(
        self,
        cleaner: PipelineModel,
        encoder: FeatureEncoderModel,
        models: dict[str, object],
        outliers: str = "none",
        signatures: dict[str, dict] | None = None,
    ):
        self.cleaner = row_preserving(cleaner, outliers)
        self.encoder = encoder
        self.models = dict(models)
        self.signatures = signatures or {}

    @classmethod
    def load(
        cls, cleaner_path: str, encoder_path: str, model_paths: dict[str, str], outliers: str = "none"
    ) -> MultiTargetPredictor:
        spark = SparkSession.getActiveSession()
        signatures = {
            t: load_signature(spark, p.removesuffix("_model") + "_signature")
            for t, p in model_paths.items()
            if p.endswith("_model")
        }
        return cls(
            load_pipeline(cleaner_path),
            FeatureEncoderModel.load(encoder_path),
            {t: load_model(p) for t, p in model_paths.items()},
            outliers,
            signatures,
        )

    def preprocess(self, df: DataFrame) -> DataFrame:
        """Cleaned and encoded features beside the input's other columns; one row per input row."""
        return self.encoder.transform(self.cleaner.transform(df))

    def predict(self, data: DataFrame | list[dict], prefix: str = "") -> DataFrame:
        """Input columns of the encoded table with one prediction column per target."""
        if isinstance(data, list):
            data = rows_to_table(SparkSession.getActiveSession(), data)
        out = self.preprocess(data)
        for signature in self.signatures.values():
            check_signature(out, signature)
        models = {f"{prefix}{t}": m for t, m in self.models.items()}
        return score_all(models, out, self.encoder.feature_names)

    def predict_columns(self, data: DataFrame | list[dict], keep: list[str] = ()) -> DataFrame:
        """Only the ``keep`` columns and the predictions."""
        return self.predict(data).select(*keep, *self.models)


class Predictor(MultiTargetPredictor):
    """One target; the prediction column is ``prediction``."""

    def __init__(self, cleaner, encoder, model, outliers: str = "none"):
        super().__init__(cleaner, encoder, {"prediction": model}, outliers)


def predict_table(predictor: MultiTargetPredictor, df: DataFrame, prefix: str = "prediction_") -> DataFrame:
    """Score a table in place of calling a service per batch: ``prediction_<target>`` beside every row."""
    return predictor.predict(df, prefix)


def batch_score(
    spark: SparkSession,
    models_dir: str,
    state_dir: str,
    output: str,
    csv_path: str | None = None,
    json_path: str | None = None,
    target: str = "both",
    model_name: str = "xgboost",
    lines: bool | None = None,
) -> DataFrame:
    """Load rows and fitted state, score one target or both, write predictions, return what was written."""
    if target not in (*TARGETS, "both"):
        raise ValueError(f"target must be one of {(*TARGETS, 'both')}, got {target!r}")
    wanted = TARGETS if target == "both" else (target,)
    predictor = MultiTargetPredictor.load(
        f"{state_dir}/cleaner",
        f"{state_dir}/encoder",
        {t: f"{models_dir}/{model_name}_{t}_model" for t in wanted},
    )
    rows = load_input(spark, csv_path, json_path, lines)
    predictions = predictor.predict_columns(rows)
    save_predictions(predictions, output, target)
    return spark.read.schema(predictions.schema).json(f"{output}/rows")
