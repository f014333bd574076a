"""Fitted state: cleaning and encoding pipelines, models, and the signature beside each model."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def save_pipeline(model, path: str) -> None:
    """Persist a fitted pipeline or stage; its learned values are JSON params."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a forest or boosted-tree regression model by the class its metadata names."""
    from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
    from pyspark.ml.util import DefaultParamsReader

    spark = SparkSession.getActiveSession()
    name = DefaultParamsReader.loadMetadata(path, spark)["class"].rsplit(".", 1)[-1]
    kinds = {c.__name__: c for c in (RandomForestRegressionModel, GBTRegressionModel)}
    if name not in kinds:
        raise ValueError(f"{path} holds a {name}, expected one of {sorted(kinds)}")
    return kinds[name].load(path)


def make_signature(example: DataFrame, features: list[str], target: str, keys: list[str]) -> dict:
    """Feature schema, target, task and the two first rows by key."""
    inputs = example.select(*features)
    rows = example.orderBy(*keys).limit(2).select(*features).collect()
    return {
        "features": features,
        "target": target,
        "task": "regression",
        "schema": json.loads(inputs.schema.json()),
        "input_example": [r.asDict() for r in rows],
    }


def save_signature(spark: SparkSession, signature: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(signature),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_signature(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def check_signature(df: DataFrame, signature: dict) -> None:
    """Refuse a table that lacks a feature or holds it in a type that is no number where one is needed."""
    wanted = T.StructType.fromJson(signature["schema"])
    missing = [f.name for f in wanted.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks the features {missing}")
    wrong = [
        f.name
        for f in wanted.fields
        if isinstance(f.dataType, T.NumericType) and not isinstance(df.schema[f.name].dataType, T.NumericType)
    ]
    if wrong:
        raise ValueError(f"features are not numeric: {wrong}")
