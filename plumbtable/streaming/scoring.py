"""Arriving files of rows in, predictions out, with the expressions and models of the batch path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbtable.plans.scoring import MultiTargetPredictor


def row_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    source: str = "json",
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """A stream of rows from files landing in ``path``."""
    reader = spark.readStream.format(source).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def start_stream(
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """Apply a stateless ``transform`` and append to a Parquet sink, each row exactly once.

    Without ``continuous`` (a processing interval) everything available is handled and the query ends.
    ``checkpoint`` must be on shared storage: a restart continues from it.
    """
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        transform(rows)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(sink)
    )


def score_stream(
    rows: DataFrame,
    predictor: MultiTargetPredictor,
    sink: str,
    checkpoint: str,
    keep: list[str] = (),
    continuous: str | None = None,
) -> StreamingQuery:
    """Score a stream: the ``keep`` columns and one prediction per target for every arriving row."""
    return start_stream(
        rows, lambda df: predictor.predict_columns(df, list(keep)), sink, checkpoint, continuous
    )
