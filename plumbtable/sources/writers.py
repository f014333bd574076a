"""Table and report sinks. Rows are always written by the tasks; envelopes are gathered by task, a bounded number of rows each."""

from __future__ import annotations

import contextlib
import os
import re
import shutil

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Rows of an envelope, about.
ENVELOPE_ROWS = 10_000


def save_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV part files, each with a header; parents are created and an earlier output is replaced."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def save_csv_file(df: DataFrame, path: str) -> None:
    """One headered CSV file in the folder ``path``, whatever its size; an earlier output is replaced.

    Every partition is written as a part by its task, in the order of the partitions, and every part is then copied to
    its place in the file by a task. That needs a folder which takes writes at any place of a file, as shared file
    systems do (``file:``). Other stores take a file from a single writer, so a single task writes it there.
    """
    spark = df.sparkSession
    save_csv(df.limit(0), path)
    (header,) = _files(spark, path)
    if not header["path"].startswith("file:"):
        return save_csv(df.coalesce(1), path)
    save_csv(df, f"{path}/_parts", header=False)
    folder, name = os.path.split(header["path"].removeprefix("file:"))
    pieces, end, copied = [], 0, 0
    for file in [header, *sorted(_files(spark, f"{path}/_parts"), key=_number)]:
        pieces.append((file["path"].removeprefix("file:"), f"{folder}/_whole", end))
        end += file["length"]
    open(f"{folder}/_whole", "wb").close()
    # As many parts at once as there are cores; those copied go, so that the disk does not hold all rows twice.
    context = spark.sparkContext
    for at in range(0, len(pieces), context.defaultParallelism):
        some = pieces[at : at + context.defaultParallelism]
        copied += context.parallelize(some, len(some)).map(_copy).sum()
        for source, _, _ in some:
            os.remove(source)
    if copied != end:
        raise RuntimeError(f"{copied} of {end} bytes copied to {folder}/_whole")
    os.replace(f"{folder}/_whole", f"{folder}/whole.csv")
    shutil.rmtree(f"{folder}/_parts")
    # The checksum of the header by itself.
    with contextlib.suppress(FileNotFoundError):
        os.remove(f"{folder}/.{name}.crc")


def _files(spark: SparkSession, path: str) -> list[Row]:
    """``path, length`` of each file; only names and sizes are looked at."""
    return spark.read.format("binaryFile").load(path).select("path", "length").collect()


def _number(file: Row) -> tuple[int, str]:
    """A part's partition, then its name."""
    name = os.path.basename(file["path"])
    return int(re.match(r"part-(\d+)", name)[1]), name


def _copy(piece: tuple[str, str, int]) -> int:
    """Bytes of a part copied to their place; a task that runs again writes the same bytes there."""
    source, target, start = piece
    with open(source, "rb") as part, open(target, "r+b") as whole:
        whole.seek(start)
        shutil.copyfileobj(part, whole, 1 << 20)
        return whole.tell() - start


def save_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def prediction_summary(predictions: DataFrame, target: str) -> DataFrame:
    return predictions.agg(
        F.lit(target).alias("target"), F.count(F.lit(1)).alias("num_predictions")
    )


def prediction_envelopes(
    predictions: DataFrame, target: str, columns: list[str], rows: int = ENVELOPE_ROWS
) -> DataFrame:
    """``{target, part, num_predictions, predictions[]}`` rows of about ``rows`` predictions each, in parts from 0.

    Rows are dealt out in turn within each task, so equal rows do not meet in one part. No row without predictions.
    """
    parts = max(1, -(-predictions.count() // rows))
    dealt = predictions.select(*columns).withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
    return (
        dealt.groupBy(F.col("__part").alias("part"))
        .agg(F.count(F.lit(1)).alias("num_predictions"), F.collect_list(F.struct(*columns)).alias("predictions"))
        .select(F.lit(target).alias("target"), "part", "num_predictions", "predictions")
    )


def save_predictions(predictions: DataFrame, path: str, target: str) -> None:
    """Prediction rows under ``rows`` and ``{target, num_predictions}`` under ``summary``."""
    save_json(predictions, f"{path}/rows")
    written = predictions.sparkSession.read.schema(predictions.schema).json(f"{path}/rows")
    save_json(prediction_summary(written, target), f"{path}/summary")


def save_metrics(metrics: DataFrame, path: str) -> None:
    """One row per target."""
    save_json(metrics, path)


def save_report(report: dict[str, DataFrame], path: str) -> None:
    """A monitoring report: one folder of JSON rows per section."""
    for section, df in report.items():
        save_json(df, f"{path}/{section}")
