"""Table sources. Dirty text is read as text and coerced later; types are never inferred from it."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbtable.operators.convert import coerce_all
from plumbtable.sources.documents import cut_rows
from plumbtable.sources.records import csv_records

# Cell texts a CSV reader of the data model takes as missing.
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def load_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, missing: list[str] | None = None
) -> DataFrame:
    """Headered CSV with every column as text; missing markers become null.

    A quote inside a quoted cell is doubled, and a quoted cell may hold line breaks, which stay as they are. Files
    are split among tasks either way: one pass over the lines tells whether any ends inside a quoted cell, and if
    so the records are cut by an index of the splits (``records``). Lines end with a line feed, with or without a
    carriage return; lines of white space only are skipped. ``columns`` names the columns by position.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    names = columns or reader.option("multiLine", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    records = csv_records(spark, path) if names else None
    if records is None:
        rows = reader.option("multiLine", False).schema(schema).csv(path)
    else:
        ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        rows = records.select(F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"}).alias("row")).select("row.*")
    return mark_missing(rows, MISSING_MARKERS if missing is None else missing)


def mark_missing(df: DataFrame, markers: list[str]) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(markers), F.col(c)) for c in text})


def load_positional_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Skip the header row and impose ``names`` by position."""
    return load_csv(spark, path).toDF(*names)


def _has_large_files(spark: SparkSession, path: str) -> bool:
    """Whether a file takes more than one split; only the files' names and sizes are looked at."""
    size = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    limit = spark.sql("SET spark.sql.files.maxPartitionBytes").first()["value"]
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", limit.strip().lower())
    bytes_limit = int(found[1]) << 10 * " kmgt".index(found[2] or " ") if found else 128 << 20
    return (size or 0) > bytes_limit


def has_document_per_line(spark: SparkSession, path: str) -> bool:
    """Whether the JSON text has a document per line: its first two lines with text are documents by themselves."""
    lines = [r["value"] for r in spark.read.text(path).where("trim(value) <> ''").limit(2).collect()]

    def whole(text: str) -> bool:
        try:
            return isinstance(json.loads(text), (dict, list))
        except ValueError:
            return False

    return len(lines) == 2 and all(map(whole, lines))


def load_rows_json(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, lines: bool | None = None
) -> DataFrame:
    """JSON documents that are a list of rows, or an object holding that list under ``rows``.

    ``schema`` is the schema of one row; without it the row type is read from the documents. A file has a document
    per line, or is one document; ``lines`` says which, or it is told from the first two lines. Either is split
    among tasks: the rows of documents larger than a split are cut out by an index (``documents``).
    """
    if lines is None:
        lines = has_document_per_line(spark, path)
    if not lines and _has_large_files(spark, path):
        rows = spark.read.schema(schema) if schema is not None else spark.read
        return rows.json(cut_rows(spark, path))

    def read(wanted: T.StructType | None = None) -> DataFrame:
        reader = spark.read.option("multiLine", not lines)
        return (reader.schema(wanted) if wanted else reader).json(path)

    if schema is not None:
        row = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        # Both document shapes under one schema: a bare row has no "rows", an object no row columns.
        either = T.StructType([*row.fields, T.StructField("rows", T.ArrayType(row))])
        here = F.struct(*[F.col(n).alias(n) for n in row.fieldNames()])
        return read(either).select(F.inline(F.coalesce("rows", F.array(here))))
    document = read()
    if "rows" not in document.columns or not isinstance(document.schema["rows"].dataType, T.ArrayType):
        return document
    if not isinstance(document.schema["rows"].dataType.elementType, T.StructType):
        raise ValueError(f"no rows in {path}")
    return document.select(F.inline("rows"))


def load_input(
    spark: SparkSession,
    csv_path: str | None = None,
    json_path: str | None = None,
    lines: bool | None = None,
) -> DataFrame:
    """Rows to score from a CSV file or from JSON documents."""
    if csv_path:
        return load_csv(spark, csv_path)
    if json_path:
        return load_rows_json(spark, json_path, lines=lines)
    raise ValueError("give a CSV path or a JSON path")


def rows_to_table(spark: SparkSession, rows: list[dict], schema: str | T.StructType | None = None) -> DataFrame:
    """A request's rows as a table; an empty request is refused."""
    if not rows:
        raise ValueError("no rows given")
    return spark.createDataFrame(rows, schema)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def split_roles(df: DataFrame, targets: list[str]) -> tuple[list[str], list[str]]:
    """Feature and target columns of a prepared table: every column but the targets is a feature."""
    missing = [t for t in targets if t not in df.columns]
    if missing:
        raise ValueError(f"target columns not in the table: {missing}")
    return [c for c in df.columns if c not in targets], list(targets)


def load_prepared(spark: SparkSession, path: str, targets: list[str]) -> tuple[DataFrame, list[str]]:
    """A prepared table (Parquet, or CSV coerced to numbers) and its feature columns."""
    df = coerce_all(load_csv(spark, path)) if path.endswith(".csv") else load_parquet(spark, path)
    return df, split_roles(df, targets)[0]
