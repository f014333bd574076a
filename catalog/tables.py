"""Views of the given tables that the queries share, in Spark and in SQL.

The given tables are clean, so dirt is derived from the row key by the same rule on both sides.
Every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbtable.operators.convert import coerce_columns

# The date that parts reference events from current ones.
CUT = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int) -> Column:
    return F.col("event_id") % n == 0


def dirty(events: DataFrame) -> DataFrame:
    """Events as a dirty text table: missing, junk, blank and wild cells."""
    value = (
        F.when(every(17), F.lit(None))
        .when(every(23), "error")
        .when(every(29), "   ")
        .when(every(101), F.format_string("%.2f", F.col("value") * 1000))
        .otherwise(F.format_string("%.2f", "value"))
    )
    return events.select(
        "event_id",
        "ts",
        value.alias("value"),
        F.when(~every(19), F.col("user_id").cast("string")).alias("user_id"),
        F.when(~every(31), F.get_json_object("props", "$.k")).alias("k"),
        F.when(~every(37), F.col("event_type")).alias("event_type"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(table(spark, sf_dir, "events"))


READINGS_SQL = r"""
readings AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 17 = 0 THEN NULL
         WHEN event_id % 23 = 0 THEN 'error'
         WHEN event_id % 29 = 0 THEN '   '
         WHEN event_id % 101 = 0 THEN printf('%.2f', value * 1000)
         ELSE printf('%.2f', value) END AS value,
    CASE WHEN event_id % 19 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 31 <> 0 THEN regexp_extract(props, '(\d+)', 1) END AS k,
    CASE WHEN event_id % 37 <> 0 THEN event_type END AS event_type
  FROM events)"""


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_columns(readings(spark, sf_dir), ["value", "user_id", "k"])


TYPED_SQL = (
    READINGS_SQL
    + """,
typed AS (
  SELECT event_id, ts, try_cast(trim(value) AS DOUBLE) AS value, try_cast(user_id AS DOUBLE) AS user_id,
    try_cast(k AS DOUBLE) AS k, event_type
  FROM readings)"""
)

MODE_SQL = "(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def mode_sql(column: str, source: str) -> str:
    return MODE_SQL.format(c=column, t=source)


IMPUTED_SQL = (
    TYPED_SQL
    + f""",
imputed AS (
  SELECT event_id, ts,
    coalesce(value, (SELECT quantile_cont(value, 0.5) FROM typed)) AS value,
    coalesce(user_id, (SELECT quantile_cont(user_id, 0.5) FROM typed)) AS user_id,
    coalesce(k, {mode_sql("k", "typed")}) AS k,
    event_type
  FROM typed)"""
)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with two truths and two formula predictions."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        (F.col("l_extendedprice") / 1000).alias("y1"),
        (F.col("l_extendedprice") / 1000 * 0.97 + F.col("l_quantity") * 0.05).alias("p1"),
        F.col("l_quantity").alias("y2"),
        (F.col("l_quantity") * 0.9 + F.col("l_discount") * 10 + F.col("l_linenumber") * 0.3).alias("p2"),
    )


PREDICTIONS_SQL = """
predictions AS (
  SELECT l_orderkey, l_returnflag, l_extendedprice / 1000 AS y1,
    l_extendedprice / 1000 * 0.97 + l_quantity * 0.05 AS p1,
    l_quantity AS y2, l_quantity * 0.9 + l_discount * 10 + l_linenumber * 0.3 AS p2
  FROM lineitem)"""

TARGETS = {"heating": ("y1", "p1"), "cooling": ("y2", "p2")}
FEATURES = ["value", "user_id", "k"]


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events before and from ``CUT``, scored by formula; the later ones have shifted values and errors."""
    events = table(spark, sf_dir, "events")
    base = events.select(
        "event_id",
        (F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).alias("early"),
        "value",
        F.col("user_id").cast("double").alias("user_id"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    ref = base.filter("early").select(
        "event_id", "value", "user_id", "k",
        F.col("value").alias("y1"),
        (F.col("value") + (F.col("event_id") % 7 - 3) * 0.5).alias("p1"),
        F.col("k").alias("y2"),
        (F.col("k") + (F.col("event_id") % 5 - 2) * 0.5).alias("p2"),
    )
    cur = base.filter("NOT early").select(
        "event_id", (F.col("value") * 1.2 + 1).alias("value"), "user_id", "k",
        F.col("value").alias("y1"),
        (F.col("value") + (F.col("event_id") % 7 - 3) * 0.5 + 2).alias("p1"),
        F.col("k").alias("y2"),
        (F.col("k") + (F.col("event_id") % 5 - 2) * 0.5).alias("p2"),
    )
    return ref, cur


SIDES_SQL = f"""
base AS (
  SELECT event_id, ts, value, CAST(user_id AS DOUBLE) AS user_id,
    CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS k
  FROM events),
ref AS (
  SELECT event_id, value, user_id, k, value AS y1, value + (event_id % 7 - 3) * 0.5 AS p1,
    k AS y2, k + (event_id % 5 - 2) * 0.5 AS p2
  FROM base WHERE ts < TIMESTAMP '{CUT}'),
cur AS (
  SELECT event_id, value * 1.2 + 1 AS value, user_id, k, value AS y1,
    value + (event_id % 7 - 3) * 0.5 + 2 AS p1, k AS y2, k + (event_id % 5 - 2) * 0.5 AS p2
  FROM base WHERE ts >= TIMESTAMP '{CUT}')"""


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison; an exact zero never shows a sign."""
    return df.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
