"""Projection, coercion, learned cleaning and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import IMPUTED_SQL, READINGS_SQL, TYPED_SQL, mode_sql, readings, rounded, table, typed
from plumbtable.operators.categories import (
    CategoricalCleaner,
    category_difference,
    category_frequencies,
    filter_valid_categories,
    sorted_distinct,
    valid_category_report,
)
from plumbtable.operators.convert import (
    FeatureSelector,
    TypeConverter,
    category_codes,
    clean_currency,
    clip_constants,
    coerce_all,
)
from plumbtable.operators.duplicates import DuplicateRemover, duplicate_report
from plumbtable.operators.missing import (
    MissingValueImputer,
    drop_any_null,
    drop_null_threshold,
    fill_categorical_with_mode,
    fill_continuous_with_median,
    split_versions,
)
from plumbtable.operators.outliers import (
    OutlierRemover,
    iqr_bounds,
    remove_outliers_sequential,
    sequential_report,
)
from plumbtable.operators.profile import audit_counts
from plumbtable.plans.cleaning import scoring_cleaner, training_cleaner

NUMBERS = ["value", "user_id"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STATUS = {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}


@query("SELECT event_id, user_id, event_type FROM events")
def project_drop(spark, sf):
    return FeatureSelector(["ts", "value", "props", "absent"]).transform(table(spark, sf, "events"))


@query(f"WITH {TYPED_SQL} SELECT event_id, value, user_id, k FROM typed")
def coerce_numeric(spark, sf):
    return TypeConverter(NUMBERS, ["k"]).transform(readings(spark, sf)).drop("ts", "event_type")


@query(
    f"WITH {TYPED_SQL} SELECT CAST(event_id AS DOUBLE) AS event_id, value, user_id, k, "
    "CAST(NULL AS DOUBLE) AS event_type FROM typed"
)
def coerce_every_column(spark, sf):
    return coerce_all(readings(spark, sf).drop("ts"))


@query(f"WITH {TYPED_SQL} SELECT event_id, CAST(k AS INTEGER) AS k FROM typed")
def category_code_cast(spark, sf):
    coded = readings(spark, sf).select("event_id", F.concat("k", F.lit(".0")).alias("k"))
    return category_codes(coded, ["k"])


@query("SELECT o_orderkey, o_totalprice AS price FROM orders")
def currency(spark, sf):
    priced = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("$"), F.format_string("%.2f", "o_totalprice")).alias("price")
    )
    return clean_currency(priced, "price")


@query(
    f"WITH {TYPED_SQL} SELECT event_id, CASE WHEN value IS NOT NULL THEN least(greatest(value, 0), 100) END AS value, "
    "CASE WHEN k IS NOT NULL THEN greatest(k, 10) END AS k FROM typed"
)
def clip_to_constants(spark, sf):
    df = typed(spark, sf).select("event_id", "value", "k")
    return clip_constants(clip_constants(df, "value", 0, 100), "k", 10, None)


@query(
    f"WITH {TYPED_SQL} SELECT event_id, value, user_id, k, event_type FROM typed "
    "WHERE value IS NOT NULL AND user_id IS NOT NULL AND k IS NOT NULL AND event_type IS NOT NULL"
)
def drop_any_null_rows(spark, sf):
    return drop_any_null(typed(spark, sf).drop("ts"))


@query(
    f"WITH {TYPED_SQL} SELECT event_id, value, user_id, k, event_type FROM typed "
    "WHERE 1 + (value IS NOT NULL)::INT + (user_id IS NOT NULL)::INT + (k IS NOT NULL)::INT "
    "+ (event_type IS NOT NULL)::INT >= 4"
)
def drop_null_threshold_rows(spark, sf):
    return drop_null_threshold(typed(spark, sf).drop("ts"), 0.9)


@query(
    f"""WITH {IMPUTED_SQL},
filled AS (SELECT event_id, value, user_id, k, coalesce(event_type, {mode_sql("event_type", "typed")}) AS event_type
  FROM imputed)
SELECT 'drop' AS branch, event_id, value, user_id, k, event_type FROM typed
WHERE value IS NOT NULL AND user_id IS NOT NULL AND k IS NOT NULL AND event_type IS NOT NULL
UNION ALL SELECT 'fill', event_id, value, user_id, k, event_type FROM filled"""
)
def drop_and_fill_versions(spark, sf):
    dropped, filled = split_versions(typed(spark, sf).drop("ts"), NUMBERS, ["k", "event_type"])
    return (
        dropped.withColumn("branch", F.lit("drop")).unionByName(filled.withColumn("branch", F.lit("fill")))
    )


@query(
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O') "
    "AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
)
def valid_categories(spark, sf):
    return filter_valid_categories(
        table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), STATUS
    )


@query(
    """WITH f AS (SELECT o_orderstatus IN ('F', 'O') AS a, o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS b
  FROM orders)
SELECT 'o_orderstatus' AS "column", count(*) FILTER (NOT a) AS removed FROM f
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (a AND NOT b) FROM f
UNION ALL SELECT 'total', count(*) FILTER (NOT (a AND b)) FROM f"""
)
def valid_category_counts(spark, sf):
    return valid_category_report(table(spark, sf, "orders"), STATUS)


@query(f"WITH {IMPUTED_SQL} SELECT event_id, value, user_id, k FROM imputed")
def impute_median_mode(spark, sf):
    df = typed(spark, sf).drop("ts", "event_type")
    return MissingValueImputer(NUMBERS, ["k"]).fit(df).transform(df)


@query(
    f"WITH {TYPED_SQL} SELECT event_id, value, user_id, k FROM typed "
    "WHERE value IS NOT NULL AND user_id IS NOT NULL AND k IS NOT NULL"
)
def impute_drop(spark, sf):
    df = typed(spark, sf).drop("ts", "event_type")
    return MissingValueImputer(NUMBERS, ["k"], "drop").fit(df).transform(df)


@query(
    f"""WITH {TYPED_SQL} SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM typed)) AS value,
coalesce(event_type, {mode_sql("event_type", "typed")}) AS event_type FROM typed"""
)
def fill_legacy(spark, sf):
    df = typed(spark, sf).select("event_id", "value", "event_type")
    return fill_categorical_with_mode(fill_continuous_with_median(df, ["value"]), ["event_type"])


def _bounds_sql(columns, source, k):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(q1 - {k} * (q3 - q1), 4) AS lower, round(q3 + {k} * (q3 - q1), 4) AS upper
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source})"""
        for c in columns
    )


@query(_bounds_sql(MEASURES, "lineitem", "7.0"))
def iqr_bounds_table(spark, sf):
    bounds = iqr_bounds(table(spark, sf, "lineitem"), MEASURES)
    return rounded(
        spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in bounds.items()], "column string, lower double, upper double")
    )


LIMITS_SQL = (
    TYPED_SQL
    + """,
q AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3,
  quantile_cont(user_id, 0.25) AS b1, quantile_cont(user_id, 0.75) AS b3 FROM typed),
limits AS (SELECT a1 - 1.5 * (a3 - a1) AS alo, a3 + 1.5 * (a3 - a1) AS ahi,
  b1 - 1.5 * (b3 - b1) AS blo, b3 + 1.5 * (b3 - b1) AS bhi FROM q)"""
)


@query(
    f"WITH {LIMITS_SQL} SELECT event_id, value, user_id FROM typed, limits "
    "WHERE value BETWEEN alo AND ahi AND user_id BETWEEN blo AND bhi"
)
def iqr_remove(spark, sf):
    df = typed(spark, sf).select("event_id", *NUMBERS)
    return OutlierRemover(NUMBERS, 1.5).fit(df).transform(df)


@query(
    f"""WITH {LIMITS_SQL}, k AS (SELECT count(*) AS n,
  count(*) FILTER (value BETWEEN alo AND ahi AND user_id BETWEEN blo AND bhi) AS kept FROM typed, limits)
SELECT n AS rows_before, kept AS rows_after, n - kept AS removed, round((n - kept) * 100.0 / n, 2)::DOUBLE AS removed_percent FROM k"""
)
def iqr_remove_counts(spark, sf):
    df = typed(spark, sf).select(*NUMBERS)
    return OutlierRemover(NUMBERS, 1.5).fit(df).report(df)


@query(
    f"""WITH {LIMITS_SQL} SELECT event_id,
round(CASE WHEN value IS NOT NULL THEN least(greatest(value, alo), ahi) END, 4) AS value,
round(CASE WHEN user_id IS NOT NULL THEN least(greatest(user_id, blo), bhi) END, 4) AS user_id FROM typed, limits"""
)
def iqr_clip(spark, sf):
    df = typed(spark, sf).select("event_id", *NUMBERS)
    return rounded(OutlierRemover(NUMBERS, 1.5, "clip").fit(df).transform(df))


@query(
    f"""WITH {LIMITS_SQL}
SELECT 'value' AS "column", count(*) FILTER (value < alo OR value > ahi) AS clipped FROM typed, limits
UNION ALL SELECT 'user_id', count(*) FILTER (user_id < blo OR user_id > bhi) FROM typed, limits"""
)
def iqr_clip_counts(spark, sf):
    df = typed(spark, sf).select(*NUMBERS)
    return OutlierRemover(NUMBERS, 1.5, "clip").fit(df).report(df)


SEQUENTIAL_SQL = (
    TYPED_SQL
    + """,
l1 AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM typed)),
s1 AS (SELECT t.* FROM typed t, l1 WHERE value BETWEEN lo AND hi),
l2 AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont(user_id, 0.25) AS q1, quantile_cont(user_id, 0.75) AS q3 FROM s1)),
s2 AS (SELECT s1.* FROM s1, l2 WHERE user_id BETWEEN lo AND hi),
l3 AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont(k, 0.25) AS q1, quantile_cont(k, 0.75) AS q3 FROM s2)),
s3 AS (SELECT s2.* FROM s2, l3 WHERE k BETWEEN lo AND hi)"""
)


@query(f"WITH {SEQUENTIAL_SQL} SELECT event_id, value, user_id, k FROM s3")
def iqr_sequential(spark, sf):
    df = typed(spark, sf).select("event_id", "value", "user_id", "k")
    return remove_outliers_sequential(df, ["value", "user_id", "k"])[0]


@query(
    f"""WITH {SEQUENTIAL_SQL}
SELECT 'value' AS "column", count(*) FILTER (value < lo OR value > hi) AS outliers FROM typed, l1
UNION ALL SELECT 'user_id', count(*) FILTER (user_id < lo OR user_id > hi) FROM s1, l2
UNION ALL SELECT 'k', count(*) FILTER (k < lo OR k > hi) FROM s2, l3"""
)
def iqr_sequential_counts(spark, sf):
    df = typed(spark, sf).select("value", "user_id", "k")
    bounds = remove_outliers_sequential(df, ["value", "user_id", "k"])[1]
    return sequential_report(df, bounds).drop("step_no")


RARE_SQL = (
    TYPED_SQL
    + f""",
valid AS (SELECT k FROM typed WHERE k IS NOT NULL GROUP BY k
  HAVING count(*) >= 0.01 * (SELECT count(k) FROM typed)),
top AS (SELECT {mode_sql("k", "typed")} AS k)"""
)


@query(
    f"WITH {RARE_SQL} SELECT event_id, CASE WHEN k IN (SELECT k FROM valid) THEN k ELSE (SELECT k FROM top) END AS k FROM typed"
)
def rare_to_mode(spark, sf):
    df = typed(spark, sf).select("event_id", "k")
    return CategoricalCleaner(["k"]).fit(df).transform(df)


@query(
    f"""WITH {RARE_SQL} SELECT 'k' AS "column", count(*) FILTER (k IS NULL OR k NOT IN (SELECT k FROM valid)) AS replaced FROM typed"""
)
def rare_replaced_counts(spark, sf):
    df = typed(spark, sf).select("k")
    return CategoricalCleaner(["k"]).fit(df).replaced_report(df)


@query("SELECT 'l_orderkey' AS \"column\", count(*) FILTER (l_orderkey % 3 = 0) AS replaced FROM lineitem")
def replaced_wide_counts(spark, sf):
    """A domain of two thirds of all order keys with a threshold of 0; the others are replaced."""
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    model = CategoricalCleaner(["l_orderkey"], 0.0).fit(lines.filter("l_orderkey % 3 <> 0"))
    return model.replaced_report(lines)


@query(f"WITH {RARE_SQL} SELECT DISTINCT k FROM typed WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM valid)")
def unseen_categories(spark, sf):
    df = typed(spark, sf).select("k")
    return CategoricalCleaner(["k"]).fit(df).unseen(df, "k")


@query("SELECT DISTINCT user_id, event_type, value FROM events")
def dedup(spark, sf):
    return DuplicateRemover().transform(table(spark, sf, "events").select("user_id", "event_type", "value"))


@query(
    """WITH d AS (SELECT DISTINCT user_id, event_type, value FROM events)
SELECT (SELECT count(*) FROM events) AS rows, (SELECT count(*) FROM d) AS distinct_rows,
  (SELECT count(*) FROM events) - (SELECT count(*) FROM d) AS duplicates"""
)
def duplicate_count(spark, sf):
    return duplicate_report(table(spark, sf, "events").select("user_id", "event_type", "value"))


TRAIN_SQL = (
    IMPUTED_SQL
    + f""",
b AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3,
  quantile_cont(user_id, 0.25) AS b1, quantile_cont(user_id, 0.75) AS b3 FROM imputed),
kept AS (SELECT i.* FROM imputed i, b WHERE value BETWEEN a1 - 7 * (a3 - a1) AND a3 + 7 * (a3 - a1)
  AND user_id BETWEEN b1 - 7 * (b3 - b1) AND b3 + 7 * (b3 - b1)),
kvalid AS (SELECT k FROM kept GROUP BY k HAVING count(*) >= 0.01 * (SELECT count(k) FROM kept)),
ktop AS (SELECT {mode_sql("k", "kept")} AS k),
trained AS (SELECT DISTINCT value, user_id,
    CASE WHEN k IN (SELECT k FROM kvalid) THEN k ELSE (SELECT k FROM ktop) END AS k, event_type FROM kept)"""
)


def cleaned_for_training(spark, sf):
    df = readings(spark, sf).drop("event_id", "ts")
    return training_cleaner(NUMBERS, ["k"], ["event_type"]).fit(df).transform(df)


@query(f"WITH {TRAIN_SQL} SELECT value, user_id, k FROM trained")
def train_clean(spark, sf):
    return cleaned_for_training(spark, sf)


@query(f"WITH {TRAIN_SQL} SELECT k, count(*) AS n, round(avg(value), 4) AS mean_value FROM trained GROUP BY k")
def cleaned_by_category(spark, sf):
    """Scan, coerce, impute, remove outliers, rare to mode, dedup, then group."""
    return rounded(
        cleaned_for_training(spark, sf)
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    )


SCORE_SQL = (
    IMPUTED_SQL
    + f""",
svalid AS (SELECT k FROM imputed GROUP BY k HAVING count(*) >= 0.01 * (SELECT count(k) FROM imputed)),
stop AS (SELECT {mode_sql("k", "imputed")} AS k),
sb AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3,
  quantile_cont(user_id, 0.25) AS b1, quantile_cont(user_id, 0.75) AS b3 FROM imputed)"""
)
SCORED_K = "CASE WHEN k IN (SELECT k FROM svalid) THEN k ELSE (SELECT k FROM stop) END AS k"


@query(
    f"""WITH {SCORE_SQL} SELECT event_id,
round(least(greatest(value, a1 - 7 * (a3 - a1)), a3 + 7 * (a3 - a1)), 4) AS value,
round(least(greatest(user_id, b1 - 7 * (b3 - b1)), b3 + 7 * (b3 - b1)), 4) AS user_id, {SCORED_K} FROM imputed, sb"""
)
def score_clean_clip(spark, sf):
    df = readings(spark, sf).drop("ts", "event_type")
    return rounded(scoring_cleaner(NUMBERS, ["k"], "clip").fit(df).transform(df))


@query(f"WITH {SCORE_SQL} SELECT event_id, value, user_id, {SCORED_K} FROM imputed")
def score_clean_none(spark, sf):
    df = readings(spark, sf).drop("ts", "event_type")
    return scoring_cleaner(NUMBERS, ["k"]).fit(df).transform(df)


@query(
    f"""WITH {SCORE_SQL},
kept AS (SELECT imputed.* FROM imputed, sb WHERE value BETWEEN a1 - 7 * (a3 - a1) AND a3 + 7 * (a3 - a1)
  AND user_id BETWEEN b1 - 7 * (b3 - b1) AND b3 + 7 * (b3 - b1)),
kvalid AS (SELECT k FROM kept GROUP BY k HAVING count(*) >= 0.01 * (SELECT count(k) FROM kept))
SELECT event_id, value, user_id, CASE WHEN k IN (SELECT k FROM kvalid) THEN k ELSE {mode_sql("k", "kept")} END AS k FROM kept"""
)
def score_clean_remove(spark, sf):
    """Removal asked for: categories are learned from the rows that stay."""
    df = readings(spark, sf).drop("ts", "event_type")
    return scoring_cleaner(NUMBERS, ["k"], "remove").fit(df).transform(df)


@query(
    """SELECT 1 AS step_no, 'priced' AS step, count(*) AS rows_before, count(*) FILTER (o_totalprice > 100000) AS rows_after FROM orders
UNION ALL SELECT 2, 'urgent', count(*) FILTER (o_totalprice > 100000),
  count(*) FILTER (o_totalprice > 100000 AND o_orderpriority = '1-URGENT') FROM orders"""
)
def audit_step_counts(spark, sf):
    steps = {"priced": F.col("o_totalprice") > 100000, "urgent": F.col("o_orderpriority") == "1-URGENT"}
    return audit_counts(table(spark, sf, "orders"), steps)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def sort_topk(spark, sf):
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey")
        .limit(10)
    )


@query(f"WITH {READINGS_SQL} SELECT DISTINCT event_type FROM readings WHERE event_type IS NOT NULL ORDER BY event_type")
def sorted_distinct_values(spark, sf):
    return sorted_distinct(readings(spark, sf), "event_type")


@query(
    "SELECT o_orderkey, 'urgent' AS part FROM orders WHERE o_orderpriority = '1-URGENT' "
    "UNION ALL SELECT o_orderkey, 'rest' FROM orders WHERE o_orderpriority <> '1-URGENT'"
)
def union_all(spark, sf):
    orders = table(spark, sf, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return (
        orders.filter(urgent)
        .select("o_orderkey", F.lit("urgent").alias("part"))
        .unionByName(orders.filter(~urgent).select("o_orderkey", F.lit("rest").alias("part")))
    )


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def category_difference_values(spark, sf):
    return category_difference(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query(
    f"""WITH {READINGS_SQL}, f AS (SELECT event_type, count(*) AS n FROM readings WHERE event_type IS NOT NULL GROUP BY 1)
SELECT event_type, n AS "count", round(n / (SELECT sum(n) FROM f), 4) AS share FROM f"""
)
def category_freq(spark, sf):
    return rounded(category_frequencies(readings(spark, sf), "event_type"))
