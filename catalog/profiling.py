"""Table profiles and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import READINGS_SQL, TYPED_SQL, readings, rounded, table, typed
from plumbtable.operators import profile as P
from plumbtable.operators.convert import detect_roles

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
READING_COLUMNS = ["event_id", "value", "user_id", "k", "event_type"]


def _union(parts):
    return " UNION ALL ".join(parts)


@query(
    f"WITH {TYPED_SQL} SELECT * FROM ("
    + _union(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count, count(*) AS total_rows,
round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS null_percent FROM typed"""
        for c in READING_COLUMNS
    )
    + ')'
)
def null_table(spark, sf):
    return P.null_table(typed(spark, sf).drop("ts"))


@query(
    f"WITH {READINGS_SQL} "
    + _union(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NOT NULL AND NOT regexp_full_match(trim({c}), '-?\\d+(\\.\\d+)?'))
AS invalid_count, count(*) AS total_rows, round(count(*) FILTER ({c} IS NOT NULL AND
NOT regexp_full_match(trim({c}), '-?\\d+(\\.\\d+)?')) * 100.0 / count(*), 2)::DOUBLE AS invalid_percent FROM readings"""
        for c in ("value", "user_id", "k", "event_type")
    )
)
def invalid_entries(spark, sf):
    df = readings(spark, sf)
    return P.invalid_entries(df, df.columns)


def _profile_sql(columns):
    shown = {"bigint": "CAST({c} AS VARCHAR)", "double": "printf('%.4f', {c})", "string": "{c}"}
    parts = []
    for c, t in columns:
        text = shown[t].format(c=c)
        parts.append(
            f"""SELECT '{c}' AS "column", '{t}' AS dtype, (SELECT count(DISTINCT {c}) FROM typed) AS distinct_count,
(SELECT count(*) - count({c}) FROM typed) AS null_count,
(SELECT string_agg({text}, '; ' ORDER BY {c}) FROM
  (SELECT DISTINCT {c} FROM typed WHERE {c} IS NOT NULL ORDER BY {c} LIMIT 10)) AS examples"""
        )
    return f"WITH {TYPED_SQL} " + _union(parts)


@query(
    _profile_sql(
        [("event_id", "bigint"), ("value", "double"), ("user_id", "double"), ("k", "double"), ("event_type", "string")]
    )
)
def column_profile(spark, sf):
    return P.column_profile(typed(spark, sf).drop("ts"))


@query(
    _union(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max, round(skewness({c}), 4) AS skewness,
round(kurtosis({c}), 4) AS kurtosis FROM lineitem"""
        for c in MEASURES
    )
)
def describe_full(spark, sf):
    return rounded(P.describe(table(spark, sf, "lineitem"), MEASURES))


@query(
    _union(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", count(DISTINCT {c}) AS "unique",
(SELECT {c} FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
(SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY {c})) AS freq FROM orders"""
        for c in ("o_orderstatus", "o_orderpriority")
    )
)
def describe_text(spark, sf):
    return P.describe_text(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    _union(f"""SELECT '{c}' AS "column", min({c}) AS min, max({c}) AS max FROM lineitem""" for c in MEASURES)
)
def min_max(spark, sf):
    return P.min_max(table(spark, sf, "lineitem"), MEASURES)


def _corr(a, b):
    return f"round(corr({a}, {b}), 4)" if a != b else "1.0::DOUBLE"


@query(
    f"WITH {TYPED_SQL} "
    + _union(
        f"SELECT '{a}' AS x, '{b}' AS y, {_corr(a, b)} AS r FROM typed"
        if a != b
        else f"SELECT '{a}' AS x, '{b}' AS y, 1.0::DOUBLE AS r"
        for a in ("value", "user_id", "k")
        for b in ("value", "user_id", "k")
    )
)
def corr_matrix(spark, sf):
    return rounded(P.correlation_matrix(typed(spark, sf), ["value", "user_id", "k"]))


PART_PAIRS = [("p_partkey", "p_retailprice"), ("p_partkey", "p_size"), ("p_retailprice", "p_size")]


@query(
    "SELECT * FROM ("
    + _union(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 4) AS r FROM part" for a, b in PART_PAIRS)
    + ") WHERE abs(r) >= 0.3"
)
def corr_pairs(spark, sf):
    return rounded(P.correlated_pairs(table(spark, sf, "part"), ["p_partkey", "p_size", "p_retailprice"], 0.3))


HISTOGRAM_SQL = """WITH s AS (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}),
h AS (SELECT CAST(least(floor(({c} - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n FROM {t}, s GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 30), 4) AS lower, round(lo + (g.bin + 1) * ((hi - lo) / 30), 4) AS upper,
  coalesce(n, 0) AS "count" FROM g CROSS JOIN s LEFT JOIN h ON h.bin = g.bin"""


@query(HISTOGRAM_SQL.format(c="l_extendedprice", t="lineitem"))
def histogram30(spark, sf):
    return rounded(P.histogram(table(spark, sf, "lineitem"), "l_extendedprice"))


@query(HISTOGRAM_SQL.format(c="value", t="events"))
def histogram_skewed(spark, sf):
    return rounded(P.histogram(table(spark, sf, "events"), "value"))


KDE_SQL = """WITH t AS ({source}), s AS (SELECT count(v) AS n, stddev_samp(v) AS s, min(v) AS lo, max(v) AS hi FROM t),
w AS (SELECT v, count(*) AS w FROM t WHERE v IS NOT NULL GROUP BY 1),
g AS (SELECT range AS point FROM range({grid})),
z AS (SELECT point, w, (lo + point * ((hi - lo) / ({grid} - 1)) - v) / (s * pow(n, -0.2)) AS z FROM w, g, s)
SELECT round(any_value(lo) + point * ((any_value(hi) - any_value(lo)) / ({grid} - 1)), 4) AS x,
  round(sum(w * exp(-0.5 * z * z)) / (any_value(n) * any_value(s) * pow(any_value(n), -0.2) * sqrt(2 * pi())), 6) AS density
FROM z, s GROUP BY point"""


def _curve(df, column, grid=200):
    return P.density(df, column, grid).select(F.round("x", 4).alias("x"), F.round("density", 6).alias("density"))


@query(KDE_SQL.format(source="SELECT value AS v FROM events", grid=200))
def kde_grid(spark, sf):
    return _curve(table(spark, sf, "events"), "value")


@query(KDE_SQL.format(source="SELECT l_quantity AS v FROM lineitem", grid=1000))
def kde_exact(spark, sf):
    """A grid of 1,000 points over a column of many equal values."""
    return _curve(table(spark, sf, "lineitem"), "l_quantity", 1000)


@query(KDE_SQL.format(source="SELECT CASE WHEN event_id = 1 THEN 1e5 ELSE value END AS v FROM events", grid=200))
def kde_far_outlier(spark, sf):
    """One value far from all others: most grid points have no value near."""
    events = table(spark, sf, "events")
    return _curve(events.withColumn("value", F.when(F.col("event_id") == 1, 1e5).otherwise(F.col("value"))), "value")


def _box_sql(c, t):
    return f"""SELECT '{c}' AS "column", round(any_value(q1), 4) AS q25, round(any_value(q2), 4) AS q50, round(any_value(q3), 4) AS q75,
min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
count(*) FILTER ({c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {t})"""


@query(_union(_box_sql(c, "events") for c in ("value", "user_id")))
def box_stats(spark, sf):
    return rounded(P.box_stats(table(spark, sf, "events"), ["value", "user_id"]))


def _bin(c):
    return f"CAST(least(floor(({c} - {c}_lo) / (({c}_hi - {c}_lo) / 30)), 29) AS INTEGER)"


PAIRED = ["l_quantity", "l_extendedprice", "l_tax"]


@query(
    "WITH s AS (SELECT "
    + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in PAIRED)
    + " FROM lineitem) "
    + _union(
        f"""SELECT '{a}' AS x, '{b}' AS y, {_bin(a)} AS bin_x, {_bin(b)} AS bin_y, l_returnflag AS hue, count(*) AS "count"
FROM lineitem, s GROUP BY ALL"""
        for i, a in enumerate(PAIRED)
        for b in PAIRED[i + 1 :]
    )
)
def pair_bins(spark, sf):
    return P.pair_bins(table(spark, sf, "lineitem"), PAIRED, "l_returnflag")


@query(
    _union(
        f"""SELECT '{c}' AS "column", '{r}' AS role, count({c}) AS "count" FROM part"""
        for c, r in (
            ("p_partkey", "numeric"),
            ("p_name", "categorical"),
            ("p_brand", "categorical"),
            ("p_type", "categorical"),
            ("p_size", "numeric"),
        )
    )
)
def role_detection(spark, sf):
    """Detected role and non-null count of every feature, the target left out."""
    part = table(spark, sf, "part")
    numeric, categorical = detect_roles(part, ["p_retailprice"])
    roles = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    rows = [F.struct(F.lit(c).alias("column"), F.lit(r).alias("role"), F.count(c).alias("count")) for c, r in roles]
    return part.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@query(f"WITH {TYPED_SQL} SELECT count(*) AS rows FROM typed")
def row_counts(spark, sf):
    return P.row_count(typed(spark, sf))
