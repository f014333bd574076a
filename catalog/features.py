"""Splits, encoding, scaling and principal components."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import rounded, table
from plumbtable.operators.encode import FeatureEncoder, category_positions, sparse_one_hot
from plumbtable.operators.reduce import principal_components
from plumbtable.operators.split import train_test_split, with_folds
from plumbtable.plans.features import prepare_features

RANKED_SQL = """
ranked AS (SELECT *, row_number() OVER (ORDER BY substr(md5(concat('42|', length({k}::VARCHAR), ':', {k}::VARCHAR)), 1, 13), {k}::VARCHAR) AS rn,
  count(*) OVER () AS n FROM {t})"""


def ranked_sql(key, source):
    return RANKED_SQL.format(k=key, t=source)


@query(
    f"""WITH {ranked_sql("o_orderkey", "orders")}
SELECT o_orderkey, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS side FROM ranked"""
)
def split_rows(spark, sf):
    train, test = train_test_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(
    f"""WITH {ranked_sql("event_id", "events")}
SELECT event_type, count(*) FILTER (rn <= ceil(0.2 * n)) AS test_rows, count(*) FILTER (rn > ceil(0.2 * n)) AS train_rows
FROM ranked GROUP BY event_type"""
)
def split_counts(spark, sf):
    train, test = train_test_split(table(spark, sf, "events").select("event_id", "event_type"), ["event_id"])
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.groupBy("event_type").agg(
        F.count_if("is_test").alias("test_rows"), F.count_if(~F.col("is_test")).alias("train_rows")
    )


@query(
    f"""WITH {ranked_sql("c_custkey", "customer")}
SELECT c_custkey, CAST(CASE WHEN rn <= ceil(0.2 * n) THEN 0 WHEN rn <= ceil(0.4 * n) THEN 1 WHEN rn <= ceil(0.6 * n) THEN 2
  WHEN rn <= ceil(0.8 * n) THEN 3 ELSE 4 END AS INTEGER) AS fold FROM ranked"""
)
def fold_rows(spark, sf):
    return with_folds(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"], 5)


def _scaled(c, source):
    return f"({c} - (SELECT min({c}) FROM {source})) / ((SELECT max({c}) FROM {source}) - (SELECT min({c}) FROM {source}))"


@query(
    f"""SELECT p_partkey, round({_scaled("p_size::DOUBLE", "part")}, 6) AS p_size,
round({_scaled("p_retailprice", "part")}, 6) AS p_retailprice FROM part"""
)
def minmax_scale(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(FeatureEncoder(["p_size", "p_retailprice"]).fit(df).transform(df), 6)


def _hot(c, values):
    return ", ".join(f"CAST({c} = '{v}' AS INT)::DOUBLE AS {c}_{v}" for v in values)


SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TYPES = ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(f"SELECT c_custkey, {_hot('c_mktsegment', SEGMENTS)} FROM customer")
def one_hot(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return FeatureEncoder([], ["c_mktsegment"]).fit(df).transform(df)


@query(
    f"""SELECT round({_scaled("p_size::DOUBLE", "part")}, 6) AS p_size, {_hot("p_type", TYPES)}, p_partkey, p_name FROM part"""
)
def encode_scale(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_type")
    return rounded(FeatureEncoder(["p_size"], ["p_type"]).fit(df).transform(df), 6)


PREPARED_SQL = f"""WITH {ranked_sql("p_partkey", "part")},
train AS (SELECT * FROM ranked WHERE rn > ceil(0.2 * n))
SELECT p_partkey, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS side,
  round({_scaled("p_size::DOUBLE", "train")}, 6) AS p_size, {_hot("p_type", TYPES)}, p_retailprice FROM ranked"""


@query(PREPARED_SQL)
def prepared_union(spark, sf):
    """Split, fit on the training rows only, encode both sides, put them together."""
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_retailprice")
    sets = prepare_features(df, ["p_size"], ["p_type"], ["p_retailprice"], keys=["p_partkey"], keep=["p_partkey"])
    both = sets.train.withColumn("side", F.lit("train")).unionByName(sets.test.withColumn("side", F.lit("test")))
    return rounded(both, 6)


OTHER_SQL = f"""WITH early AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
late AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT o_orderkey, round({_scaled("o_totalprice", "early")}, 6) AS o_totalprice, {_hot("o_orderstatus", ["O", "P"])} FROM late"""


@query(OTHER_SQL)
def encode_other_table(spark, sf):
    """Fitted on the early orders, applied to the late ones."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    model = FeatureEncoder(["o_totalprice"], ["o_orderstatus"]).fit(orders.filter(early))
    return rounded(model.transform(orders.filter(~early).drop("o_orderdate")), 6)


@query(
    """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_extendedprice / 1000) AS d,
  covar_samp(l_quantity, l_extendedprice / 1000) AS b FROM lineitem),
e AS (SELECT (a + d) / 2 AS m, sqrt(((a - d) / 2) * ((a - d) / 2) + b * b) AS s FROM c)
SELECT 1 AS component, round((m + s) / (2 * m), 6) AS explained FROM e
UNION ALL SELECT 2, round((m - s) / (2 * m), 6) FROM e"""
)
def pca_variance(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    _, ratios = principal_components(df, ["l_quantity", "price"])
    rows = [(i + 1, float(v)) for i, v in enumerate(ratios)]
    return rounded(spark.createDataFrame(rows, "component int, explained double"), 6)


@query()
def pca_scores(spark, sf):
    """Two components of the embeddings; signs are arbitrary, so absolute scores."""
    dims = len(table(spark, sf, "embeddings").select("embedding").first()[0])
    names = [f"e{i}" for i in range(dims)]
    df = table(spark, sf, "embeddings").select(
        "vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]
    )
    scores, _ = principal_components(df, names, keep=["vec_id"])
    return scores.select("vec_id", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2"))


@query(
    """WITH d AS (SELECT l_orderkey, dense_rank() OVER (ORDER BY l_orderkey) - 1 AS position FROM (SELECT DISTINCT l_orderkey FROM lineitem))
SELECT l.l_orderkey, l.l_linenumber, (SELECT count(*) FROM d) - 1 AS size, nullif(position, 0) - 1 AS place
FROM lineitem l JOIN d USING (l_orderkey)"""
)
def one_hot_wide(spark, sf):
    """Every order key a category: a sparse vector per row, no column per key."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    hot = sparse_one_hot(lines, "l_orderkey", category_positions(lines, "l_orderkey"), "hot")
    return hot.select("l_orderkey", "l_linenumber", F.col("hot.size").alias("size"), F.get("hot.indices", F.lit(0)).alias("place"))


@query(
    f"""SELECT round({_scaled("p_size_", "part_sizes")}, 6) AS "p_type_LARGE", {_hot("p_type", TYPES).replace("p_type_", "p_type__")},
  p_partkey FROM part_sizes""".replace("part_sizes", "(SELECT *, p_size::DOUBLE AS p_size_ FROM part)")
)
def encode_name_clash(spark, sf):
    """A number named like a category's column: both stay, the category's columns give way."""
    df = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("p_type_LARGE"), "p_type")
    return rounded(FeatureEncoder(["p_type_LARGE"], ["p_type"]).fit(df).transform(df), 6)


@query(
    """WITH keyed AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id END AS a, CASE WHEN event_id % 2 = 1 THEN user_id END AS b,
  event_id AS c FROM events),
ranked AS (SELECT *, row_number() OVER (ORDER BY substr(md5(concat('42|', coalesce(length(a::VARCHAR) || ':' || a::VARCHAR, '-'),
  coalesce(length(b::VARCHAR) || ':' || b::VARCHAR, '-'), length(c::VARCHAR), ':', c::VARCHAR)), 1, 13)) AS rn, count(*) OVER () AS n FROM keyed)
SELECT event_id, rn <= ceil(0.2 * n) AS is_test FROM ranked"""
)
def split_null_keys(spark, sf):
    """A key of three columns, two of which are null in turn."""
    even = F.col("event_id") % 2 == 0
    df = table(spark, sf, "events").select(
        "event_id",
        F.when(even, F.col("user_id")).alias("a"),
        F.when(~even, F.col("user_id")).alias("b"),
        F.col("event_id").alias("c"),
    )
    train, test = train_test_split(df, ["a", "b", "c"])
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.select("event_id", "is_test")


@query(
    """WITH c AS (SELECT avg(l_quantity) AS ma, avg(l_extendedprice / 1000) AS md, var_samp(l_quantity) AS a,
  var_samp(l_extendedprice / 1000) AS d, covar_samp(l_quantity, l_extendedprice / 1000) AS b FROM lineitem),
e AS (SELECT *, 0.5 * atan2(2 * b, a - d) AS t FROM c)
SELECT l_orderkey, l_linenumber, round(abs((l_quantity - ma) * cos(t) + (l_extendedprice / 1000 - md) * sin(t)), 4) AS pc1,
  round(abs((l_extendedprice / 1000 - md) * cos(t) - (l_quantity - ma) * sin(t)), 4) AS pc2 FROM lineitem, e"""
)
def pca_pair_scores(spark, sf):
    """Scores of two columns, whose directions have a closed form; signs are arbitrary, so absolute."""
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price")
    )
    scores, _ = principal_components(df, ["l_quantity", "price"], keep=["l_orderkey", "l_linenumber"])
    return scores.select("l_orderkey", "l_linenumber", *[F.round(F.abs(c), 4).alias(c) for c in ("pc1", "pc2")])
