import json
import os

import pytest
from conftest import CATEGORICAL, NUMERIC, ids
from pyspark.sql import functions as F

from plumbtable.cli import parser, run
from plumbtable.operators.cleaner import CleaningConfig, DataCleaner
from plumbtable.session import fresh_path
from plumbtable.sources.writers import save_csv

CONFIG = CleaningConfig(NUMERIC, CATEGORICAL, 0.7)


def test_config_is_checked():
    with pytest.raises(ValueError):
        CleaningConfig(NUMERIC, CATEGORICAL, 1.5)
    with pytest.raises(ValueError):
        CleaningConfig([], CATEGORICAL)


def test_chain(mini):
    cleaner = DataCleaner(mini).apply_config(CONFIG)
    assert ids(cleaner.remove_outliers_iqr().get()) == [0, 1, 3, 4, 8]
    chained = (
        cleaner.clean_currency("X4").clip_outliers("X4", 0, 50).fill_continuous_with_median().fill_categorical_with_mode()
    )
    out = chained.filter_valid_categories({"X6": ["A", "B"]}).get()
    assert out.count() == 6 and out.agg(F.max("X4")).first()[0] == 50.0
    assert out.filter("X1 IS NULL OR X3 IS NULL").count() == 0
    coerced = cleaner.coerce_numeric().drop_missing_values().get()
    assert dict(coerced.dtypes)["X6"] == "double"
    dropped, filled = cleaner.split_versions()
    assert dropped.count() == 7 and filled.count() == 9
    with pytest.raises(ValueError, match="apply_config"):
        DataCleaner(mini).coerce_numeric()


def test_commands_end_to_end(spark):
    home = fresh_path(spark, "cli")
    os.makedirs(home)
    raw = spark.range(300).select(
        (F.col("id") % 61).cast("double").alias("x"),
        (F.col("id") % 3).alias("c"),
        (F.col("id") % 61 * 2 + F.col("id") / 1000).alias("y1"),
        (F.col("id") % 61 * 3 + F.col("id") / 1000).alias("y2"),
    )
    save_csv(raw, f"{home}/in.csv")
    with open(f"{home}/config.json", "w") as f:
        json.dump({"model": {"name": "xgboost", "library": "xgboost_sklearn", "params": {"n_estimators": 6}}}, f)

    def call(text):
        run(spark, parser().parse_args(text.format(home=home).split()))

    call("prepare --input {home}/in.csv --workdir {home}/w --numeric x --categorical c --targets y1,y2")
    call("train --config {home}/config.json --workdir {home}/w --targets heating=y1,cooling=y2 --run-name first")
    assert spark.read.json(f"{home}/w/metrics").filter("r2 > 0.9").count() == 2
    assert {r["run_name"] for r in spark.read.parquet(f"{home}/w/runs").collect()} == {"first"}
    call("predict --input {home}/in.csv --workdir {home}/w --output {home}/p")
    assert spark.read.json(f"{home}/p/rows").filter("heating IS NOT NULL").count() == 300
    scored = raw.withColumns({"p1": F.col("y1") + 1, "p2": F.col("y2")})
    scored.write.parquet(f"{home}/ref")
    scored.withColumn("p1", F.col("p1") + 9).write.parquet(f"{home}/cur")
    call("monitor --reference {home}/ref --current {home}/cur --features x,c --targets y1=p1,y2=p2 --output {home}/r")
    assert spark.read.json(f"{home}/r/summary").first()["critical_issues"] >= 1
