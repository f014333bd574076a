"""Training-run records and their leaderboard."""

from __future__ import annotations

import time
import traceback
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = (
    "run_id string, run_name string, target string, family string, status string, failure string, "
    "trace string, started_at double, duration_s double, params map<string,string>, metrics map<string,double>, "
    "tags map<string,string>"
)


def flat_params(model_params: dict, best_params: dict | None = None, **extra) -> dict[str, str]:
    """``model__*`` and ``hpo_best__*`` entries plus plain extras; only scalar values are recorded."""
    out = {f"model__{k}": v for k, v in model_params.items()}
    out.update({f"hpo_best__{k}": v for k, v in (best_params or {}).items()})
    out.update(extra)
    return {k: str(v) for k, v in out.items() if v is None or isinstance(v, (int, float, str, bool))}


def log_run(
    spark: SparkSession,
    path: str,
    *,
    run_name: str,
    target: str,
    family: str,
    params: dict[str, str],
    metrics: dict[str, float] | None = None,
    tags: dict[str, str] | None = None,
    started_at: float | None = None,
    duration_s: float | None = None,
    failure: BaseException | None = None,
) -> str:
    """Append one run to the runs table and return its id."""
    now = time.time()
    started = now if started_at is None else started_at
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        run_name,
        target,
        family,
        "error" if failure else "finished",
        str(failure) if failure else None,
        "".join(traceback.format_exception(failure)) if failure else None,
        started,
        now - started if duration_s is None else duration_s,
        params,
        metrics or {},
        {"target": target, **(tags or {})},
    )
    spark.createDataFrame([row], RUNS_SCHEMA).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def run_metrics(runs: DataFrame) -> DataFrame:
    """Finished runs with their metrics as columns."""
    return runs.filter("status = 'finished'").select(
        "run_id", "run_name", "target", "family", "duration_s",
        *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in ("mae", "rmse", "r2")],
    )


def leaderboard(runs: DataFrame) -> DataFrame:
    """Mean metrics and duration by target and family, with the best and worst run by MAE.

    ``runs`` has ``run_id, target, family, mae, rmse, r2, duration_s``. Ties go to the smaller id.
    """
    return runs.groupBy("target", "family").agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("mae").alias("mae"),
        F.avg("rmse").alias("rmse"),
        F.avg("r2").alias("r2"),
        F.avg("duration_s").alias("duration_s"),
        F.min_by("run_id", F.struct("mae", "run_id")).alias("best_run"),
        F.min_by("run_id", F.struct((-F.col("mae")).alias("m"), "run_id")).alias("worst_run"),
    )
