"""Session helpers: a local session for tests and benches, and the shared folder for durable state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Folders of local sessions without a shared one, by application.
_LOCAL_DIRS: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "plumbtable") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local master without the setting (tests, bench)
    gets a folder of its own; a cluster session without it is refused, since a machine-local
    folder there would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # The setting cannot be changed in a running session, so the folder is kept here.
    name = spark.sparkContext.applicationId
    if name not in _LOCAL_DIRS:
        _LOCAL_DIRS[name] = tempfile.mkdtemp(prefix="plumbtable-")
    return _LOCAL_DIRS[name]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df, label: str):
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
