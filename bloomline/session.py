"""Session defaults for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    n = 8 if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bloomline")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bloomline-"))
        .config("spark.ui.enabled", "false")
        # Candidate models are fitted at the same time, each in a pool of its own.
        .config("spark.scheduler.mode", "FAIR")
        # Call-site capture doubles the cost of building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_given: dict[str, str] = {}


def use_shared_dir(spark: SparkSession, path: str) -> None:
    """Name the shared folder for a session that started without ``spark.checkpoint.dir``."""
    _given.setdefault(spark.sparkContext.applicationId, path)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``, or the one given to ``use_shared_dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _given.get(spark.sparkContext.applicationId)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/bloomline/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame used several times to the shared folder and read it back.

    The written table cuts the lineage, outlives lost executors, and gives the
    planner its real size for the choice of later joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage here."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
