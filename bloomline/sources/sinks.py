"""Parquet sinks: append, reload, replace by key, forecast upsert."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from bloomline.session import materialize

LISTED = 10_000  # most models or years of an upsert that are broadcast; longer lists are joined by shuffle


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_partitions(
    df: DataFrame, path: str, keys: list[str], values: list[tuple] | None = None
) -> None:
    """Delete key values and write the rows of ``df``, in one commit.

    The deleted keys are those present in ``df``, and with ``values`` those too:
    a reload that finds nothing for a key then leaves nothing. Dynamic overwrite
    leaves partitions alone that get no row, so such a key is cleared after it.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    for value in values or []:
        named = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, value)])
        if df.where(named).isEmpty():
            clear_partition(df.sparkSession, path, keys, value)


def clear_partition(spark: SparkSession, path: str, keys: list[str], value: tuple) -> None:
    """Overwrite one partition's folder with a table of no rows."""
    existing = read_if_present(spark, path)
    if existing is None:
        return
    folder = "/".join([path, *[f"{k}={v}" for k, v in zip(keys, value)]])
    if read_if_present(spark, folder) is not None:
        existing.drop(*keys).limit(0).write.mode("overwrite").parquet(folder)


def upsert_cross(
    existing: DataFrame,
    new: DataFrame,
    crossed: tuple[str, str] = ("model_name", "forecast_year"),
    within: tuple[str, ...] = ("model_version", "event_type"),
) -> DataFrame:
    """Existing rows, minus every model x year combination of ``new``, plus ``new``.

    A row leaves when its model and its year both occur in ``new`` under the same
    version and event, whether or not the pair itself does. Each test is an
    equi-join against a distinct list, so the combinations are never built.
    """
    kept = existing
    for i, col in enumerate(crossed):
        listed = materialize(new.select(*within, col).distinct(), "listed").withColumn(f"_hit{i}", F.lit(True))
        # A handful of models and years, each on a large share of the stored rows: sent to all
        # tasks after a look at its length, so that the stored rows are not shuffled on them.
        if listed.limit(LISTED + 1).count() <= LISTED:
            listed = F.broadcast(listed)
        kept = kept.join(listed, on=[*within, col], how="left")
    hit = F.col("_hit0").isNotNull() & F.col("_hit1").isNotNull()
    return kept.where(~hit).select(existing.columns).unionByName(new.select(existing.columns))


def write_forecast(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Upsert into the forecast table, stored by event and version.

    Only the partitions of ``new`` are rewritten, and the swap is one commit: a
    failed run leaves the old rows. The previous rows are read from the same
    partitions, which dynamic overwrite replaces only after the job has ended.
    """
    keys = ["event_type", "model_version"]
    existing = read_if_present(spark, path)
    if existing is not None:
        touched = new.select(*keys).distinct()
        same = existing.join(touched, on=keys, how="left_semi").select(new.columns)
        new = upsert_cross(same, new)
    replace_partitions(new, path, keys)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists. Of several writers one succeeds."""
    jvm = spark._jvm.org.apache.hadoop.fs
    file = jvm.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        system.create(file, False).close()
    except Py4JJavaError:
        if system.exists(file):
            return False
        raise
    return True


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        # A folder without a single file was written from no rows.
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
