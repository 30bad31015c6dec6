"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans rely on. Sizes of the cluster are left to whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "repodw", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; where none is set, one in the warehouse folder,
    which every executor reaches as well. Never a machine's own folder, but where the session runs on one machine."""
    return scratch_for(spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)


def scratch_for(named: str | None, warehouse: str, master: str) -> str:
    if named:
        return named.rstrip("/")
    if not master.startswith("local") and (":" not in warehouse or warehouse.startswith("file:")):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder: executors don't share {warehouse}")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that no other run uses."""
    return f"{scratch_root(spark)}/repodw-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "part", path: str | None = None) -> DataFrame:
    """The rows, written once to the shared scratch folder and read from there.

    For a result that several queries read: computed a single time, and safe when executors are lost.
    """
    path = path or scratch_dir(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Python workers get Arrow batches of at most so many rows in what runs inside. Executors and workers keep the memory
    of their largest batch, of whole texts here, for as long as they live."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what `written` wrote inside. What is to stay is read from elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_path(spark, path)


@contextmanager
def written_for_now(df: DataFrame, name: str = "part") -> Iterator[DataFrame]:
    """`written`, with the files deleted at the end of the block."""
    path = scratch_dir(df.sparkSession, name)
    try:
        yield written(df, name, path)
    finally:
        delete_path(df.sparkSession, path)


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop's file system and path object, so that folders are handled on any storage Spark writes to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)
