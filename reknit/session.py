"""Session settings, and the shared folder where lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where intermediate tables lie on the default file system, if no folder is set.
DEFAULT_SCRATCH = "/tmp/reknit-scratch"

# Measured bytes up to which a table is broadcast; beyond it the same join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app_name: str = "reknit", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators count on (AQE with skew splitting, UTC)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the checkpoint folder of the session.

    Where none is set, it is a folder on the default Hadoop file system. Every executor must
    see it, so on a cluster whose default file system is each machine's own, a shared one has
    to be named.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    files, location = hadoop_path(spark, DEFAULT_SCRATCH)
    if files.getScheme() == "file" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return files.makeQualified(location).toString()


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/reknit-{spark.sparkContext.applicationId}"


# Paths of the jobs under way, the innermost last.
_jobs: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the scratch folder."""
    path = f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex}"
    if _jobs:
        _jobs[-1].append(path)
    return path


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside, once the job has published its results."""
    paths: list[str] = []
    _jobs.append(paths)
    try:
        yield
    finally:
        _jobs.remove(paths)
        for path in paths:
            files, location = hadoop_path(spark, path)
            files.delete(location, True)


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds a path, and the path in its terms."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once no result needs them."""
    files, location = hadoop_path(spark, _own_scratch(spark))
    files.delete(location, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back.

    It fixes random values, cuts the lineage and survives the loss of executors. The
    plan runs once, and later reads still prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measure(df: DataFrame) -> int:
    """The bytes of a table's values, computed on the executors; nested ones as their JSON."""
    def width(name: str, kind: str):
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(name), F.lit(0))
        if kind.startswith(("array", "map", "struct", "variant")):
            return F.octet_length(F.to_json(F.struct(name)))
        return F.lit(16 if kind.startswith("decimal") else 8)

    widths = [width(name, kind) for name, kind in df.dtypes]
    total = df.agg(F.sum(sum(widths, F.lit(0)).cast("long")).alias("bytes")).first()
    return total.bytes or 0


def broadcast_if_small(df: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size is under the limit, else leave the join to Spark."""
    return df.hint("broadcast") if size <= limit else df
