"""Imports that run in steps and go on where they were stopped."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reknit.operators.keys import number_rows
from reknit.operators.quality import import_step
from reknit.session import hadoop_path

log = logging.getLogger(__name__)

# The column that deals pending rows to steps.
STEP = "__step"


def finished_steps(spark: SparkSession, root: str) -> set[int]:
    """The steps of an import that are done."""
    files, folder = hadoop_path(spark, f"{root}/finished")
    if not files.exists(folder):
        return set()
    return {int(status.getPath().getName()) for status in files.listStatus(folder)}


def run_import(spark: SparkSession, source: DataFrame, order: Sequence[str],
               work: Callable[[DataFrame], DataFrame], root: str, size: int | None = None,
               unique: bool = False) -> DataFrame:
    """The rows that ``work`` makes of the source, step by step in ``order``.

    On the first run the pending rows are dealt to steps of the size that suits their number
    (or ``size``) and written below ``root``, where later runs find them. A step is finished
    when its rows are written: then its mark appears. A run that is stopped leaves its finished
    steps, and the next one does the others once; rows of an unfinished step are written anew.
    """
    root = root.rstrip("/")
    files, pending = hadoop_path(spark, f"{root}/pending")
    _, written = hadoop_path(spark, f"{root}/pending/_SUCCESS")
    if not files.exists(written):
        numbered = number_rows(source, order, "__n", unique)
        total = source.count()
        size = size or spark.range(1).select(import_step(F.lit(total))).first()[0]
        numbered.withColumn(STEP, F.floor((F.col("__n") - 1) / size)).drop("__n").write.mode(
            "overwrite").partitionBy(STEP).parquet(pending.toString())
    rows = spark.read.schema(source.schema.add(STEP, "long")).parquet(pending.toString())
    steps = sorted(int(status.getPath().getName().split("=")[1])
                   for status in files.listStatus(pending)
                   if status.getPath().getName().startswith(f"{STEP}="))
    done = finished_steps(spark, root)
    for step in steps:
        if step in done:
            log.info("step %d of %d was finished before", step + 1, len(steps))
            continue
        work(rows.filter(F.col(STEP) == step).drop(STEP)).write.mode("overwrite").parquet(
            f"{root}/steps/{step}")
        _, mark = hadoop_path(spark, f"{root}/finished/{step}")
        files.create(mark, True).close()
    if not steps:
        return work(source.limit(0))
    return spark.read.parquet(*(f"{root}/steps/{step}" for step in steps))
