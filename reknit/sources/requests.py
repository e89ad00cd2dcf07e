"""Merge requests from files and arguments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reknit.functions.lists import split_list
from reknit.operators.keys import number_rows
from reknit.sources.tables import values


def explode_requests(df: DataFrame, survivor: str = "id", duplicates: str = "id_duplicates",
                     order: tuple[str, ...] = ("line",)) -> DataFrame:
    """One row per old id: the order columns, its position in the list, old_id, new_id.

    A comma at the end of a list adds nothing; an empty item elsewhere is no number and raises.
    """
    listed = split_list(F.regexp_replace(duplicates, ",$", ""))
    return df.filter(F.trim(duplicates) != "").select(
        *order,
        F.col(survivor).cast("long").alias("new_id"),
        F.posexplode(listed).alias("position", "item"),
    ).select(*order, "position", F.trim("item").cast("long").alias("old_id"), "new_id")


def _with_steps(exploded: DataFrame, order: tuple[str, ...]) -> DataFrame:
    return number_rows(exploded, [*order, "position"], "step", unique=True).select(
        "step", "old_id", "new_id")


def read_merge_requests(spark: SparkSession, path: str) -> DataFrame:
    """(step, old_id, new_id) from TAB-separated text with header.

    Column ``id`` is the survivor and ``id_duplicates`` a comma list of old ids; further
    columns are ignored. Steps follow the lines, then the lists. Lines that lack either
    value are skipped; a value that is no number raises.
    """
    lines = (spark.read.csv(path, sep="\t", header=True)
             .select("id", "id_duplicates",
                     F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"))
             .withColumn("line", F.monotonically_increasing_id())
             .filter(F.trim("id") != ""))
    order = ("file", "block", "line")
    return _with_steps(explode_requests(lines, order=order), order)


def merge_requests(spark: SparkSession, pairs: Iterable[tuple[int, str]]) -> DataFrame:
    """(step, old_id, new_id) from (survivor, comma list of old ids) pairs."""
    rows = [(line, str(new), old) for line, (new, old) in enumerate(pairs)]
    lines = values(spark, rows, "line long, id string, id_duplicates string")
    return _with_steps(explode_requests(lines), ("line",))
