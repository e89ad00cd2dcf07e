"""Delimited lists held in one text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_list(value: Column | str, separator: str = ",") -> Column:
    """An array of the items; the empty text has none, NULL stays NULL."""
    text = F.col(value) if isinstance(value, str) else value
    empty = F.array().cast("array<string>")
    # The limit -1 keeps trailing empty items.
    return F.when(text == "", empty).otherwise(F.split(text, f"\\Q{separator}\\E", -1))


def explode_list(df: DataFrame, value: Column | str, alias: str, separator: str = ",",
                 trim: bool = True) -> DataFrame:
    """One row per item; rows whose list is NULL or empty are lost."""
    text = F.col(value) if isinstance(value, str) else value
    # A column of its own, so that a computed text is computed once.
    rows = df.withColumn("__list", text).withColumn(alias, F.explode(
        split_list("__list", separator))).drop("__list")
    return rows.withColumn(alias, F.trim(alias)) if trim else rows


def explode_together(df: DataFrame, lists: dict[str, Column]) -> DataFrame:
    """Explode arrays side by side; the shorter ones are padded with NULL, NULL counts as empty."""
    sides = [F.coalesce(array, F.array()).alias(name) for name, array in lists.items()]
    return df.select("*", F.inline(F.arrays_zip(*sides)).alias(*lists))
