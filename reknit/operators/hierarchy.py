"""Parents derived from dotted codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.operators.joins import keep_absent_null_safe, update_from
from reknit.operators.keys import allocate_ids
from reknit.operators.rows import append


def code_prefix(code: str) -> Column:
    """The part before the first dot."""
    return F.split_part(F.col(code), F.lit("."), F.lit(1))


def derive_parents(df: DataFrame, id: str, code: str, by: Sequence[str], moved: str,
                   parent: str) -> DataFrame:
    """Add a parent row per distinct (by…, code prefix, moved attribute) of the dotted codes.

    Ids follow (by…, prefix). Rows that have a parent ask for none, and parents that exist
    already, with the same moved attribute, are not added again; NULLs count as equal there.
    """
    alone = df.filter(F.col(parent).isNull())
    dotted = alone.filter(F.col(code).like("%.%"))
    parents = dotted.select(*by, code_prefix(code).alias(code), moved).distinct()
    parents = keep_absent_null_safe(parents, alone.filter(~F.col(code).contains(".")),
                                    [*by, code, moved])
    return append(df, allocate_ids(parents, df, id, [*by, code, moved], unique=True))


def link_parents(df: DataFrame, id: str, code: str, by: Sequence[str], moved: str,
                 parent: str) -> DataFrame:
    """Point dotted codes to the row of their prefix and clear the attribute it took over.

    When several parents fit, the one with the smallest id is taken.
    """
    parents = df.filter(F.col(parent).isNull()).select(*by, F.col(code).alias("__code"),
                                                       F.col(id).alias("__id"))
    parents = parents.groupBy(*by, "__code").agg(F.min("__id").alias("__id"))
    return update_from(
        df, parents, [*by, (code_prefix(code), "__code")],
        {parent: F.col("source.__id"), moved: F.lit(None)},
        where=F.col(f"target.{code}").like("%.%"), unique=True)
