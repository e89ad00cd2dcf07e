"""Appending, deleting and conditional updating of rows."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.session import materialize

log = logging.getLogger(__name__)

Snapshot = dict[str, DataFrame]


@dataclass(frozen=True)
class Rewrite:
    """A table of which only some files are replaced: the files that stay, and the new rows."""

    kept: list[str]
    part: DataFrame


def append(target: DataFrame, new: DataFrame, defaults: Mapping[str, Column] | None = None
           ) -> DataFrame:
    """Append by column name; columns the new rows lack take their default, else NULL."""
    unknown = set(new.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    for name, default in (defaults or {}).items():
        if name not in new.columns:
            new = new.withColumn(name, default)
    types = dict(target.dtypes)
    new = new.select(*[F.col(name).cast(types[name]).alias(name) for name in new.columns])
    return target.unionByName(new, allowMissingColumns=True)


def append_positional(target: DataFrame, new: DataFrame) -> DataFrame:
    """Append by position; the new columns fill the first columns of the target."""
    if len(new.columns) > len(target.columns):
        raise ValueError("more columns than the target has")
    return append(target, new.toDF(*target.columns[: len(new.columns)]))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete the rows where the condition is true; where it is NULL they stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def set_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Conditional update; every right-hand side sees the row as it was before."""
    return df.select(*[
        F.when(condition, values[name]).otherwise(F.col(name)).alias(name)
        if name in values else F.col(name) for name in df.columns])


def relabel(df: DataFrame, key: str, label: str, labels: Mapping) -> DataFrame:
    """Give the rows with the listed keys a new label."""
    if not labels:
        return df
    pairs = [item for key_value in labels.items() for item in map(F.lit, key_value)]
    return df.withColumn(label, F.coalesce(F.create_map(*pairs)[F.col(key)], F.col(label)))


def fill_uuid(df: DataFrame, column: str) -> DataFrame:
    """Give rows without one a random UUID, fixed by writing those rows once."""
    filled = materialize(df.filter(F.col(column).isNull()).withColumn(column, F.expr("uuid()")),
                         "uuid")
    return df.filter(F.col(column).isNotNull()).unionByName(filled)


def repeat_rows(df: DataFrame, times: str, chunk: int = 10_000) -> DataFrame:
    """Each row as often as the column ``times`` says, which is dropped.

    Counts are cut into chunks first, so that no row ever carries a long array.
    """
    last = F.floor((F.col(times) - 1) / chunk)
    chunks = df.filter(F.col(times) > 0).withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    copies = F.least(F.lit(chunk), F.col(times) - F.col("__chunk") * chunk)
    return chunks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop(
        "__copy", "__chunk", times)


def cascade(edges: Iterable[tuple[str, str]], roots: Sequence[str]) -> set[str]:
    """The roots and all tables that refer to them, directly or through others."""
    edges, reached, pending = list(edges), set(roots), list(roots)
    while pending:
        parent = pending.pop()
        for child, referred in edges:
            if referred == parent and child not in reached:
                reached.add(child)
                pending.append(child)
    return reached


def truncate_cascade(snapshot: Snapshot, edges: Iterable[tuple[str, str]], roots: Sequence[str]
                     ) -> Snapshot:
    """Empty the roots and every table with a (child, parent) edge chain to them."""
    emptied = cascade(edges, roots)
    for name in sorted(emptied - set(roots)):
        log.info("truncate cascades to %s", name)
    return {name: table.limit(0) if name in emptied else table
            for name, table in snapshot.items()}
