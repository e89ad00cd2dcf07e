"""Foreign keys between the tables of a snapshot."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.merge import KeyMap, MergeSpec
from reknit.operators.rows import Snapshot


@dataclass(frozen=True)
class ForeignKey:
    """A column whose values, NULL aside, are ids of a parent table."""

    child: str
    key: str
    parent: str
    id: str


def dangling(snapshot: Snapshot, references: Iterable[ForeignKey],
             gone: DataFrame | None = None) -> DataFrame:
    """(child, key, parent, value, rows) for every value that has no parent, in one plan.

    Values are counted before they meet the parents, with map-side combining, so a value that
    many rows hold is one row of the anti join. With ``gone``, ids (column ``id``) that have
    just been removed, only these are looked for. References of absent tables are left out.
    """
    found = []
    for key in references:
        if key.child not in snapshot or key.parent not in snapshot:
            continue
        held = snapshot[key.child].filter(F.col(key.key).isNotNull()).select(
            F.col(key.key).alias("value"))
        if gone is not None:
            held = held.join(gone.select(F.col("id").alias("value")), "value", "left_semi")
        values = held.groupBy("value").agg(F.count("*").alias("rows"))
        parents = snapshot[key.parent].select(F.col(key.id).alias("value"))
        found.append(values.join(parents, "value", "left_anti").select(
            F.lit(key.child).alias("child"), F.lit(key.key).alias("key"),
            F.lit(key.parent).alias("parent"), F.col("value").cast("string").alias("value"),
            "rows"))
    if not found:
        session = next(iter(snapshot.values())).sparkSession
        return session.createDataFrame(
            [], "child string, key string, parent string, value string, rows long")
    return reduce(DataFrame.unionByName, found)


def references_of(spec: MergeSpec) -> list[ForeignKey]:
    """The foreign keys that a merge knows of."""
    return [ForeignKey(rule.table, rule.key, spec.table, spec.id)
            for rule in [*spec.keys, *spec.links]]


def left_behind(snapshot: Snapshot, references: Iterable[ForeignKey], spec: MergeSpec,
                keymap: KeyMap) -> DataFrame:
    """What still refers to entities that a merge has removed, for tables it does not list."""
    return dangling(snapshot, [key for key in references if key.parent == spec.table],
                    keymap.old_ids())
