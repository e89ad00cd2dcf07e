"""Seeding rows that name other rows by natural keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.joins import lookup
from reknit.operators.keys import allocate_ids
from reknit.operators.rows import Snapshot, append


@dataclass(frozen=True)
class Reference:
    """An id column found in ``table`` by matching seed columns with its natural key."""

    out: str
    table: str
    on: Sequence[tuple]
    value: str


@dataclass(frozen=True)
class Seed:
    """Rows for a table; ``order`` is the order in which ids are given, when ``id`` is."""

    table: str
    rows: DataFrame
    references: Sequence[Reference] = field(default_factory=tuple)
    id: str | None = None
    order: Sequence[str] = field(default_factory=tuple)


def resolve(rows: DataFrame, snapshot: Snapshot, references: Sequence[Reference]) -> DataFrame:
    """Add the referenced ids; a name that is not found gives NULL."""
    for reference in references:
        rows = lookup(rows, snapshot[reference.table], reference.on, reference.value,
                      reference.out)
    return rows


def unresolved(rows: DataFrame, snapshot: Snapshot, references: Sequence[Reference]) -> DataFrame:
    """The rows with a name that no row of the referenced table bears; NULL counts as one."""
    resolved = resolve(rows, snapshot, references)
    lost = F.lit(False)
    for reference in references:
        lost = lost | F.col(reference.out).isNull()
    return resolved.filter(lost)


def require_resolved(rows: DataFrame, snapshot: Snapshot, references: Sequence[Reference],
                     table: str) -> None:
    """Raise where a name that is given is borne by no row of the referenced table."""
    resolved = resolve(rows, snapshot, references)
    lost = {}
    for reference in references:
        given = F.lit(True)
        for named, _ in reference.on:
            named = F.col(named) if isinstance(named, str) else named
            given = given & named.isNotNull()
        lost[reference.out] = given & F.col(reference.out).isNull()
    if not lost:
        return
    # All references are counted in one pass; rows are looked up only where some are lost.
    counts = resolved.agg(*(F.count_if(condition).alias(out)
                            for out, condition in lost.items())).first()
    for out, condition in lost.items():
        if counts[out]:
            raise ValueError(f"{table}: no {out} for " + "; ".join(
                map(str, resolved.filter(condition).take(3))))


def seed_metadata(snapshot: Snapshot, seeds: Sequence[Seed], strict: bool = False) -> Snapshot:
    """Add seed rows table by table; later seeds may refer to rows added by earlier ones.

    A name that is not found gives NULL, or with ``strict`` is an error.
    """
    snapshot = dict(snapshot)
    for seed in seeds:
        target = snapshot[seed.table]
        if strict:
            require_resolved(seed.rows, snapshot, seed.references, seed.table)
        rows = resolve(seed.rows, snapshot, seed.references)
        rows = rows.select(*[name for name in target.columns if name in rows.columns])
        if seed.id is not None:
            order = list(seed.order) or [name for name in rows.columns if name != seed.id]
            rows = allocate_ids(rows, target, seed.id, order)
        snapshot[seed.table] = append(target, rows)
    return snapshot


def grants(rows: DataFrame, modules: DataFrame) -> DataFrame:
    """(role, action, filter, module, object) rights; modules may be given by code.

    ``rows`` has id_role, id_action, id_filter, id_module, module_code and id_object; where
    id_module is NULL the code is looked up.
    """
    found = lookup(rows, modules, "module_code", "id_module", "__module")
    return found.select("id_role", "id_action", "id_filter",
                        F.coalesce("id_module", "__module").alias("id_module"), "id_object")
