"""Inserting only what is missing, and overwriting what is shared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.operators.joins import (
    keep_absent, keep_not_in, lookup, one_per_key, own_shuffle, translate_ids, update_from)
from reknit.operators.keys import allocate_ids
from reknit.operators.rows import append, repeat_rows
from reknit.session import materialize


def _insert(target: DataFrame, new: DataFrame, id: str | None, order: Sequence[str] | None,
            gap: int = 0, unique: bool = False) -> DataFrame:
    new = new.select(*[name for name in target.columns if name in new.columns])
    if id is not None:
        order = order or [name for name in new.columns if name != id]
        # The ids are fixed by writing the new rows, and only these.
        new = materialize(allocate_ids(new, target, id, order, gap, unique), "new")
    return append(target, new)


def insert_missing(target: DataFrame, source: DataFrame, on, null_aware: bool = False,
                   among: Column | None = None, id: str | None = None,
                   order: Sequence[str] | None = None, unique: bool = False,
                   gap: int = 0) -> DataFrame:
    """Add the source rows without a counterpart in the target.

    ``on`` pairs source and target expressions. ``among`` restricts the target rows that
    count as counterparts. With ``null_aware`` one NULL key in the target lets nothing in, as
    NOT IN does. With ``id`` the new rows get fresh ids, in ``order``; ``unique`` says that
    the columns of ``order`` tell the rows apart, ``gap`` skips ids before the first.
    """
    known = target if among is None else target.filter(among)
    new = keep_not_in(source, known, on) if null_aware else keep_absent(source, known, on)
    return _insert(target, new, id, order, gap, unique)


def insert_children(target: DataFrame, children: DataFrame, source_parents: DataFrame,
                    target_parents: DataFrame, parent_id: str, natural_key: str,
                    lookups: Sequence[tuple[DataFrame, Sequence, str, str]] = (),
                    id: str | None = None, order: Sequence[str] | None = None,
                    unique: bool = False, gap: int = 0) -> DataFrame:
    """Add children under the target's parents, found through the parents' natural key.

    Each lookup (dimension, on, value, out) turns codes of the child into an id. Ids are given
    as by ``insert_missing``.
    """
    new = translate_ids(children, source_parents, target_parents, parent_id, natural_key)
    for dimension, on, value, out in lookups:
        new = lookup(new, dimension, on, value, out, measure_first=True)
    return _insert(target, new, id, order, gap, unique)


def overwrite_matched(target: DataFrame, partner: DataFrame, on, values: Mapping[str, Column],
                      id: str) -> DataFrame:
    """Overwrite entities shared with a partner; of several partner rows the smallest id wins."""
    return update_from(target, partner, on, dict(values), order=[id])


def insert_ignore(target: DataFrame, new: DataFrame, *unique: Sequence[str], id: str | None = None,
                  order: Sequence[str] = (), gap: int = 0) -> DataFrame:
    """INSERT … ON CONFLICT DO NOTHING under one or several unique keys.

    Rows go in by ``order``, then by their other columns; a row is left out when its values
    of some key are taken by the target or by a row that went in before. NULLs never conflict.
    """
    keys = [list(columns) for columns in unique]
    for columns in keys:
        if set(columns) <= set(new.columns):
            new = keep_absent(new, target, columns)
    keys = [columns for columns in keys if set(columns) <= set(new.columns)]
    columns_order = [*order, *[name for name in new.columns if name not in order]]
    if not keys:
        # Nothing that the new rows have could conflict.
        accepted = new
    elif len(keys) == 1:
        accepted = _first_of_key(new, keys[0], columns_order)
    else:
        accepted = _first_of_keys(new, keys, columns_order)
    return _insert(target, accepted, id, columns_order, gap)


def _has(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])


def _first_of_key(new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return one_per_key(new.filter(_has(key)), key, order).select(*new.columns).unionByName(
        new.filter(~_has(key)))


def _first_of_keys(new: DataFrame, keys: list[list[str]], order: list[str]) -> DataFrame:
    """The rows a row-by-row insert would accept.

    Each round accepts the rows that come first under all their keys and drops the rows these
    shut out; the rows between wait for the next round. Rounds are spread, one written table
    each, but their number is that of the longest run of rows in which each waits for the one
    before: whether a row goes in is known only when that of every earlier conflicting row is,
    and with several keys no shortcut through such a run is known (it is the first maximal
    independent set in a stated order, a problem that is complete for sequential time). Rows
    that conflict in small groups, as those of re-imported files do, take a few rounds whatever
    their number.
    """
    names = new.columns
    # Identical rows that have a key conflict, so one of them is enough; others stay as counted.
    pending = materialize(new.groupBy(*names).agg(F.count("*").alias("__copies"))
                          .withColumn("__rank", F.struct(*order)), "pending")
    accepted = []
    while not pending.isEmpty():
        rows = pending
        for i, key in enumerate(keys):
            first = (pending.filter(_has(key)).groupBy(*key)
                     .agg(F.min("__rank").alias(f"__first{i}")))
            rows = rows.join(own_shuffle(first, key), key, "left")
        wins = reduce(lambda a, b: a & b, [
            F.col(f"__first{i}").isNull() | (F.col(f"__first{i}") == F.col("__rank"))
            for i in range(len(keys))])
        judged = materialize(rows.select(*names, "__copies", "__rank", wins.alias("__won")),
                             "judged")
        won = judged.filter("__won").drop("__won")
        accepted.append(won)
        pending = judged.filter("NOT __won").drop("__won")
        for key in keys:
            # Of the rows that went in, none shares a key with another.
            pending = keep_absent(pending, won, key, unique=True)
    if not accepted:
        return new.limit(0)
    chosen = reduce(DataFrame.unionByName, accepted)
    keyed = reduce(lambda a, b: a | b, [_has(key) for key in keys])
    copies = F.when(keyed, F.lit(1).cast("long")).otherwise(F.col("__copies"))
    return repeat_rows(chosen.select(*names, copies.alias("__times")), "__times")


def add_to_list(links: DataFrame, members: DataFrame, lists: DataFrame, code: str, member_id: str,
                list_id: str = "id_liste", code_column: str = "code_liste",
                ignore_conflicts: bool = True) -> DataFrame:
    """Put the members into the list with the given code; an unknown code adds nothing."""
    found = lists.filter(F.col(code_column) == code).agg(F.min(list_id)).scalar()
    new = members.select(found.alias(list_id), F.col(member_id)).dropna(subset=[list_id])
    if ignore_conflicts:
        return insert_ignore(links, new, [list_id, member_id])
    return append(links, new)
