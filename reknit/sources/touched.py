"""Changing published tables by rewriting only the files that hold a changed row."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.operators.joins import update_from
from reknit.operators.merge import (
    KeyMap, LinkRule, MergeSpec, drop_entities, merge_fk, merge_links)
from reknit.operators.rows import Rewrite, Snapshot, set_where
from reknit.session import broadcast_if_small, materialize, measure
from reknit.sources.publish import Published

log = logging.getLogger(__name__)

Rewrites = dict[str, Rewrite]


def _named(rows: DataFrame) -> list[str]:
    """Names of the files that rows come from; there are few of them, however many rows."""
    return [row.name for row in rows.select(
        F.col("_metadata.file_name").alias("name")).distinct().collect()]


def files_holding(table: DataFrame, keys: Iterable[str], ids: DataFrame) -> set[str]:
    """Names of the files with a row in which one of ``keys`` is one of ``ids`` (column id).

    Only the key columns are read, and nothing is shuffled but the names.
    """
    found = [table.select(F.col(key).alias("id"), "_metadata").join(ids, "id", "left_semi")
             for key in keys]
    return {name for rows in found for name in _named(rows)}


def files_where(table: DataFrame, condition: Column) -> set[str]:
    """Names of the files with a row for which the condition is true; it is pushed down."""
    return set(_named(table.filter(condition)))


def rewrite(published: Published, name: str, touched: set[str],
            change: Callable[[DataFrame], DataFrame]) -> Rewrite | None:
    """The touched files changed and the others kept; None where no file is touched."""
    if not touched:
        return None
    files = published.files[name]
    inside = [path for path in files if path.rsplit("/", 1)[1] in touched]
    spark = published[name].sparkSession
    part = spark.read.schema(published[name].schema).parquet(
        *(f"{published.root}/{path}" for path in inside))
    log.info("%s: %d of %d files are rewritten", name, len(inside), len(files))
    return Rewrite([path for path in files if path not in set(inside)], change(part))


def merge_touched(published: Published, spec: MergeSpec, keymap: KeyMap
                  ) -> tuple[Snapshot, Rewrites]:
    """A merge of which only files with rows of merged ids are written again.

    Rows of survivors never change and never go, so their files are read, to see what collides
    with them, but stay. The tables of the snapshot show the merged rows as a whole.
    """
    by_table: dict[str, list] = {}
    for rule in [*spec.keys, *spec.links]:
        if rule.table in published:
            by_table.setdefault(rule.table, []).append(rule)
        elif not rule.optional:
            raise KeyError(rule.table)
        else:
            log.info("table %s does not exist, skipped", rule.table)
    by_table.setdefault(spec.table, [])
    merged, rewrites = dict(published), {}
    for name, rules in by_table.items():
        keys = [rule.key for rule in rules] + [spec.id] * (name == spec.table)
        touched = files_holding(published[name], dict.fromkeys(keys), keymap.old_ids())

        def change(part: DataFrame) -> DataFrame:
            whole = published[name]
            for rule in rules:
                if isinstance(rule, LinkRule):
                    part = merge_links(part, rule.key, rule.compare, keymap, whole)
                    whole = merge_links(whole, rule.key, rule.compare, keymap)
                else:
                    part, whole = (merge_fk(df, rule.key, keymap) for df in (part, whole))
            return drop_entities(part, spec.id, keymap) if name == spec.table else part

        _replace(published, merged, rewrites, name, rewrite(published, name, touched, change))
    return merged, rewrites


def set_where_touched(published: Published, name: str, condition: Column,
                      values: Mapping[str, Column]) -> tuple[Snapshot, Rewrites]:
    """A conditional update that rewrites only the files with such rows."""
    merged, rewrites = dict(published), {}
    touched = files_where(published[name], condition)
    _replace(published, merged, rewrites, name, rewrite(
        published, name, touched, lambda part: set_where(part, condition, values)))
    return merged, rewrites


def update_from_touched(published: Published, name: str, source: DataFrame, key: str, other: str,
                        values: Mapping[str, Column], order: Sequence[str] = ()
                        ) -> tuple[Snapshot, Rewrites]:
    """UPDATE … FROM on target.key = source.other, rewriting only the files that it reaches."""
    merged, rewrites = dict(published), {}
    ids = materialize(source.select(F.col(other).alias("id")).distinct(), "ids")
    touched = files_holding(published[name], [key], broadcast_if_small(ids, measure(ids)))
    _replace(published, merged, rewrites, name, rewrite(
        published, name, touched,
        lambda part: update_from(part, source, [(key, other)], dict(values), order)))
    return merged, rewrites


def _replace(published: Published, merged: Snapshot, rewrites: Rewrites, name: str,
             found: Rewrite | None) -> None:
    if found is None:
        return
    rewrites[name] = found
    spark, schema = published[name].sparkSession, published[name].schema
    kept = [spark.read.schema(schema).parquet(*(f"{published.root}/{p}" for p in found.kept))
            ] if found.kept else []
    merged[name] = reduce(DataFrame.unionByName, [*kept, found.part])
