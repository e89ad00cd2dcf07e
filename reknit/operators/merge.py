"""Merging duplicate entities in every table that refers to them.

A merge request says that ``old_id`` becomes ``new_id`` at some ``step``. All requests are
applied in one pass per table, with the result of applying them one by one in step order.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.joins import own_shuffle
from reknit.operators.keys import number_rows
from reknit.operators.rows import Snapshot
from reknit.session import BROADCAST_BYTES, broadcast_if_small, materialize, measure

log = logging.getLogger(__name__)

# The priority of a row that already sits on the survivor: below every request step.
SURVIVOR = -1
# More than there can be requests; places in a walk are counted back from it.
LAST = 1 << 62


@dataclass(frozen=True)
class KeyMap:
    """Every id named in the requests with its final survivor.

    ``rows`` holds (id, survivor, prio). Where several rows of a link table end up the same,
    those with the smallest ``prio`` are the ones that stay.
    """

    rows: DataFrame
    size: int

    def joinable(self) -> DataFrame:
        return broadcast_if_small(self.rows, self.size)

    def old_ids(self) -> DataFrame:
        return broadcast_if_small(self.rows.filter(F.col("prio") != SURVIVOR).select("id"),
                                  self.size)


def invalid_requests(requests: DataFrame) -> DataFrame:
    """(step, old_id, new_id, reason) of the requests that cannot be applied."""
    repeated = requests.groupBy("old_id").agg(F.count("*").alias("n"), F.min("step").alias("first"))
    itself = requests.filter("old_id = new_id").withColumn("reason", F.lit("merged into itself"))
    empty = requests.filter("old_id IS NULL OR new_id IS NULL OR step IS NULL").withColumn(
        "reason", F.lit("incomplete"))
    again = requests.join(repeated.filter("n > 1").drop("n", "first"), "old_id").select(
        *requests.columns, F.lit("merged away twice").alias("reason"))
    gone = (requests.join(repeated.select(F.col("old_id").alias("new_id"), "first"), "new_id")
            .filter("first < step AND old_id <> new_id")
            .select(*requests.columns, F.lit("survivor merged away earlier").alias("reason")))
    unordered = (requests.join(requests.groupBy("step").agg(F.count("*").alias("n"))
                               .filter("n > 1").drop("n"), "step")
                 .select(*requests.columns, F.lit("step used twice").alias("reason")))
    return reduce(DataFrame.unionByName, [itself, empty, again, gone, unordered])


def _summary(requests: DataFrame):
    """In one job: how many requests are wrong in some way, and how many start a chain."""
    olds = requests.groupBy("old_id").agg(F.count("*").alias("n"), F.min("step").alias("first"))
    steps = requests.groupBy("step").agg(F.count("*").alias("n"))
    itself = F.col("old_id") == F.col("new_id")
    survivors = own_shuffle(olds.select(F.col("old_id").alias("new_id"), "first"), ["new_id"])
    onward = requests.join(survivors, "new_id", "left")
    return onward.agg(
        F.count_if(F.greatest(F.col("old_id").isNull(), F.col("new_id").isNull(),
                              F.col("step").isNull(), itself, F.col("first") < F.col("step")))
        .alias("wrong"),
        F.count_if(F.col("first").isNotNull()).alias("chained"),
    ).select("chained", (F.col("wrong")
                         + olds.agg(F.count_if(F.col("n") > 1)).scalar()
                         + steps.agg(F.count_if(F.col("n") > 1)).scalar()).alias("wrong")).first()


def _in_order_of_arrival(olds: DataFrame) -> DataFrame:
    """Chained requests (id, survivor, prio) with the final survivor and the id's place.

    The steps from a survivor down to an id, the latest first, order the ids. That is a walk
    through the forest of merges that takes what was merged into a node by step, so the walk's
    arcs, one down to each id and one back up, make a list: after the way down come the first
    id merged into it, or the way up; after the way up its next sibling, or the parent's way
    up. An id's place is the number of ways down before it, summed by doubling along the list.
    """
    # Siblings are neighbours in the order of (survivor, step).
    placed = materialize(number_rows(olds, ["survivor", "prio"], "n", unique=True), "placed")
    after = placed.select((F.col("n") - 1).alias("n"), F.col("survivor"),
                          F.col("id").alias("sibling"))
    firsts = placed.groupBy(F.col("survivor").alias("id")).agg(F.min("n").alias("n")).join(
        placed.select("n", F.col("id").alias("child")), "n").select("id", "child")
    tree = placed.join(after, ["survivor", "n"], "left").join(
        own_shuffle(firsts, ["id"]), "id", "left")
    parents = own_shuffle(placed.select(F.col("id").alias("survivor")), ["survivor"])
    tree = tree.join(parents.withColumn("inner", F.lit(True)), "survivor", "left")

    def arc(id, down: bool):
        return F.struct(F.col(id).alias("id"), F.lit(down).alias("down"))

    # weight: ways down from here to before ``next``, or to the end of the tree's list, where
    # the last way up knows the survivor.
    down = tree.select(arc("id", True).alias("arc"),
                       F.when(F.col("child").isNotNull(), arc("child", True))
                       .otherwise(arc("id", False)).alias("next"),
                       F.lit(1).cast("long").alias("weight"), F.lit(None).cast("long").alias("top"))
    after_up = F.when(F.col("sibling").isNotNull(), arc("sibling", True)).when(
        F.col("inner"), arc("survivor", False))
    up = tree.select(arc("id", False).alias("arc"), after_up.alias("next"),
                     F.lit(0).cast("long").alias("weight"),
                     F.when(after_up.isNull(), F.col("survivor")).alias("top"))
    arcs = materialize(down.unionByName(up), "arcs")
    while not arcs.filter("next IS NOT NULL").isEmpty():
        onward = arcs.select(F.col("arc").alias("next"), F.col("next").alias("later"),
                             F.col("weight").alias("more"), F.col("top").alias("found"))
        arcs = materialize(arcs.join(own_shuffle(onward, ["next"]), "next", "left").select(
            "arc", F.col("later").alias("next"),
            (F.col("weight") + F.coalesce("more", F.lit(0))).alias("weight"),
            F.coalesce("top", "found").alias("top")), "arcs")
    # Of one survivor's ids, the earlier ones have more ways down before the list ends.
    return arcs.filter("arc.down").select(
        F.col("arc.id").alias("id"), F.col("top").alias("survivor"),
        (LAST - F.col("weight")).alias("prio"))


def resolve_requests(requests: DataFrame) -> KeyMap:
    """Check the requests and follow each old id to its final survivor.

    Chains are followed by doubling, so a chain of length n takes log2(n) rounds over rows of
    constant size; requests without chains take none.
    """
    requests = materialize(requests.select(
        *[F.col(name).cast("long").alias(name) for name in ("step", "old_id", "new_id")]),
        "requests")
    summary = _summary(requests)
    if summary.wrong:
        examples = invalid_requests(requests).take(5)
        raise ValueError("merge requests cannot be applied: " + "; ".join(
            f"{row.old_id} into {row.new_id}: {row.reason}" for row in examples))
    olds = requests.select(F.col("old_id").alias("id"), F.col("new_id").alias("survivor"),
                           F.col("step").alias("prio"))
    if summary.chained:
        olds = materialize(_in_order_of_arrival(olds), "olds")
    survivors = olds.select("survivor").distinct().select(
        F.col("survivor").alias("id"), "survivor", F.lit(SURVIVOR).cast("long").alias("prio"))
    rows = materialize(olds.select("id", "survivor", "prio").unionByName(survivors), "keymap")
    return KeyMap(rows, measure(rows))


def judge_requests(requests: DataFrame) -> DataFrame:
    """(step, old_id, new_id, reason) as if every request were applied, or refused, on its own.

    In the order of their steps (then of their ids) requests are refused that merge an id into
    itself, are incomplete, or name an id that a request applied before them has merged away;
    NULL stands for those that are applied. A refused request does not count for later ones.

    A request waits for the earlier ones that merge one of its two ids away. Each round decides
    all that wait for none that is open, so that most files take one round, and at most as many
    as the longest run of requests that wait for each other.
    """
    requests = requests.select(
        *[F.col(name).cast("long").alias(name) for name in ("step", "old_id", "new_id")])
    reason = F.when(F.col("old_id").isNull() | F.col("new_id").isNull() | F.col("step").isNull(),
                    "incomplete").when(F.col("old_id") == F.col("new_id"), "merged into itself")
    placed = materialize(number_rows(requests, ["step", "old_id", "new_id"], "place")
                         .withColumn("reason", reason), "placed")
    decided = [placed.filter("reason IS NOT NULL")]
    open_ = placed.filter("reason IS NULL")
    # The first request that merged an id away, and the first one that may yet do so.
    applied = open_.limit(0).select(F.col("old_id").alias("id"), F.col("place").alias("gone"))
    while True:
        firsts = open_.groupBy(F.col("old_id").alias("id")).agg(F.min("place").alias("first"))
        known = firsts.join(applied, "id", "full")
        sides = [own_shuffle(known.select(F.col("id").alias(f"{side}_id"),
                                          F.col("first").alias(f"{side}_first"),
                                          F.col("gone").alias(f"{side}_gone")), [f"{side}_id"])
                 for side in ("old", "new")]
        met = open_.join(sides[0], "old_id", "left").join(sides[1], "new_id", "left")
        place = F.col("place")
        waiting = F.col("old_first") < place
        verdict = F.when(F.col("old_gone") < place, "merged away earlier").when(
            ~waiting & (F.col("new_gone") < place), "survivor merged away earlier").when(
            ~waiting & (F.coalesce(F.col("new_first"), place) >= place), "applied")
        judged = materialize(met.withColumn("verdict", verdict).select(
            *placed.columns, "verdict"), "judged")
        decided.append(judged.filter("verdict IS NOT NULL").withColumn(
            "reason", F.nullif("verdict", F.lit("applied"))).select(*placed.columns))
        open_ = judged.filter("verdict IS NULL").select(*placed.columns)
        if open_.isEmpty():
            break
        fresh = judged.filter("verdict = 'applied'").select(
            F.col("old_id").alias("id"), F.col("place").alias("gone"))
        # Only what the open requests name is looked at in the next round.
        named = open_.select(F.explode(F.array("old_id", "new_id")).alias("id")).distinct()
        applied = materialize(applied.unionByName(fresh).join(named, "id", "left_semi"), "applied")
    return reduce(DataFrame.unionByName, decided).select("step", "old_id", "new_id", "reason")


def resolve_valid(requests: DataFrame) -> tuple[KeyMap, DataFrame]:
    """The map of the requests that can be applied, and the others with their reasons.

    Requests that share a step are taken in the order of their ids.
    """
    judged = materialize(judge_requests(requests), "verdicts")
    valid = judged.filter("reason IS NULL").select("step", "old_id", "new_id")
    ordered = number_rows(valid, ["step", "old_id", "new_id"], "n", unique=True).select(
        F.col("n").alias("step"), "old_id", "new_id")
    return resolve_requests(ordered), judged.filter("reason IS NOT NULL")


def _rekey(df: DataFrame, key: str, keymap: KeyMap) -> DataFrame:
    """The table with ``key`` replaced, plus the priority of the id it had (NULL if unnamed)."""
    ids = keymap.joinable().select(F.col("id").alias("__id"), F.col("survivor").alias("__survivor"),
                                   F.col("prio").alias("__prio"))
    joined = df.join(ids, F.col(key) == F.col("__id"), "left")
    new = F.coalesce("__survivor", key).cast(df.schema[key].dataType)
    return joined.withColumn(key, new).drop("__id", "__survivor")


def merge_links(df: DataFrame, key: str, compare: Sequence[str], keymap: KeyMap,
                whole: DataFrame | None = None) -> DataFrame:
    """Re-key a link table, dropping rows the survivor already has.

    ``df`` may be a part of a table ``whole`` that holds all rows of merged ids: what they
    collide with may be elsewhere.

    Rows collide when they end on the same survivor with equal ``compare`` columns, none of
    them NULL. Of colliding rows, those of the id that reached the survivor first stay.

    Only rows of named ids are grouped, with map-side combining. The groups that really
    collide are written and measured. Where they are too many to be broadcast, rows of other
    ids, which cannot collide, pass them by: of the table only the named rows are shuffled to
    meet them.
    """
    rekeyed = _rekey(df, key, keymap)
    everything = rekeyed if whole is None else _rekey(whole, key, keymap)
    group = [key, *compare]
    names = [f"__g{i}" for i in range(len(group))]
    contested = materialize(
        everything.filter(F.col("__prio").isNotNull()).dropna(subset=list(compare))
        .groupBy(*group).agg(F.min("__prio").alias("__kept"), F.max("__prio").alias("__last"))
        .filter("__kept < __last").drop("__last").toDF(*names, "__kept"), "contested")
    size = measure(contested)
    if size == 0:
        return rekeyed.drop("__prio")
    same = reduce(lambda a, b: a & b,
                  [F.col(name) == F.col(other) for name, other in zip(group, names)])
    lost = same & (F.col("__prio") > F.col("__kept"))
    if size <= BROADCAST_BYTES:
        return rekeyed.join(broadcast_if_small(contested, size), lost, "left_anti").drop("__prio")
    ids = keymap.joinable().select(F.col("id").alias("__id"))
    others = df.join(ids, F.col(key) == F.col("__id"), "left_anti")
    named = rekeyed.filter(F.col("__prio").isNotNull()).join(contested, lost, "left_anti")
    return others.unionByName(named.drop("__prio"))


def merge_fk(df: DataFrame, key: str, keymap: KeyMap) -> DataFrame:
    """Replace old ids in a plain foreign key; nothing can collide."""
    return _rekey(df, key, keymap).drop("__prio")


def drop_entities(df: DataFrame, id: str, keymap: KeyMap) -> DataFrame:
    """Remove the entities that were merged away."""
    return df.join(keymap.old_ids().withColumnRenamed("id", "__id"),
                   F.col(id) == F.col("__id"), "left_anti")


def diagnose_self_parent(df: DataFrame, id: str, parent: str) -> DataFrame:
    """Entities that became their own parent, as a survivor does whose parent was merged."""
    return df.filter(F.col(id) == F.col(parent))


@dataclass(frozen=True)
class LinkRule:
    table: str
    key: str
    compare: tuple[str, ...]
    optional: bool = False


@dataclass(frozen=True)
class KeyRule:
    table: str
    key: str
    optional: bool = False


@dataclass(frozen=True)
class MergeSpec:
    """Which tables refer to an entity, and how."""

    table: str
    id: str
    links: Sequence[LinkRule] = field(default_factory=tuple)
    keys: Sequence[KeyRule] = field(default_factory=tuple)


def merge_snapshot(snapshot: Snapshot, spec: MergeSpec, keymap: KeyMap) -> Snapshot:
    """Merge in every table of the spec. Absent tables are skipped when optional, else raise."""
    merged = dict(snapshot)
    for rule in [*spec.keys, *spec.links]:
        if rule.table not in merged:
            if not rule.optional:
                raise KeyError(rule.table)
            log.info("table %s does not exist, skipped", rule.table)
        elif isinstance(rule, LinkRule):
            merged[rule.table] = merge_links(merged[rule.table], rule.key, rule.compare, keymap)
        else:
            merged[rule.table] = merge_fk(merged[rule.table], rule.key, keymap)
    merged[spec.table] = drop_entities(merged[spec.table], spec.id, keymap)
    return merged


def apply_merges(snapshot: Snapshot, spec: MergeSpec, requests: DataFrame) -> Snapshot:
    """Merge a whole request list, (step, old_id, new_id), into a snapshot."""
    return merge_snapshot(snapshot, spec, resolve_requests(requests))
