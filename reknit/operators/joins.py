"""Joins of the migration scripts: anti joins, lookups and updates from another table.

The joined side has one row per key, made so by an aggregation that combines map-side. A hot
key can then only sit on the other side, where AQE splits it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.session import BROADCAST_BYTES, broadcast_if_small, materialize, measure

Pair = tuple[Column | str, Column | str]

# A type of a dimension with more codes than this is joined, not packed into a map.
PACKED_CODES = 1_000


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _pairs(on: str | Sequence[str | Pair]) -> list[Pair]:
    items = [on] if isinstance(on, str) else on
    return [(item, item) if isinstance(item, str) else item for item in items]


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def _marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys as (missing, text), which are never NULL and equal only where both texts are there.

    On a computed key that may be NULL, Spark puts a filter below the join that computes it
    once more. A missing text of the left side stays NULL, one of the right becomes empty, so
    that the two differ.
    """
    return df.withColumns({key: F.struct(F.col(key).isNull().alias("missing"),
                                         F.coalesce(key, F.lit("")).alias("text"))
                           for key in keys})


def own_shuffle(side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys as computed columns, so that the join shuffles an aggregated side once more.

    AQE splits a hot key only where both sides of the join come straight from a shuffle; else
    the join would take the aggregation's partitioning as it is. The side is small by then.
    """
    return side.withColumns({key: F.greatest(key, key) for key in keys})


def _keyed(left: DataFrame, right: DataFrame, on, unique: bool
           ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the key expressions as columns, the right keys distinct."""
    pairs = _pairs(on)
    keys = [f"__key{i}" for i in range(len(pairs))]
    left = left.select("*", *[_col(a).alias(key) for key, (a, _) in zip(keys, pairs)])
    right = right.select(*[_col(b).alias(key) for key, (_, b) in zip(keys, pairs)])
    if any(isinstance(b, Column) for _, b in pairs):
        kinds = [dict(side.dtypes) for side in (left, right)]
        texts = [key for key in keys if all(kind[key] == "string" for kind in kinds)]
        right = _marked(right, texts)
        left = left.withColumns({key: F.struct(F.lit(False).alias("missing"),
                                               F.col(key).alias("text")) for key in texts})
    return left, right if unique else own_shuffle(right.distinct(), keys), keys


def keep_absent(left: DataFrame, right: DataFrame, on, unique: bool = False) -> DataFrame:
    """Rows of ``left`` without a match (NOT EXISTS, LEFT JOIN … IS NULL). NULL never matches.

    ``on`` holds column names, or pairs of left and right expressions. ``unique`` says that
    the right side repeats no key, and spares the shuffle that would make its keys distinct.
    """
    left, right, keys = _keyed(left, right, on, unique)
    return left.join(right, keys, "left_anti").drop(*keys)


def keep_absent_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a match in columns of the same names; NULL matches NULL."""
    names = {name: f"__right{i}" for i, name in enumerate(on)}
    right = right.select(*[F.col(name).alias(other) for name, other in names.items()]).distinct()
    same = _all([F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()])
    return left.join(own_shuffle(right, list(names.values())), same, "left_anti")


def keep_present(left: DataFrame, right: DataFrame, on, unique: bool = False) -> DataFrame:
    """Rows of ``left`` with a match, once each."""
    left, right, keys = _keyed(left, right, on, unique)
    return left.join(right, keys, "left_semi").drop(*keys)


def keep_absent_any(left: DataFrame, right: DataFrame, *alternatives) -> DataFrame:
    """NOT EXISTS (a OR b): one hash anti join per alternative instead of a nested loop."""
    return reduce(lambda rows, on: keep_absent(rows, right, on), alternatives, left)


def keep_not_in(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``left.key NOT IN (SELECT right.key)`` with its NULL rules.

    One NULL on the right empties the result, and a NULL on the left passes only an empty
    right side. Both facts come from one scalar subquery, so the right side is never
    broadcast whole.
    """
    ((left_key, right_key),) = _pairs(on)
    facts = right.agg(
        F.struct(
            (F.count("*") > 0).alias("any_row"),
            F.coalesce(F.max(_col(right_key).isNull()), F.lit(False)).alias("any_null"),
        ).alias("facts")
    ).scalar()
    rows = keep_absent(left, right, [(left_key, right_key)])
    return rows.filter(~facts["any_null"] & (_col(left_key).isNotNull() | ~facts["any_row"]))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key (DISTINCT ON): the smallest by ``order``, then by all other columns.

    A minimum over structs, so hot keys shrink before the shuffle. NULL is a key of its own.
    """
    rest = [*order, *[name for name in df.columns if name not in order]]
    rest = [name for name in rest if name not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__best"))
    return best.select(*[F.col(name) if name in keys else F.col(f"__best.`{name}`").alias(name)
                         for name in df.columns])


def update_from(target: DataFrame, source: DataFrame, on, values: dict[str, Column],
                order: Sequence[str] = (), where: Column | None = None,
                unique: bool = False) -> DataFrame:
    """UPDATE … FROM: overwrite columns of the target rows that match the source.

    Expressions in ``values`` may use both rows as ``target.x`` and ``source.x``. When the
    source repeats a key, its smallest row by ``order`` (then by all columns) wins; pass
    ``unique`` when it cannot. ``where`` is one more condition on the target row.
    """
    pairs = _pairs(on)
    keys = [f"__key{i}" for i in range(len(pairs))]
    source = source.select("*", *[_col(b).alias(key) for key, (_, b) in zip(keys, pairs)])
    if not unique:
        source = one_per_key(source, keys, order)
    source = own_shuffle(source, keys).withColumn("__matched", F.lit(True))
    target_keys = [f"__target{i}" for i in range(len(pairs))]
    keyed = target.select("*", *[_col(a).alias(key) for key, (a, _) in zip(target_keys, pairs)])
    conditions = [F.col(f"target.{a}") == F.col(f"source.{b}") for a, b in zip(target_keys, keys)]
    if where is not None:
        conditions.append(where)
    joined = keyed.alias("target").join(source.alias("source"), _all(conditions), "left")
    matched = F.col("source.__matched")
    columns = []
    for name in target.columns:
        old = F.col(f"target.`{name}`")
        columns.append(F.when(matched, values[name]).otherwise(old).alias(name)
                       if name in values else old.alias(name))
    return joined.select(*columns)


def measured(side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A joined side, written once: broadcast when it turns out small, else shuffled on its own.

    Estimates after an aggregation or a join are too high for a static broadcast, and a switch
    at run time comes after the other side has been shuffled.
    """
    side = materialize(side, "side")
    size = measure(side)
    return broadcast_if_small(side, size) if size <= BROADCAST_BYTES else own_shuffle(side, keys)


def lookup(df: DataFrame, dimension: DataFrame, on, value: str, out: str,
           measure_first: bool = False) -> DataFrame:
    """Add ``out``: the id found in a dimension, NULL where none; the smallest if several.

    ``measure_first`` writes the reduced dimension and broadcasts it if it is small, which
    spares a large table one shuffle per lookup.
    """
    pairs = _pairs(on)
    keys = [f"__key{i}" for i in range(len(pairs))]
    side = dimension.select(*[_col(b).alias(key) for key, (_, b) in zip(keys, pairs)],
                            F.col(value).alias("__value"))
    side = side.groupBy(*keys).agg(F.min("__value").alias("__value"))
    side = measured(side, keys) if measure_first else own_shuffle(side, keys)
    keyed = df.select("*", *[_col(a).alias(key) for key, (a, _) in zip(keys, pairs)])
    return keyed.join(side, keys, "left").withColumn(out, F.col("__value")).drop("__value", *keys)


def lookup_types(df: DataFrame, dimension: DataFrame, kind: str, code: str, value: str,
                 columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Ids for several columns from one dimension of typed codes, without a join per column.

    ``columns`` names, per column to add, the type (column ``kind`` of the dimension) and the
    column that holds the code. NULL where there is no such code; the smallest id if several.
    The codes of the wanted types are counted, and packed into one row with a map per type, a
    scalar subquery that needs no join. Types of more than ``PACKED_CODES`` codes, where a map
    would be slow, are looked up by a join per column.
    """
    kinds = sorted({kind for kind, _ in columns.values()})
    codes = materialize(
        dimension.filter(F.col(kind).isin(kinds) & F.col(code).isNotNull())
        .groupBy(F.col(kind).alias("__kind"), F.col(code).alias("__code"))
        .agg(F.min(value).alias("__value")), "codes")
    sizes = {row['__kind']: row.n for row in
             codes.groupBy("__kind").agg(F.count("*").alias("n")).collect()}
    small = [k for k in kinds if sizes.get(k, 0) <= PACKED_CODES]
    packed = {out: pair for out, pair in columns.items() if pair[0] in small}
    found = df
    if packed:
        def of(k: str) -> Column:
            return F.map_from_entries(F.collect_list(
                F.when(F.col("__kind") == k, F.struct("__code", "__value"))))

        pack = codes.agg(F.struct(*(of(k).alias(f"m{i}") for i, k in enumerate(small)))
                         .alias("pack")).scalar()
        found = found.select("*", *(
            F.try_element_at(pack[f"m{small.index(k)}"], F.col(held)).alias(out)
            for out, (k, held) in packed.items()))
    for out, (k, held) in columns.items():
        if out not in packed:
            found = lookup(found, codes.filter(F.col("__kind") == k), [(held, "__code")],
                           "__value", out)
    return found.select(*df.columns, *columns)


def unresolved_codes(found: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(kind, code, rows) of the codes for which ``lookup_types`` has found no id, in one pass."""
    cells = F.array(*(F.when(F.col(held).isNotNull() & F.col(out).isNull(), F.struct(
        F.lit(kind).alias("kind"), F.col(held).cast("string").alias("code")))
        for out, (kind, held) in columns.items()))
    return (found.select(F.explode(F.array_compact(cells)).alias("cell"))
            .groupBy("cell.kind", "cell.code").agg(F.count("*").alias("rows")))


def scalar_lookup(dimension: DataFrame, condition: Column, value: str) -> Column:
    """The id of one dimension row as a scalar subquery: NULL without a row, else the smallest."""
    return dimension.filter(condition).agg(F.min(value)).scalar()


def translate_codes(df: DataFrame, mapping: DataFrame, code: str, source: str,
                    standard: str) -> DataFrame:
    """Replace a code by its standard code; codes outside the mapping are dropped."""
    side = mapping.select(F.col(source).alias(code), F.col(standard).alias("__standard")).distinct()
    return (df.join(side, code)
            .withColumn(code, F.col("__standard")).drop("__standard"))


def translate_ids(children: DataFrame, parents: DataFrame, targets: DataFrame, parent_id: str,
                  natural_key: str) -> DataFrame:
    """Re-point children from source parents to target parents through a shared natural key.

    Children whose parent has no counterpart are dropped. Where target parents share a natural
    key, the smallest one takes the children. The bridge between the parents is written and
    measured, so that the children are not shuffled to meet a small one.
    """
    smallest = targets.groupBy(natural_key).agg(F.min(parent_id).alias("__target"))
    bridge = parents.select(F.col(parent_id).alias("__source"), natural_key).distinct().join(
        smallest, natural_key).groupBy("__source").agg(F.min("__target").alias("__target"))
    bridge = measured(bridge.select("__source", "__target"), ["__source"])
    return (children.join(bridge, F.col(parent_id) == F.col("__source"))
            .withColumn(parent_id, F.col("__target")).drop("__source", "__target"))
