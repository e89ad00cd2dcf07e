"""Constraint checks, difference lists and import progress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reknit.functions.identifiers import qualify, quote
from reknit.operators.rows import Snapshot

# Fixed value: the schema of import tables named without one.
IMPORT_SCHEMA = "gn_imports"
ACTION = "meta_last_action"


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The repeated keys and how often they occur; keys with a NULL never conflict."""
    return (df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
            .filter("n > 1"))


def require_unique(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise where a key repeats, as a constraint of the target would."""
    repeated = check_unique(df, columns).take(5)
    if repeated:
        raise ValueError(f"{', '.join(columns)} repeat: " + ", ".join(
            f"{tuple(row)[:-1]} {row.n} times" for row in repeated))


def count_actions(df: DataFrame, column: str = ACTION) -> DataFrame:
    """Rows per last action."""
    return df.groupBy(column).agg(F.count("*").alias("total"))


def import_total(source: SparkSession | Snapshot, table: str, action: str,
                 default_schema: str = IMPORT_SCHEMA) -> int:
    """Rows of a named table with the given last action."""
    schema, name = qualify(table, default_schema)
    df = (source.table(quote(schema, name)) if isinstance(source, SparkSession)
          else source[f"{schema}.{name}"])
    return df.filter(F.col(ACTION) == action).count()


def import_totals(df: DataFrame, actions: Sequence[str], column: str = ACTION) -> DataFrame:
    """(action, total) for each of the actions in one aggregation, 0 where no row has it."""
    counts = df.agg(*(F.count_if(F.col(column) == action).alias(f"n{k}")
                      for k, action in enumerate(actions)))
    return counts.select(F.inline(F.array(*(
        F.struct(F.lit(action).alias("action"), F.col(f"n{k}").alias("total"))
        for k, action in enumerate(actions)))))


def import_step(total: Column | str) -> Column:
    """The batch size for a number of pending rows; NULL for NULL."""
    total = F.col(total) if isinstance(total, str) else total
    # The limits and sizes of the steps.
    return (F.when(total <= 100_000, 10_000)
            .when(total <= 2_500_000, 100_000)
            .when(total > 2_500_000, 500_000))


def import_plan(df: DataFrame, column: str = ACTION) -> DataFrame:
    """Per last action, the pending rows, the batch size and the number of batches."""
    plan = count_actions(df, column).withColumn("step", import_step("total"))
    return plan.withColumn("batches", F.ceil(F.col("total") / F.col("step")))


def diff_report(left: DataFrame, right: DataFrame, on: Sequence[str | tuple], compare: str,
                columns: Mapping[str, Column]) -> DataFrame:
    """Rows present on both sides whose compared value differs; NULL differs from a value.

    ``columns`` picks the output, from ``left.x`` and ``right.x``. A key that repeats on either
    side is an error, as it would pair every such row with every other.
    """
    pairs = [(key, key) if isinstance(key, str) else key for key in on]
    left = left.select("*", *[(F.col(a) if isinstance(a, str) else a).alias(f"__l{i}")
                              for i, (a, _) in enumerate(pairs)])
    right = right.select("*", *[(F.col(b) if isinstance(b, str) else b).alias(f"__r{i}")
                                for i, (_, b) in enumerate(pairs)])
    # Both sides in one job.
    found = [check_unique(side, keys).select(
        *(F.col(key).cast("string").alias(f"key{i}") for i, key in enumerate(keys)), "n")
        for side, keys in ((left, [f"__l{i}" for i in range(len(pairs))]),
                           (right, [f"__r{i}" for i in range(len(pairs))]))]
    repeated = found[0].union(found[1]).take(3)
    if repeated:
        raise ValueError(f"keys repeat: {', '.join(str(tuple(row)) for row in repeated)}")
    condition = ~F.col(f"left.{compare}").eqNullSafe(F.col(f"right.{compare}"))
    for i in range(len(pairs)):
        condition = condition & (F.col(f"left.__l{i}") == F.col(f"right.__r{i}"))
    joined = left.alias("left").join(right.alias("right"), condition)
    return joined.select(*[value.alias(name) for name, value in columns.items()])
