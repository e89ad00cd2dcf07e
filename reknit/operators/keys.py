"""Dense numbering in a stated order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reknit.session import materialize

# Identical rows that travel as one counted row while being numbered.
COPIES = 10_000


def number_rows(df: DataFrame, order: Sequence[str], out: str, unique: bool = False) -> DataFrame:
    """Add ``out`` = 1, 2, 3, … by ``order``, then by the other columns.

    The rows are range partitioned and sorted once; the position within each partition plus
    the sizes of the partitions before it make the number. Identical rows could all meet in
    one partition, so they are counted first and repeated last, unless ``unique`` says the
    columns of ``order`` already tell all rows apart.
    """
    columns = df.columns
    if unique:
        keys = list(order)
        rows = df.withColumn("__copies", F.lit(1).cast("long"))
    else:
        keys = [*order, *[name for name in columns if name not in order], "__chunk"]
        rows = df.groupBy(*columns).agg(F.count("*").alias("__all"))
        last_chunk = F.floor((F.col("__all") - 1) / COPIES)
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk))
                           .alias("__chunk"))
        rows = rows.withColumn("__copies", F.least(
            F.lit(COPIES), F.col("__all") - F.col("__chunk") * COPIES)).drop("__all")
    # monotonically_increasing_id() is the partition number, then the row's position in it.
    placed = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__place", 33)
    # One row per partition: its number of rows, summed over the partitions before it.
    before = (placed.groupBy(part.alias("__part")).agg(F.sum("__copies").alias("__size"))
              .withColumn("__before", F.sum("__size").over(Window.orderBy("__part"))
                          - F.col("__size"))
              .drop("__size"))
    located = placed.withColumn("__part", part).join(before.hint("broadcast"), "__part")
    if unique:
        position = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
        return located.select(*columns, (F.col("__before") + position).alias(out))
    within = Window.partitionBy("__part").orderBy("__place").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("__copies").over(within), F.lit(0))
    return (located.withColumn("__start", start)
            .select(*columns, F.col("__start"),
                    F.explode(F.sequence(F.lit(1).cast("long"), "__copies")).alias("__copy"))
            .select(*columns, (F.col("__start") + F.col("__copy")).alias(out)))


def allocate_ids(new: DataFrame, target: DataFrame, id: str, order: Sequence[str], gap: int = 0,
                 unique: bool = False) -> DataFrame:
    """Give new rows the ids after the largest one of the target, in ``order``.

    ``gap=1`` skips one id, as a sequence set to max + 1 and marked as used does. An empty
    target counts as max = 0.
    """
    last = target.agg(F.coalesce(F.max(id), F.lit(0))).scalar()
    # Range partitioning runs what is before it once more to find its bounds.
    new = materialize(new.drop(id), "unnumbered")
    numbered = number_rows(new, order, "__n", unique)
    return numbered.select((last + F.lit(gap) + F.col("__n")).alias(id), *new.columns)
