"""Ids from durable counters, which never give an id out again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.operators.keys import number_rows
from reknit.session import materialize


@dataclass(frozen=True)
class Counter:
    """A sequence: its last value, and whether that has been given out."""

    last: int = 1
    called: bool = False

    @property
    def next(self) -> int:
        return self.last + 1 if self.called else self.last

    def set(self, value: int, called: bool = True) -> Counter:
        """The counter at another value, which is the next one to give out if not ``called``."""
        return Counter(value, called)

    def at_least(self, value: int | None) -> Counter:
        """The counter moved up to a value that is in use, never down."""
        return self if value is None or value < self.next else Counter(value, True)

    def advance(self, count: int) -> Counter:
        """The counter after ``count`` more ids."""
        return Counter(self.next + count - 1, True) if count else self


def draw_ids(new: DataFrame, counter: Counter, id: str, order: Sequence[str],
             unique: bool = False) -> tuple[DataFrame, Counter]:
    """Give new rows the counter's next ids in ``order``; returns them and the counter after.

    Ids of rows that were deleted since, even the largest ones, do not come back, as long as
    the counter is published with the table. An ``id`` column that the rows have is replaced.
    """
    rows = materialize(number_rows(materialize(new.drop(id), "unnumbered"), order, "__n", unique),
                       "drawn")
    after = counter.advance(rows.count())
    numbered = rows.select((F.lit(counter.next - 1) + F.col("__n")).alias(id),
                           *[name for name in new.columns if name != id])
    return numbered, after


def counter_of(table: DataFrame, id: str) -> Counter:
    """A counter for a table that had none: it goes on after the largest id."""
    return Counter().at_least(table.agg(F.max(id).alias("last")).first().last)
