"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of ``edges`` (columns a, b) reaches: (node, low).

    A large star hangs a node's larger neighbours on its smallest one, a small star the
    smaller ones; both are a minimum per node and a join with it, so that no neighbourhood is
    ever gathered, and the number of rounds grows with the logarithm of the longest path.
    Links that a round repeats go once, at its end.
    Self loops and NULL ends are left out; an empty table gives an empty one.
    """
    # Always b > a: each edge hangs a larger node on a smaller one.
    links = materialize(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), "links")
    before = None
    while True:
        # Of a node's neighbours only smaller ones can be below it, so each link is looked at once.
        lows = links.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("low"))
        large = links.join(lows, "a", "left").select(F.coalesce("low", "a").alias("a"), "b")
        lows = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(lows, "b")
        links = materialize(
            small.select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b"))
            .filter("a <> b").distinct(), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # Stars only: every node but the smallest ones is at the far end of one edge.
    return (links.select(F.col("b").alias("node"), F.col("a").alias("low"))
            .unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("low"))
                         .distinct()))
