"""A key that a third of all rows share is split by AQE in every join that may meet it."""

import re

import pytest
from pyspark.sql import functions as F

from reknit.operators import joins, links
from reknit.operators import merge as m
from reknit.operators.hierarchy import link_parents

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def big(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.uuid().alias("payload"), F.col("id").alias("n"))
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def run(df):
    """The number of rows, and whether some join split a hot key."""
    counted = df.select(F.struct(*df.columns).alias("row")).agg(
        F.count("row").alias("n"), F.max(F.xxhash64("row")).alias("h"))
    ((n, _),) = counted.collect()
    return n, "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_anti_join(big):
    right = big.filter("n % 2 = 0 AND k <> 7").select("k")
    assert run(joins.keep_absent(big, right, "k")) == (200_000, True)


def test_semi_join(big):
    assert run(joins.keep_present(big, big.filter("n < 30").select("k"), "k")) == (100_020, True)


def test_lookup(big):
    dimension = big.select("k", F.col("n").alias("v"))
    assert run(joins.lookup(big, dimension, "k", "v", "out")) == (300_000, True)


def test_update(big):
    source = big.select("k", F.col("n").alias("v"))
    updated = joins.update_from(big, source, "k", {"n": F.col("source.v")}, order=["v"])
    assert run(updated) == (300_000, True)


def test_parents(big):
    plots = big.select(
        F.col("n").alias("id"), F.lit(1).alias("t"), F.lit(None).cast("long").alias("parent"),
        F.concat(F.col("k").cast("string"), F.lit("."), "payload").alias("code"),
        F.lit(1).alias("d"))
    linked = link_parents(plots, "id", "code", ["t"], "d", "parent")
    assert run(linked) == (300_000, True)


def test_merge(big, monkeypatch):
    monkeypatch.setattr(m, "broadcast_if_small", lambda df, size: df)
    requests = big.sparkSession.range(8, 2_000).selectExpr("id AS step", "id AS old_id",
                                                           "7L AS new_id")
    keymap = m.resolve_requests(requests)
    assert run(m.merge_fk(big, "k", keymap)) == (300_000, True)
    linked = big.withColumn("c", F.lit("same"))
    assert run(m.merge_links(linked, "k", ["c"], keymap)) == (300_000 - 1_328, True)


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_few_codes_of_many_values_are_dealt_by_links(spark, rows, monkeypatch, broadcast):
    """Two codes went to one task, which made all links."""
    monkeypatch.setattr(links, "LINKS", 1_000)
    monkeypatch.setattr(links, "SIDE", 16)
    monkeypatch.setattr(links, "BROADCAST_BYTES", broadcast)
    lists = spark.range(300).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'a, b, a' WHEN id % 3 = 1 THEN 'b, none' ELSE 'c' END AS codes")
    lists = lists.unionByName(lists.filter("id < 9")).unionByName(
        spark.range(300, 2_300).selectExpr("id", "'none' AS codes"))
    values = {"a": range(50), "b": range(30, 70), "c": [100], "d": range(9)}
    dimension = spark.createDataFrame(
        [(code, v) for code, own in values.items() for v in own] * 2, "code string, value long")
    found = links.codes_to_links(lists, "id", "codes", dimension, "code", "value")
    assert rows(found) == sorted(
        ((k, v) for k in range(300) for v in sorted(
            {v for code in ("ab", "b", "c")[k % 3] for v in values[code]})), key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # a twice in 103 lists, b in these and 103 others, c in 103, and what is read in vain.
    made = 103 * 2 * 50 + (103 + 103) * 40 + 103 + 103 + 2_000
    dealt = re.findall(r"hashpartitioning\(([^()]*), (\d+)\), REPARTITION_BY_NUM", plan)
    assert {int(n) for _, n in dealt} == {made // 1_000 + 1}
    keys = {re.sub(r"#\d+L?", "", names) for names, _ in dealt}
    assert keys == ({"id"} if broadcast else {"code, __listed, __known"})
    if broadcast:
        # Nothing is shuffled to make the links distinct.
        assert "hashpartitioning(id" not in plan.split("BroadcastHashJoin")[0]
