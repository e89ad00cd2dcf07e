"""Rows: conditional updates, deletes, appends, keys, constraints and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.operators.keys import allocate_ids
from reknit.operators.quality import (
    check_unique, count_actions, diff_report, import_plan, import_step)
from reknit.operators.rows import (
    append, append_positional, delete_where, fill_uuid, relabel, set_where, truncate_cascade)


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority ELSE o_orderstatus END
         AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def conditional_update(spark, folder):
    """A value moves to another column, which the cleared one must not see."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus",
                                                   "o_orderpriority")
    return set_where(orders, F.col("o_orderpriority") == "5-LOW",
                     {"o_orderpriority": F.lit(None), "o_orderstatus": F.col("o_orderpriority")})


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE l_linestatus END
         AS l_linestatus
FROM lineitem
""")
def relabelled(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                    "l_linestatus")
    return relabel(lines, "l_returnflag", "l_linestatus", {"A": "accepted", "R": "returned"})


@query("""
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
WHERE coalesce(nullif(o_orderpriority, '5-LOW') <> '1-URGENT', true)
""")
def delete_keeps_null(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return delete_where(orders, F.col("priority") == "1-URGENT")


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, 'SUPPLY' FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL FROM part
""")
def appended_rows(spark, folder):
    """By name with a default, then by position with a column left out."""
    target = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return append_positional(append(target, suppliers, {"segment": F.lit("SUPPLY")}), parts)


def _counts(snapshot: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in snapshot.items()])


@query("""
SELECT 'customer' AS name, 0::BIGINT AS n UNION ALL SELECT 'orders', 0
UNION ALL SELECT 'lineitem', 0 UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'events', count(*) FROM events
""")
def truncate_cascade_counts(spark, folder):
    names = ["customer", "orders", "lineitem", "part", "supplier", "events"]
    edges = [("orders", "customer"), ("lineitem", "orders"), ("lineitem", "part"),
             ("customer", "nation"), ("supplier", "nation")]
    return _counts(truncate_cascade({n: table(spark, folder, n) for n in names}, edges,
                                    ["customer"]))


@query("""
SELECT 'part' AS name, p_partkey AS id FROM part
UNION ALL SELECT 'supplier', s_suppkey FROM supplier
UNION ALL SELECT 'events', event_id FROM events
""")
def truncate_cascade_rows(spark, folder):
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey",
            "part": "p_partkey", "supplier": "s_suppkey", "events": "event_id"}
    edges = [("orders", "customer"), ("lineitem", "orders"), ("lineitem", "part"),
             ("customer", "nation"), ("supplier", "nation")]
    left = truncate_cascade({n: table(spark, folder, n) for n in keys}, edges, ["customer"])
    return reduce(DataFrame.union, [
        df.select(F.lit(name).alias("name"), F.col(keys[name]).alias("id"))
        for name, df in left.items()])


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING'
  THEN '00000000-0000-4000-8000-000' || lpad(c_custkey::VARCHAR, 9, '0') ELSE 'made' END AS uuid
FROM customer
""")
def conditional_uuid_rows(spark, folder):
    """Every row by its key: given ids as they were, the made ones by their form."""
    key = F.col("c_custkey")
    given = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(
        F.lit("00000000-0000-4000-8000-000"), F.lpad(key.cast("string"), 9, "0")))
    customers = table(spark, folder, "customer").select("c_custkey", given.alias("uuid"))
    form = F.col("uuid").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$") & ~F.startswith(
        "uuid", F.lit("00000000-0000"))
    return fill_uuid(customers, "uuid").select(
        "c_custkey", F.when(form, "made").otherwise(F.col("uuid")).alias("uuid"))


@query("""
SELECT count(*) AS n, count(*) AS filled, count(*) AS well_formed,
       count(*) FILTER (c_mktsegment = 'BUILDING') AS kept
FROM customer
""")
def conditional_uuid(spark, folder):
    """Ids for those without one; the random values show only in their counts."""
    key = F.col("c_custkey")
    given = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(
        F.lit("00000000-0000-4000-8000-000"), F.lpad(key.cast("string"), 9, "0")))
    customers = table(spark, folder, "customer").select("c_custkey", given.alias("uuid"),
                                                        given.alias("before"))
    return fill_uuid(customers, "uuid").agg(
        F.count("*").alias("n"), F.countDistinct("uuid").alias("filled"),
        F.count_if(F.length("uuid") == 36).alias("well_formed"),
        F.count_if(F.col("uuid") == F.col("before")).alias("kept"))


@query("""
SELECT o_orderkey,
       (SELECT max(p_partkey) FROM part) + 1
         + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id
FROM orders
""")
def key_allocation(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("id"))
    return allocate_ids(orders, parts, "id", ["o_orderdate", "o_orderkey"], gap=1,
                        unique=True).drop("o_orderdate")


@query("""
SELECT l_returnflag, l_linestatus, l_quantity,
       (SELECT max(p_partkey) FROM part)
         + row_number() OVER (ORDER BY l_quantity, l_returnflag, l_linestatus) AS id
FROM lineitem
""")
def key_allocation_copies(spark, folder):
    """Many identical rows, each with an id of its own."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("id"))
    return allocate_ids(lines, parts, "id", ["l_quantity"])


@query("""
SELECT l_orderkey, nullif(l_linenumber, 1) AS line, count(*) AS n FROM lineitem
WHERE nullif(l_linenumber, 1) IS NOT NULL GROUP BY ALL HAVING count(*) > 1
""")
def unique_check(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(1)).alias("line"))
    return check_unique(lines, ["l_orderkey", "line"])


@query("SELECT event_type, count(*) AS total FROM events GROUP BY event_type")
def action_counts(spark, folder):
    return count_actions(table(spark, folder, "events"), "event_type")


@query("""
SELECT l_returnflag, total, step, CAST(ceil(total / step) AS BIGINT) AS batches
FROM (SELECT l_returnflag, total, CASE WHEN total <= 100000 THEN 10000
             WHEN total <= 2500000 THEN 100000 ELSE 500000 END AS step
      FROM (SELECT l_returnflag, count(*) AS total FROM lineitem GROUP BY 1))
""")
def import_plan_by_flag(spark, folder):
    return import_plan(table(spark, folder, "lineitem"), "l_returnflag")


@query("""
SELECT o_orderkey, CASE WHEN t <= 100000 THEN 10000 WHEN t <= 2500000 THEN 100000
                        WHEN t > 2500000 THEN 500000 END AS step
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 10 END AS t FROM orders)
""")
def import_steps(spark, folder):
    total = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * 10)
    return table(spark, folder, "orders").select("o_orderkey", import_step(total).alias("step"))


@query("""
SELECT o_orderkey AS left_id, o_orderkey AS right_id, a AS left_value, b AS right_value
FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS a,
             CASE WHEN o_totalprice > 300000 THEN 'changed' ELSE o_orderpriority END AS b
      FROM orders)
WHERE a IS DISTINCT FROM b
""")
def diff_list(spark, folder):
    orders = table(spark, folder, "orders")
    left = orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("v"))
    right = orders.select(F.col("o_orderkey").alias("k"), F.when(
        F.col("o_totalprice") > 300000, "changed").otherwise(F.col("o_orderpriority")).alias("v"))
    return diff_report(left, right, [("o_orderkey", "k")], "v", {
        "left_id": F.col("left.o_orderkey"), "right_id": F.col("right.k"),
        "left_value": F.col("left.v"), "right_value": F.col("right.v")})
