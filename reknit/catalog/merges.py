"""Merging: blocks of ten customers are taken to be one customer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.operators.merge import (
    KeyRule, LinkRule, MergeSpec, apply_merges, diagnose_self_parent, drop_entities, merge_fk,
    merge_links, resolve_requests)
from reknit.plans.merge_entities import merge_from_file
from reknit.session import scratch_path
from reknit.sources.publish import read_published

# The steps of the second round of requests come after those of the first.
LATER = 1_000_000_000_000


def first_of_block(block: int) -> Column:
    return F.expr(f"c_custkey div {block} * {block}")


def block_requests(customers: DataFrame, block: int = 10, offset: int = 0) -> DataFrame:
    """Each customer goes to the first one of its block."""
    return (customers.select((F.col("c_custkey") + offset).alias("step"),
                             F.col("c_custkey").alias("old_id"),
                             first_of_block(block).alias("new_id"))
            .filter("old_id <> new_id"))


def chained_requests(customers: DataFrame) -> DataFrame:
    """Customers go to the first of their ten, these later to the first of their hundred."""
    survivors = customers.select(first_of_block(10).alias("c_custkey")).distinct()
    return block_requests(customers).union(block_requests(survivors, 100, LATER))


MAP = """
WITH map AS (
  SELECT c_custkey AS id, c_custkey // 10 * 10 AS survivor,
         CASE WHEN c_custkey = c_custkey // 10 * 10 THEN -1 ELSE c_custkey END AS prio
  FROM customer)
"""


@query(MAP + """
, ranked AS (
  SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey, o_orderpriority,
         rank() OVER (PARTITION BY coalesce(survivor, o_custkey), o_orderpriority
                      ORDER BY coalesce(prio, -1)) AS r
  FROM orders LEFT JOIN map ON id = o_custkey)
SELECT o_orderkey, o_custkey, o_orderpriority FROM ranked WHERE r = 1
""")
def merge_links_by_priority(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    keymap = resolve_requests(block_requests(table(spark, folder, "customer")))
    return merge_links(orders, "o_custkey", ["o_orderpriority"], keymap)


@query(MAP + """
, linked AS (
  SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey,
         nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus, coalesce(prio, -1) AS prio
  FROM orders LEFT JOIN map ON id = o_custkey),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY o_custkey, priority, o_orderstatus ORDER BY prio) AS r
  FROM linked)
SELECT o_orderkey, o_custkey, priority, o_orderstatus FROM ranked WHERE r = 1 OR priority IS NULL
""")
def merge_links_nulls(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        "o_orderstatus")
    keymap = resolve_requests(block_requests(table(spark, folder, "customer")))
    return merge_links(orders, "o_custkey", ["priority", "o_orderstatus"], keymap)


@query("""
WITH map AS (
  SELECT c_custkey AS id, hundred AS survivor,
         CASE WHEN c_custkey = hundred THEN []
              WHEN c_custkey = ten THEN [1000000000000 + c_custkey]
              WHEN ten = hundred THEN [c_custkey]
              ELSE [1000000000000 + ten, c_custkey] END AS prio
  FROM (SELECT c_custkey, c_custkey // 10 * 10 AS ten, c_custkey // 100 * 100 AS hundred
        FROM customer)),
ranked AS (
  SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey, o_orderpriority,
         rank() OVER (PARTITION BY coalesce(survivor, o_custkey), o_orderpriority
                      ORDER BY coalesce(prio, [])) AS r
  FROM orders LEFT JOIN map ON id = o_custkey)
SELECT o_orderkey, o_custkey, o_orderpriority FROM ranked WHERE r = 1
""")
def merge_links_chain(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    keymap = resolve_requests(chained_requests(table(spark, folder, "customer")))
    return merge_links(orders, "o_custkey", ["o_orderpriority"], keymap)


@query(MAP + """
SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey, o_totalprice
FROM orders LEFT JOIN map ON id = o_custkey
""")
def merge_foreign_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    keymap = resolve_requests(block_requests(table(spark, folder, "customer")))
    return merge_fk(orders, "o_custkey", keymap)


@query("SELECT * FROM customer WHERE c_custkey = c_custkey // 10 * 10")
def drop_merged_entities(spark, folder):
    customers = table(spark, folder, "customer")
    return drop_entities(customers, "c_custkey", resolve_requests(block_requests(customers)))


def _merged_snapshot(spark, folder):
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    spec = MergeSpec(
        "customer", "c_custkey",
        links=[LinkRule("contacts", "o_custkey", ("o_orderstatus", "o_orderpriority")),
               LinkRule("absent", "o_custkey", ("o_orderstatus",), optional=True)],
        keys=[KeyRule("orders", "o_custkey")])
    snapshot = {"customer": customers, "orders": orders.select("o_orderkey", "o_custkey"),
                "contacts": orders.select("o_custkey", "o_orderstatus", "o_orderpriority")}
    return apply_merges(snapshot, spec, block_requests(customers))


@query(MAP + """
, o AS (SELECT coalesce(survivor, o_custkey) AS k FROM orders LEFT JOIN map ON id = o_custkey),
linked AS (
  SELECT coalesce(survivor, o_custkey) AS k,
         rank() OVER (PARTITION BY coalesce(survivor, o_custkey), o_orderstatus, o_orderpriority
                      ORDER BY coalesce(prio, -1)) AS r
  FROM orders LEFT JOIN map ON id = o_custkey)
SELECT 'customer' AS name, count(*) AS n, count(DISTINCT c_custkey) AS ids
FROM customer WHERE c_custkey = c_custkey // 10 * 10
UNION ALL SELECT 'orders', count(*), count(DISTINCT k) FROM o
UNION ALL SELECT 'contacts', count(*), count(DISTINCT k) FROM linked WHERE r = 1
""")
def merge_snapshot_counts(spark, folder):
    merged = _merged_snapshot(spark, folder)
    counts = [merged[name].agg(F.count("*").alias("n"), F.countDistinct(key).alias("ids"))
              .select(F.lit(name).alias("name"), "n", "ids")
              for name, key in (("customer", "c_custkey"), ("orders", "o_custkey"),
                                ("contacts", "o_custkey"))]
    return counts[0].union(counts[1]).union(counts[2])


@query(MAP + """
, linked AS (
  SELECT coalesce(survivor, o_custkey) AS k, o_orderstatus, o_orderpriority,
         rank() OVER (PARTITION BY coalesce(survivor, o_custkey), o_orderstatus, o_orderpriority
                      ORDER BY coalesce(prio, -1)) AS r
  FROM orders LEFT JOIN map ON id = o_custkey)
SELECT 'customer' AS name, c_custkey AS id, c_name AS a, c_mktsegment AS b
FROM customer WHERE c_custkey = c_custkey // 10 * 10
UNION ALL SELECT 'orders', coalesce(survivor, o_custkey), o_orderkey::VARCHAR, NULL
FROM orders LEFT JOIN map ON id = o_custkey
UNION ALL SELECT 'contacts', k, o_orderstatus, o_orderpriority FROM linked WHERE r = 1
""")
def merge_snapshot_rows(spark, folder):
    """The merged tables themselves, below each other."""
    merged = _merged_snapshot(spark, folder)
    columns = {"customer": ("c_custkey", F.col("c_name"), F.col("c_mktsegment")),
               "orders": ("o_custkey", F.col("o_orderkey").cast("string"), F.lit(None)),
               "contacts": ("o_custkey", F.col("o_orderstatus"), F.col("o_orderpriority"))}
    return reduce(DataFrame.union, [
        merged[name].select(F.lit(name).alias("name"), F.col(key).alias("id"), one.alias("a"),
                            other.cast("string").alias("b"))
        for name, (key, one, other) in columns.items()])



@query(MAP + """
SELECT coalesce(survivor, o_custkey) AS c_custkey, count(*) AS lines,
       count(DISTINCT o_orderkey) AS orders,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM orders LEFT JOIN map ON id = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY 1
""")
def merged_customer_lines(spark, folder):
    """Order lines per customer once duplicate customers are one."""
    orders = merge_foreign_key(spark, folder)
    # Lines are summed per order before they meet the orders.
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("units"))
    return (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.sum("lines").alias("lines"), F.count("*").alias("orders"),
                 F.sum("units").alias("units")))


@query(MAP + """
, ranked AS (
  SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey, o_orderstatus,
         rank() OVER (PARTITION BY coalesce(survivor, o_custkey), o_orderstatus
                      ORDER BY coalesce(prio, -1)) AS r
  FROM orders LEFT JOIN map ON id = o_custkey)
SELECT o_orderkey, o_custkey, o_orderstatus, c_name
FROM ranked JOIN customer ON c_custkey = o_custkey WHERE r = 1
""")
def merge_from_request_file(spark, folder):
    """A request file applied to a snapshot, published, and read back."""
    path, root = scratch_path(spark, "requests"), scratch_path(spark, "merged")
    customers = table(spark, folder, "customer")
    (block_requests(customers).repartitionByRange("step").sortWithinPartitions("step")
     .select(F.col("new_id").alias("id"), F.col("old_id").alias("id_duplicates"))
     .write.csv(path, sep="\t", header=True))
    spec = MergeSpec("customer", "c_custkey",
                     links=[LinkRule("orders", "o_custkey", ("o_orderstatus",))])
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    merge_from_file(spark, {"customer": customers, "orders": orders}, spec, path, root)
    merged = read_published(spark, root)
    return (merged["orders"].join(merged["customer"], F.col("c_custkey") == F.col("o_custkey"))
            .select("o_orderkey", "o_custkey", "o_orderstatus", "c_name"))


@query("""
WITH merged AS (
  SELECT c_custkey, (c_custkey + 1) // 10 * 10 AS parent
  FROM customer WHERE c_custkey = c_custkey // 10 * 10)
SELECT c_custkey, parent FROM merged WHERE c_custkey = parent
""")
def own_parents(spark, folder):
    """Customers whose parent, the next customer, was merged into them."""
    customers = table(spark, folder, "customer")
    keymap = resolve_requests(block_requests(customers))
    hierarchy = customers.select("c_custkey", (F.col("c_custkey") + 1).alias("parent"))
    merged = drop_entities(merge_fk(hierarchy, "parent", keymap), "c_custkey", keymap)
    return diagnose_self_parent(merged, "c_custkey", "parent")
