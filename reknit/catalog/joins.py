"""Anti joins, lookups and updates from other tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.functions.documents import json_typed
from reknit.operators.joins import (
    keep_absent, keep_absent_any, keep_not_in, keep_present, lookup, one_per_key, scalar_lookup,
    translate_codes, translate_ids, update_from)


def numbered_name(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 9, "0"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem AS l
WHERE l_returnflag = 'N' AND NOT EXISTS (
  SELECT 1 FROM lineitem AS r
  WHERE r.l_returnflag = 'R' AND r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey)
""")
def anti_join_composite(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    returned = lines.filter("l_returnflag = 'R'")
    return keep_absent(lines.filter("l_returnflag = 'N'"), returned,
                       ["l_partkey", "l_suppkey"]).drop("l_returnflag")


@query("""
WITH words AS (
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN chr(0) WHEN 1 THEN '' WHEN 2 THEN NULL
                    ELSE lower(c_mktsegment) END AS word FROM customer)
SELECT c_custkey, length(word) AS n FROM words
WHERE NOT EXISTS (SELECT 1 FROM customer c
                  WHERE lower(nullif(c.c_mktsegment, 'BUILDING')) = words.word)
""")
def anti_join_missing_texts(spark, folder):
    """Against computed keys, some of them NULL: NUL and empty texts are texts like others."""
    customers, key = table(spark, folder, "customer"), F.col("c_custkey")
    word = (F.when(key % 4 == 0, F.lit("\0")).when(key % 4 == 1, F.lit(""))
            .when(key % 4 == 3, F.lower("c_mktsegment")))
    left = customers.select("c_custkey", word.alias("word"))
    given = F.lower(F.nullif("c_mktsegment", F.lit("BUILDING")))
    return keep_absent(left, customers, [("word", given)]).select(
        "c_custkey", F.length("word").cast("long").alias("n"))


@query("""
SELECT c.c_custkey, c.c_name
FROM customer c LEFT JOIN orders o
  ON o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F'
WHERE o.o_orderkey IS NULL
""")
def left_is_null(spark, folder):
    urgent = table(spark, folder, "orders").filter(
        "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return keep_absent(customers, urgent, [("c_custkey", "o_custkey")])


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM supplier
  WHERE upper('customer#' || lpad(CAST(s_suppkey * 7 AS VARCHAR), 9, '0')) = upper(c_name)
     OR s_suppkey = c_custkey)
""")
def anti_join_or(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", numbered_name("customer#", F.col("s_suppkey") * 7).alias("name"))
    return keep_absent_any(customers, suppliers, [("c_custkey", "s_suppkey")],
                           [(F.upper("c_name"), F.upper("name"))])


@query("""
SELECT 'plain' AS list, c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL
SELECT 'with null', c_custkey FROM customer
WHERE c_custkey NOT IN (
  SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey END FROM orders
  WHERE o_orderpriority = '1-URGENT')
UNION ALL
SELECT 'empty', c_custkey FROM customer
WHERE nullif(c_custkey, 7) NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = 'none')
""")
def not_in_null_aware(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey")
    orders = table(spark, folder, "orders")
    urgent = orders.filter("o_orderpriority = '1-URGENT'")
    nullable = urgent.select(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("k"))
    parts = {
        "plain": keep_not_in(customers, urgent, [("c_custkey", "o_custkey")]),
        "with null": keep_not_in(customers, nullable, [("c_custkey", "k")]),
        "empty": keep_not_in(customers, orders.filter("o_orderpriority = 'none'"),
                             [(F.nullif("c_custkey", F.lit(7)), "o_custkey")]),
    }
    first, *rest = [df.select(F.lit(name).alias("list"), "c_custkey")
                    for name, df in parts.items()]
    for df in rest:
        first = first.union(df)
    return first


@query("""
SELECT c_custkey, coalesce(s_name, c_name) AS c_name,
       CASE WHEN s_name IS NULL THEN c_acctbal ELSE c_acctbal + s_acctbal END AS c_acctbal,
       c_mktsegment
FROM customer LEFT JOIN (
  SELECT s_nationkey, s_name, s_acctbal,
         row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n
  FROM supplier) ON s_nationkey = c_nationkey AND n = 1 AND c_mktsegment <> 'BUILDING'
""")
def update_from_first_match(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    suppliers = table(spark, folder, "supplier")
    return update_from(
        customers, suppliers, [("c_nationkey", "s_nationkey")],
        {"c_name": F.col("source.s_name"),
         "c_acctbal": F.col("target.c_acctbal") + F.col("source.s_acctbal")},
        order=["s_suppkey"], where=F.col("target.c_mktsegment") != "BUILDING",
    ).drop("c_nationkey")


@query("""
SELECT o_orderkey, c1.c_custkey AS by_name, c2.k AS by_balance
FROM orders
LEFT JOIN customer c1 ON c1.c_name = 'Customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0')
LEFT JOIN (SELECT c_mktsegment, c_nationkey, min(c_custkey) AS k FROM customer GROUP BY ALL) c2
  ON c2.c_nationkey = o_custkey % 30 AND c2.c_mktsegment = 'BUILDING'
""")
def dimension_lookup(spark, folder):
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    name = numbered_name("Customer#", F.col("o_custkey") * 2)
    found = lookup(orders, customers, [(name, "c_name")], "c_custkey", "by_name")
    found = lookup(found, customers, [(F.col("o_custkey") % 30, "c_nationkey"),
                                      (F.lit("BUILDING"), "c_mktsegment")],
                   "c_custkey", "by_balance")
    return found.drop("o_custkey")


@query("""
SELECT o_orderkey, o_custkey,
       (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY') AS first_machinery,
       (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'none') AS nobody
FROM orders
""")
def scalar_lookups(spark, folder):
    customers = table(spark, folder, "customer")
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey",
        scalar_lookup(customers, F.col("c_mktsegment") == "MACHINERY", "c_custkey")
        .alias("first_machinery"),
        scalar_lookup(customers, F.col("c_mktsegment") == "none", "c_custkey").alias("nobody"))


@query("""
SELECT l_orderkey, l_linenumber, n_name AS word
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
""")
def translated_codes(spark, folder):
    """Supplier keys of order lines replaced by the supplier's nation."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("word"))
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    mapping = table(spark, folder, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("code"), "n_name")
    return translate_codes(lines, mapping, "word", "code", "n_name")


@query("""
SELECT t.o_orderkey + 1000000 AS o_orderkey, l_linenumber, l_partkey
FROM lineitem JOIN orders s ON s.o_orderkey = l_orderkey
JOIN orders t ON md5(CAST(t.o_orderkey AS VARCHAR)) = md5(CAST(s.o_orderkey AS VARCHAR))
WHERE t.o_orderstatus = 'F'
""")
def translated_ids(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.md5(F.col("o_orderkey").cast("string")).alias("uuid"))
    targets = orders.filter("o_orderstatus = 'F'").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1000000)
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    return translate_ids(lines, orders, targets, "o_orderkey", "uuid")


@query("""
SELECT event_id, props FROM events WHERE EXISTS (
  SELECT 1 FROM customer
  WHERE json_extract(CASE WHEN c_custkey % 2 = 0 THEN '{"k":' || c_custkey || '}'
                          ELSE '{"k":"' || c_custkey || '"}' END, '$.k')
        = json_extract(props, '$.k'))
""")
def json_typed_join(spark, folder):
    """Numbers and texts differ: only even customers carry a number, written in three ways."""
    key = F.col("c_custkey")
    written = F.when(key % 6 == 0, F.concat(key.cast("string"), F.lit(".0"))).when(
        key % 6 == 2, F.concat((key / 10).cast("decimal(38,1)").cast("string"), F.lit("e1"))
    ).otherwise(key.cast("string"))
    customers = table(spark, folder, "customer").select(
        F.when(key % 2 == 0, F.concat(F.lit('{"k":'), written, F.lit("}")))
        .otherwise(F.to_json(F.struct(key.cast("string").alias("k")))).alias("doc"))
    events = table(spark, folder, "events").select("event_id", "props")
    return keep_present(events, customers, [(json_typed("props", "k"), json_typed("doc", "k"))])


@query("""
SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_partkey
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS n
      FROM lineitem) WHERE n = 1
""")
def distinct_on(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    return one_per_key(lines, ["l_partkey"], ["l_shipdate"]).drop("l_shipdate")
