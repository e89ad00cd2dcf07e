"""Inserting what is missing, overwriting what is shared, seeding, lists of names."""

from __future__ import annotations

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.catalog.joins import numbered_name
from reknit.functions.documents import json_object, json_typed
from reknit.operators.seed import Reference, Seed, grants, seed_metadata, unresolved
from reknit.operators.upsert import (
    add_to_list, insert_children, insert_ignore, insert_missing, overwrite_matched)


def _targets(spark, folder):
    """Suppliers, every other number, under the names of customers."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        numbered_name("Customer#", F.col("s_suppkey") * 2).alias("name"),
        F.col("s_acctbal").alias("balance"))


def _customers(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_name").alias("name"),
                                                   F.col("c_acctbal").alias("balance"))


TARGETS = """
  SELECT s_suppkey AS id, 'Customer#' || lpad(CAST(s_suppkey * 2 AS VARCHAR), 9, '0') AS name,
         s_acctbal AS balance
  FROM supplier
"""


@query(f"""
WITH target AS ({TARGETS})
SELECT id, name, balance FROM target
UNION ALL
SELECT (SELECT max(id) FROM target) + row_number() OVER (ORDER BY c_name), c_name, c_acctbal
FROM customer WHERE NOT EXISTS (SELECT 1 FROM target WHERE name = c_name)
""")
def insert_missing_rows(spark, folder):
    return insert_missing(_targets(spark, folder), _customers(spark, folder), "name", id="id",
                          order=["name"], unique=True)


@query(f"SELECT id, nullif(name, 'Customer#000000002') AS name, balance FROM ({TARGETS})")
def insert_missing_null_aware(spark, folder):
    """One unnamed target row lets nothing in."""
    target = _targets(spark, folder).withColumn(
        "name", F.nullif("name", F.lit("Customer#000000002")))
    return insert_missing(target, _customers(spark, folder), "name", null_aware=True, id="id",
                          order=["name"])


@query("""
WITH partner AS (
  SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN '{"index":' || c_custkey || '}'
                         ELSE '{"index":"' || c_custkey || '"}' END AS doc FROM customer)
SELECT o_orderkey AS id, '{"index":' || o_custkey || '}' AS doc, o_orderstatus AS origin FROM orders
UNION ALL
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY doc), doc, NULL
FROM partner WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderstatus = 'F'
    AND json_extract('{"index":' || o_custkey || '}', '$.index') = json_extract(doc, '$.index'))
""")
def insert_missing_parents(spark, folder):
    """Parents matched on a typed JSON index, among the target rows of one origin."""
    key = F.col("c_custkey")
    partner = table(spark, folder, "customer").select(
        F.when(F.col("c_nationkey") < 10, json_object(index=key))
        .otherwise(json_object(index=key.cast("string"))).alias("doc"))
    target = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), json_object(index="o_custkey").alias("doc"),
        F.col("o_orderstatus").alias("origin"))
    index = json_typed("doc", "index")
    return insert_missing(target, partner, [(index, index)], among=F.col("origin") == "F",
                          id="id", order=["doc"])


@query("""
WITH dimension AS (
  SELECT l_returnflag, min(l_suppkey) AS id FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT o_orderkey + 1000000 AS parent, l_linenumber AS line, l_partkey AS part, id AS id_flag
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN dimension ON dimension.l_returnflag = lineitem.l_returnflag
WHERE o_orderstatus = 'F'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 2
""")
def insert_children_rows(spark, folder):
    """Lines under the finished orders, found by UUID, with a code looked up, added to others."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("parent"), "o_orderstatus",
        F.md5(F.col("o_orderkey").cast("string")).alias("uuid"))
    arrived = orders.filter("o_orderstatus = 'F'").withColumn("parent", F.col("parent") + 1000000)
    lines = table(spark, folder, "lineitem")
    dimension = lines.filter("l_returnflag <> 'N'").select("l_returnflag", "l_suppkey",
                                                           F.lit("FLAG").alias("kind"))
    children = lines.select(
        F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))
    target = lines.filter("l_linenumber = 2").select(
        F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("id_flag"))
    return insert_children(
        target, children, orders, arrived, "parent", "uuid",
        [(dimension, [(F.lit("FLAG"), "kind"), ("flag", "l_returnflag")], "l_suppkey", "id_flag")])


@query("""
WITH ranked AS (
  SELECT s_name, s_suppkey, s_acctbal, s_nationkey,
         row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n
  FROM supplier)
SELECT c_custkey, coalesce(s_name, c_name) AS c_name,
       CASE WHEN s_name IS NULL THEN NULL ELSE '{"partner":' || s_suppkey || '}' END AS doc
FROM (SELECT *, nullif(c_nationkey, 3) AS mail FROM customer)
LEFT JOIN ranked ON s_nationkey = mail AND n = 1
""")
def overwrite_shared(spark, folder):
    """Shared by an address that may be missing, or repeat among the partner's rows."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("mail"),
        F.lit(None).cast("string").alias("doc"))
    partner = table(spark, folder, "supplier").select(
        "s_suppkey", "s_name", F.col("s_nationkey").alias("mail"),
        json_object(partner="s_suppkey").alias("doc"))
    return overwrite_matched(customers, partner, "mail", {
        "c_name": F.col("source.s_name"), "doc": F.col("source.doc")}, id="s_suppkey").drop("mail")


@query("""
WITH target AS (
  SELECT min(p_partkey) AS id, p_name, p_brand FROM part WHERE p_type = 'ECONOMY'
  GROUP BY p_name, p_brand),
new AS (
  SELECT p_name, p_brand FROM part EXCEPT SELECT p_name, p_brand FROM target)
SELECT id, p_name, p_brand FROM target
UNION ALL
SELECT (SELECT max(id) FROM target) + row_number() OVER (ORDER BY p_name, p_brand), p_name, p_brand
FROM new
""")
def insert_if_absent(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    target = parts.filter("p_type = 'ECONOMY'").groupBy("p_name", "p_brand").agg(
        F.min("p_partkey").alias("id")).select("id", "p_name", "p_brand")
    return insert_ignore(target, parts.select("p_name", "p_brand"), ["p_name", "p_brand"], id="id",
                         order=["p_name", "p_brand"])


@query("""
SELECT s_suppkey AS id, NULL AS p_name, NULL AS p_brand FROM supplier
UNION ALL
SELECT min(p_partkey), p_name, p_brand FROM part
WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY p_name, p_brand
""")
def insert_under_two_keys(spark, folder):
    """Both the id and the name with its brand must be free."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand")
    target = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit(None).cast("string").alias("p_name"),
        F.lit(None).cast("string").alias("p_brand"))
    return insert_ignore(target, parts, ["id"], ["p_name", "p_brand"], order=["id"])


@query("""
SELECT k AS id, k // 2 AS a, CASE WHEN k % 8 < 7 THEN (k + 1) // 2 END AS b
FROM (SELECT p_partkey - (SELECT min(p_partkey) FROM part) AS k FROM part) WHERE k % 2 = 0
""")
def insert_along_chains(spark, folder):
    """Each row conflicts with the one before and the one after it, in runs of eight."""
    parts = table(spark, folder, "part")
    k = F.col("p_partkey") - parts.agg(F.min("p_partkey")).scalar()
    new = parts.select(k.alias("id")).select(
        "id", F.expr("id div 2").alias("a"),
        F.when(F.col("id") % 8 < 7, F.expr("(id + 1) div 2")).alias("b"))
    return insert_ignore(new.limit(0), new, ["a"], ["b"], order=["id"])


@query("""
SELECT l_suppkey AS list, l_partkey AS member FROM lineitem
UNION ALL
SELECT s_suppkey, p_partkey FROM part, supplier
WHERE p_type = 'ECONOMY' AND s_name = 'Supplier#000000007'
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_partkey = p_partkey)
""")
def list_membership(spark, folder):
    links = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("list"),
                                                    F.col("l_partkey").alias("member"))
    members = table(spark, folder, "part").filter("p_type = 'ECONOMY'").select(
        F.col("p_partkey").alias("member"))
    lists = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("list"), "s_name")
    return add_to_list(links, members, lists, "Supplier#000000007", "member", list_id="list",
                       code_column="s_name")


@query("""
WITH brand AS (
  SELECT row_number() OVER (ORDER BY p_brand) AS id, p_brand
  FROM (SELECT DISTINCT p_brand FROM part)),
item AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS id, id AS id_brand, p_partkey AS code
  FROM part JOIN brand ON brand.p_brand = part.p_brand)
SELECT item.id AS id_item, id_brand, l_suppkey AS actor
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) LEFT JOIN item ON code = l_partkey
""")
def seeded_chain(spark, folder):
    """Brands, then items of brands, then links to items: all named by codes, ids given here."""
    parts = table(spark, folder, "part")
    snapshot = {
        "brands": spark.createDataFrame([], "id long, p_brand string"),
        "items": spark.createDataFrame([], "id long, id_brand long, code long"),
        "links": spark.createDataFrame([], "id_item long, id_brand long, actor long"),
    }
    in_brands = Reference("id_brand", "brands", [("brand", "p_brand")], "id")
    in_items = Reference("id_item", "items", [("code", "code")], "id")
    brand_of = Reference("id_brand", "items", [("code", "code")], "id_brand")
    return seed_metadata(snapshot, [
        Seed("brands", parts.select("p_brand").distinct(), id="id"),
        Seed("items", parts.select(F.col("p_brand").alias("brand"),
                                   F.col("p_partkey").alias("code")),
             [in_brands], id="id", order=["code"]),
        Seed("links", table(spark, folder, "lineitem").select(
            F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("actor")).distinct(),
             [in_items, brand_of]),
    ])["links"]


@query("""
SELECT o_orderkey FROM orders
WHERE 'Customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') NOT IN (SELECT c_name FROM customer)
""")
def unresolved_names(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", numbered_name("Customer#", F.col("o_custkey") * 2).alias("name"))
    customers = {"customer": table(spark, folder, "customer")}
    return unresolved(rows, customers, [
        Reference("id", "customer", [("name", "c_name")], "c_custkey")]).select("o_orderkey")


@query("""
WITH modules AS (
  SELECT c_mktsegment, min(c_custkey) AS id FROM customer WHERE c_mktsegment <> 'BUILDING'
  GROUP BY 1)
SELECT c_custkey AS id_role, a.n AS id_action, CAST(c_nationkey AS BIGINT) AS id_filter,
       CASE WHEN c_acctbal < 0 THEN 0 ELSE modules.id END AS id_module, 1::BIGINT AS id_object
FROM customer CROSS JOIN (VALUES (1::BIGINT), (2), (3)) a(n)
LEFT JOIN modules ON modules.c_mktsegment = customer.c_mktsegment
""")
def grant_matrix(spark, folder):
    customers = table(spark, folder, "customer")
    rows = customers.select(
        F.col("c_custkey").alias("id_role"),
        F.explode(F.array(*[F.lit(n).cast("long") for n in (1, 2, 3)])).alias("id_action"),
        F.col("c_nationkey").cast("long").alias("id_filter"),
        F.when(F.col("c_acctbal") < 0, F.lit(0).cast("long")).alias("id_module"),
        F.col("c_mktsegment").alias("module_code"), F.lit(1).cast("long").alias("id_object"))
    modules = customers.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_mktsegment").alias("module_code"), F.col("c_custkey").alias("id_module"))
    return grants(rows, modules)
