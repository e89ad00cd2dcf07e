"""Link tables from lists of codes, ids and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.catalog.joins import numbered_name
from reknit.functions.documents import json_object, json_text
from reknit.operators.links import (
    codes_to_links, link_missing_observers, links_from_id_list, missing_links)
from reknit.sources.tables import values

# Second words of part names and the first words that stand for them.
WORDS = (("ring", "red"), ("widget", "small"), ("bolt", "blue"), ("gear", "red"))


@query("""
WITH listed AS (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part),
dimension AS (
  SELECT split_part(p_name, ' ', 1) AS code, p_size AS id FROM part GROUP BY ALL),
mapping(code, standard) AS (
  VALUES ('ring', 'red'), ('widget', 'small'), ('bolt', 'blue'), ('gear', 'red'))
SELECT p_partkey, id FROM listed JOIN dimension ON code = word
UNION
SELECT p_partkey, id FROM listed JOIN mapping m ON m.code = word
  JOIN dimension d ON d.code = m.standard
""")
def coded_links(spark, folder):
    """Codes that several dimension rows share, directly and through a mapping."""
    parts = table(spark, folder, "part")
    dimension = parts.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("code"),
                             F.col("p_size").alias("id")).distinct()
    lists = parts.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(", ")).alias("codes"))
    mapping = values(spark, WORDS, "source_code string, standard_code string")
    return codes_to_links(lists, "p_partkey", "codes", dimension, "code", "id", mapping)


@query("""
WITH listed AS (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part),
dimension AS (
  SELECT split_part(p_name, ' ', 1) AS code, min(p_partkey) AS id FROM part
  WHERE p_type = 'ECONOMY' GROUP BY 1)
SELECT DISTINCT p_partkey, id FROM listed JOIN dimension ON code = word
""")
def coded_links_of_type(spark, folder):
    parts = table(spark, folder, "part")
    dimension = parts.groupBy("p_type", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("code")
                              ).agg(F.min("p_partkey").alias("id"))
    lists = parts.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(",")).alias("codes"))
    return codes_to_links(lists, "p_partkey", "codes", dimension, "code", "id",
                          type_column="p_type", type_name="ECONOMY")


@query("""
WITH listed AS (
  SELECT l_orderkey, unnest([
    'supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0'),
    'eluesupplier#' || lpad(CAST(l_suppkey + 1 AS VARCHAR), 9, '0')]) AS name FROM lineitem),
people AS (
  SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'elue' END || lower(s_name) AS name
  FROM supplier),
missing AS (
  SELECT l_orderkey, name FROM listed
  EXCEPT
  SELECT l_orderkey, people.name FROM lineitem JOIN people ON s_suppkey = l_suppkey
  WHERE l_returnflag = 'R')
SELECT l_orderkey, s_suppkey FROM missing JOIN people ON people.name = missing.name
""")
def missing_name_links(spark, folder):
    """Lists of two names per order line; odd suppliers have a first name, all a remark."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    lists = lines.select("l_orderkey", F.concat(
        numbered_name("Supplier #", F.col("l_suppkey")), F.lit(", Élue "),
        numbered_name("Supplier#", F.col("l_suppkey") + 1)).alias("names"))
    people = table(spark, folder, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 2 == 1, "Élue").alias("first"),
        F.concat("s_name", F.lit(" (stagiaire)")).alias("last"))
    links = lines.filter("l_returnflag = 'R'").select(
        "l_orderkey", F.col("l_suppkey").alias("s_suppkey"))
    return missing_links(lists, "l_orderkey", "names", links, people, "s_suppkey", "first", "last")


@query("""
WITH listed AS (
  SELECT l_orderkey, unnest([l_suppkey, l_suppkey + 1]) AS id FROM lineitem
  WHERE l_linestatus = 'O')
SELECT o_orderkey + 1000000 AS id, id - 1 AS s_suppkey
FROM listed JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderstatus = 'F' AND id - 1 IN (SELECT s_suppkey FROM supplier)
""")
def listed_id_links(spark, folder):
    """Comma lists of ids that people keep in their documents, for the orders taken over."""
    lists = table(spark, folder, "lineitem").select(
        F.md5(F.col("l_orderkey").cast("string")).alias("uuid"),
        F.when(F.col("l_linestatus") == "O", F.concat_ws(
            ", ", F.col("l_suppkey").cast("string"), (F.col("l_suppkey") + 1).cast("string")))
        .alias("ids"))
    taken = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(
        (F.col("o_orderkey") + 1000000).alias("id"),
        F.md5(F.col("o_orderkey").cast("string")).alias("key"))
    people = table(spark, folder, "supplier").select(
        "s_suppkey", json_object(partner=F.col("s_suppkey") + 1).alias("doc"))
    return links_from_id_list(lists, "ids", "uuid", taken, "key", "id", people, "s_suppkey",
                              json_text("doc", "partner"))


@query("""
WITH zones AS (
  SELECT o_custkey AS id, 'supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS name
  FROM orders WHERE o_orderpriority <> '5-LOW'
    AND o_orderkey NOT IN (SELECT p_partkey FROM part)),
unknown AS (
  SELECT name, min(id) AS id FROM (
    SELECT id, name FROM zones UNION ALL SELECT id + 1, 'zoe' FROM zones)
  WHERE id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY name)
SELECT s_suppkey, s_name, CASE WHEN unknown.id IS NULL THEN '{"origin":1,"x":' || s_suppkey || '}'
       ELSE '{"origin":{"partner":' || unknown.id || '},"x":' || s_suppkey || '}' END AS doc
FROM supplier LEFT JOIN unknown ON unknown.name = lower(s_name)
""")
def listed_observers(spark, folder):
    """Ids found only in lists go to the people whose name stands beside them."""
    key = F.col("o_custkey")
    zones = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("index"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat_ws(
            ",", key.cast("string"), (key + 1).cast("string"))).alias("ids"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(
            numbered_name("Supplier #", key), F.lit(", Zoé"))).alias("names"))
    people = table(spark, folder, "supplier").select(
        "s_suppkey", "s_name", F.lit(None).cast("string").alias("first"),
        F.to_json(F.struct(F.lit(1).alias("origin"), F.col("s_suppkey").alias("x"))).alias("doc"))
    known = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("s_suppkey"))
    common = table(spark, folder, "part").select(F.col("p_partkey").alias("__index"))
    return link_missing_observers(
        people, known, zones, common, F.col("index"), "ids", "names", "s_suppkey", "first",
        "s_name", "doc", ["origin"], "partner").drop("first")
