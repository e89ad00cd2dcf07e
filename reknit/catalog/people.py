"""Organisms, their people and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.catalog.joins import numbered_name
from reknit.operators.people import (
    assign_group, has_password, lacks_password, migrate_organisms, migrate_roles)

GROUPS = (10000, 10001)


def _links(spark, folder):
    """Two of the five priorities stand for the two groups."""
    priority = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.when(priority == "1-URGENT", 10000).when(priority == "2-HIGH", 10001).otherwise(3)
        .alias("id_role_groupe"), F.col("o_custkey").alias("id_role_utilisateur"))


def _roles(spark, folder):
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_role"), F.lit(False).alias("groupe"),
        F.when(segment != "BUILDING", segment).otherwise("").alias("identifiant"),
        F.col("c_name").alias("nom_role"),
        F.nullif(segment, F.lit("FURNITURE")).alias("prenom_role"), F.lit("").alias("desc_role"),
        F.when(segment == "MACHINERY", "x").otherwise("").alias("pass"),
        F.concat("c_name", F.lit("@example.org")).alias("email"),
        F.floor(F.abs("c_acctbal") / 50).alias("id_organisme"))


LINKS = """
links AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 10000 WHEN '2-HIGH' THEN 10001 ELSE 3 END
           AS id_role_groupe, o_custkey AS id_role_utilisateur FROM orders)
"""


@query(f"""
WITH {LINKS},
organisms AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey FROM supplier),
target AS (
  SELECT p_partkey * 3 AS id, 'SUPPLIER#' || lpad(CAST(p_partkey * 5 AS VARCHAR), 9, '0') AS name
  FROM part)
SELECT id AS id_organisme, name AS nom_organisme, NULL AS ville_organisme, NULL AS tel_organisme
FROM target
UNION ALL
SELECT DISTINCT o.id, o.name, CASE WHEN s_nationkey < 5 THEN NULL ELSE 'LYON' END,
       '04 ' || substr(n, 1, 2) || ' ' || substr(n, 3, 2) || ' ' || substr(n, 5, 2) || ' '
             || substr(n, 7, 2)
FROM (SELECT *, lpad(CAST(id AS VARCHAR), 8, '0') AS n FROM organisms) AS o
JOIN customer ON CAST(floor(abs(c_acctbal) / 50) AS BIGINT) = o.id
JOIN links ON id_role_utilisateur = c_custkey
WHERE id_role_groupe IN (10000, 10001) AND NOT EXISTS (
  SELECT 1 FROM target WHERE target.id = o.id OR upper(target.name) = upper(o.name))
""")
def migrated_organisms(spark, folder):
    key = F.col("s_suppkey")
    organisms = table(spark, folder, "supplier").select(
        key.alias("id_organisme"), F.col("s_name").alias("nom_organisme"),
        F.lit("").alias("adresse_organisme"), F.lit("").alias("cp_organisme"),
        F.when(F.col("s_nationkey") < 5, "").otherwise("Lyon").alias("ville_organisme"),
        F.concat(F.lit(" 04"), F.lpad(key.cast("string"), 8, "0")).alias("tel_organisme"),
        F.lit(" ").alias("fax_organisme"), F.lit("").alias("email_organisme"))
    part = F.col("p_partkey")
    target = table(spark, folder, "part").select(
        (part * 3).alias("id_organisme"), numbered_name("SUPPLIER#", part * 5).alias("nom_organisme"),
        *[F.lit(None).cast("string").alias(f"{name}_organisme")
          for name in ("adresse", "cp", "ville", "tel", "fax", "email", "url")])
    migrated = migrate_organisms(organisms, _roles(spark, folder), _links(spark, folder), target,
                                 GROUPS)
    return migrated.select("id_organisme", "nom_organisme", "ville_organisme", "tel_organisme")


@query(f"""
WITH {LINKS},
roles AS (
  SELECT c_custkey AS id_role, c_name, c_mktsegment AS s, nullif(c_mktsegment, 'FURNITURE') AS first
  FROM customer),
target AS (
  SELECT s_suppkey * 3 AS id_role,
         'CUSTOMER#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS last, 'machinery' AS first
  FROM supplier)
SELECT id_role, last AS nom_role, first AS prenom_role, NULL AS identifiant, NULL AS pass,
       NULL AS remarques
FROM target
UNION ALL
SELECT DISTINCT id_role, upper(c_name), first, CASE WHEN s <> 'BUILDING' THEN s END,
       CASE WHEN s = 'MACHINERY' THEN 'x' END, 'imported'
FROM roles LEFT JOIN links ON id_role_utilisateur = id_role
WHERE (id_role_groupe IN (10000, 10001) OR id_role IN (10000, 10001)) AND NOT EXISTS (
  SELECT 1 FROM target
  WHERE (upper(target.last) = upper(c_name) AND upper(target.first) = upper(roles.first))
     OR target.id_role = roles.id_role)
""")
def migrated_roles(spark, folder):
    roles = _roles(spark, folder)
    key = F.col("s_suppkey")
    target = table(spark, folder, "supplier").select(
        (key * 3).alias("id_role"), numbered_name("CUSTOMER#", key).alias("nom_role"),
        F.lit("machinery").alias("prenom_role"), F.lit(True).alias("active"),
        F.lit(False).alias("groupe"), F.lit(1).cast("long").alias("id_organisme"),
        *[F.lit(None).cast("string").alias(name)
          for name in ("identifiant", "desc_role", "pass", "email", "remarques")])
    migrated = migrate_roles(roles, _links(spark, folder), target, GROUPS, "imported")
    return migrated.select("id_role", "nom_role", "prenom_role", "identifiant", "pass", "remarques")


@query("""
SELECT 10000 AS id_role_groupe, c_custkey AS id_role_utilisateur FROM customer
WHERE nullif(c_mktsegment, 'BUILDING') IS NOT NULL
UNION ALL
SELECT 10001, c_custkey FROM customer
WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY'
""")
def password_groups(spark, folder):
    """An empty password counts as one and as none."""
    segment = F.col("c_mktsegment")
    roles = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_role"),
        F.when(segment == "MACHINERY", "").when(segment != "BUILDING", "x").alias("pass"))
    links = spark.createDataFrame([], "id_role_groupe int, id_role_utilisateur long")
    links = assign_group(roles, links, 10000, has_password())
    return assign_group(roles, links, 10001, lacks_password())


@query(f"""
WITH {LINKS}
SELECT id_role_groupe, id_role_utilisateur FROM links WHERE id_role_groupe = 10000
UNION ALL
SELECT 7, c_custkey FROM customer WHERE c_acctbal > 0
  AND c_custkey NOT IN (SELECT id_role_utilisateur FROM links WHERE id_role_groupe = 10000)
""")
def group_of_ungrouped(spark, folder):
    links = _links(spark, folder).filter("id_role_groupe = 10000")
    roles = table(spark, folder, "customer").select(F.col("c_custkey").alias("id_role"), "c_acctbal")
    return assign_group(roles, links, 7, F.col("c_acctbal") > 0, only_ungrouped=True)
