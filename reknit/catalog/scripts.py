"""Single steps of the scripts: arguments, staging, conditions with NULLs, lookups of one row."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.operators import quality
from reknit.operators.merge import merge_fk, resolve_requests
from reknit.operators.people import assign_group
from reknit.plans import taxon_lists
from reknit.plans.reconcile_partner import group_by_name, organism_by_uuid
from reknit.sources.requests import merge_requests
from reknit.sources.tables import stage


@query("""
SELECT o_orderkey, c_custkey,
       CASE WHEN c_nationkey IN (5, 14, 15) THEN 0 WHEN c_nationkey IN (2, 3) THEN 1
            WHEN c_nationkey = 24 THEN 17 ELSE c_nationkey END AS c_nationkey
FROM orders JOIN customer ON c_custkey = o_custkey
""")
def requests_from_arguments(spark, folder):
    """Nations merged as on a command line, in the orders of their customers."""
    arguments = [(0, "5, 14,15"), (1, " 2, 3"), (17, "24")]
    keymap = resolve_requests(merge_requests(spark, arguments))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return orders.join(merge_fk(customers, "c_nationkey", keymap),
                       F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def staged_orders(spark, folder):
    """A table under a name of the session, read by SQL."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    stage(orders, "staged_orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM staged_orders WHERE o_orderstatus = 'F'")


PEOPLE = """
  SELECT c_custkey AS id, nullif(c_mktsegment, 'BUILDING') AS pass,
         nullif(c_nationkey, 3) AS other,
         CASE c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS active
  FROM customer
"""


def people(spark, folder):
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("id_role"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("pass"),
        F.nullif("c_nationkey", F.lit(3)).cast("string").alias("pass_plus"),
        F.when(key % 3 == 0, True).when(key % 3 == 1, False).alias("active"))


@query(f"""
WITH people AS ({PEOPLE})
SELECT 1::BIGINT AS id_role_groupe, id AS id_role_utilisateur FROM people
WHERE coalesce(pass, other::VARCHAR) IS NULL AND active IS TRUE
UNION ALL SELECT 2, id FROM people WHERE coalesce(pass, other::VARCHAR) IS NOT NULL AND active IS TRUE
""")
def active_people_by_password(spark, folder):
    """Groups by COALESCE … IS NULL and IS TRUE: unknown activity counts as none."""
    roles = people(spark, folder)
    links = roles.select(F.lit(None).cast("long").alias("id_role_groupe"),
                         F.col("id_role").alias("id_role_utilisateur")).limit(0)
    password, active = F.coalesce("pass", "pass_plus"), F.col("active").eqNullSafe(True)
    links = assign_group(roles, links, 1, password.isNull() & active)
    return assign_group(roles, links, 2, password.isNotNull() & active)


@query("""
SELECT l.l_orderkey, l.l_linenumber, r.l_orderkey AS other_order, r.l_linenumber AS other_line
FROM lineitem l JOIN lineitem r ON r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey
WHERE l.l_returnflag = 'R' AND r.l_returnflag = 'A'
""")
def joined_on_two_columns(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag")
    others = lines.filter("l_returnflag = 'A'").select(
        "l_partkey", "l_suppkey", F.col("l_orderkey").alias("other_order"),
        F.col("l_linenumber").alias("other_line"))
    return (lines.filter("l_returnflag = 'R'").join(others, ["l_partkey", "l_suppkey"])
            .select("l_orderkey", "l_linenumber", "other_order", "other_line"))


@query("""
SELECT n_nationkey,
       (SELECT min(s_suppkey) FROM supplier WHERE md5(s_name) = md5('Supplier#000000003')) AS organism,
       (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 0)
         AS people,
       (SELECT min(s_suppkey) FROM supplier WHERE md5(s_name) = 'none') AS missing
FROM nation
""")
def rows_by_uuid_and_name(spark, folder):
    """Scalar lookups: an organism by its UUID, a group (and no person) by its name."""
    organisms = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id_organisme"), F.md5("s_name").alias("uuid_organisme"))
    roles = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_role"), F.col("c_mktsegment").alias("nom_role"),
        (F.col("c_custkey") % 2 == 0).alias("groupe"))
    # The UUID of a stated name, as a script would hold it.
    uuid = hashlib.md5(b"Supplier#000000003").hexdigest()
    return table(spark, folder, "nation").select(
        "n_nationkey", organism_by_uuid(organisms, uuid).alias("organism"),
        group_by_name(roles, "MACHINERY").alias("people"),
        organism_by_uuid(organisms, "none").alias("missing"))


@query("""
SELECT a AS action, count(o_orderkey) AS total
FROM (VALUES ('F'), ('O'), ('none')) AS actions(a) LEFT JOIN orders ON o_orderstatus = a GROUP BY a
""")
def import_totals(spark, folder):
    """Rows of an import table per last action asked for."""
    orders = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("meta_last_action"))
    return quality.import_totals(orders, ["F", "O", "none"])


@query("""
WITH taxa AS (SELECT p_partkey, p_size FROM part WHERE p_type = 'SMALL'),
     names AS (SELECT p_partkey AS cd_nom, p_size AS cd_ref FROM part WHERE p_partkey % 2 = 0)
SELECT p_partkey AS cd_nom, p_size::BIGINT AS cd_ref, 'Added for SMALL list - 2024-02-29' AS comments
FROM taxa WHERE p_partkey % 2 = 1
UNION ALL SELECT cd_nom, cd_ref::BIGINT, NULL FROM names
""")
def names_of_a_list(spark, folder):
    """A list of all taxa of a kind, with the day of the run as a parameter."""
    parts = table(spark, folder, "part")
    taxa = parts.select(F.col("p_partkey").alias("cd_nom"), F.col("p_size").cast("long").alias("cd_ref"),
                        F.col("p_type").alias("regne"))
    names = taxa.filter("cd_nom % 2 = 0").select(
        F.col("cd_nom").alias("id_nom"), "cd_nom", "cd_ref",
        F.lit(None).cast("string").alias("comments"))
    lists = parts.limit(0).select(F.col("p_partkey").alias("id_liste"),
                                  F.col("p_name").alias("code_liste"))
    links = parts.limit(0).select(F.col("p_partkey").alias("id_liste"),
                                  F.col("p_partkey").alias("id_nom"))
    row = parts.agg(F.lit("SMALL").alias("code_liste"))
    done = taxon_lists.add_kingdom_list(
        {taxon_lists.TAXREF: taxa, taxon_lists.NAMES: names, taxon_lists.LISTS: lists,
         taxon_lists.LIST_NAMES: links}, row, "SMALL", "SMALL", date(2024, 2, 29))
    return done[taxon_lists.NAMES].select("cd_nom", "cd_ref", "comments")
