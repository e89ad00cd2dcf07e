"""Files written from the test tables, read back by the sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.sources.publish import publish, read_published
from reknit.sources.requests import explode_requests, read_merge_requests
from reknit.sources.tables import (
    diff_schema, read_diff_csv, read_import_batch, read_tables, write_import_batch)
from reknit.session import scratch_path


@query("""
SELECT l_orderkey, l_linenumber, position, l_orderkey AS new_id,
       CASE position WHEN 0 THEN l_partkey ELSE l_suppkey END AS old_id
FROM lineitem CROSS JOIN (VALUES (0), (1)) p(position)
""")
def exploded_requests(spark, folder):
    lists = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws(
            ", ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("ids"))
    return explode_requests(lists, "l_orderkey", "ids", ("l_orderkey", "l_linenumber"))


@query("""
WITH listed AS (SELECT o_orderkey, o_custkey, unnest([0, 1]) AS position FROM orders)
SELECT row_number() OVER (ORDER BY o_orderkey, position) AS step,
       o_orderkey * 2 + position AS old_id, o_custkey AS new_id
FROM listed
""")
def request_file(spark, folder):
    """A request file of several parts; the steps follow its lines and lists."""
    path = scratch_path(spark, "requests")
    key = F.col("o_orderkey")
    (table(spark, folder, "orders")
     .select(F.lit("merge").alias("comment"), F.col("o_custkey").alias("id"), F.concat_ws(
         ",", (key * 2).cast("string"), (key * 2 + 1).cast("string")).alias("id_duplicates"),
             "o_orderkey")
     .repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey")
     .write.csv(path, sep="\t", header=True))
    return read_merge_requests(spark, path)


@query("""
SELECT o_orderkey AS ours_id_zp, o_custkey AS theirs_id_zp, o_orderkey + 1 AS ours_cd_nom,
       CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 END AS theirs_cd_nom,
       o_orderstatus || ', ' || o_orderpriority AS nom_obs
FROM orders
""")
def diff_file(spark, folder):
    """The columns of the file stand in another order, and it has one more."""
    path, schema = scratch_path(spark, "diff"), diff_schema("ours", "theirs")
    key, other = F.col("o_orderkey"), F.col("o_custkey")
    (table(spark, folder, "orders")
     .select(F.when(F.col("o_orderstatus") == "F", other + 1).alias("theirs_cd_nom"),
             (key + 1).alias("ours_cd_nom"), key.alias("ours_id_zp"),
             F.concat_ws(", ", "o_orderstatus", "o_orderpriority").alias("nom_obs"),
             F.lit("x").alias("more"), other.alias("theirs_id_zp"))
     .write.csv(path, sep=";", header=True))
    return read_diff_csv(spark, path, schema)


@query("""
SELECT c_custkey AS visit, c_name AS site_code, c_mktsegment AS site_desc, '01' AS import_number,
       '2020-06-01' AS import_date FROM customer
UNION ALL
SELECT s_suppkey, s_name, 'supply', '02', '2020-06-02' FROM supplier
""")
def import_batches(spark, folder):
    """Two numbered batches in one import table, the first of them imported twice."""
    root, target = scratch_path(spark, "imports"), scratch_path(spark, "visits")
    schema = "visit long, code string, taxon string"
    batches = {
        "01": table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "02": table(spark, folder, "supplier").select("s_suppkey", "s_name", F.lit("supply"))}
    for number, batch in batches.items():
        batch.toDF("visit", "code", "taxon").select("taxon", "visit", "code").write.csv(
            f"{root}/{number}/visits.csv", header=True)
    rename = {"code": "site_code", "taxon": "site_desc"}
    for number, day in (("01", 1), ("02", 2), ("01", 1)):
        write_import_batch(read_import_batch(spark, root, "visits", schema, number,
                                             date(2020, 6, day), rename), target)
    stamped = ("visit long, site_code string, site_desc string, import_date date, "
               "import_number string")
    return spark.read.schema(stamped).parquet(target).withColumn(
        "import_date", F.col("import_date").cast("string"))


@query("""
SELECT o_orderkey, c_name, l_linenumber
FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
""")
def published_snapshot(spark, folder):
    """The tables of an extract, published twice; the newest version is read."""
    root = scratch_path(spark, "published")
    tables = read_tables(spark, folder, ["customer", "orders", "lineitem"])
    publish(spark, {name: df.limit(0) for name, df in tables.items()}, root)
    publish(spark, tables, root)
    found = read_published(spark, root)
    return (found["orders"].join(found["customer"], F.col("c_custkey") == F.col("o_custkey"))
            .join(found["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_orderkey", "c_name", "l_linenumber"))
