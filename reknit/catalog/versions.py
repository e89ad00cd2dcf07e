"""Published versions: merges of a few files, foreign keys, refused requests, durable ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.catalog.merges import first_of_block
from reknit.operators.joins import lookup_types, unresolved_codes
from reknit.operators.keys import number_rows
from reknit.operators.merge import (
    KeyRule, LinkRule, MergeSpec, judge_requests, merge_snapshot, resolve_requests)
from reknit.operators.references import ForeignKey, dangling, left_behind
from reknit.operators.rows import append, delete_where
from reknit.operators.sequences import counter_of, draw_ids
from reknit.plans.merge_entities import merge_what_can_be
from reknit.session import scratch_path
from reknit.sources.imports import run_import
from reknit.sources.publish import publish, read_published
from reknit.sources.tables import read_with_rejects
from reknit.sources.touched import merge_touched, set_where_touched, update_from_touched

SPEC = MergeSpec("customer", "c_custkey",
                 links=[LinkRule("orders", "o_custkey", ("o_orderpriority",))])


def debtor_requests(customers):
    """Customers in debt go to the first of their ten."""
    return (customers.filter("c_acctbal < 0")
            .select(F.col("c_custkey").alias("step"), F.col("c_custkey").alias("old_id"),
                    first_of_block(10).alias("new_id")).filter("old_id <> new_id"))


def _published(spark, folder, root):
    """Customers and orders, each dealt to files by their customer."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    publish(spark, {"customer": table(spark, folder, "customer").repartitionByRange(16, "c_custkey"),
                    "orders": orders.repartitionByRange(32, "o_custkey")}, root)
    return read_published(spark, root)


DEBTORS = """
WITH old AS (
  SELECT c_custkey AS id, c_custkey // 10 * 10 AS survivor FROM customer
  WHERE c_acctbal < 0 AND c_custkey <> c_custkey // 10 * 10)
"""


@query(DEBTORS + """
, ranked AS (
  SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey, o_orderpriority,
         rank() OVER (PARTITION BY coalesce(survivor, o_custkey), o_orderpriority
                      ORDER BY coalesce(id, -1)) AS r
  FROM orders LEFT JOIN old ON id = o_custkey)
SELECT o_orderkey, o_custkey, o_orderpriority, c_name
FROM ranked LEFT JOIN (SELECT * FROM customer WHERE c_custkey NOT IN (SELECT id FROM old))
  ON c_custkey = o_custkey
WHERE r = 1
""")
def merge_of_touched_files(spark, folder):
    """A merge published on a version, of which it keeps the files without merged customers."""
    root = scratch_path(spark, "versions")
    base = _published(spark, folder, root)
    keymap = resolve_requests(debtor_requests(table(spark, folder, "customer")))
    merged, rewrites = merge_touched(base, SPEC, keymap)
    publish(spark, merged, root, base, rewrites)
    done = read_published(spark, root)
    return (done["orders"].join(done["customer"], F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "o_custkey", "o_orderpriority", "c_name"))


@query("""
SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN o_orderstatus = 'P' THEN 'open'
       ELSE o_orderpriority END AS o_orderpriority
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def updates_of_touched_files(spark, folder):
    """A conditional update, then one from another table, each a version of its own."""
    root = scratch_path(spark, "versions")
    base = _published(spark, folder, root)
    changed, rewrites = set_where_touched(base, "orders", F.col("o_orderstatus") == "P",
                                          {"o_orderpriority": F.lit("open")})
    publish(spark, changed, root, base, rewrites)
    base = read_published(spark, root)
    debtors = table(spark, folder, "customer").filter("c_acctbal < 0").select("c_custkey")
    changed, rewrites = update_from_touched(base, "orders", debtors, "o_custkey", "c_custkey",
                                            {"o_orderpriority": F.lit("debt")})
    publish(spark, changed, root, base, rewrites)
    return read_published(spark, root)["orders"].select("o_orderkey", "o_orderpriority")


REFERENCES = [ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
              ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
              ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey")]


@query(DEBTORS + """
SELECT 'orders' AS child, 'o_custkey' AS key, 'customer' AS parent, o_custkey::VARCHAR AS value,
       count(*) AS rows
FROM orders WHERE o_custkey IN (SELECT id FROM old) GROUP BY o_custkey
""")
def left_behind_by_a_merge(spark, folder):
    """Orders that a merge which does not list them leaves without their customer."""
    snapshot = {name: table(spark, folder, name)
                for name in ("customer", "orders", "nation", "supplier")}
    spec = MergeSpec("customer", "c_custkey")
    keymap = resolve_requests(debtor_requests(snapshot["customer"]))
    return left_behind(merge_snapshot(snapshot, spec, keymap), REFERENCES, spec, keymap)


@query("""
WITH kept AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
nations AS (SELECT * FROM nation WHERE n_regionkey <> 1)
SELECT 'orders' AS child, 'o_custkey' AS key, 'customer' AS parent, o_custkey::VARCHAR AS value,
       count(*) AS rows
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM kept) GROUP BY o_custkey
UNION ALL
SELECT 'customer', 'c_nationkey', 'nation', c_nationkey::VARCHAR, count(*)
FROM kept WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nations) GROUP BY c_nationkey
UNION ALL
SELECT 'supplier', 's_nationkey', 'nation', s_nationkey::VARCHAR, count(*)
FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nations) GROUP BY s_nationkey
""")
def dangling_references(spark, folder):
    """Foreign keys of a snapshot from which parents were deleted."""
    snapshot = {name: table(spark, folder, name)
                for name in ("customer", "orders", "nation", "supplier")}
    snapshot["customer"] = delete_where(snapshot["customer"], F.expr("c_mktsegment = 'BUILDING'"))
    snapshot["nation"] = delete_where(snapshot["nation"], F.expr("n_regionkey = 1"))
    return dangling(snapshot, REFERENCES)


def contradictory_requests(customers):
    """Three rounds of requests within blocks of ten, many of which name a customer that is gone."""
    block = first_of_block(10)

    def step(first: str, new) -> object:
        return F.expr(first).alias("step"), F.col("c_custkey").alias("old_id"), new.alias("new_id")

    def shifted(by: int):
        return block + (F.col("c_custkey") + by) % 10

    return (customers.filter("c_acctbal > 4000").select(*step("c_custkey", block))
            .union(customers.select(*step("1000000000000 + c_custkey", shifted(1))))
            .union(customers.select(*step("2000000000000 - c_custkey", shifted(3)))))


JUDGED = """
WITH RECURSIVE requests AS (
  SELECT c_custkey AS step, c_custkey AS old_id, c_custkey // 10 * 10 AS new_id
  FROM customer WHERE c_acctbal > 4000
  UNION ALL SELECT 1000000000000 + c_custkey, c_custkey,
                   c_custkey // 10 * 10 + (c_custkey + 1) % 10 FROM customer
  UNION ALL SELECT 2000000000000 - c_custkey, c_custkey,
                   c_custkey // 10 * 10 + (c_custkey + 3) % 10 FROM customer),
numbered AS (
  SELECT *, old_id // 10 AS block,
         row_number() OVER (PARTITION BY old_id // 10 ORDER BY step, old_id, new_id) AS n
  FROM requests),
walk AS (
  SELECT DISTINCT block, 0::BIGINT AS n, []::BIGINT[] AS dead, 0::BIGINT AS step,
         0::BIGINT AS old_id, 0::BIGINT AS new_id, NULL::VARCHAR AS reason FROM numbered
  UNION ALL
  SELECT block, n, CASE WHEN reason IS NULL THEN list_append(dead, old_id) ELSE dead END, step,
         old_id, new_id, reason
  FROM (SELECT r.*, w.dead, CASE WHEN r.old_id = r.new_id THEN 'merged into itself'
               WHEN list_contains(w.dead, r.old_id) THEN 'merged away earlier'
               WHEN list_contains(w.dead, r.new_id) THEN 'survivor merged away earlier' END
               AS reason
        FROM walk w JOIN numbered r ON r.block = w.block AND r.n = w.n + 1))
"""


@query(JUDGED + "SELECT step, old_id, new_id, reason FROM walk WHERE n > 0")
def judged_requests(spark, folder):
    """Requests applied or refused one by one, with the reasons."""
    return judge_requests(contradictory_requests(table(spark, folder, "customer")))


@query(JUDGED + """
, applied AS (SELECT old_id, new_id FROM walk WHERE n > 0 AND reason IS NULL),
ends AS (
  SELECT old_id AS id, new_id AS survivor FROM applied
  UNION ALL SELECT e.id, a.new_id FROM ends e JOIN applied a ON a.old_id = e.survivor),
finals AS (SELECT * FROM ends WHERE survivor NOT IN (SELECT old_id FROM applied))
SELECT o_orderkey, coalesce(survivor, o_custkey) AS o_custkey, NULL AS reason
FROM orders LEFT JOIN finals ON id = o_custkey
UNION ALL SELECT step, old_id, reason FROM walk WHERE n > 0 AND reason IS NOT NULL
""")
def merge_of_valid_requests(spark, folder):
    """A file with contradictory requests: what can be merged is, and the rest is written down."""
    root, refused = scratch_path(spark, "versions"), scratch_path(spark, "refused")
    spec = MergeSpec("customer", "c_custkey", keys=[KeyRule("orders", "o_custkey")])
    requests = contradictory_requests(table(spark, folder, "customer"))
    merge_what_can_be(spark, _published(spark, folder, root), spec, requests, root, refused)
    kept = read_published(spark, root)["orders"].select(
        "o_orderkey", "o_custkey", F.lit(None).cast("string").alias("reason"))
    return kept.union(spark.read.parquet(refused).select("step", "old_id", "reason"))


@query("""
SELECT o_orderkey AS id, o_orderpriority AS label FROM orders
WHERE o_orderkey < (SELECT max(o_orderkey) FROM orders) // 2
UNION ALL
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY s_suppkey), s_name
FROM supplier
""")
def ids_after_deleting_the_largest(spark, folder):
    """Ids go on after the largest one there ever was, two versions later."""
    root = scratch_path(spark, "versions")
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"),
                                                 F.col("o_orderpriority").alias("label"))
    publish(spark, {"rows": rows}, root, sequences={"rows.id": counter_of(rows, "id")})
    base = read_published(spark, root)
    half = F.col("id") >= F.floor(rows.agg(F.max("id")).scalar() / 2)
    publish(spark, {"rows": delete_where(base["rows"], half)}, root, base)
    base = read_published(spark, root)
    new = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"),
                                                  F.col("s_name").alias("label"))
    drawn, counter = draw_ids(new, base.sequences["rows.id"], "id", ["key"], unique=True)
    publish(spark, {"rows": append(base["rows"], drawn.drop("key"))}, root, base,
            sequences={"rows.id": counter})
    return read_published(spark, root)["rows"]


@query("""
SELECT o_orderkey, 'x' AS o_orderpriority, c_name, 0 AS c_acctbal
FROM orders JOIN customer ON c_custkey = o_custkey
""")
def two_writers_on_one_base(spark, folder):
    """Two versions made from the same one, of different tables: the later keeps the earlier's."""
    root = scratch_path(spark, "versions")
    publish(spark, {"customer": table(spark, folder, "customer").select("c_custkey", "c_name",
                                                                        "c_acctbal"),
                    "orders": table(spark, folder, "orders").select("o_orderkey", "o_custkey",
                                                                    "o_orderpriority")}, root)
    one, other = read_published(spark, root), read_published(spark, root)
    publish(spark, {**one, "orders": one["orders"].withColumn("o_orderpriority", F.lit("x"))},
            root, one)
    publish(spark, {**other, "customer": other["customer"].withColumn("c_acctbal", F.lit(0))},
            root, other)
    done = read_published(spark, root)
    return (done["orders"].join(done["customer"], F.col("c_custkey") == F.col("o_custkey"))
            .select("o_orderkey", "o_orderpriority", "c_name", "c_acctbal"))


@query("""
SELECT c_custkey, upper(c_mktsegment) AS segment, n_name
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def import_in_steps(spark, folder):
    """An import that is stopped after its second step, and run again."""
    root = scratch_path(spark, "import")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    begun = []

    def work(part):
        begun.append(part)
        if len(begun) == 3:
            raise InterruptedError("stopped on purpose")
        return (part.join(F.broadcast(nations), F.col("n_nationkey") == F.col("c_nationkey"), "left")
                .select("c_custkey", F.upper("c_mktsegment").alias("segment"), "n_name"))

    # Twelve steps, whatever the number of customers.
    size = max(1, -(-customers.count() // 12))
    try:
        run_import(spark, customers, ["c_custkey"], work, root, size, unique=True)
    except InterruptedError:
        pass
    return run_import(spark, customers, ["c_custkey"], work, root, size, unique=True)


@query("""
SELECT 'row' AS kind, o_orderkey::VARCHAR AS a, o_totalprice::DECIMAL(15, 2)::VARCHAR AS b FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
UNION ALL
SELECT 'reject', concat(o_orderkey, ',', o_orderstatus, ',', o_orderpriority), NULL
FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'
UNION ALL SELECT 'reject', concat(o_orderkey, ',', o_orderstatus, ',1,x'), NULL
FROM orders WHERE o_orderpriority = '5-LOW'
""")
def rejected_records(spark, folder):
    """A file in which some records lack a number or have a field too many."""
    path = scratch_path(spark, "records")
    orders = table(spark, folder, "orders")
    line = F.concat_ws(",", F.col("o_orderkey"), "o_orderstatus", F.when(
        F.col("o_orderpriority") == "5-LOW", "1,x").when(
        F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string")))
    header = orders.limit(1).select(F.lit("id,status,price").alias("value"))
    header.coalesce(1).write.text(f"{path}/header")
    orders.select(line.alias("value")).write.text(f"{path}/lines")
    # Every file of a folder has the header.
    text = spark.read.text(f"{path}/header").union(
        spark.read.text(f"{path}/lines").coalesce(1)).coalesce(1)
    text.write.text(f"{path}/all")
    good, rejects = read_with_rejects(spark, f"{path}/all",
                                      "id long, status string, price decimal(15,2)")
    return good.select(F.lit("row").alias("kind"), F.col("id").cast("string").alias("a"),
                       F.col("price").cast("string").alias("b")).union(
        rejects.select(F.lit("reject"), "record", F.lit(None).cast("string")))


TYPED = """
WITH codes AS (
  SELECT 'status' AS kind, o_orderstatus AS code FROM orders WHERE o_orderstatus <> 'P'
  UNION SELECT 'priority', o_orderpriority FROM orders
  UNION SELECT 'mode', l_linestatus FROM lineitem UNION SELECT 'flag', l_returnflag FROM lineitem
  UNION SELECT 'mode', l_returnflag FROM lineitem),
ids AS (SELECT *, row_number() OVER (ORDER BY kind, code) AS id FROM codes)
"""


@query(TYPED + """
SELECT l_orderkey, l_linenumber, s.id AS status, p.id AS priority, m.id AS mode, f.id AS flag,
       r.id AS returned, c.id AS other
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN ids s ON s.kind = 'status' AND s.code = o_orderstatus
LEFT JOIN ids p ON p.kind = 'priority' AND p.code = o_orderpriority
LEFT JOIN ids m ON m.kind = 'mode' AND m.code = l_linestatus
LEFT JOIN ids f ON f.kind = 'flag' AND f.code = l_returnflag
LEFT JOIN ids r ON r.kind = 'mode' AND r.code = l_returnflag
LEFT JOIN ids c ON c.kind = 'none' AND c.code = l_returnflag
""")
def six_typed_lookups(spark, folder):
    """Six columns of codes from one dimension, without a join for each."""
    found, columns = _typed(spark, folder)
    return found.select("l_orderkey", "l_linenumber", *columns)


@query(TYPED + """
SELECT 'status' AS kind, 'P' AS code, count(*) AS rows
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'none', l_returnflag, count(*)
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_returnflag
""")
def unresolved_typed_codes(spark, folder):
    return unresolved_codes(*_typed(spark, folder))


def _typed(spark, folder):
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")

    def codes(kind, df, code):
        return df.select(F.lit(kind).alias("kind"), F.col(code).alias("code")).distinct()

    dimension = number_rows(
        codes("status", orders.filter("o_orderstatus <> 'P'"), "o_orderstatus")
        .union(codes("priority", orders, "o_orderpriority")).union(codes("mode", lines, "l_linestatus"))
        .union(codes("flag", lines, "l_returnflag")).union(codes("mode", lines, "l_returnflag"))
        .distinct(), ["kind", "code"], "id", unique=True)
    columns = {"status": ("status", "o_orderstatus"), "priority": ("priority", "o_orderpriority"),
               "mode": ("mode", "l_linestatus"), "flag": ("flag", "l_returnflag"),
               "returned": ("mode", "l_returnflag"), "other": ("none", "l_returnflag")}
    rows = lines.select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag").join(
        orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        F.col("o_orderkey") == F.col("l_orderkey"))
    return lookup_types(rows, dimension, "kind", "code", "id", columns), columns
