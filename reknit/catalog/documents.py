"""JSON documents: building, editing, grouping into them."""

from __future__ import annotations

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.functions.documents import (
    json_merge, json_nested, json_object, json_pair, json_set, json_text, json_typed)
from reknit.operators.documents import enrich_json, group_pairs
from reknit.operators.people import attach_provenance


@query("""
SELECT c_custkey, json_object('id', c_custkey, 'segment', nullif(c_mktsegment, 'BUILDING'),
                              'nation', c_nationkey)::VARCHAR AS doc
FROM customer
""")
def json_build(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", json_object(
        id="c_custkey", segment=F.nullif("c_mktsegment", F.lit("BUILDING")),
        nation="c_nationkey").alias("doc"))


@query("""
SELECT c_custkey, json_object('origin', json_object(
         'id', c_custkey, 'nation', n_name,
         'segment', nullif(c_mktsegment, 'BUILDING'),
         'at', replace((TIMESTAMP '2020-01-01' + to_microseconds(c_custkey * 1234500))::VARCHAR,
                       ' ', 'T')))::VARCHAR AS doc
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def provenance(spark, folder):
    """Times go to the microsecond and belong to no zone."""
    at = F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.col("c_custkey") * F.lit(1.2345).cast("decimal(10,6)"))
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    source = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    target = customers.select("c_custkey", F.lit(None).cast("string").alias("doc"))
    return attach_provenance(target, source, "c_custkey", "doc", "origin", {
        "id": F.col("c_custkey"), "nation": F.col("n_name"),
        "segment": F.nullif("c_mktsegment", F.lit("BUILDING")), "at": at})


@query("""SELECT p_partkey, '{"' || p_partkey || '":"' || p_name || '"}' AS pair FROM part""")
def json_pairs(spark, folder):
    return table(spark, folder, "part").select("p_partkey",
                                               json_pair("p_partkey", "p_name").alias("pair"))


GROUPED = """
  SELECT l_orderkey, '[' || string_agg('{"' || l_linenumber || '":"' || p_name || '"}', ','
                                       ORDER BY l_linenumber, p_name) || ']' AS items
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey
"""


def _named_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


@query(GROUPED)
def json_group(spark, folder):
    return group_pairs(_named_lines(spark, folder), "l_orderkey", "l_linenumber", "p_name",
                       "items")


@query("""
SELECT event_id,
       json_merge_patch(props, json_object('origin', json_object('user', user_id)))::VARCHAR AS added,
       json_object('k', event_id)::VARCHAR AS replaced,
       json_object('k', json_extract(props, '$.k'))::VARCHAR AS no_parent,
       '{"origin":{"event":"' || event_type || '","user":' || user_id || '}}' AS nested,
       NULL::VARCHAR AS null_value
FROM events
""")
def json_set_paths(spark, folder):
    user = json_object(user="user_id")
    return table(spark, folder, "events").select(
        "event_id",
        json_set("props", ["origin"], user).alias("added"),
        json_set("props", ["k"], F.col("event_id").cast("string")).alias("replaced"),
        json_set("props", ["origin", "user"], user).alias("no_parent"),
        json_set(json_nested("origin", user="user_id"), ["origin", "event"],
                 F.concat(F.lit('"'), "event_type", F.lit('"'))).alias("nested"),
        json_set("props", ["k"], F.lit(None).cast("string")).alias("null_value"))


@query("""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN '{"k":"error","user":' || user_id || '}'
            ELSE '{"k":' || json_extract(props, '$.k') || ',"user":' || user_id || '}'
       END AS merged
FROM events
""")
def json_merge_objects(spark, folder):
    error = F.col("event_type") == "error"
    return table(spark, folder, "events").select("event_id", json_merge(
        "props", F.when(error, json_object(user="user_id", k="event_type"))
        .otherwise(json_object(user="user_id"))).alias("merged"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS as_text,
       json_extract(props, '$.k')::VARCHAR AS typed, NULL::VARCHAR AS absent
FROM events
""")
def json_values(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", json_text("props", "k").alias("as_text"),
        json_typed("props", "k").alias("typed"), json_typed("props", "x", "y").alias("absent"))


def _documents(spark, folder):
    """Orders with documents that name them; only the urgent ones hold a project already."""
    project = F.when(F.col("o_orderpriority") == "1-URGENT",
                     F.struct(F.lit("x").alias("items"), F.col("o_orderkey").alias("old")))
    origin = F.struct(F.col("o_orderkey").alias("index"), project.alias("project"))
    return table(spark, folder, "orders").select(
        "o_orderkey", F.to_json(F.struct(origin.alias("origin"))).alias("doc"))


@query(f"""
SELECT o_orderkey, CASE
  WHEN items IS NOT NULL
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":' || items || '}}}}}}'
  WHEN o_orderpriority = '1-URGENT'
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":"x","old":' || o_orderkey
         || '}}}}}}'
  ELSE '{{"origin":{{"index":' || o_orderkey || '}}}}' END AS doc
FROM orders LEFT JOIN ({GROUPED}) ON l_orderkey = o_orderkey
""")
def enriched_documents(spark, folder):
    return enrich_json(_documents(spark, folder), _named_lines(spark, folder), "l_orderkey",
                       "l_linenumber", "p_name", json_text("doc", "origin", "index").cast("long"),
                       "doc", ["origin", "project"], "items")


@query(f"""
SELECT o_orderkey, CASE
  WHEN items IS NOT NULL AND o_orderpriority = '1-URGENT'
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":' || items || ',"old":'
         || o_orderkey || '}}}}}}'
  WHEN items IS NOT NULL
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":' || items || '}}}}}}'
  WHEN o_orderpriority = '1-URGENT'
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":"x","old":' || o_orderkey
         || '}}}}}}'
  ELSE '{{"origin":{{"index":' || o_orderkey || '}}}}' END AS doc
FROM orders LEFT JOIN ({GROUPED}) ON l_orderkey = o_orderkey
""")
def enriched_documents_merged(spark, folder):
    return enrich_json(_documents(spark, folder), _named_lines(spark, folder), "l_orderkey",
                       "l_linenumber", "p_name", json_text("doc", "origin", "index").cast("long"),
                       "doc", ["origin", "project"], "items", merge=True)


@query(f"""
SELECT o_orderkey, CASE
  WHEN items IS NOT NULL AND o_orderpriority = '1-URGENT'
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":' || items || ',"old":'
         || o_orderkey || '}}}}}}'
  WHEN items IS NOT NULL THEN NULL
  WHEN o_orderpriority = '1-URGENT'
    THEN '{{"origin":{{"index":' || o_orderkey || ',"project":{{"items":"x","old":' || o_orderkey
         || '}}}}}}'
  ELSE '{{"origin":{{"index":' || o_orderkey || '}}}}' END AS doc
FROM orders LEFT JOIN ({GROUPED}) ON l_orderkey = o_orderkey
""")
def enriched_documents_strict(spark, folder):
    """Merging into a missing object makes the document NULL, as the strict rule wants."""
    return enrich_json(_documents(spark, folder), _named_lines(spark, folder), "l_orderkey",
                       "l_linenumber", "p_name", json_text("doc", "origin", "index").cast("long"),
                       "doc", ["origin", "project"], "items", merge=True, strict_null=True)


@query("""
SELECT event_id,
  json_extract(doc, '$.a[0].b')::VARCHAR AS first,
  json_extract_string(doc, '$.a[#-1].b') AS last,
  json_extract(doc, '$.a[2]')::VARCHAR AS beyond,
  json_extract(doc, '$.n."0"')::VARCHAR AS named,
  '{"a":[{"b":' || user_id || '},{"b":7}],"n":{"0":"zero"}}' AS inner_set,
  '{"a":[{"b":' || user_id || '},{"b":"' || event_type || '"},7],"n":{"0":"zero"}}' AS appended,
  '{"a":[7,{"b":' || user_id || '},{"b":"' || event_type || '"}],"n":{"0":"zero"}}' AS put_first,
  '{"a":[{"b":' || user_id || '},7],"n":{"0":"zero"}}' AS replaced,
  doc AS no_parent,
  '[' || user_id || ',"' || event_type || '",' || event_id || ']' AS joined
FROM (SELECT *, '{"a":[{"b":' || user_id || '},{"b":"' || event_type || '"}],"n":{"0":"zero"}}' AS doc
      FROM events)
""")
def json_array_paths(spark, folder):
    """Elements of arrays by position, forwards and backwards, read and set."""
    def item(value):
        return F.to_json(F.struct(F.col(value).alias("b")))

    doc = F.concat(F.lit('{"a":['), item("user_id"), F.lit(","), item("event_type"),
                   F.lit('],"n":{"0":"zero"}}'))
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type",
                                                 doc.alias("doc"))
    seven = F.lit("7")
    pair = F.concat(F.lit("["), "user_id", F.lit(',"'), "event_type", F.lit('"]'))
    return rows.select(
        "event_id", json_typed("doc", "a", 0, "b").alias("first"),
        json_text("doc", "a", "-1", "b").alias("last"), json_typed("doc", "a", 2).alias("beyond"),
        json_typed("doc", "n", 0).alias("named"),
        json_set("doc", ["a", 1, "b"], seven).alias("inner_set"),
        json_set("doc", ["a", 5], seven).alias("appended"),
        json_set("doc", ["a", "-3"], seven).alias("put_first"),
        json_set("doc", ["a", -1], seven).alias("replaced"),
        json_set("doc", ["a", 2, "b"], seven).alias("no_parent"),
        json_merge(pair, F.col("event_id").cast("string")).alias("joined"))
