"""Cleaning and parsing of text, and parents derived from codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from reknit.catalog import query, table
from reknit.functions.lists import explode_list, explode_together, split_list
from reknit.functions.text import (
    blank_to_null, clean_phone, concat_skip_null, iso_date, person_key, replace_first,
    search_group, unaccent, upper_or_null)
from reknit.operators.extract import (
    SENSOR_GUARD, SENSOR_SERIAL, extract_facts, sensor_facts)
from reknit.operators.hierarchy import derive_parents, link_parents
from reknit.session import materialize

DIGITS = "lpad(CAST(c_custkey AS VARCHAR), 10, '0')"


@query(f"""
SELECT c_custkey,
       regexp_replace(replace(nullif(trim(phone), ''), '.', ' '),
         '^([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})$',
         '\\1 \\2 \\3 \\4 \\5') AS phone
FROM (SELECT c_custkey, CASE c_mktsegment
        WHEN 'BUILDING' THEN {DIGITS}
        WHEN 'FURNITURE' THEN '  ' || {DIGITS} || ' '
        WHEN 'MACHINERY' THEN regexp_replace({DIGITS}, '([0-9]{{2}})', '.\\1', 'g')
        WHEN 'HOUSEHOLD' THEN '   ' ELSE substr({DIGITS}, 2) END AS phone FROM customer)
""")
def phone_clean(spark, folder):
    digits = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    segment = F.col("c_mktsegment")
    phone = (F.when(segment == "BUILDING", digits)
             .when(segment == "FURNITURE", F.concat(F.lit("  "), digits, F.lit(" ")))
             .when(segment == "MACHINERY", F.regexp_replace(digits, "([0-9]{2})", ".$1"))
             .when(segment == "HOUSEHOLD", "   ").otherwise(F.substr(digits, F.lit(2))))
    return table(spark, folder, "customer").select("c_custkey", clean_phone(phone).alias("phone"))


@query("""
SELECT doc_id, nullif(lang, 'fr') AS lang, nullif(nullif(upper(source), 'SRC0'), '') AS source,
       concat(nullif(lang, 'fr'), source) AS joined
FROM documents
""")
def blanks_to_null(spark, folder):
    lang = F.nullif("lang", F.lit("fr"))
    source = F.when(F.col("source") != "src0", F.col("source")).otherwise("")
    return table(spark, folder, "documents").select(
        "doc_id", blank_to_null(F.coalesce(lang, F.lit(""))).alias("lang"),
        upper_or_null(source).alias("source"), concat_skip_null(lang, "source").alias("joined"))


@query("""
SELECT doc_id, md5(replace(strip_accents(text), 'ß', 'ss')) AS plain FROM documents
""")
def unaccented_texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id",
                                                    F.md5(unaccent("text")).alias("plain"))


@query("""
SELECT doc_id, md5(trim(concat(
         lower(strip_accents(nullif(lang, 'en'))),
         lower(replace(strip_accents(regexp_replace(
           regexp_replace(text || ' (née X) (Y)', '\\s', '', 'g'),
           '\\([^\\(]*\\)', '')), 'ß', 'ss'))))) AS key
FROM documents
""")
def person_keys(spark, folder):
    """The whole text as a surname, with the language, or nothing, as first name."""
    last = F.concat("text", F.lit(" (née X) (Y)"))
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(person_key(F.nullif("lang", F.lit("en")), last)).alias("key"))


@query("""
SELECT page_id, md5(regexp_replace(html, '<[^>]*>', '#')) AS first_only,
       md5(regexp_replace(html, '<[^>]*>', '#', 'g')) AS every
FROM pages
""")
def first_match_only(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", F.md5(replace_first("html", "<[^>]*>", "#")).alias("first_only"),
        F.md5(F.regexp_replace("html", "<[^>]*>", "#")).alias("every"))


@query("""
SELECT doc_id, text LIKE '%.%' AS has_dot, text ILIKE '%É%' AS has_e,
       regexp_matches(text, '[0-9]{2}') AS has_number
FROM documents
""")
def text_predicates(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", text.like("%.%").alias("has_dot"), text.ilike("%É%").alias("has_e"),
        text.rlike("[0-9]{2}").alias("has_number"))


@query("""
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page,
       nullif(regexp_extract(html, '(?i)<HTML\\s+LANG="([a-z]+)"', 1), '') AS lang
FROM pages
""")
def searched_groups(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", search_group("url", "[?&]page=([0-9]+)").alias("page"),
        search_group("html", r'<HTML\s+LANG="([a-z]+)"').alias("lang"))


DESCRIPTION = """
  SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN 'Prairie. Capteur de température n°' || o_custkey || ' ('
                         || strftime(o_orderdate, '%Y-%m-%d') || ').'
    WHEN '2-HIGH' THEN 'Capteur  temperature n°' || o_custkey || ' b('
                       || strftime(o_orderdate, '%Y/%m/%d') || ')'
    WHEN '3-MEDIUM' THEN 'Visite (2001-02-03). Capteur température n°A' || o_custkey || '('
                         || strftime(o_orderdate, '%Y/%m/%d') || ')'
    WHEN '5-LOW' THEN 'CAPTEUR DE TEMPÉRATURE n°7 (2001-02-03)' ELSE NULL END AS text
  FROM orders
"""


@query(f"""
SELECT o_orderkey,
       coalesce(nullif(regexp_extract(
         text, '(?i)Capteur(?:\\s+de)?\\s+temp[eé]rature\\s+n°([^\\s(]+)\\s*\\(', 1), ''),
         '..?..') AS serial_number,
       replace(nullif(regexp_extract(text, '\\((\\d{{4}}[-/]\\d{{2}}[-/]\\d{{2}})\\)', 1), ''),
               '/', '-') AS install_date
FROM ({DESCRIPTION})
WHERE regexp_matches(
  text, 'Capteur(?:\\s+de)?\\s+temp[eé]rature\\s+n°[^(]+\\(\\d{{4}}[-/]\\d{{2}}[-/]\\d{{2}}\\)')
""")
def extracted_facts(spark, folder):
    priority, number = F.col("o_orderpriority"), F.col("o_custkey").cast("string")
    dashed, slashed = (F.date_format("o_orderdate", p) for p in ("yyyy-MM-dd", "yyyy/MM/dd"))
    text = (F.when(priority == "1-URGENT", F.concat(
                F.lit("Prairie. Capteur de température n°"), number, F.lit(" ("), dashed,
                F.lit(").")))
            .when(priority == "2-HIGH", F.concat(
                F.lit("Capteur  temperature n°"), number, F.lit(" b("), slashed, F.lit(")")))
            .when(priority == "3-MEDIUM", F.concat(
                F.lit("Visite (2001-02-03). Capteur température n°A"), number, F.lit("("), slashed,
                F.lit(")")))
            .when(priority == "5-LOW", "CAPTEUR DE TEMPÉRATURE n°7 (2001-02-03)"))
    described = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    facts = extract_facts(described, "text", SENSOR_GUARD, sensor_facts("text"))
    return facts.select("o_orderkey", "serial_number",
                        F.col("install_date").cast("string").alias("install_date"))


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders
""")
def lenient_dates(spark, folder):
    text = F.when(F.col("o_orderpriority") == "5-LOW", "2001-13-01").otherwise(
        F.date_format("o_orderdate", "yyyy/MM/dd"))
    return table(spark, folder, "orders").select(
        "o_orderkey", iso_date(text, strict=False).cast("string").alias("day"))


@query(f"""
SELECT o_orderkey, nullif(regexp_extract(
         text, '(?i)Capteur(?:\\s+de)?\\s+temp[eéÉ]rature\\s+n°([^\\s(]+)\\s*\\(', 1), '') AS serial
FROM ({DESCRIPTION})
""")
def serials_in_any_case(spark, folder):
    priority = F.col("o_orderpriority")
    number = F.col("o_custkey").cast("string")
    text = (F.when(priority == "1-URGENT", F.concat(
                F.lit("Prairie. Capteur de température n°"), number, F.lit(" (")))
            .when(priority == "3-MEDIUM", F.concat(
                F.lit("Capteur température n°A"), number, F.lit("(")))
            .when(priority == "5-LOW", "CAPTEUR DE TEMPÉRATURE n°7 (2001-02-03)"))
    return table(spark, folder, "orders").select("o_orderkey",
                                                 search_group(text, SENSOR_SERIAL).alias("serial"))


@query("""
SELECT p_partkey, trim(unnest(string_split(p_name || ', ' || p_type, ','))) AS item FROM part
WHERE p_brand <> 'Brand#1'
""")
def exploded_lists(spark, folder):
    """Lists that are empty or NULL leave no rows."""
    brand = F.col("p_brand")
    parts = table(spark, folder, "part").select(
        "p_partkey", F.when(brand != "Brand#1", F.concat_ws(", ", "p_name", "p_type"))
        .when(F.col("p_size") > 25, "").alias("items"))
    return explode_list(parts, "items", "item").drop("items")


@query("""
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word,
       unnest(CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'SMALL' THEN []
                          WHEN 'LARGE' THEN ['one'] ELSE ['a', 'b', 'c'] END) AS letter
FROM part
""")
def lists_side_by_side(spark, folder):
    kind = F.col("p_type")
    letters = (F.when(kind == "ECONOMY", None).when(kind == "SMALL", "").when(kind == "LARGE", "one")
               .otherwise("a,b,c"))
    parts = table(spark, folder, "part").select("p_partkey", F.replace(
        "p_name", F.lit(" "), F.lit(",")).alias("words"), letters.alias("letters"))
    return explode_together(parts, {"word": split_list("words"), "letter": split_list("letters")}
                            ).select("p_partkey", "word", "letter")


PLOTS = """
  SELECT p_partkey AS id, CASE WHEN p_partkey % 5 > 0 THEN p_type END AS transect,
         p_brand || '.' || p_partkey AS code, p_size AS distance, NULL::BIGINT AS parent FROM part
  UNION ALL
  SELECT p_partkey + 1000000000, p_type, p_brand, CAST(p_size + p_partkey % 2 AS INTEGER), NULL
  FROM part WHERE p_partkey % 7 = 0
  UNION ALL
  SELECT p_partkey + 2000000000, NULL, p_brand, p_size, NULL FROM part WHERE p_partkey % 25 = 0
"""
PARENTS = f"""
  SELECT (SELECT max(id) FROM ({PLOTS})) + row_number() OVER (
           ORDER BY transect NULLS FIRST, code, distance) AS id, transect, code, distance
  FROM (SELECT transect, split_part(code, '.', 1) AS code, distance FROM ({PLOTS})
        WHERE code LIKE '%.%'
        EXCEPT SELECT transect, code, distance FROM ({PLOTS}) WHERE code NOT LIKE '%.%')
"""
SHAPE = dict(id="id", code="code", by=["transect"], moved="distance", parent="parent")


def plots(spark, folder):
    """Dotted plots, some of no transect; undotted ones, half of them at another distance."""
    parts, key = table(spark, folder, "part"), F.col("p_partkey")
    columns = ["id", "transect", "code", "distance"]
    dotted = parts.select(
        key, F.when(key % 5 > 0, F.col("p_type")),
        F.concat("p_brand", F.lit("."), key.cast("string")), "p_size").toDF(*columns)
    alone = parts.filter(key % 7 == 0).select(
        key + 1000000000, "p_type", "p_brand",
        (F.col("p_size") + key % 2).cast("int")).toDF(*columns)
    outside = parts.filter(key % 25 == 0).select(
        key + 2000000000, F.lit(None).cast("string"), "p_brand", "p_size").toDF(*columns)
    return dotted.unionByName(alone).unionByName(outside).withColumn(
        "parent", F.lit(None).cast("long"))


@query(f"""
SELECT id, transect, code, distance FROM ({PLOTS})
UNION ALL SELECT id, transect, code, distance FROM ({PARENTS})
""")
def derived_parents(spark, folder):
    return derive_parents(plots(spark, folder), **SHAPE).drop("parent")


@query(f"""
WITH plots AS ({PLOTS}), parents AS ({PARENTS}),
every AS (SELECT id, transect, code, distance FROM plots UNION ALL SELECT * FROM parents),
first AS (SELECT transect, code, min(id) AS id FROM every WHERE code NOT LIKE '%.%' GROUP BY ALL)
SELECT every.id, every.transect, every.code, first.id AS parent,
       CASE WHEN first.id IS NULL THEN distance END AS distance
FROM every LEFT JOIN first ON first.transect = every.transect AND every.code LIKE '%.%'
  AND first.code = split_part(every.code, '.', 1)
""")
def linked_parents(spark, folder):
    with_parents = materialize(derive_parents(plots(spark, folder), **SHAPE), "plots")
    return link_parents(with_parents, **SHAPE)
