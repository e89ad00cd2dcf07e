"""One query per operator over its whole table, each with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reknit.llm import (
    conversations, decontaminate, lengths, licenses, neardup, pieces, quality, runs, secrets, topk,
    toxicity, urls, warc)

Query = Callable[[SparkSession, str], DataFrame]

# The vocabulary of the SentencePiece queries.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The rules of the URL query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
             ("org/fr/", "allow")]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query()
def op1_license_scans(spark, folder):
    # The documents of a source lie in its folder, by language.
    docs = table(spark, folder, "documents").withColumn("path", F.concat_ws(
        "/", "source", "lang", F.col("doc_id").cast("string")))
    return licenses.scan_licences(docs)


@query()
def op2_secret_scans(spark, folder):
    docs = table(spark, folder, "documents")
    return secrets.find(docs, secrets.fit(docs))


@query()
def op3_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, folder, "labels")))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@query(rf"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all({LOWER}, {WORD}) AS w FROM documents),
    items AS (SELECT item_id, regexp_extract_all({LOWER}, {WORD}) AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 13) AS width, unnest(list_transform(
            range(1, len(w) - least(len(w), 13) + 2),
            lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS phrase
        FROM items WHERE len(w) > 0),
    widths AS (SELECT DISTINCT width FROM windows),
    placed AS (
        SELECT doc_id, width, unnest(range(1, len(w) - width + 2)) AS spot,
               unnest(list_transform(range(1, len(w) - width + 2),
                                     lambda i: array_to_string(w[i:i + width - 1], ' '))) AS phrase
        FROM docs, widths WHERE len(w) >= width),
    hits AS (SELECT doc_id, item_id, width, spot FROM placed JOIN windows USING (width, phrase)),
    covered AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(spot, spot + width)) AS place FROM hits) GROUP BY doc_id),
    found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op4_benchmark_decontamination(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"),
                                       table(spark, folder, "benchmark"))


@query("""
    WITH paid AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
    payloads AS (SELECT page_id, strlen(p) AS payload_bytes, sha1(p) AS payload_digest FROM paid),
    shared AS (
        SELECT payload_digest, max(page_id) AS response FROM payloads
        WHERE payload_bytes >= 1000 GROUP BY payload_digest)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
           CASE WHEN page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < response THEN response END AS refers_to
    FROM payloads LEFT JOIN shared USING (payload_digest)
""")
def op5_warc_archives(spark, folder):
    packages = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_archives(packages, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op6_url_filters(spark, folder):
    pages = table(spark, folder, "pages")
    # A page is labelled by the document whose number ends its path.
    url = F.col("url")
    shown = pages.select(
        urls.host_of(url).alias("host"), urls.path_of(url).alias("path"),
        F.regexp_extract(urls.path_of(url), r"/([0-9]{1,18})(?:\.html|/)?$", 1)
        .try_cast("long").alias("doc_id"))
    known = table(spark, folder, "labels").filter("quality IN (0, 1)").select(
        "doc_id", (1 - F.col("quality")).alias("bad"))
    return urls.filter_urls(pages, shown.join(known, "doc_id").drop("doc_id"), URL_RULES)


@query()
def op7_sentencepiece(spark, folder):
    coded = pieces.encode(table(spark, folder, "documents"), pieces.load_vocabulary(PIECES),
                          keep=["doc_id"], check="round_trip")
    return coded.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long")
                        .alias("n_ids"), "round_trip")


@query("""
    WITH terms AS (
        SELECT vec_id, list_transform(
            embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(
            embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
               list_sum(list_transform(range(1, len(q.w) + 1),
                                       lambda i: q.w[i] * d.w[i]))::BIGINT AS score
        FROM terms q JOIN terms d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
    ranked AS (
        SELECT query_id, row_number() OVER (
            PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored)
    SELECT * FROM ranked WHERE rank <= 5
""")
def op8_exact_top_k(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op9_token_counts(spark, folder):
    return lengths.histogram(table(spark, folder, "documents"), lengths.load_coder(RANKS))


@query(rf"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                              lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
        FROM worded),
    items AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
        WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    lows AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN lows USING (doc_id)
""")
def op10_minhash_near_dedup(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"), size=3, threshold=0.85)


# CRC-32 of the text in column k, bit by bit.
CRC32 = """xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(1, strlen(k) + 1),
        lambda i: ascii(k[i])::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
        lambda v, j: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)::BIGINT"""


@query(rf"""
    WITH keyed AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               doc_id::VARCHAR AS k FROM documents),
    drawn AS (SELECT doc_id, w, len(w) AS n, {CRC32} AS h FROM keyed),
    placed AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS parts FROM drawn),
    tailed AS (
        SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(0, n), lambda i:
            CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END)
            ELSE w END AS w
        FROM placed),
    grams AS (
        SELECT doc_id, unnest(range(0, n - 15)) AS spot, unnest(list_transform(range(1, n - 14),
            lambda i: hash(array_to_string(w[i:i + 15], ' ')))) AS gram
        FROM tailed WHERE n >= 24),
    pairs AS (
        SELECT a.doc_id, a.spot, b.spot - a.spot AS period,
               a.spot - row_number() OVER (
                   PARTITION BY a.doc_id, b.spot - a.spot ORDER BY a.spot) AS island
        FROM grams a JOIN grams b USING (doc_id, gram) WHERE a.spot < b.spot),
    stretches AS (
        SELECT doc_id, period, min(spot) AS start, count(*) + 15 + period AS length
        FROM pairs GROUP BY doc_id, period, island
        HAVING count(*) + 15 + period >= greatest(24, 3 * period)),
    runs AS (
        SELECT * FROM stretches s WHERE NOT EXISTS (
            SELECT 1 FROM stretches t WHERE t.doc_id = s.doc_id AND t.period < s.period
                AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
    best AS (
        SELECT DISTINCT ON (doc_id) * FROM runs
        ORDER BY doc_id, length::DOUBLE / period DESC, start, period),
    listed AS (
        SELECT doc_id, count(*) AS n_runs, string_agg(concat(
            start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
            flatten(list(range(start + period, start + length))) AS gone
        FROM runs GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start,
           length::BIGINT AS length, period::BIGINT AS period,
           (1000 * length // period)::BIGINT AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256,
           sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(
               list_filter(range(0, n), lambda i: NOT list_contains(gone, i)),
               lambda i: w[i + 1]) END, ' '), '')) AS collapsed_sha256
    FROM tailed LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)
""")
def op11_periodic_runs(spark, folder):
    found = runs.detect(_tailed(table(spark, folder, "documents"))).withColumn(
        "best", runs.strongest("runs"))
    lines = F.array_join(F.transform("runs", lambda run: F.concat(
        run["start"], F.lit(","), run["length"], F.lit(","), run["period"], F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _tailed(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by a checksum of the id, gets a periodic tail."""
    drawn = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary"))
                        .alias("h"))
    # Only the texts that change are split here.
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    split = drawn.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn(
        "n", F.size("w").cast("long"))
    placed = split.withColumn("a", F.expr("(h div 10) % n")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    tail = F.expr("array_join(concat(slice(w, 1, int(a)), transform("
                  "sequence(a, n - 1), i -> w[int(a + (i - a) % p)])), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text"))
                         .alias("text"))


def _edit(initial: str, cost: str, state: str, line: str | None = None) -> str:
    """SQL of a state's best way with an edit before it."""
    said = f"list_prepend({line}, {state}.said)" if line else f"{state}.said"
    return f"{{'cost': {state}.cost + {cost}, 'audit': '{initial}' || {state}.audit, 'said': {said}}}"


def _stayed(state: str, kept: str, then: str, name: str) -> str:
    """SQL of the best edit of a row before which a conversation is in a state."""
    return (f"list_min(CASE WHEN gone THEN [{_edit('D', '4', state)}] ELSE [{_edit('D', '4', state)}, "
            f"{kept}, {_edit('R', '3 + cut', then, f"'{name}:' || text")}] END)")


def _kept(initial: str, then: str) -> str:
    return f"WHEN '{initial}' THEN {_edit('K', 'cut', then, "role || ':' || text")}"


def _inserted() -> str:
    """SQL of the states' best ways, inserts included, from those without (bn, bs, bu, ba)."""
    user = f"list_min([bu, {_edit('I', '3', 'ba', "'assistant:'")}])"
    return (f"SELECT conv_id, i, list_min([bn, {_edit('I', '3', 'u', "'user:'")}]) AS n, "
            f"list_min([bs, {_edit('I', '3', 'u', "'user:'")}]) AS s, u, a FROM ("
            f"SELECT *, {user} AS u, list_min([ba, {_edit('I', '3', 'bu', "'user:'")}]) AS a FROM")


_OPEN = "{'cost': 1000000000, 'audit': '', 'said': []::VARCHAR[]}"
_DONE = "{'cost': 0, 'audit': '', 'said': []::VARCHAR[]}"


@query(rf"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k
        FROM conversations),
    drawn AS (SELECT *, {CRC32} % 20 AS h FROM keyed),
    damaged AS (
        SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
               CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM drawn, (VALUES (0), (1)) AS c(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
    placed AS (
        SELECT *, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
            rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS shown
        FROM damaged),
    told AS (
        SELECT *, shown = '' AS blank, shown <> '' AND row_number() OVER (
                PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1)
                NOT IN ('su', 'ua', 'au'), false) AS seam
        FROM placed),
    faults AS (
        SELECT *, blank OR again AS gone,
            3 * (NOT blank AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?'))::INT AS cut
        FROM told),
    totals AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
            count(*) FILTER (cut > 0) AS truncated, count(*) FILTER (seam) AS illegal,
            max(i) + 1 AS i FROM faults GROUP BY conv_id),
    walk AS (
        {_inserted()} (SELECT conv_id, i, {_DONE} AS bn, {_OPEN} AS bs, {_OPEN} AS bu,
                              {_DONE} AS ba FROM totals))
        UNION ALL
        {_inserted()} (
            SELECT w.conv_id, f.i,
                {_stayed('n', f"CASE left(role, 1) {_kept('s', 's')} {_kept('u', 'u')} END", 'u', 'user')} AS bn,
                {_stayed('s', f"CASE left(role, 1) {_kept('u', 'u')} END", 'u', 'user')} AS bs,
                {_stayed('u', f"CASE left(role, 1) {_kept('a', 'a')} END", 'a', 'assistant')} AS bu,
                {_stayed('a', f"CASE left(role, 1) {_kept('u', 'u')} END", 'u', 'user')} AS ba
            FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
                AND f.i = w.i - 1)))
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(n.cost, 0)::BIGINT AS cost,
           coalesce(n.audit, '') AS audit,
           sha256(coalesce(array_to_string(n.said, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = 1
""")
def op12_conversation_repair(spark, folder):
    damaged = _damaged(table(spark, folder, "conversations"))
    return conversations.summary(conversations.repair(damaged, present="present"))


def _damaged(rows: DataFrame) -> DataFrame:
    """A fifth of the rows is dropped, emptied, cut, repeated or given to the user."""
    key = F.concat(*(F.coalesce(F.col(name).cast("string"), F.lit(" ")) if name else F.lit(":")
                     for name in ("conv_id", None, "turn")))
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    drawn = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                        (F.crc32(key.cast("binary")) % 20).alias("h"))
    return drawn.select(
        "conv_id", "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("h") != 0).alias("present"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))


@query()
def op13_toxicity(spark, folder):
    # A third of the ids is held out of the fit.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                          F.lit(False))
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels").filter(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                              "predicted")
