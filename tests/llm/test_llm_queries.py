"""The queries over the small tables: against SQL where there is some, else their contract."""

import hashlib
import re

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from reknit.llm.queries import QUERIES, SQL
from reknit.llm.shingles import words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        path = spark_path(name)
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def spark_path(name):
    import os
    path = f"{SF}/{name}.parquet"
    return f"{path}/*.parquet" if os.path.isdir(path) else path


def test_one_query_per_operator():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    found, wanted = QUERIES[name](spark, SF).toArrow(), duck.sql(SQL[name]).to_arrow_table()
    columns = sorted(found.column_names)
    assert columns == sorted(wanted.column_names)
    for column in columns:
        assert found.schema.field(column).type == wanted.schema.field(column).type, column
    rows = [sorted(map(repr, zip(*(t[c].to_pylist() for c in columns)))) for t in (found, wanted)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("name, source, id", [
    ("op1_license_scans", "documents", "doc_id"), ("op2_secret_scans", "documents", "doc_id"),
    ("op3_quality_classifier", "documents", "doc_id"), ("op6_url_filters", "pages", "page_id"),
    ("op7_sentencepiece", "documents", "doc_id"), ("op13_toxicity", "documents", "doc_id")])
def test_a_row_for_each_row(spark, name, source, id):
    found = QUERIES[name](spark, SF)
    table = spark.read.parquet(f"{SF}/{source}.parquet")
    assert sorted(r[0] for r in found.select(id).collect()) == sorted(
        r[0] for r in table.select(id).collect())


def test_pieces_and_lengths(spark):
    assert QUERIES["op7_sentencepiece"](spark, SF).filter("NOT round_trip OR n_ids = 0").count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    found = QUERIES["op9_token_counts"](spark, SF)
    assert found.agg({"docs": "sum"}).first()[0] == docs


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before it kept, against plain rules."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF)
        path = str(tmp_path / str(number))
        result.write.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
        docs = spark.read.parquet(path)
        kept[name] = {row.doc_id: row for row in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    for one, other in zip(names, names[1:]):
        assert set(kept[other]) <= set(kept[one])
    assert len(kept["quality classifier"]) > 150
    # Of two texts that are alike one has gone.
    sets = []
    for row in kept["near dedup"].values():
        words = words_of(row.text)
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))})
    for k, one in enumerate(sets):
        assert not any(len(one & other) >= 0.8 * len(one | other) for other in sets[:k])
    for row in kept["secret scans"].values():
        assert not re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", row.text)
        assert row.n_chars == len(row.text)
    coded = kept["tokens"]
    assert all(row.round_trip and row.n_ids == len(row.ids) for row in coded.values())
    run = corpus_pipeline.run(spark, SF)
    digest = lambda ids: hashlib.sha256(str(ids).encode()).hexdigest()
    assert {row.doc_id: digest(row.ids) for row in run.collect()} == {
        id: digest(row.ids) for id, row in coded.items()}


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        assert result.count() == 0, name
        docs = result if name != "tokens" else docs
