"""Rows and values that must not be lost or altered on the way."""

import json

import pytest
from pyspark.sql import functions as F

from reknit.functions.documents import (
    iso_timestamp, json_holds_object, json_nested, json_text, json_typed)
from reknit.operators.documents import enrich_json
from reknit.operators.hierarchy import derive_parents, link_parents
from reknit.operators.joins import keep_absent, keep_present
from reknit.operators.people import attach_provenance
from reknit.operators.quality import diff_report
from reknit.operators.rows import fill_uuid, repeat_rows
from reknit.operators.upsert import insert_ignore, insert_missing
from reknit.sources.tables import read_delimited, read_import_batch, read_tables

SHAPE = dict(id="id", code="code", by=["transect"], moved="distance", parent="parent")
PLOTS = "id long, transect long, code string, distance int, parent long"


def test_parents_with_another_attribute_are_made(frame, rows):
    plots = frame(PLOTS, (1, 1, "A.1", 5, None), (2, 1, "A", 9, None), (3, 1, "B.1", 4, None),
                  (4, 1, "B", 4, None), (7, None, "C.1", 6, None), (8, 1, "D.1", None, 4))
    derived = derive_parents(plots, **SHAPE)
    assert rows(derived.filter("id > 8")) == sorted(
        [(9, None, "C", 6, None), (10, 1, "A", 5, None)], key=repr)
    linked = link_parents(derived, **SHAPE)
    # No distance is lost: each is on a plot still.
    assert {r[0] for r in linked.select("distance").collect()} >= {5, 9, 4, 6}
    assert derive_parents(linked, **SHAPE).count() == linked.count()
    assert derive_parents(derived, **SHAPE).count() == derived.count()


def test_texts_with_nul_and_empty_texts_stay(frame, rows):
    left = frame("k string", ("\0",), ("a",), ("",), (None,))
    right = frame("v string", (None,), ("A",))
    on = [("k", F.lower("v"))]
    assert rows(keep_absent(left, right, on)) == sorted([("\0",), ("",), (None,)], key=repr)
    assert rows(keep_present(left, right, on)) == [("a",)]
    assert rows(keep_absent(left, right.distinct(), on, unique=True)) == sorted(
        [("\0",), ("",), (None,)], key=repr)


def test_columns_are_found_by_name(spark, rows, tmp_path):
    (tmp_path / "01").mkdir()
    (tmp_path / "01" / "visits.csv").write_text("taxon,code,visit,more\nplantA,x,7,y\n")
    schema = "visit long, code string, taxon string"
    batch = read_import_batch(spark, str(tmp_path), "visits", schema, "01",
                              __import__("datetime").date(2020, 1, 1))
    assert rows(batch, "visit", "code", "taxon") == [(7, "x", "plantA")]
    found = read_tables(spark, str(tmp_path / "01"), ["visits"], "csv", {"visits": schema})
    assert rows(found["visits"]) == [(7, "x", "plantA")]
    with pytest.raises(ValueError, match="no column absent"):
        read_delimited(spark, str(tmp_path / "01" / "visits.csv"), "visit long, absent string")
    (tmp_path / "01" / "bad.csv").write_text("visit\nseven\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path / "01" / "bad.csv"), "visit long").collect()


def test_timestamps_keep_their_microseconds(frame, rows):
    times = frame("k long, at string", (1, "2020-01-01 00:00:00.123456"), (2, "2020-01-01 10:00:00"),
                  (3, None))
    target = frame("k long, doc string", (1, None), (2, None), (3, None))
    for kind in ("timestamp", "timestamp_ntz"):
        source = times.withColumn("at", F.col("at").cast(kind))
        done = attach_provenance(target, source, "k", "doc", "o", {"at": F.col("at")})
        assert rows(done) == [(1, '{"o":{"at":"2020-01-01T00:00:00.123456"}}'),
                              (2, '{"o":{"at":"2020-01-01T10:00:00"}}'), (3, '{"o":{"at":null}}')]
        assert rows(source.select(json_nested("o", at="at")).limit(1)) == [
            ('{"o":{"at":"2020-01-01T00:00:00.123456"}}',)]
        assert rows(source.select(iso_timestamp("at")))[0] == ("2020-01-01T00:00:00.123456",)


def test_equal_numbers_are_written_alike(frame):
    numbers = ["100", "100.0", "1e2", "1E+2", "-0.0", "0", "1.50", "1.5", "12345678901234567890123",
               "1e30", "1e-30", "1e300", "0.1", "-2.50e1"]
    found = [r[0] for r in frame("d string", *[('{"k":%s}' % n,) for n in numbers])
             .select(json_typed("d", "k")).collect()]
    assert found[:4] == ["100"] * 4 and found[4:6] == ["0", "0"] and found[6:8] == ["1.5", "1.5"]
    assert found[8] == "12345678901234567890123" and found[9] == "1" + "0" * 30
    assert float(found[10]) == 1e-30 and float(found[11]) == 1e300 and found[12:] == ["0.1", "-25"]
    texts = frame("d string", ('{"k":"1e2"}',), ('{"k":null}',), ('{}',), ('{"k":[1]}',))
    assert [r[0] for r in texts.select(json_typed("d", "k")).collect()] == [
        '"1e2"', "null", None, "[1]"]


def test_quotes_in_paths_and_fields(frame, rows):
    docs = frame("d string", (json.dumps({"it's": {"k": "v", "n": 1, "z": None}}),), ("{}",))
    assert [r[0] for r in docs.select(json_text("d", "it's", "k")).collect()] == ["v", None]
    assert [r[0] for r in docs.select(json_text("d", "it's", "n")).collect()] == ["1", None]
    assert [r[0] for r in docs.select(json_text("d", "it's", "z")).collect()] == [None, None]
    assert [r[0] for r in docs.select(json_typed("d", "it's", "n")).collect()] == ["1", None]
    assert [r[0] for r in docs.select(json_holds_object("d", "it's")).collect()] == [True, False]
    target = frame("id long, doc string", (1, "{}"))
    children = frame("parent long, k string, v string", (1, "x", "y"))
    for merge in (False, True):
        done = enrich_json(target, children, "parent", "k", "v", "id", "doc", ["p"], 'a"b', merge)
        assert json.loads(rows(done)[0][1]) == {"p": {'a"b': [{"x": "y"}]}}


def test_inserts_without_a_usable_key(frame, rows):
    target = frame("id long, a string, b string", (1, "x", "y"))
    assert rows(insert_ignore(target, frame("b string", ("y",), ("y",)), ["a"])) == sorted(
        [(1, "x", "y"), (None, None, "y"), (None, None, "y")], key=repr)
    done = insert_missing(target, frame("a string", ("z",)), "a", id="id", gap=1)
    assert rows(done, "id", "a") == [(1, "x"), (3, "z")]


def test_repeated_keys_are_refused(frame):
    twice, once = frame("k long, v long", (1, 1), (1, 2)), frame("k long, v long", (1, 3))
    for left, right in ((twice, once), (once, twice)):
        with pytest.raises(ValueError, match="keys repeat"):
            diff_report(left, right, ["k"], "v", {"k": F.col("left.k")})


def test_many_copies(frame):
    done = repeat_rows(frame("a string, n long", ("x", 25), ("y", 0), ("z", 10)), "n", chunk=10)
    assert {r[0]: r[1] for r in done.groupBy("a").count().collect()} == {"x": 25, "z": 10}


def test_uuids_are_made_for_rows_without(frame, rows):
    done = fill_uuid(frame("k long, u string", (1, "a"), (2, None), (3, None)), "u")
    found = dict(rows(done))
    assert found[1] == "a" and found[2] != found[3] and found == dict(rows(done))
