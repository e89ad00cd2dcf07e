import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from reknit.operators import joins, quality
from reknit.operators import rows as row_ops
from reknit.operators.documents import enrich_json, group_pairs
from reknit.operators.extract import SENSOR_GUARD, extract_facts, sensor_facts
from reknit.operators.hierarchy import derive_parents, link_parents
from reknit.operators.keys import allocate_ids, number_rows
from reknit.operators.links import codes_to_links
from reknit.operators.upsert import add_to_list, insert_ignore, insert_missing, overwrite_matched
from reknit.session import materialize


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_anti_join_with_or_has_no_nested_loop(frame, rows):
    left = frame("id long, name string", (1, "A"), (2, "b"), (3, None), (4, "D"))
    right = frame("id long, name string", (1, "x"), (9, "B"), (None, "d"))
    kept = joins.keep_absent_any(left, right, "id", [(F.upper("name"), F.upper("name"))])
    assert "NestedLoop" not in plan_of(kept) and "Cartesian" not in plan_of(kept)
    assert rows(kept) == [(3, None)]


def test_not_in(frame, rows):
    left = frame("k long", (1,), (2,), (None,))
    assert rows(joins.keep_not_in(left, frame("k long", (1,)), "k")) == [(2,)]
    assert rows(joins.keep_not_in(left, frame("k long", (1,), (None,)), "k")) == []
    assert rows(joins.keep_not_in(left, frame("k long"), "k")) == [(1,), (2,), (None,)]


def test_update_from_takes_the_smallest_source_row(frame, rows):
    target = frame("id long, mail string, name string", (1, "a", "x"), (2, None, "y"), (3, "b", "z"))
    source = frame("sid long, mail string, name string",
                   (8, "a", "late"), (7, "a", "early"), (6, None, "never"))
    done = joins.update_from(target, source, "mail", {"name": F.col("source.name")}, order=["sid"])
    assert rows(done, "id", "name") == [(1, "early"), (2, "y"), (3, "z")]


def test_update_from_can_set_null(frame, rows):
    target = frame("id long, name string", (1, "x"), (2, "y"))
    source = frame("id long, name string", (1, None))
    done = joins.update_from(target, source, "id", {"name": F.col("source.name")})
    assert rows(done) == [(1, None), (2, "y")]


def test_lookup(frame, rows):
    dimension = frame("name string, id long", ("a", 5), ("a", 4), (None, 1))
    found = joins.lookup(frame("n string", ("a",), ("z",), (None,)), dimension,
                         [("n", "name")], "id", "out")
    assert rows(found, "n", "out") == sorted([("a", 4), ("z", None), (None, None)], key=repr)


def test_one_per_key_keeps_null_keys(frame, rows):
    df = frame("k long, v long, w string", (1, 3, "a"), (1, 2, "z"), (None, 1, "q"), (None, 1, "p"))
    assert rows(joins.one_per_key(df, ["k"], ["v"])) == sorted(
        [(1, 2, "z"), (None, 1, "p")], key=repr)


@pytest.mark.parametrize("unique", [True, False])
def test_numbers_are_dense_and_ordered(spark, rows, unique):
    df = spark.range(5_000).selectExpr("(id * 7919) % 5000 AS v", "id % 3 AS w")
    numbered = number_rows(df, ["v"], "n", unique).orderBy("n").collect()
    assert [(r.v, r.n) for r in numbered] == [(i, i + 1) for i in range(5_000)]


def test_identical_rows_get_numbers_each(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id < 25000 THEN 5 ELSE id % 10 END AS v")
    numbered = number_rows(df, ["v"], "n").collect()
    assert sorted(r.n for r in numbered) == list(range(1, 30_001))
    by_number = [r.v for r in sorted(numbered, key=lambda r: r.n)]
    assert by_number == sorted(by_number)


def test_allocate_ids(frame, rows):
    new = frame("name string", ("b",), ("a",))
    assert rows(allocate_ids(new, frame("id long", (7,)), "id", ["name"])) == [(8, "a"), (9, "b")]
    assert rows(allocate_ids(new, frame("id long", (7,)), "id", ["name"], gap=1)) == [
        (10, "b"), (9, "a")]
    assert rows(allocate_ids(new, frame("id long"), "id", ["name"])) == [(1, "a"), (2, "b")]


def test_append(frame, rows):
    target = frame("a long, b string, c boolean", (1, "x", True))
    new = frame("b string, a int", ("y", 2))
    assert rows(row_ops.append(target, new, {"c": F.lit(False)})) == [(1, "x", True), (2, "y", False)]
    assert rows(row_ops.append(target, new)) == [(1, "x", True), (2, "y", None)]
    assert rows(row_ops.append_positional(target, frame("p long, q string", (3, "z")))) == [
        (1, "x", True), (3, "z", None)]
    with pytest.raises(ValueError, match="oops"):
        row_ops.append(target, frame("oops long", (1,)))


def test_delete_keeps_null(frame, rows):
    df = frame("a long", (1,), (2,), (None,))
    assert rows(row_ops.delete_where(df, F.col("a") != 2)) == sorted([(2,), (None,)], key=repr)


def test_set_where_sees_the_old_row(frame, rows):
    df = frame("id long, mail string, url string", (1, "www", None), (2, "m", "u"))
    moved = row_ops.set_where(df, F.col("id") == 1, {"mail": F.lit(None), "url": F.col("mail")})
    assert rows(moved) == [(1, None, "www"), (2, "m", "u")]


def test_cascade():
    edges = [("b", "a"), ("c", "b"), ("a", "c"), ("e", "d")]
    assert row_ops.cascade(edges, ["a"]) == {"a", "b", "c"}


def test_truncate_cascade(frame):
    tables = {name: frame("x long", (1,)) for name in "abd"}
    left = row_ops.truncate_cascade(tables, [("b", "a"), ("zz", "a")], ["a"])
    assert {name: df.count() for name, df in left.items()} == {"a": 0, "b": 0, "d": 1}


def test_fill_uuid_is_fixed(frame, rows):
    filled = row_ops.fill_uuid(frame("id long, u string", (1, None), (2, "kept"), (3, None)), "u")
    first, second = rows(filled), rows(filled)
    assert first == second and ("kept" in {u for _, u in first})
    assert len({u for _, u in first}) == 3 and all(u for _, u in first)


def greedy(target, new, keys):
    """Row by row, as an insert that ignores conflicts."""
    taken = [{tuple(r[i] for i in key) for r in target} for key in keys]
    kept = []
    for row in sorted(new, key=lambda r: tuple((v is not None, v) for v in r)):
        values = [tuple(row[i] for i in key) for key in keys]
        if any(v in seen and None not in v for v, seen in zip(values, taken)):
            continue
        kept.append(row)
        for v, seen in zip(values, taken):
            seen.add(v)
    return sorted(kept, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_insert_ignore_with_two_keys(frame, rows, seed):
    chance = random.Random(seed)
    pick = lambda: (chance.choice([None, *range(6)]), chance.choice([None, *"abcde"]))
    target = [(100, "a")] if seed else []
    new = [pick() for _ in range(25)]
    done = insert_ignore(frame("x long, y string", *target), frame("x long, y string", *new),
                         ["x"], ["y"], order=["x"])
    assert rows(done) == sorted([*target, *greedy(target, new, [(0,), (1,)])], key=repr)


def test_insert_ignore_twice_changes_nothing(frame, rows):
    target = frame("id long, code string, note string", (4, "a", "old"))
    new = frame("code string, note string", ("b", "2"), ("b", "1"), ("a", "x"), ("c", "3"))
    once = materialize(insert_ignore(target, new, ["code"], id="id", order=["code"]))
    assert rows(once) == [(4, "a", "old"), (5, "b", "1"), (6, "c", "3")]
    assert rows(insert_ignore(once, new, ["code"], id="id", order=["code"])) == rows(once)


def test_insert_missing_twice_changes_nothing(frame, rows):
    target = frame("id long, uuid string", (1, "u1"))
    source = frame("uuid string", ("u1",), ("u2",))
    once = materialize(insert_missing(target, source, "uuid", id="id"))
    assert rows(once) == [(1, "u1"), (2, "u2")]
    assert rows(insert_missing(once, source, "uuid", id="id")) == rows(once)


def test_overwrite_ignores_null_mail(frame, rows):
    target = frame("id long, mail string, doc string", (1, None, "a"), (2, "m", "b"))
    partner = frame("pid long, mail string, doc string", (9, "m", "nine"), (3, "m", "three"),
                    (1, None, "none"))
    done = overwrite_matched(target, partner, "mail", {"doc": F.col("source.doc")}, id="pid")
    assert rows(done, "id", "doc") == [(1, "a"), (2, "three")]


def test_unknown_list_adds_nothing(frame, rows):
    links = frame("id_liste long, id_nom long", (1, 5))
    lists = frame("id_liste long, code_liste string", (1, "A"))
    members = frame("id_nom long", (5,), (6,))
    assert rows(add_to_list(links, members, lists, "B", "id_nom")) == [(1, 5)]
    assert rows(add_to_list(links, members, lists, "A", "id_nom")) == [(1, 5), (1, 6)]


def test_group_pairs(frame, rows):
    children = frame("p long, k long, v string", (1, 10, "b"), (1, 9, "a"), (1, 9, "a"), (2, 1, None))
    assert rows(group_pairs(children, "p", "k", "v", "j")) == [
        (1, '[{"9":"a"},{"9":"a"},{"10":"b"}]'), (2, '[{"1":null}]')]


ZONES = "id long, doc string"


def enriched(frame, merge, strict=False):
    zones = frame(ZONES, (1, '{"o":{"i":5,"p":{"old":1}}}'), (2, '{"o":{"i":6}}'), (3, None),
                  (4, '{"x":1}'))
    children = frame("i long, k long, v string", (5, 1, "a"), (6, 2, "b"), (7, 3, "c"))
    key = F.get_json_object("doc", "$.o.i").cast("long")
    return enrich_json(zones, children, "i", "k", "v", key, "doc", ["o", "p"], "items",
                       merge=merge, strict_null=strict)


def test_enrich_replaces(frame, rows):
    assert rows(enriched(frame, merge=False)) == [
        (1, '{"o":{"i":5,"p":{"items":[{"1":"a"}]}}}'),
        (2, '{"o":{"i":6,"p":{"items":[{"2":"b"}]}}}'), (3, None), (4, '{"x":1}')]


def test_enrich_merges(frame, rows):
    assert rows(enriched(frame, merge=True))[:2] == [
        (1, '{"o":{"i":5,"p":{"items":[{"1":"a"}],"old":1}}}'),
        (2, '{"o":{"i":6,"p":{"items":[{"2":"b"}]}}}')]


def test_enrich_strict_wipes_documents_without_the_object(frame, rows):
    assert rows(enriched(frame, merge=True, strict=True))[1] == (2, None)


def test_codes(frame, rows):
    areas = frame("id long, codes string", (1, "A, old"), (2, ""), (3, None), (4, "A,A"))
    dimension = frame("code string, value long, kind string", ("A", 7, "t"), ("A", 8, "u"),
                      ("new", 9, "t"))
    mapping = frame("source_code string, standard_code string", ("old", "new"), ("A", "new"))
    args = (areas, "id", "codes", dimension, "code", "value")
    assert rows(codes_to_links(*args)) == [(1, 7), (1, 8), (4, 7), (4, 8)]
    assert rows(codes_to_links(*args, mapping)) == [(1, 7), (1, 8), (1, 9), (4, 7), (4, 8), (4, 9)]
    assert rows(codes_to_links(*args, type_column="kind", type_name="t")) == [(1, 7), (4, 7)]


def test_parents(frame, rows):
    plots = frame("id long, transect long, code string, distance long, parent long",
                  (1, 1, "A.1", 5, None), (2, 1, "A.2", 6, None), (3, 1, "B.1.2", 7, None),
                  (4, 2, "C.1", 8, None), (5, 2, "C", 8, None), (6, 2, "D", 9, None))
    shape = dict(id="id", code="code", by=["transect"], moved="distance", parent="parent")
    once = materialize(link_parents(materialize(derive_parents(plots, **shape)), **shape))
    assert rows(once) == sorted([
        (1, 1, "A.1", None, 7), (2, 1, "A.2", None, 7), (3, 1, "B.1.2", None, 9),
        (4, 2, "C.1", None, 5), (5, 2, "C", 8, None), (6, 2, "D", 9, None),
        (7, 1, "A", 5, None), (8, 1, "A", 6, None), (9, 1, "B", 7, None)], key=repr)
    again = link_parents(materialize(derive_parents(once, **shape)), **shape)
    assert rows(again) == rows(once)


def test_sensors(frame, rows):
    texts = frame("id long, text string",
                  (1, "Capteur de température n°AB 12 (2020-01-02)"),
                  (2, "Vu (2019-05-06). Capteur temperature n°X7 (2020/01/02)"),
                  (3, "capteur de température n°X7 (2020-01-02)"), (4, None), (5, "rien"))
    found = extract_facts(texts, "text", SENSOR_GUARD, sensor_facts("text"))
    assert rows(found, "id", "serial_number", "install_date") == [
        (1, "..?..", date(2020, 1, 2)), (2, "X7", date(2019, 5, 6))]


def test_unique(frame, rows):
    df = frame("mail string", ("a",), ("a",), (None,), (None,), ("b",))
    assert rows(quality.check_unique(df, ["mail"])) == [("a", 2)]


def test_import_figures(spark, frame, rows):
    steps = frame("t long", (100_000,), (100_001,), (2_500_000,), (2_500_001,), (None,))
    assert rows(steps.select("t", quality.import_step("t"))) == sorted(
        [(100_000, 10_000), (100_001, 100_000), (2_500_000, 100_000), (2_500_001, 500_000),
         (None, None)], key=repr)
    batch = frame("meta_last_action string", ("I",), ("I",), ("U",), (None,))
    assert quality.import_total({"gn_imports.visits": batch}, "Visits", "I") == 2
    with pytest.raises(ValueError, match="3 parts"):
        quality.import_total({}, "a.b.c", "I")
    assert rows(quality.import_plan(batch.dropna())) == [("I", 2, 10_000, 1), ("U", 1, 10_000, 1)]


def test_import_total_from_the_catalog(spark, frame):
    frame("meta_last_action string", ("I",)).createOrReplaceTempView("visits_now")
    assert spark.table("visits_now").count() == 1
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND|SCHEMA_NOT_FOUND"):
        quality.import_total(spark, "visits_now", "I")


def test_diff_report(frame, rows):
    left = frame("i long, taxon long", (1, 5), (2, 6), (3, None), (4, None), (5, 1))
    right = frame("i long, taxon long", (1, 5), (2, 7), (3, 8), (4, None), (6, 1))
    report = quality.diff_report(left, right, ["i"], "taxon", {
        "i": F.col("left.i"), "ours": F.col("left.taxon"), "theirs": F.col("right.taxon")})
    assert rows(report) == [(2, 6, 7), (3, None, 8)]


def test_no_python_in_plans(frame):
    zones = enriched(frame, merge=True)
    assert "Python" not in plan_of(zones) and "Arrow" not in plan_of(zones)
