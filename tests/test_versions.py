"""Published versions: rewritten files, conflicts, foreign keys, refused requests, counters."""

import os
import random

import pytest
from pyspark.sql import functions as F

from reknit.operators import joins
from reknit.operators.merge import KeyRule, LinkRule, MergeSpec, judge_requests, resolve_requests
from reknit.operators.references import ForeignKey, dangling
from reknit.operators.sequences import Counter, counter_of, draw_ids
from reknit.plans.merge_entities import merge_from_arguments, merge_what_can_be
from reknit.sources.imports import finished_steps, run_import
from reknit.sources.publish import (
    ConflictError, DanglingError, publish, published_versions, read_published)
from reknit.sources.tables import read_with_rejects
from reknit.sources.touched import (
    files_holding, merge_touched, set_where_touched, update_from_touched)


def data_files(root, name):
    return {n for d, _, names in os.walk(root) for n in names
            if n.startswith("part-") and d.endswith(f"/{name}")}


@pytest.fixture
def base(spark, tmp_path):
    """People and links in ten files each, by person; a table that no merge lists."""
    root = str(tmp_path / "root")
    ids = spark.range(1000).withColumnRenamed("id", "person")
    publish(spark, {
        "people": ids.select(F.col("person").alias("id"), F.lit("p").alias("name"))
        .repartitionByRange(10, "id"),
        "links": ids.selectExpr("person", "person % 7 AS thing").repartitionByRange(10, "person"),
        "notes": ids.selectExpr("person", "-person AS other").repartitionByRange(10, "person"),
        "visits": ids.selectExpr("person % 50 AS visitor")}, root)
    return read_published(spark, root)


SPEC = MergeSpec("people", "id", links=[LinkRule("links", "person", ("thing",))],
                 keys=[KeyRule("notes", "person"), KeyRule("gone", "person", optional=True)])


def test_only_files_with_merged_ids_are_rewritten(spark, base, rows):
    before = {name: data_files(base.root, name) for name in base}
    version = merge_from_arguments(spark, base, SPEC, [(3, "4, 5"), (950, "951")], base.root)
    done = read_published(spark, base.root)
    assert done.version == version
    for name in ("people", "links", "notes"):
        kept = set(base.files[name]) & set(done.files[name])
        # The ids lie in two of ten files.
        assert len(kept) == 8 and len(data_files(base.root, name) - before[name]) <= 2
    assert done.files["visits"] == base.files["visits"]
    gone = {4: 3, 5: 3, 951: 950}
    assert rows(done["people"], "id") == sorted(
        ((k,) for k in range(1000) if k not in gone), key=repr)
    assert rows(done["links"]) == sorted(
        {(gone.get(k, k), k % 7) for k in range(1000)}, key=repr)
    assert rows(done["notes"]) == sorted(
        ((gone.get(k, k), -k) for k in range(1000)), key=repr)
    # The earlier version still reads as it was.
    assert read_published(spark, base.root, base.version)["people"].count() == 1000


def test_collisions_with_rows_of_kept_files(spark, tmp_path, rows):
    """A survivor's row lies in another file than the row that collides with it."""
    root = str(tmp_path / "root")
    links = spark.createDataFrame([(1, 7), (500, 7), (500, 8), (501, 8)], "person long, thing long")
    publish(spark, {"people": spark.range(600), "links": links.repartitionByRange(3, "person")},
            root)
    base = read_published(spark, root)
    spec = MergeSpec("people", "id", links=[LinkRule("links", "person", ("thing",))])
    keymap = resolve_requests(spark.createDataFrame([(1, 500, 1), (2, 501, 1)],
                                                    "step long, old_id long, new_id long"))
    merged, rewrites = merge_touched(base, spec, keymap)
    assert rows(merged["links"]) == [(1, 7), (1, 8)]
    # Where no file holds a merged id, the table is the very same one.
    merged, rewrites = merge_touched(base, spec, resolve_requests(spark.createDataFrame(
        [(1, 9000, 1)], "step long, old_id long, new_id long")))
    assert not rewrites and merged["links"] is base["links"]
    assert files_holding(base["links"], ["person"], spark.range(1, 2)) and not files_holding(
        base["links"], ["person"], spark.range(0))


def test_updates_rewrite_few_files(spark, base, rows):
    changed, rewrites = set_where_touched(base, "people", F.col("id").between(10, 12),
                                          {"name": F.lit("x")})
    assert len(rewrites["people"].kept) == 9
    publish(spark, changed, base.root, base, rewrites)
    base = read_published(spark, base.root)
    source = spark.createDataFrame([(998, "y"), (998, "z"), (5000, "no"), (None, "no")],
                                   "key long, name string")
    changed, rewrites = update_from_touched(base, "people", source, "id", "key",
                                            {"name": F.col("source.name")})
    assert len(rewrites["people"].kept) == 9
    publish(spark, changed, base.root, base, rewrites)
    found = read_published(spark, base.root)["people"].filter("name <> 'p'")
    assert rows(found, "id", "name") == [(10, "x"), (11, "x"), (12, "x"), (998, "y")]
    nothing, none = set_where_touched(base, "people", F.col("id") < 0, {"name": F.lit("n")})
    assert not none and nothing["people"] is base["people"]


def test_second_writer_of_a_table_is_refused(spark, base, frame, rows):
    root = base.root
    other = read_published(spark, root)
    first = publish(spark, {**base, "visits": frame("visitor long", (1,))}, root, base)
    with pytest.raises(ConflictError, match="visits"):
        publish(spark, {**other, "visits": frame("visitor long", (2,))}, root, other)
    with pytest.raises(ConflictError, match="visits"):
        publish(spark, {**other, "links": other["links"].limit(1)}, root, other, reads=["visits"])
    assert published_versions(spark, root)[-1] == first
    # Other tables are put on top of the first writer's version; a dropped one stays away.
    kept = {name: table for name, table in other.items() if name != "notes"}
    second = publish(spark, {**kept, "extra": frame("x long", (5,))}, root, other)
    done = read_published(spark, root)
    assert done.version == second > first
    assert rows(done["visits"]) == [(1,)] and rows(done["extra"]) == [(5,)]
    assert "notes" not in done and done.files["links"] == base.files["links"]


def test_sequences_conflict_too(spark, frame, tmp_path):
    root = str(tmp_path / "root")
    publish(spark, {"a": frame("x long", (1,))}, root, sequences={"a.x": Counter(1, True)})
    one, other = read_published(spark, root), read_published(spark, root)
    publish(spark, dict(one), root, one, sequences={"a.x": Counter(5, True)})
    with pytest.raises(ConflictError, match="a.x"):
        publish(spark, dict(other), root, other, sequences={"a.x": Counter(7, True)})
    publish(spark, dict(other), root, other, sequences={"b.y": Counter()})
    assert read_published(spark, root).sequences == {"a.x": Counter(5, True), "b.y": Counter()}


def test_empty_tables_keep_their_columns(spark, frame, tmp_path):
    root = str(tmp_path / "root")
    publish(spark, {"a": frame("x long, y string", (1, "a")).limit(0)}, root)
    found = read_published(spark, root)["a"]
    assert found.count() == 0 and found.dtypes == [("x", "bigint"), ("y", "string")]


def test_a_merge_that_leaves_rows_behind_is_not_published(spark, base):
    keys = [ForeignKey("visits", "visitor", "people", "id"),
            ForeignKey("links", "person", "people", "id")]
    with pytest.raises(DanglingError, match="visits.visitor = 4 .20 rows. is not in people"):
        merge_from_arguments(spark, base, SPEC, [(3, "4")], base.root, keys)
    assert published_versions(spark, base.root) == [base.version]
    merge_from_arguments(spark, base, SPEC, [(3, "400")], base.root, keys)
    assert len(published_versions(spark, base.root)) == 2


def test_dangling_values_are_counted_once(spark, frame, rows):
    snapshot = {"child": spark.range(10_000).selectExpr("IF(id % 3 = 0, 77, id % 5) AS p"),
                "nulls": frame("p long", (None,), (None,)), "parent": frame("id long", (0,), (1,))}
    keys = [ForeignKey("child", "p", "parent", "id"), ForeignKey("nulls", "p", "parent", "id"),
            ForeignKey("absent", "p", "parent", "id")]
    found = dangling(snapshot, keys)
    counts = {r.value: r.rows for r in found.collect()}
    assert counts["77"] == 3334 and set(counts) == {"77", "2", "3", "4"}
    assert rows(dangling(snapshot, keys, frame("id long", (3,))), "value") == [("3",)]
    assert dangling({"parent": snapshot["parent"]}, keys).count() == 0


def one_by_one(requests):
    """Each request as a transaction of its own."""
    dead, out = set(), []
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    for step, old, new in sorted(requests, key=order):
        reason = None
        if None in (step, old, new):
            reason = "incomplete"
        elif old == new:
            reason = "merged into itself"
        elif old in dead:
            reason = "merged away earlier"
        elif new in dead:
            reason = "survivor merged away earlier"
        else:
            dead.add(old)
        out.append((step, old, new, reason))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_requests_as_one_by_one(spark, rows, seed):
    draw = random.Random(seed)
    top = (8, 30, 200)[seed % 3]
    requests = [(draw.choice([draw.randrange(60), None] if seed == 5 else [draw.randrange(60)]),
                 draw.randrange(top), draw.randrange(top)) for _ in range(80)]
    if seed == 0:
        # A chain against its order: every request waits for the one before.
        requests = [(k, 12 - k, 13 - k) for k in range(12)] + [(3, 9, 10)]
    df = spark.createDataFrame(requests, "step long, old_id long, new_id long")
    assert rows(judge_requests(df)) == one_by_one(requests)


def test_valid_requests_are_merged_and_the_others_written(spark, base, tmp_path, rows):
    requests = [(1, 10, 11), (2, 11, 11), (3, 12, 10), (4, 12, 11), (5, 10, 12)]
    refused = str(tmp_path / "refused")
    merge_what_can_be(spark, base, SPEC, spark.createDataFrame(
        requests, "step long, old_id long, new_id long"), base.root, refused)
    assert rows(spark.read.parquet(refused)) == [
        r for r in one_by_one(requests) if r[3] is not None]
    done = read_published(spark, base.root)
    assert done["people"].count() == 998
    assert rows(done["notes"].filter("person = 11")) == [(11, -10), (11, -11), (11, -12)]


def test_ids_never_come_back(spark, frame, rows, tmp_path):
    root = str(tmp_path / "root")
    table = frame("id long, label string", (1, "a"), (2, "b"), (9, "c"))
    assert counter_of(table.limit(0), "id") == Counter()
    publish(spark, {"t": table}, root, sequences={"t.id": counter_of(table, "id")})
    base = read_published(spark, root)
    publish(spark, {"t": base["t"].filter("id < 2")}, root, base)
    base = read_published(spark, root)
    drawn, after = draw_ids(frame("label string", ("y",), ("x",), ("x",)),
                            base.sequences["t.id"], "id", ["label"])
    assert rows(drawn) == [(10, "x"), (11, "x"), (12, "y")] and after == Counter(12, True)
    nothing, same = draw_ids(drawn.limit(0), after, "id", ["label"])
    assert nothing.count() == 0 and same == after
    # As setval: the value is the next one unless it counts as given out.
    assert Counter().set(41).next == 42 and Counter().set(41, False).next == 41
    assert Counter(5, True).at_least(3) == Counter(5, True)
    assert Counter(5, True).at_least(8).next == 9 and Counter().next == 1


def test_an_import_goes_on_where_it_stopped(spark, rows, tmp_path):
    root = str(tmp_path / "import")
    source = spark.range(95).selectExpr("95 - id AS key", "'x' AS label")
    seen = []

    def work(part, stop=None):
        if stop is not None and len(seen) == stop:
            raise InterruptedError
        seen.append(sorted(r.key for r in part.collect()))
        return part.withColumn("label", F.concat("label", F.lit("!")))

    with pytest.raises(InterruptedError):
        run_import(spark, source, ["key"], lambda part: work(part, 3), root, 20, unique=True)
    assert finished_steps(spark, root) == {0, 1, 2}
    done = run_import(spark, source, ["key"], work, root, 20, unique=True)
    # Every row once, in order, and the first steps not again.
    assert [k for step in seen for k in step] == list(range(1, 96)) and len(seen) == 5
    assert rows(done) == rows(source.selectExpr("key", "'x!' AS label"))
    assert rows(run_import(spark, source, ["key"], work, root)) == rows(done) and len(seen) == 5
    empty = run_import(spark, source.limit(0), ["key"], lambda part: part, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.columns == ["key", "label"]


def test_records_that_do_not_fit(spark, rows, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,more\n1,a,x\nb,c,x\n3,"d, e",x\n4\n5,f,x,y\n,g,\n')
    good, rejects = read_with_rejects(spark, str(path), "id int, name string")
    assert rows(good) == sorted([(1, "a"), (3, "d, e"), (None, "g")], key=repr)
    assert {r.record for r in rejects.collect()} == {"b,c,x", "5,f,x,y", "4"}
    assert all(r.file.endswith("in.csv") for r in rejects.collect())
    with pytest.raises(ValueError, match="no column city"):
        read_with_rejects(spark, str(path), "id int, city string")


def test_typed_lookups(spark, frame, rows, monkeypatch):
    dimension = frame("kind string, code string, id long", ("a", "x", 1), ("a", "y", 2),
                      ("a", "y", 0), ("b", "x", 3), ("b", None, 4), ("c", "z", 5))
    data = frame("k long, one string, other string", (1, "x", "x"), (2, "y", None), (3, "q", "y"))
    columns = {"p": ("a", "one"), "q": ("b", "one"), "r": ("a", "other"), "s": ("none", "one")}
    wanted = [(1, 1, 3, 1, None), (2, 0, None, None, None), (3, None, None, 0, None)]
    for most in (1_000, 1, 0):
        monkeypatch.setattr(joins, "PACKED_CODES", most)
        found = joins.lookup_types(data, dimension, "kind", "code", "id", columns)
        assert found.columns == ["k", "one", "other", "p", "q", "r", "s"]
        assert rows(found, "k", *columns) == sorted(wanted, key=repr)
    assert rows(joins.unresolved_codes(found, columns)) == [
        ("a", "q", 1), ("b", "q", 1), ("b", "y", 1), ("none", "q", 1), ("none", "x", 1),
        ("none", "y", 1)]
