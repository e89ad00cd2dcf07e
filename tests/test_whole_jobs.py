"""Jobs that write only what changed, and chains and gates of merges."""

import os
import random

import pytest
from pyspark.sql import functions as F

from reknit.operators import merge as m
from reknit.operators.merge import KeyRule, LinkRule, MergeSpec
from reknit.plans.merge_entities import merge_from_arguments
from reknit.session import job_scratch, materialize, measure, scratch_dir
from reknit.sources.publish import publish, published_versions, read_published


def files_below(path):
    return sorted(os.path.join(d, n) for d, _, names in os.walk(path) for n in names
                  if n.startswith("part-"))


def test_untouched_tables_are_shared_and_scratch_is_empty(spark, frame, rows, tmp_path):
    root = str(tmp_path / "published")
    spec = MergeSpec("people", "id", links=[LinkRule("links", "person", ("thing",))],
                     keys=[KeyRule("notes", "person")])
    publish(spark, {"people": frame("id long", (1,), (2,), (3,)),
                    "links": frame("person long, thing long", (1, 7), (2, 7), (2, 8)),
                    "notes": frame("person long", (2,), (3,)),
                    "other": frame("x long", (5,))}, root)
    before = files_below(root)
    scratch = scratch_dir(spark).removeprefix("file:")
    left = files_below(scratch)
    version = merge_from_arguments(spark, read_published(spark, root), spec, [(1, "2")], root)
    done = read_published(spark, root)
    assert rows(done["people"]) == [(1,), (3,)] and rows(done["links"]) == [(1, 7), (1, 8)]
    assert rows(done["notes"]) == [(1,), (3,)] and rows(done["other"]) == [(5,)]
    assert files_below(scratch) == left
    fresh = set(files_below(root)) - set(before)
    assert fresh and not any("/other/" in path for path in fresh)
    assert done.files["other"] == read_published(
        spark, root, published_versions(spark, root)[0]).files["other"]
    assert published_versions(spark, root)[-1] == version


def test_nested_jobs_drop_their_own(spark, frame):
    with job_scratch(spark):
        outer = materialize(frame("x long", (1,)))
        with job_scratch(spark):
            materialize(frame("x long", (2,)))
        assert outer.count() == 1
    path = outer.inputFiles()
    assert not path or not os.path.exists(path[0].removeprefix("file://"))


def by_steps(requests):
    """The order in which ids reach their survivor: walk the forest by step."""
    below = {}
    for step, old, new in sorted(requests):
        below.setdefault(new, []).append((step, old))
    olds = {old for _, old, _ in requests}
    places, survivors = {}, {}
    for top in sorted(set(below) - olds):
        stack = [old for _, old in reversed(below[top])]
        while stack:
            id = stack.pop()
            places[id], survivors[id] = len(places), top
            stack.extend(old for _, old in reversed(below.get(id, [])))
    return places, survivors


@pytest.mark.parametrize("seed", range(4))
def test_forests_are_walked_by_step(spark, frame, seed):
    draw = random.Random(seed)
    # Merged away from the largest id down, so that no survivor is gone before.
    count = 60
    requests = [(step, count - step, draw.randrange(count - step) if seed else count - step - 1)
                for step in range(count)]
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", *requests))
    found = [r for r in keymap.rows.collect() if r.prio != m.SURVIVOR]
    places, survivors = by_steps(requests)
    assert {r.id: r.survivor for r in found} == survivors
    for top in set(survivors.values()):
        mine = sorted((r.prio, r.id) for r in found if r.survivor == top)
        assert [id for _, id in mine] == sorted((r for r in survivors if survivors[r] == top),
                                                key=places.get)


def test_a_long_chain_has_rows_of_constant_size(spark):
    count = 20_000
    requests = spark.range(1, count + 1).select(
        F.col("id").alias("step"), (count + 1 - F.col("id")).alias("old_id"),
        (count - F.col("id")).alias("new_id"))
    keymap = m.resolve_requests(requests)
    assert {kind for _, kind in keymap.rows.dtypes} == {"bigint"}
    olds = keymap.rows.filter(F.col("prio") != m.SURVIVOR)
    assert olds.count() == count and olds.filter("survivor <> 0").count() == 0
    # The last merge, of id 1 into 0, brings all others; so ids arrive in their order.
    assert olds.selectExpr("corr(prio - 4611686018427367904, id) c").first().c > 0.999


def test_only_named_rows_meet_the_collisions(frame, rows, monkeypatch):
    monkeypatch.setattr(m, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(m, "broadcast_if_small", lambda df, size: df.hint("merge"))
    draw = random.Random(3)
    links = [(draw.choice([*range(12), None]), draw.choice(["a", "b", None])) for _ in range(200)]
    requests = [(1, 1, 2), (2, 3, 2), (3, 2, 4), (4, 9, 8)]
    table = frame("k long, c string", *links)
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", *requests))
    merged = m.merge_links(table, "k", ["c"], keymap)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "NestedLoop" not in plan
    large = rows(merged)
    monkeypatch.undo()
    assert large == rows(m.merge_links(table, "k", ["c"], keymap))


def test_nested_values_are_measured(frame, spark):
    long = spark.range(1).select(F.sequence(F.lit(1), F.lit(10_000)).alias("a"),
                                 F.lit(1.5).cast("decimal(20,2)").alias("d"),
                                 F.parse_json(F.lit('{"k":"' + "x" * 500 + '"}')).alias("v"))
    assert measure(long.select("a")) > 10_000
    assert measure(long.select("d")) == 16 and measure(long.select("v")) > 500
    assert measure(long.limit(0)) == 0


def test_children_are_not_shuffled_for_small_dimensions(spark, frame, rows):
    from reknit.operators.upsert import insert_children

    children = frame("parent long, a string, b string, c string", (1, "x", "y", "x"),
                     (2, "y", None, "q"))
    ours = frame("parent long, uuid string", (1, "u"), (2, "v"))
    theirs = frame("parent long, uuid string", (10, "u"), (20, "v"))
    codes = frame("code string, kind string, id long", ("x", "k", 7), ("y", "k", 8), ("x", "o", 9))
    target = frame("parent long, a string, id_a long, id_b long, id_c long")
    done = insert_children(
        target, children, ours, theirs, "parent", "uuid",
        [(codes, [(F.lit("k"), "kind"), (name, "code")], "id", f"id_{name}") for name in "abc"])
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert rows(done) == sorted([(10, "x", 7, 8, 7), (20, "y", 8, None, None)], key=repr)


def test_names_that_are_not_found_are_an_error(frame):
    from reknit.operators.seed import Reference, Seed, seed_metadata

    snapshot = {"t": frame("name string, org_id long"), "orgs": frame("id long, org string", (1, "A"))}
    seed = Seed("t", frame("name string, org string", ("n", "A"), ("m", None), ("o", "B")),
                [Reference("org_id", "orgs", [("org", "org")], "id")])
    assert seed_metadata(snapshot, [seed])["t"].count() == 3
    with pytest.raises(ValueError, match="no org_id for"):
        seed_metadata(snapshot, [seed], strict=True)
    known = Seed("t", seed.rows.filter("name <> 'o'"), seed.references)
    assert seed_metadata(snapshot, [known], strict=True)["t"].count() == 2
