"""Merging against a model that applies the requests one by one."""

import random

import pytest

from reknit.operators import merge as m
from reknit.sources.requests import merge_requests, read_merge_requests


def sequential(links, requests):
    """Links (key, compare) after one transaction per request."""
    links = list(links)
    for _, old, new in sorted(requests):
        taken = {c for k, c in links if k == new and c is not None}
        links = [(new, c) if k == old and c not in taken else (k, c)
                 for k, c in links if not (k == old and c in taken)]
    return sorted(links, key=repr)


def random_case(seed):
    """Valid requests with chains, and links with repeats and NULLs."""
    chance = random.Random(seed)
    ids = list(range(1, 13))
    chance.shuffle(ids)
    alive, requests = ids[:], []
    for step in range(chance.randint(1, 9)):
        old = alive.pop(chance.randrange(len(alive)))
        requests.append((step * 3, old, chance.choice(alive)))
    links = [(chance.choice(ids), chance.choice([None, "a", "b", "c"])) for _ in range(40)]
    return requests, links


@pytest.mark.parametrize("seed", range(6))
def test_links_like_one_by_one(frame, rows, seed):
    requests, links = random_case(seed)
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", *requests))
    merged = m.merge_links(frame("k long, c string", *links), "k", ["c"], keymap)
    assert rows(merged) == sequential(links, requests)


def test_links_with_two_compare_columns_and_payload(frame, rows):
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", (1, 2, 1)))
    links = frame("k int, a long, b string, note string",
                  (1, 5, "x", "kept"), (2, 5, "x", "lost"), (2, 5, "y", "moved"),
                  (2, 5, None, "null moves"), (1, 5, None, "null stays"), (3, 5, "x", "apart"))
    merged = m.merge_links(links, "k", ["a", "b"], keymap)
    assert merged.schema["k"].dataType.typeName() == "integer"
    assert rows(merged, "k", "note") == sorted(
        [(1, "kept"), (1, "moved"), (1, "null moves"), (1, "null stays"), (3, "apart")], key=repr)


def test_shuffle_path_gives_the_same(frame, rows, monkeypatch):
    requests, links = random_case(99)
    monkeypatch.setattr(m, "broadcast_if_small", lambda df, size: df.hint("merge"))
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", *requests))
    merged = m.merge_links(frame("k long, c string", *links), "k", ["c"], keymap)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(merged) == sequential(links, requests)


def test_hot_link(spark, frame, rows):
    """A third of all rows in one group: all of the survivor's stay, all of the others' go."""
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", (1, 2, 1), (2, 3, 1)))
    links = spark.range(30_000).selectExpr("id % 3 + 1 AS k", "'same' AS c")
    merged = m.merge_links(links, "k", ["c"], keymap)
    assert rows(merged.groupBy("k", "c").count()) == [(1, "same", 10_000)]


@pytest.mark.parametrize("requests, reason", [
    ([(1, 5, 5)], "itself"),
    ([(1, 5, 6), (2, 5, 7)], "twice"),
    ([(1, 5, 6), (2, 7, 5)], "earlier"),
    ([(1, 5, 6), (2, 6, 5)], "earlier"),
    ([(1, 5, 6), (1, 7, 6)], "step"),
    ([(1, None, 6)], "incomplete"),
])
def test_invalid_requests(frame, requests, reason):
    with pytest.raises(ValueError, match=reason):
        m.resolve_requests(frame("step long, old_id long, new_id long", *requests))


def test_long_chain(frame, rows):
    chain = [(i, i, i + 1) for i in range(1, 12)]
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", *chain))
    assert rows(keymap.rows.filter("id <> survivor"), "survivor") == [(12,)] * 11
    links = frame("k long, c string", (1, "a"), (11, "a"), (5, "b"))
    assert rows(m.merge_links(links, "k", ["c"], keymap)) == [(12, "a"), (12, "b")]


def test_snapshot(frame, rows):
    spec = m.MergeSpec(
        "people", "id",
        links=[m.LinkRule("groups", "person", ("team",)),
               m.LinkRule("missing", "person", ("x",), optional=True)],
        keys=[m.KeyRule("people", "parent"), m.KeyRule("gone", "author", optional=True)])
    snapshot = {
        "people": frame("id long, parent long", (1, 2), (2, None), (3, 2)),
        "groups": frame("person long, team long", (1, 7), (2, 7), (2, 8), (None, 9)),
        "other": frame("x long", (1,)),
    }
    requests = frame("step long, old_id long, new_id long", (1, 2, 1))
    merged = m.apply_merges(snapshot, spec, requests)
    assert rows(merged["people"]) == [(1, 1), (3, 1)]
    assert rows(merged["groups"]) == [(1, 7), (1, 8), (None, 9)]
    assert rows(merged["other"]) == [(1,)]
    assert rows(m.diagnose_self_parent(merged["people"], "id", "parent")) == [(1, 1)]
    with pytest.raises(KeyError):
        m.apply_merges({"people": snapshot["people"]}, spec, requests)


def test_request_file(spark, tmp_path, rows):
    path = tmp_path / "requests.tsv"
    path.write_text('name\tid\tid_duplicates\tnote\n'
                    'A\t1\t"12,125"\tx\nB\t2\t13,\t\nC\t\t14\ty\nD\t3\t\tz\n', encoding="utf-8")
    requests = read_merge_requests(spark, str(path))
    assert rows(requests, "step", "old_id", "new_id") == [(1, 12, 1), (2, 125, 1), (3, 13, 2)]


def test_steps_follow_a_file_read_in_many_splits(spark, tmp_path):
    path = tmp_path / "requests.tsv"
    ids = random.Random(1).sample(range(100_000), 4_000)
    path.write_text("id\tid_duplicates\n" + "".join(
        f"{200_000 + i}\t{a},{b}\n" for i, (a, b) in enumerate(zip(ids[::2], ids[1::2]))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        requests = read_merge_requests(spark, str(path)).orderBy("step").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.old_id for r in requests] == ids
    assert [r.step for r in requests] == list(range(1, 4_001))


def test_request_file_with_bad_id(spark, tmp_path):
    path = tmp_path / "requests.tsv"
    path.write_text("id\tid_duplicates\n1\t12,x\n", encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        m.resolve_requests(read_merge_requests(spark, str(path)))


def test_request_arguments(spark, rows):
    requests = merge_requests(spark, [(9, "12, 125"), (8, "3")])
    assert rows(requests) == [(1, 12, 9), (2, 125, 9), (3, 3, 8)]


def test_plan_reads_the_table_without_shuffling_it(frame):
    keymap = m.resolve_requests(frame("step long, old_id long, new_id long", (1, 2, 1)))
    links = frame("k long, c string", (1, "a"), (2, "a"), (3, "b"))
    plan = m.merge_links(links, "k", ["c"], keymap)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in plan and "Window" not in plan and "Python" not in plan
