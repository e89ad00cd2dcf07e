"""Components, shingles and near duplicates against plain versions."""

import random

import pytest

from reknit.llm import components as graph
from reknit.llm import neardup
from reknit.llm.components import components
from reknit.llm.shingles import WordHashes, shingle_set, words_of


def lows_of(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)],
    [(random.Random(k).randrange(80), random.Random(k + 999).randrange(80)) for k in range(60)],
    [(-5, 7), (7, 3), (3, -5), (9, 8)]])
def test_components(spark, edges):
    found = components(spark.createDataFrame([*edges, (None, 4)], "a long, b long"))
    wanted = lows_of([edge for edge in edges if edge[0] != edge[1]])
    assert {row.node: row.low for row in found.collect()} == wanted
    assert found.count() == len(wanted)


def test_exchanges_of_a_round(spark, monkeypatch):
    """Each is a stage of as many tasks as there are partitions, of which the driver keeps count."""
    rounds, plain = [], graph.materialize

    def kept(df, name):
        rounds.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hash"))
        return plain(df, name)

    monkeypatch.setattr(graph, "materialize", kept)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long")
        assert {row.low for row in components(edges).collect()} == {0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # As planned, before Spark finds that both sides of the second join have two in common.
    assert len(rounds) > 2 and max(rounds[1:]) <= 7


def test_words_and_short_texts():
    assert words_of("Ab C \x1c\tD\x0bÉ") == ["ab c".encode(), b"\x1c", b"d", "É".encode()]
    hashes = WordHashes()
    assert len(shingle_set(words_of("a b a b a b"), 3, hashes)) == 2
    assert len(shingle_set(words_of("a b"), 3, hashes)) == 1
    assert len(shingle_set(words_of(" \n"), 3, hashes)) == 0
    assert shingle_set(words_of("a"), 3, hashes)[0] != shingle_set(words_of("a a"), 3, hashes)[0]


def plain_groups(rows, size, threshold):
    """Sets, links between all pairs of rows, components over ids."""
    sets = []
    for _, text in rows:
        words = [w.lower() for w in (text or "").encode().split()]
        width = min(size, len(words))
        sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)}
                    if words else set())
    edges = [(row[0], row[0]) for row in rows]
    for i, one in enumerate(sets):
        for j in range(i):
            other = sets[j]
            both = len(one & other)
            if one and other and both >= threshold * len(one | other) - 1e-12:
                edges.append((rows[i][0], rows[j][0]))
    low = lows_of(edges)
    return sorted((id, len(own), low[id], id == low[id]) for (id, _), own in zip(rows, sets))


def families(seed, count=12, members=9):
    draw = random.Random(seed)
    rows = []
    for family in range(count):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.choice((2, 8, 60, 150)))]
        for member in range(draw.randrange(1, members)):
            own = list(words)
            for _ in range(draw.randrange(0, 4)):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
            rows.append((family * 1000 + draw.randrange(1000), " ".join(own)))
    draw.shuffle(rows)
    return list({id: (id, text) for id, text in rows}.values())


@pytest.mark.parametrize("block, grid", [(2000, 16), (4, 16), (3, 1)])
def test_near_duplicates_as_all_pairs(spark, monkeypatch, block, grid):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(neardup, "GRID", grid)
    rows = families(block + grid)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size, threshold in ((3, 0.85), (5, 0.8)):
        found = neardup.near_duplicates(docs, size=size, threshold=threshold)
        assert sorted(map(tuple, found.collect())) == plain_groups(rows, size, threshold)


def test_odd_rows_of_near_duplicates(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "one two", "d"), (5, "ONE  two", "e"),
            (6, "one two", "f"), (6, "one two", "f"), (7, long, "g"), (8, long + " end", "h"),
            (None, "one two", "i"), (None, None, "j"),
            # An id with two texts ties their classes together.
            (20, "p q r s", "k"), (21, "p q r s", "l"), (21, "t u v w", "m"), (19, "t u v w", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").selectExpr(
        "*", "kept AS component_id", "1 AS doc", "2 AS print")
    found = sorted(map(tuple, neardup.near_duplicates(docs, size=3).collect()), key=repr)
    assert found == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 1, 4, False), (6, 1, 4, False), (7, 29_998, 7, True), (8, 29_999, 7, False),
        (None, 1, None, True), (None, 0, None, True), (20, 2, 19, False), (21, 2, 19, False),
        (21, 2, 19, False), (19, 2, 19, True)], key=repr)
    kept = neardup.keep_one(docs, size=3)
    assert kept.columns == docs.columns
    assert sorted((row.doc_id for row in kept.collect()), key=repr) == sorted(
        [1, 2, 3, 4, 7, None, None, 19, 20], key=repr)
    empty = neardup.near_duplicates(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert neardup.keep_one(docs.limit(0)).count() == 0


def test_no_text_is_lost_under_a_repeated_id(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "A  b c"), (1, "x y z"), (2, "k l m"), (1, ""),
            (1, None), (3, "x y z"), (0, "k l m"), (5, "n o p"), (5, "n o p"), (None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS print", "2 AS row", "'x' AS own")
    for df in (docs, docs.repartition(7), docs.orderBy("text")):
        kept = neardup.keep_one(df)
        assert kept.columns == docs.columns
        found = [(r.doc_id, (r.text or "").lower().split()) for r in kept.collect()]
        assert sorted(found, key=repr) == sorted([
            (1, "a b c".split()), (1, "x y z".split()), (0, "k l m".split()), (1, []), (1, []),
            (5, "n o p".split()), (None, "a b c".split())], key=repr)


def test_ids_of_text(spark):
    rows = [(f"d{id:05}", text) for id, text in families(3)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = neardup.near_duplicates(docs, size=3, threshold=0.85)
    assert dict(found.dtypes)["component_id"] == "string"
    assert sorted(map(tuple, found.collect())) == plain_groups(rows, 3, 0.85)
    left = {row.doc_id for row in neardup.keep_one(docs, size=3, threshold=0.85).collect()}
    assert left == {row.doc_id for row in found.filter("kept").collect()}


def test_estimate_is_near_the_similarity():
    import numpy as np

    from reknit.llm.shingles import minima, permutations

    draw = np.random.default_rng(3)
    errors = []
    for share in (0.3, 0.6, 0.85, 0.95):
        common = draw.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        sets = [np.unique(np.concatenate([common, draw.integers(
            0, 2**63, 2000 - len(common), dtype=np.uint64)])) for _ in range(2)]
        both = len(np.intersect1d(*sets))
        one, other = (np.frombuffer(neardup.packed(minima(s, permutations(neardup.HASHES))),
                                    np.uint64) for s in sets)
        found = neardup.estimates(one, other[None, :])[0]
        errors.append(abs(found - both / (4000 - both)))
    assert max(errors) < 0.2


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_floor_of_the_estimate(threshold):
    from fractions import Fraction
    from math import comb

    equal = (1 + 3 * Fraction(str(threshold))) / 4
    tails, total = [], Fraction(0)
    for cells in range(neardup.HASHES + 1):
        tails.append(total)
        total += comb(neardup.HASHES, cells) * equal**cells * (1 - equal) ** (
            neardup.HASHES - cells)
    cells = round((neardup.estimate_floor(threshold) * 0.75 + 0.25) * neardup.HASHES)
    assert tails[cells] <= 1e-10 < tails[cells + 1]
