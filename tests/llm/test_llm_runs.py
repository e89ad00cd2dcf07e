"""Periodic runs against trying every period at every place."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reknit.llm import runs
from reknit.llm.runs import collapse, find_runs


def every_period(words, length=runs.LENGTH, times=runs.TIMES):
    """Slow model: all stretches of every period, without those of a smaller one."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(length, times * q):
                stretch = words[i:j + q]
                if not any(all(stretch[k] == stretch[k + c] for k in range(len(stretch) - c))
                           for c in range(1, q)):
                    found.append((i, j - i + q, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def made(draw):
    n, letters = draw.randrange(0, 140), [b"a", b"b", b"c", b"d"][:draw.randrange(1, 5)]
    kind = draw.randrange(5)
    if kind == 0:
        return [draw.choice(letters) for _ in range(n)]
    if kind == 1:
        out = []
        for _ in range(draw.randrange(1, 5)):
            block = [draw.choice(letters) for _ in range(draw.randrange(1, 14))]
            out += (block * 20)[:draw.randrange(0, 60)]
        return out
    if kind == 2:
        words = [b"%d" % i for i in range(n)]
        a, p = draw.randrange(0, n + 1), draw.randrange(1, 30)
        return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    if kind == 3:
        words = ([draw.choice(letters) for _ in range(draw.randrange(1, 8))] * 40)[:n]
        for _ in range(draw.randrange(0, 3) if words else 0):
            words[draw.randrange(len(words))] = b"z"
        return words
    x, y = [b"a"], [b"b"]
    while len(y) <= n:
        x, y = y, y + x
    return y[:n]


@pytest.mark.parametrize("length, times", [(24, 3), (6, 2), (10, 4), (5, 3)])
def test_same_as_every_period(length, times):
    draw = random.Random(length)
    count = 0
    for _ in range(60):
        texts = [made(draw) for _ in range(10)]
        for words, found in zip(texts, find_runs(texts, length, times)):
            assert found == every_period(words, length, times)
            count += len(found)
    assert count > 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=90),
       st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=6), st.integers(0, 12))
def test_periods_inside_noise(noise, block, times):
    words = noise[:len(noise) // 2] + block * times + noise[len(noise) // 2:]
    assert find_runs([words, words[::-1]]) == [every_period(words), every_period(words[::-1])]


def test_long_texts():
    for words in ([b"a"] * 300_000, [b"a", b"b", b"c"] * 100_000,
                  [b"w%d" % (i % 50_000) for i in range(300_000)]):
        (run,), = find_runs([words])
        assert run[:2] == (0, 300_000)
        assert collapse(words, [run]) == words[:run[2]]
    assert find_runs([[b"w%d" % i for i in range(300_000)]]) == [[]]


def test_overlapping_runs_collapse():
    # The period a b ends where the period b b c begins.
    words = b"a b a b a b a b a b a b a b a b a b a b a b a b b c b b c b b c b b c b b c b b c " \
            b"b b c b b c b b c".split()
    found = find_runs([words])[0]
    assert found == every_period(words) and len(found) == 2
    kept = [w for k, w in enumerate(words)
            if not any(s + p <= k < s + n for s, n, p in found)]
    assert collapse(words, found) == kept


def test_rows(spark):
    rows = [(None, "x " * 40), (1, None), (2, ""), (3, " \n\t "), (4, "a b c\u2003d"),
            (5, "one two " * 15), (5, "one two " * 15), (6, "é ü\n" * 12 + "end")]
    docs = spark.createDataFrame([(id, text, 1, "w") for id, text in rows],
                                 "doc_id int, text string, runs int, collapsed string")
    found = runs.detect(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert dict(found.dtypes)["doc_id"] == "int"
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in found.collect()), key=repr)
    assert got == sorted([
        (None, 40, [(0, 40, 1)], "x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
        (4, 3, [], "a b c\u2003d"), (5, 30, [(0, 30, 2)], "one two"),
        (5, 30, [(0, 30, 2)], "one two"), (6, 25, [(0, 24, 2)], "é ü end")], key=repr)
    assert runs.detect(docs.limit(0)).count() == 0


def test_strongest(spark):
    lists = [[], [(0, 30, 3)], [(0, 24, 8), (5, 30, 10), (9, 31, 10), (50, 62, 20)],
             [(0, 30, 10), (4, 27, 9), (40, 24, 8)]]
    rows = spark.createDataFrame([(k, runs_) for k, runs_ in enumerate(lists)],
                                 "k int, runs array<struct<start:long,length:long,period:long>>")
    best = {r.k: r.best for r in rows.select("k", runs.strongest("runs").alias("best")).collect()}
    assert best[0] is None
    assert [tuple(best[k]) for k in (1, 2, 3)] == [(0, 30, 3), (9, 31, 10), (0, 30, 10)]


def test_many_texts(spark):
    """Texts are solved in groups of any size with the same result."""
    texts = [" ".join(w.decode() for w in made(random.Random(k))) for k in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.detect(docs).collect()}
    assert found == {k: every_period(text.encode().split()) for k, text in enumerate(texts)}
