"""The FM-index and decontamination against plain searches."""

import hashlib
import random
import re

import numpy as np
import pytest

from reknit.llm import decontaminate
from reknit.llm.fmindex import FMIndex, suffix_order


@pytest.mark.parametrize("seed", range(12))
def test_index_counts_and_locates(seed):
    draw = np.random.default_rng(seed)
    symbols = int(draw.integers(1, 9))
    text = draw.integers(0 if seed % 3 else 1, symbols + 1, int(draw.integers(0, 400)))
    if seed % 2:
        text = np.tile(text, 3)
    index = FMIndex(text, symbols, rate=int(draw.integers(1, 20)))
    for width in (1, 2, 5):
        patterns = draw.integers(1, symbols + 1, (30, width))
        low, high = index.search(patterns)
        for pattern, a, b in zip(patterns, low, high):
            wanted = [k for k in range(len(text) - width + 1)
                      if (text[k:k + width] == pattern).all()]
            assert sorted(index.locate(np.arange(a, b))) == wanted


def test_suffixes_are_in_order():
    text = np.array([1, 2, 1, 2, 1, 0, 1, 2, 1, 0, 0])
    # Each separator is smaller than all codes and than the separators behind it.
    marks = iter(range(-100, 0))
    spelled = [next(marks) if c == 0 else int(c) for c in text]
    wanted = sorted(range(len(text)), key=lambda k: spelled[k:])
    assert suffix_order(text).tolist() == wanted


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(rows, items, window=13):
    out = []
    for id, text in rows:
        own, hit, found = words(text), set(), set()
        for item, phrase in items:
            them = words(phrase)
            width = min(window, len(them))
            windows = {tuple(them[k:k + width]) for k in range(len(them) - width + 1 if them else 0)}
            for k in range(len(own) - width + 1 if width else 0):
                if tuple(own[k:k + width]) in windows:
                    hit.update(range(k, k + width))
                    if item is not None:
                        found.add(str(item))
        out.append((id, len(own), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def cases():
    draw = random.Random(7)
    items = [(k, " ".join(draw.choice("abcdefgh") for _ in range(draw.choice((1, 3, 13, 14, 40)))))
             for k in range(9, 14)]
    items += [(20, None), (21, "... !"), (None, "only here"), (22, items[0][1]), (22, items[0][1])]
    rows = [(1, None), (2, ""), (3, "Only HERE"), (4, "émile 9 x"), (None, items[1][1])]
    for k in range(10, 40):
        filler = " ".join(draw.choice("abcdefghxyz") for _ in range(draw.randrange(60)))
        quote = draw.choice(items)[1] or ""
        rows.append((k, f"{filler}, {quote.upper()}. {filler} y{'z ' * draw.randrange(300)}"))
    return rows + rows[-2:], items


@pytest.mark.parametrize("block, shard", [(8_000_000, 2_000_000), (20, 50)])
def test_contamination_as_plain_search(spark, monkeypatch, block, shard):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    rows, items = cases()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS row", "2 AS hits", "3 AS n_hit")
    tests = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item")
    found = decontaminate.contamination(docs, tests)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows, items)
    kept = decontaminate.decontaminate(docs, tests)
    assert kept.columns == docs.columns
    dirty = {row[0] for row in plain(rows, items) if row[5]}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (id for id, _ in rows if id not in dirty), key=repr)
    touched = {row[0] for row in plain(rows, items) if row[2]}
    texts = dict(rows)
    for row in kept.collect():
        if row.doc_id not in touched:
            assert row.text == texts[row.doc_id]


def test_cut_keeps_what_is_outside():
    assert decontaminate.cut("Ab, cd! ef-gh. Ij", [1, 4], [3, 5]) == "Ab, -gh. "
    assert decontaminate.cut("Ab cd", [0], [2]) == ""


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    tests = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:3] for r in decontaminate.contamination(docs, tests).collect()] == [(1, 2, 0)]
    assert decontaminate.contamination(docs.limit(0), tests).count() == 0
    assert decontaminate.decontaminate(docs, tests).collect() == docs.collect()


def test_one_worker_a_task_and_each_text_once(spark, monkeypatch):
    """Two operators in a row kept two workers a task alive, with each text in two columns."""
    docs = spark.createDataFrame([(1, "a b", 3), (2, "c d e", 5)],
                                 "doc_id long, text string, n_chars int")
    tests = spark.createDataFrame([(1, "d e"), (2, "x")], "item_id long, text string")
    for block, passes in ((8_000_000, 1), (2, 3)):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        clean = decontaminate.decontaminate(docs, tests)
        plan = re.sub(r"#\d+L?", "", clean._jdf.queryExecution().optimizedPlan().toString())
        assert plan.count("MapInArrow") == passes
        assert "n_chars, n_chars" in plan and "text, text" not in plan
        assert sorted(map(tuple, clean.collect())) == [(1, "a b", 3)]
    assert [tuple(r) for r in decontaminate.decontaminate(docs.select("text"), tests).collect()] \
        == [("a b",)]
