"""Length histograms and licence scans against plain versions."""

import random

import pytest

from reknit.llm import lengths, licenses
from reknit.llm.queries import RANKS

CODER = lengths.load_coder(RANKS)


@pytest.mark.parametrize("cell", [4, 1024])
def test_histogram_as_plain_sums(spark, monkeypatch, cell):
    monkeypatch.setattr(lengths, "CELL", cell)
    texts = [None, "", "a", "one two three", "été 日本 🙂", "x" * 3000, "word " * 20_000, "a b"]
    rows = [(k % 3 or None, texts[k % len(texts)]) for k in range(40)]
    docs = spark.createDataFrame(rows, "lang long, text string").selectExpr(
        "*", "1 AS length", "2 AS docs", "3 AS tokens")
    sizes = [CODER.length(text or "") for _, text in rows]
    found = lengths.histogram(docs.drop("length"), CODER)
    by_limit = {}
    for row in found.collect():
        limit = row.length
        assert row.docs == sizes.count(limit) and row.tokens == limit * row.docs
        assert row.docs_longer == sum(s > limit for s in sizes)
        assert row.tokens_longer == sum(s for s in sizes if s > limit)
        assert row.truncated_total == sum(min(s, limit) for s in sizes)
        assert abs(row["quantile"] - sum(s <= limit for s in sizes) / len(sizes)) < 1e-12
        by_limit[limit] = row
    assert set(by_limit) == set(sizes)
    for row in lengths.answers(spark, found, [0, 1, 2, 700, 10**6]).collect():
        limit = row["limit"]
        assert row.docs_within == sum(s <= limit for s in sizes)
        assert row.tokens_within == sum(s for s in sizes if s <= limit)
        assert row.truncated_total == sum(min(s, limit) for s in sizes)
    for row in lengths.histogram(docs, CODER, by=["lang"]).collect():
        own = [s for s, (lang, _) in zip(sizes, rows) if lang == row.lang]
        assert row.docs == own.count(row.length)
        assert row.truncated_total == sum(min(s, row.length) for s in own)
    assert lengths.histogram(docs.limit(0), CODER).count() == 0


FILES = [
    (1, "a/b/c/code.py", "# Licensed under the Apache License, Version 2.0.\nx = 1\n" * 3),
    (2, "a/b/c/plain.py", "x = 1"), (3, "a/LICENSE.txt", "Released under the MIT License."),
    (4, "a/b/d/e/deep.py", None), (5, "top.py", ""), (6, "z/x.py", "nothing of the kind, really"),
    (7, "a/b/d/COPYING", "This work is licensed under the\nGNU General Public License,\nversion 3.\n\n"
     + "word " * 400), (8, None, "x"), (9, "a/LICENSE.txt", "Released under the MIT License."),
    (None, "a/q", "y"), (10, "ab/c.py", "y"), (11, "a/b/c/long.py", "lorem ipsum " * 40_000),
    (12, "s//t", "y"), (13, "s//LICENCE", "Licensed under CC BY-NC 4.0."),
    (14, "s/notes", "Licensed under CC BY 4.0."), (15, "s/u", "y"), (11, "a/b/c/long.py", "x")]


def test_licences_and_inheritance(spark):
    files = spark.createDataFrame(FILES, "doc_id long, path string, text string").selectExpr(
        "*", "1 AS licence", "2 AS folder", "3 AS id")
    found = licenses.scan_licences(files)
    assert found.count() == len(FILES)
    rows = {row.doc_id: (row.licence, row.origin, row.inherited_from) for row in found.collect()}
    assert rows == {
        1: ("Apache-2.0", "own", None), 2: ("MIT", "inherited", "a"), 3: ("MIT", "own", None),
        4: ("GPL-3.0", "inherited", "a/b/d"), 5: (None, None, None), 6: (None, None, None),
        7: ("GPL-3.0", "own", None), 8: (None, None, None), 9: ("MIT", "own", None),
        None: ("MIT", "inherited", "a"), 10: (None, None, None), 11: ("MIT", "inherited", "a"),
        12: ("CC-BY-NC-4.0", "inherited", "s/"), 13: ("CC-BY-NC-4.0", "own", None),
        # A text that is a notice as a whole speaks for its directory, whatever its name.
        14: ("CC-BY-4.0", "own", None), 15: ("CC-BY-4.0", "inherited", "s")}
    assert licenses.scan_licences(files.limit(0)).count() == 0


def test_short_cut_drops_no_match(spark):
    """``scan`` ends early only where the cosine can't reach the threshold."""
    import random
    from collections import Counter

    docs = spark.createDataFrame([(text,) for _, _, text in FILES], "text string")
    templates = licenses.fit(docs)
    draw = random.Random(4)
    hits = 0
    for _ in range(3000):
        words = licenses.terms_of(draw.choice(licenses.TEMPLATES)[1].encode())
        words = [w for w in words if draw.random() > 0.1] + [
            b"w%d" % draw.randrange(3) for _ in range(draw.randrange(6))]
        known = [w for w in words if w in templates.weights]
        others = Counter(w for w in words if w not in templates.weights)
        full = templates.matches(Counter(known), sum(n * n for n in others.values())) if known else {}
        assert templates.scan(words) == full
        hits += bool(full)
    assert hits > 300
    own = templates.scan(licenses.terms_of(licenses.TEMPLATES[0][1].encode()))
    assert own["MIT"] == pytest.approx(1)
    assert templates.other > max(templates.weights.values()) - 1e-9


def test_full_texts_and_headers(spark):
    from reknit.llm.licence_texts import HEADERS, TEXTS

    mit = "MIT License\n\nCopyright (c) 2019 Jo Doe\n\n" + TEXTS["MIT"]
    gpl = "/*\n" + "\n".join(" * " + line for line in HEADERS[3][1].split(". ")) + "\n */\nint x;"
    long = "some words before " * 30 + HEADERS[3][1] + " and others after it" * 30
    rows = [("m/LICENSE", mit), ("m/a/x.py", "x = 1"), ("g/x.c", gpl), ("g/long", long),
            ("s/x.js", "// SPDX-License-Identifier: MIT\nlet x"), ("p/y", "prose of no licence " * 50),
            ("b/COPYING", "Copyright 2001 Jo Doe\n\n" + TEXTS["BSD-3-Clause"]), ("b/z", "z"),
            *((f"t/{name}/LICENSE", text) for name, text in TEXTS.items())]
    files = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)],
                                  "doc_id long, path string, text string")
    found = {r.path: (r.licence, r.origin) for r in licenses.scan_licences(files).collect()}
    assert found == {
        "m/LICENSE": ("MIT", "own"), "m/a/x.py": ("MIT", "inherited"), "g/x.c": ("GPL-3.0", "own"),
        "g/long": ("GPL-3.0", "own"), "s/x.js": ("MIT", "own"), "p/y": (None, None),
        "b/COPYING": ("BSD-3-Clause", "own"), "b/z": ("BSD-3-Clause", "inherited"),
        **{f"t/{name}/LICENSE": (name, "own") for name in TEXTS}}


def test_long_white_space_is_cut_where_the_pattern_cuts():
    import tiktoken

    coder = lengths.load_coder(RANKS)
    plain = tiktoken.Encoding("plain", pat_str=lengths.PATTERN, mergeable_ranks=coder.ranks,
                              special_tokens={})
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice(["ab", "'s", " ", "\n", "\x85", "\x1c", "1", ".", "é", "  "])
                       * draw.choice([1, 1, 1, lengths.LONG_SPACE - 1, lengths.LONG_SPACE, 1500])
                       for _ in range(draw.randrange(1, 12)))
        assert "".join(part for part, _ in lengths.parts(text)) == text
        assert coder.length(text) == len(plain.encode_ordinary(text))


@pytest.mark.parametrize("text", [
    " " * 5_000_000, "\n" * 5_000_000 + "x", " \t" * 2_500_000 + " end", "a" * 5_000_000,
    "7" * 2_000_000, "word " * 1_000_000])
def test_very_long_texts(spark, text):
    coder = lengths.load_coder(RANKS)
    docs = spark.createDataFrame([(1, text), (2, "a b"), (3, None)], "doc_id long, text string")
    found = {row.doc_id: row.length for row in lengths.encoded_lengths(
        docs, coder, by=["doc_id"]).collect()}
    assert found[1] == coder.length(text) > 1000 and found[2] == 2 and found[3] == 0
