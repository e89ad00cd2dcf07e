"""Column functions against plain Python models, on many random values in one job."""

import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from reknit.functions.documents import json_merge, json_set, json_typed
from reknit.functions.text import person_key, squash


def dumps(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def some_json(chance, depth=3):
    kind = chance.randrange(6 if depth else 4)
    if kind < 4:
        return chance.choice([None, True, 0, -7, 12345678901, "", "é\"\\x", "5"])
    if kind == 4:
        return [some_json(chance, depth - 1) for _ in range(chance.randrange(3))]
    return {key: some_json(chance, depth - 1) for key in chance.sample("abcd", chance.randrange(4))}


def some_object(chance):
    return {key: some_json(chance) for key in chance.sample("abcd", chance.randrange(5))}


def set_model(document, path, value):
    """The document with the value, or the document itself where the parent is missing."""
    if not isinstance(document, dict):
        return document
    step, *rest = path
    if not rest:
        return {**document, step: value}
    if step not in document:
        return document
    return {**document, step: set_model(document[step], rest, value)}


@pytest.mark.parametrize("path", [["a"], ["a", "b"], ["b", "a", "c"]])
def test_json_set(frame, path):
    chance = random.Random(len(path))
    cases = [(some_object(chance), some_json(chance)) for _ in range(400)]
    df = frame("n long, doc string, value string",
               *[(n, json.dumps(doc), json.dumps(value)) for n, (doc, value) in enumerate(cases)])
    for row in df.select("n", json_set("doc", path, "value").alias("out")).collect():
        document, value = cases[row.n]
        assert row.out == dumps(set_model(document, path, value)), (document, value)


def test_json_merge_and_typed(frame):
    chance = random.Random(5)
    cases = [(some_object(chance), some_object(chance)) for _ in range(400)]
    df = frame("n long, a string, b string",
               *[(n, json.dumps(a), json.dumps(b)) for n, (a, b) in enumerate(cases)])
    for row in df.select("n", json_merge("a", "b").alias("merged"),
                         json_typed("a", "b").alias("typed")).collect():
        left, right = cases[row.n]
        assert row.merged == dumps({**left, **right})
        assert row.typed == (dumps(left["b"]) if "b" in left else None)


def plain(text):
    for ligature, letters in (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("ß", "ss"), ("ø", "o")):
        text = text.replace(ligature, letters)
    decomposed = unicodedata.normalize("NFD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c)).lower()


def test_name_keys(frame):
    chance = random.Random(3)
    letters = "abZÉèçñÜöłœßø ()-'\t"
    name = lambda: chance.choice([None, *["".join(chance.choices(letters, k=12))] * 9])
    cases = [(name(), name()) for _ in range(500)]
    df = frame("n long, first string, last string", *[(n, *c) for n, c in enumerate(cases)])
    for row in df.select("n", person_key("first", "last").alias("key"),
                         squash("last").alias("squashed")).collect():
        first, last = (value and value.replace("ł", "l") for value in cases[row.n])
        family = re.sub(r"\([^\(]*\)", "", re.sub(r"\s", "", last), count=1) if last else ""
        assert row.key == (plain(first or "") + plain(family)).strip(" ")
        assert row.squashed == (plain(re.sub(r"\s", "", last)) if last is not None else None)


def test_squash_agrees_with_keys(frame):
    df = frame("whole string, first string, last string", ("Zoé  Du Pré", "Zoé", "Du Pré"))
    assert df.filter(squash("whole") == person_key("first", F.col("last"))).count() == 1
