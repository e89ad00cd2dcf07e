"""Toxicity: windows, gains against plain compression, held-out accuracy, odd rows."""

import random
import re

import numpy as np
import pytest

from reknit.llm import toxicity
from reknit.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
# Words of the labelled documents of the given tables that make them toxic.
INSULTS = re.compile("trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron",
                     re.IGNORECASE)


@pytest.fixture(scope="module")
def made(spark):
    """Labelled texts of made-up words, every fourth with rude ones."""
    draw = random.Random(5)
    parts = ["an", "the", "re", "ing", "er", "st", "ou", "ti", "on", "ble"]
    rows = []
    for id in range(1200):
        words = ["".join(draw.choices(parts, k=draw.randint(1, 4)))
                 for _ in range(draw.randint(30, 200))]
        bad = id % 4 == 0
        for _ in range(bad * draw.randint(4, 9)):
            words[draw.randrange(len(words))] = draw.choice(["zugwanker", "quxdolt", "pifheadly"])
        rows.append((id, " ".join(words), int(bad)))
    docs = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows if a < 1000],
                                   "doc_id long, toxic int")
    return docs, labels, rows, toxicity.fit(docs, labels)


@pytest.mark.parametrize("text", [
    "", "a", "short text", "Words of ordinary length, " * 50, "x" * 1000, " " * 500,
    "é" * 300 + " end", "tab\tand\nline " * 40])
def test_windows_give_the_text_again(text):
    data = toxicity.prepared(text)
    found = toxicity.windows(data)
    assert b"".join(found) == data
    assert all(0 < len(w) <= 2 * toxicity.STEP + toxicity.REACH for w in found)
    for one in found[:-1]:
        assert len(one) >= toxicity.STEP - toxicity.REACH


def test_windows_end_at_white_space():
    data = toxicity.prepared("word " * 200)
    for one, other in zip(toxicity.windows(data), toxicity.windows(data)[1:]):
        assert other.startswith(b" ")
        assert not one.endswith(b" ")


def test_gains_are_differences_of_lengths(made):
    model = made[3]
    assert model.ordinary and model.toxic
    gains = toxicity.Gains(model)
    ordinary, toxic = gains._by
    text = made[2][4][1]
    found = [len(ordinary(w)) - len(toxic(w)) for w in toxicity.windows(toxicity.prepared(text))]
    assert gains.counts(text) == [len(found), *(sum(g >= t for g in found) for t in toxicity.GAINS)]
    # The remembered gains are the same ones.
    assert gains.counts(text) == gains.counts(text)


def test_scores_of_unseen_documents(spark, made):
    docs, _, rows, model = made
    truth = {id: bad for id, _, bad in rows}
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert set(found) == set(truth)
    unseen = [found[id] for id in range(1000, 1200)]
    right = [r.predicted == truth[r.doc_id] for r in unseen]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())


def test_odd_rows(spark, made):
    model = made[3]
    rows = [(None, "zugwanker quxdolt"), (1, None), (2, ""), (3, "x" * 200_000), (4, " " * 100_000),
            (5, "same"), (5, "same"), (6, "é\x00 " * 1000)]
    docs = spark.createDataFrame(
        [(id, text, 0.5, 1, "w") for id, text in rows],
        "doc_id long, text string, score double, predicted int, window string")
    found = toxicity.score(docs, model)
    assert found.columns == ["doc_id", "score", "predicted"]
    kept = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == len(rows) and kept[1] == kept[2]
    assert toxicity.score(docs.limit(0), model).count() == 0
    # Ids of another type stay as they are.
    text_ids = toxicity.score(docs.withColumn("doc_id", docs.doc_id.cast("string")), model)
    assert dict(text_ids.dtypes)["doc_id"] == "string" and text_ids.count() == len(rows)


def test_too_few_labels(spark, made):
    docs, labels = made[0], made[1]
    for known in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("doc_id < 3"),
                  labels.selectExpr("doc_id", "CAST(NULL AS int) AS toxic")):
        model = toxicity.fit(docs, known)
        assert model.logistic is None
        scores = {r.score for r in toxicity.score(docs.limit(20), model).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1
    assert toxicity.fit(docs.limit(0), labels).logistic is None


def test_fit_of_repeated_ids(spark, made):
    """A hot id, and NULL ids, reach the driver as one document at most; labels may repeat."""
    docs, labels, _, model = made
    more = docs.unionByName(spark.range(2000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 7 END AS doc_id", "'zz ' || id AS text"))
    again = labels.unionByName(labels)
    texts = toxicity._texts_of(more, again.distinct().withColumnRenamed("toxic", "label")
                               .withColumnRenamed("doc_id", "id"), "doc_id", "text")
    assert texts.count() == labels.count()
    assert toxicity.fit(docs, again).toxic == model.toxic


def test_query_catches_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = (QUERIES["op13_toxicity"](spark, SF).filter("held_out")
             .join(docs, "doc_id").join(labels, "doc_id").select("predicted", "toxic", "text")
             .collect())
    # A part of the labels is noise: no word in the text says so.
    rude = [r for r in found if r.toxic == 1 and INSULTS.search(r.text or "")]
    clean = [r for r in found if r.toxic == 0]
    assert np.mean([r.predicted for r in rude]) > 0.7
    assert np.mean([r.predicted for r in clean]) < 0.01
