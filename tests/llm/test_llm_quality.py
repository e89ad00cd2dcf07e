"""The co-trained classifier by accuracy on documents that it has not seen."""

import tracemalloc

import numpy as np
import pyarrow as pa

from reknit.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = labels.filter("pmod(hash(doc_id), 3) > 0")
    model = quality.fit(docs, seen)
    scored = quality.classify(docs, model).join(
        labels.join(seen, "doc_id", "left_anti"), "doc_id").collect()
    assert len(scored) > 60
    right = sum((row.score >= 0.5) == row.quality for row in scored)
    assert right / len(scored) > 0.95
    good = [row for row in scored if row.quality]
    assert sum(row.keep for row in good) / len(good) > 0.98
    assert sum(not row.keep for row in scored if not row.quality) > 0
    assert all(0 <= row.text_score <= 1 and 0 <= row.meta_score <= 1 for row in scored)


def test_bounded_sample_and_same_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = quality.fit(docs, labels, sample=300, pool=100)
    two = quality.fit(docs.repartition(7), labels.repartition(3), sample=300, pool=100)
    assert np.allclose(one.text.weights, two.text.weights)
    assert one.threshold == two.threshold


def test_views_teach_each_other():
    draw = np.random.default_rng(1)
    labels = draw.integers(0, 2, 400).astype(float)
    texts = labels[:, None] * 2 + draw.normal(size=(400, 3))
    metas = labels[:, None] * 3 + draw.normal(size=(400, 2))
    few = slice(0, 40)
    alone = quality.fit_logistic(texts[few], labels[few])
    both = quality.co_train(texts[few], metas[few], labels[few], texts[40:300], metas[40:300],
                            sure=0.9)
    right = lambda odds: ((odds > 0) == labels[300:]).mean()
    assert right(both.text.odds(texts[300:])) >= right(alone.odds(texts[300:])) - 0.02
    assert ((both.scores(texts[300:], metas[300:]) > 0.5) == labels[300:]).mean() > 0.93


def test_odd_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, labels.unionByName(labels.limit(5)))
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "xx", "new", -5), (None, "a b c", "en", "src1", 5),
         (3, "word " * 60_000, "en", None, 300_000), (3, "same id", "en", "src1", 7)],
        "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
            "*", "1 AS score", "2 AS keep", "3 AS row", "4 AS id")
    found = quality.classify(odd, model)
    assert found.columns == ["doc_id", "text_score", "meta_score", "score", "keep"]
    assert found.count() == 5
    assert quality.keep_good(odd, model).columns == odd.columns
    # Without labels of both classes there is no classifier, and all rows stay.
    assert quality.fit(docs, labels.limit(0)) is None
    assert quality.fit(docs.limit(0), labels) is None
    assert quality.keep_good(odd, None).count() == 5
    assert {row.score for row in quality.classify(odd, None).collect()} == {0.5}
    assert quality.classify(odd.limit(0), model).count() == 0


def test_fit_in_parts_finds_the_least_loss(monkeypatch):
    draw = np.random.default_rng(2)
    rows = draw.normal(3, 5, (501, 6)).astype(np.float32)
    rows[:, 2] = 1
    labels = (rows[:, 0] + draw.normal(size=501) > 3).astype(float)
    whole = quality.fit_logistic(rows, labels)
    monkeypatch.setattr(quality, "PART", 50)
    model = quality.fit_logistic(rows, labels)
    assert np.allclose(model.weights, whole.weights, atol=1e-8)
    assert np.allclose(model.odds(rows), whole.odds(rows), atol=1e-8)
    design = np.hstack([np.ones((501, 1)), (rows.astype(float) - model.mean) / model.scale])
    penalty = np.array([1e-6, *[quality.RIDGE] * 6])
    slope = design.T @ (quality.sigmoid(design @ model.weights) - labels) + penalty * model.weights
    assert np.abs(slope).max() < 0.05
    assert np.allclose(model.scale[[0, 2]], [rows[:, 0].std(dtype=float), 1])


def test_the_driver_holds_no_whole_matrix_of_a_full_sample():
    draw = np.random.default_rng(3)
    n, pool = quality.SAMPLE, quality.POOL
    labels = (draw.random(n) < 0.5).astype(float)
    shift = np.concatenate([labels, draw.integers(0, 2, pool)]).astype(np.float32)[:, None]
    cells = {width: draw.normal(size=(n + pool, width)).astype(np.float32) + shift
             for width in (quality.WIDTH, quality.META)}
    texts, metas = cells[quality.WIDTH], cells[quality.META]
    tracemalloc.start()
    quality.co_train(texts[:n], metas[:n], labels, texts[n:], metas[n:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The samples as they come, once more for the view that is fitted, and no copies in doubles.
    assert peak < 2 * (texts.nbytes + metas.nbytes)


def test_rows_are_unpacked_in_order():
    rows = np.arange(35, dtype=np.float32).reshape(7, 5)
    packed = [row.tobytes() for row in rows]
    cells = pa.chunked_array([packed[:3], [], packed[3:]], pa.binary())
    order = np.array([6, 2, 0, 1, 5, 3, 4])
    assert (quality._unpacked(cells, order, 5) == rows[order]).all()
    assert quality._unpacked(pa.chunked_array([], pa.binary()), order[:0], 5).shape == (0, 5)
