"""A quality classifier by co-training of two views.

One logistic regression sees what the text looks like (character and word statistics), the
other what the page says about itself (language, source, stated length). Over some rounds each
labels the unlabelled documents that it is sure of for the other one. On labelled documents
held out from both, each view is calibrated, and the calibrated views are combined into the
score of every document.

Fitting takes a bounded sample: ``SAMPLE`` labelled and ``POOL`` unlabelled documents, chosen
by a hash of their ids. Scoring goes over all documents, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.llm.memory import give_back

# Labelled and unlabelled documents that the fit takes (in expectation, by a hash of the id).
SAMPLE, POOL = 20_000, 10_000
ROUNDS = 3
# How sure a view has to be to label a document for the other.
SURE = 0.98
# Share of held-out good documents that may fall below the threshold, which is at most EVEN.
LOST, EVEN = 0.002, 0.35
# Ridge of the views, which have many features, and of the calibration, which has few.
RIDGE, CALIBRATION_RIDGE = 10.0, 1.0
# Fewer labelled documents of a class than this give no classifier.
LEAST = 10
# Rows that are widened and standardised at a time, as the fit runs in the driver's memory.
PART = 2_000

META_CELLS = 64
META = META_CELLS + 12


def text_view(text: str | None) -> np.ndarray:
    """Shares of characters, and how words and lines repeat."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    shares = np.concatenate([counts[:128], counts[128:].reshape(16, 8).sum(axis=1)])
    words, lines = raw.split(), raw.split(b"\n")
    n, bytes_ = max(len(words), 1), max(len(raw), 1)
    return np.concatenate([np.sqrt(shares / bytes_), [
        math.log1p(len(words)), len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        bytes_ / n / 10, math.log1p(len(lines)) / math.log1p(n), len(set(lines)) / len(lines),
        counts[65:91].sum() / max(counts[65:91].sum() + counts[97:123].sum(), 1),
        float(not words)]])


def meta_view(lang: str | None, source: str | None, chars: int | None) -> np.ndarray:
    """Language and source by hashed cells, and the stated length by its magnitude."""
    cells = np.zeros(META)
    for name, value in (("lang", lang), ("source", source)):
        cells[xxhash.xxh3_64_intdigest(f"{name}={value}") % META_CELLS] += 1
    size = -1 if chars is None or chars < 0 else min(10, int(math.log2(chars + 1) / 2))
    cells[META_CELLS + 1 + size] = 1
    return cells


@dataclass
class Logistic:
    """A ridge logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of a label of 1."""
        return np.concatenate([
            ((rows[part] - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
            for part in _parts(len(rows))])


def _parts(n: int) -> list[slice]:
    return [slice(start, start + PART) for start in range(0, max(n, 1), PART)]


def sigmoid(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = RIDGE) -> Logistic:
    """By Newton steps, halved while they don't lower the loss.

    Sums go over parts of the rows, so that the standardised sample is never whole in memory.
    """
    parts = _parts(len(rows))
    mean = rows.mean(axis=0, dtype=float)
    scale = np.sqrt(sum(((rows[part] - mean) ** 2).sum(axis=0) for part in parts) / len(rows))
    scale[scale < 1e-9] = 1
    penalty = np.full(rows.shape[1] + 1, ridge)
    penalty[0] = 1e-6
    weights = np.zeros(len(penalty))

    def odds_of(w: np.ndarray) -> np.ndarray:
        own = w[1:] / scale
        return np.concatenate([rows[part].astype(float) @ own for part in parts]) + (
            w[0] - mean @ own)

    def loss(w: np.ndarray) -> float:
        odds = odds_of(w)
        return float(np.logaddexp(0, odds).sum() - labels @ odds + (penalty * w * w).sum() / 2)

    now = loss(weights)
    for _ in range(30):
        p = sigmoid(odds_of(weights))
        gradient, curve = penalty * weights, np.diag(penalty)
        for part in parts:
            design = np.hstack([np.ones((len(p[part]), 1)), (rows[part] - mean) / scale])
            gradient = gradient + design.T @ (p[part] - labels[part])
            curve = curve + (design * (p[part] * (1 - p[part]))[:, None]).T @ design
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while size > 1e-4 and loss(weights - size * step) > now:
            size /= 2
        weights = weights - size * step
        before, now = now, loss(weights)
        if before - now < 1e-6 * max(1.0, before):
            break
    return Logistic(mean, scale, weights)


@dataclass
class Classifier:
    text: Logistic
    meta: Logistic
    calibrated: tuple[Logistic, Logistic]
    combined: Logistic
    threshold: float

    def views(self, texts: np.ndarray, metas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of both views."""
        raw = self.text.odds(texts), self.meta.odds(metas)
        return tuple(c.odds(odds[:, None]) for c, odds in zip(self.calibrated, raw))

    def scores(self, texts: np.ndarray, metas: np.ndarray) -> np.ndarray:
        return sigmoid(self.combined.odds(np.stack(self.views(texts, metas), axis=1)))


def co_train(texts: np.ndarray, metas: np.ndarray, labels: np.ndarray, pool_texts: np.ndarray,
             pool_metas: np.ndarray, rounds: int = ROUNDS, sure: float = SURE) -> Classifier:
    """The classifier of labelled rows and a pool of unlabelled ones, both in both views."""
    held = np.arange(len(labels)) % 4 == 0
    own = (texts[~held], labels[~held]), (metas[~held], labels[~held])
    pools = pool_texts, pool_metas
    views = [fit_logistic(*rows) for rows in own]
    taught: list[np.ndarray] = [np.full(len(pool_texts), -1) for _ in views]
    for _ in range(rounds):
        for view in (0, 1):
            p = sigmoid(views[view].odds(pools[view])) if len(pools[view]) else np.empty(0)
            other = taught[1 - view]
            fresh = other < 0
            other[fresh & (p >= sure)] = 1
            other[fresh & (p <= 1 - sure)] = 0
        for view in (0, 1):
            told = taught[view] >= 0
            views[view] = fit_logistic(
                np.vstack([own[view][0], pools[view][told]]),
                np.concatenate([own[view][1], taught[view][told]]))
    raw = [views[0].odds(texts[held]), views[1].odds(metas[held])]
    calibrated = tuple(fit_logistic(odds[:, None], labels[held], CALIBRATION_RIDGE)
                       for odds in raw)
    both = np.stack([c.odds(odds[:, None]) for c, odds in zip(calibrated, raw)], axis=1)
    combined = fit_logistic(both, labels[held], CALIBRATION_RIDGE)
    good = np.sort(sigmoid(combined.odds(both))[labels[held] == 1])
    return Classifier(views[0], views[1], calibrated, combined,
                      min(EVEN, float(good[int(LOST * len(good))])))


def _matrix(frame: list, width: int) -> np.ndarray:
    return np.array(frame, float).reshape(-1, width)


def _views(docs: DataFrame, text: str, lang: str, source: str, chars: str) -> list:
    return [F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
            F.col(source).cast("string").alias("source"), F.col(chars).cast("long").alias("chars")]


def _batch_views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    columns = [batch.column(name) for name in ("text", "lang", "source", "chars")]
    texts = [text_view(cell.as_py()) for cell in columns[0]]
    metas = [meta_view(*cells) for cells in zip(*(c.to_pylist() for c in columns[1:]))]
    return _matrix(texts, WIDTH), _matrix(metas, META)


WIDTH = len(text_view(""))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality",
        text: str = "text", lang: str = "lang", source: str = "source", chars: str = "n_chars",
        sample: int = SAMPLE, pool: int = POOL) -> Classifier | None:
    """Fit on a bounded sample, or None where a class has too few labelled documents.

    An id that is labelled more than once counts with its smallest label; NULL labels and ids
    are left out.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(
        F.col(id).alias("id")).agg(F.min(label).alias("label"))
    share = sample / max(known.count(), 1)
    pool_share = pool / max(docs.count(), 1)
    cell = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    rows = docs.select(F.col(id).alias("id"), *_views(docs, text, lang, source, chars)).filter(
        cell < round(1_000_000 * max(share, pool_share)))
    known = known.filter(cell < round(1_000_000 * share))
    rows = rows.join(known, "id", "left").filter(
        F.col("label").isNotNull() | (cell < round(1_000_000 * pool_share)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, metas = _batch_views(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label").cast(pa.int32()),
                 pa.array([row.astype(np.float32).tobytes() for row in texts], pa.binary()),
                 pa.array([row.astype(np.float32).tobytes() for row in metas], pa.binary())],
                names=["id", "label", "texts", "metas"])

    kind = docs.select(id).dtypes[0][1]
    found = rows.mapInArrow(run, f"id {kind}, label int, texts binary, metas binary").toArrow()
    given = found["label"].cast(pa.float64()).to_numpy()
    order = pc.sort_indices(found, [("id", "ascending")]).to_numpy()
    # Labelled rows come first, so that they and the others are views.
    order = order[np.argsort(np.isnan(given[order]), kind="stable")]
    n = int((~np.isnan(given)).sum())
    values = given[order[:n]]
    texts, metas = (_unpacked(found[name], order, width)
                    for name, width in (("texts", WIDTH), ("metas", META)))
    del found
    model = None
    if min((values == 0).sum(), (values == 1).sum()) >= LEAST:
        model = co_train(texts[:n], metas[:n], values, texts[n:], metas[n:])
    del texts, metas
    give_back()
    return model


def _unpacked(cells: pa.ChunkedArray, order: np.ndarray, width: int) -> np.ndarray:
    """Rows of floats from their bytes, in the order given, a chunk at a time."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rows, done = np.empty((len(order), width), np.float32), 0
    for chunk in cells.chunks:
        packed = np.frombuffer(b"".join(chunk.to_pylist()), np.float32)
        rows[place[done:done + len(chunk)]] = packed.reshape(-1, width)
        done += len(chunk)
    return rows


def _scored(batch: pa.RecordBatch, model: Classifier | None) -> tuple[np.ndarray, ...]:
    if model is None:
        even = np.full(len(batch), 0.5)
        return even, even, even, np.ones(len(batch), bool)
    texts, metas = _batch_views(batch)
    views = model.views(texts, metas)
    score = sigmoid(model.combined.odds(np.stack(views, axis=1)))
    return sigmoid(views[0]), sigmoid(views[1]), score, score >= model.threshold


def classify(docs: DataFrame, model: Classifier | None, id: str = "doc_id", text: str = "text",
             lang: str = "lang", source: str = "source", chars: str = "n_chars") -> DataFrame:
    """Per row: ``id``, text_score, meta_score, score (of quality 1), keep.

    NULL and empty texts are scored by their statistics like any others, NULL metadata is a
    value of its own. Without a model every score is 0.5 and all rows are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *scores, keep = _scored(batch, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(s, pa.float64()) for s in scores),
                 pa.array(keep, pa.bool_())],
                names=["id", "text_score", "meta_score", "score", "keep"])

    kind = docs.select(id).dtypes[0][1]
    rows = docs.select(F.col(id).alias("id"), *_views(docs, text, lang, source, chars))
    return rows.mapInArrow(run, f"id {kind}, text_score double, meta_score double, "
                                "score double, keep boolean").withColumnRenamed("id", id)


def keep_good(docs: DataFrame, model: Classifier | None, text: str = "text", lang: str = "lang",
              source: str = "source", chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _scored(batch, model)[-1]
            yield batch.select(["row"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
                       *_views(docs, text, lang, source, chars))
    return rows.mapInArrow(run, rows.select("row").schema).select("row.*")
