"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary documents, one on windows of
toxic ones. A window of about ``STEP`` bytes is compressed with the ordinary dictionary, and with
the toxic one; the bytes that the second saves are its gain. Both dictionaries end with the same
ordinary content behind the same entropy tables, and the toxic content stands before it, at the
far end, where a match costs no less than one in the ordinary part. So a window gains only by
what ordinary text does not hold.

Thresholds are calibrated on labelled documents that trained no dictionary: how often a window of
an ordinary document reaches each gain, and, by a logistic regression, how much more often than
that the windows of a document have to reach it. Its result is the score.

Fitting takes a bounded sample of labelled documents (``SAMPLE`` per class for the dictionaries,
``CALIBRATION`` of either class), the first by a hash of their ids, and of each document at most
``WINDOWS`` windows for the dictionaries. Scoring goes over all windows of all documents, without
a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.llm.quality import CALIBRATION_RIDGE, Logistic, fit_logistic, sigmoid

# Labelled documents of each class for the dictionaries, and of both for the thresholds.
SAMPLE, CALIBRATION = 2_500, 4_000
# Windows of a document that train a dictionary, chosen by their hash.
WINDOWS = 256
# Fewer documents of a class than this, for dictionaries or thresholds, give no model.
LEAST = 5
# A window ends at the first white space from STEP bytes on, or at STEP if there is none in REACH.
STEP, REACH = 32, 32
# Sizes of the ordinary dictionary and of the toxic content before it.
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 2_048
# Gains that are counted.
GAINS = (1, 2, 3, 4, 5)
# Score from which a document is predicted to be toxic.
TOXIC = 0.7
# Windows whose gain a worker remembers before it starts anew.
REMEMBERED = 100_000

# Fixed value: the three repeat offsets that end the tables of every trained dictionary.
REPEAT_OFFSETS = b"".join(n.to_bytes(4, "little") for n in (1, 4, 8))

_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))


def prepared(text: str | None) -> bytes:
    """The bytes that are compressed: UTF-8 with A-Z in lower case, empty for NULL."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def windows(data: bytes) -> list[bytes]:
    """A text in windows that hold whole words where words have ordinary lengths."""
    if not data:
        return []
    marks = np.arange(STEP, len(data), STEP)
    spaces = np.append(np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8)]), len(data))
    ends = spaces[np.searchsorted(spaces, marks)]
    cuts = np.unique(np.concatenate(
        [[0], np.where(ends - marks <= REACH, ends, marks), [len(data)]])).tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


@dataclass
class Model:
    """Dictionaries and thresholds; without ``logistic``, every score is ``share``."""

    share: float
    ordinary: bytes = b""
    toxic: bytes = b""
    rates: tuple[float, ...] = ()
    logistic: Logistic | None = None


def train_dictionaries(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes] | None:
    """The ordinary and the toxic dictionary, or None where there is too little to train on."""
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, ordinary, k=32, d=6).as_bytes()
        # The tables of this one are not used: only what comes after them.
        extra = zstandard.train_dictionary(2 * TOXIC_BYTES, toxic, k=16, d=6).as_bytes()
    except zstandard.ZstdError:
        return None
    tables = base.index(REPEAT_OFFSETS) + len(REPEAT_OFFSETS)
    content = extra[extra.index(REPEAT_OFFSETS) + len(REPEAT_OFFSETS):][-TOXIC_BYTES:]
    return base, base[:tables] + content + base[tables:]


class Gains:
    """Counts the gains of a text's windows."""

    def __init__(self, model: Model):
        # All positions of both parts stay in the search tree (chain_log), and short matches count.
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTOPT, min_match=3, window_log=17, hash_log=16,
            chain_log=18, search_log=3, target_length=32, write_content_size=False,
            write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        self._by = []
        for data in (model.ordinary, model.toxic):
            trained = zstandard.ZstdCompressionDict(data)
            trained.precompute_compress(compression_params=settings)
            self._by.append(zstandard.ZstdCompressor(
                dict_data=trained, compression_params=settings).compress)
        self._known: dict[bytes, int] = {}

    def of(self, window: bytes) -> int:
        gain = self._known.get(window)
        if gain is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            ordinary, toxic = self._by
            gain = self._known[window] = len(ordinary(window)) - len(toxic(window))
        return gain

    def counts(self, text: str | None) -> list[int]:
        """The number of windows, and of those that reach each of ``GAINS``."""
        cells = [0] * (GAINS[-1] + 1)
        found = windows(prepared(text))
        for gain in map(self.of, found):
            if gain > 0:
                cells[min(gain, GAINS[-1])] += 1
        reached = np.cumsum(cells[:0:-1])[::-1]
        return [len(found), *(int(reached[g - 1]) for g in GAINS)]


def surprise(counts: np.ndarray, rates: tuple[float, ...]) -> np.ndarray:
    """Per gain, how unlikely so many windows are in ordinary text (log of a Poisson ratio)."""
    expected = counts[:, :1] * np.array(rates) + 0.05
    reached = counts[:, 1:]
    over = reached * np.log(np.maximum(reached, 1) / expected) - (reached - expected)
    return np.sqrt(np.where(reached > expected, np.maximum(over, 0), 0))


def scores(counts: np.ndarray, model: Model) -> np.ndarray:
    if model.logistic is None:
        return np.full(len(counts), model.share)
    return sigmoid(model.logistic.odds(surprise(counts, model.rates)))


def _texts_of(docs: DataFrame, chosen: DataFrame, id: str, text: str) -> DataFrame:
    """(id, label, text) of chosen ids, of which ``chosen`` has a bounded number.

    A repeated id counts once, with its smallest text; the minimum is combined map-side.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    return (rows.join(chosen.hint("broadcast"), "id")
            .groupBy("id", "label").agg(F.min("text").alias("text")))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "toxic",
        text: str = "text") -> Model:
    """Train and calibrate on the labelled documents of ``labels`` (``id``, ``label`` 0 or 1).

    NULL ids and labels are left out; an id that is labelled more than once counts with its
    largest label. Where a class has fewer than ``LEAST`` documents, or there is too little text
    for a dictionary, the model gives every document the smoothed share of toxic labels.
    """
    spread = F.xxhash64("id", F.lit("toxicity"))
    known = (labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull())
             .groupBy(F.col(id).alias("id")).agg(F.max(label).cast("int").alias("label")))
    shares = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    known = known.withColumn("spread", spread)
    calibrating = F.pmod("spread", F.lit(3)) == 0

    def first(rows: DataFrame, count: int) -> DataFrame:
        return rows.orderBy("spread", "id").limit(count).select("id", "label")

    total = shares.first()
    model = Model((total.bad + 1) / (total.n + 2))
    trained = train_dictionaries(*(
        _training_windows(_texts_of(docs, first(
            known.filter(~calibrating & (F.col("label") == value)), SAMPLE), id, text))
        for value in (0, 1)))
    if trained is None:
        return model
    model = Model(model.share, *trained)
    counted = _counted(_texts_of(docs, first(known.filter(calibrating), CALIBRATION), id, text),
                       model).orderBy("id").collect()
    values = np.array([row.label for row in counted], float)
    if min((values == 0).sum(), (values == 1).sum()) < LEAST:
        return model
    counts = np.array([row.counts for row in counted], float)
    clean = counts[values == 0].sum(axis=0)
    rates = tuple((clean[1:] + 0.5) / (clean[0] + 1))
    return Model(model.share, *trained, rates,
                 fit_logistic(surprise(counts, rates), values, CALIBRATION_RIDGE))


def _training_windows(texts: DataFrame) -> list[bytes]:
    """At most ``WINDOWS`` windows of each text, in an order that does not depend on Spark's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("text"):
                found = windows(prepared(cell.as_py()))
                if len(found) > WINDOWS:
                    found = sorted(found, key=xxhash.xxh3_64_intdigest)[:WINDOWS]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["window"])

    found = texts.mapInArrow(run, "window binary").toArrow()["window"].to_pylist()
    return sorted(found, key=lambda w: (xxhash.xxh3_64_intdigest(w), w))


def _counted(texts: DataFrame, model: Model) -> DataFrame:
    """The counts of the windows of labelled texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model)
        for batch in batches:
            counts = [gains.counts(cell.as_py()) for cell in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(counts, pa.list_(pa.int64()))],
                names=["id", "label", "counts"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, label int, counts array<bigint>")


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``id``, score (0 to 1, higher: more likely toxic), predicted (1 from ``TOXIC``).

    Every row gives one, repeated ones too. NULL and empty texts have no windows and are scored
    as such; other columns, whatever their names, play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model) if model.logistic is not None else None
        for batch in batches:
            counts = np.array(
                [gains.counts(cell.as_py()) if gains else [0] for cell in batch.column("text")],
                float).reshape(len(batch), -1)
            found = scores(counts, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.float64()),
                 pa.array((found >= TOXIC).astype(np.int32), pa.int32())],
                names=["id", "score", "predicted"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed(
        "id", id)
