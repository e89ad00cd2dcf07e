"""Benchmark decontamination by an FM-index per shard of the training texts.

A shard is a run of documents of bounded size. Its words become codes of the test phrases'
vocabulary; a word that no phrase holds separates, and so does a stretch shorter than the
shortest phrase, since no phrase can lie there. The FM-index of the shard then answers all
phrases at once by backward search through wavelet ranks, occurrences are located from sampled
suffix positions, and the words they cover are merged into removal spans. No text is shuffled.

The test items come in blocks of bounded size (``BLOCK_BYTES``), one pass over the texts each. The
last pass also makes the result, so that one block needs one worker a task and each text goes
to it once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reknit.llm.fmindex import FMIndex
from reknit.llm.memory import give_back

WINDOW = 13
BLOCK_BYTES = 8_000_000
# Words of the documents that share an index.
SHARD_WORDS = 800_000

# Fixed value: what is no word. Bytes of longer code points belong to words.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c).isdigit() or 0x61 <= c <= 0x7A
               or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Phrases:
    """The windows of some test items: by length a matrix of codes, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.codes: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.codes.setdefault(w, len(self.codes) + 1) for w in words_of(text)]
            width = min(window, len(words))
            for start in range(len(words) - width + 1 if words else 0):
                owners.setdefault(tuple(words[start:start + width]), set()).update(
                    () if item is None else (item,))
        self.groups = []
        for width in sorted({len(phrase) for phrase in owners}):
            phrases = [phrase for phrase in owners if len(phrase) == width]
            self.groups.append((width, np.array(phrases, np.int64),
                                [sorted(owners[phrase]) for phrase in phrases]))
        self.shortest = self.groups[0][0] if self.groups else 0

    def coded(self, text: str | None) -> np.ndarray:
        """The codes of a text's words, 0 for those that no phrase holds."""
        words, get = words_of(text), self.codes.get
        return np.fromiter((get(word, 0) for word in words), np.int32, len(words))


def _stretches(codes: np.ndarray, shortest: int) -> np.ndarray:
    """Places to index: stretches of known words that a phrase fits into, each with its end."""
    known = np.concatenate([[0], (codes > 0).astype(np.int8), [0]])
    steps = np.diff(known)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    long = ends - starts >= shortest
    marks = np.zeros(len(codes) + 1, np.int64)
    marks[starts[long]] += 1
    # The separator behind a stretch is kept; the texts end in one.
    marks[np.minimum(ends[long] + 1, len(codes))] -= 1
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def shard_hits(texts: list[np.ndarray], phrases: Phrases) -> list[tuple[list, list, list]]:
    """Per coded text of a shard: starts and ends of its merged spans in words, the items found."""
    lengths = np.array([len(words) for words in texts], np.int64)
    # Each text is followed by a separator.
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    codes = np.zeros(int(begins[-1]), np.int64)
    for begin, words in zip(begins, texts):
        codes[begin:begin + len(words)] = words
    kept = _stretches(codes, phrases.shortest)
    covered = np.zeros(len(codes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    if len(kept):
        index = FMIndex(codes[kept], len(phrases.codes))
        for width, patterns, owners in phrases.groups:
            low, high = index.search(patterns)
            found = np.flatnonzero(low < high)
            times = (high - low)[found]
            if not len(found):
                continue
            rows = np.repeat(low[found] - np.cumsum(times) + times, times) + np.arange(times.sum())
            at = kept[index.locate(rows)]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + width, -1)
            docs = np.searchsorted(begins, at, side="right") - 1
            pairs = np.unique(np.stack([docs, np.repeat(found, times)]), axis=1)
            for doc, pattern in pairs.T.tolist():
                items[doc].update(owners[pattern])
    hit = (np.cumsum(covered)[:-1] > 0).astype(np.int8)
    steps = np.diff(np.concatenate([[0], hit, [0]]))
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    owner = np.searchsorted(begins, starts, side="right") - 1
    spans: list[tuple[list, list, list]] = [([], [], sorted(own)) for own in items]
    for doc, start, end in zip(owner.tolist(), starts.tolist(), ends.tolist()):
        spans[doc][0].append(start - int(begins[doc]))
        spans[doc][1].append(end - int(begins[doc]))
    return spans


def merged(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Spans in order, those that meet or overlap as one."""
    out: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [start for start, _ in out], [end for _, end in out]


# What is known of a row after some blocks: its number of words, its spans and its items.
HITS = pa.struct([("words", pa.int64()), ("starts", pa.list_(pa.int32())),
                  ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

# Makes a batch of results from one of (row, text, hits) and its new hits.
Finish = Callable[[pa.RecordBatch, list[dict]], pa.RecordBatch]


def _with_hits(rows: pa.RecordBatch, hits: list[dict]) -> pa.RecordBatch:
    return rows.set_column(2, "hits", pa.array(hits, HITS))


def _scan(rows: DataFrame, phrases: Phrases, finish: Finish, schema) -> DataFrame:
    """What ``finish`` makes of (row, text, hits) with the hits of one block of items added."""

    def shard(rows: pa.RecordBatch, texts: list[np.ndarray]) -> pa.RecordBatch:
        out = []
        for words, had, (starts, ends, items) in zip(texts, rows.column(2).to_pylist(),
                                                     shard_hits(texts, phrases)):
            starts, ends = merged(had["starts"] + starts, had["ends"] + ends)
            out.append({"words": len(words), "starts": starts, "ends": ends,
                        "items": sorted({*had["items"], *items})})
        return finish(rows, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, size, done = [], 0, 0
            for cell in batch.column(1):
                words = phrases.coded(cell.as_py())
                if texts and size + len(words) > SHARD_WORDS:
                    yield shard(batch.slice(done, len(texts)), texts)
                    done += len(texts)
                    texts, size = [], 0
                texts.append(words)
                size += len(words)
            yield shard(batch.slice(done), texts)
        give_back()

    return rows.mapInArrow(run, schema)


def _passes(docs: DataFrame, row: Column, benchmark: DataFrame, text: str, item: str,
            item_text: str, window: int, finish: Finish, schema: str) -> DataFrame:
    """What ``finish`` makes of (row, text, hits) with the hits of all blocks of test items.

    ``schema`` is that of its columns beside ``row``.
    """
    none = F.struct(F.lit(0).cast("long").alias("words"), *(
        F.array().cast(kind).alias(name) for name, kind in (
            ("starts", "array<int>"), ("ends", "array<int>"), ("items", "array<string>"))))
    rows = docs.select(row.alias("row"), F.col(text).cast("string").alias("text"),
                       none.alias("hits"))
    items = benchmark.select(F.col(item).cast("string").alias("item"),
                             F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    kind = rows.schema["row"].dataType.simpleString()
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        phrases = Phrases([(r["item"], r["text"]) for r in part], window)
        if block < blocks - 1:
            rows = _scan(rows, phrases, _with_hits, rows.schema)
    return _scan(rows, phrases, finish, f"row {kind}, {schema}")


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  share: int = 20) -> DataFrame:
    """Per row: ``id``, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit when it lies in an occurrence of ``window`` consecutive words of an item (all
    of its words if it has fewer). A document is contaminated when at least one word in
    ``share`` is hit. NULL and empty texts have no words and are clean; items without words
    have no windows, and those without id make hits but are not counted. Items that repeat
    count once, rows that repeat each give a row.
    """
    def finish(rows: pa.RecordBatch, hits: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(hits, HITS)],
                                          names=["row", "hits"])

    hits = _passes(docs, F.col(id), benchmark, text, item, item_text, window, finish,
                   "hits struct<words: bigint, starts: array<int>, ends: array<int>, "
                   "items: array<string>>")
    items = F.array_sort("hits.items")
    n_hit = F.aggregate(F.zip_with("hits.starts", "hits.ends", lambda a, b: b - a),
                        F.lit(0).cast("long"), lambda total, width: total + width)
    return (hits.select(F.col("row").alias(id), F.col("hits.words").alias("n_words"),
                        n_hit.alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0)
                        & (share * F.col("n_hit") >= F.col("n_words"))))


def cut(text: str, starts: list[int], ends: list[int]) -> str:
    """A text without some spans of its words; what stands between words outside them stays."""
    places = [match.span() for match in WORD.finditer(
        text.translate({c: c + 32 for c in range(0x41, 0x5B)}))]
    pieces, done = [], 0
    for start, end in zip(starts, ends):
        pieces.append(text[done:places[start][0]])
        done = places[end - 1][1]
    return "".join(pieces) + text[done:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  share: int = 20) -> DataFrame:
    """``docs`` without contaminated rows, and the removal spans cut from the texts of the rest.

    All columns stay as they are but for ``text``. Cases as for ``contamination``.
    """
    others = [F.col(f"`{name}`") for name in docs.columns if name != text]

    def finish(rows: pa.RecordBatch, hits: list[dict]) -> pa.RecordBatch:
        kept, texts = [], []
        for k, (value, hit) in enumerate(zip(rows.column(1), hits)):
            n_hit = sum(hit["ends"]) - sum(hit["starts"])
            if n_hit and share * n_hit >= hit["words"]:
                continue
            kept.append(k)
            value = value.as_py()
            texts.append(cut(value, hit["starts"], hit["ends"]) if n_hit else value)
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(kept, pa.int64())), pa.array(texts, pa.string())],
            names=["row", "text"])

    # The text goes beside the other columns, not among them as well.
    clean = _passes(docs, F.struct(*others) if others else F.lit(True), benchmark, text, item,
                    item_text, window, finish, "text string")
    return clean.select(*(F.col("text").alias(name) if name == text
                          else F.col(f"row.`{name}`").alias(name) for name in docs.columns))
