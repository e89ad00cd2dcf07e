"""Periodic runs: stretches of a text that repeat a group of words, found by descending LCP.

A run of period q is a stretch of at least ``LENGTH`` words and ``TIMES`` periods in which words
q apart are equal, which no neighbouring word extends and whose smallest period is q. In terms of
suffixes: its first word s and s + q have a common prefix (LCP) of length - q words, and no
position between them shares as much with either, since the run would have a smaller period then.

So the suffixes of a text are united in classes by falling LCP, as Kruskal's algorithm unites
nodes by cost: a union-find holds the classes, each with its positions in order. When two classes
meet at LCP l, positions of different classes that become neighbours at distance q, with l long
enough for a run, are a seed: the run of period q that ends l words after the later one. Seeds
inside of a run name the same end, and the least of them is the run's start.

The first words of a run, ``_shared()`` of them at least, occur again one period later, so texts
in which no so many words occur twice are left aside. The suffixes of the others are ranked by
prefix doubling, many texts at once, and their LCPs come from the ranks of all doublings. A text
is held by one task in whole, with a few numbers per word and doubling; there is no shuffle.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reknit.llm.shingles import mixed

# A run has at least so many words, and so many periods.
LENGTH, TIMES = 24, 3
# Texts are ranked together up to so many words.
BATCH_WORDS = 200_000

Run = tuple[int, int, int]


def _shared(length: int, times: int) -> int:
    """Words that the start of every run has in common with a later position."""
    return min(max(length - q, (times - 1) * q) for q in range(1, length + 1))


class _Codes(dict):
    """Words in numbers, by first appearance."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _repeating(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the texts in which a stretch of ``size`` words may occur twice (by hash)."""
    lengths = np.diff(starts)
    text = np.repeat(np.arange(len(lengths)), lengths)
    # A stretch's hash: of its greatest power of two words, and of as many that end with it.
    hashes, width = mixed(codes.astype(np.uint64) + np.uint64(1)), 1
    step = np.uint64(0x9E3779B97F4A7C15)
    while 2 * width <= size:
        hashes = mixed(hashes[:-width] * step + hashes[width:]) if len(hashes) > width else hashes[:0]
        width *= 2
    rest = size - width
    if rest:
        hashes = mixed(hashes[:-rest] * step + hashes[rest:]) if len(hashes) > rest else hashes[:0]
    inside = np.flatnonzero(np.arange(len(hashes)) + size <= starts[1:][text[:len(hashes)]])
    own = text[inside]
    hashes = mixed(hashes[inside] + own.astype(np.uint64) * step)
    order = np.argsort(hashes)
    again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    return np.unique(own[order[again]])


def _doubled_ranks(codes: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... words, until all stand alone.

    Equal ranks mean equal words within the same text. A rank is the number of positions before
    the first one of that rank, so it stays when others are told apart.
    """
    total = len(codes)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ends = starts[1:][text]
    order = np.lexsort((codes, text))
    fresh = np.ones(total, bool)
    fresh[1:] = (codes[order[1:]] != codes[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    firsts = np.flatnonzero(fresh)
    ranks = np.full(total + 1, -1, np.int64)
    ranks[order] = firsts[np.cumsum(fresh) - 1]
    levels, width = [ranks.astype(np.int32)], 1
    active = np.arange(total)
    while True:
        sizes = np.bincount(ranks[:-1], minlength=total)
        active = active[sizes[ranks[active]] > 1]
        if not len(active):
            return levels
        later = active + width
        following = np.where(later < ends[active], ranks[np.minimum(later, total)] + 1, 0)
        order = np.lexsort((following, ranks[active]))
        active, following = active[order], following[order]
        own = ranks[active]
        group = np.ones(len(active), bool)
        group[1:] = own[1:] != own[:-1]
        part = group.copy()
        part[1:] |= following[1:] != following[:-1]
        places = np.arange(len(active))
        group_first = places[group][np.cumsum(group) - 1]
        part_first = places[part][np.cumsum(part) - 1]
        ranks = ranks.copy()
        ranks[active] = own + part_first - group_first
        width *= 2
        levels.append(ranks.astype(np.int32))


def _common_prefixes(one: np.ndarray, other: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at two positions of a text begin with in common."""
    length = np.zeros(len(one), np.int64)
    for power in range(len(levels) - 1, -1, -1):
        ranks = levels[power]
        length += (ranks[one + length] == ranks[other + length]).astype(np.int64) << power
    return length


def _unite(order: list[int], prefixes: list[int], length: int, times: int,
           found: dict[tuple[int, int], int]) -> None:
    """Add runs as (period, end): start, from positions in suffix order and neighbours' LCPs.

    ``prefixes[k]`` is the LCP of positions ``order[k]`` and ``order[k + 1]``.
    """
    parent = list(range(len(order)))
    members = [[position] for position in order]

    def root(slot: int) -> int:
        while parent[slot] != slot:
            parent[slot] = slot = parent[parent[slot]]
        return slot

    def seed(early: int, late: int, prefix: int) -> None:
        period = late - early
        if (times - 1) * period <= prefix and period + prefix >= length:
            key = (period, late + prefix)
            if early < found.get(key, late):
                found[key] = early

    for slot in sorted(range(len(prefixes)), key=prefixes.__getitem__, reverse=True):
        prefix = prefixes[slot]
        one, other = root(slot), root(slot + 1)
        if len(members[one]) < len(members[other]):
            one, other = other, one
        parent[other] = one
        large, small = members[one], members[other]
        members[other] = []
        before = -1
        for k, position in enumerate(small):
            place = bisect_left(large, position)
            if place and large[place - 1] != before:
                seed(large[place - 1], position, prefix)
            if place < len(large) and (k + 1 == len(small) or large[place] < small[k + 1]):
                seed(position, large[place], prefix)
            large.insert(place, position)
            before = position


def find_runs(texts: list[list[bytes]], length: int = LENGTH,
              times: int = TIMES) -> list[list[Run]]:
    """The runs of each list of words, as (start, length, period), by start and period."""
    found: list[list[Run]] = [[] for _ in texts]
    shared = _shared(length, times)
    numbers = _Codes()
    codes = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]

    def joined(chosen: list[int]) -> tuple[np.ndarray, np.ndarray]:
        starts = np.concatenate([[0], np.cumsum([len(codes[k]) for k in chosen])]).astype(np.int64)
        return np.concatenate([codes[k] for k in chosen] or [np.empty(0, np.int64)]), starts

    long = [k for k, words in enumerate(texts) if len(words) >= length]
    chosen = [long[k] for k in _repeating(*joined(long), shared)]
    if not chosen:
        return found
    together, starts = joined(chosen)
    levels = _doubled_ranks(together, starts)
    # Positions whose first words occur elsewhere in the text, in the order of their suffixes.
    last = levels[-1][:-1]
    power = min(shared.bit_length() - 1, len(levels) - 1)
    alike = levels[power][:-1]
    kept = np.flatnonzero(np.bincount(alike, minlength=len(alike))[alike] > 1)
    order = kept[np.argsort(last[kept])]
    if not len(order):
        return found
    prefixes = _common_prefixes(order[:-1], order[1:], levels)
    # Suffixes with too little in common are never in one class; the rest goes in pieces.
    cuts = np.concatenate([[0], np.flatnonzero(prefixes < shared) + 1, [len(order)]])
    ordered, listed = order.tolist(), prefixes.tolist()
    seeds: dict[tuple[int, int], int] = {}
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a > 1:
            _unite(ordered[a:b], listed[a:b - 1], length, times, seeds)
    for (period, end), start in seeds.items():
        text = int(np.searchsorted(starts, start, "right")) - 1
        found[chosen[text]].append((start - int(starts[text]), end - start, period))
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that are left when every run keeps its first period only."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(kept)]


def detect(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH,
           times: int = TIMES) -> DataFrame:
    """Per row: ``id``, n_words, runs (start, length, period; by start and period), collapsed.

    Words are separated by space and \\t to \\r and compared as they are. ``collapsed`` is the
    text with each run cut to its first period and one space between words. NULL and empty texts
    have no words and collapse to the empty text. Every row gives one, repeated ones too; other
    columns, whatever their names, play no part. ``times`` is at least 2.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def solved(ids: list[pa.Array], texts: list[list[bytes]]) -> pa.RecordBatch:
        found = find_runs(texts, length, times)
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays(ids), pa.array([len(words) for words in texts], pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), run)) for run in runs]
                      for runs in found], pa.list_(run_type)),
            pa.array([b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")
                      for words, runs in zip(texts, found)], pa.string())],
            names=["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        texts: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for k, cell in enumerate(batch.column("text")):
                ids.append(batch.column("id").slice(k, 1))
                words = (cell.as_py() or "").encode("utf-8", "surrogatepass").split()
                texts.append(words)
                held += len(words)
                if held >= BATCH_WORDS:
                    yield solved(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield solved(ids, texts)

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, n_words long, runs array<struct<start: long, length: long, "
             "period: long>>, collapsed string").withColumnRenamed("id", id)


def strongest(runs: str) -> F.Column:
    """Of an array of runs, that of most periods (ties: smallest start, then period), or NULL."""
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
                    lambda best, run: F.when(
                        run["length"] * best["period"] > best["length"] * run["period"],
                        run).otherwise(best))
