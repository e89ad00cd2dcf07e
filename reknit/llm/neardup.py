"""Near duplicates by b-bit MinHash.

Every text becomes its set of word shingles and 128 minima. Bands of four minima name buckets
that similar texts share; the two low bits of each minimum are packed into 32 bytes, from which
a pair's similarity is estimated by counting equal cells and taking off chance collisions.

1. Texts with equal sets form a class, which gets a number of its own and is represented by one
   document (a minimum per fingerprint, combined map-side, so a third of all rows may be copies
   of one text).
2. Classes that share buckets form families: components of the edges from each bucket's
   smallest member, which are as many as members, never pairs.
3. A family's sets meet in one task, those of a larger one in pairs of blocks, and those of a
   family of very many blocks bucket by bucket, so no task ever holds more than two blocks.
4. In the task, pairs of different components whose estimate passes are verified on full sets;
   links that join two components leave the task (at most one per member), not all pairs.
5. The components of these links are the groups.

The estimate is let through down to where a pair at the threshold falls once in 10**10 (the exact
binomial tail), and 32 bands miss a link at a similarity of 0.8 once in 2 * 10**7, at 0.85 once
in 10**10.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from reknit.llm.components import components
from reknit.llm.memory import give_back
from reknit.llm.shingles import (
    WordHashes, minima, mixed, permutations, shingle_set, words_of)
from reknit.session import broadcast_if_small, materialize, measure

ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
BITS = 2
CHANCE = 1 / 2**BITS

# A task takes at most so many members and shingles of a side; larger groups are dealt in blocks.
BLOCK_MEMBERS = 2_000
BLOCK_SHINGLES = 1_000_000
# A task gives memory back after groups of so many members.
LARGE_MEMBERS = 500
# A family of up to so many blocks is dealt in pairs of them, a larger one bucket by bucket.
GRID = 16


def packed(lowest: np.ndarray) -> bytes:
    """The low bits of the minima, four to a byte."""
    low = (lowest & np.uint32(3)).astype(np.uint8).reshape(-1, 4)
    return (low << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities of a packed signature to others, corrected for cells equal by chance."""
    differing = one ^ others
    cells = (differing | (differing >> np.uint64(1))) & np.uint64(0x5555555555555555)
    equal = 1 - np.bitwise_count(cells).sum(axis=1) / HASHES
    return (equal - CHANCE) / (1 - CHANCE)


def estimate_floor(threshold: float, missed: float = 1e-10) -> float:
    """The estimate that a pair at the threshold falls below with a probability of ``missed``."""
    equal = CHANCE + (1 - CHANCE) * threshold
    cells, below = 0, (1 - equal) ** HASHES
    while below <= missed:
        cells += 1
        below += math.comb(HASHES, cells) * equal**cells * (1 - equal) ** (HASHES - cells)
    return (cells / HASHES - CHANCE) / (1 - CHANCE)


def band_keys(lowest: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band."""
    rows = lowest.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        keys = mixed((keys + rows[:, row]) * np.uint64(0x9E3779B97F4A7C15))
    return keys.view(np.int64)


def signatures(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """Per row: doc, n_shingles, print (of the set), signature, keys (of its buckets)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, multipliers = WordHashes(), permutations(HASHES)
        for batch in batches:
            counts, prints, packs, keys = [], [], [], []
            for value in batch.column(1):
                found = shingle_set(words_of(value.as_py()), size, hashes)
                counts.append(len(found))
                lowest = minima(found, multipliers) if len(found) else None
                prints.append(_print(found))
                packs.append(None if lowest is None else packed(lowest))
                keys.append(None if lowest is None else band_keys(lowest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(packs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc", "n_shingles", "print", "signature", "keys"])
        give_back()

    rows = docs.select(F.col(id).alias("doc"), F.col(text).cast("string"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc {kind}, n_shingles long, print binary, signature binary, keys array<long>")


def _print(found: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None


def _full_sets(texts: DataFrame, size: int) -> DataFrame:
    """(text) becomes (print, shingles), the set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(words_of(value.as_py()), size, hashes)
                    for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_print(found) for found in sets], pa.binary()),
                 pa.array([found.tobytes() for found in sets], pa.binary())],
                names=["print", "shingles"])
        give_back()

    return texts.mapInArrow(run, "print binary, shingles binary").filter("print IS NOT NULL")


class _Bitsets:
    """Sets of one task as bit rows over the shingles that at least two of them hold."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(found) for found in sets], np.int64)
        values, place, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = counts > 1
        column = np.cumsum(shared) - 1
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.columns = [column[own[shared[own]]] for own in
                        (place[a:b] for a, b in zip(starts, starts[1:]))]
        self.width = int(shared.sum())

    def common(self, one: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of one set with others."""
        mask = np.zeros(self.width + 1, bool)
        mask[self.columns[one]] = True
        lengths = [len(self.columns[k]) for k in others]
        if not sum(lengths):
            return np.zeros(len(others), np.int64)
        hits = mask[np.concatenate([self.columns[k] for k in others])].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(hits)])
        ends = np.cumsum(lengths)
        return sums[ends] - sums[ends - lengths]


def links_within(docs: np.ndarray, side: np.ndarray, sketches: np.ndarray,
                 sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links that join the members of a task into their components.

    With two sides only pairs across them count, as another task has the pairs within. A pair
    is skipped once its ends are joined by links found before it.
    """
    bits, floor = _Bitsets(sets), estimate_floor(threshold)
    percent = round(threshold * 10_000)
    root = np.arange(len(docs))
    two = side.min() != side.max()
    links = []
    for one in range(len(docs) - 1):
        others = np.arange(one + 1, len(docs))
        passing = root[others] != root[one]
        if two:
            passing &= side[others] != side[one]
        others = others[passing]
        small, large = (f(bits.sizes[one], bits.sizes[others]) for f in (np.minimum, np.maximum))
        others = others[small * 10_000 >= percent * large]
        others = others[estimates(sketches[one], sketches[others]) >= floor]
        if not len(others):
            continue
        common = bits.common(one, others)
        union = bits.sizes[one] + bits.sizes[others] - common
        for other in others[common * 10_000 >= percent * union]:
            if root[other] != root[one]:
                root[root == root[other]] = root[one]
                links.append((int(docs[one]), int(docs[other])))
    return links


def _family_links(members: DataFrame, threshold: float) -> DataFrame:
    """Verified links of (unit, i, j, side, node, signature, shingles)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # A text that is both of a single and of a repeated id comes twice.
        group = group.sort_values("node", kind="stable").drop_duplicates("node")
        sets = [np.frombuffer(found, np.uint64) for found in group["shingles"]]
        sketches = np.frombuffer(b"".join(group["signature"]), np.uint64).reshape(len(group), -1)
        found = links_within(group["node"].to_numpy(), group["side"].to_numpy(), sketches, sets,
                             threshold)
        if len(group) >= LARGE_MEMBERS:
            # Not for every one of many small families.
            del sets, sketches
            give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return members.groupBy("unit", "i", "j").applyInPandas(run, "a long, b long")


def _units(members: DataFrame, banded: DataFrame) -> DataFrame:
    """Which tasks a member takes part in: (node, unit, i, j, side)."""
    def blocked(sizes: DataFrame) -> DataFrame:
        return sizes.withColumn("blocks", F.greatest(
            F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int"))

    def dealt(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("side", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("node", "unit", F.least("side", "other").alias("i"),
                        F.greatest("side", "other").alias("j"), "side"))

    sizes = blocked(members.groupBy("family").agg(F.count("*").alias("n"),
                                                  F.sum("n_shingles").alias("total")))
    sized = members.join(sizes.select("family", "blocks"), "family")
    whole = sized.filter(F.col("blocks") <= GRID).withColumn("unit", F.col("family"))
    inside = banded.join(sized.filter(F.col("blocks") > GRID).select("node", "n_shingles"), "node")
    buckets = blocked(inside.groupBy("key").agg(F.count("*").alias("n"),
                                                F.sum("n_shingles").alias("total"))
                      .filter("n > 1"))
    split = inside.join(buckets.select("key", "blocks"), "key").withColumn("unit", F.col("key"))
    return dealt(whole).unionByName(dealt(split))


def _repeated(rows: DataFrame) -> DataFrame:
    """Ids of more than one row (doc), with the least and greatest print of their texts."""
    return materialize(
        rows.filter("doc IS NOT NULL").groupBy("doc").agg(
            F.count("*").alias("n"), F.min("print").alias("one"), F.max("print").alias("other"))
        .filter("n > 1").drop("n"), "repeated")


def _classes(docs: DataFrame, rows: DataFrame, repeated: DataFrame, id: str, text: str, size: int,
             threshold: float) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (node, print, low: its smallest id), and the links that join them.

    ``rows`` are the signatures. A class is a node of its own even where ids repeat.
    """
    usable = rows.filter("doc IS NOT NULL AND print IS NOT NULL")
    classes = materialize(
        usable.groupBy("print").agg(F.min("doc").alias("low"), *(
            F.first(name).alias(name) for name in ("n_shingles", "signature", "keys")))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    banded = classes.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")) \
        .filter("least < most")
    banded = materialize(banded.join(shared.select("key", "least"), "key"), "buckets")
    families = components(banded.select(F.col("least").alias("a"), F.col("node").alias("b")))
    members = materialize(classes.drop("keys").join(
        families.select("node", F.col("low").alias("family")), "node"), "members")
    dealt = _units(members, banded.select("node", "key")).join(
        members.select("node", "print", "signature"), "node")
    # Of a class one text goes on.
    texts = (docs.select(F.col(id).alias("doc"), F.col(text).cast("string").alias("text"))
             .join(members.select(F.col("low").alias("doc")).distinct(), "doc", "left_semi"))
    if repeated.isEmpty():
        sets = _full_sets(texts.select("text"), size)
    else:
        # A repeated id has other texts, and the same one again, however often.
        once = texts.join(repeated, "doc", "left_anti")
        more = texts.join(repeated, "doc", "left_semi")
        sets = _full_sets(once.select("text"), size).unionByName(
            _full_sets(more.select("text"), size).groupBy("print").agg(
                F.first("shingles").alias("shingles")))
    links = _family_links(dealt.join(sets, "print").drop("print"), threshold)
    return classes.select("node", "print", "low"), links


def _grouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Per class: print, low, and the number of its group."""
    groups = components(links)
    return classes.join(groups.select("node", F.col("low").alias("group")), "node", "left").select(
        "print", "low", F.coalesce("group", "node").alias("group"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """Per row: ``id``, n_shingles, component_id (the smallest id reachable), kept.

    Texts are linked when the Jaccard similarity of their sets of ``size``-word shingles is at
    least ``threshold``. NULL and empty texts, and rows without id, are linked with nothing
    (component_id is their own id). Rows that repeat an id are one document, linked by any of
    their texts; each gives a row. Ids may be of any type that can be ordered. Other columns of
    ``docs`` are not looked at.
    """
    rows = materialize(signatures(docs, id, text, size), "signatures")
    repeated = _repeated(rows)
    classes, links = _classes(docs, rows, repeated, id, text, size, threshold)
    # An id that repeats with another text ties the classes of its texts together.
    usable = rows.filter("doc IS NOT NULL AND print IS NOT NULL").select("doc", "print")
    again = repeated.filter("one <> other").select("doc")
    placed = (usable.join(again, "doc").distinct().join(classes, "print").select("doc", "node"))
    tied = placed.join(placed.groupBy("doc").agg(F.min("node").alias("a")), "doc").select(
        "a", F.col("node").alias("b"))
    groups = materialize(_grouped(classes, links.unionByName(tied)), "groups")
    lows = groups.join(groups.groupBy("group").agg(F.min("low").alias("component")), "group")
    return (rows.select("doc", "n_shingles", F.when(F.col("doc").isNotNull(), F.col("print"))
                        .alias("print"))
            .join(lows.select("print", "component"), "print", "left")
            .withColumn("component_id", F.coalesce("component", "doc"))
            .select(F.col("doc").alias(id), "n_shingles", "component_id",
                    F.col("doc").eqNullSafe(F.col("component_id")).alias("kept")))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5,
             threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of texts one row stays.

    It is the one with the smallest id. Here rows are judged by their texts, so of rows that
    repeat an id those with texts of their own stay. Rows without id, and those with a NULL or
    empty text, all stay.
    """
    rows = materialize(signatures(docs, id, text, size), "signatures")
    repeated = _repeated(rows)
    classes, links = _classes(docs, rows, repeated, id, text, size, threshold)
    best = F.min(F.struct("low", "print"))
    stay = (_grouped(classes, links).groupBy("group").agg(best.alias("best"))
            .select(F.col("best.low").alias("doc"), F.col("best.print").alias("print")))
    stay = materialize(stay, "stay")
    again = repeated.select("doc")
    # Ids that occur once go by their ids alone, and no text is looked at again.
    gone = materialize(
        rows.filter("doc IS NOT NULL AND print IS NOT NULL").select("doc", "print")
        .join(again, "doc", "left_anti").join(stay, ["doc", "print"], "left_anti").select("doc"),
        "gone")
    key = docs[id]

    def without(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        other = broadcast_if_small(other.withColumnRenamed("doc", "__doc"), measure(other))
        return rows.join(other, key == F.col("__doc"), how)

    kept = without(docs, gone, "left_anti")
    if again.isEmpty():
        return kept
    repeated = without(docs, again, "left_semi")
    judged = _with_prints(repeated, text, size)
    own = F.struct(F.col(f"row.`{id}`").alias("doc"), F.col("print"))
    winners = judged.filter("print IS NOT NULL").join(
        stay.select(F.struct("doc", "print").alias("own")), own == F.col("own"), "left_semi")
    # Of rows with the same id and text any one will do.
    one = (winners.groupBy(F.col(f"row.`{id}`").alias("__id"), "print")
           .agg(F.first("row").alias("row")).select("row.*"))
    empty = judged.filter("print IS NULL").select("row.*")
    return without(kept, again, "left_anti").unionByName(one).unionByName(empty)


def _with_prints(docs: DataFrame, text: str, size: int) -> DataFrame:
    """Rows of ``docs`` as structs, with the prints of their texts."""
    cells = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
                        F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            prints = [_print(shingle_set(words_of(value.as_py()), size, hashes))
                      for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())],
                                             names=["row", "print"])

    schema = cells.select("row").schema.add("print", BinaryType())
    return cells.mapInArrow(run, schema)
