"""Exact top-k search by inner products, with block-at-a-time pruning.

Vectors are sparse rows of integer term weights. Rows in id order make document-range blocks,
which keep each term's largest and smallest weight. The sum of a query's weights times these
bounds every score in a block; per query, blocks are taken by falling bound and scored through
their forward index until the bounds fall below the k-th score found. Ties are kept apart by
id, so a block whose bound equals the k-th score is still scored.

Queries are a stated part of the rows. They go out in blocks of bounded size, each of which
passes over all rows once; a task keeps k rows per query, and these are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reknit.session import materialize

BLOCK_ROWS = 256
# Components of all queries that are sent out together (64 MB as integers).
QUERY_COMPONENTS = 8_000_000
SCALE = 256

LARGEST = 2**63 - 1


def product(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """one · otherᵀ in exact integers; scores beyond a long become the nearest long."""
    width = min(one.shape[1], other.shape[1])
    one, other = one[:, :width], other[:, :width]
    if not width or not one.size or not other.size:
        return np.zeros((len(one), len(other)), np.int64)
    most = max(int(abs(one.astype(float)).max()), 1) * max(int(abs(other.astype(float)).max()), 1)
    if most * width < 2**53:
        return (one.astype(float) @ other.T.astype(float)).astype(np.int64)
    if most * width < 2**62:
        return one @ other.T
    return np.clip(one.astype(object) @ other.T.astype(object), -LARGEST, LARGEST).astype(np.int64)


class Best:
    """The k best (score, id) of each query, by falling score, then id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -LARGEST - 1, np.int64)
        self.ids = np.full((queries, k), LARGEST, np.int64)
        self.filled = np.zeros(queries, np.int64)

    def takes(self, bounds: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Could rows of these bounds still be among the best of these queries?"""
        return (self.filled[queries] < self.k) | (bounds >= self.scores[queries, -1])

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(queries):
            return
        touched = np.unique(queries)
        slots = np.arange(self.k) < self.filled[touched, None]
        queries = np.concatenate([queries, np.repeat(touched, self.k)[slots.ravel()]])
        scores = np.concatenate([scores, self.scores[touched][slots]])
        ids = np.concatenate([ids, self.ids[touched][slots]])
        order = np.lexsort((ids, ~scores, queries))
        queries, scores, ids = queries[order], scores[order], ids[order]
        begins = np.searchsorted(queries, touched)
        rank = np.arange(len(queries)) - np.repeat(
            begins, np.diff(np.append(begins, len(queries))))
        kept = rank < self.k
        self.scores[queries[kept], rank[kept]] = scores[kept]
        self.ids[queries[kept], rank[kept]] = ids[kept]
        self.filled[touched] = np.minimum(
            self.k, np.diff(np.append(begins, len(queries))))


def search(best: Best, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray,
           rows: np.ndarray, block_rows: int = BLOCK_ROWS) -> int:
    """Add the best of some rows; the number of (query, block) pairs that were scored."""
    starts = np.arange(0, len(rows), block_rows)
    largest = np.maximum.reduceat(rows, starts) if rows.size else np.zeros((len(starts), 0), int)
    smallest = np.minimum.reduceat(rows, starts) if rows.size else largest
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = product(positive, largest) + product(negative, smallest)
    order = np.argsort(~bounds, axis=1, kind="stable")
    active, scored = np.arange(len(queries)), 0
    for step in range(len(starts)):
        blocks = order[active, step]
        active = active[best.takes(bounds[active, blocks], active)]
        if not len(active):
            break
        blocks = order[active, step]
        found = []
        for block in np.unique(blocks):
            own = active[blocks == block]
            part = slice(starts[block], starts[block] + block_rows)
            scores = product(queries[own], rows[part])
            hits = best.takes(scores.T, own).T & (ids[part][None, :] != query_ids[own][:, None])
            at, column = np.nonzero(hits)
            found.append((own[at], scores[at, column], ids[part][column]))
            scored += len(own)
        best.add(*(np.concatenate(column) for column in zip(*found)))
    return scored


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of integers, filled up with zeros to the longest one."""
    lengths = np.diff(vectors.offsets.to_numpy())
    rows = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
    return rows


def weights(vectors: DataFrame, id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """(id, terms): the rows that take part, in id order over range partitions, each id once."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(id).isNotNull() & F.col(embedding).isNotNull() & usable).select(
        F.col(id).cast("long").alias("id"), F.transform(
            embedding, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            fresh = np.diff(ids, prepend=ids[:1]) != 0
            if len(ids):
                fresh[0], last = last is None or ids[0] != last, ids[-1]
            yield batch.filter(pa.array(fresh))

    return materialize(rows.repartitionByRange("id").sortWithinPartitions("id", "terms")
                       .mapInArrow(run, rows.schema), "weights")


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id: str = "vec_id",
          embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Per query: query_id, rank (from 1), ``id``, score of its ``k`` best other rows.

    ``queries`` tells the rows that are searched for. Components become floor(scale * x);
    vectors that are NULL or hold NULL, NaN or infinity, and rows without id, take no part.
    Shorter vectors count as filled up with zeros, an empty one scores 0. Rows that repeat an
    id count once, as the smallest of their vectors. Ties go to the smaller id; with fewer rows
    than ``k`` all are returned, and an empty table gives none.
    """
    rows = weights(vectors, id, embedding, scale)
    asked = rows.withColumnRenamed("id", id).filter(queries).withColumnRenamed(id, "id")
    size = asked.agg(F.sum(F.greatest(F.size("terms"), F.lit(1)))).first()[0] or 0
    parts = size // QUERY_COMPONENTS + 1
    found = None
    for part in range(parts):
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toArrow()
        block = block.combine_chunks()
        one = (_pass(rows, block["id"].to_numpy(), _matrix(block["terms"].combine_chunks()), k)
               if len(block) else None)
        found = one if found is None else found if one is None else found.unionByName(one)
    if found is None:
        found = rows.limit(0).selectExpr("id AS query_id", "id", "id AS score")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id), "score"))


def _pass(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """The k best rows per query of every task."""
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best = Best(len(query_ids), k)
        for batch in batches:
            if len(batch):
                search(best, query_ids, queries, batch.column(0).to_numpy(),
                       _matrix(batch.column(1)))
        query, place = np.nonzero(np.arange(k) < best.filled[:, None])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[query]), pa.array(best.ids[query, place]),
             pa.array(best.scores[query, place])], names=["query_id", "id", "score"])

    return rows.mapInArrow(run, "query_id long, id long, score long")
