"""Token counts as an exact histogram of encoded lengths.

Documents are encoded by a byte-level BPE of given ranks and only their lengths are kept, which
are counted per distinct length (map-side first, so equal lengths cost nothing to move). Suffix
sums over the histogram then answer totals, quantiles and truncated totals for every context
limit without looking at a document again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reknit.session import materialize

# Lengths that are summed up together first, so that no window orders the whole histogram.
CELL = 1024

# Fixed value: how the vocabulary's texts were cut before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# White space of the pattern (the Unicode property). Runs from this length on are cut from the
# text before the pattern sees them, as it goes back over a run character by character.
_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = 1_000
_LONG_SPACE = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """A text in parts that are encoded apart, and whether the pattern cuts a part no further.

    The pattern takes a run of white space up to its last character, which belongs to what
    follows, or to its end where nothing follows; nothing before a run reaches into it. So a
    run but its last character is one of the pattern's cuts, and the rest is as it would be.
    """
    begin = 0
    for run in _LONG_SPACE.finditer(text) if len(text) >= LONG_SPACE else ():
        end = run.end() - (run.end() < len(text))
        yield text[begin:run.start()], False
        yield text[run.start():end], True
        begin = end
    yield text[begin:], False


class Coder:
    """A byte-level BPE that is built where it is used first.

    Texts are encoded whole, however long they are.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self._built = ranks, pattern, None

    def __getstate__(self):
        return self.ranks, self.pattern

    def __setstate__(self, state):
        self.__init__(*state)

    def length(self, text: str) -> int:
        import tiktoken

        if self._built is None:
            self._built = [tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=self.ranks,
                                             special_tokens={}).encode_ordinary
                           for pattern in (self.pattern, r"[\s\S]+")]
        pattern, whole = self._built
        return sum(len((whole if uncut else pattern)(part)) for part, uncut in parts(text))


def load_coder(path: str, pattern: str = PATTERN) -> Coder:
    """The ranks of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return Coder({base64.b64decode(token): int(rank) for token, rank in
                      (line.split() for line in lines)}, pattern)


def encoded_lengths(docs: DataFrame, coder: Coder, text: str = "text",
                    by: Sequence[str] = ()) -> DataFrame:
    """Per row ``by`` and its length in tokens; NULL and empty texts have 0, long ones are whole."""
    shared = docs.sparkSession.sparkContext.broadcast(coder)
    rows = docs.select(*by, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            lengths = np.array([coder.length(cell.as_py()) if cell.is_valid else 0
                                for cell in batch.column(len(by))], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(by)], pa.array(lengths)],
                                             names=[*by, "length"])

    fields = "".join(f"`{name}` {kind}, " for name, kind in rows.dtypes[:len(by)])
    return rows.mapInArrow(run, f"{fields}length long")


def histogram(docs: DataFrame, coder: Coder, text: str = "text",
              by: Sequence[str] = ()) -> DataFrame:
    """Per distinct length (and ``by``): docs, tokens, and the answers for that context limit.

    docs_longer and tokens_longer are the suffix sums beyond the length, quantile the share of
    documents up to it, and truncated_total the tokens left when every document is cut to it.
    An empty table gives no rows.
    """
    counted = materialize(
        encoded_lengths(docs, coder, text, by).groupBy(*by, "length")
        .agg(F.count("*").alias("docs"))
        .withColumn("tokens", F.col("length") * F.col("docs"))
        .withColumn("__cell", F.floor(F.col("length") / CELL)), "lengths")
    names = ("docs", "tokens")
    # Two levels: the sums of whole cells beyond, and those of longer texts in the same cell.
    cells = counted.groupBy(*by, "__cell").agg(*(F.sum(n).alias(n) for n in names))
    beyond = Window.partitionBy(*by).orderBy(F.desc("__cell")).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    cells = cells.select(
        *(F.col(name).alias(f"__by_{name}") for name in (*by, "__cell")),
        *(F.coalesce(F.sum(n).over(beyond), F.lit(0)).alias(f"__{n}") for n in names),
        *(F.sum(n).over(everything).alias(f"__all_{n}") for n in names))
    within = Window.partitionBy(*by, "__cell").orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, -1)
    longer = counted.join(cells, [F.col(name).eqNullSafe(F.col(f"__by_{name}"))
                                  for name in (*by, "__cell")])
    longer = longer.select("*", *(
        (F.col(f"__{n}") + F.coalesce(F.sum(n).over(within), F.lit(0))).alias(f"{n}_longer")
        for n in names))
    return longer.select(
        *by, "length", "docs", "tokens", "docs_longer", "tokens_longer",
        (1 - F.col("docs_longer") / F.col("__all_docs")).alias("quantile"),
        (F.col("__all_tokens") - F.col("tokens_longer")
         + F.col("length") * F.col("docs_longer")).alias("truncated_total"))


def answers(spark: SparkSession, found: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For any context limits, from a histogram without ``by``: limit, docs and tokens within,
    and the total when every document is cut to the limit."""
    asked = spark.createDataFrame([(int(limit),) for limit in limits], "`limit` long")
    # A few stated limits against the histogram, which has a row per distinct length.
    pairs = found.select("length", "docs", "tokens").join(F.broadcast(asked))
    fits = F.col("length") <= F.col("limit")
    return pairs.groupBy("limit").agg(
        F.sum(F.when(fits, F.col("docs")).otherwise(0)).alias("docs_within"),
        F.sum(F.when(fits, F.col("tokens")).otherwise(0)).alias("tokens_within"),
        F.sum(F.when(fits, F.col("tokens")).otherwise(F.col("docs") * F.col("limit")))
        .alias("truncated_total"))
