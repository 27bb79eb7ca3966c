"""Exact histogram of encoded lengths and what it answers for every context limit.

Texts are encoded in tasks and counted by length before the shuffle.  The histogram has a
row for each length that occurs, so it is small against the corpus; suffix sums over it
give documents and tokens at or beyond a length and the total when all documents are
cut at that length.  Sums run over ranges of ``RANGE`` lengths and then over the ranges, so
no window holds more than a range.  The histogram is stored once, as both read it.

Null and empty texts have length 0.  An empty table gives an empty histogram.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.byte_bpe import load_pieces
from textmill.session import cut_lineage

RANGE = 1024
# Longer runs of white space are beyond the pattern engine's stack.
_LONG_BLANK = re.compile(r"\s{50000,}")


def lengths(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """One column ``n_tokens``: the encoded length of every row's text."""
    pieces = df.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = {piece: i for i, piece in enumerate(pieces.value)}
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        def length(value: str | None) -> int:
            total, begin = 0, 0
            for blank in _LONG_BLANK.finditer(value or ""):
                # The run without its last character is one piece of the pattern.
                total += len(coder.encode_ordinary(value[begin : blank.start()]))
                stop = blank.end() - (blank.end() < len(value))
                total += len(coder.encode_single_piece(value[blank.start() : stop]))
                begin = stop
            return total + len(coder.encode_ordinary((value or "")[begin:]))

        for batch in batches:
            made = np.array([length(t.as_py()) for t in batch.column(0)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(made)], names=["n_tokens"])

    return df.select(text).mapInArrow(run, T.StructType([T.StructField("n_tokens", T.LongType())]))


def histogram(counted: DataFrame, length: str = "n_tokens") -> DataFrame:
    """``length, documents`` and the suffix sums for each length that occurs.

    ``documents_from`` and ``tokens_from`` cover lengths at or above it, ``documents_to`` those
    up to it; ``truncated_tokens`` is the total when every document is cut at this length and
    ``lost_tokens`` what that drops; ``rank`` is the share of documents up to it.
    """
    counts = counted.groupBy(F.col(length).alias("length")).agg(F.count("*").alias("documents"))
    bars = cut_lineage(counts, "lengths").withColumn("_range", F.floor(F.col("length") / RANGE)).withColumn("_tokens", F.col("length") * F.col("documents"))
    totals = bars.groupBy("_range").agg(F.sum("documents").alias("_d"), F.sum("_tokens").alias("_t"))
    # One row for each range of lengths.
    later = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shifts = totals.select(
        "_range",
        F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_d"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_t"),
        F.sum("_d").over(everything).alias("_all_d"),
        F.sum("_t").over(everything).alias("_all_t"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = bars.withColumn("_sd", F.sum("documents").over(inside)).withColumn("_st", F.sum("_tokens").over(inside))
    joined = summed.join(shifts, "_range").select(
        "length",
        "documents",
        (F.col("_sd") + F.col("_d")).alias("documents_from"),
        (F.col("_st") + F.col("_t")).alias("tokens_from"),
        "_all_d",
        "_all_t",
    )
    beyond = F.col("tokens_from") - F.col("length") * F.col("documents_from")
    upto = F.col("_all_d") - F.col("documents_from") + F.col("documents")
    return joined.select(
        "length",
        "documents",
        "documents_from",
        "tokens_from",
        upto.alias("documents_to"),
        (F.col("_all_t") - beyond).alias("truncated_tokens"),
        beyond.alias("lost_tokens"),
        (upto / F.col("_all_d")).alias("rank"),
    )


def at_limits(bars: DataFrame, limits: DataFrame, limit: str = "context_limit") -> DataFrame:
    """Totals for any limits: those of the next length at or above, corrected by the distance."""
    above = bars.select("length", "documents_from", "tokens_from")
    all_tokens = bars.agg(F.max("tokens_from").alias("total_tokens"))
    met = limits.join(above, F.col("length") >= F.col(limit), "left")
    first = met.groupBy(limit).agg(F.min(F.struct("length", "documents_from", "tokens_from")).alias("b"))
    beyond = F.coalesce(F.col("b.tokens_from") - F.col(limit) * F.col("b.documents_from"), F.lit(0))
    return first.join(F.broadcast(all_tokens)).select(
        limit,
        F.coalesce("b.documents_from", F.lit(0)).alias("documents_from"),
        (F.col("total_tokens") - beyond).alias("truncated_tokens"),
        beyond.alias("lost_tokens"),
    )


def quantile(bars: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    return bars.filter(F.col("rank") >= share).agg(F.min("length").alias("length"))
