"""Concatenate token rows in order and cut them into equal blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.arrays import IGNORED_LABEL
from textmill.operators.exploding import explode_structs
from textmill.operators.ordering import BUCKET, prefix_sum, row_numbers, whole_div


def _pieces(placed: DataFrame, ids: str, block: int, keys: list[str], cols: list[str]) -> DataFrame:
    """Cut every row at block borders; one output row per (row, block).

    Slices are taken before the explode, so a long row is copied once only.
    """
    start = F.col("start")
    first = whole_div(start, block)
    last = whole_div(start + F.size(ids) - 1, block)

    def piece(b: Column) -> Column:
        begin = F.greatest(b * block, start)
        offset = (begin - start).cast("int")
        length = (b * block + block - begin).cast("int")
        return F.struct(
            b.alias("block_id"),
            begin.alias("_at"),
            *(F.slice(F.col(c), offset + 1, length).alias(c) for c in cols),
        )

    return explode_structs(placed, [*keys], F.transform(F.sequence(first, last), piece))


def _assemble(pieces: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    # A block holds at most ``block`` tokens, so each group is bounded.
    collected = pieces.groupBy(*keys, "block_id").agg(
        F.sort_array(F.collect_list(F.struct("_at", *cols))).alias("_parts")
    )
    joined = (F.flatten(F.col(f"_parts.{c}")).alias(c) for c in cols)
    return collected.select(*keys, "block_id", *joined)


def pack(
    df: DataFrame,
    order_by: str,
    ids: str = "input_ids",
    block: int = 512,
    tail: str = "drop",
    bucket: int = BUCKET,
) -> DataFrame:
    """Blocks of ``block`` ids over the whole table; ``tail`` is drop or keep."""
    if tail not in ("drop", "keep"):
        raise ValueError(f"unknown tail {tail!r}")
    filled = df.select(order_by, ids).filter(F.size(ids) > 0).withColumn("_len", F.size(ids))
    placed = prefix_sum(filled, order_by, "_len", "start", bucket)
    blocks = _assemble(_pieces(placed, ids, block, [], [ids]), [], [ids])
    return blocks.filter(F.size(ids) == block) if tail == "drop" else blocks


def pack_groups(
    df: DataFrame,
    order_by: str,
    end_id: int,
    ids: str = "input_ids",
    labels: str = "labels",
    block: int = 128,
    group: int = 1000,
) -> DataFrame:
    """Pack every ``group`` consecutive rows on their own and pad the last block.

    A group with at least one full block always gets one more, padded, block,
    even when the length is an exact multiple; a shorter group keeps its rest
    unpadded.
    """
    numbered = row_numbers(df.select(order_by, ids, labels), order_by, "_row", group)
    grouped = numbered.withColumn("group_id", whole_div(F.col("_row"), group))
    sized = grouped.withColumn("_len", F.size(ids))
    before = Window.partitionBy("group_id").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("start", F.coalesce(F.sum("_len").over(before), F.lit(0)).cast("long"))
    blocks = _assemble(
        _pieces(placed.filter(F.col("_len") > 0), ids, block, ["group_id"], [ids, labels]), ["group_id"], [ids, labels]
    )
    totals = sized.groupBy("group_id").agg(F.sum("_len").cast("long").alias("_total"))
    frame = totals.select(
        "group_id",
        "_total",
        F.explode(F.sequence(F.lit(0).cast("long"), whole_div(F.col("_total"), block))).alias("block_id"),
    ).filter(F.col("_total") > 0)
    whole = frame.join(blocks, ["group_id", "block_id"], "left")

    def padded(c: str, pad: int) -> Column:
        held = F.coalesce(F.col(c), F.array().cast("array<int>"))
        full = F.slice(F.concat(held, F.array_repeat(F.lit(pad), block)), 1, block)
        return F.when(F.col("_total") >= block, full).otherwise(held)

    return whole.select(
        "group_id", "block_id", padded(ids, end_id).alias(ids), padded(labels, IGNORED_LABEL).alias(labels)
    )
