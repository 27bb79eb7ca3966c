"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of fixed size.  Sorting all blocks and numbering the
distinct ones gives each block an integer name; equal blocks, and only those, share one.
Then adjacent names are paired and the pairs are named the same way, until every document
has one name.  Names come from comparing contents, so no two different texts can collide.

One naming pass is one range partitioning and one sort.  The range key ends with a hash of
the row, so copies of one block spread over many partitions; a block that reaches over a
partition border is named once through the table of border blocks (two or so a partition).
Each level is stored in the shared folder, and later levels hold long documents only.

Null counts as the empty text.  A row is a document: repeated ids and repeated rows are
rows of their own; of rows that are equal in all that counts, one stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import cut_lineage

BLOCK_BYTES = 4096
# A name is partition * 2^36 + place; a document's identity adds its level above bit 57.
_PLACE_BITS = 36
_LEVEL_BITS = 57


def normalised(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null counts as empty."""
    blanks = [" ", "\n", "\r", "\t", "\x0b", "\x0c"]
    return reduce(lambda x, c: F.replace(x, F.lit(c), F.lit("")), blanks, F.coalesce(text, F.lit("")))


def _name_runs(carried: list[str], schema: pa.Schema):
    """Number the distinct values of a sorted partition; border values go out as rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        place, last, last_hash, first_hash = -1, None, None, None
        border: dict[int, bytes] = {}  # distinct values of the hash read last

        def edges(values: dict[int, bytes], value_hash: int) -> pa.RecordBatch:
            n = len(values)
            columns = [pa.nulls(n, schema.field(c).type) for c in carried]
            columns += [pa.array([part] * n), pa.array(list(values)), pa.array([value_hash] * n), pa.array(list(values.values()), pa.binary())]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            values, hashes = batch.column("_value"), batch.column("_hash").to_numpy()
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
            new[0] = last is None or values[0].as_py() != last
            places = place + np.cumsum(new)
            newest = int(hashes[-1])
            if first_hash is None:
                first_hash = last_hash = int(hashes[0])
            if newest != last_hash:
                # The run read so far has ended; it matters only if it was the first one.
                if last_hash == first_hash:
                    for i in np.flatnonzero(new & (hashes == first_hash)).tolist():
                        border[int(places[i])] = values[i].as_py()
                    yield edges(border, first_hash)
                border, last_hash = {}, newest
            for i in np.flatnonzero(new & (hashes == newest)).tolist():
                border[int(places[i])] = values[i].as_py()
            place, last = int(places[-1]), values[-1].as_py()
            n = batch.num_rows
            columns = [batch.column(c) for c in carried]
            columns += [pa.array(np.full(n, part)), pa.array(places), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
        if border:
            yield edges(border, last_hash)

    return run


def name_values(df: DataFrame, value: str, spread: list[str], label: str = "names") -> DataFrame:
    """Replace the binary column ``value`` by ``name``: equal values, and only those, get one integer.

    ``spread`` names columns that tell rows apart; rows of one value are dealt out by them.
    The result is stored in the shared folder.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carried = [c for c in df.columns if c != value]
    hashed = df.withColumnRenamed(value, "_value").withColumn("_hash", F.xxhash64("_value"))
    dealt = hashed.repartitionByRange("_hash", F.xxhash64(*spread))
    ordered = dealt.sortWithinPartitions("_hash", "_value")
    fields = [
        *[T.StructField(c, df.schema[c].dataType) for c in carried],
        T.StructField("_part", T.LongType()),
        T.StructField("_place", T.LongType()),
        T.StructField("_border_hash", T.LongType()),
        T.StructField("_border", T.BinaryType()),
    ]
    schema = T.StructType(fields)
    runs = cut_lineage(ordered.mapInArrow(_name_runs(carried, to_arrow_schema(schema)), schema), label)
    rows = runs.filter(F.col("_border").isNull()).drop("_border", "_border_hash")
    own = F.shiftleft(F.col("_part"), _PLACE_BITS).bitwiseOR(F.col("_place"))
    borders = runs.filter(F.col("_border").isNotNull()).select("_part", "_place", "_border_hash", "_border", own.alias("_own"))
    first = borders.groupBy("_border_hash", "_border").agg(F.min("_own").alias("_first"))
    moved = (
        borders.join(first, ["_border_hash", "_border"])
        .filter(F.col("_own") != F.col("_first"))
        .select("_part", "_place", "_first")
    )
    # A partition has one first and one last hash, so this table is bounded by the partitions.
    named = rows.join(F.broadcast(moved), ["_part", "_place"], "left")
    return named.withColumn("name", F.coalesce("_first", own)).drop("_part", "_place", "_first")


def _word(x: Column) -> Column:
    """Eight bytes of a name."""
    return F.unhex(F.lpad(F.hex(x), 16, "0"))


def identities(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES) -> DataFrame:
    """``key``, ``n_points`` (code points of the text), ``text_sha256`` and ``identity`` of every row, with a row number ``row_id``."""
    clean = df.select(
        F.col(key).alias("key"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_points"),
        normalised(F.col(text)).alias("clean"),
    )
    raw = clean.select(
        F.monotonically_increasing_id().alias("row_id"),
        "key",
        "n_points",
        F.sha2("clean", 256).alias("sha"),
        F.encode("clean", "utf-8").alias("raw"),
    )
    n_blocks = F.greatest(F.ceil(F.length("raw") / F.lit(block)), F.lit(1)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda i: F.substring(F.col("raw"), i * block + 1, F.lit(block))
    )
    blocks = raw.withColumn("n_blocks", n_blocks).select(
        "row_id", "n_blocks", "key", "n_points", "sha", F.posexplode_outer(cut).alias("block", "value")
    )
    first = F.col("block") == 0
    # What belongs to the document travels with its first block only.
    slim = blocks.select(
        "row_id", "n_blocks", "block", "value", *[F.when(first, F.col(c)).alias(c) for c in ("key", "n_points", "sha")]
    )
    names = name_values(slim, "value", ["row_id", "block"], "block-names")
    documents = names.filter(F.col("block") == 0)
    done = documents.filter(F.col("n_blocks") == 1).select("row_id", "key", "n_points", "sha", F.col("name").alias("identity"))
    longest = documents.agg(F.max("n_blocks")).first()[0] or 1
    ends, level = [], 0
    names = names.filter(F.col("n_blocks") > 1).select("row_id", "n_blocks", "block", "name")
    while longest > 1:
        longest, level = (longest + 1) // 2, level + 1
        pairs = (
            names.groupBy("row_id", F.shiftright("block", 1).alias("half"))
            .agg(
                F.max("n_blocks").alias("n"),
                F.max(F.when(F.col("block") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("block") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
            .select(
                "row_id",
                F.shiftright(F.col("n") + 1, 1).alias("n_blocks"),
                F.col("half").alias("block"),
                F.concat(_word(F.col("left")), _word(F.col("right"))).alias("value"),
            )
        )
        named = name_values(pairs, "value", ["row_id", "block"], "pair-names")
        ends.append(
            named.filter(F.col("n_blocks") == 1).select(
                "row_id", F.col("name").bitwiseOR(F.lit(level << _LEVEL_BITS).cast("long")).alias("identity")
            )
        )
        names = named.filter(F.col("n_blocks") > 1)
    if ends:
        long_ones = documents.filter(F.col("n_blocks") > 1).select("row_id", "key", "n_points", "sha")
        done = done.unionByName(long_ones.join(reduce(DataFrame.unionByName, ends), "row_id"))
    return done.select("row_id", F.col("key").alias(key), "n_points", F.col("sha").alias("text_sha256"), "identity")


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``key, keep_id, group_size, kept, text_sha256, n_points``.

    Of equal texts the row with the most code points stays, then the smallest key (null last).
    """
    rows = cut_lineage(identities(df, key, text, block), "identities")
    order = F.struct((-F.col("n_points")).alias("a"), F.col(key).isNull().alias("b"), F.col(key).alias("c"), F.col("row_id").alias("d"))
    groups = rows.groupBy("identity").agg(F.count("*").alias("group_size"), F.min(order).alias("_best"))
    repeated = groups.filter(F.col("group_size") > 1)
    joined = rows.join(repeated, "identity", "left")
    return joined.select(
        key,
        F.when(F.col("_best").isNull(), F.col(key)).otherwise(F.col("_best.c")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_best.d") == F.col("row_id"), F.lit(True)).alias("kept"),
        "text_sha256",
        "n_points",
    )


def drop_exact(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    groups = exact_groups(df, key, text).filter("kept")
    marks = cut_lineage(groups.select(F.col(key).alias("_key"), F.col("text_sha256").alias("_sha"), F.col("n_points").alias("_points")), "kept")
    tagged = df.withColumns(
        {
            "_key": F.col(key),
            "_sha": F.sha2(normalised(F.col(text)), 256),
            "_points": F.coalesce(F.length(text), F.lit(0)).cast("long"),
        }
    )
    same = [tagged[c].eqNullSafe(marks[c]) for c in ("_key", "_sha", "_points")]
    found = tagged.join(marks, reduce(lambda a, b: a & b, same), "left_semi")
    # Rows that repeat a kept row in key and text pass the join as well.
    rows = found.groupBy("_key", "_sha", "_points").count().filter("count > 1").select("_key", "_sha", "_points")
    again = cut_lineage(rows, "repeated")
    if again.isEmpty():
        return found.select(*[F.col(f"`{c}`") for c in df.columns])
    same = [found[c].eqNullSafe(again[c]) for c in ("_key", "_sha", "_points")]
    met = reduce(lambda a, b: a & b, same)
    single = found.join(again, met, "left_anti")
    one = found.join(again, met, "left_semi").dropDuplicates(["_key", "_sha", "_points"])
    return single.unionByName(one).select(*[F.col(f"`{c}`") for c in df.columns])
