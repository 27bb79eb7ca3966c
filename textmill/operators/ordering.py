"""Distributed running sums, row numbers, splits, shuffles and shards."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import cut_lineage

BUCKET = 1024


def whole_div(x: Column, n: int) -> Column:
    """Floor division of integers, exact for every 64-bit value."""
    divisor = F.lit(n).cast("long")
    return F.call_function("div", x - F.pmod(x, divisor), divisor)


def _key_range(df: DataFrame, key: str, bucket: int) -> tuple[int, int]:
    """Lowest key and how many bucket levels the key range needs."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if high is None:
        return 0, 1
    levels, covered = 1, bucket
    while covered < high - low + 1:
        levels, covered = levels + 1, covered * bucket
    return low, levels


def prefix_sum(df: DataFrame, key: str, value: str, out: str = "start", bucket: int = BUCKET) -> DataFrame:
    """Exclusive running sum of ``value`` in ``key`` order (unique integer keys).

    Keys are cut into ranges of ``bucket``; each level sums its ranges and passes
    the range offsets down, so no window ever holds more than ``bucket`` rows.
    Rows are shuffled once by range; offsets are joined on the same range.
    """
    low, levels = _key_range(df, key, bucket)
    return _prefix_sum(df, key, value, out, bucket, low, levels)


def _prefix_sum(df: DataFrame, key: str, value: str, out: str, bucket: int, low: int, levels: int) -> DataFrame:
    part, shift = f"_range{levels}", f"_shift{levels}"
    ranged = df.withColumn(part, whole_div(F.col(key) - F.lit(low).cast("long"), bucket))
    inside = Window.partitionBy(part).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    if levels == 1:
        # A single range is left.
        return local.drop(part)
    totals = ranged.groupBy(part).agg(F.sum(value).cast("long").alias("_sum"))
    # The next level uses the totals twice; stored, they are computed once.
    stored = cut_lineage(totals, "range-totals")
    offsets = _prefix_sum(stored, part, "_sum", shift, bucket, 0, levels - 1).select(part, shift)
    return local.join(offsets, part).withColumn(out, (F.col(out) + F.col(shift)).cast("long")).drop(part, shift)


def row_numbers(df: DataFrame, key: str, out: str = "row_no", bucket: int = BUCKET) -> DataFrame:
    """Dense 0-based row numbers in key order."""
    return prefix_sum(df.withColumn("_one", F.lit(1)), key, "_one", out, bucket).drop("_one")


def hash_fraction(key: Column, seed: int = 0) -> Column:
    """Repeatable number in [0, 1) from a key."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def split_rows(df: DataFrame, key: str, test: float = 0.1, seed: int = 0) -> DataFrame:
    """Adds ``split`` = train/test, the same under any partitioning."""
    held_out = hash_fraction(F.col(key), seed) < test
    return df.withColumn("split", F.when(held_out, "test").otherwise("train"))


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Repeatable order per seed (a range-partitioned sort)."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))), key)


def shard_rows(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Adds ``shard``, a hash of the key."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.withColumn("shard", (digest % shards).cast("int"))


def shuffled_positions(df: DataFrame, key: str, seed: int, buckets: int = 4096) -> DataFrame:
    """``place`` 0..n-1 of every row in a seeded order, without a global sort.

    Hash digests are uniform, so their leading digits cut the rows into even
    buckets; places inside a bucket are ranked there and shifted by the sizes of
    the buckets before it (a table of at most ``buckets`` rows).
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    hashed = df.withColumn("_digest", digest).withColumn(
        "_bucket", F.floor(F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long") * buckets / 4294967296).cast("int")
    )
    inside = Window.partitionBy("_bucket").orderBy("_digest", key)
    ranked = hashed.withColumn("_place", F.row_number().over(inside) - 1)
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return ranked.join(offsets, "_bucket").select(
        (F.col("_place") + F.col("_offset")).cast("long").alias("place"), *df.columns
    )


#: Rounds of a permutation, and the prime its bits are computed under.
ROUNDS = 48
PRIME = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int, int]]:
    """Four numbers a round: the partner's sum (before it is reduced to the table size) and three factors."""
    digests = (hashlib.sha256(f"{seed}#{i}".encode()).digest() for i in range(rounds))
    parts = ([int.from_bytes(d[k : k + 7], "big") for k in (0, 7, 14, 21)] for d in digests)
    return [(p[0], *(1 + x % (PRIME - 1) for x in p[1:])) for p in parts]


def permuted(position: Column, n: int, seed: int, rounds: int = ROUNDS) -> Column:
    """Place of a position 0..n-1 in a seeded order: computed, so nothing is sorted or shuffled.

    A swap-or-not network.  In each round a position and the one that adds up with it to the
    round's key (modulo n) change places or stay, by one bit of the larger of the two.  Both see
    the same bit, so every round, and the whole, maps 0..n-1 onto itself for any n.
    """
    if n < 1:
        return position.cast("long")
    size, prime = F.lit(n).cast("long"), F.lit(PRIME).cast("long")
    keys = [(k % n, a, b, c) for k, a, b, c in round_keys(seed, rounds)]
    columns = [F.array(*[F.lit(v).cast("long") for v in values]) for values in zip(*keys)]

    def step(x: Column, key: Column) -> Column:
        partner = F.pmod(key["0"] - x, size)
        # Every factor is below 2**31, so no product leaves 64 bits.
        mixed = (F.pmod(F.greatest(x, partner), prime) * key["1"] + key["2"]) % prime
        mixed = (mixed * mixed + key["3"]) % prime
        return F.when(mixed % 2 == 1, partner).otherwise(x)

    return F.aggregate(F.arrays_zip(*[c.alias(str(i)) for i, c in enumerate(columns)]), position.cast("long"), step)


def permuted_positions(df: DataFrame, key: str, seed: int, out: str = "place") -> DataFrame:
    """``out`` 0..n-1 of every row in a seeded order; ``key`` is a unique integer and gets dense numbers first.

    Another epoch is another seed over the same numbers: a projection.
    """
    position = "_".join(["position", *df.columns])
    numbered = row_numbers(df, key, position)
    return numbered.withColumn(out, permuted(F.col(position), df.count(), seed)).drop(position)
