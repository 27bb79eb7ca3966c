"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``POINTS`` points of a 64-bit ring.  A key belongs to the next point
clockwise from its hash.  A shard takes keys of its own arcs until it is full; keys that
overflow go on clockwise, point by point, to the first shard with room.  With ``slack = 0``
the loads differ by one row at most.

Keys of one arc are alike, so the walk only needs the arcs' counts: it runs over at most
shards x points numbers on the driver, whatever the number of rows, and yields for every
arc which ranks go to which shard.  The rows' ranks come from buckets of the hash: their
number grows with the rows, each is ranked by itself and shifted by the counts before it.
Rows that are equal in all columns used are counted together first, so repeated rows
do not pile up in one bucket.

Null keys and null texts are keys and (empty) texts like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import cut_lineage

POINTS = 128
ROWS_PER_BUCKET = 20_000
_SPACE = 1 << 63


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """Positions of all virtual nodes with their shards, in clockwise order."""
    return sorted(
        (int.from_bytes(hashlib.sha256(f"{s}/{p}".encode()).digest()[:8], "big") >> 1, s)
        for s in range(shards)
        for p in range(points)
    )


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows a shard may take; without slack the sum is the number of rows."""
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-int(-(1 + slack) * rows // shards)] * shards


@dataclass
class Segment:
    """Ranks ``low`` to ``high`` - 1 of an arc go to ``shard`` and begin there at slot ``slot``."""

    arc: int
    low: int
    high: int
    shard: int
    slot: int


def assign_arcs(counts: list[int], owners: list[int], room: list[int]) -> list[Segment]:
    """Place the keys of all arcs; ``room`` is what each shard may take."""
    room, taken, out, rest = list(room), [0] * len(room), [], []

    def take(arc: int, low: int, n: int, shard: int) -> None:
        out.append(Segment(arc, low, low + n, shard, taken[shard]))
        taken[shard] += n
        room[shard] -= n

    for arc, n in enumerate(counts):
        own = min(n, room[owners[arc]])
        if own:
            take(arc, 0, own, owners[arc])
        if own < n:
            rest.append((arc, own))
    for arc, low in rest:
        at = arc
        while low < counts[arc]:
            at = (at + 1) % len(counts)
            n = min(counts[arc] - low, room[owners[at]])
            if n:
                take(arc, low, n, owners[at])
                low += n
    return out


def _position(columns: list[Column]) -> Column:
    """Place on the ring, below 2^63."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def assign(
    df: DataFrame,
    columns: list[str],
    shards: int,
    points: int = POINTS,
    slack: float = 0.0,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``columns``, ``shard``, ``slot`` (from 0 in each shard) and ``home_shard`` of every row.

    ``columns`` identify a row and give its place on the ring; other columns are not carried.
    """
    nodes = ring(shards, points)
    places, owners = np.array([p for p, _ in nodes]), [s for _, s in nodes]
    named = [F.col(f"`{c}`") for c in columns]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies")).withColumn("_at", _position(named))

    def find_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A key belongs to the next point clockwise; after the last one comes the first.
            arcs = np.searchsorted(places, batch.column("_at").to_numpy()) % len(places)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(arcs)], names=[*batch.schema.names, "_arc"])

    schema = T.StructType([*counted.schema.fields, T.StructField("_arc", T.LongType())])
    stored = cut_lineage(counted.mapInArrow(find_arc, schema), "ring-keys")
    distinct = stored.count()
    width = min(_SPACE - 1, -(-_SPACE // max(1, -(-distinct // rows_per_bucket))))
    keyed = stored.withColumn("_bucket", F.floor(F.col("_at") / F.lit(width).cast("long")).cast("long"))

    # Running counts inside a cell (one arc, one bucket), then of the cells before it in the arc.
    inside = Window.partitionBy("_arc", "_bucket").orderBy("_at", *named).rowsBetween(Window.unboundedPreceding, -1)
    cells = cut_lineage(keyed.groupBy("_arc", "_bucket").agg(F.sum("_copies").alias("_n")), "ring-cells")
    before = Window.partitionBy("_arc").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("_arc", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    ranked = keyed.withColumn("_rank", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(offsets, ["_arc", "_bucket"])
    each = ranked.select(
        *named,
        "_arc",
        (F.col("_rank") + F.col("_shift")).alias("_rank"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy"),
    ).withColumn("_rank", F.col("_rank") + F.col("_copy"))

    counts = [0] * len(nodes)
    for row in cells.groupBy("_arc").agg(F.sum("_n").alias("n")).collect():  # at most one row a point
        counts[row["_arc"]] = row["n"]
    segments = sorted(assign_arcs(counts, owners, capacities(sum(counts), shards, slack)), key=lambda s: (s.arc, s.low))
    arcs, lows, targets, slots = (np.array([getattr(s, f) for s in segments], dtype=np.int64) for f in ("arc", "low", "shard", "slot"))
    homes = np.array(owners)
    out = T.StructType(
        [
            *[df.schema[c] for c in columns],
            T.StructField("shard", T.IntegerType()),
            T.StructField("slot", T.LongType()),
            T.StructField("home_shard", T.IntegerType()),
        ]
    )
    # Ranks are below 2^40, so arc and rank fit one number.
    keys = arcs * (1 << 40) + lows

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arc, rank = batch.column("_arc").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, arc * (1 << 40) + rank, side="right") - 1
            made = [targets[at].astype(np.int32), slots[at] + rank - lows[at], homes[arc].astype(np.int32)]
            held = [batch.column(c) for c in columns] + [pa.array(x) for x in made]
            yield pa.RecordBatch.from_arrays(held, names=out.names)

    return each.select(*named, "_arc", "_rank").mapInArrow(place, out)
