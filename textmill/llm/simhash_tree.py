"""SimHash near-duplicates with BK-trees.

Fingerprints: words are runs without blanks, shingles are ``width`` words (repeats count), each
hashed with XXH64 (seed 42); a bit is set if over half of the hashes have it.  Fewer words
than ``width`` make one shingle; no word makes fingerprint zero.  Null counts as empty.

Search: the 64 bits are cut into five bands.  Two fingerprints that differ in at most three
bits agree in two bands at least, so for each of the ten pairs of bands all fingerprints
meet, once, in the shard of their two band values.  Each shard is a BK-tree (a child's key
is its distance to the parent) and a search follows only edges within the radius of the
distance to the node.  The trees are built where the shard's rows arrive: their number
grows with the data, so shipping them all to every task would not be bounded.

A shard of more than ``SHARD_ROWS`` fingerprints is cut into several trees; each
fingerprint then also searches the trees of the later blocks.  Tasks emit at most one link a
fingerprint and tree, never all pairs, and components are joined by alternating star steps.
Equal fingerprints are one node, whatever the number of their documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import cut_lineage

WIDTH = 3
RADIUS = 3
SEED = 42
SHARD_ROWS = 4096
# Five bands of 64 bits: (lowest bit, bits).
BANDS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
_HASHES_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 21


def fingerprint(raw: bytes, width: int = WIDTH) -> int:
    """SimHash of one text given in UTF-8."""
    words = raw.lower().split()  # on bytes both are ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends.tolist()
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, n, _HASHES_AT_ONCE):
        high = min(n, low + _HASHES_AT_ONCE)
        spans = zip(starts[low:high], ends[low + width - 1 :] if n > 1 or len(words) == width else [len(joined)])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``key`` and ``bits``: the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x.as_py(), width) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=[key, "bits"])

    raw = df.select(F.col(key), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("_raw"))
    return raw.mapInArrow(run, T.StructType([df.schema[key], T.StructField("bits", T.LongType())]))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees of several shards, built and searched level by level.

    ``group`` (ascending) tells the shards apart; the first fingerprint of a shard is its
    root.  Fingerprints of one shard are distinct.
    """

    def __init__(self, group: np.ndarray, prints: np.ndarray) -> None:
        self.prints = prints
        self.roots = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, np.int64)
        self.groups = group[self.roots]
        slots, nodes = [], []
        at = np.repeat(self.roots, np.diff(np.append(self.roots, len(group))))
        waiting = np.setdiff1d(np.arange(len(group)), self.roots, assume_unique=True)
        at = at[waiting]
        while len(waiting):
            slot = at * 65 + distance(prints[waiting], prints[at])
            order = np.argsort(slot, kind="stable")
            slot, waiting = slot[order], waiting[order]
            first = np.concatenate([[True], slot[1:] != slot[:-1]])
            child = waiting[first]
            slots.append(slot[first])
            nodes.append(child)
            at = np.repeat(child, np.diff(np.append(np.flatnonzero(first), len(slot))))[~first]
            waiting = waiting[~first]
        slots = np.concatenate(slots) if slots else np.empty(0, np.int64)
        nodes = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
        order = np.argsort(slots, kind="stable")
        self.slots, self.nodes = slots[order], nodes[order]

    def search(self, group: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) of one shard within the radius."""
        place = np.searchsorted(self.groups, group)
        known = (place < len(self.groups)) & (self.groups[np.minimum(place, len(self.groups) - 1)] == group)
        query = np.flatnonzero(known)
        node = self.roots[place[query]]
        found_q, found_n = [], []
        while len(query):
            d = distance(prints[query], self.prints[node])
            near = d <= radius
            found_q.append(query[near])
            found_n.append(node[near])
            low = np.searchsorted(self.slots, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.slots, node * 65 + np.minimum(d + radius, 64), side="right")
            n = high - low
            query = np.repeat(query, n)
            node = self.nodes[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_n)


def join_sets(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of ``n`` items under the links ``a - b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            return label


def _shard_links(group: np.ndarray, prints: np.ndarray, asks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of complete shards: every fingerprint with another one of its component here."""
    tree = np.flatnonzero(~asks)
    if not len(tree):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    forest = Forest(group[tree], prints[tree])
    sizes = np.bincount(np.searchsorted(forest.groups, group[tree]), minlength=len(forest.groups))
    # A search visits the nodes of its tree at most; queries go in slices of bounded work.
    place = np.minimum(np.searchsorted(forest.groups, group), len(forest.groups) - 1)
    work = np.cumsum(sizes[place])
    left, right, begin = [], [], 0
    while begin < len(group):
        done = work[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(work, done + _PAIRS_AT_ONCE, side="right")))
        q, n = forest.search(group[begin:end], prints[begin:end], radius)
        q, n = q + begin, tree[n]
        other = q != n
        if other.any():
            # A forest of links is enough: pairs inside one set add nothing.
            label = join_sets(len(group), q[other], n[other])
            moved = np.flatnonzero(label != np.arange(len(group)))
            left.append(moved)
            right.append(label[moved])
        begin = end
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return prints[np.concatenate(left)], prints[np.concatenate(right)]


def _link_shards(radius: int, at_once: int):
    """Rows sorted by shard, tree rows first; shards are taken together in batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(group, block, prints, asks):
        ids = np.zeros(len(group), dtype=np.int64)
        ids[1:] = np.cumsum((group[1:] != group[:-1]) | (block[1:] != block[:-1]))
        a, b = _shard_links(ids, prints.view(np.uint64), asks, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if len(held[0]) < at_once:
                continue
            group, block, _, asks = held
            whole = int(np.flatnonzero((group != group[-1]) | (block != block[-1])).max(initial=-1)) + 1
            if whole:
                yield links(*[x[:whole] for x in held])
                held = [x[whole:] for x in held]
            if asks[-1] and len(held[0]) >= 2 * at_once:
                # One shard with many queries: answer those read so far and keep the tree.
                yield links(*held)
                held = [x[~held[3]] for x in held]
        if held is not None and len(held[0]):
            yield links(*held)

    return run


def shard_keys(bits: Column) -> Column:
    """The ten shards of a fingerprint, one for each pair of bands."""
    band = [F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << n) - 1)) for low, n in BANDS]
    pairs = combinations(range(len(BANDS)), 2)
    return F.array(
        *[F.lit(k << 26).cast("long") + F.shiftleft(band[i], 13) + band[j] for k, (i, j) in enumerate(pairs)]
    )


def near_links(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``a, b`` whose components are those of all pairs of ``prints.bits`` (distinct) within the radius."""
    if radius > 3:
        raise ValueError("five bands find distances up to three")
    entries = prints.select("bits", F.explode(shard_keys(F.col("bits"))).alias("shard"))
    large = cut_lineage(
        entries.groupBy("shard").count().filter(F.col("count") > shard_rows)
        .select("shard", F.ceil(F.col("count") / shard_rows).cast("int").alias("blocks")),
        "large-shards",
    )
    kind = "a long, b long"
    plain = entries
    parts = []
    if not large.isEmpty():
        plain = entries.join(large, "shard", "left_anti")
        hot = entries.join(large, "shard").withColumn("own", F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int"))
        # Own block: tree row; later blocks: query row.
        targets = F.sequence(F.col("own"), F.col("blocks") - 1)
        dealt = hot.select("shard", "bits", "own", F.explode(targets).alias("block")).select(
            "shard", "block", "bits", (F.col("block") != F.col("own")).alias("asks")
        )
        placed = dealt.repartition("shard", "block").sortWithinPartitions("shard", "block", "asks")
        parts.append(placed.mapInArrow(_link_shards(radius, 4 * shard_rows), kind))
    placed = plain.select("shard", F.lit(0).alias("block"), "bits", F.lit(False).alias("asks"))
    placed = placed.repartition("shard").sortWithinPartitions("shard")
    links = placed.mapInArrow(_link_shards(radius, 4 * shard_rows), kind)
    for part in parts:
        links = links.unionByName(part)
    return links


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node; the root is the smallest node of its component.

    Alternating star steps: every node links its larger neighbours to its smallest one, then
    its smaller ones.  The number of links never grows.
    """
    edges = cut_lineage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        stored = cut_lineage(large, "large-star")
        smallest = stored.groupBy("a").agg(F.min("b").alias("low"))
        small = stored.join(smallest, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        edges = cut_lineage(small.filter("a <> b").distinct(), "small-star")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if seen == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``key, bits, component_id`` of every row; the component's id is its smallest key (nulls last)."""
    rows = cut_lineage(fingerprints(df, key, text, width), "fingerprints")
    nodes = cut_lineage(rows.groupBy("bits").agg(F.min(key).alias("low")), "nodes")
    roots = components(near_links(nodes.select("bits"), radius))
    member = nodes.join(roots, nodes["bits"] == roots["node"], "left").select("bits", "low", F.coalesce("root", "bits").alias("root"))
    named = cut_lineage(member, "members")
    ids = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = named.join(ids, "root").select("bits", "component_id")
    return rows.join(by_print, "bits").select(key, "bits", "component_id")
