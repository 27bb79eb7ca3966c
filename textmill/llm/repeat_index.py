"""Long repeated byte strings, found with suffix arrays kept as a logarithmic index family.

A ``width``-byte string is a window.  Windows of equal bytes have the same anchor: the seed
of ``SEED`` bytes whose hash is smallest in the window.  A document is cut into runs of
windows with a common anchor; a run's fragment is the bytes its windows cover.

1. Anchors ``(seed hash, fragment hash, document, start, windows)`` are sorted by range.
   Equal fragments are neighbours there, and all of their windows repeat.  A seed with one
   fragment has no further windows to compare.
2. Of a seed with several fragments, each distinct one is brought (as bytes) to the seed's
   shard.  There, every batch of fragments gets a suffix array of its windows; it is merge-scanned
   against the levels that exist, which finds the windows that occur in both, and levels
   of equal size are merged to one of twice the size.
3. A seed with very many distinct fragments would fill one shard.  Its windows are grouped
   by their own digests instead, first within each batch, then across batches.

Every repeated window is found: equal windows always share their anchor.  Hashes of 64 bits
select candidates; a fragment is identified by two of them and its length, a window
of a hot seed by 64 more bits; all other windows are compared byte by byte.

Defined results: null counts as an empty text; texts shorter than ``width`` keep all bytes;
matches end at a text's borders; repeated rows, null or repeated ids are separate texts;
texts of any length are read in overlapping slices; an empty table gives no rows.  Only
the named columns are read, whatever the others are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from textmill.session import cut_lineage

WIDTH = 200
SEED = 50
#: Bytes of a text read at once; windows of neighbouring slices do not overlap, their bytes do.
SLICE = 1 << 20
#: Fragments of a shard, and of a batch within it.
SHARD_FRAGMENTS = 2048
BATCH_FRAGMENTS = 256
#: A seed with more distinct fragments is grouped by window.
HOT_FRAGMENTS = 1024
#: Windows of hot seeds that one part is made for.
PART_WINDOWS = 1 << 19

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


class RollingHash:
    """Hashes of any ranges of one byte array, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray, base: int):
        terms = mixed(data.astype(np.uint64) + np.uint64(base & 0xFFFF)) * _powers(base, len(data))
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.inverse = _powers(pow(base, -1, 1 << 64), len(data) + 1)

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[begin]) * self.inverse[begin])


def _window_minimum(values: np.ndarray, length: int) -> np.ndarray:
    """Minimum of every ``length`` neighbours, by doubling."""
    span = 1
    while span * 2 <= length:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = length - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with a common anchor: seed hash, fragment hash, first window, windows."""
    n = len(data)
    starts = np.arange(n - seed + 1)
    first = RollingHash(data, _BASES[0])
    hashes = first.ranges(starts, starts + seed)
    low = np.uint64(SLICE * 2 - 1)
    best = _window_minimum((hashes & ~low) | starts.astype(np.uint64), width - seed + 1)
    place = (best & low).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.concatenate([begin, [len(place)]]))
    second = RollingHash(data, _BASES[1])
    whole = second.ranges(begin, begin + count + width - 1) + count.astype(np.uint64)
    return hashes[place[begin]].view(np.int64), whole.view(np.int64), begin, count


ANCHOR_SCHEMA = "seed bigint, whole bigint, doc bigint, start bigint, windows int"


def find_anchors(texts: DataFrame, width: int, seed: int) -> DataFrame:
    """Anchors of ``doc, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                data = np.frombuffer((text.as_py() or "").encode(), dtype=np.uint8)
                for at in range(0, max(len(data) - width + 1, 0), SLICE - width + 1):
                    part = data[at : at + SLICE]
                    if len(part) < width:
                        break
                    s, w, begin, count = anchors(part, width, seed)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "seed": s,
                            "whole": w,
                            "doc": np.full(len(s), doc, dtype=np.int64),
                            "start": begin + at,
                            "windows": count.astype(np.int32),
                        }
                    )

    return texts.mapInArrow(_gathered(run), ANCHOR_SCHEMA)


def _gathered(run, rows: int = 1 << 16):
    """The same batches, joined to larger ones."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in run(batches):
            held.append(batch)
            size += len(batch)
            if size >= rows:
                yield pa.concat_batches(held)
                held, size = [], 0
        if held:
            yield pa.concat_batches(held)

    return joined


CLASS_SCHEMA = ANCHOR_SCHEMA + ", repeated boolean, candidate boolean"


def classify(sorted_anchors: DataFrame) -> DataFrame:
    """Which fragments occur again, and which must be compared with others of their seed.

    Partitions are sorted by seed, fragment, document and start.  A seed at the border of a
    partition may go on in the next one: its fragments are compared in any case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All batches of one partition: a range of bounded size by construction of the sort.
        held: list[pa.RecordBatch] = []
        border: int | None = None
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            seeds = np.asarray(batch.column("seed"))
            if border is None:
                border = int(seeds[0])
            changes = np.flatnonzero(seeds[1:] != seeds[:-1])
            if len(changes) == 0:
                continue
            # Keep the last seed, which may go on in the next batch.
            cut = int(changes[-1]) + 1
            yield _flags(pa.concat_batches([*held[:-1], batch.slice(0, cut)]), {border})
            held = [batch.slice(cut)]
        if held:
            last = int(held[-1].column("seed")[len(held[-1]) - 1].as_py())
            yield _flags(pa.concat_batches(held), {border, last})

    return sorted_anchors.mapInArrow(run, CLASS_SCHEMA)


def _flags(batch: pa.RecordBatch, borders: set[int | None]) -> pa.RecordBatch:
    seed, whole = np.asarray(batch.column("seed")), np.asarray(batch.column("whole"))
    new_seed = np.concatenate([[True], seed[1:] != seed[:-1]])
    new_whole = new_seed | np.concatenate([[True], whole[1:] != whole[:-1]])
    group = np.cumsum(new_whole) - 1
    repeated = np.bincount(group)[group] > 1
    family = np.cumsum(new_seed) - 1
    fragments = np.bincount(family[new_whole])
    several = fragments[family] > 1
    for border in borders:
        several |= seed == border
    out = {name: batch.column(name) for name in batch.schema.names}
    out["repeated"], out["candidate"] = pa.array(repeated), pa.array(new_whole & several)
    keep = pa.array(repeated | (new_whole & several))
    return pa.RecordBatch.from_pydict(out).filter(keep)


def _windows(data: np.ndarray, begin: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all fragments as fixed-width strings, and their places in ``data``."""
    owner = np.repeat(np.arange(len(begin)), count)
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    place = begin[owner] + within
    return place, np.lib.stride_tricks.sliding_window_view(data, width)[place].view(f"S{width}").ravel()


class Level:
    """A suffix array: windows in byte order, and the entries they stand for."""

    def __init__(self, keys: np.ndarray, entries: np.ndarray):
        self.keys, self.entries = keys, entries

    @classmethod
    def of(cls, keys: np.ndarray, entries: np.ndarray) -> Level:
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], entries[order])

    def repeats_within(self, found: np.ndarray) -> None:
        same = self.keys[1:] == self.keys[:-1]
        found[self.entries[1:][same]] = True
        found[self.entries[:-1][same]] = True

    def scan(self, other: Level, found: np.ndarray) -> None:
        """Mark windows that occur in both levels; both sides are in order."""
        for a, b in ((self, other), (other, self)):
            at = np.searchsorted(b.keys, a.keys)
            at[at == len(b.keys)] = 0
            found[a.entries[b.keys[at] == a.keys]] = True

    def merged(self, other: Level) -> Level:
        keys, entries = np.concatenate([self.keys, other.keys]), np.concatenate([self.entries, other.entries])
        return Level.of(keys, entries)


class IndexFamily:
    """Levels of one, two, four, ... batches; a new batch is scanned against all of them."""

    def __init__(self, windows: int):
        self.levels: list[Level | None] = []
        self.found = np.zeros(windows, dtype=bool)

    def add(self, keys: np.ndarray, entries: np.ndarray) -> None:
        fresh = Level.of(keys, entries)
        fresh.repeats_within(self.found)
        for level in self.levels:
            if level is not None:
                level.scan(fresh, self.found)
        for i, level in enumerate(self.levels):
            if level is None:
                self.levels[i] = fresh
                return
            fresh, self.levels[i] = level.merged(fresh), None
        self.levels.append(fresh)


SPAN_SCHEMA = "doc bigint, start bigint, end bigint"


def _spans(doc: np.ndarray, start: np.ndarray, count: np.ndarray, found: np.ndarray, width: int) -> pd.DataFrame:
    """Covered byte ranges of the windows found, consecutive ones together."""
    owner = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
    owner, within = owner[found], within[found]
    if not len(owner):
        return pd.DataFrame({"doc": [], "start": [], "end": []}, dtype=np.int64)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(owner)]]) - 1
    who = owner[begin]
    return pd.DataFrame({"doc": doc[who], "start": start[who] + within[begin], "end": start[who] + within[end] + width})


def compare_shards(fragments: DataFrame, shards: int, width: int) -> DataFrame:
    """Repeated windows among the fragments of each shard."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Batches follow the seeds' fragments in any order; seeds need not stay together.
        data = np.frombuffer(b"".join(rows["fragment"]), dtype=np.uint8)
        lengths = rows["fragment"].str.len().to_numpy(dtype=np.int64)
        begin, count = np.cumsum(lengths) - lengths, rows["windows"].to_numpy(dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(count)])
        family = IndexFamily(int(offsets[-1]))
        for at in range(0, len(rows), BATCH_FRAGMENTS):
            part = slice(at, at + BATCH_FRAGMENTS)
            _, keys = _windows(data, begin[part], count[part], width)
            family.add(keys, np.arange(offsets[at], offsets[at] + len(keys)))
        return _spans(rows["doc"].to_numpy(), rows["start"].to_numpy(), count, family.found, width)

    dealt = fragments.withColumn("shard", F.pmod(F.xxhash64("seed"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(run, SPAN_SCHEMA)


def _sorted_classes(found: DataFrame) -> DataFrame:
    order = ["seed", "whole", "doc", "start"]
    return classify(found.repartitionByRange(*order).sortWithinPartitions(*order))


def _covered(anchors_: DataFrame, width: int) -> DataFrame:
    return anchors_.select("doc", "start", (F.col("start") + F.col("windows") + (width - 1)).alias("end"))


PART_SCHEMA = SPAN_SCHEMA + ", part int, rows binary"
_ENTRY = np.dtype([("seed", "<i8"), ("digest", "<i8"), ("doc", "<i8"), ("start", "<i8"), ("known", "?")])


def _fragment_windows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the fragments, and the windows of each."""
    parts = []
    for seed, doc, start, windows, fragment in zip(*(batch.column(c).to_pylist() for c in ("seed", "doc", "start", "windows", "fragment"))):
        begin = np.arange(windows)
        rows = np.zeros(windows, dtype=_ENTRY)
        rows["seed"], rows["doc"], rows["start"] = seed, doc, begin + start
        rows["digest"] = RollingHash(np.frombuffer(fragment, dtype=np.uint8), _BASES[1]).ranges(begin, begin + width).view(np.int64)
        parts.append(rows)
    return np.concatenate(parts), np.array([len(p) for p in parts])


def _groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order with equal windows together, and where each group begins in it."""
    order = np.lexsort((rows["digest"], rows["seed"]))
    seed, digest = rows["seed"][order], rows["digest"][order]
    new = np.concatenate([[True], (seed[1:] != seed[:-1]) | (digest[1:] != digest[:-1])])
    return order, np.flatnonzero(new)


def hot_parts(fragments: DataFrame, parts: int, width: int) -> DataFrame:
    """Hot seeds' windows grouped within each batch: spans of those repeated there, and one entry a
    distinct window, packed by the part its digest belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows, count = _fragment_windows(batch, width)
            order, begin = _groups(rows)
            size = np.diff(np.concatenate([begin, [len(rows)]]))
            found = np.zeros(len(rows), dtype=bool)
            found[order] = np.repeat(size > 1, size)
            first = np.cumsum(count) - count
            spans = _spans(rows["doc"][first], rows["start"][first], count, found, width)
            one = rows[order[begin]]
            one["known"] = size > 1
            part = mixed(one["digest"].view(np.uint64)) % np.uint64(parts)
            one = one[np.argsort(part, kind="stable")]
            ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))
            packed = [(i, one[a:b].tobytes()) for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
            n, m = len(spans), len(packed)
            yield pa.RecordBatch.from_pydict(
                {
                    **{c: pa.array([*spans[c], *[None] * m], pa.int64()) for c in ("doc", "start", "end")},
                    "part": pa.array([None] * n + [i for i, _ in packed], pa.int32()),
                    "rows": pa.array([None] * n + [r for _, r in packed], pa.binary()),
                }
            )

    return fragments.mapInArrow(run, PART_SCHEMA)


def _repeated_hot(fragments: DataFrame, parts: int, width: int) -> DataFrame:
    """Spans of hot seeds' repeated windows.  A window shared by many documents leaves each
    batch once, so no part is filled by it."""

    def run(packed: pd.DataFrame) -> pd.DataFrame:
        rows = np.concatenate([np.frombuffer(r, dtype=_ENTRY) for r in packed["rows"]])
        order, begin = _groups(rows)
        size = np.diff(np.concatenate([begin, [len(rows)]]))
        again = order[np.repeat(size > 1, size)]
        new = rows[again][~rows["known"][again]]
        return pd.DataFrame({"doc": new["doc"], "start": new["start"], "end": new["start"] + width})

    both = cut_lineage(hot_parts(fragments, parts, width), "windows")
    across = both.filter("part IS NOT NULL").select("part", "rows").groupBy("part").applyInPandas(run, SPAN_SCHEMA)
    return both.filter("part IS NULL").select("doc", "start", "end").unionByName(across)


def _cut_fragments(candidates: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The bytes of each candidate; a document's text is met once."""
    wanted = candidates.groupBy("doc").agg(F.collect_list(F.struct("seed", "start", "windows")).alias("wanted"))
    met = texts.join(wanted, "doc").select("doc", F.encode("text", "UTF-8").alias("data"), F.explode("wanted").alias("w"))
    # Positions in SQL count from one; on binary data they count bytes.
    cut = F.substring(F.col("data"), (F.col("w.start") + 1).cast("int"), F.col("w.windows") + (width - 1))
    return met.select("doc", "w.seed", "w.start", "w.windows", cut.alias("fragment"))


def repeated_spans(texts: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``doc, start, end`` ranges of bytes in repeated windows; ranges may overlap.

    ``texts`` has ``doc`` (unique, the same whenever it is computed) and ``text``.
    """
    if not 0 < seed <= width:
        raise ValueError("the seed must fit into a window")
    # Stored, because the sort reads its rows twice: once for the borders of its ranges.
    anchored = cut_lineage(find_anchors(texts, width, seed), "anchors")
    classes = cut_lineage(_sorted_classes(anchored), "classes")
    again = _covered(classes.filter("repeated"), width)
    candidates = classes.filter("candidate").select("seed", "doc", "start", "windows")
    counts = candidates.groupBy("seed").agg(F.count("*").alias("n"))
    counted = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    # Hot seeds are few by this bound: ten thousand longs at most.
    bound = max(HOT_FRAGMENTS, counted["total"] // 10_000)
    fragments = _cut_fragments(candidates, texts, width)
    shards = max(1, -(-counted["total"] // SHARD_FRAGMENTS))
    if counted["most"] <= bound:
        return again.unionByName(compare_shards(fragments, shards, width))
    fragments = cut_lineage(fragments, "fragments")
    parts = max(1, counted["total"] * (width - seed) // PART_WINDOWS)
    hot = F.broadcast(cut_lineage(counts.filter(F.col("n") > bound).select("seed"), "hot-seeds"))
    cold = compare_shards(fragments.join(hot, "seed", "left_anti"), shards, width)
    return again.unionByName(cold).unionByName(_repeated_hot(fragments.join(hot, "seed", "left_semi"), parts, width))


KEPT_SCHEMA = "n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "spans", "kept")}
        for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "ends"))):
            data = (text or "").encode()
            spans: list[list[int]] = []
            for a, b in sorted(zip(starts or [], ends or [])):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            borders = [0, *(x for span in spans for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2]))
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(kept))
            out["spans"].append([{"start": a, "end": b} for a, b in spans])
            out["kept"].append(kept)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_pydict(
            {
                "key": batch.column("key"),
                "n_bytes": pa.array(out["n_bytes"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "spans": pa.array(out["spans"], span),
                "kept": pa.array(out["kept"], pa.binary()),
            }
        )


def drop_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """One row for each input row: the key, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed
    byte ranges) and ``kept``, the remaining bytes.

    ``kept`` is binary: a span may begin or end within a character.
    """
    texts = df.select(F.monotonically_increasing_id().alias("doc"), F.col(key).alias("key"), F.col(text).alias("text"))
    spans = repeated_spans(texts.select("doc", "text"), width, seed)
    of_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("covered"))
    met = texts.join(of_doc, "doc", "left").select("key", "text", F.col("covered.start").alias("starts"), F.col("covered.end").alias("ends"))
    schema = StructType([StructField("key", df.schema[key].dataType), *StructType.fromDDL(KEPT_SCHEMA)])
    return met.mapInArrow(_without, schema).withColumnRenamed("key", key)
