"""Phrases whose words occur together more often than apart, counted in FM-indexes of shards.

A shard holds about ``SHARD_WORDS`` words of one language as word numbers, with a border
between pieces.  Its forward and its backward Burrows-Wheeler transform, sorted to the depth
needed, are extended interval by interval: each step reads the words to the left (forward
index) or to the right (backward index) of every interval at once, and gives the intervals and
counts of all phrases one word longer.  Counts are summed across shards.

Most phrases are rare, so their texts are not exchanged.  Each shard first sends the counts by
``HASH_BITS`` bits of a phrase's hash, packed; only phrases whose hash reaches the least count in all
shards together are sent as texts (in a list for each range of hashes) and summed.  A sum over a hash is no smaller than that of any phrase
under it, so none is lost, and phrases that share a hash are told apart by their texts.

Depth grows by one a round.  A phrase can reach the least count only if the phrases one word
shorter that it holds do, so a round goes on with the places where those that were sent begin, and its
shards shrink.

Defined results: null counts as an empty text and a null language as ``und``; repeated rows
count again; texts of any length are cut into shards between pieces, so no phrase is lost; an
empty table gives no rows; only the named columns are read, whatever others are called.  Equal
scores rank by count, then by the phrase's bytes.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.llm.flat import FACTOR, mixed, word_hashes
from textmill.session import cut_lineage, drop_stored, scratch_path

# --- fixed values -----------------------------------------------------------
LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
UNKNOWN_LANGUAGE = "und"
PIECE_BORDERS = b".,;:!?\n\x0b\x0c\r"
WORD_BORDERS = b" \t"
# ----------------------------------------------------------------------------

SHARD_WORDS = 1 << 22
#: Bytes of text held for all languages before every shard is closed.
HELD_BYTES = 1 << 26
#: Bits of a phrase's hash that rare phrases are recognised by (32 at most).
HASH_BITS = 32
#: Words of all shards together for each range of hashes that is summed at a time.
PART_WORDS = 1 << 21
#: Phrases hashed at a time.
HASHED_PHRASES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(WORD_BORDERS)] = 1
_KIND[list(PIECE_BORDERS)] = 2


def split_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Word numbers from one with 0 between pieces and at both ends, and the words (the first stands for 0)."""
    data = _LOWER[np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8)]
    kind = _KIND[data]
    inside = kind == 0
    begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    letters = pa.py_buffer(data[inside].tobytes())
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), letters])
    coded = words.dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
    numbers = np.asarray(coded.indices, dtype=np.int32) + 1
    new = np.concatenate([[True], piece[1:] != piece[:-1]]) if len(piece) else np.zeros(0, dtype=bool)
    places = np.arange(len(numbers)) + np.cumsum(new)
    sequence = np.zeros(len(numbers) + int(new.sum()) + 1, dtype=np.int32)
    sequence[places] = numbers
    return sequence, pa.concat_arrays([pa.array([""], pa.large_string()), coded.dictionary.cast(pa.large_string())])


class Index:
    """Burrows-Wheeler transform of a sequence whose rotations are sorted by their first ``depth`` symbols."""

    def __init__(self, sequence: np.ndarray, symbols: int, depth: int):
        self.order = _sorted_places(sequence, depth)
        self.before = sequence[self.order - 1]
        counts = np.bincount(sequence, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self._stride = len(sequence) + 1
        # Places of each symbol in the transform, one sorted list after the other.
        self._places = np.sort(self.before.astype(np.int64) * self._stride + np.arange(len(sequence)))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of the symbols in the transform before the places."""
        return np.searchsorted(self._places, symbol * self._stride + place) - self.first[symbol]


def _sorted_places(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Start places in order of their first ``depth`` symbols (places past the end hold 0)."""

    def shifted(values: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([values[by:], np.zeros(min(by, len(values)), dtype=values.dtype)])

    names, known = sequence.astype(np.int64), 1
    while known * 2 < depth:
        pair = names * (int(names.max(initial=0)) + 1) + shifted(names, known)
        names, known = np.unique(pair, return_inverse=True)[1], known * 2
    if known < depth:
        names = names * (int(names.max(initial=0)) + 1) + shifted(names, depth - known)
    return np.argsort(names, kind="stable")


@dataclass
class Intervals:
    """Phrases of one length: symbols, and their intervals in both indexes."""

    symbols: np.ndarray
    low: np.ndarray
    back_low: np.ndarray
    count: np.ndarray


class BothWays:
    """Forward and backward index of one shard."""

    def __init__(self, sequence: np.ndarray, symbols: int, depth: int):
        self.symbols = symbols
        self.forward = Index(sequence, symbols, depth)
        self.backward = Index(sequence[::-1], symbols, depth) if depth > 2 else None

    def words(self) -> Intervals:
        each = np.arange(1, self.symbols)
        low = self.forward.first[each]
        count = self.forward.first[each + 1] - low
        used = count > 0
        return Intervals(each[used, None], low[used], low[used], count[used])

    def extend(self, known: Intervals, left: bool) -> Intervals:
        """All phrases one word longer to one side, with their counts."""
        index = self.forward if left else self.backward
        low, other = (known.low, known.back_low) if left else (known.back_low, known.low)
        owner = np.repeat(np.arange(len(low)), known.count)
        rows = np.arange(int(known.count.sum())) + np.repeat(low - (np.cumsum(known.count) - known.count), known.count)
        keys, count = np.unique(owner * self.symbols + index.before[rows], return_counts=True)
        who, symbol = keys // self.symbols, keys % self.symbols
        # Smaller symbols beside the same phrase come first in the other index; 0 is the smallest.
        ahead = np.cumsum(count) - count
        begin = np.concatenate([[True], who[1:] != who[:-1]]) if len(who) else np.zeros(0, dtype=bool)
        ahead = ahead - np.repeat(ahead[begin], np.diff(np.concatenate([np.flatnonzero(begin), [len(who)]])))
        word = symbol > 0
        who, symbol, count, ahead = who[word], symbol[word], count[word], ahead[word]
        new_low = index.first[symbol] + index.rank(symbol, low[who])
        new_other = other[who] + ahead
        sides = (symbol[:, None], known.symbols[who]) if left else (known.symbols[who], symbol[:, None])
        grown = np.concatenate(sides, axis=1)
        return Intervals(grown, new_low, new_other, count) if left else Intervals(grown, new_other, new_low, count)

    def phrases(self, length: int) -> Intervals:
        """All phrases of ``length`` words, grown to the left and to the right in turn."""
        found = self.words()
        for step in range(length - 1):
            found = self.extend(found, left=step % 2 == 0)
        return found

    def places(self, found: Intervals, chosen: np.ndarray) -> np.ndarray:
        """Where the chosen phrases begin."""
        low, count = found.low[chosen], found.count[chosen]
        rows = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
        return self.forward.order[rows]


def phrase_texts(found: Intervals, words: pa.Array) -> pa.Array:
    parts = [words.take(pa.array(column)) for column in found.symbols.T]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def keep_promising(sequence: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
    """The words of phrases of ``length`` words that begin where two phrases one word shorter follow each other."""
    marked = np.zeros(len(sequence) + 1, dtype=bool)
    marked[begins] = True
    start = np.flatnonzero(marked[:-1] & marked[1:])
    change = np.zeros(len(sequence) + 1, dtype=np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    kept = np.where(np.cumsum(change)[:-1] > 0, sequence, 0)
    wanted = kept > 0
    border = np.concatenate([[False], wanted[:-1]])
    return np.concatenate([np.zeros(1, dtype=sequence.dtype), kept[wanted | border]])


def renumber(sequence: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    used = np.zeros(len(words), dtype=bool)
    used[sequence] = True
    used[0] = True
    return (np.cumsum(used, dtype=np.int32) - 1)[sequence], words.filter(pa.array(used))


# Word numbers are packed: frequent words recur and the codec finds them.
CODEC = "zstd"

SHARD_SCHEMA = "shard bigint, lang string, size bigint, sequence binary, words array<string>"
_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("sequence", pa.binary()), ("words", pa.list_(pa.string()))])
COUNT_SCHEMA = "part int, shard bigint, size int, keys binary, counts binary"
_COUNTS = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("size", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
HOT_SCHEMA = "shard bigint, size int, keys binary"
_HOT = pa.schema([("shard", pa.int64()), ("size", pa.int32()), ("keys", pa.binary())])
# A row holds the phrases of a shard in a range of hashes with their counts there, or (without phrases) a shard.
FOUND_SCHEMA = f"{SHARD_SCHEMA}, part int, phrases array<string>, counts array<bigint>"
_FOUND = pa.schema([*_SHARD, ("part", pa.int32()), ("phrases", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
SUM_SCHEMA = "lang string, phrase string, f bigint"
_SUM = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])


def _shard_row(shard: int, lang: str, sequence: np.ndarray, words: pa.Array) -> pa.Table:
    columns = {
        "shard": [shard],
        "lang": [lang],
        "size": [len(sequence)],
        "sequence": [pa.compress(sequence.astype(np.int32).tobytes(), CODEC, asbytes=True)],
        "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
    }
    return pa.table(columns, schema=_SHARD)


def _opened(size: int, sequence: bytes, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    return np.frombuffer(pa.decompress(sequence, 4 * size, CODEC, asbytes=True), dtype=np.int32), words.cast(pa.large_string())


def _sliced(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between pieces."""
    begin = 0
    while len(text) - begin > HELD_BYTES // 4:
        ends = [e for e in (text.rfind(bytes([c]), begin, begin + HELD_BYTES // 4) for c in PIECE_BORDERS) if e > begin]
        if not ends:
            ends = [e for e in (text.find(bytes([c]), begin + HELD_BYTES // 4) for c in PIECE_BORDERS) if e > begin]
            if not ends:
                break
            ends = [min(ends)]
        yield text[begin : max(ends)]
        begin = max(ends)
    yield text[begin:]


def first_shards(texts: DataFrame) -> DataFrame:
    """Shards of ``lang, text``; no row is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            sequence, words = split_words(held.pop(lang))
            del sizes[lang]
            yield from _shard_row((task << 32) + number, lang, sequence, words).to_batches()
            number += 1

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for part in _sliced((text or "").encode()):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    # A word and its border take six bytes or so.
                    if sizes[lang] >= 6 * SHARD_WORDS:
                        yield from close(lang)
                if sum(sizes.values()) >= HELD_BYTES:
                    for each in list(held):
                        yield from close(each)
        for each in list(held):
            yield from close(each)

    return texts.mapInArrow(run, SHARD_SCHEMA)


def phrase_hashes(found: Intervals, words: pa.Array, lang: str, bits: int) -> np.ndarray:
    """The first ``bits`` bits of a hash of the language and the phrase's words."""
    hashed, start = word_hashes(words), word_hashes(pa.array([lang], pa.large_string()))
    keys = np.empty(len(found.count), dtype=np.uint32)
    for at in range(0, len(keys), HASHED_PHRASES):
        symbols = found.symbols[at : at + HASHED_PHRASES]
        state = np.repeat(start, len(symbols))
        for column in symbols.T:
            state = mixed(state * FACTOR + hashed[column])
        keys[at : at + len(symbols)] = state >> np.uint64(64 - bits)
    return keys


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, byte by byte: most are small, so the upper bytes take no room."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), CODEC, asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(data, 4 * size, CODEC, asbytes=True), dtype=np.uint8)
    return flat.reshape(4, -1).T.copy().view("<u4").ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Rising numbers as the gaps between them."""
    return _packed(np.diff(keys, prepend=np.uint32(0)))


def _unpacked_keys(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, size), dtype=np.uint32)


def shard_words(shards: DataFrame) -> DataFrame:
    """``lang, n``: words of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, size, sequence in zip(*(batch.column(c).to_pylist() for c in ("lang", "size", "sequence"))):
                numbers = np.frombuffer(pa.decompress(sequence, 4 * size, CODEC, asbytes=True), dtype=np.int32)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]), "n": pa.array([np.count_nonzero(numbers)], pa.int64())})

    return shards.select("lang", "size", "sequence").mapInArrow(run, "lang string, n bigint")


def shard_counts(shards: DataFrame, length: int, parts: int, bits: int) -> DataFrame:
    """Counts by hash of the phrases of ``length`` words in each shard, in ``parts`` ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                sequence, words = _opened(row["size"].as_py(), row["sequence"].as_py(), row["words"].values)
                found = BothWays(sequence, len(words), length).phrases(length)
                keys = phrase_hashes(found, words, row["lang"].as_py(), bits)
                order = np.argsort(keys)
                keys, counts = keys[order], found.count[order]
                begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
                keys, counts = keys[begin], np.add.reduceat(counts, begin) if len(begin) else counts
                edges = np.searchsorted(keys, [(part << bits) // parts for part in range(parts + 1)])
                rows = [
                    (part, row["shard"].as_py(), end - at, _packed_keys(keys[at:end]), _packed(counts[at:end]))
                    for part, (at, end) in enumerate(zip(edges.tolist(), edges[1:].tolist()))
                    if end > at
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _COUNTS)], schema=_COUNTS)

    return shards.mapInArrow(run, COUNT_SCHEMA)


def hot_keys(counts: DataFrame, least: int) -> DataFrame:
    """For each shard those of its hashes whose counts in all shards together reach ``least``."""

    def run(rows: pa.Table) -> pa.Table:
        sizes = rows["size"].to_pylist()
        own = [_unpacked_keys(data, size) for data, size in zip(rows["keys"].to_pylist(), sizes)]
        keys = np.concatenate(own)
        order = np.argsort(keys)
        number = np.concatenate([_unpacked(data, size) for data, size in zip(rows["counts"].to_pylist(), sizes)])[order]
        keys = keys[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        hot = keys[begin][np.add.reduceat(number.astype(np.int64), begin) >= least]
        kept = [mine[np.isin(mine, hot, assume_unique=True)] for mine in own]
        made = [(shard, len(mine), _packed_keys(mine)) for shard, mine in zip(rows["shard"].to_pylist(), kept) if len(mine)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), _HOT)], schema=_HOT) if made else _HOT.empty_table()

    return counts.groupBy("part").applyInArrow(run, HOT_SCHEMA)


def find_phrases(shards: DataFrame, hot: DataFrame, length: int, longest: int, parts: int, bits: int) -> DataFrame:
    """The phrases of each shard whose hashes are hot, and below ``longest`` the shard cut down to the places where two of them follow each other."""

    def run(shard: pa.Table, known: pa.Table) -> pa.Table:
        if not len(shard) or not len(known):
            return _FOUND.empty_table()
        row = {name: shard[name][0] for name in shard.schema.names}
        number, lang = row["shard"].as_py(), row["lang"].as_py()
        sequence, words = _opened(row["size"].as_py(), row["sequence"].as_py(), row["words"].values)
        index = BothWays(sequence, len(words), length)
        found = index.phrases(length)
        wanted = np.concatenate([_unpacked_keys(data, size) for data, size in zip(known["keys"].to_pylist(), known["size"].to_pylist())])
        keys = phrase_hashes(found, words, lang, bits)
        chosen = np.isin(keys, wanted)
        range_of = (keys[chosen].astype(np.uint64) * np.uint64(parts) >> np.uint64(bits)).astype(np.int32)
        order = np.argsort(range_of, kind="stable")
        picked = np.flatnonzero(chosen)[order]
        part = Intervals(*(v[picked] for v in (found.symbols, found.low, found.back_low, found.count)))
        used, begin = np.unique(range_of[order], return_index=True)
        edges = pa.array([*begin.tolist(), len(picked)], pa.int32())
        columns = {name: pa.nulls(len(used), _FOUND.field(name).type) for name in ("size", "sequence", "words")} | {
            "shard": pa.array(np.full(len(used), number, dtype=np.int64)),
            "lang": pa.repeat(lang, len(used)),
            "part": pa.array(used),
            "phrases": pa.ListArray.from_arrays(edges, phrase_texts(part, words).cast(pa.string())),
            "counts": pa.ListArray.from_arrays(edges, pa.array(part.count.astype(np.int64))),
        }
        made = pa.table([columns[name] for name in _FOUND.names], schema=_FOUND)
        if length == longest:
            return made
        cut, words = renumber(keep_promising(sequence, index.places(found, chosen), length + 1), words)
        if len(words) < 2:
            return made
        whole = _shard_row(number, lang, cut, words)
        for name in ("part", "phrases", "counts"):
            whole = whole.append_column(_FOUND.field(name), pa.nulls(1, _FOUND.field(name).type))
        return pa.concat_tables([made, whole])

    return shards.groupBy("shard").cogroup(hot.groupBy("shard")).applyInArrow(run, FOUND_SCHEMA)


def sum_phrases(found: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, f`` of the phrases whose sum over all shards reaches ``least``; equal phrases share a range of hashes."""

    def run(rows: pa.Table) -> pa.Table:
        lists = rows["phrases"].combine_chunks()
        owner = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
        langs = rows["lang"].combine_chunks().take(pa.array(owner))
        each = pa.table({"lang": langs, "phrase": lists.flatten(), "n": rows["counts"].combine_chunks().flatten()})
        summed = each.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
        kept = summed.filter(pc.greater_equal(summed["n_sum"], least))
        return pa.table([kept["lang"], kept["phrase"], kept["n_sum"]], schema=_SUM)

    return found.filter("part IS NOT NULL").select("part", "lang", "phrases", "counts").groupBy("part").applyInArrow(run, SUM_SCHEMA)


def count_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases of up to ``longest`` words that occur ``least`` times, and ``lang, n``."""
    texts = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    levels = []
    spark = df.sparkSession
    shards, path = _store(first_shards(texts), "shards1")
    totals = cut_lineage(shard_words(shards).groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    for length in range(1, longest + 1):
        parts = max(1, -(-(shards.agg(F.sum("size")).first()[0] or 0) // PART_WORDS))
        hot = hot_keys(shard_counts(shards, length, parts, HASH_BITS), least)
        found, new = _store(find_phrases(shards, hot, length, longest, parts, HASH_BITS), f"shards{length + 1}")
        levels.append(cut_lineage(sum_phrases(found, least), f"phrases{length}").withColumn("words", F.lit(length)))
        # Nothing reads the longer shards again.
        drop_stored(spark, path)
        shards, path = found.filter("part IS NULL").select(*_SHARD.names), new
        _forget(spark)
    drop_stored(spark, path)
    return cut_lineage(reduce(DataFrame.unionByName, levels), "phrases"), totals


def _store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _forget(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of rounds that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def _part(words: Column, first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def score_phrases(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score, left_extension, right_extension``.

    The score is the lowest over all cuts; extensions are the largest counts of a phrase one
    word longer to that side (0: none is frequent).
    """
    single = phrases.select("lang", "phrase", "f")
    listed = phrases.filter("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = listed.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("x"), _part(F.col("w"), F.col("k") + 1, F.size("w")).alias("y"))
    left = single.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l"))
    right = single.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r"))
    met = sides.join(left, ["lang", "x"]).join(right, ["lang", "y"]).join(totals, "lang")
    big = "decimal(19,0)"
    above = (F.col("a") * 1000).cast(big) * F.col("n").cast(big)
    below = F.col("l").cast(big) * F.col("r").cast(big)
    scored = met.select("lang", "phrase", "a", "k", "l", "r", "n", F.call_function("div", above, below).cast("long").alias("score"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = listed.filter("words > 2").withColumn("size", F.size("w") - 1)
    without_first = longer.select("lang", _part(F.col("w"), 2, F.col("size")).alias("phrase"), F.col("f").alias("to_left"), F.lit(0).cast("long").alias("to_right"))
    without_last = longer.select("lang", _part(F.col("w"), 1, F.col("size")).alias("phrase"), F.lit(0).cast("long").alias("to_left"), F.col("f").alias("to_right"))
    extensions = (
        without_first.unionByName(without_last)
        .groupBy("lang", "phrase")
        .agg(F.max("to_left").alias("left_extension"), F.max("to_right").alias("right_extension"))
    )
    whole = lowest.join(extensions, ["lang", "phrase"], "left")
    return whole.select(
        "lang",
        "phrase",
        F.size(F.split("phrase", " ")).alias("words"),
        "a",
        "cut.l",
        "cut.r",
        "n",
        "cut.score",
        F.coalesce("left_extension", F.lit(0)).alias("left_extension"),
        F.coalesce("right_extension", F.lit(0)).alias("right_extension"),
    )


def best_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases that no equally frequent longer one holds.

    A longer phrase that holds this one and is as frequent has a part one word longer than
    this one that is as frequent, so the extensions decide.
    """
    scored = score_phrases(*count_phrases(df, text, lang, least, longest))
    free = scored.filter(F.greatest("left_extension", "right_extension") < F.col("a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return free.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
