"""Byte-level BPE: encode texts by a rank file and decode ids back to bytes.

Encoding runs in one stage without a shuffle of texts:

1. a regular expression cuts the text into words (JVM);
2. each task numbers the distinct words it meets and passes every word on once, as the
   array of its bytes; pieces and common words have a number and ids beforehand;
3. a fold of higher-order functions merges the adjacent pair of lowest rank until no pair
   has a rank.  The rank map is a literal: pair (a, b) is looked up at ``shift[a] + b``;
4. each document's word numbers are replaced by the ids of the words.

Common words are folded once for all tasks: those that occur at least twice in about
``COMMON_DOCS`` documents, ``COMMON_WORDS`` at most.  They are broadcast with their ids.  This only
saves folds: a word that is not among them gets the same ids in its task.

The words of a task come before the documents that use them, so the table of a task is
built once and stays bounded: after ``TABLE_WORDS`` distinct words both sides start anew.

Null and empty texts have no ids and decode to empty bytes.  A word of more than
``FOLD_BYTES`` bytes is merged with a heap instead of the fold, with the same result.
Repeated rows give repeated rows; all other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.flat import word_hashes
from textmill.session import cut_lineage

COMMON_DOCS = 24_000
COMMON_WORDS = 500_000
TABLE_WORDS = 400_000
FOLD_BYTES = 512
SLICE_WORDS = 200_000
# Ids have 17 bits at most.  The order of a pair is twice its rank, plus one if the merged
# piece has splits that can overlap; this number stands for "no such pair".
_ID_BITS = 17
NO_PAIR = 1 << (_ID_BITS + 1)
_BIG = 1 << 40

# White space as the rank files' pattern means it (Unicode White_Space).
_SPACE = r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def java_pattern(pattern: str) -> str:
    """The split pattern with white space written out: Java's own class is ASCII only."""
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]")
    return inside.replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


@lru_cache(maxsize=4)
def load_pieces(path: str) -> tuple[bytes, ...]:
    """The pieces of a rank file in rank order."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))) or len(ranked) >= 1 << _ID_BITS:
        raise ValueError(f"{path} does not rank its pieces from 0 on")
    return tuple(ranked[i] for i in range(len(ranked)))


def pair_ranks(pieces: tuple[bytes, ...]) -> dict[tuple[int, int], int]:
    """Rank of every pair of pieces whose concatenation is a piece."""
    ids = {piece: i for i, piece in enumerate(pieces)}
    pairs = {}
    for whole, rank in ids.items():
        for cut in range(1, len(whole)):
            left, right = ids.get(whole[:cut]), ids.get(whole[cut:])
            if left is not None and right is not None:
                pairs[left, right] = rank
    return pairs


@lru_cache(maxsize=4)
def rank_table(path: str) -> tuple[list[int], list[int]]:
    """``shift`` per left piece and ``cells``: the cell at ``shift[a] + b`` holds ``a`` and the pair's order.

    Rows of the sparse pair matrix are laid over each other, longest first, each at the
    first place where none of its cells is taken.
    """
    pieces = load_pieces(path)
    pairs = pair_ranks(pieces)
    # Pairs (x, y) and (y, z) of one rank overlap; with one split only, the order by id is the order by place.
    odd = set()
    # The splits of a piece follow one another.
    for rank, splits in groupby(pairs.items(), key=itemgetter(1)):
        lefts, rights = map(set, zip(*(pair for pair, _ in splits)))
        if len(lefts) > 1 and lefts & rights:
            odd.add(rank)
    rows: dict[int, list[tuple[int, int]]] = {}
    for (left, right), rank in pairs.items():
        rows.setdefault(left, []).append((right, 2 * rank + (rank in odd)))
    del pairs
    cells = np.full(16 * len(pieces) + (1 << 16), -1, dtype=np.int64)
    free = np.ones(len(cells), dtype=bool)
    shift = [0] * len(pieces)
    low: dict[int, int] = {}
    for left, row in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
        columns = np.array([right for right, _ in row])
        # Rows of one length are tried from where the last of them found its place.
        place, span = max(0, low.get(len(row), 0) - int(columns.min())), 4096
        while True:
            fits = free[place + columns[0] : place + columns[0] + span].copy()
            for column in columns[1:]:
                fits &= free[place + column : place + column + span]
            if fits.any():
                break
            place += span
        place += int(fits.argmax())
        low[len(row)] = place + int(columns.min())
        shift[left] = place
        free[place + columns] = False
        for right, order in row:
            cells[place + right] = left * NO_PAIR + order
    top = int(np.flatnonzero(cells >= 0).max()) + 1 if len(rows) else 0
    return shift, cells[: top + len(pieces)].tolist()


def _let(value: Column, use) -> Column:
    """Bind a column to a name inside an expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_merges(symbols: Column, shift: Column, cells: Column, border: Column) -> Column:
    """Ids of one word, given the ids of its single bytes.

    The state is one number a symbol: the order of the pair that begins there, above the
    symbol's id.  A step merges the first pair of lowest order and looks up the two pairs
    that this makes new.  A border on both sides, in no pair, gives every symbol its neighbours.
    """
    top = F.lit((1 << _ID_BITS) - 1).cast("long")

    def packed(left: Column, right: Column) -> Column:
        # A cell of another row gives a difference below 0 or beyond the largest order.
        found = F.get(cells, (F.get(shift, left.cast("int")) + right).cast("int")) - left * F.lit(NO_PAIR).cast("long")
        order = F.least(F.pmod(found, F.lit(_BIG)), F.lit(NO_PAIR).cast("long"))
        return F.shiftleft(order, _ID_BITS).bitwiseOR(left)

    def merge(state: Column, at: Column, best: Column) -> Column:
        left, right = F.get(state, at - 2).bitwiseAND(top), F.get(state, at + 1).bitwiseAND(top)
        return F.concat(
            F.slice(state, F.lit(1), at - 2),
            F.array(packed(left, best), packed(best, right)),
            F.slice(state, at + 2, F.size(state)),
        )

    def step(state: Column, _: Column) -> Column:
        def lowest(low: Column) -> Column:
            first = F.shiftright(low, _ID_BITS)
            # An odd order marks a piece whose splits can overlap: then the leftmost place counts, not the id.
            place = F.when(
                first % 2 == 1, F.array_position(F.transform(state, lambda x: F.shiftright(x, _ID_BITS)), first)
            ).otherwise(F.array_position(state, low))
            merged = _let(place.cast("int"), lambda at: merge(state, at, F.shiftright(low, _ID_BITS + 1)))
            return F.when(low >= F.lit(NO_PAIR << _ID_BITS), state).otherwise(merged)

        return _let(F.array_min(state), lowest)

    edge = F.array(border)
    bordered = F.concat(edge, symbols, edge)
    # The right border has no right neighbour and so begins no pair.
    start = F.zip_with(bordered, F.concat(symbols, edge), packed)
    rounds = F.slice(symbols, F.lit(2), F.size(symbols))
    return F.aggregate(
        rounds, start, step, lambda done: F.transform(F.slice(done, F.lit(2), F.size(done) - 2), lambda x: x.bitwiseAND(top))
    )


def heap_merges(symbols: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """The same merges for a very long word, in n log n steps over a linked list."""
    n = len(symbols)
    ids, after, before = list(symbols), [*range(1, n), -1], [*range(-1, n - 1)]
    alive = [True] * n
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or ids[i] != left or ids[j] != right:
            continue
        ids[i], alive[j], after[i] = rank, False, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for at in (before[i], i):
            if at >= 0 and after[at] >= 0:
                pair = ids[at], ids[after[at]]
                if pair in pairs:
                    heapq.heappush(heap, (pairs[pair], at, *pair))
    return [x for x, keep in zip(ids, alive) if keep]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start .. start + length`` of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def _byte_lists(words: list[bytes], byte_ids: np.ndarray) -> pa.ListArray:
    """The ids of each word's bytes; a word beyond the fold's length has an empty list."""
    folded = [w if len(w) <= FOLD_BYTES else b"" for w in words]
    ends = np.cumsum([0, *map(len, folded)])
    flat = byte_ids[np.frombuffer(b"".join(folded), dtype=np.uint8)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


class KnownWords:
    """Numbers of distinct words, 25 bytes or so beside the letters of each: found by a hash, told apart by their bytes."""

    def __init__(self, words: pa.Array) -> None:
        hashes = word_hashes(words)
        self.order = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.order]
        self.words = words

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 for those that are not known."""
        found = np.full(len(words), -1, dtype=np.int32)
        wanted = word_hashes(words)
        at = np.searchsorted(self.hashes, wanted)
        left = np.arange(len(words))
        while len(left):
            left = left[at[left] < len(self.hashes)]
            left = left[self.hashes[at[left]] == wanted[left]]
            if not len(left):
                break
            tried = self.order[at[left]]
            same = np.asarray(pc.equal(self.words.take(pa.array(tried)), words.take(pa.array(left))))
            found[left[same]] = tried[same]
            # Another word can have the same hash.
            left = left[~same]
            at[left] += 1
        return found


def _number_words(passed: list[str], byte_ids: np.ndarray, common: KnownWords, schema: pa.Schema):
    """Replace the word arrays by numbers; new words go out with the batch's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        n_common = len(common.words)
        for whole in batches:
            words = whole.column("_words")
            counts = np.diff(words.offsets.to_numpy())
            begin = 0
            while begin < whole.num_rows:
                # As many documents as fit a slice, one at least.
                end = begin + max(1, int(np.searchsorted(np.cumsum(counts[begin:]), SLICE_WORDS, side="right")))
                batch = whole.slice(begin, end - begin)
                begin = end
                held = batch.column("_words")
                flat = held.flatten().cast(pa.binary()).dictionary_encode()
                numbers = common.numbers(flat.dictionary)
                others = np.flatnonzero(numbers < 0)
                distinct = flat.dictionary.take(pa.array(others)).to_pylist()
                if len(known) + len(distinct) > TABLE_WORDS:
                    known = {}
                base, fresh = len(known), []
                for k, word in zip(others.tolist(), distinct):
                    at = known.get(word)
                    if at is None:
                        known[word] = at = len(known)
                        fresh.append(word)
                    numbers[k] = n_common + at
                codes = numbers[flat.indices.to_numpy(zero_copy_only=False)] if len(flat) else numbers
                offsets = np.concatenate([[0], np.cumsum(counts[end - batch.num_rows : end])]).astype(np.int32)
                lists = _byte_lists(fresh, byte_ids)
                n = batch.num_rows
                first = np.concatenate([[0, len(fresh)], np.full(n - 1, len(fresh))]).astype(np.int32)
                long_words = [w for w in fresh if len(w) > FOLD_BYTES]
                columns = [batch.column(c) for c in passed] + [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes)),
                    pa.ListArray.from_arrays(pa.array(first), lists),
                    pa.array([long_words] + [None] * (n - 1), pa.list_(pa.binary())),
                    pa.array([base] + [None] * (n - 1), pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


class _WordTable:
    """Ids of the words numbered so far, as one flat array."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids = ids
        self.starts = np.cumsum(lengths) - lengths
        self.lengths = lengths

    def add(self, words: list[np.ndarray], lengths: np.ndarray) -> None:
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, *words])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])


def _cut_bytes(data, edges: np.ndarray) -> pa.Array:
    """Byte strings between neighbouring edges, without a copy of each."""
    offsets = pa.py_buffer(edges.astype(np.int64).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, offsets, pa.py_buffer(data)])


def _spelt(pieces: pa.Array, ids: np.ndarray, edges: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of all ids in a row, and the places of the edges between ids in them."""
    texts = pieces.take(pa.array(ids))
    places = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, dtype=np.int64)
    return texts.buffers()[2] or pa.py_buffer(b""), places[edges]


def _place_ids(passed: list[str], pieces: pa.Array, common, byte_ids: np.ndarray, schema: pa.Schema, decoded: bool):
    """Replace word numbers by ids, packed as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, pairs = _WordTable(*common), None
        for whole in batches:
            bases = whole.column("_base").to_pylist()
            marks = [i for i, b in enumerate(bases) if b is not None]
            cuts = sorted({0, *marks})
            for begin, end in zip(cuts, [*cuts[1:], whole.num_rows]):
                batch = whole.slice(begin, end - begin)
                if bases[begin] is not None:
                    if bases[begin] == 0:
                        table = _WordTable(*common)
                    fresh = batch.column("_merged").slice(0, 1).flatten()
                    lengths = np.diff(fresh.offsets.to_numpy()).astype(np.int64)
                    parts = [fresh.flatten().to_numpy(zero_copy_only=False).astype(np.int32)]
                    if (lengths == 0).any():
                        pairs = pairs or pair_ranks(tuple(pieces.to_pylist()))
                        # An empty entry stands for the next long word.
                        long_ids = [
                            heap_merges(byte_ids[np.frombuffer(w, dtype=np.uint8)].tolist(), pairs)
                            for w in batch.column("_long")[0].as_py()
                        ]
                        ends = np.cumsum(lengths)
                        parts = np.split(parts[0], ends[lengths == 0])
                        parts = [x for k, p in enumerate(parts) for x in (p, long_ids[k] if k < len(long_ids) else [])]
                        parts = [np.asarray(p, dtype=np.int32) for p in parts]
                        lengths[lengths == 0] = [len(x) for x in long_ids]
                    table.add(parts, lengths)
                held = batch.column("_codes")
                codes = held.flatten().to_numpy(zero_copy_only=False)
                counts = np.diff(held.offsets.to_numpy())
                lengths = table.lengths[codes]
                ids = table.ids[_ragged(table.starts[codes], lengths)]
                word_ends = np.concatenate([[0], np.cumsum(lengths)])
                ends = word_ends[np.cumsum(counts)]
                starts = np.concatenate([[0], ends[:-1]])
                out = [batch.column(c) for c in passed]
                out.append(pa.array(ends - starts))
                # All texts in a row; a document's bytes begin where the one before ends.
                edges = np.concatenate([[0], ends])
                out.append(_cut_bytes(ids.astype("<u4").tobytes(), 4 * edges))
                if decoded:
                    out.append(_cut_bytes(*_spelt(pieces, ids, edges)))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def _arrow(fields: list[T.StructField]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(fields))


def _free(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` that pass through; those with an output's name are replaced."""
    return [c for c in df.columns if c not in names]


def _folds(words: Column, path: str) -> Column:
    """Ids of every word of an array, given the ids of its bytes."""
    shift, cells = rank_table(path)
    # The border's number is the first that is no piece.
    border = F.lit(len(shift)).cast("long")
    shifts = F.from_json(F.lit(json.dumps([*shift, 0])), "array<int>")
    table = F.from_json(F.lit(json.dumps(cells)), "array<bigint>")
    # Bound once: the large literals then stand in the expression once.
    return _let(
        shifts,
        lambda places: _let(table, lambda ranks: F.transform(words, lambda word: fold_merges(word, places, ranks, border))),
    )


def _count_words(ids: dict[bytes, int]):
    """How often each word occurs that is no piece, summed up within a task as far as the table's bound allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            made = pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays(list(made), names=["word", "n"])

        for batch in batches:
            met = batch.column(0).flatten().cast(pa.binary()).value_counts()
            words, numbers = met.field("values").to_pylist(), met.field("counts").to_pylist()
            counts.update({w: k for w, k in zip(words, numbers) if w not in ids and len(w) <= FOLD_BYTES})
            if len(counts) > TABLE_WORDS:
                yield flushed()
        yield flushed()

    return run


def common_words(split: DataFrame, path: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words to fold beforehand with all their ids in a row and the number of ids of each.

    ``split`` has one column, the array of a document's words.  The words come from a sample
    of bounded expected size; those of the smallest count are left out as a whole where
    there would be more than ``COMMON_WORDS``.
    """
    nothing = pa.array([], pa.binary()), np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
    total = split.count()
    if total == 0:
        return nothing
    pieces = load_pieces(path)
    ids = {piece: i for i, piece in enumerate(pieces)}
    byte_ids = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)
    shared = split.sparkSession.sparkContext.broadcast(ids)
    taken = split if total <= COMMON_DOCS else split.sample(COMMON_DOCS / total, seed=1)

    def count(batches):
        return _count_words(shared.value)(batches)

    counted = taken.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    stored = cut_lineage(counted.filter("n > 1"), "words")
    least, held = None, 0
    # One row for each number of occurrences in the sample.
    for n, words in sorted(map(tuple, stored.groupBy("n").agg(F.count("*")).collect()), reverse=True):
        held += words
        if held > COMMON_WORDS:
            break
        least = n
    if least is None:
        return nothing

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = _byte_lists(batch.column(0).to_pylist(), byte_ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["word", "symbols"])

    spelt = stored.filter(F.col("n") >= least).select("word").mapInArrow(symbols, "word binary, symbols array<bigint>")
    folded = spelt.select("word", F.get(_folds(F.array("symbols"), path), F.lit(0)).cast("array<int>").alias("ids")).toArrow()
    lists = folded.column("ids").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return folded.column("word").combine_chunks().cast(pa.binary()), lists.flatten().to_numpy().astype(np.int32), lengths


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """Adds ``n_tokens`` and ``token_ids`` (packed, 4 bytes an id), with ``decoded`` also the bytes the ids stand for.

    The column ``text`` is replaced by these; a column with an output's name is replaced too.
    """
    pieces = load_pieces(path)
    ids = {piece: i for i, piece in enumerate(pieces)}
    byte_ids = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)

    passed = _free(df, text, "n_tokens", "token_ids", "decoded")
    kept = [df.schema[c] for c in passed]
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))
    split = df.select(*[F.col(f"`{c}`") for c in passed], words.alias("_words"))

    # Pieces are numbered by their rank, common words after them.
    frequent, frequent_ids, frequent_lengths = common_words(df.select(words.alias("_words")), path)
    context = df.sparkSession.sparkContext
    spelt = context.broadcast(KnownWords(pa.concat_arrays([pa.array(pieces, pa.binary()), frequent])))
    start = (
        np.concatenate([np.arange(len(pieces), dtype=np.int32), frequent_ids]),
        np.concatenate([np.ones(len(pieces), dtype=np.int64), frequent_lengths]),
    )
    shared = context.broadcast((pa.array(pieces, pa.large_binary()), start))

    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    numbered = [
        *kept,
        T.StructField("_codes", ints),
        T.StructField("_fresh", T.ArrayType(longs)),
        T.StructField("_long", T.ArrayType(T.BinaryType())),
        T.StructField("_base", T.IntegerType()),
    ]
    arrow_numbered = _arrow(numbered)

    def number(batches):
        return _number_words(passed, byte_ids, spelt.value, arrow_numbered)(batches)

    coded = split.mapInArrow(number, T.StructType(numbered))

    merged = coded.select(
        *[F.col(f"`{c}`") for c in passed],
        "_codes",
        _folds(F.col("_fresh"), path).alias("_merged"),
        "_long",
        "_base",
    )
    result = [*kept, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())]
    if decoded:
        result.append(T.StructField("decoded", T.BinaryType()))
    arrow = _arrow(result)

    def place(batches):
        return _place_ids(passed, *shared.value, byte_ids, arrow, decoded)(batches)

    return merged.mapInArrow(place, T.StructType(result))


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that packed ids stand for; null ids stay null."""
    pieces = df.sparkSession.sparkContext.broadcast(load_pieces(path))
    names = _free(df, out)
    fields = [*[df.schema[c] for c in names], T.StructField(out, T.BinaryType())]
    arrow = _arrow(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces.value
        for batch in batches:
            texts = [
                None if p is None else b"".join(map(known.__getitem__, np.frombuffer(p, dtype="<u4").tolist()))
                for p in batch.column(ids).to_pylist()
            ]
            columns = [batch.column(c) for c in names] + [pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, T.StructType(fields))
