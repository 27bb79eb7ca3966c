"""Subword vocabularies: word counts, merge rounds and encoding."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import ColumnOrName, chars, let
from textmill.functions.tokens import nfkc, pretokenize
from textmill.operators.exploding import explode_items, explode_structs
from textmill.session import drop_stored, store

# --- fixed values -----------------------------------------------------------
SPECIAL_TOKENS = ["<EOS>", "<BOS>", "<SEP>", "<CLS>", "<MASK>", "<UNK>", "<PAD>"]
EXTRA_TOKENS = ["\t", "\n"]
UNKNOWN = "<UNK>"
VOCABULARY_SIZE = 30_000
MIN_FREQUENCY = 100
# ----------------------------------------------------------------------------

#: Merges tried in one round, and the best pairs whose exact counts the driver holds.
TRIED = 4096
TOP_PAIRS = 16384
#: Pieces a task encodes at a time, and the words whose ids it keeps within a batch.
SLICE_PIECES = 1 << 17
CACHED_WORDS = 1 << 16
#: Most stretches of words the next merges are worked out from, and the pairs that are tried even if they have more
#: (the most frequent stretches count then).  All merges are checked on all words.
GUESS_WORDS = 400_000
LEAST_TRIED = 64
#: Pairs tried first where there are more words than that.
FIRST_TRIED = 256
#: Words of more symbols are folded one at a time: a step of the fold of many words reads all symbols of those it has not done.
LONG_WORD = 512


Pair = tuple[str, str]


def word_counts(df: DataFrame, text: ColumnOrName, min_freq: int = 1) -> DataFrame:
    """``word, freq`` of the pre-tokenised pieces, counted before the shuffle."""
    pieces = explode_items(df, [], pretokenize(text), "word")
    counted = pieces.groupBy("word").agg(F.count("*").alias("freq"))
    return counted.filter(F.col("freq") >= min_freq) if min_freq > 1 else counted


@dataclass
class Vocabulary:
    """Token ids and merge order; small and bounded by the vocabulary size."""

    tokens: list[str]
    merges: list[tuple[str, str]] = field(default_factory=list)

    @property
    def ids(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.tokens)}


# Symbols of a word are kept in one string with this control character between them.
SEPARATOR = "\x1f"


def _symbols(word: Column) -> Column:
    """Single characters; the separator itself cannot be a symbol and is replaced."""
    return F.array_join(chars(F.translate(word, SEPARATOR, "\ufffd")), SEPARATOR)


def _pair_counts(words: DataFrame) -> DataFrame:
    def pairs(parts: Column) -> Column:
        last = F.size(parts) - 1
        index = F.when(last < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last - 1))
        return F.transform(index, lambda i: F.struct(F.get(parts, i).alias("a"), F.get(parts, i + 1).alias("b")))

    found = explode_structs(words, ["freq"], let(F.split("symbols", SEPARATOR), pairs))
    return found.groupBy("a", "b").agg(F.sum("freq").alias("n"))


def fold(parts: list[str], ranks: dict[Pair, list[int]], changes: dict | None = None, freq: int = 1) -> list[str]:
    """Merge adjacent symbols, lowest rank first and from the left, in time n log n.

    ``ranks`` lists the places of each pair in the order of merges.  With ``changes`` (training)
    ranks only go up, as a merge learned earlier is not applied again to what later ones
    join, and the change of every pair's count at every rank is added to it.  Without
    (encoding), the first place of a pair counts whenever it appears.
    """
    after = [*range(1, len(parts)), -1]
    before = list(range(-1, len(parts) - 1))
    symbols: list[str | None] = list(parts)
    queue: list[tuple[int, int, str, str]] = []

    def offer(at: int, beyond: int) -> None:
        left, right = symbols[at], symbols[after[at]]
        for rank in ranks.get((left, right), ()):
            if changes is None or rank > beyond:
                heapq.heappush(queue, (rank, at, left, right))
                return

    def count(left: str, right: str, rank: int, by: int) -> None:
        if changes is not None:
            changes[left, right, rank] = changes.get((left, right, rank), 0) + by * freq

    for i in range(len(parts) - 1):
        offer(i, -1)
    while queue:
        rank, at, left, right = heapq.heappop(queue)
        other = after[at]
        if symbols[at] != left or other < 0 or symbols[other] != right:
            continue
        outer, following, joined = before[at], after[other], left + right
        count(left, right, rank, -1)
        symbols[at], symbols[other], after[at] = joined, None, following
        if following >= 0:
            before[following] = at
            count(right, symbols[following], rank, -1)
            count(joined, symbols[following], rank, 1)
            offer(at, rank)
        if outer >= 0:
            count(symbols[outer], left, rank, -1)
            count(symbols[outer], joined, rank, 1)
            offer(outer, rank)
    return [s for s in symbols if s is not None]


def _places(merges: list[Pair]) -> dict[Pair, list[int]]:
    places: dict[Pair, list[int]] = {}
    for i, pair in enumerate(merges):
        places.setdefault(pair, []).append(i)
    return places


def _split(symbols: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Symbols of all words as codes, how many each word has, and the symbol of each code."""
    lists = pc.split_pattern(symbols, SEPARATOR)
    coded = lists.flatten().dictionary_encode()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths.astype(np.int64), coded.dictionary


def _joined(codes: np.ndarray, lengths: np.ndarray, names: pa.Array) -> pa.Array:
    """One string of symbols for each run of ``lengths`` codes."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(codes))), SEPARATOR)


def _found(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key would stand in the sorted ``known``, and whether it is there."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def live_stretches(words: DataFrame, live: set[Pair]) -> DataFrame:
    """``symbols, freq`` of the stretches of words in which all neighbours are live pairs."""
    chosen = sorted(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = (pa.array([pair[side] for pair in chosen], pa.string()) for side in (0, 1))
        for batch in batches:
            codes, lengths, names = _split(batch.column("symbols"))
            a, b = (pc.fill_null(pc.index_in(x, value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64) for x in (left, right))
            known = np.sort((a << 32 | b)[(a >= 0) & (b >= 0)])
            owner = np.repeat(np.arange(len(lengths)), lengths)
            linked = (owner[1:] == owner[:-1]) & _found(codes[:-1] << 32 | codes[1:], known)[1]
            # A stretch is a run of linked neighbours and the symbol that ends it.
            edges = np.diff(np.concatenate([[False], linked, [False]]).astype(np.int8))
            begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            held = np.concatenate([linked, [False]])
            held[ends] = True
            freq = batch.column("freq").take(pa.array(owner[begins]))
            rows = pa.table({"freq": freq, "symbols": _joined(codes[held], ends - begins + 1, names)})
            summed = rows.group_by("symbols").aggregate([("freq", "sum")])
            yield from summed.select(["freq_sum", "symbols"]).rename_columns(["freq", "symbols"]).to_batches()

    return words.mapInArrow(run, "freq bigint, symbols string").groupBy("symbols").agg(F.sum("freq").alias("freq"))


class Linked:
    """Words as one array of symbols, each with its neighbours, and where every pair may stand."""

    def __init__(self, words: pa.Array, freq: np.ndarray) -> None:
        self.symbols, lengths, names = _split(words)
        self.names = names.to_pylist()
        self.code = {s: i for i, s in enumerate(self.names)}
        n = len(self.symbols)
        self.freq = np.repeat(freq, lengths)
        ends = np.cumsum(lengths)
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.after[ends - 1] = self.before[ends - lengths] = -1
        at = np.flatnonzero(self.after >= 0)
        self.where: dict[int, list[np.ndarray]] = {}
        keys, self.held = self._summed(at, self.freq[at])
        for key, places in keys:
            self.where[key] = [places]

    def number(self, symbol: str) -> int:
        if symbol not in self.code:
            self.code[symbol] = len(self.names)
            self.names.append(symbol)
        return self.code[symbol]

    def key(self, pair: Pair) -> int:
        return self.number(pair[0]) << 32 | self.number(pair[1])

    def pair(self, key: int) -> Pair:
        return self.names[key >> 32], self.names[key & 0xFFFFFFFF]

    def _summed(self, at: np.ndarray, by: np.ndarray) -> tuple[Iterator[tuple[int, np.ndarray]], dict[int, int]]:
        """Places by the pair that begins there, and the sum of ``by`` of each pair."""
        if not len(at):
            return iter(()), {}
        keys = self.symbols[at] << 32 | self.symbols[self.after[at]]
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        distinct = keys[first].tolist()
        return zip(distinct, np.split(at, first[1:])), dict(zip(distinct, np.add.reduceat(by[order], first).tolist()))

    def join(self, key: int) -> dict[int, int]:
        """Join a pair wherever it stands, from the left; the change of every pair's count."""
        left, right = key >> 32, key & 0xFFFFFFFF
        places = self.where.pop(key, None)
        if places is None:
            return {}
        at = np.unique(np.concatenate(places))
        # Places are kept until they are looked at: some begin another pair by now.
        at = at[(self.symbols[at] == left) & (self.after[at] >= 0)]
        at = at[self.symbols[self.after[at]] == right]
        if not len(at):
            return {}
        if left == right:
            begins = np.concatenate([[True], self.after[at[:-1]] != at[1:]])
            place = np.arange(len(at))
            at = at[(place - place[begins][np.cumsum(begins) - 1]) % 2 == 0]
        other = self.after[at]
        outer, following = self.before[at], self.after[other]
        gone = np.unique(np.concatenate([outer[outer >= 0], at, other[following >= 0]]))
        _, changed = self._summed(gone, -self.freq[gone])
        self.symbols[at], self.symbols[other] = self.number(self.names[left] + self.names[right]), -1
        self.after[at] = following
        self.before[following[following >= 0]] = at[following >= 0]
        outer = self.before[at]
        new = np.unique(np.concatenate([outer[outer >= 0], at[following >= 0]]))
        found, more = self._summed(new, self.freq[new])
        for pair, where in found:
            self.where.setdefault(pair, []).append(where)
        for pair, n in more.items():
            changed[pair] = changed.get(pair, 0) + n
        return {pair: n for pair, n in changed.items() if n}


def guess_merges(
    words: pa.Array, freq: np.ndarray, exact: dict[Pair, int], most: int, least: int, last: tuple[int, Pair] | None = None
) -> list[Pair]:
    """The next merges, as far as some words and the exact counts of the best pairs tell.

    Pairs that come after ``last`` (count, pair) in the order of training are not taken.
    """
    linked = Linked(words, freq)
    held = linked.held
    likely = {key: float(n) for key, n in held.items()} | {linked.key(p): float(n) for p, n in exact.items()}
    queue = [(-n, linked.pair(key), key) for key, n in likely.items()]
    heapq.heapify(queue)
    merges: list[Pair] = []
    while queue and len(merges) < most:
        n, pair, key = heapq.heappop(queue)
        if -n != likely.get(key) or -n < least:
            continue
        if last and (n, pair) > (-last[0], last[1]):
            break
        merges.append(pair)
        # Words outside the guess are taken to change as these do.
        share = -n / held[key] if held.get(key) else 0.0
        for other, by in linked.join(key).items():
            held[other] = held.get(other, 0) + by
            likely[other] = likely.get(other, 0.0) + by * share
            heapq.heappush(queue, (-likely[other], linked.pair(other), other))
        likely[key] = 0.0
    return merges


def confirmed(merges: list[Pair], exact: dict[Pair, int], floor: int, changes: dict[int, list[tuple[Pair, int]]], least: int) -> int:
    """How many of the merges one-by-one training would make, given all counts above ``floor``.

    At each place the most frequent pair (the lower one of equals) must be the merge tried.
    """
    counts = dict(exact)
    queue = [(-n, pair) for pair, n in counts.items()]
    heapq.heapify(queue)
    for i, pair in enumerate(merges):
        while queue and counts.get(queue[0][1]) != -queue[0][0]:
            heapq.heappop(queue)
        # A count at the floor may have equals that are not known, save for the first in order.
        if not queue or queue[0][1] != pair or -queue[0][0] < least or (i > 0 and -queue[0][0] <= floor):
            return i
        for other, by in changes.get(i, ()):
            counts[other] = counts.get(other, 0) + by
            heapq.heappush(queue, (-counts[other], other))
    return len(merges)


CHANGE_SCHEMA = "a string, b string, step int, n bigint"
_CHANGES = pa.schema([("a", pa.string()), ("b", pa.string()), ("step", pa.int32()), ("n", pa.int64())])


class Merges:
    """The fold of training over many words at once, step by step of each word.

    A step joins the pair of lowest place in each word that has one beyond the place of its last step; words without one are done.
    """

    def __init__(self, merges: list[Pair]) -> None:
        self.places = _places(merges)
        self.known = pa.array(sorted({s for a, b in merges for s in (a, b, a + b)}), pa.string())
        code = {s: i for i, s in enumerate(self.known.to_pylist())}
        self.result = np.array([code[a + b] for a, b in merges], dtype=np.int64)
        keys = np.array([code[a] << 32 | code[b] for a, b in merges], dtype=np.int64)
        self.pairs, number = np.unique(keys, return_inverse=True)
        self.after = len(merges)
        # Places by pair: a pair can be joined again when later merges make its symbols anew.
        self.ordered = np.sort(number * (self.after + 1) + np.arange(self.after))

    def _next(self, symbols: np.ndarray, owner: np.ndarray, last: np.ndarray) -> np.ndarray:
        """For each symbol and its right neighbour the next place of their pair after the word's last one, or ``after``."""
        places = np.full(len(symbols), self.after)
        number, hit = _found(symbols[:-1] << 32 | symbols[1:], self.pairs)
        at = np.flatnonzero(hit & (owner[1:] == owner[:-1]))
        base = number[at] * (self.after + 1)
        where = np.searchsorted(self.ordered, base + last[owner[at]] + 1)
        place = self.ordered[np.minimum(where, len(self.ordered) - 1)] - base
        ok = (where < len(self.ordered)) & (place >= 0) & (place < self.after)
        places[at[ok]] = place[ok]
        return places

    def fold(self, words: pa.Array, freq: np.ndarray, changes: list[pa.Table] | None = None) -> pa.Array:
        """The words after all merges; the change of every pair's count at every place is added to ``changes``."""
        codes, lengths, own = _split(words)
        place = pc.index_in(own, value_set=self.known)
        names = pa.concat_arrays([self.known, own.filter(pc.is_null(place))])
        symbols = pc.index_in(own, value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        last = np.full(len(lengths), -1)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        moved: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            places = self._next(symbols, owner, last)
            best = np.full(len(lengths), self.after)
            at = np.flatnonzero(places < self.after)
            np.minimum.at(best, owner[at], places[at])
            on = best[owner] < self.after
            done.append((owner[~on], symbols[~on]))
            owner, symbols, places = owner[on], symbols[on], places[on]
            if not len(symbols):
                break
            step = best[owner]
            # Of pairs that overlap (only those of two equal symbols do) every other one is joined, from the left.
            chosen = places == step
            at = np.flatnonzero(chosen)
            run = np.cumsum(np.concatenate([[True], np.diff(at) > 1])) - 1
            first = at[np.concatenate([[True], np.diff(at) > 1])]
            at = at[(at - first[run]) % 2 == 0]
            if changes is not None:
                moved.append(self._pairs(symbols, owner, step, np.concatenate([at - 1, at, at + 1]), -freq))
            symbols[at] = self.result[step[at]]
            fresh = np.zeros(len(symbols), dtype=bool)
            fresh[at] = True
            left = np.ones(len(symbols), dtype=bool)
            left[at + 1] = False
            owner, symbols, step, fresh = owner[left], symbols[left], step[left], np.flatnonzero(fresh[left])
            if changes is not None:
                moved.append(self._pairs(symbols, owner, step, np.concatenate([fresh - 1, fresh]), freq))
            last = best
        if changes is not None and moved:
            key, step, n = (np.concatenate(x) for x in zip(*moved))
            summed = pa.table({"key": key, "step": step, "n": n}).group_by(["key", "step"]).aggregate([("n", "sum")])
            summed = summed.filter(pc.not_equal(summed.column("n_sum"), 0))
            key = summed.column("key").to_numpy()
            a, b = (names.take(pa.array(x)) for x in (key >> 32, key & 0xFFFFFFFF))
            columns = [a, b, summed.column("step").cast(pa.int32()), summed.column("n_sum")]
            changes.append(pa.table(columns, schema=_CHANGES))
        owner, symbols = (np.concatenate(x) for x in zip(*done)) if done else (np.empty(0, np.int64), np.empty(0, np.int64))
        order = np.argsort(owner, kind="stable")
        return _joined(symbols[order], np.bincount(owner, minlength=len(lengths)), names)

    @staticmethod
    def _pairs(symbols: np.ndarray, owner: np.ndarray, step: np.ndarray, at: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, ...]:
        """Key, place and frequency of the neighbours that begin at some places, each once."""
        taken = np.zeros(len(symbols) + 1, dtype=bool)
        taken[at] = True
        at = np.flatnonzero(taken[: len(symbols) - 1] & (owner[1:] == owner[:-1]))
        return symbols[at] << 32 | symbols[at + 1], step[at], freq[owner[at]]

    def fold_batch(self, batch: pa.RecordBatch, changes: list[pa.Table] | None = None) -> pa.RecordBatch:
        """``freq, symbols`` after all merges; the few long words are folded one at a time."""
        long = pc.greater_equal(pc.count_substring(batch.column("symbols"), SEPARATOR), LONG_WORD)
        short = batch.filter(pc.invert(long))
        folded = [self.fold(short.column("symbols"), short.column("freq").to_numpy(), changes)]
        freq, longer, found = batch.filter(long).column("freq"), [], {}
        for symbols, n in zip(batch.filter(long).column("symbols").to_pylist(), freq.to_pylist()):
            longer.append(SEPARATOR.join(fold(symbols.split(SEPARATOR), self.places, found, n)))
        rows = [{"a": a, "b": b, "step": step, "n": n} for (a, b, step), n in found.items() if n]
        if changes is not None and rows:
            changes.append(pa.Table.from_pylist(rows, schema=_CHANGES))
        columns = [pa.concat_arrays([short.column("freq"), freq]), pa.concat_arrays([*folded, pa.array(longer, pa.string())])]
        return pa.RecordBatch.from_arrays(columns, ["freq", "symbols"])


def _try_merges(words: DataFrame, merges: list[Pair]) -> DataFrame:
    """Change of pair counts at every step, summed over all words; only words that hold a pair are folded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Merges(merges)
        for batch in batches:
            changes: list[pa.Table] = []
            known.fold_batch(batch.select(["freq", "symbols"]), changes)
            for part in changes:
                yield from part.to_batches()

    changed = words.mapInArrow(run, CHANGE_SCHEMA)
    return changed.groupBy("a", "b", "step").agg(F.sum("n").alias("n"))


def _merge_words(words: DataFrame, merges: list[Pair]) -> DataFrame:
    """The words after the merges; those of one symbol have no pair any more and go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Merges(merges)
        for batch in batches:
            yield known.fold_batch(batch.select(["freq", "symbols"]))

    return words.mapInArrow(run, "freq bigint, symbols string").filter(F.col("symbols").contains(SEPARATOR))


def _rows(df: DataFrame, *columns: str) -> Iterator[tuple]:
    """A bounded result's rows, brought to the driver by column."""
    found = df.select(*columns).toArrow()
    return zip(*(found.column(c).to_pylist() for c in columns))


def train_bpe(
    df: DataFrame,
    text: ColumnOrName,
    vocabulary_size: int = VOCABULARY_SIZE,
    min_freq: int = MIN_FREQUENCY,
    specials: list[str] = SPECIAL_TOKENS,
    max_merges: int | None = None,
    normalise: bool = False,
) -> Vocabulary:
    """Byte-pair merges from a corpus (ties: lower pair first), as one-by-one training makes them.

    The corpus is read once and shrinks to stored tables of distinct words and of pair counts.
    A round takes the most frequent pairs and cuts all words where two neighbours are none of them:
    until the least of these pairs is the best, merges fall into the stretches between the cuts, which
    are few after equal ones are summed up.  The merges worked out from them are folded into all words,
    which gives the exact change of every pair's count at every step, and are kept
    up to the first that was not the most frequent pair of its step.  Counts are carried on by
    their changes.  The driver holds ``GUESS_WORDS`` stretches, ``TOP_PAIRS`` pairs and the
    changes of pairs that can come among the best; all characters of the corpus are kept,
    their number is bounded by the code points there are.  ``normalise`` applies NFKC first.
    """
    # The rounds work on this table only; deal it out so that every core has a share.
    cores = df.sparkSession.sparkContext.defaultParallelism
    counted = word_counts(df, nfkc(text) if normalise else text).repartition(cores, "word")
    words, words_path = store(counted.select("freq", _symbols(F.col("word")).alias("symbols")), "words")
    alphabet = [
        r["c"] for r in words.select(F.explode(F.array_distinct(F.split("symbols", SEPARATOR))).alias("c")).distinct().collect()
    ]
    vocabulary = Vocabulary([*specials, *sorted(set(alphabet) - set(specials))])
    limit = min(vocabulary_size - len(vocabulary.tokens), max_merges if max_merges is not None else vocabulary_size)
    known = set(vocabulary.tokens)
    if limit > 0:
        pairs, pairs_path = store(_pair_counts(words), "pairs")
    attempt = TRIED if words.count() <= GUESS_WORDS else min(TRIED, FIRST_TRIED)
    while len(vocabulary.merges) < limit:
        top = pairs.filter(F.col("n") >= min_freq).orderBy(F.col("n").desc(), "a", "b").limit(TOP_PAIRS).collect()
        if not top:
            break
        exact = {(r["a"], r["b"]): r["n"] for r in top}
        floor = top[-1]["n"] if len(top) == TOP_PAIRS else min_freq - 1
        while True:
            live = {(r["a"], r["b"]) for r in top[:attempt]}
            stretches, stretches_path = store(live_stretches(words, live), "stretches")
            if attempt <= LEAST_TRIED or stretches.count() <= GUESS_WORDS:
                break
            drop_stored(df.sparkSession, stretches_path)
            attempt = max(LEAST_TRIED, attempt // 2)
        frequent = stretches.orderBy(F.desc("freq"), "symbols").limit(GUESS_WORDS)
        guess = frequent.select("symbols", "freq").toArrow()
        end = top[min(attempt, len(top)) - 1]
        last = (end["n"], (end["a"], end["b"]))
        symbols, freq = guess.column("symbols").combine_chunks(), guess.column("freq").to_numpy()
        tried = guess_merges(symbols, freq, exact, limit - len(vocabulary.merges), min_freq, last)
        changed, changed_path = store(_try_merges(words, tried), "changes")
        # Only pairs that can come among the best at some step.
        up = changed.groupBy("a", "b").agg(F.sum(F.greatest("n", F.lit(0))).alias("up"))
        base = up.join(pairs.withColumnRenamed("n", "before"), ["a", "b"], "left").na.fill(0, ["before"])
        reaching = base.filter(F.col("before") + F.col("up") > floor).select("a", "b", "before")
        changes: dict[int, list[tuple[Pair, int]]] = {}
        for a, b, step, n, before in _rows(changed.join(reaching, ["a", "b"]), "a", "b", "step", "n", "before"):
            exact.setdefault((a, b), before)
            changes.setdefault(step, []).append(((a, b), n))
        merges = tried[: confirmed(tried, exact, floor, changes, min_freq)]
        # Merges far beyond a wrong guess are wasted.
        attempt = min(TRIED, max(LEAST_TRIED, 2 * len(merges)))
        vocabulary.merges += merges
        for a, b in merges:
            if a + b not in known:
                known.add(a + b)
                vocabulary.tokens.append(a + b)
        kept = changed.filter(F.col("step") < len(merges)).select("a", "b", "n")
        summed = pairs.unionByName(kept).groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 0")
        new_pairs, new_pairs_path = store(summed, "pairs")
        new_words, new_words_path = store(_merge_words(words, merges), "words")
        # What the new tables replace is read no more.
        for path in (words_path, pairs_path, changed_path, stretches_path):
            drop_stored(df.sparkSession, path)
        words, words_path, pairs, pairs_path = new_words, new_words_path, new_pairs, new_pairs_path
    vocabulary.tokens += [t for t in EXTRA_TOKENS if t not in known]
    return vocabulary


def _sliced(lists: pa.Array) -> Iterator[pa.Array]:
    """Slices of whole rows with at most ``SLICE_PIECES`` elements, or one row."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(lists):
        gone = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, gone + SLICE_PIECES, side="right")))
        yield lists.slice(at, to - at)
        at = to


def _coded(lists: pa.Array, merged: Callable[[str], np.ndarray]) -> pa.Array:
    """Ids of lists of pieces; each distinct piece is looked up once."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    pieces = lists.flatten().dictionary_encode()
    known = [merged(w) for w in pieces.dictionary.to_pylist()]
    sizes = np.array([len(k) for k in known], dtype=np.int64)
    codes = pieces.indices.to_numpy(zero_copy_only=False)
    counts = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(counts)])
    begins = (np.cumsum(sizes) - sizes)[codes]
    flat = np.concatenate([*known, np.empty(0, dtype=np.int32)])
    values = flat[np.repeat(begins - ends[:-1], counts) + np.arange(ends[-1])]
    offsets = ends[np.concatenate([[0], np.cumsum(lengths)])]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def encode(text: ColumnOrName, vocabulary: Vocabulary, normalise: bool = False) -> Column:
    """Token ids of a text: pieces are cut by the engine, each distinct one of a slice of an Arrow batch is merged once."""
    ids = vocabulary.ids
    places = _places(vocabulary.merges)
    unknown = ids.get(UNKNOWN, 0)

    @F.arrow_udf("array<int>")
    def to_ids(pieces: pa.Array) -> pa.Array:
        @lru_cache(maxsize=CACHED_WORDS)
        def merged(word: str) -> np.ndarray:
            symbols = fold(list(word), places) if places else word
            return np.array([ids.get(s, unknown) for s in symbols], dtype=np.int32)

        parts = [_coded(part, merged) for part in _sliced(pieces)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return to_ids(pretokenize(nfkc(text) if normalise else text))
