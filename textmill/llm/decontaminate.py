"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased.  Each test item gives the ``GRAM``-word
n-grams that are the rarest of ``WINDOW`` neighbours, by their count over all passages, so
a copied run of GRAM + WINDOW - 1 words always holds a seed.  A passage that has a seed is
aligned with the item around it; the best local score (match 2, mismatch -1, gap -1) over
the score of a perfect copy must reach ``THRESHOLD``.

Items are a stated query set: they are read in blocks of at most ``BLOCK_GRAMS`` n-grams,
and each block is shipped to the tasks as one automaton, so what a task holds is bounded
whatever the benchmark's size.  Passages are scanned where they lie, without a shuffle.

Null and empty texts match nothing; an item with fewer words than an n-gram seeds with
all its words.  Repeated rows give repeated results; extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAM = 3
WINDOW = 3
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_GRAMS = 100_000
#: Passages that are Python strings at a time.
ROWS_AT_ONCE = 512


def plain(text: Column) -> Column:
    """Lower-cased words with one blank before, between and after them."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def item_grams(words: list[str], n: int = GRAM) -> list[str]:
    if len(words) <= n:
        return [" ".join(words)] if words else []
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def rare_seeds(grams: list[str], counts: dict[str, int], window: int = WINDOW) -> list[int]:
    """Positions of the n-grams that are the rarest of a window (first of equals)."""
    rank = [(counts.get(g, 0), i) for i, g in enumerate(grams)]
    last = max(0, len(grams) - window)
    return sorted({min(rank[i : i + window])[1] for i in range(last + 1)}) if grams else []


def _best_cell(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """Best Smith-Waterman score of two word lists, and the first cell (words of ``a``, words of ``b``) that has it."""
    numbers: dict[str, int] = {}
    x = np.array([numbers.setdefault(w, len(numbers)) for w in a])
    y = np.array([numbers.setdefault(w, len(numbers)) for w in b])
    ramp = -GAP * np.arange(len(y) + 1)
    row = np.zeros(len(y) + 1, dtype=np.int64)
    best = (0, 0, 0)
    for used, w in enumerate(x, 1):
        step = np.maximum(row[:-1] + np.where(y == w, MATCH, MISMATCH), row[1:] + GAP)
        row = np.concatenate([[0], np.maximum(step, 0)])
        # Gaps along the row: the running maximum of score + distance.
        row = np.maximum(row, np.maximum.accumulate(row + ramp) - ramp)
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), used, at)
    return best


def local_score(a: list[str], b: list[str]) -> tuple[int, int]:
    """Best Smith-Waterman score of two word lists and where it ends in ``b``."""
    score, _, end = _best_cell(a, b)
    return score, end


def local_span(a: list[str], b: list[str]) -> tuple[int, int, int]:
    """Best score, and the first and end word of its alignment in ``b``.

    The first best cell is the only one of the prefixes it ends, so the best alignment of the
    reversed prefixes begins in it and ends where the alignment begins.
    """
    score, used, end = _best_cell(a, b)
    return score, end - _best_cell(a[:used][::-1], b[:end][::-1])[2], end


def _automaton(phrases: list[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for i, phrase in enumerate(phrases):
        machine.add_word(f" {phrase} ", i)
    machine.make_automaton()
    return machine


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, len(b), ROWS_AT_ONCE))


def gram_counts(passages: DataFrame, grams: list[str], text: str) -> dict[str, int]:
    """How often each n-gram occurs in all passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, found = _automaton(grams), np.zeros(len(grams), dtype=np.int64)
        for batch in _sliced(batches):
            for value in batch.column(0).to_pylist():
                for _, i in machine.iter(value):
                    found[i] += 1
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], names=["gram", "n"])

    counted = passages.select(plain(F.col(text)).alias("t")).mapInArrow(count, "gram long, n long")
    # One row for each n-gram of the block at most.
    return {grams[r["gram"]]: r["n"] for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def _align(words: list[str], anchors: list[int], item: list[str], threshold: float = THRESHOLD) -> tuple[float, int, int]:
    """Best score around the anchors (places where the item would begin): score, first and end word."""
    reach = len(item) // 2 + 2
    spans: list[list[int]] = []
    for at in sorted(anchors):
        low, high = max(0, at - reach), min(len(words), at + len(item) + reach)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    best = (0.0, 0, 0)
    known = set(item)
    for low, high in spans:
        # Merged spans can be long; they are aligned in overlapping pieces.
        for begin in range(low, high, 4 * len(item) + 64):
            piece = words[begin : min(high, begin + 8 * len(item) + 128)]
            shared = sum(w in known for w in piece)
            # A score is at most that of a match for every shared word.
            if shared < threshold * len(item):
                continue
            score, first, end = local_span(item, piece)
            share = score / (MATCH * len(item))
            if share > best[0]:
                best = (share, begin + first, begin + end)
    return best


def _block_matches(passages: DataFrame, items: list[tuple], key: str, text: str, threshold: float) -> DataFrame:
    """Matches of one block of items (id, words)."""
    grams = {i: item_grams(words) for i, (_, words) in enumerate(items)}
    counts = gram_counts(passages, sorted(set().union(*map(set, grams.values()))), text)
    seeds: dict[str, list[tuple[int, int]]] = {}
    for i, own in grams.items():
        for at in rare_seeds(own, counts):
            seeds.setdefault(own[at], []).append((i, at))
    phrases = sorted(seeds)
    shared = passages.sparkSession.sparkContext.broadcast((phrases, [seeds[p] for p in phrases], items))
    schema = T.StructType(
        [
            passages.schema[key],
            T.StructField("item", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("end_word", T.LongType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, places, items = shared.value
        machine = _automaton(phrases)
        lengths = [len(p) + 1 for p in phrases]
        for batch in _sliced(batches):
            rows, found = [], []
            for r, value in enumerate(batch.column(1).to_pylist()):
                hits = [(end - lengths[i], i) for end, i in machine.iter(value)]
                if not hits:
                    continue
                words = value.split()
                begins = np.array([m.start() for m in re.finditer(" (?! |$)", value)])
                anchors: dict[int, list[int]] = {}
                for start, i in hits:
                    word = int(np.searchsorted(begins, start))
                    for item, at in places[i]:
                        anchors.setdefault(item, []).append(word - at)
                for item, where in anchors.items():
                    score, first, end = _align(words, where, items[item][1], threshold)
                    if score >= threshold:
                        rows.append(r)
                        found.append((item, score, first, end))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return passages.select(F.col(key), plain(F.col(text)).alias("_t")).mapInArrow(scan, schema)


def matches(
    passages: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each passage and item that align: ``key, item_id, score, first_word, end_word``."""
    spark = passages.sparkSession
    block, size = [], 0
    listed = benchmark.select(item_key, plain(F.col(item_text)).alias("t")).orderBy(item_key)
    out = []

    def close() -> None:
        nonlocal block, size
        if block:
            found = _block_matches(passages, [(i, w) for i, (_, w) in enumerate(block)], key, text, threshold)
            ids = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(block)], T.StructType([T.StructField("item", T.LongType()), benchmark.schema[item_key]]))
            # As many rows as the block has items.
            out.append(found.join(F.broadcast(ids), "item").select(key, item_key, "score", "first_word", "end_word"))
        block, size = [], 0

    for row in listed.toLocalIterator():
        words = row["t"].split()
        if words:
            block.append((row[item_key], words))
            size += len(words)
        if size >= BLOCK_GRAMS:
            close()
    close()
    if not out:
        empty = T.StructType([passages.schema[key], benchmark.schema[item_key], T.StructField("score", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, out)
