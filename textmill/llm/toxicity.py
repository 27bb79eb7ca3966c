"""Toxicity scores: a support vector machine over a subsequence string kernel with Nyström landmarks.

Kernel: two strings are as alike as the three-letter subsequences they share, each
occurrence weighted by ``DECAY ** span``.  Letters need not be adjacent (span up to ``SPAN``),
so gapped and padded spellings ("i.d.i.o.t", "idxiot") stay close to the plain word.
Characters other than letters are skipped; look-alike digits and signs count as letters.

A text's units are its words; single characters in a row ("i d i o t") are one unit, and
runs of more than two ``UNIT`` letters are read in windows of that length, one every ``UNIT`` letters,
so what spans ``UNIT`` letters at most (a landmark has 20) is whole in one of them.  Features are, for each landmark, the
largest kernel value of any unit, relative to the landmark's own; the landmarks' kernel
matrix to the power -1/2 maps them to the Nyström space where a linear machine is trained.

Landmarks are the words that tell toxic from other sentences best, no two of them alike.
Training takes about ``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` labelled texts (all, if there are
fewer); scoring reads every row and its whole text.  Null and empty texts score like a
text without any landmark.  Without both labels every score is the share of toxic labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.flat import pieces, points
from textmill.llm.language_id import unit
from textmill.session import cut_lineage

SPAN = 6
DECAY = 0.6
UNIT = 32
# Characters that two pieces of a very long text share.
SEAM = 4096
#: Letters scored at once, and rows a batch that goes back; some twenty arrays of this length are held.
SLICE_POINTS = 1 << 18
ROWS_AT_ONCE = 512
LANDMARKS = 48
CANDIDATES = 600
ALIKE = 0.75
# Kernel values below this count as none.
FLOOR = 0.5
TOXIC_SAMPLE = 3000
CLEAN_SAMPLE = 9000
SYMBOLS = 64
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_CODES: np.ndarray | None = None


def _codes() -> np.ndarray:
    """Symbol of every code point: 0 none, 1 to 26 the letters a to z, the rest shared by other letters."""
    global _CODES
    if _CODES is None:
        table = np.zeros(0x110000, dtype=np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c) - 96 if "a" <= c <= "z" else 27 + i % (SYMBOLS - 27)
        for sign, letter in LOOK_ALIKES.items():
            table[ord(sign)] = ord(letter) - 96
        _CODES = table
    return _CODES


def units(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, the unit of each symbol, and the text of each unit."""
    flat, owner = points([t.lower() for t in texts], "", " ")
    blank = (flat == 32) | ((flat >= 9) & (flat <= 13)) | (flat == 0xA0)
    # A blank between two single characters belongs to a spaced-out word.
    single = np.zeros(len(flat), dtype=bool)
    single[1:-1] = ~blank[1:-1] & blank[:-2] & blank[2:]
    if len(flat) > 1:
        single[0] = not blank[0] and blank[1]
    single &= codes[flat] > 0
    inner = np.zeros(len(flat), dtype=bool)
    inner[1:-1] = blank[1:-1] & single[:-2] & single[2:] & (owner[:-2] == owner[2:])
    border = blank & ~inner
    # Only letters count; signs between them are no distance.
    keep = ~border & (codes[flat] > 0)
    run, owner = np.cumsum(border)[keep], owner[keep]
    if not len(run):
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    size = np.diff(np.append(first, len(run)))
    # A long run is read in windows of two units that begin a unit apart.
    count = np.maximum(1, -(-size // UNIT) - 1)
    window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(first, count) + window * UNIT
    length = np.minimum(2 * UNIT, np.repeat(first + size, count) - begin)
    at = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
    return codes[flat[keep]][at], np.repeat(np.arange(len(begin)), length), owner[begin]


def subsequences(symbols: np.ndarray, unit_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap pattern: feature numbers, where they begin, and their weight."""
    code = symbols.astype(np.int32)
    n = len(code)
    for last in range(2, SPAN):
        m = n - last
        if m <= 0:
            return
        inside = (unit_of[:m] == unit_of[last:]) & (code[:m] > 0) & (code[last:] > 0)
        at = np.flatnonzero(inside)
        head, tail = code[at] * (SYMBOLS * SYMBOLS), code[at + last]
        for middle in range(1, last):
            between = code[at + middle]
            ok = between > 0
            yield (head + between * SYMBOLS + tail)[ok], at[ok], DECAY ** (last + 1)


@dataclass
class Landmarks:
    """Words with their weighted subsequences: ``row[feature]`` is a row of ``weights`` (row 0: none)."""

    words: list[str]
    row: np.ndarray
    weights: np.ndarray
    own: np.ndarray
    codes: np.ndarray


def landmarks(words: list[str]) -> Landmarks:
    profiles = []
    codes = _codes()
    for word in words:
        symbols, unit_of, _ = units([word], codes)
        profile: dict[int, float] = {}
        for features, _, weight in subsequences(symbols, unit_of):
            for f in features.tolist():
                profile[f] = profile.get(f, 0.0) + weight
        profiles.append(profile)
    features = sorted(set().union(*profiles)) if profiles else []
    row = np.zeros(SYMBOLS**3, dtype=np.int32)
    row[features] = np.arange(1, len(features) + 1)
    weights = np.zeros((len(features) + 1, len(words)), dtype=np.float32)
    for j, profile in enumerate(profiles):
        for f, value in profile.items():
            weights[row[f], j] = value
    own = np.array([max(sum(v * v for v in p.values()), 1e-9) for p in profiles], dtype=np.float32)
    return Landmarks(words, row, weights, own, codes)


def distinct_units(symbols: np.ndarray, unit_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols and unit numbers of the distinct units, and which of them each unit is (by a 64-bit hash)."""
    first = np.flatnonzero(np.concatenate([[True], unit_of[1:] != unit_of[:-1]]))
    place = np.arange(len(symbols)) - np.repeat(first, np.diff(np.append(first, len(symbols))))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(2 * UNIT, 0x9E3779B97F4A7C15, dtype=np.uint64))
        hashes = np.add.reduceat((symbols.astype(np.uint64) + np.uint64(1)) * powers[place], first)
    _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
    number = np.full(len(first), -1)
    number[sample] = np.arange(len(sample))
    kept = number[unit_of]
    inside = kept >= 0
    # Units keep the order of the text, so renumber them by it.
    order = np.argsort(sample)
    rename = np.empty(len(sample), dtype=np.int64)
    rename[order] = np.arange(len(sample))
    return symbols[inside], rename[kept[inside]], rename[which]


def kernel_rows(marks: Landmarks, texts: list[str]) -> np.ndarray:
    """For each text and landmark the largest kernel value of the text's units, at most 1; below ``FLOOR`` it is 0."""
    best = np.zeros((len(texts), len(marks.words)), dtype=np.float32)
    scaled = marks.weights / marks.own
    highest = scaled.max(axis=1)
    for numbers, held in pieces(texts, SLICE_POINTS, SEAM):
        symbols, unit_of, text_of = units(held, marks.codes)
        if not len(text_of):
            continue
        symbols, unit_of, which = distinct_units(symbols, unit_of)
        rows, places, factors = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, np.float32)]
        for features, begin, weight in subsequences(symbols, unit_of):
            row = marks.row[features]
            hit = np.flatnonzero(row)
            rows.append(row[hit])
            places.append(unit_of[begin[hit]])
            factors.append(np.full(len(hit), weight, dtype=np.float32))
        rows, places, factors = np.concatenate(rows), np.concatenate(places), np.concatenate(factors)
        # No landmark's value can exceed this sum, so most units need no exact values.
        bound = np.bincount(places, weights=factors * highest[rows], minlength=int(which.max()) + 1)
        near = np.flatnonzero(bound >= FLOOR)
        if not len(near):
            continue
        slot = np.full(len(bound), -1)
        slot[near] = np.arange(len(near))
        use = slot[places] >= 0
        rows, places, factors = rows[use], slot[places[use]], factors[use]
        order = np.argsort(places, kind="stable")
        rows, places, factors = rows[order], places[order], factors[order]
        values = np.zeros((len(near), len(marks.words)), dtype=np.float32)
        cuts = np.searchsorted(places, np.arange(0, len(near) + 4096, 4096))
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                part = places[low:high]
                first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                values[part[first]] = np.add.reduceat(scaled[rows[low:high]] * factors[low:high, None], first, axis=0)
        values = np.where(values < FLOOR, 0, np.minimum(values, 1))
        slot[near[values.max(axis=1) == 0]] = -1
        met = np.flatnonzero(slot[which] >= 0)
        if len(met):
            owner = numbers[text_of[met]]
            cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            largest = np.maximum.reduceat(values[slot[which[met]]], cut, axis=0)
            np.maximum.at(best, owner[cut], largest)
    return best


def choose_landmarks(words: list[str], count: int = LANDMARKS) -> Landmarks:
    """The first ``count`` words of which no two are alike."""
    marks = landmarks(words)
    scale = np.sqrt(marks.own)
    gram = (marks.weights.T @ marks.weights) / scale[:, None] / scale[None, :]
    chosen: list[int] = []
    for i in range(len(words)):
        if len(chosen) < count and (not chosen or gram[i, chosen].max() < ALIKE):
            chosen.append(i)
    return landmarks([words[i] for i in chosen])


def nystrom(marks: Landmarks) -> np.ndarray:
    """The landmarks' normalised kernel matrix to the power -1/2."""
    scale = np.sqrt(marks.own)
    gram = (marks.weights.T @ marks.weights) / scale[:, None] / scale[None, :]
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    return (vectors / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T


@dataclass
class Model:
    marks: Landmarks | None
    direction: np.ndarray  # weights on kernel values: Nyström map and machine in one
    offset: float
    slope: float  # of the logistic curve over the machine's margin
    base: float

    def scores(self, texts: list[str]) -> np.ndarray:
        margin = kernel_rows(self.marks, texts).astype(np.float64) @ self.direction + self.offset if self.marks else np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.base, -30, 30)))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the texts of ``df`` that ``labels`` (one row a key; of repeated keys the largest label counts) marks."""
    spark = df.sparkSession
    marked = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        rate = toxic / max(1, toxic + clean)
        return Model(None, np.empty(0), 0.0, 0.0, float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))))
    share = F.when(F.col("label") == 1, min(1.0, TOXIC_SAMPLE / toxic)).otherwise(min(1.0, CLEAN_SAMPLE / clean))
    ids = marked.filter(unit(F.col("key")) < share)
    # The expected number of rows is TOXIC_SAMPLE + CLEAN_SAMPLE at most, so this broadcast is bounded.
    sample = cut_lineage(
        df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(ids), "key").select("text", F.col("label").cast("double").alias("label")),
        "labelled",
    )
    n = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    words = sample.select(
        "label", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,20}"), F.lit(0)))).alias("word")
    )
    seen = words.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    pooled = (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    gain = (F.col("toxic") / n_toxic - F.col("clean") / n_clean) / F.sqrt(pooled * (1 - pooled) + 1e-9)
    best = seen.filter(F.col("toxic") >= 2).select("word", gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(CANDIDATES).collect()
    marks = choose_landmarks([r["word"] for r in best])
    if not marks.words:
        rate = n_toxic / (n_toxic + n_clean)
        return Model(None, np.empty(0), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    whiten = nystrom(marks)
    shared = spark.sparkContext.broadcast((vars(marks), whiten))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, turn = shared.value
        known = Landmarks(**fields)
        for batch in batches:
            rows = kernel_rows(known, batch.column(0).to_pylist()).astype(np.float64) @ turn
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    points_ = cut_lineage(sample.mapInArrow(features, "x array<double>, label double"), "kernel-features")
    train = points_.select(array_to_vector("x").alias("features"), "label")
    machine = LinearSVC(maxIter=60, regParam=1e-3).fit(train)
    direction = machine.coefficients.toArray()
    margin = F.aggregate(
        F.zip_with("x", F.array(*[F.lit(float(v)) for v in direction]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b
    ) + float(machine.intercept)
    curve = LogisticRegression(maxIter=60).fit(points_.select(array_to_vector(F.array(margin)).alias("features"), "label"))
    return Model(marks, whiten @ direction, float(machine.intercept), float(curve.coefficients[0]), float(curve.intercept))


def score(df: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Adds a score and a decision (1 from 0.5 on) under ``names``; all columns pass, those of these names are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema

    passed = [c for c in df.columns if c not in names]
    kinds = (T.DoubleType(), T.IntegerType())
    schema = T.StructType([*[df.schema[c] for c in passed], *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    plain = vars(model) | {"marks": model.marks and vars(model.marks)}
    arrow, shared = to_arrow_schema(schema), df.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        known.marks = known.marks and Landmarks(**known.marks)
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, len(b), ROWS_AT_ONCE)):
            made = known.scores([t or "" for t in batch.column(text).to_pylist()])
            columns = [batch.column(c) for c in passed] + [pa.array(made), pa.array((made >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)
