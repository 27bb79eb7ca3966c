"""Language identification with bit-sliced Bloom filters over character n-grams.

A slot of the filter holds one bit for each language.  An n-gram sets, in each language it
belongs to, the bit of its slots; the AND of its slots gives all languages that may contain
it.  A text's hits per language are counted over its n-grams and corrected for the share
of bits that are set anyway, ``(hits/n - f) / (1 - f)``; the largest estimate decides.

Texts are lower-cased, runs of other characters than letters become one blank.  Training
reads a sample of about ``SAMPLE`` texts of each language (all, if there are fewer); the
filter has a fixed number of slots, so what is collected and broadcast is bounded.
Prediction reads every row and its whole text.  Null texts and texts without a letter are
``und`` with score 0; ties go to the language with more training texts, then by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.flat import pieces, points
from textmill.session import cut_lineage

GRAM = 4
SLOT_BITS = 21
SAMPLE = 1500
MIN_COUNT = 2
# An n-gram belongs to a language if its rate there is at least this share of its highest rate.
RATE_SHARE = 0.05
MAX_LANGUAGES = 64
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(texts: list[str], letters: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts and the text number of each."""
    flat, owner = points([t.lower() for t in texts], "  ", "  ")
    codes = np.where(letters[flat], flat, 32).astype(np.uint64)
    blank = codes == 32
    keep = np.ones(len(codes), dtype=bool)
    # A run of blanks inside a text becomes one; a text keeps two at its start.
    keep[2:] = ~(blank[2:] & blank[1:-1] & (owner[2:] == owner[:-2]) & (owner[2:] == owner[1:-1]))
    codes, owner = codes[keep], owner[keep]
    m = len(codes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    value = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        value = (value ^ codes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    inside = owner[:m] == owner[n - 1 :]
    return value[inside], owner[:m][inside]


def slots(values: np.ndarray, bits: int = SLOT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The two slots of each n-gram."""
    mask = np.uint64((1 << bits) - 1)
    return (values & mask).astype(np.int64), ((values >> np.uint64(40)) & mask).astype(np.int64)


@dataclass
class Model:
    """Languages (more training texts first), the filter and its filled shares."""

    languages: list[str]
    table: np.ndarray
    filled: np.ndarray
    letters: np.ndarray


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold that training leaves out; null keys do not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def unit(key: Column) -> Column:
    """Repeatable number in [0, 1) from a key."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 11) / F.lit(float(1 << 53))


def fit(df: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> Model:
    """Train on the rows of ``df`` with a text and a label."""
    spark = df.sparkSession
    rows = df.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")
    )
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["label"] for r in counts]
    number = {name: i for i, name in enumerate(languages)}
    share = spark.createDataFrame([(r["label"], min(1.0, sample / r["count"])) for r in counts], "label string, share double")
    chosen = rows.join(F.broadcast(share), "label").filter(unit(F.col("key")) < F.col("share")).select("label", "text")

    letters = spark.sparkContext.broadcast(letter_table())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            for owners, held in pieces(batch.column(1).to_pylist()):
                values, owner = grams(held, letters.value)
                language = names[owners][owner]
                for one in np.unique(language):
                    found, n = np.unique(values[language == one], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), one)), pa.array(found.view(np.int64)), pa.array(n)],
                        names=["language", "gram", "n"],
                    )

    counted = chosen.mapInArrow(count, "language long, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    stored = cut_lineage(counted, "gram-counts")
    totals = stored.groupBy("language").agg(F.sum("n").alias("total"))
    rated = stored.join(F.broadcast(totals), "language").withColumn("rate", F.col("n") / F.col("total"))
    highest = rated.groupBy("gram").agg(F.max("rate").alias("highest"))
    kept = rated.join(highest, "gram").filter((F.col("n") >= MIN_COUNT) & (F.col("rate") >= RATE_SHARE * F.col("highest")))
    masks = kept.groupBy("gram").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("language").cast("int"))).alias("mask"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = batch.column(1)
            for places in slots(batch.column(0).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(places), mask], names=["slot", "mask"])

    # At most one row for each slot of the filter.
    filled = masks.mapInArrow(fill, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    table = np.zeros(1 << SLOT_BITS, dtype=kind)
    table[filled.column("slot").to_numpy()] = filled.column("mask").to_numpy().view(np.uint64).astype(kind)
    share_set = np.array([np.mean((table >> kind(i)) & kind(1)) for i in range(len(languages))])
    return Model(languages, table, share_set**2, letters.value)


def estimates(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Corrected shares (texts x languages) and the number of n-grams of each text."""
    hits = np.zeros((len(texts), len(model.languages)))
    total = np.zeros(len(texts))
    for numbers, held in pieces(texts):
        values, owner = grams(held, model.letters)
        first, second = slots(values)
        found = model.table[first] & model.table[second]
        owner = numbers[owner]
        total += np.bincount(owner, minlength=len(texts))
        for i in range(len(model.languages)):
            hits[:, i] += np.bincount(owner[(found >> found.dtype.type(i)) & found.dtype.type(1) == 1], minlength=len(texts))
    n = np.maximum(total, 1)[:, None]
    return (hits / n - model.filled) / np.maximum(1 - model.filled, 1e-9), total


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; the text column is dropped, columns of these names are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema

    passed = [c for c in df.columns if c not in (text, "lang_pred", "score")]
    schema = T.StructType(
        [*[df.schema[c] for c in passed], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    arrow, shared = to_arrow_schema(schema), df.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known.languages:
                shares, _ = estimates(known, texts)
                # Padding makes n-grams of blanks; only texts with a letter are judged.
                lettered = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
                best = shares.argmax(axis=1)
                scores = np.where(lettered, np.clip(shares.max(axis=1), 0, 1), 0.0)
                names = [known.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            columns = [batch.column(c) for c in passed] + [pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.select(*[F.col(f"`{c}`") for c in passed], F.col(text).alias("_text")).mapInArrow(run, schema)
