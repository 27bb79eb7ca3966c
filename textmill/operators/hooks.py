"""User functions over batches: generation, scoring, embedding, grading.

A hook takes a *loader*: a function without arguments that returns the model call.
It runs once per task, inside the executor, so models never travel with the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.prompts import parse_verdict
from textmill.functions.vectors import l2_normalise

TextFn = Callable[..., list]
Loader = Callable[[], TextFn]
BATCH = 256


def map_batches(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """Apply a pandas-frame function to every batch."""
    return df.mapInPandas(lambda frames: (fn(frame) for frame in frames), schema)


def prepare_where(df: DataFrame, where: Column | Callable) -> DataFrame:
    """Row predicate: a Column, or a function from a pandas frame to a boolean series.

    The function sees a whole batch; a missing answer drops its row, as null does in a Column.
    """
    if isinstance(where, Column):
        return df.filter(where)

    @F.pandas_udf("boolean")
    def keep(rows: pd.DataFrame) -> pd.Series:
        answers = where(rows)
        if not isinstance(answers, pd.Series) or len(answers) != len(rows):
            raise TypeError("the predicate must return one boolean a row, as a series")
        return answers.astype("boolean").fillna(False).astype(bool)

    return df.filter(keep(F.struct(*df.columns)))


def call_model(
    df: DataFrame, load: Loader, inputs: list[str], out: str, out_type: T.DataType, batch: int = BATCH
) -> DataFrame:
    """Append ``out`` = model(inputs) in batches of ``batch`` rows; no shuffle."""
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, out_type)])
    arrow_type = _arrow_type(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                rows = whole.slice(at, batch)
                answers = model(*(rows[c].to_pylist() for c in inputs))
                columns = [rows[c] for c in kept] + [pa.array(answers, arrow_type)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, out])

    return df.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return {
        T.StringType(): pa.string(),
        T.DoubleType(): pa.float64(),
        T.FloatType(): pa.float32(),
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.BooleanType(): pa.bool_(),
    }[t]


def generate(df: DataFrame, load: Loader, prompt: str = "prompt", out: str = "generation", batch: int = BATCH) -> DataFrame:
    return call_model(df, load, [prompt], out, T.StringType(), batch)


def score_pairs(df: DataFrame, load: Loader, left: str, right: str, out: str = "score", batch: int = BATCH) -> DataFrame:
    return call_model(df, load, [left, right], out, T.DoubleType(), batch)


def embed(df: DataFrame, load: Loader, text: str, out: str = "embedding", normalise: bool = True, batch: int = BATCH) -> DataFrame:
    vectors = call_model(df, load, [text], out, T.ArrayType(T.DoubleType()), batch)
    return vectors.withColumn(out, l2_normalise(out)) if normalise else vectors


def grade(
    df: DataFrame, load: Loader, inputs: list[str], out: str = "grade", field: str = "score", batch: int = BATCH
) -> DataFrame:
    """The model answers with a JSON verdict; ``out`` is its lower-cased field."""
    return call_model(df, load, inputs, out, T.StringType(), batch).withColumn(out, parse_verdict(out, field))


def build_preference(prompts: DataFrame, load: Loader, prompt: str = "prompt", chosen: str = "chosen") -> DataFrame:
    """Preference rows whose rejected side a model generates: no join, the row carries both."""
    return generate(prompts, load, prompt, "rejected").select(
        *[c for c in prompts.columns if c not in (prompt, chosen)],
        F.col(prompt).alias("prompt"),
        F.col(chosen).alias("chosen"),
        "rejected",
    )


def join_preference(prompts: DataFrame, generations: DataFrame, key: str) -> DataFrame:
    """Preference rows from a stored table of generations."""
    return prompts.join(generations.select(key, F.col("generation").alias("rejected")), key)
