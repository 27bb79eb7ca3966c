"""Vector arithmetic on ``array<float>`` columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import ColumnOrName, col, let


def _doubles(c: ColumnOrName) -> Column:
    return col(c).cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    return _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def norm(a: ColumnOrName) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Cosine similarity; null when a vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def l2_normalise(a: ColumnOrName) -> Column:
    """Unit vector; a zero vector stays zero."""
    # Bound first: a computed vector would be computed again for its length.
    return let(
        _doubles(a),
        lambda v: let(norm(v), lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(x))),
    )


def l2_distance(a: ColumnOrName, b: ColumnOrName) -> Column:
    squares = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(_total(squares))


def letter_vector(c: ColumnOrName, letters: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Letter-frequency vector, unit length: a model-free embedding (ASCII letters).

    The engine lower-cases; the bytes of a text are counted in one pass, as in UTF-8 a letter
    is no part of another character.
    """
    places = np.frombuffer(letters.encode("ascii"), dtype=np.uint8)
    # A null text has a vector of nulls.
    unknown = [None] * len(letters)

    @F.arrow_udf("array<int>")
    def counts(texts: pa.Array) -> pa.Array:
        rows = (
            np.bincount(np.frombuffer(t.as_buffer(), dtype=np.uint8), minlength=256)[places] if t.is_valid else unknown
            for t in texts
        )
        return pa.array(rows, pa.list_(pa.int32()))

    return l2_normalise(counts(F.lower(col(c))))


def quantize_groups(a: ColumnOrName, group: int = 8) -> Column:
    """Symmetric int8 groups: scale = max|x| / 127 per ``group`` values.

    Returns ``array<struct<scale double, q array<int>>>``.
    """

    def one(part: Column) -> Column:
        scale = F.array_max(F.transform(part, F.abs)) / 127.0
        return let(
            scale,
            lambda s: F.struct(
                s.alias("scale"),
                F.transform(part, lambda x: F.when(s > 0, F.rint(x / s)).otherwise(0.0).cast("int")).alias("q"),
            ),
        )

    def groups(values: Column) -> Column:
        last = F.ceil(F.size(values) / F.lit(group)).cast("int") - 1
        index = F.when(last < 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last))
        return F.transform(index, lambda g: let(F.slice(values, g * group + 1, group), one))

    return let(_doubles(a), groups)


def dequantize_groups(c: ColumnOrName) -> Column:
    return F.flatten(
        F.transform(col(c), lambda g: F.transform(g["q"], lambda q: q * g["scale"]))
    )
