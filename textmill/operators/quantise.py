"""Number-range compression of embedding tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_point_state(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row ``struct(scale, zero_point)`` over the whole table, reduced inside rows first."""
    return df.agg(
        F.struct(
            ((F.max(F.array_max(vector)).cast("double") - F.min(F.array_min(vector)).cast("double")) / 255.0).alias("scale"),
            F.min(F.array_min(vector)).cast("double").alias("zero_point"),
        ).alias("state")
    )


def quantize_zero_point(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Vectors as integers 0..255 (truncated), with the state needed to go back."""
    stated = df.withColumn("state", zero_point_state(df, vector).scalar())
    scale, low = F.col("state.scale"), F.col("state.zero_point")

    def one(x: Column) -> Column:
        level = F.when(scale > 0, (x.cast("double") - low) / scale).otherwise(0.0)
        return F.least(F.greatest(level, F.lit(0.0)), F.lit(255.0)).cast("int")

    return stated.withColumn(vector, F.transform(vector, one))


def dequantize_zero_point(df: DataFrame, vector: str = "embedding", state: str = "state") -> DataFrame:
    return df.withColumn(
        vector, F.transform(vector, lambda q: q * F.col(f"{state}.scale") + F.col(f"{state}.zero_point"))
    )


def quantize_tensor(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Symmetric int8 with one scale for the whole table."""
    top = df.agg(
        (F.max(F.array_max(F.transform(vector, F.abs))).cast("double") / 127.0).alias("scale")
    )
    scaled = df.withColumn("scale", top.scalar())
    return scaled.withColumn(
        vector,
        F.transform(
            vector,
            lambda x: F.when(F.col("scale") > 0, F.rint(x.cast("double") / F.col("scale"))).otherwise(0.0).cast("int"),
        ),
    )
