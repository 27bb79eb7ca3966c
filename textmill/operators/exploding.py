"""Explode computed arrays without evaluating them twice.

For a plain explode the optimizer adds a ``size(array) > 0`` filter and pushes it
down to the scan, which repeats the whole array expression there.  The outer forms
get no such filter; the position tells an empty array from a real element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_items(df: DataFrame, keys: list[str | Column], items: Column, item: str, pos: str = "pos") -> DataFrame:
    """Keys, position and element of every array element."""
    rows = df.select(*keys, F.posexplode_outer(items).alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())


def explode_structs(df: DataFrame, keys: list[str | Column], items: Column) -> DataFrame:
    """Keys and the fields of every struct element."""
    rows = explode_items(df, keys, items, "_item", "_pos")
    names = [k for k in rows.columns if k not in ("_pos", "_item")]
    return rows.select(*names, "_item.*")


def built_rows(df: DataFrame, keys: list[str | Column], row: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Keys and the fields of a computed struct, for the rows whose struct passes ``keep``.

    The test runs on the built struct.  A plain filter on its fields would be pushed
    down and evaluate the long expressions a second time.
    """
    return explode_structs(df, keys, F.filter(F.array(row), keep))
