"""Fixed-length token rows, masks and shifts (all row-local)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import ColumnOrName, col, let

IGNORED_LABEL = -100


def pad_truncate(ids: ColumnOrName, length: int, pad: int) -> Column:
    return F.slice(F.concat(col(ids), F.array_repeat(F.lit(pad), length)), 1, length)


def clip_ids(ids: ColumnOrName, max_ids: int, end: int) -> Column:
    """At most ``max_ids`` tokens, then the end id."""
    return F.concat(F.slice(col(ids), 1, max_ids), F.array(F.lit(end)))


def position_ids(ids: ColumnOrName, end: int) -> Column:
    """Positions that restart after every end token of a packed row."""

    def segments(row: Column) -> Column:
        index = F.when(F.size(row) == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(0), F.size(row) - 1)
        )
        ends = F.transform(F.filter(index, lambda i: F.get(row, i) == end), lambda i: i + 1)
        lengths = F.zip_with(
            F.concat(F.array(F.lit(0)), ends),
            F.concat(ends, F.array(F.size(row))),
            lambda begin, stop: stop - begin,
        )
        filled = F.filter(lengths, lambda n: n > 0)
        return F.flatten(F.transform(filled, lambda n: F.sequence(F.lit(0), n - 1)))

    return let(col(ids), segments)


def loss_mask(ids: ColumnOrName, end: int) -> Column:
    return F.transform(col(ids), lambda x: F.when(x == end, 0).otherwise(1))


def shift_labels(ids: ColumnOrName) -> Column:
    """Next-token targets: inputs without the last id, labels without the first."""
    row = col(ids)
    kept = F.greatest(F.size(row) - 1, F.lit(0))
    return F.struct(F.slice(row, 1, kept).alias("inputs"), F.slice(row, 2, kept).alias("labels"))


def shift_right(labels: ColumnOrName, start: int, pad: int) -> Column:
    """Decoder inputs: start id first, last label dropped, ignored labels padded."""
    row = col(labels)
    head = F.slice(row, 1, F.greatest(F.size(row) - 1, F.lit(0)))
    moved = F.when(F.size(row) > 0, F.concat(F.array(F.lit(start)), head)).otherwise(row)
    return F.transform(moved, lambda x: F.when(x == IGNORED_LABEL, pad).otherwise(x))


def mask_prompt(ids: ColumnOrName, prompt_len: Column) -> Column:
    """Labels that ignore the prompt part."""
    row = col(ids)
    hidden = F.array_repeat(F.lit(IGNORED_LABEL), prompt_len)
    return F.concat(hidden, F.slice(row, prompt_len + 1, F.size(row)))


def answer_mask(type_ids: ColumnOrName, ids: ColumnOrName) -> Column:
    """Answer token ids; prompt and padding positions become 0."""
    return F.zip_with(col(type_ids), col(ids), lambda t, x: t * x)
