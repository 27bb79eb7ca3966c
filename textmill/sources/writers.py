"""Writers: never interactive, the save mode decides what happens to old data."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import SLICE_TEXTS, text_or_empty

ROWS_PER_FILE = 1_000_000
SEPARATOR = "[SEP]"


def write_parquet(
    df: DataFrame, path: str, mode: str = "append", compression: str = "gzip", rows_per_file: int = ROWS_PER_FILE
) -> None:
    df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", rows_per_file).parquet(path)


def check_sep(sep: str) -> None:
    """A separator that escaped text can never contain, not even across its own ends."""
    overlaps = any(sep.startswith(sep[at:]) for at in range(1, len(sep)))
    if not sep or sep[0] in "nrs" or overlaps or set(sep) & set("\\\r\n"):
        raise ValueError(f"separator {sep!r} cannot be used with escapes")


def escaped(text: Column, sep: str = SEPARATOR) -> Column:
    """Backslash, line breaks and the separator as two-letter escapes."""
    for raw, letter in (("\\", "\\"), ("\n", "n"), ("\r", "r"), (sep, "s")):
        text = F.replace(text, F.lit(raw), F.lit("\\" + letter))
    return text


def sep_line(prompt: str, response: str, sep: str = SEPARATOR) -> Column:
    return F.concat(text_or_empty(prompt), F.lit(sep), text_or_empty(response))


def write_sep_text(
    df: DataFrame,
    path: str,
    prompt: str = "prompt",
    response: str = "response",
    sep: str = SEPARATOR,
    mode: str = "errorifexists",
    escape: bool = False,
) -> None:
    """A line a record.  With ``escape`` line breaks inside a record do not split it and
    ``read_sep_text`` gives the same texts back (null as empty)."""
    if escape:
        check_sep(sep)
        sides = [escaped(text_or_empty(side), sep) for side in (prompt, response)]
        line = F.concat(sides[0], F.lit(sep), sides[1])
    else:
        line = sep_line(prompt, response, sep)
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def _array_lines(batches: Iterator[pa.RecordBatch], rows_per_file: int) -> Iterator[pa.RecordBatch]:
    """One line a row; brackets stand on the first and last row of each array."""
    written, held = 0, None

    def batch_of(lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    for batch in (b.slice(at, SLICE_TEXTS) for b in batches for at in range(0, b.num_rows, SLICE_TEXTS)):
        lines = []
        for row in batch.column(0).to_pylist():
            if held is not None:
                lines.append(held)
            held = ("," if written % rows_per_file else "[") + row
            written += 1
            if written % rows_per_file == 0:
                lines.append(held + "]")
                held = None
        if lines:
            yield batch_of(lines)
    if held is not None:
        yield batch_of([held + "]"])
    elif written == 0:
        yield batch_of(["[]"])


def write_json_array(
    df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE, keep_nulls: bool = False
) -> None:
    """Files of one JSON array each, of ``rows_per_file`` objects at most.

    An array takes as many lines as it has objects, so the file writer's own row limit ends
    a file where its array ends; a task that is lost or run twice commits whole files only.
    An empty partition writes ``[]``.
    """
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": str(not keep_nulls).lower()})
    lines = df.select(whole.alias("value")).mapInArrow(lambda b: _array_lines(b, rows_per_file), "value string")
    lines.write.mode(mode).option("maxRecordsPerFile", rows_per_file).text(path)
