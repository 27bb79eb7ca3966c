"""Readers.  Schemas are always declared, so no reader scans data to infer one."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import col
from textmill.session import cut_lineage

INSTRUCTION = "instruction string, input string, output string"
CHAT = "conversation array<struct<human: string, assistant: string>>"
RATED_QA = "title string, desc string, content string, star int"
PLAIN_QA = "title string, desc string, answer string"
PREFERENCE = "prompt string, chosen string, rejected string"
PREFERENCE_RAW = "prompt string, chosen string, reject string"
PAGE = (
    "title string, id long, redirect struct<_title: string>, "
    "revision struct<id: long, text: struct<_VALUE: string>>"
)
CORRUPT = "_corrupt_record"
# A whole line (CR before LF is white space) of two fields; nothing is matched twice.
TWO_FIELDS = r"(?U)(?<![^\n])[\s&&[^\n]]*+(\S++)[\s&&[^\n]]++(\S++)[\s&&[^\n]]*+(?![^\n])"
PARTS = "source_file string, block long, part long, head boolean, tail boolean, value string"


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, with_file: bool = False) -> DataFrame:
    """One record per line; unreadable lines become rows with ``_corrupt_record``."""
    full = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    df = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    return _with_file(df) if with_file else df


def good_records(df: DataFrame) -> DataFrame:
    """Readable rows only.

    The scan refuses a plan that needs nothing but the corrupt-record column (a bare
    count, say), so the filter also looks at the first data column; that part is
    always true.
    """
    parsed = F.hash(F.col(df.columns[0])) >= F.lit(-(2**31))
    return df.filter(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)


def read_json_array(spark: SparkSession, paths: str | list[str], schema: str, with_corrupt: bool = False) -> DataFrame:
    """Files that hold one array of objects each.

    ``with_corrupt`` adds the file name and, for a file that cannot be read, its content
    as ``_corrupt_record``; without it such a file gives a row of nulls.
    """
    reader = spark.read.option("multiLine", True)
    if not with_corrupt:
        return reader.schema(schema).json(paths)
    full = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    return _with_file(reader.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(paths))


def read_parquet(spark: SparkSession, paths: str | list[str], *columns: str) -> DataFrame:
    names = [paths] if isinstance(paths, str) else paths
    df = spark.read.parquet(*names)
    return df.select(*columns) if columns else df


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).withColumnRenamed("value", "line")


def read_sep_text(spark: SparkSession, paths: str | list[str], sep: str = "[SEP]") -> DataFrame:
    """``prompt, response`` of lines that were written with escapes."""
    at = F.instr("line", sep)

    def restored(piece: Column) -> Column:
        for letter, raw in (("n", "\n"), ("r", "\r"), ("s", sep)):
            piece = F.replace(piece, F.lit("\\" + letter), F.lit(raw))
        return piece

    def plain(text: Column) -> Column:
        # Between two pairs of backslashes a backslash always leads an escape.
        pieces = F.split(text, r"\\\\", -1)
        return F.array_join(F.transform(pieces, restored), "\\")

    lines = read_lines(spark, paths).filter(at > 0)
    return lines.select(
        plain(F.substring("line", F.lit(1), at - 1)).alias("prompt"),
        plain(F.substring("line", at + len(sep), F.length("line"))).alias("response"),
    )


def read_articles(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per blank-line-separated article, any number of blank lines between."""
    df = spark.read.option("lineSep", "\n\n").text(paths).withColumnRenamed("value", "article")
    return df.filter(F.length(F.regexp_replace("article", "\n", "")) > 0)


def read_dir(spark: SparkSession, path: str, fmt: str, schema: str, skip: tuple[str, ...] = (), pattern: str = "*") -> DataFrame:
    """All files of a folder with their name, leaving out ``skip``."""
    df = _with_file(spark.read.format(fmt).schema(schema).option("pathGlobFilter", pattern).load(path))
    if not skip:
        return df
    return df.filter(~F.element_at(F.split("source_file", "/"), -1).isin(*skip))


def tagged_sentence(block: Column | str) -> Column:
    """Struct(chars, labels) of a block of ``char label`` lines; other lines are skipped.

    One pass a column over the block: a line costs no expression of its own.
    """
    return F.struct(
        F.regexp_extract_all(col(block), F.lit(TWO_FIELDS), F.lit(1)).alias("chars"),
        F.regexp_extract_all(col(block), F.lit(TWO_FIELDS), F.lit(2)).alias("labels"),
    )


def _sentence_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines between blank lines, split by split; parts at the ends of a split stay open."""
    names = [c.split()[0] for c in PARTS.split(", ")]
    split, part, head, lines, done = None, 0, False, [], []

    def close(tail: bool) -> None:
        done.append((*split, part, head, tail, "\n".join(lines)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for at, line in zip(zip(*(c.to_pylist() for c in batch.columns[:2])), batch.column(2).to_pylist()):
            if at != split:
                if split:
                    close(tail=True)
                split, part, head, lines = at, 0, at[1] > 0, []
            if line:
                lines.append(line)
            else:
                close(tail=False)
                part, head, lines = part + 1, False, []
        if done:
            yield batch_of(done)
            done = []
    if split:
        close(tail=True)
        yield batch_of(done)


def _joined_parts(parts: DataFrame) -> DataFrame:
    """Sentences that reach over splits.

    A split has at most two open parts, so a window over a file holds two rows a split.
    """
    place = Window.partitionBy("source_file").orderBy("block", "part")
    numbered = parts.withColumn("sentence", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(place))
    pieces = F.sort_array(F.collect_list(F.struct("block", "part", "value")))
    return numbered.groupBy("source_file", "sentence").agg(
        F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value")
    )


def read_conll(spark: SparkSession, paths: str | list[str], line_break: str | None = "\r\n") -> DataFrame:
    """``chars, labels`` per sentence, with its file; a blank line ends a sentence.

    ``line_break=None`` takes LF, CRLF and CR alike, also mixed in one file, and still cuts
    large files into splits.  The files are read once, their parts are stored: whole sentences
    need no shuffle, only the parts at split borders are joined.
    """
    if line_break is None:
        lines = spark.read.text(paths).select("_metadata.file_path", "_metadata.file_block_start", "value")
        parts = cut_lineage(lines.mapInArrow(_sentence_parts, PARTS), "sentence-parts")
        is_open = F.col("head") | F.col("tail")
        raw = parts.filter(~is_open).select("source_file", "value").unionByName(
            _joined_parts(parts.filter(is_open)).select("source_file", "value")
        )
    else:
        text = spark.read.option("lineSep", line_break * 2).text(paths)
        raw = text.select(F.col("_metadata.file_path").alias("source_file"), "value")
    rows = raw.select("source_file", tagged_sentence("value").alias("s"))
    return rows.select("source_file", "s.chars", "s.labels").filter(F.size("chars") > 0)


def read_wiki_dump(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``id, title, redirect, text`` per page of a dump (plain, bz2 or gzip)."""
    raw = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(paths)
    return raw.select("id", "title", F.col("redirect._title").alias("redirect"), F.col("revision.text._VALUE").alias("text"))


def preview(df: DataFrame, rows: int = 5) -> tuple[DataFrame, list[str], int]:
    """First rows, column names and row count."""
    return df.limit(rows), df.columns, df.count()
