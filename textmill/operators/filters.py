"""Row filters.  Each ``*_ok`` helper is a predicate, each table function a filter."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import (
    TABLE_WORDS,
    TRANSLATION_WORDS,
    ColumnOrName,
    col,
    strip,
    text_or_empty,
)


def _all(parts: list[Column]) -> Column:
    return reduce(and_, parts, F.lit(True))


def ordinary_task(title: ColumnOrName, response: ColumnOrName, variant: str = "default") -> Column:
    """False for translation and table tasks.

    ``variant="t5_sft"`` looks for the English keyword in the response and is
    case-sensitive there.
    """
    head, body = text_or_empty(title), text_or_empty(response)
    chinese, english = TRANSLATION_WORDS
    table, rule = TABLE_WORDS
    if variant == "t5_sft":
        translation = F.contains(head, F.lit(chinese)) | F.contains(body, F.lit(english))
    elif variant == "default":
        translation = F.contains(head, F.lit(chinese)) | F.contains(F.lower(head), F.lit(english))
    else:
        raise ValueError(f"unknown variant {variant!r}")
    tabular = F.contains(head, F.lit(table)) | F.contains(head, F.lit(rule)) | F.contains(body, F.lit(rule))
    return ~(translation | tabular)


def drop_tasks(df: DataFrame, title: str, response: str, variant: str = "default") -> DataFrame:
    return df.filter(ordinary_task(title, response, variant))


def min_score(df: DataFrame, column: str, least: int = 5) -> DataFrame:
    return df.filter(F.col(column) >= least)


def min_len(df: DataFrame, **limits: int) -> DataFrame:
    return df.filter(_all([F.length(text_or_empty(c)) >= n for c, n in limits.items()]))


def max_len(df: DataFrame, **limits: int) -> DataFrame:
    return df.filter(_all([F.length(text_or_empty(c)) <= n for c, n in limits.items()]))


def valid_instruction(prompt: ColumnOrName, extra: ColumnOrName, output: ColumnOrName, longest: int = 256) -> Column:
    """Length test on prompt and optional input, both prompt and output present."""
    return (
        (F.length(text_or_empty(prompt)) <= longest)
        & (F.length(text_or_empty(extra)) <= longest)
        & (F.length(text_or_empty(prompt)) > 0)
        & (F.length(text_or_empty(output)) > 0)
    )


def valid_pairs(df: DataFrame, prompt: str = "prompt", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Preference rows whose two answers differ and whose texts are present."""
    present = _all([F.length(text_or_empty(c)) > 0 for c in (prompt, chosen, rejected)])
    return df.filter(present & (strip(text_or_empty(chosen)) != strip(text_or_empty(rejected))))


def truncate_pair(df: DataFrame, longest: int = 512, prompt: str = "prompt", response: str = "response") -> DataFrame:
    """Both sides are cut when either is too long."""
    cut = (F.length(prompt) > longest) | (F.length(response) > longest)
    return df.withColumns(
        {c: F.when(cut, F.substring(F.col(c), 1, longest)).otherwise(F.col(c)) for c in (prompt, response)}
    )


def to_preference(df: DataFrame, **renames: str) -> DataFrame:
    """One preference schema: ``to_preference(df, rejected="reject")``."""
    names = {"prompt": "prompt", "chosen": "chosen", "rejected": "rejected"} | renames
    return df.select(*(F.col(old).cast("string").alias(new) for new, old in names.items()))


def article_title(title: ColumnOrName, accepted: tuple[str, ...] = ("w",)) -> Column:
    """True for titles outside foreign namespaces."""
    name = col(title)
    return ~F.contains(name, F.lit(":")) | F.split_part(name, F.lit(":"), F.lit(1)).isin(*accepted)


def article_pages(pages: DataFrame, accepted: tuple[str, ...] = ("w",)) -> DataFrame:
    return pages.filter(F.col("redirect").isNull() & article_title("title", accepted))


def incubator_pages(pages: DataFrame, language: str) -> DataFrame:
    """Pages titled ``prefix/language/title``; the title becomes the third part."""
    parts = F.split(F.col("title"), "/")
    return pages.filter((F.size(parts) >= 3) & (F.get(parts, 1) == language)).withColumn("title", F.get(parts, 2))


def restrict_titles(pages: DataFrame, titles: DataFrame) -> DataFrame:
    """Keep listed titles and attach their tags.

    The list is joined by its key; the optimiser broadcasts it when it is small.
    """
    return pages.join(titles.dropDuplicates(["title"]), "title")


@dataclass(frozen=True)
class SearchSpec:
    """Bounds of a structured search: minimum inclusive, maximum exclusive."""

    min_view_count: int | None = None
    max_view_count: int | None = None
    earliest_publish_date: datetime.date | None = None
    latest_publish_date: datetime.date | None = None
    min_length_sec: int | None = None
    max_length_sec: int | None = None


def metadata_filter(
    df: DataFrame,
    spec: SearchSpec,
    views: str = "view_count",
    published: str = "publish_date",
    length: str = "length_sec",
) -> DataFrame:
    """Plain comparisons only, so every bound reaches the file scan."""
    bounds = [
        (views, spec.min_view_count, spec.max_view_count),
        (published, spec.earliest_publish_date, spec.latest_publish_date),
        (length, spec.min_length_sec, spec.max_length_sec),
    ]
    tests = [F.col(c) >= F.lit(low) for c, low, _ in bounds if low is not None]
    tests += [F.col(c) < F.lit(high) for c, _, high in bounds if high is not None]
    return df.filter(_all(tests)) if tests else df


def keep_relevant(df: DataFrame, grade: str = "grade") -> DataFrame:
    return df.filter(F.lower(strip(F.col(grade))) == "yes")


def noise_line(line: ColumnOrName, dots: int = 20) -> Column:
    """True for contents marks, dotted leaders, blank and all-digit lines."""
    bare = strip(line)
    return (
        F.contains(bare, F.lit("." * dots))
        | F.contains(bare, F.lit("目录"))
        | (F.length(bare) < 1)
        | F.rlike(bare, F.lit(r"^\p{Nd}+$"))
    )


def page_text(text: ColumnOrName) -> Column:
    """Text of a page: its stripped lines without noise, joined without a separator."""
    kept = F.filter(F.split(col(text), "\n"), lambda line: ~noise_line(line))
    return F.array_join(F.transform(kept, strip), "")
