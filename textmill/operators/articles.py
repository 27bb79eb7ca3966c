"""Encyclopaedia articles to training samples; one article is one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.prompts import WIKI_QUESTIONS, fill_title
from textmill.functions.text import END_MARK, let, normalise_line, pick_template, text_or_empty
from textmill.operators.exploding import built_rows

HEADER_END = "："


def article_sample(
    key: str,
    text: str,
    max_len: int = 512,
    cut: bool = False,
    templates: list[str] = WIKI_QUESTIONS,
    mapping: dict[str, str] | None = None,
) -> Column:
    """Struct(prompt, response) of an article, null when it gives no sample.

    The first line must be a heading.  Body lines are added until the response
    passes ``max_len``; the passing line is included (``cut`` shortens the result
    to ``max_len``).  A closed short article ends with the blank line's newline; a
    record that still ends in a newline is the open end of a file.
    """

    def build(raw: Column) -> Column:
        closed = ~F.endswith(raw, F.lit("\n"))
        bare = F.regexp_replace(raw, r"^\n+|\n+$", "")
        lines = F.transform(F.split(bare, "\n"), lambda s: normalise_line(F.concat(s, F.lit("\n")), mapping))
        return let(F.struct(closed.alias("closed"), lines.alias("lines")), assemble)

    def assemble(s: Column) -> Column:
        header = F.get(s["lines"], 0)
        body = F.filter(
            F.slice(s["lines"], 2, F.greatest(F.size(s["lines"]), F.lit(1))),
            lambda line: ~F.endswith(line, F.lit(HEADER_END)),
        )
        zero = F.struct(F.lit("").alias("text"), F.lit(False).alias("done"))
        filled = F.aggregate(
            body,
            zero,
            lambda acc, line: F.when(acc["done"], acc).otherwise(
                F.struct(
                    F.concat(acc["text"], line).alias("text"),
                    (F.length(acc["text"]) + F.length(line) > max_len).alias("done"),
                )
            ),
        )
        return let(
            filled,
            lambda f: let(
                F.when(f["done"] | ~s["closed"], f["text"]).otherwise(F.concat(f["text"], F.lit("\n"))),
                lambda response: F.when(
                    F.endswith(header, F.lit(HEADER_END)) & (F.length(response) > 0),
                    F.struct(
                        fill_title(
                            pick_template(key, templates), F.substring(header, 1, F.length(header) - 1)
                        ).alias("prompt"),
                        (F.substring(response, 1, max_len) if cut else response).alias("response"),
                    ),
                ),
            ),
        )

    return let(text_or_empty(text), build)


def wiki_samples(articles: DataFrame, key: str, text: str, max_len: int = 512, cut: bool = False, **options) -> DataFrame:
    """One sample per article that has a heading and a body."""
    sample = article_sample(key, text, max_len, cut, **options)
    sampled = built_rows(articles, [key], sample, lambda s: s.isNotNull())
    return sampled.withColumn("sample", F.concat("prompt", "response", F.lit(END_MARK)))
