"""Declared source specs: one description per corpus, one builder for all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import collapse_punct, compose_optional, compose_prompt, strip_cr, text_or_empty, to_sample
from textmill.operators.exploding import built_rows
from textmill.operators.filters import ordinary_task
from textmill.operators.hooks import prepare_where


@dataclass(frozen=True)
class SourceSpec:
    """How a raw table becomes ``prompt, response``."""

    title: str
    response: str
    desc: str | None = None
    optional: str | None = None
    sep: str = ""
    keep: Callable[[], Column] | None = None
    least_prompt: int = 0
    least_response: int = 15
    # The response test may look at the raw text instead of the cleaned one.
    test_raw_response: bool = False
    collapse: str | None = None


def _belle() -> Column:
    return ordinary_task("instruction", "output")


def _sft() -> Column:
    return ordinary_task("instruction", "output", variant="t5_sft")


# Pair corpora test both sides, sample corpora the response only.
PAIR_SPECS = {
    "baike": SourceSpec("title", "answer", desc="desc", least_prompt=15),
    "belle": SourceSpec("instruction", "output", desc="input", keep=_belle, least_prompt=15),
    "webtext": SourceSpec("title", "content", desc="desc", keep=lambda: F.col("star") >= 5, least_prompt=15),
    "zhihu": SourceSpec("INSTRUCTION", "RESPONSE", desc="INSTRUCTION", least_prompt=15),
    "sft": SourceSpec(
        "instruction", "output", desc="input", sep=" ", keep=_sft,
        least_prompt=5, least_response=5, test_raw_response=True, collapse="t5_sft",
    ),
}
SAMPLE_SPECS = {
    "shareAI": SourceSpec("human", "assistant"),
    "ruozhiba": SourceSpec("instruction", "output"),
    "belle": SourceSpec("instruction", "output", desc="input", keep=_belle),
    "CQIA": SourceSpec("instruction", "output", optional="input"),
    "alpaca": SourceSpec("instruction", "output", optional="input"),
}


def prepare(
    df: DataFrame, spec: SourceSpec, keep_columns: tuple[str, ...] = (), where: Column | Callable | None = None
) -> DataFrame:
    """``prompt, response`` of a raw table: one stage of column expressions, no shuffle.

    The cheap keyword test comes first; the similarity test runs on what is left.  ``where`` is the
    user's own test of raw rows, a Column or a function over batches (see ``prepare_where``); it
    runs last, so a slow function sees only what the spec keeps.
    """
    kept = df.filter(spec.keep()) if spec.keep else df
    kept = kept if where is None else prepare_where(kept, where)
    if spec.desc:
        prompt = compose_prompt(spec.title, spec.desc, spec.sep)
    elif spec.optional:
        prompt = compose_optional(spec.title, spec.optional, spec.sep)
    else:
        prompt = text_or_empty(spec.title)
    prompt, response = strip_cr(prompt), strip_cr(text_or_empty(spec.response))
    if spec.collapse:
        prompt, response = (collapse_punct(c, variant=spec.collapse) for c in (prompt, response))
    pair = F.struct(prompt.alias("prompt"), response.alias("response"), text_or_empty(spec.response).alias("raw"))
    tested = "raw" if spec.test_raw_response else "response"
    return built_rows(
        kept,
        [*keep_columns],
        pair,
        lambda p: (F.length(p[tested]) >= spec.least_response) & (F.length(p["prompt"]) >= spec.least_prompt),
    ).drop("raw")


def prepare_samples(df: DataFrame, spec: SourceSpec, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """One ``prompt`` column: prompt, response and end mark."""
    pairs = prepare(df, spec, keep_columns)
    return pairs.select(*keep_columns, to_sample("prompt", "response").alias("prompt"))


def corpus_report(df: DataFrame, by: list[str], text: str, kept: Column | None = None) -> DataFrame:
    """Rows read, rows kept and characters kept per group."""
    return df.groupBy(*by).agg(*report_columns(text, kept))


def corpus_report_total(df: DataFrame, by: str, text: str, kept: Column | None = None) -> DataFrame:
    """The same with a last line over everything (null group)."""
    return df.rollup(by).agg(*report_columns(text, kept))


def report_columns(text: str, kept: Column | None) -> list[Column]:
    keep = F.lit(True) if kept is None else kept
    return [
        F.count("*").alias("rows_read"),
        F.count_if(keep).alias("rows_kept"),
        F.coalesce(F.sum(F.when(keep, F.length(text))), F.lit(0)).alias("chars_kept"),
    ]


def corpus_totals(df: DataFrame, text: str, ids: str | None = None) -> DataFrame:
    """Character and token totals of a corpus."""
    columns = [F.count("*").alias("rows"), F.sum(F.length(text)).alias("chars")]
    if ids:
        columns.append(F.sum(F.size(ids)).alias("tokens"))
    return df.agg(*columns)
