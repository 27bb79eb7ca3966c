"""Scores of generated text, entities, retrieval and preferences."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import ColumnOrName, chars, col, let, strip, text_or_empty
from textmill.functions.tokens import multiset_overlap, ngrams, set_overlap, term_counts
from textmill.functions.vectors import cosine
from textmill.operators.exploding import explode_items

# --- fixed values -----------------------------------------------------------
NO_ANSWER = "无答案"
BLEU_ORDER = 4
BETA = 0.2
GROUP_SIZE = 8
# ----------------------------------------------------------------------------


# ---- n-gram scores ---------------------------------------------------------
def ngram_counts(tokens: Column, n: int = BLEU_ORDER) -> Column:
    """``array<struct<n, gram, count>>`` for 1..n, counted inside the row."""
    def order(i: int) -> Column:
        return F.transform(
            term_counts(ngrams(tokens, i)),
            lambda run: F.struct(F.lit(i).alias("n"), run["term"].alias("gram"), run["tf"].alias("count")),
        )

    return F.concat(*map(order, range(1, n + 1)))


def _precisions(reference: Column, output: Column, n: int) -> list[Column]:
    """Struct(clipped, total) per order."""
    return [
        F.struct(
            multiset_overlap(ngrams(reference, i), ngrams(output, i)).alias("clipped"),
            F.greatest(F.size(output) - (i - 1), F.lit(0)).alias("total"),
        )
        for i in range(1, n + 1)
    ]


def bleu4(reference: Column, output: Column, n: int = BLEU_ORDER) -> Column:
    """Geometric mean of clipped precisions times exp(1 - ref/out), uncapped.

    Zero when any order has no match.
    """

    def score(s: Column) -> Column:
        logs = F.aggregate(
            s["p"], F.lit(0.0), lambda acc, p: acc + F.log(p["clipped"].cast("double") / p["total"]) / n
        )
        penalty = F.exp(1.0 - s["r"].cast("double") / s["o"])
        return F.when(F.exists(s["p"], lambda p: p["clipped"] == 0), F.lit(0.0)).otherwise(penalty * F.exp(logs))

    state = F.struct(
        F.array(*_precisions(reference, output, n)).alias("p"),
        F.size(reference).alias("r"),
        F.size(output).alias("o"),
    )
    return let(state, score)


def sentence_bleu(reference: Column, output: Column, n: int = BLEU_ORDER) -> Column:
    """Sentence BLEU with geometric-sequence smoothing and the capped penalty.

    The k-th order without a match counts as 1 / (2^k * total); no shared unigram
    gives 0.
    """

    def score(s: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("logs"), F.lit(0).alias("misses"))

        def add(acc: Column, p: Column) -> Column:
            total = F.greatest(p["total"], F.lit(1)).cast("double")
            misses = acc["misses"] + (p["clipped"] == 0).cast("int")
            smoothed = F.when(p["clipped"] == 0, 1.0 / (F.pow(F.lit(2.0), misses) * total)).otherwise(
                p["clipped"] / total
            )
            return F.struct((acc["logs"] + F.log(smoothed) / n).alias("logs"), misses.alias("misses"))

        logs = F.aggregate(s["p"], zero, add, lambda acc: acc["logs"])
        penalty = F.when(s["o"] > s["r"], F.lit(1.0)).otherwise(F.exp(1.0 - s["r"].cast("double") / s["o"]))
        return F.when((s["o"] == 0) | (F.get(s["p"], 0)["clipped"] == 0), F.lit(0.0)).otherwise(penalty * F.exp(logs))

    state = F.struct(
        F.array(*_precisions(reference, output, n)).alias("p"),
        F.size(reference).alias("r"),
        F.size(output).alias("o"),
    )
    return let(state, score)


def _f_score(overlap: Column, reference: Column, output: Column) -> Column:
    """F measure from an overlap and two sizes."""
    return let(
        F.struct(
            F.when(output > 0, overlap / output).otherwise(0.0).alias("p"),
            F.when(reference > 0, overlap / reference).otherwise(0.0).alias("r"),
        ),
        lambda s: F.when(s["p"] + s["r"] > 0, 2 * s["p"] * s["r"] / (s["p"] + s["r"])).otherwise(0.0),
    )


def rouge_n(reference: Column, output: Column, n: int) -> Column:
    """F of the distinct n-grams of both sides."""
    r, o = F.array_distinct(ngrams(reference, n)), F.array_distinct(ngrams(output, n))
    return let(
        F.struct(r.alias("r"), o.alias("o")),
        lambda s: _f_score(set_overlap(s["r"], s["o"]), F.size(s["r"]), F.size(s["o"])),
    )


@F.pandas_udf(T.IntegerType())
def _common_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence, one bit row per token.

    Python integers hold a whole row of the table, so a step costs one machine
    word per 64 tokens.
    """
    out = []
    for left, right in zip(a, b):
        places: dict[str, int] = {}
        for i, token in enumerate(left):
            places[token] = places.get(token, 0) | (1 << i)
        full = (1 << len(left)) - 1
        row = full
        for token in right:
            match = places.get(token, 0) & row
            row = ((row + match) | (row - match)) & full
        out.append(len(left) - row.bit_count())
    return pd.Series(out)


def rouge_l(reference: Column, output: Column) -> Column:
    return _f_score(_common_length(reference, output), F.size(reference), F.size(output))


def text_metrics(
    pairs: DataFrame,
    reference: str = "reference",
    output: str = "output",
    segment: Callable[[Column], Column] = chars,
) -> DataFrame:
    """Mean ROUGE-1/2/L F and BLEU-4, each row times 100 and rounded to 4 places.

    ``segment`` cuts a text into words (characters by default); an empty output
    counts as a single dash for ROUGE; BLEU always works on characters.
    """
    ref, out = segment(text_or_empty(reference)), segment(text_or_empty(output))
    shown = F.when(F.size(out) == 0, F.array(F.lit("-"))).otherwise(out)
    scored = pairs.select(ref.alias("_ref"), shown.alias("_out"), chars(text_or_empty(reference)).alias("_rc"), chars(text_or_empty(output)).alias("_oc"))
    rows = {
        "rouge_1": rouge_n(F.col("_ref"), F.col("_out"), 1),
        "rouge_2": rouge_n(F.col("_ref"), F.col("_out"), 2),
        "rouge_l": rouge_l(F.col("_ref"), F.col("_out")),
        "bleu_4": sentence_bleu(F.col("_rc"), F.col("_oc")),
    }
    return scored.agg(*(F.avg(F.round(c * 100, 4)).alias(name) for name, c in rows.items()))


# ---- entities --------------------------------------------------------------
def f1_sets(gold: ColumnOrName, pred: ColumnOrName) -> Column:
    """F1 of two entity lists; repeats count in the denominators only."""
    g = F.coalesce(col(gold), F.array().cast("array<string>"))
    p = F.coalesce(col(pred), F.array().cast("array<string>"))
    return let(
        F.struct(g.alias("g"), p.alias("p")),
        lambda s: _f_score(set_overlap(s["g"], s["p"]), F.size(s["g"]), F.size(s["p"])),
    )


def f1_by_type(items: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """Mean F1 per entity type over the items where either side has the type.

    ``gold`` and ``pred`` are ``map<type, array<entity>>``: both sides of an item sit
    in one row, so the outer join of their types is a union of the keys.
    """
    kinds = F.array_union(F.map_keys(gold), F.map_keys(pred))
    per_type = explode_items(items, [gold, pred], kinds, "type").select(
        "type", f1_sets(F.try_element_at(gold, F.col("type")), F.try_element_at(pred, F.col("type"))).alias("f1")
    )
    return per_type.groupBy("type").agg(F.avg("f1").alias("f1"), F.count("*").alias("items"))


# ---- answers and retrieval -------------------------------------------------
def pair_predictions(gold: DataFrame, pred: DataFrame, key: str | list[str], answer: str = "answer") -> DataFrame:
    """Gold rows with their prediction; a missing one is null."""
    keys = [key] if isinstance(key, str) else key
    return gold.withColumnRenamed(answer, "gold").join(
        pred.select(*keys, F.col(answer).alias("prediction")), keys, "left"
    )


def semantic_score(gold: ColumnOrName, prediction: ColumnOrName, gold_vec: ColumnOrName, pred_vec: ColumnOrName) -> Column:
    """0 when only the gold answer is "no answer", else the cosine of the embeddings."""
    differs = (strip(gold) == NO_ANSWER) & ~(F.coalesce(strip(prediction), F.lit("")) == NO_ANSWER)
    return F.when(differs | col(prediction).isNull(), F.lit(0.0)).otherwise(
        F.coalesce(cosine(gold_vec, pred_vec), F.lit(0.0))
    )


def retrieval_metrics(hits: DataFrame, truth: DataFrame, k: int, query: str = "query_id", doc: str = "chunk_id") -> DataFrame:
    """Hit rate at ``k`` and mean reciprocal rank over the queries of ``truth``."""
    good = hits.join(truth.select(query, doc).distinct(), [query, doc]).groupBy(query).agg(F.min("rank").alias("first"))
    asked = truth.select(query).distinct().join(good, query, "left")
    within = F.col("first") <= k
    return asked.agg(
        F.count("*").alias("queries"),
        F.avg(F.when(within, 1.0).otherwise(0.0)).alias("hit_rate"),
        F.avg(F.when(within, 1.0 / F.col("first")).otherwise(0.0)).alias("mrr"),
    )


# ---- preferences -----------------------------------------------------------
def masked_mean(logps: ColumnOrName, mask: ColumnOrName) -> Column:
    """Mean log-probability over the positions whose mask is not 0."""
    kept = F.filter(
        F.arrays_zip(col(logps).alias("x"), col(mask).alias("m")), lambda t: t["m"] != 0
    )
    return let(
        kept,
        lambda k: F.when(
            F.size(k) > 0, F.aggregate(k, F.lit(0.0), lambda acc, t: acc + t["x"].cast("double")) / F.size(k)
        ),
    )


def preference_loss(
    policy_chosen: ColumnOrName,
    policy_rejected: ColumnOrName,
    base_chosen: ColumnOrName,
    base_rejected: ColumnOrName,
    beta: float = BETA,
    smoothing: float = 0.0,
) -> Column:
    """Struct(loss, chosen_reward, rejected_reward) of one preference pair."""
    pc, pr, rc, rr = map(col, (policy_chosen, policy_rejected, base_chosen, base_rejected))
    x = beta * ((pc - pr) - (rc - rr))
    # -ln(sigmoid(z)) = ln(1 + e^-z), written so that neither sign overflows.
    def neg_log_sigmoid(z: Column) -> Column:
        return F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))

    loss = neg_log_sigmoid(x) * (1 - smoothing) + neg_log_sigmoid(-x) * smoothing
    return F.struct(
        loss.alias("loss"), (beta * (pc - rc)).alias("chosen_reward"), (beta * (pr - rr)).alias("rejected_reward")
    )


def preference_metrics(scored: DataFrame, group: str = "step", result: str = "result") -> DataFrame:
    """Per group: mean loss and rewards, number of wins, sum of margins."""
    won, lost = F.col(f"{result}.chosen_reward"), F.col(f"{result}.rejected_reward")
    return scored.groupBy(group).agg(
        F.avg(f"{result}.loss").alias("loss"),
        F.avg(won).alias("chosen_rewards"),
        F.avg(lost).alias("rejected_rewards"),
        F.sum((won > lost).cast("int")).alias("reward_accuracies"),
        F.sum(won - lost).alias("margins"),
    )
