"""Metrics: n-grams, BLEU, ROUGE, entity F1, semantic score, preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.tokens import words
from textmill.functions.vectors import letter_vector
from textmill.operators.conversations import exchanges
from textmill.operators.exploding import explode_structs
from textmill.operators.metrics import (
    bleu4,
    f1_by_type,
    masked_mean,
    ngram_counts,
    pair_predictions,
    preference_loss,
    preference_metrics,
    rouge_l,
    rouge_n,
    semantic_score,
    sentence_bleu,
    text_metrics,
)
from textmill.plans.registered import query, table
from textmill.plans.registered.chat import EXCHANGES_SQL
from textmill.plans.registered.search import unit_sql, letters_sql
from textmill.plans.registered.sqltext import words as sql_words


#: Turns behind the pairs one task scores.
TASK_TURNS = 4000


def reply_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies and the same replies with every fifth word left out."""
    turns = table(spark, sf_dir, "conversations")
    # A joined partition is as large as its shuffle allows, and some scores take a second for a thousand rows.
    parts = max(spark.sparkContext.defaultParallelism, -(-turns.count() // TASK_TURNS))
    pairs = exchanges(turns).repartition(parts)
    ref = words("assistant")
    return pairs.select(
        "conv_id", "turn", "user", "assistant", ref.alias("ref"), F.filter(ref, lambda _, i: i % 5 != 4).alias("out")
    )


PAIRS_SQL = f"""
    {EXCHANGES_SQL},
    p AS (SELECT conv_id, turn, "user", assistant, {sql_words('assistant')} AS ref,
                 list_filter({sql_words('assistant')}, lambda w, i: (i - 1) % 5 <> 4) AS out FROM ex)
"""


def grams_sql(side: str) -> str:
    return f"""
    {side}_g AS (SELECT conv_id, turn, v.n AS n, unnest(list_transform(range(1, greatest(len({side}) - v.n + 2, 1)::BIGINT),
                        lambda i: array_to_string({side}[i:i + v.n - 1], ' '))) AS g
                 FROM p, (VALUES (1), (2), (3), (4)) v(n)),
    {side}_c AS (SELECT conv_id, turn, n, g, count(*) AS c FROM {side}_g GROUP BY ALL)
    """


CLIPPED_SQL = f"""
    {PAIRS_SQL}, {grams_sql('ref')}, {grams_sql('out')},
    clip AS (SELECT conv_id, turn, n, sum(least(r.c, o.c)) AS clipped FROM ref_c r JOIN out_c o USING (conv_id, turn, n, g) GROUP BY ALL),
    frame AS (SELECT conv_id, turn, v.n, greatest(len(out) - v.n + 1, 0) AS total, len(ref) AS rl, len(out) AS ol
              FROM p, (VALUES (1), (2), (3), (4)) v(n)),
    prec AS (SELECT f.*, coalesce(clipped, 0) AS clipped FROM frame f LEFT JOIN clip USING (conv_id, turn, n))
"""


@query(
    "ngram_statistics",
    f"""
    WITH {PAIRS_SQL}, {grams_sql('ref')}
    SELECT n::INTEGER AS n, g AS gram, sum(c)::BIGINT AS count FROM ref_c GROUP BY n, g
    """,
)
def ngram_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n-gram counts of all replies: counted in the row, summed across rows."""
    pairs = reply_pairs(spark, sf_dir)
    grams = explode_structs(pairs, [], ngram_counts(F.col("ref")))
    return grams.groupBy("n", "gram").agg(F.sum("count").alias("count"))


@query(
    "bleu_scores",
    f"""
    WITH {CLIPPED_SQL}
    SELECT conv_id, turn, round(CASE WHEN min(clipped) = 0 THEN 0.0
        ELSE exp(1.0 - any_value(rl)::DOUBLE / any_value(ol)) * exp(sum(ln(CASE WHEN clipped = 0 THEN 1 ELSE clipped::DOUBLE / total END)) / 4) END, 6) AS bleu
    FROM prec GROUP BY conv_id, turn
    """,
)
def bleu_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = reply_pairs(spark, sf_dir)
    return pairs.select("conv_id", "turn", F.round(bleu4(F.col("ref"), F.col("out")), 6).alias("bleu"))


SMOOTH_SQL = f"""
    {CLIPPED_SQL},
    miss AS (SELECT *, sum(CASE WHEN clipped = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn ORDER BY n) AS k FROM prec),
    sm AS (SELECT conv_id, turn, n, clipped, rl, ol, CASE WHEN clipped = 0 THEN 1.0 / (pow(2, k) * greatest(total, 1)) ELSE clipped::DOUBLE / total END AS v FROM miss),
    smooth AS (SELECT conv_id, turn, CASE WHEN any_value(ol) = 0 OR min(clipped) FILTER (WHERE n = 1) = 0 THEN 0.0
        ELSE (CASE WHEN any_value(ol) > any_value(rl) THEN 1.0 ELSE exp(1.0 - any_value(rl)::DOUBLE / any_value(ol)) END)
             * exp(sum(ln(v)) / 4) END AS bleu FROM sm GROUP BY conv_id, turn)
"""
ROUGE_SQL = """
    sets AS (SELECT conv_id, turn, n, count(*) FILTER (WHERE side = 'r') AS rn, count(*) FILTER (WHERE side = 'o') AS otn, count(*) - count(DISTINCT g) AS shared
             FROM (SELECT conv_id, turn, n, g, 'r' AS side FROM ref_c UNION ALL SELECT conv_id, turn, n, g, 'o' FROM out_c) GROUP BY conv_id, turn, n),
    rouge AS (SELECT conv_id, turn, n, CASE WHEN shared > 0 THEN 2.0 * (shared::DOUBLE / otn) * (shared::DOUBLE / rn)
                 / (shared::DOUBLE / otn + shared::DOUBLE / rn) ELSE 0.0 END AS f FROM sets)
"""


@query(
    "overlap_scores",
    f"""
    WITH {SMOOTH_SQL}, {ROUGE_SQL}
    SELECT p.conv_id, p.turn, round(coalesce(r1.f, 0), 6) AS rouge_1, round(coalesce(r2.f, 0), 6) AS rouge_2,
           round(CASE WHEN len(out) > 0 THEN 2.0 * (len(out)::DOUBLE / len(ref)) / (1.0 + len(out)::DOUBLE / len(ref)) ELSE 0.0 END, 6) AS rouge_l,
           round(s.bleu, 6) AS smoothed_bleu
    FROM p JOIN smooth s USING (conv_id, turn) LEFT JOIN rouge r1 ON r1.conv_id = p.conv_id AND r1.turn = p.turn AND r1.n = 1
    LEFT JOIN rouge r2 ON r2.conv_id = p.conv_id AND r2.turn = p.turn AND r2.n = 2
    """,
)
def overlap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per reply; the output is a subsequence, so its whole length is common."""
    pairs = reply_pairs(spark, sf_dir)
    ref, out = F.col("ref"), F.col("out")
    return pairs.select(
        "conv_id",
        "turn",
        F.round(rouge_n(ref, out, 1), 6).alias("rouge_1"),
        F.round(rouge_n(ref, out, 2), 6).alias("rouge_2"),
        F.round(rouge_l(ref, out), 6).alias("rouge_l"),
        F.round(sentence_bleu(ref, out), 6).alias("smoothed_bleu"),
    )


@query("mean_text_metrics")
def mean_text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus means over characters (the longest common subsequence has no SQL form)."""
    pairs = reply_pairs(spark, sf_dir).select(
        F.col("assistant").alias("reference"), F.array_join("out", " ").alias("output")
    )
    return text_metrics(pairs)


@query(
    "entity_f1",
    f"""
    WITH {PAIRS_SQL},
    g AS (SELECT conv_id, turn, 'len' || (length(w) % 4) AS type, list(w) AS items FROM (SELECT conv_id, turn, unnest(ref) AS w FROM p) GROUP BY ALL),
    o AS (SELECT conv_id, turn, 'len' || (length(w) % 4) AS type, list(w) AS items FROM (SELECT conv_id, turn, unnest({sql_words('"user"')}) AS w FROM p) GROUP BY ALL),
    j AS (SELECT type, coalesce(g.items, []) AS gi, coalesce(o.items, []) AS oi FROM g FULL OUTER JOIN o USING (conv_id, turn, type)),
    f AS (SELECT type, len(list_intersect(list_distinct(gi), list_distinct(oi))) AS tp, len(gi) AS gn, len(oi) AS otn FROM j)
    SELECT type, round(avg(CASE WHEN tp > 0 THEN 2.0 * (tp::DOUBLE / otn) * (tp::DOUBLE / gn) / (tp::DOUBLE / otn + tp::DOUBLE / gn) ELSE 0.0 END), 6) AS f1,
           count(*) AS items FROM f GROUP BY type
    """,
)
def entity_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words typed by their length stand for entities; the user text is the prediction."""

    def typed(tokens):
        kind = F.transform(tokens, lambda w: F.concat(F.lit("len"), (F.length(w) % 4).cast("string")))
        return F.map_from_entries(
            F.filter(
                F.transform(
                    F.array(*(F.lit(f"len{i}") for i in range(4))),
                    lambda t: F.struct(
                        t.alias("type"),
                        F.filter(tokens, lambda w: F.concat(F.lit("len"), (F.length(w) % 4).cast("string")) == t).alias("items"),
                    ),
                ),
                lambda e: F.size(e["items"]) > 0,
            )
        )

    pairs = reply_pairs(spark, sf_dir)
    items = pairs.select(typed(F.col("ref")).alias("gold"), typed(words("user")).alias("pred"))
    scored = f1_by_type(items)
    return scored.select("type", F.round("f1", 6).alias("f1"), "items")


@query(
    "semantic_scores",
    f"""
    WITH {EXCHANGES_SQL},
    v AS (SELECT conv_id, turn, {letters_sql('assistant')} AS g, {letters_sql('"user"')} AS u FROM ex),
    missing AS (SELECT a.conv_id, a.turn FROM ex a WHERE (a.conv_id + a.turn) % 7 = 0)
    SELECT v.conv_id, v.turn, round(CASE WHEN m.conv_id IS NOT NULL THEN 0.0 ELSE
        coalesce(CASE WHEN list_sum(list_transform(g, lambda x: x * x)) > 0 AND list_sum(list_transform(u, lambda x: x * x)) > 0
                 THEN list_cosine_similarity(g::DOUBLE[], u::DOUBLE[]) END, 0.0) END, 6) AS score
    FROM v LEFT JOIN missing m ON v.conv_id = m.conv_id AND v.turn = m.turn
    """,
)
def semantic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies against user texts by letter vectors; some predictions are missing."""
    pairs = exchanges(table(spark, sf_dir, "conversations"))
    gold = pairs.select("conv_id", "turn", F.col("assistant").alias("answer"))
    pred = pairs.filter((F.col("conv_id") + F.col("turn")) % 7 != 0).select("conv_id", "turn", F.col("user").alias("answer"))
    joined = pair_predictions(gold, pred, ["conv_id", "turn"])
    score = semantic_score("gold", "prediction", letter_vector("gold"), letter_vector("prediction"))
    return joined.select("conv_id", "turn", F.round(score, 6).alias("score"))


@query(
    "preference_rewards",
    """
    WITH lp AS (SELECT vec_id, embedding, list_transform(embedding, lambda x, i: CASE WHEN i % 3 = 0 THEN 0 ELSE 1 END) AS mask FROM embeddings),
    m AS (SELECT vec_id,
        list_avg(list_transform(list_filter(embedding, lambda x, i: i % 3 <> 0), lambda x: -abs(x::DOUBLE))) AS pc,
        list_avg(list_transform(list_filter(embedding, lambda x, i: i % 3 <> 0), lambda x: -abs(x::DOUBLE) * 1.5 + x::DOUBLE)) AS pr,
        list_avg(list_transform(list_filter(embedding, lambda x, i: i % 3 <> 0), lambda x: x::DOUBLE - 1.0)) AS rc,
        list_avg(list_transform(list_filter(embedding, lambda x, i: i % 3 <> 0), lambda x: -x::DOUBLE - 1.0)) AS rr FROM embeddings),
    l AS (SELECT vec_id // 8 AS step, 0.2 * ((pc - pr) - (rc - rr)) AS z, 0.2 * (pc - rc) AS won, 0.2 * (pr - rr) AS lost FROM m)
    SELECT step::BIGINT AS step, round(avg(ln(1 + exp(-z)) * 0.9 + ln(1 + exp(z)) * 0.1), 6) AS loss, round(avg(won), 6) AS chosen_rewards,
           round(avg(lost), 6) AS rejected_rewards, sum(CASE WHEN won > lost THEN 1 ELSE 0 END)::BIGINT AS reward_accuracies,
           round(sum(won - lost), 6) AS margins FROM l GROUP BY step
    """,
)
def preference_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors stand for the logged log-probabilities of preference pairs, eight per step."""
    vectors = table(spark, sf_dir, "embeddings")
    mask = F.transform("embedding", lambda _, i: F.when((i + 1) % 3 == 0, 0).otherwise(1))

    def side(fn):
        return masked_mean(F.transform(F.col("embedding").cast("array<double>"), fn), mask)

    means = vectors.select(
        F.floor(F.col("vec_id") / F.lit(8)).alias("step"),
        side(lambda x: -F.abs(x)).alias("pc"),
        side(lambda x: -F.abs(x) * 1.5 + x).alias("pr"),
        side(lambda x: x - 1.0).alias("rc"),
        side(lambda x: -x - 1.0).alias("rr"),
    )
    scored = means.select("step", preference_loss("pc", "pr", "rc", "rr", smoothing=0.1).alias("result"))
    rounded = preference_metrics(scored)
    floats = ("loss", "chosen_rewards", "rejected_rewards", "margins")
    return rounded.select("step", "reward_accuracies", *(F.round(c, 6).alias(c) for c in floats))
