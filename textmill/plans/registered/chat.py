"""Conversations: first turns, preference rows, history budgets, rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.prompts import render_chat, render_question, render_reply, trim_generation
from textmill.functions.text import add_end
from textmill.operators.conversations import collect_history, exchanges, first_turn_by_role, fit_history
from textmill.operators.filters import max_len, to_preference, valid_pairs
from textmill.plans.registered import query, table

EXCHANGES_SQL = """
    ex AS (SELECT a.conv_id, a.turn, a.text AS "user", b.text AS assistant FROM conversations a JOIN conversations b
           ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant')
"""


@query(
    "first_turns",
    """
    SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS human,
           arg_min(text, turn) FILTER (WHERE role = 'assistant') AS assistant
    FROM conversations GROUP BY conv_id
    """,
)
def first_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return first_turn_by_role(turns, {"user": "human", "assistant": "assistant"})


@query(
    "instruction_exchanges",
    f"""
    WITH {EXCHANGES_SQL}
    SELECT conv_id, turn,
           '<|im_start|>问：' || chr(10) || regexp_replace(replace("user", '答：', ''), '^\\s+|\\s+$', '', 'g')
             || chr(10) || '答：' || chr(10) AS question,
           regexp_replace(assistant, '^\\s+|\\s+$', '', 'g') || chr(10) || '<|im_end|>' AS reply FROM ex
    """,
)
def instruction_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = exchanges(table(spark, sf_dir, "conversations"))
    return pairs.select(
        "conv_id", "turn", render_question("user").alias("question"), render_reply("assistant").alias("reply")
    )


PREFERENCE_SQL = f"""
    {EXCHANGES_SQL},
    other AS (SELECT conv_id - 1 AS conv_id, arg_min(assistant, turn) AS rejected FROM ex GROUP BY conv_id),
    pref AS (SELECT e.conv_id, e.turn, e."user" AS prompt, e.assistant AS chosen, o.rejected
             FROM ex e JOIN other o ON e.conv_id = o.conv_id)
"""


def preference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn, its reply, and the first reply of the next conversation as the worse answer."""
    pairs = exchanges(table(spark, sf_dir, "conversations"))
    worse = pairs.groupBy((F.col("conv_id") - 1).alias("conv_id")).agg(F.min_by("assistant", "turn").alias("reject"))
    return pairs.join(worse, "conv_id").select(
        "conv_id", "turn", F.col("user").alias("prompt"), F.col("assistant").alias("chosen"), "reject"
    )


@query(
    "preference_pairs",
    f"""
    WITH {PREFERENCE_SQL}
    SELECT prompt || '[EOS]' AS prompt, chosen || '[EOS]' AS chosen, rejected || '[EOS]' AS rejected FROM pref
    WHERE length(prompt) <= 256 AND length(chosen) <= 256 AND length(rejected) <= 256
      AND length(prompt) > 0 AND length(chosen) > 0 AND length(rejected) > 0
      AND regexp_replace(chosen, '^\\s+|\\s+$', '', 'g') <> regexp_replace(rejected, '^\\s+|\\s+$', '', 'g')
    """,
)
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_preference(preference_rows(spark, sf_dir), rejected="reject")
    kept = valid_pairs(max_len(rows, prompt=256, chosen=256, rejected=256))
    return kept.select(*(add_end(c, "[EOS]").alias(c) for c in ("prompt", "chosen", "rejected")))


HISTORY_SQL = f"""
    {EXCHANGES_SQL},
    lastq AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS query
              FROM conversations WHERE role = 'user' GROUP BY conv_id),
    priced AS (SELECT e.*, q.query, sum(length("user") + length(assistant) + 20) OVER
                 (PARTITION BY e.conv_id ORDER BY e.turn DESC) AS used
               FROM ex e JOIN lastq q ON e.conv_id = q.conv_id AND e.turn < q.last_turn),
    fitted AS (SELECT * FROM priced WHERE used + 10 < 2048)
"""


def past_exchanges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    turns = table(spark, sf_dir, "conversations")
    last = (
        turns.filter(F.col("role") == "user")
        .groupBy("conv_id")
        .agg(F.max("turn").alias("last_turn"), F.max_by("text", "turn").alias("query"))
    )
    past = exchanges(turns).join(last.select("conv_id", "last_turn"), "conv_id")
    return past.filter(F.col("turn") < F.col("last_turn")).drop("last_turn"), last.select("conv_id", "query")


def fitted_history(past: DataFrame) -> DataFrame:
    cost = F.length("user") + F.length("assistant") + 20
    return fit_history(past, cost, budget=2048, least_cost=20, system_cost=10)


@query(
    "history_budget",
    f"WITH {HISTORY_SQL} SELECT conv_id, turn, used::BIGINT AS history_cost FROM fitted",
)
def history_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, _ = past_exchanges(spark, sf_dir)
    return fitted_history(past).select("conv_id", "turn", "history_cost")


@query(
    "chat_prompts",
    f"""
    WITH {HISTORY_SQL},
    h AS (SELECT conv_id, string_agg(chr(10) || '<|im_start|>user' || chr(10) || "user" || '<|im_end|>' || chr(10)
              || '<|im_start|>assistant' || chr(10) || assistant || '<|im_end|>', '' ORDER BY turn) AS past
          FROM fitted GROUP BY conv_id)
    SELECT q.conv_id, '<|im_start|>system' || chr(10) || 'Answer.' || '<|im_end|>' || coalesce(past, '')
           || chr(10) || '<|im_start|>user' || chr(10) || query || '<|im_end|>' || chr(10)
           || '<|im_start|>assistant' || chr(10) AS prompt
    FROM lastq q LEFT JOIN h ON q.conv_id = h.conv_id
    """,
)
def chat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, last = past_exchanges(spark, sf_dir)
    rows = last.join(collect_history(fitted_history(past)), "conv_id", "left")
    none = F.array().cast("array<struct<user:string,assistant:string>>")
    filled = rows.withColumn("history", F.coalesce("history", none))
    return filled.select("conv_id", render_chat("query", "history", "Answer.").alias("prompt"))


@query(
    "trimmed_replies",
    f"""
    WITH {EXCHANGES_SQL},
    s AS (SELECT conv_id, turn, assistant, regexp_replace(replace(assistant, ' the ', ''), '^\\s+|\\s+$', '', 'g') AS t FROM ex)
    SELECT conv_id, turn, regexp_replace(split_part(t, '.', 1), '^\\s+|\\s+$', '', 'g') AS text,
           CASE WHEN contains(t, '.') THEN 'Gen ''.''' ELSE 'Gen length ' || length(assistant) END AS end_reason
    FROM s
    """,
)
def trimmed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = exchanges(table(spark, sf_dir, "conversations"))
    trimmed = pairs.withColumn("t", trim_generation("assistant", [" the "], ["."]))
    return trimmed.select("conv_id", "turn", "t.text", "t.end_reason")
