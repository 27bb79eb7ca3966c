"""Token rows: packing, padding, masks and shifts.

Tokens are words hashed to 16-bit ids, so every twin can recompute them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.arrays import (
    answer_mask,
    clip_ids,
    loss_mask,
    mask_prompt,
    pad_truncate,
    position_ids,
    shift_labels,
    shift_right,
)
from textmill.functions.tokens import hash_ids, words
from textmill.operators.conversations import exchanges
from textmill.operators.packing import pack, pack_groups
from textmill.plans.registered import documents, query, table
from textmill.plans.registered.chat import EXCHANGES_SQL
from textmill.plans.registered.sqltext import words as sql_words
from textmill.session import cut_lineage

END = 65536
PAD = 65537


def digest(ids: Column) -> Column:
    return F.md5(F.array_join(ids, ","))


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", hash_ids(words("text")).alias("input_ids"))


def stored_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded corpus, written once: packing reads lengths and ids separately."""
    return cut_lineage(token_rows(spark, sf_dir), "tokens")


HASH_SQL = "list_transform({w}, lambda w: ('0x' || substr(md5(w), 1, 4))::INTEGER)"
TOKENS_SQL = f"""
    ids AS (SELECT doc_id, {HASH_SQL.format(w=sql_words('text'))} AS input_ids FROM documents),
    flat AS (SELECT doc_id, unnest(input_ids) AS id, generate_subscripts(input_ids, 1) AS i FROM ids)
"""
PLACED_SQL = f"""
    {TOKENS_SQL}, placed AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS place FROM flat)
"""


@query(
    "packed_blocks",
    f"""
    WITH {PLACED_SQL}
    SELECT (place // 512)::BIGINT AS block_id, count(*)::INTEGER AS n, md5(string_agg(id::VARCHAR, ',' ORDER BY place)) AS digest
    FROM placed GROUP BY place // 512 HAVING count(*) = 512
    """,
)
def packed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = pack(stored_token_rows(spark, sf_dir), "doc_id")
    return blocks.select("block_id", F.size("input_ids").alias("n"), digest(F.col("input_ids")).alias("digest"))


@query(
    "packed_blocks_keep_rest",
    f"""
    WITH {PLACED_SQL}
    SELECT (place // 300)::BIGINT AS block_id, count(*)::INTEGER AS n, md5(string_agg(id::VARCHAR, ',' ORDER BY place)) AS digest
    FROM placed GROUP BY place // 300
    """,
)
def packed_blocks_keep_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = pack(stored_token_rows(spark, sf_dir), "doc_id", block=300, tail="keep")
    return blocks.select("block_id", F.size("input_ids").alias("n"), digest(F.col("input_ids")).alias("digest"))


@query(
    "packed_groups",
    f"""
    WITH {TOKENS_SQL},
    numbered AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents),
    g AS (SELECT row_no // 100 AS group_id, id, row_number() OVER (PARTITION BY row_no // 100 ORDER BY row_no, i) - 1 AS place
          FROM flat JOIN numbered USING (doc_id)),
    total AS (SELECT group_id, count(*) AS n FROM g GROUP BY group_id),
    frame AS (SELECT group_id, n, unnest(range(0, CASE WHEN n >= 128 THEN (n // 128 + 1) * 128 ELSE n END)) AS place FROM total)
    SELECT f.group_id::BIGINT AS group_id, (f.place // 128)::BIGINT AS block_id, count(*)::INTEGER AS n,
           md5(string_agg(coalesce(g.id, {END})::VARCHAR, ',' ORDER BY f.place)) AS ids,
           md5(string_agg(coalesce(g.id, -100)::VARCHAR, ',' ORDER BY f.place)) AS labels
    FROM frame f LEFT JOIN g ON f.group_id = g.group_id AND f.place = g.place
    GROUP BY f.group_id, f.place // 128
    """,
)
def packed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_token_rows(spark, sf_dir).withColumn("labels", F.col("input_ids"))
    blocks = pack_groups(rows, "doc_id", END, block=128, group=100)
    return blocks.select(
        "group_id",
        "block_id",
        F.size("input_ids").alias("n"),
        digest(F.col("input_ids")).alias("ids"),
        digest(F.col("labels")).alias("labels"),
    )


@query(
    "fixed_length_rows",
    f"""
    WITH {TOKENS_SQL}
    SELECT doc_id,
           md5(array_to_string(list_slice(input_ids || list_transform(range(0, 256), lambda z: {PAD}), 1, 256), ',')) AS padded,
           md5(array_to_string(list_slice(input_ids, 1, 255) || [{END}], ',')) AS clipped
    FROM ids
    """,
)
def fixed_length_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, sf_dir).select(
        "doc_id",
        digest(pad_truncate("input_ids", 256, PAD)).alias("padded"),
        digest(clip_ids("input_ids", 255, END)).alias("clipped"),
    )


@query(
    "position_and_loss_masks",
    f"""
    WITH {TOKENS_SQL},
    ended AS (SELECT doc_id, id, i FROM flat UNION ALL SELECT doc_id, {END}, 1000000000 FROM ids),
    placed AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS place FROM ended),
    seg AS (SELECT id, place, place // 512 AS block_id,
                   coalesce(sum(CASE WHEN id = {END} THEN 1 ELSE 0 END) OVER
                     (PARTITION BY place // 512 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM placed),
    pos AS (SELECT *, row_number() OVER (PARTITION BY block_id, s ORDER BY place) - 1 AS p FROM seg)
    SELECT block_id::BIGINT AS block_id, md5(string_agg(p::VARCHAR, ',' ORDER BY place)) AS positions,
           md5(string_agg(CASE WHEN id = {END} THEN '0' ELSE '1' END, ',' ORDER BY place)) AS losses
    FROM pos GROUP BY block_id HAVING count(*) = 512
    """,
)
def position_and_loss_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_token_rows(spark, sf_dir)
    ended = rows.withColumn("input_ids", F.concat("input_ids", F.array(F.lit(END))))
    return pack(ended, "doc_id").select(
        "block_id",
        digest(position_ids("input_ids", END)).alias("positions"),
        digest(loss_mask("input_ids", END)).alias("losses"),
    )


@query(
    "exchange_masks",
    f"""
    WITH {EXCHANGES_SQL},
    e AS (SELECT conv_id, turn, {HASH_SQL.format(w=sql_words('"user"'))} AS q, {HASH_SQL.format(w=sql_words('assistant'))} AS a FROM ex),
    x AS (SELECT *, q || a AS ids, list_transform(q, lambda z: -100) || a AS labels FROM e)
    SELECT conv_id, turn, md5(array_to_string(labels, ',')) AS labels,
           md5(array_to_string(list_transform(q, lambda z: 0) || a, ',')) AS answers,
           md5(array_to_string(list_slice(ids, 1, len(ids) - 1), ',')) AS inputs,
           md5(array_to_string(list_slice(ids, 2, len(ids)), ',')) AS targets,
           md5(array_to_string([{END}] || list_transform(list_slice(labels, 1, len(labels) - 1),
               lambda z: CASE WHEN z = -100 THEN {PAD} ELSE z END), ',')) AS decoder_inputs
    FROM x
    """,
)
def exchange_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = exchanges(table(spark, sf_dir, "conversations")).select(
        "conv_id", "turn", hash_ids(words("user")).alias("q"), hash_ids(words("assistant")).alias("a")
    )
    rows = pairs.select("conv_id", "turn", "q", "a", F.concat("q", "a").alias("ids")).withColumn(
        "labels", mask_prompt("ids", F.size("q"))
    )
    kinds = F.concat(F.transform("q", lambda _: F.lit(0)), F.transform("a", lambda _: F.lit(1)))
    shifted = shift_labels("ids")
    return rows.select(
        "conv_id",
        "turn",
        digest(F.col("labels")).alias("labels"),
        digest(answer_mask(kinds, "ids")).alias("answers"),
        digest(shifted["inputs"]).alias("inputs"),
        digest(shifted["labels"]).alias("targets"),
        digest(shift_right("labels", END, PAD)).alias("decoder_inputs"),
    )
