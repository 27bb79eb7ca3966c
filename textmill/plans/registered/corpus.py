"""Cleaning, filtering, composing, de-duplicating and reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import (
    add_end,
    after_first_sentence,
    clean_chunk,
    clip_then_end,
    collapse_punct,
    compose_optional,
    compose_prompt,
    dice_chars,
    first_sentence,
    fix_wiki_marks,
    map_chars,
    map_phrases,
    normalise_line,
    pick_template,
    strip,
    strip_cr,
    to_document,
    to_sample,
    to_zh_punct,
    unescape_newline,
)
from textmill.operators.dedup import content_key, dedup_exact, exclude_sources, first_per_key, merge_datasets
from textmill.operators.filters import (
    drop_tasks,
    max_len,
    min_len,
    min_score,
    truncate_pair,
    valid_instruction,
    valid_pairs,
)
from textmill.operators.ordering import PRIME, permuted_positions, round_keys, shard_rows, split_rows
from textmill.plans.prepare import PAIR_SPECS, SAMPLE_SPECS, corpus_report_total, corpus_totals, prepare, prepare_samples
from textmill.plans.registered import documents, query, table
from textmill.plans.registered.sqltext import collapse, collapse_sft, dice, hash32, lit, strip as sql_strip, zh_punct

CLEAN_SQL = collapse(zh_punct("replace(text, chr(13), '')"))


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "lang", "source", "text")
    return docs.withColumn("clean", collapse_punct(to_zh_punct(strip_cr("text"))))


@query(
    "clean_dedup_report",
    f"""
    WITH c AS (SELECT doc_id, lang, source, {CLEAN_SQL} AS clean FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY doc_id) AS rn FROM c WHERE length(clean) >= 15)
    SELECT lang, source, count(*) AS docs, sum(length(clean))::BIGINT AS chars
    FROM k WHERE rn = 1 GROUP BY lang, source
    """,
)
def clean_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and source: documents and characters left after cleaning and de-duplication.

    Only the digest and the length of a cleaned text are shuffled, never the text.
    """
    clean = cleaned_documents(spark, sf_dir).select(
        "doc_id", "lang", "source", F.length("clean").alias("chars"), content_key(F.col("clean")).alias("_key")
    )
    # Equal texts have equal lengths, so the length rule may follow the de-duplication
    # and the cleaning is evaluated once.
    kept = first_per_key(clean, ["_key"], ["doc_id"]).filter(F.col("chars") >= 15)
    return kept.groupBy("lang", "source").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"))


@query(
    "clean_texts",
    f"SELECT doc_id, {CLEAN_SQL} AS clean, length({CLEAN_SQL})::INTEGER AS n FROM documents",
)
def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_documents(spark, sf_dir).select("doc_id", "clean", F.length("clean").alias("n"))


@query(
    "collapse_sft_variant",
    f"SELECT doc_id, {collapse_sft('text')} AS clean FROM documents",
)
def collapse_sft_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "doc_id", "text").select("doc_id", collapse_punct("text", variant="t5_sft").alias("clean"))


WIKI_SQL = (
    "regexp_replace(regexp_replace(regexp_replace({c}, '[「」｢｣『』]', '\"', 'g'), '[，；]）', '）', 'g'), '[（(]，', '（', 'g')"
)


@query(
    "normalise_lines",
    f"""
    SELECT doc_id, i AS line_no, {collapse(zh_punct(WIKI_SQL.format(c="translate(line, 'éèêëç', 'eeeec')")))} AS line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS i FROM documents)
    """,
)
def normalise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line normaliser with a character mapping table, mark repair, punctuation and collapsing."""
    mapping = dict(zip("éèêëç", "eeeec"))
    lines = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.select("doc_id", "line_no", normalise_line("line", mapping).alias("line"))


HEAD_SQL = "split_part(text, '.', 1)"
REST_SQL = "substr(text, length(split_part(text, '.', 1)) + 2)"


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows: first sentence, second line or nothing as input, the rest as output."""
    docs = documents(spark, sf_dir, "doc_id", "lang", "source", "text")
    return docs.select(
        "doc_id",
        "lang",
        "source",
        first_sentence("text").alias("instruction"),
        F.split_part("text", F.lit("\n"), F.lit(2)).alias("input"),
        after_first_sentence("text").alias("output"),
    )


INSTRUCTIONS_SQL = f"""
    instr AS (SELECT doc_id, lang, source, {HEAD_SQL} AS instruction,
                     split_part(text, chr(10), 2) AS input, {REST_SQL} AS output FROM documents)
"""


@query(
    "dice_similarity",
    f"WITH {INSTRUCTIONS_SQL} SELECT doc_id, round({dice('instruction', 'input')}, 6) AS dice FROM instr",
)
def dice_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instruction_rows(spark, sf_dir)
    return rows.select("doc_id", F.round(dice_chars("instruction", "input"), 6).alias("dice"))


COMPOSE_SQL = f"CASE WHEN {dice('instruction', 'input')} > 0.9 THEN instruction ELSE instruction || input END"


@query(
    "composed_prompts",
    f"""
    WITH {INSTRUCTIONS_SQL}
    SELECT doc_id, {COMPOSE_SQL} AS prompt,
           CASE WHEN length({sql_strip('input')}) = 0 THEN instruction ELSE instruction || ',' || input END AS optional_prompt
    FROM instr
    """,
)
def composed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_rows(spark, sf_dir).select(
        "doc_id",
        compose_prompt("instruction", "input").alias("prompt"),
        compose_optional("instruction", "input", sep=",", strip_extra=True).alias("optional_prompt"),
    )


TASK_SQL = (
    "NOT (contains(instruction, '翻译') OR contains(lower(instruction), 'translate') OR contains(instruction, '表格') "
    "OR contains(instruction, '-----') OR contains(output, '-----'))"
)
TASK_SFT_SQL = (
    "NOT (contains(instruction, '翻译') OR contains(output, 'translate') OR contains(instruction, '表格') "
    "OR contains(instruction, '-----') OR contains(output, '-----'))"
)


@query(
    "pair_corpus",
    f"""
    WITH {INSTRUCTIONS_SQL}, p AS (SELECT doc_id, {COMPOSE_SQL} AS prompt, output AS response FROM instr WHERE {TASK_SQL})
    SELECT doc_id, replace(prompt, chr(13), '') AS prompt, replace(response, chr(13), '') AS response FROM p
    WHERE length(replace(prompt, chr(13), '')) >= 15 AND length(replace(response, chr(13), '')) >= 15
    """,
)
def pair_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(instruction_rows(spark, sf_dir), PAIR_SPECS["belle"], ("doc_id",))


@query(
    "sample_corpus",
    f"""
    WITH {INSTRUCTIONS_SQL}, p AS (SELECT doc_id, {COMPOSE_SQL} AS prompt, output FROM instr WHERE {TASK_SQL})
    SELECT doc_id, replace(prompt, chr(13), '') || replace(output, chr(13), '') || '<EOS>' AS prompt FROM p
    WHERE length(replace(output, chr(13), '')) >= 15
    """,
)
def sample_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_samples(instruction_rows(spark, sf_dir), SAMPLE_SPECS["belle"], ("doc_id",))


SFT_PROMPT_SQL = f"CASE WHEN {dice('instruction', 'input')} > 0.9 THEN instruction ELSE instruction || ' ' || input END"


@query(
    "sft_corpus",
    f"""
    WITH {INSTRUCTIONS_SQL}, p AS (
        SELECT doc_id, replace({SFT_PROMPT_SQL}, chr(13), '') AS prompt, output FROM instr WHERE {TASK_SFT_SQL}),
    c AS (SELECT doc_id, {collapse_sft('prompt')} AS prompt,
                 {collapse_sft("replace(output, chr(13), '')")} AS response, output FROM p)
    SELECT doc_id, prompt, response FROM c WHERE length(prompt) >= 5 AND length(output) >= 5
    """,
)
def sft_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(instruction_rows(spark, sf_dir), PAIR_SPECS["sft"], ("doc_id",))


@query(
    "rated_corpus",
    f"""
    WITH {INSTRUCTIONS_SQL},
    r AS (SELECT i.doc_id, instruction AS title, input AS "desc", output AS content, (5 * quality)::INTEGER AS star
          FROM instr i JOIN labels l ON i.doc_id = l.doc_id),
    p AS (SELECT doc_id, CASE WHEN {dice('title', '"desc"')} > 0.9 THEN title ELSE title || "desc" END AS prompt,
                 content AS response FROM r WHERE star >= 5)
    SELECT doc_id, replace(prompt, chr(13), '') AS prompt, replace(response, chr(13), '') AS response FROM p
    WHERE length(replace(prompt, chr(13), '')) >= 15 AND length(replace(response, chr(13), '')) >= 15
    """,
)
def rated_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instruction_rows(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    rated = rows.select(
        "doc_id",
        F.col("instruction").alias("title"),
        F.col("input").alias("desc"),
        F.col("output").alias("content"),
        (F.col("quality") * 5).alias("star"),
    )
    return prepare(rated, PAIR_SPECS["webtext"], ("doc_id",))


@query(
    "high_quality_documents",
    "SELECT d.doc_id, d.lang, d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality >= 1",
)
def high_quality_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = min_score(table(spark, sf_dir, "labels"), "quality", 1).select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(good, "doc_id")


@query(
    "length_filters",
    f"""
    WITH {INSTRUCTIONS_SQL}
    SELECT doc_id, 'both_15' AS rule FROM instr WHERE length(instruction) >= 15 AND length(output) >= 15
    UNION ALL SELECT doc_id, 'merge_3' FROM instr WHERE length(instruction) >= 3 AND length(output) >= 3
    UNION ALL SELECT doc_id, 'short_256' FROM instr WHERE length(instruction) <= 256 AND length(input) <= 256 AND length(output) <= 256
    UNION ALL SELECT doc_id, 'alpaca' FROM instr
      WHERE length(instruction) <= 256 AND length(input) <= 256 AND length(instruction) > 0 AND length(output) > 0
    """,
)
def length_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every length rule in one pass: a row is emitted per rule it meets."""
    rows = instruction_rows(spark, sf_dir)
    head, extra, out = F.length("instruction"), F.length("input"), F.length("output")
    rules = {
        "both_15": (head >= 15) & (out >= 15),
        "merge_3": (head >= 3) & (out >= 3),
        "short_256": (head <= 256) & (extra <= 256) & (out <= 256),
        "alpaca": valid_instruction("instruction", "input", "output"),
    }
    names = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules.items())))
    return rows.select("doc_id", F.explode(names).alias("rule"))


@query(
    "truncated_pairs",
    f"""
    WITH {INSTRUCTIONS_SQL}, p AS (SELECT doc_id, instruction, output,
        (length(instruction) > 512 OR length(output) > 512) AS cut FROM instr
        WHERE length(instruction) >= 3 AND length(output) >= 3)
    SELECT doc_id, CASE WHEN cut THEN substr(instruction, 1, 512) ELSE instruction END AS prompt,
           CASE WHEN cut THEN substr(output, 1, 512) ELSE output END AS response,
           substr(output, 1, 251) || '[EOS]' AS clipped
    FROM p
    """,
)
def truncated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instruction_rows(spark, sf_dir).select(
        "doc_id", F.col("instruction").alias("prompt"), F.col("output").alias("response")
    )
    clipped = min_len(rows, prompt=3, response=3).withColumn("clipped", clip_then_end("response", 256))
    return truncate_pair(clipped).select("doc_id", "prompt", "response", "clipped")


@query(
    "merged_sources",
    f"""
    WITH {INSTRUCTIONS_SQL},
    u AS (SELECT 'instructions' AS source, instruction AS prompt, output AS response FROM instr
          UNION ALL SELECT 'conversations', a.text, b.text FROM conversations a JOIN conversations b
            ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant')
    SELECT source, count(*) AS rows, sum(length(prompt || '[SEP]' || response))::BIGINT AS chars,
           sum(('0x' || substr(md5(prompt || '[SEP]' || response), 1, 8))::BIGINT)::BIGINT AS checksum
    FROM u WHERE length(prompt) >= 3 AND length(response) >= 3 GROUP BY source
    """,
)
def merged_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmill.operators.conversations import exchanges
    from textmill.sources.writers import sep_line

    pairs = instruction_rows(spark, sf_dir).select(F.col("instruction").alias("prompt"), F.col("output").alias("response"))
    chat = exchanges(table(spark, sf_dir, "conversations")).select(
        F.col("user").alias("prompt"), F.col("assistant").alias("response")
    )
    merged = min_len(merge_datasets(instructions=pairs, conversations=chat), prompt=3, response=3)
    lines = merged.select("source", sep_line("prompt", "response").alias("line"))
    part = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("long")
    return lines.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum(F.length("line")).alias("chars"), F.sum(part).alias("checksum")
    )


@query(
    "exact_dedup",
    "SELECT min(doc_id) AS doc_id, length(text)::INTEGER AS n FROM documents GROUP BY text",
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(table(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id", F.length("text").alias("n"))


@query(
    "source_report",
    f"""
    WITH {INSTRUCTIONS_SQL}
    SELECT source, count(*) AS rows_read, count(*) FILTER (WHERE length(output) >= 15) AS rows_kept,
           coalesce(sum(length(output)) FILTER (WHERE length(output) >= 15), 0)::BIGINT AS chars_kept
    FROM instr GROUP BY ROLLUP (source)
    """,
)
def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instruction_rows(spark, sf_dir)
    return corpus_report_total(rows, "source", "output", F.length("output") >= 15)


@query(
    "corpus_size",
    r"SELECT count(*) AS rows, sum(length(text))::BIGINT AS chars, "
    r"sum(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')))::BIGINT AS tokens FROM documents",
)
def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmill.functions.tokens import words

    docs = table(spark, sf_dir, "documents").select("text", words("text").alias("ids"))
    return corpus_totals(docs, "text", "ids")


@query(
    "template_choice",
    f"""
    SELECT doc_id, replace(list_extract([{", ".join(lit(t) for t in __import__("textmill.functions.prompts", fromlist=["x"]).WIKI_QUESTIONS)}],
           ({hash32("doc_id::VARCHAR")} % 20 + 1)::BIGINT), '{{}}', {HEAD_SQL}) AS prompt FROM documents
    """,
)
def template_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmill.functions.prompts import WIKI_QUESTIONS, fill_title

    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", fill_title(pick_template("doc_id", WIKI_QUESTIONS), first_sentence("text")).alias("prompt"))


@query(
    "train_test_split",
    f"""
    SELECT doc_id, CASE WHEN {hash32("doc_id::VARCHAR || '#0'")} / 4294967296.0 < 0.1 THEN 'test' ELSE 'train' END AS split,
           ({hash32("doc_id::VARCHAR")} % 8)::INTEGER AS shard FROM documents
    """,
)
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return shard_rows(split_rows(docs, "doc_id"), "doc_id", 8)


@query(
    "epoch_shuffle",
    """
    SELECT (row_number() OVER (ORDER BY md5(doc_id::VARCHAR || '#7'), doc_id) - 1)::BIGINT AS place, doc_id FROM documents
    """,
)
def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textmill.operators.ordering import shuffled_positions

    return shuffled_positions(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", seed=7)


@query(
    "line_fields",
    f"""
    SELECT doc_id, split_part({sql_strip('text')}, chr(9), 1) AS document,
           translate(text, ',' || chr(10) || chr(9), '') AS chunk,
           replace(text, '\\n', chr(10)) AS unescaped FROM documents
    """,
)
def line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        to_document("text").alias("document"),
        clean_chunk("text").alias("chunk"),
        unescape_newline("text").alias("unescaped"),
    )


EPOCH_SEED = 7
ROUND_ROWS = ", ".join(f"({i}, {k}, {a}, {b}, {c})" for i, (k, a, b, c) in enumerate(round_keys(EPOCH_SEED)))


@query(
    "epoch_permutation",
    f"""
    WITH RECURSIVE keys(i, k, a, b, c) AS (
        SELECT i::INTEGER, k::BIGINT, a::BIGINT, b::BIGINT, c::BIGINT FROM (VALUES {ROUND_ROWS}) AS v(i, k, a, b, c)),
    size AS (SELECT count(*)::BIGINT AS n FROM documents),
    walk(doc_id, i, x) AS (
        SELECT doc_id, 0, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT FROM documents
        UNION ALL
        SELECT doc_id, i + 1, CASE WHEN ((m * m + c) % {PRIME}) % 2 = 1 THEN p ELSE x END FROM (
            SELECT *, ((greatest(x, p) % {PRIME}) * a + b) % {PRIME} AS m FROM (
                SELECT walk.doc_id, walk.i, walk.x, a, b, c, ((k % n) - x + n) % n AS p
                FROM walk JOIN keys ON keys.i = walk.i, size)))
    SELECT x AS place, doc_id FROM walk WHERE i = (SELECT count(*) FROM keys)
    """,
)
def epoch_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place of its own for every document, computed from its number."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return permuted_positions(docs, "doc_id", EPOCH_SEED).select("place", "doc_id")


@query("sources_left_out", "SELECT doc_id, source FROM documents WHERE source NOT IN ('src3', 'src1')")
def sources_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_sources(table(spark, sf_dir, "documents").select("doc_id", "source"), "src3", "src1", column="source")


PHRASES = {"hand": "H", "and": "&", "er": "ER", "ight": "ite"}


@query(
    "phrase_mapped_texts",
    "SELECT doc_id, md5(replace(replace(replace(replace(text, 'hand', 'H'), 'ight', 'ite'), 'and', '&'), 'er', 'ER')) AS mapped FROM documents",
)
def phrase_mapped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary whose phrases contain one another: the longest at a place counts."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", F.md5(map_phrases("text", PHRASES)).alias("mapped"))
