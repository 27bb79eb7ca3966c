"""Sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import strip
from textmill.operators.conversations import exchanges, first_turn
from textmill.operators.exploding import explode_structs
from textmill.operators.filters import article_pages, incubator_pages, restrict_titles
from textmill.operators.ordering import row_numbers
from textmill.operators.tagging import bio_spans
from textmill.plans.prepare import PAIR_SPECS, corpus_report, prepare
from textmill.plans.registered import documents, query, table
from textmill.plans.registered.chat import EXCHANGES_SQL
from textmill.plans.registered.corpus import COMPOSE_SQL, INSTRUCTIONS_SQL, TASK_SQL, instruction_rows
from textmill.plans.registered.sqltext import strip as sql_strip
from textmill.plans.registered.tags import TAGS_SQL, tagged
from textmill.session import scratch_path
from textmill.sources.readers import (
    CHAT,
    INSTRUCTION,
    good_records,
    read_articles,
    read_conll,
    read_dir,
    read_json_array,
    read_jsonl,
    read_lines,
    read_parquet,
    read_sep_text,
    read_wiki_dump,
)
from textmill.sources.writers import write_json, write_json_array, write_parquet, write_sep_text
from textmill.streaming.ingest import ingest_counted, ingest_stream

PREPARED_SQL = f"""
    WITH {INSTRUCTIONS_SQL}, p AS (SELECT {COMPOSE_SQL} AS prompt, output AS response FROM instr WHERE {TASK_SQL}),
    c AS (SELECT replace(prompt, chr(13), '') AS prompt, replace(response, chr(13), '') AS response FROM p)
    SELECT md5(prompt) AS prompt, md5(response) AS response FROM c WHERE length(prompt) >= 15 AND length(response) >= 15
"""


def instruction_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "instructions")
    write_json(instruction_rows(spark, sf_dir).select("instruction", "input", "output"), path)
    return path


@query("json_lines_corpus", PREPARED_SQL)
def json_lines_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction files: JSON lines in, prepared pairs out."""
    raw = good_records(read_jsonl(spark, instruction_files(spark, sf_dir), INSTRUCTION))
    pairs = prepare(raw, PAIR_SPECS["belle"])
    return pairs.select(F.md5("prompt").alias("prompt"), F.md5("response").alias("response"))


@query("streamed_corpus", PREPARED_SQL)
def streamed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same corpus by incremental ingestion of the files."""
    source = instruction_files(spark, sf_dir)
    target, state = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    ingest_stream(spark, PAIR_SPECS["belle"], INSTRUCTION, source, target, state).awaitTermination()
    return read_parquet(spark, target).select(F.md5("prompt").alias("prompt"), F.md5("response").alias("response"))


@query(
    "ingestion_counts",
    f"""
    WITH {INSTRUCTIONS_SQL}, p AS (
        SELECT lang IS NOT DISTINCT FROM 'de' AS bad, {TASK_SQL} AS task,
               replace({COMPOSE_SQL}, chr(13), '') AS prompt, replace(output, chr(13), '') AS response FROM instr),
    t AS (SELECT count(*) AS rows_read, count(*) FILTER (WHERE bad) AS rows_rejected,
                 count(*) FILTER (WHERE NOT bad AND task AND length(prompt) >= 15 AND length(response) >= 15) AS rows_kept FROM p)
    SELECT counted, t.* FROM t, (VALUES ('batches'), ('files'), ('stored')) AS v(counted)
    """,
)
def ingestion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as observed in passing, as counted by file and as stored, where the lines of one language are cut short."""
    source = scratch_path(spark, "lines")
    line = F.to_json(F.struct("instruction", "input", "output"))
    cut = F.when(F.col("lang").eqNullSafe("de"), F.substring(line, 1, 12)).otherwise(line)
    instruction_rows(spark, sf_dir).select(cut.alias("value")).write.text(source)
    target, rejects, counts, state = (scratch_path(spark, k) for k in ("counted", "rejected", "counts", "counted-state"))
    # Several batches whatever the number of files.
    ingest_counted(
        spark, PAIR_SPECS["belle"], INSTRUCTION, source, target, rejects, counts, state, files_per_batch=4
    ).awaitTermination()
    rows = spark.read.parquet(counts)
    sums = [F.sum(c).alias(c) for c in ("rows_read", "rows_rejected", "rows_kept")]
    kind = F.when(F.col("source_file").isNull(), "batches").otherwise("files")
    counted = rows.groupBy(kind.alias("counted")).agg(*sums)
    read = rows.filter(F.col("source_file").isNotNull()).agg(F.sum("rows_read").alias("rows_read"))
    bad = spark.read.parquet(rejects).agg(F.count("*").alias("rows_rejected"))
    kept = spark.read.parquet(target).agg(F.count("*").alias("rows_kept"))
    # Three tables of one row.
    stored = read.join(F.broadcast(bad)).join(F.broadcast(kept)).select(F.lit("stored").alias("counted"), "rows_read", "rows_rejected", "rows_kept")
    return counted.unionByName(stored)


@query(
    "json_array_files",
    f"WITH {INSTRUCTIONS_SQL} SELECT md5(instruction) AS instruction, length(output)::INTEGER AS n FROM instr",
)
def json_array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one array each, a thousand records long."""
    path = scratch_path(spark, "arrays")
    numbered = row_numbers(instruction_rows(spark, sf_dir), "doc_id")
    row = F.struct("instruction", "input", "output")
    arrays = numbered.groupBy(F.floor(F.col("row_no") / F.lit(1000)).alias("file_no")).agg(
        F.to_json(F.collect_list(row)).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    raw = read_json_array(spark, path, INSTRUCTION)
    return raw.select(F.md5("instruction").alias("instruction"), F.length("output").alias("n"))


@query(
    "json_array_sink",
    f"WITH {INSTRUCTIONS_SQL} SELECT md5(instruction) AS instruction, md5(output) AS output FROM instr",
)
def json_array_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as arrays of 500 objects at most and read back."""
    path = scratch_path(spark, "array-sink")
    rows = instruction_rows(spark, sf_dir).select("instruction", "input", "output")
    write_json_array(rows, path, rows_per_file=500, keep_nulls=True)
    back = good_records(read_json_array(spark, path, INSTRUCTION, with_corrupt=True))
    return back.select(F.md5("instruction").alias("instruction"), F.md5("output").alias("output"))


@query(
    "nested_chat_files",
    f"WITH {EXCHANGES_SQL} SELECT md5(\"user\") AS human, md5(assistant) AS assistant FROM ex",
)
def nested_chat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "chats")
    turn = F.struct(F.col("user").alias("human"), "assistant")
    later = F.struct(F.lit("later").alias("human"), F.lit("later").alias("assistant"))
    pairs = exchanges(table(spark, sf_dir, "conversations"))
    write_json(pairs.select(F.array(turn, later).alias("conversation")), path)
    first = first_turn(good_records(read_jsonl(spark, path, CHAT)))
    return first.select(F.md5("human").alias("human"), F.md5("assistant").alias("assistant"))


@query(
    "files_by_source",
    f"""
    WITH {INSTRUCTIONS_SQL}
    SELECT source, count(*) AS rows_read, count(*) FILTER (WHERE length(output) >= 15) AS rows_kept,
           coalesce(sum(length(output)) FILTER (WHERE length(output) >= 15), 0)::BIGINT AS chars_kept
    FROM instr WHERE source <> 'src3' GROUP BY source
    """,
)
def files_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of per-source files, one of them skipped, with a report per source."""
    path = scratch_path(spark, "sources")
    rows = instruction_rows(spark, sf_dir).select("source", "instruction", "input", "output")
    rows.write.partitionBy("source").json(path)
    read = read_dir(spark, path + "/*", "json", INSTRUCTION)
    named = read.withColumn("source", F.regexp_extract("source_file", "source=([^/]+)/", 1))
    return corpus_report(named.filter(F.col("source") != "src3"), ["source"], "output", F.length("output") >= 15)


@query(
    "parquet_round_trip",
    "SELECT lang, count(*) AS docs, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang",
)
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to one gzip dataset; half the rows each."""
    path = scratch_path(spark, "parquet")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    even = F.col("doc_id") % 2 == 0
    write_parquet(docs.filter(even), path, mode="errorifexists")
    write_parquet(docs.filter(~even), path)
    stored = read_parquet(spark, path, "lang", "text")
    return stored.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"))


@query(
    "sep_text_lines",
    f"""
    WITH {INSTRUCTIONS_SQL}
    SELECT md5(replace(instruction, chr(10), ' ') || '[SEP]' || replace(output, chr(10), ' ')) AS line FROM instr
    """,
)
def sep_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sep")
    rows = instruction_rows(spark, sf_dir).select(
        F.replace("instruction", F.lit("\n"), F.lit(" ")).alias("prompt"),
        F.replace("output", F.lit("\n"), F.lit(" ")).alias("response"),
    )
    write_sep_text(rows, path)
    return read_lines(spark, path).select(F.md5("line").alias("line"))


@query(
    "escaped_sep_lines",
    f"WITH {INSTRUCTIONS_SQL} SELECT md5(instruction) AS prompt, md5(coalesce(output, '')) AS response FROM instr",
)
def escaped_sep_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with their line breaks through separator files and back."""
    path = scratch_path(spark, "escaped-sep")
    write_sep_text(instruction_rows(spark, sf_dir), path, "instruction", "output", escape=True)
    back = read_sep_text(spark, path)
    return back.select(F.md5("prompt").alias("prompt"), F.md5("response").alias("response"))


@query(
    "article_files",
    """
    SELECT md5(regexp_replace(regexp_replace(text, '^\\n+|\\n+$', '', 'g'), '\\n+', chr(10), 'g')) AS article FROM documents
    WHERE length(replace(text, chr(10), '')) > 0
    """,
)
def article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank-line separated articles in plain text files."""
    path = scratch_path(spark, "articles")
    body = F.regexp_replace(F.regexp_replace("text", r"^\n+|\n+$", ""), r"\n+", "\n")
    docs = documents(spark, sf_dir, "text").select(body.alias("value")).filter(F.length("value") > 0)
    docs.write.option("lineSep", "\n\n").text(path)
    return read_articles(spark, path).select(F.md5("article").alias("article"))


@query(
    "tagged_files",
    f"WITH {TAGS_SQL} SELECT type, count(*) AS spans, sum(length(text))::BIGINT AS chars FROM spans GROUP BY type",
)
def tagged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged sentences in word-per-line files with CRLF breaks."""
    path = scratch_path(spark, "tagged")
    lines = F.transform(F.arrays_zip("chars", "labels"), lambda p: F.concat_ws(" ", p["chars"], p["labels"]))
    rows = tagged(spark, sf_dir).filter(F.size("chars") > 0).select(F.array_join(lines, "\r\n").alias("value"))
    rows.write.option("lineSep", "\r\n\r\n").text(path)
    spans = explode_structs(read_conll(spark, path), [], bio_spans("chars", "labels"))
    return spans.groupBy("type").agg(F.count("*").alias("spans"), F.sum(F.length("text")).alias("chars"))


@query(
    "tagged_files_any_break",
    f"WITH {TAGS_SQL} SELECT type, count(*) AS spans, sum(length(text))::BIGINT AS chars FROM spans GROUP BY type",
)
def tagged_files_any_break(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sentences in files that mix LF and CRLF."""
    path = scratch_path(spark, "tagged-mixed")
    lines = F.transform(F.arrays_zip("chars", "labels"), lambda p: F.concat_ws(" ", p["chars"], p["labels"]))
    sentence = F.when(F.hash("chars") % 2 == 0, F.array_join(lines, "\r\n")).otherwise(F.array_join(lines, "\n"))
    rows = tagged(spark, sf_dir).filter(F.size("chars") > 0).select(sentence.alias("value"))
    rows.write.option("lineSep", "\n\n").text(path)
    spans = explode_structs(read_conll(spark, path, line_break=None), [], bio_spans("chars", "labels"))
    return spans.groupBy("type").agg(F.count("*").alias("spans"), F.sum(F.length("text")).alias("chars"))


@query(
    "wiki_dump_pages",
    f"""
    SELECT doc_id AS id, source || '/' || lang || '/' || doc_id AS title, md5({sql_strip("text")}) AS text FROM documents
    WHERE doc_id % 5 <> 0 AND lang <> 'de'
    """,
)
def wiki_dump_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page dump: redirects and foreign namespaces are left out."""
    path = scratch_path(spark, "dump")
    docs = documents(spark, sf_dir, "doc_id", "lang", "source", "text")
    title = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    pages = docs.select(
        F.when(F.col("lang") == "de", F.concat(F.lit("Help:"), title)).otherwise(title).alias("title"),
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 5 == 0, F.struct(F.lit("x").alias("_title"))).alias("redirect"),
        F.struct(F.col("doc_id").alias("id"), F.struct(strip("text").alias("_VALUE")).alias("text")).alias("revision"),
    )
    pages.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").option("compression", "bzip2").save(path)
    kept = article_pages(read_wiki_dump(spark, path))
    return kept.select("id", "title", F.md5(F.coalesce("text", F.lit(""))).alias("text"))


@query(
    "incubator_titles",
    """
    SELECT doc_id AS id, doc_id::VARCHAR AS title, 'tag-' || source AS tags FROM documents WHERE lang = 'fr' AND source <> 'src1'
    """,
)
def incubator_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one language, kept and tagged by a title list."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    pages = docs.select(
        F.col("doc_id").alias("id"), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("title")
    )
    listed = docs.filter(F.col("source") != "src1").select(
        F.col("doc_id").cast("string").alias("title"), F.concat(F.lit("tag-"), "source").alias("tags")
    )
    return restrict_titles(incubator_pages(pages, "fr"), listed).select("id", "title", "tags")
