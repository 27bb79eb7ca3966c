"""Chunkers over whole documents (the full stop stands for the sentence mark)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.prompts import WIKI_QUESTIONS
from textmill.functions.text import first_sentence, let
from textmill.operators.articles import wiki_samples
from textmill.operators.chunking import (
    as_documents,
    block_chunks,
    build_chunks,
    explode_chunks,
    page_header,
    rule_chunks,
    sliding_chunks,
    split_long,
    split_overlap,
    split_recursive,
    text_blocks,
)
from textmill.operators.exploding import built_rows, explode_items
from textmill.operators.filters import noise_line, page_text
from textmill.plans.registered import documents, query
from textmill.plans.registered.sqltext import collapse, hash32, lit, strip as sql_strip, zh_punct
from textmill.plans.registered.corpus import HEAD_SQL, WIKI_SQL

STOP = "."
NOISE_SQL = (
    "(contains({l}, repeat('.', 20)) OR contains({l}, '目录') OR length({l}) < 1 OR regexp_full_match({l}, '\\p{{Nd}}+'))"
)


def noise_sql(line: str) -> str:
    return NOISE_SQL.format(l=sql_strip(line))


PAGE_SQL = f"""
    page AS (SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, chr(10)),
               lambda l: NOT {noise_sql('l')}), lambda l: {sql_strip('l')}), '') AS page FROM documents)
"""
LONG_SQL = """
    long AS (SELECT doc_id, n, CASE
        WHEN length(text) < 6 THEN []
        WHEN length(text) > n THEN list_transform(list_filter(list_transform(string_split(text, mark), lambda x: replace(x, chr(10), '')),
             lambda x: length(x) < n AND length(x) > 5), lambda x: translate(x, ',' || chr(10) || chr(9), ''))
        ELSE [translate(text, ',' || chr(10) || chr(9), '')] END AS pieces
      FROM (SELECT doc_id, text, CASE WHEN contains(text, '■') THEN '■' WHEN contains(text, '•') THEN '•'
                   WHEN contains(text, chr(9)) THEN chr(9) ELSE '.' END AS mark FROM documents) d,
           (VALUES (1024), (512)) v(n)),
    long_rows AS (SELECT doc_id, n, unnest(pieces) AS chunk, generate_subscripts(pieces, 1) - 1 AS pos FROM long)
"""
SLIDE_SQL = """
    slide_in AS (SELECT doc_id, n, page, list_transform(string_split(page, '.'), lambda x: length(x)) AS lens
                 FROM page, (VALUES (256), (512)) v(n)),
    slide(doc_id, n, i, slow, b, pos, eb, ee) AS (
        SELECT doc_id, n, 1, 1, 0, 0, NULL::BIGINT, NULL::BIGINT FROM slide_in
        UNION ALL
        SELECT s.doc_id, s.n, i + 1,
               CASE WHEN pos - b + lens[i] > s.n THEN slow + 1 ELSE slow END,
               CASE WHEN pos - b + lens[i] > s.n THEN least(b + lens[slow] + 1, pos) ELSE b END,
               pos + lens[i] + 1,
               CASE WHEN pos - b + lens[i] > s.n THEN b END,
               CASE WHEN pos - b + lens[i] > s.n THEN pos + lens[i] + 1 END
        FROM slide s JOIN slide_in USING (doc_id, n) WHERE i <= len(lens)),
    slide_rows AS (SELECT doc_id, n, substr(page || '.', eb + 1, ee - eb) AS chunk,
                          row_number() OVER (PARTITION BY doc_id, n ORDER BY i) - 1 AS pos
                   FROM slide JOIN slide_in USING (doc_id, n) WHERE eb IS NOT NULL)
"""
RULE_SQL = """
    rule_in AS (SELECT doc_id, n, page, list_transform(string_split(page, '.'), lambda x: length(x)) AS lens
                FROM page, (VALUES (256), (512)) v(n)),
    rule(doc_id, n, i, b, pos, eb, ee) AS (
        SELECT doc_id, n, 1, 0, 0, NULL::BIGINT, NULL::BIGINT FROM rule_in WHERE length(page) >= n
        UNION ALL
        SELECT s.doc_id, s.n, i + 1, CASE WHEN pos - b + lens[i] > s.n THEN pos ELSE b END, pos + lens[i],
               CASE WHEN pos - b + lens[i] > s.n THEN b END, CASE WHEN pos - b + lens[i] > s.n THEN pos + lens[i] END
        FROM rule s JOIN rule_in USING (doc_id, n) WHERE i <= len(lens)),
    rule_spans AS (SELECT doc_id, n, i, eb, ee FROM rule WHERE eb IS NOT NULL
                   UNION ALL SELECT r.doc_id, r.n, i, b, pos FROM rule r JOIN rule_in USING (doc_id, n)
                   WHERE i = len(lens) + 1 AND pos > b),
    rule_rows AS (
        SELECT doc_id, n, substr(replace(page, '.', ''), eb + 1, ee - eb) AS chunk,
               row_number() OVER (PARTITION BY doc_id, n ORDER BY i, ee, eb) - 1 AS pos
        FROM rule_spans JOIN rule_in USING (doc_id, n)
        UNION ALL SELECT doc_id, n, page, 0 FROM rule_in WHERE length(page) >= 6 AND length(page) < n)
"""


def chunk_rows(spark: SparkSession, sf_dir: str, chunks: Column) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return explode_items(docs, ["doc_id"], chunks, "chunk")


@query(
    "long_block_pieces",
    f"WITH {LONG_SQL} SELECT doc_id, pos::INTEGER AS pos, chunk FROM long_rows WHERE n = 1024",
)
def long_block_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_rows(spark, sf_dir, split_long("text", 1024, STOP))


@query(
    "fixed_windows",
    """
    WITH w AS (SELECT doc_id, text, unnest(range(0, greatest(ceil((length(text) - 200) / 800.0), 1)::BIGINT)) AS i
               FROM documents WHERE length(text) > 0)
    SELECT doc_id, i::INTEGER AS pos, substr(text, i * 800 + 1, 1000) AS chunk FROM w
    """,
)
def fixed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_rows(spark, sf_dir, split_overlap("text", 1000, 200))


@query("recursive_chunks")
def recursive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separator-aware chunks of 250 characters."""
    return chunk_rows(spark, sf_dir, split_recursive("text", 250, 0))


@query("overlapping_chunks")
def overlapping_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separator-aware chunks of 1000 characters that share up to 200 with their neighbours."""
    return chunk_rows(spark, sf_dir, split_recursive("text", 1000, 200))


@query(
    "sliding_windows",
    f"WITH RECURSIVE {PAGE_SQL}, {SLIDE_SQL} SELECT doc_id, pos::INTEGER AS pos, chunk FROM slide_rows WHERE n = 512",
)
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").select("doc_id", page_text("text").alias("page"))
    return explode_items(docs, ["doc_id"], sliding_chunks("page", 512, STOP), "chunk")


@query(
    "rule_windows",
    f"WITH RECURSIVE {PAGE_SQL}, {RULE_SQL} SELECT doc_id, pos::INTEGER AS pos, chunk FROM rule_rows WHERE n = 512",
)
def rule_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").select("doc_id", page_text("text").alias("page"))
    return explode_items(docs, ["doc_id"], rule_chunks("page", 512, stop=STOP), "chunk")


@query(
    "line_blocks",
    """
    WITH RECURSIVE l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
    s AS (SELECT doc_id, text, list_transform(lines, lambda x, i: length(x) + CASE WHEN i < len(lines) THEN 1 ELSE 0 END) AS lens FROM l),
    st(doc_id, i, b, pos, eb, ee) AS (
        SELECT doc_id, 1, 0, 0, NULL::BIGINT, NULL::BIGINT FROM s
        UNION ALL
        SELECT t.doc_id, i + 1, CASE WHEN pos - b + lens[i] >= 2048 THEN pos + lens[i] ELSE b END, pos + lens[i],
               CASE WHEN pos - b + lens[i] >= 2048 THEN b END, CASE WHEN pos - b + lens[i] >= 2048 THEN pos + lens[i] END
        FROM st t JOIN s USING (doc_id) WHERE i <= len(lens))
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS pos, substr(text, eb + 1, ee - eb) AS chunk
    FROM st JOIN s USING (doc_id) WHERE eb IS NOT NULL
    """,
)
def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_rows(spark, sf_dir, text_blocks("text"))


@query(
    "kept_lines",
    f"""
    SELECT doc_id, count(*) AS lines, sum(length(line))::BIGINT AS chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE NOT {noise_sql('line')} GROUP BY doc_id
    """,
)
def kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that survive the noise rule, counted inside the row."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    kept = F.filter(F.split("text", "\n"), lambda s: ~noise_line(s))
    counted = let(
        kept,
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("lines"),
            F.aggregate(lines, F.lit(0).cast("long"), lambda acc, s: acc + F.length(s)).alias("chars"),
        ),
    )
    return built_rows(docs, ["doc_id"], counted, lambda c: c["lines"] > 0)


@query(
    "all_chunkings",
    f"""
    WITH RECURSIVE {PAGE_SQL}, {LONG_SQL}, {SLIDE_SQL}, {RULE_SQL},
    u AS (SELECT doc_id, CASE n WHEN 1024 THEN 0 ELSE 1 END AS method_no, 'block_' || n AS method, pos, chunk FROM long_rows
          UNION ALL SELECT doc_id, CASE n WHEN 256 THEN 2 ELSE 3 END, 'slide_' || n, pos, chunk FROM slide_rows
          UNION ALL SELECT doc_id, CASE n WHEN 256 THEN 4 ELSE 5 END, 'rule_' || n, pos, chunk FROM rule_rows),
    d AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY method_no, doc_id, pos) AS rn FROM u)
    SELECT doc_id, method, pos::INTEGER AS pos, length(chunk)::INTEGER AS n, md5(chunk) AS digest FROM d WHERE rn = 1
    """,
)
def all_chunkings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six chunkings of every document, exact repeats removed across all of them."""
    def kept(chunk: Column) -> dict[str, Column]:
        return {"n": F.length(chunk), "digest": F.unhex(F.md5(chunk))}

    chunks = build_chunks(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text", stop=STOP, kept=kept)
    return chunks.select("doc_id", "method", "pos", "n", F.lower(F.hex("digest")).alias("digest"))


def page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as the positioned words of a page; font size and height follow from the text."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    lines = F.transform(
        F.split("text", "\n"),
        lambda s, i: F.struct(
            s.alias("text"),
            (10.0 + (F.length(s) % 2)).alias("size"),
            (16.0 + (F.length(s) % 3) * 0.8 + i).cast("double").alias("top"),
        ),
    )
    return docs.select("doc_id", lines.alias("words"))


WORDS_SQL = """
    w AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    ws AS (SELECT doc_id, unnest(lines) AS t, generate_subscripts(lines, 1) - 1 AS i FROM w)
"""


@query(
    "page_headers",
    f"""
    WITH {WORDS_SQL},
    e AS (SELECT *, contains(t, '目录') OR contains(t, '..........') AS marked,
                 (16.0 + (length(t) % 3) * 0.8 + i) AS top FROM ws),
    f AS (SELECT doc_id, arg_min(t, i) FILTER (WHERE marked OR (top > 17 AND top < 20)) AS hit,
                 arg_min(marked, i) FILTER (WHERE marked OR (top > 17 AND top < 20)) AS hit_marked,
                 arg_min(t, i) AS first FROM e GROUP BY doc_id)
    SELECT doc_id, CASE WHEN hit_marked IS NULL THEN first WHEN hit_marked THEN NULL ELSE hit END AS header FROM f
    """,
)
def page_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_words(spark, sf_dir).select("doc_id", page_header("words").alias("header"))


@query(
    "font_blocks",
    rf"""
    WITH RECURSIVE {WORDS_SQL},
    usable AS (SELECT doc_id, t, length(t) % 2 AS size, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM ws
               WHERE i > 0 AND NOT (i = 1 AND regexp_full_match(t, '\p{{Nd}}+')) AND t NOT IN ('□', '•')),
    st(doc_id, i, held, size, done) AS (
        SELECT DISTINCT doc_id, 0::BIGINT, '', -1::BIGINT, NULL::VARCHAR FROM ws
        UNION ALL
        SELECT s.doc_id, u.i,
               CASE WHEN u.t IN ('警告！', '注意！', '说明！') THEN '' WHEN u.size = s.size OR length(held) BETWEEN 1 AND 14 THEN held || u.t ELSE u.t END,
               CASE WHEN u.t IN ('警告！', '注意！', '说明！') THEN s.size ELSE u.size END,
               CASE WHEN length(held) > 0 AND (u.t IN ('警告！', '注意！', '说明！') OR NOT (u.size = s.size OR length(held) BETWEEN 1 AND 14)) THEN held END
        FROM st s JOIN usable u ON u.doc_id = s.doc_id AND u.i = s.i + 1),
    blocks AS (SELECT doc_id, i, done AS block FROM st WHERE done IS NOT NULL
               UNION ALL SELECT doc_id, max(i) + 1, arg_max(held, i) FROM st GROUP BY doc_id HAVING length(arg_max(held, i)) > 0),
    e AS (SELECT *, contains(t, '目录') OR contains(t, '..........') AS marked, (16.0 + (length(t) % 3) * 0.8 + i) AS top FROM ws),
    f AS (SELECT doc_id, arg_min(marked, i) FILTER (WHERE marked OR (top > 17 AND top < 20)) AS hit_marked FROM e GROUP BY doc_id)
    SELECT b.doc_id, (row_number() OVER (PARTITION BY b.doc_id ORDER BY b.i) - 1)::INTEGER AS pos,
           translate(block, ',' || chr(10) || chr(9), '') AS chunk
    FROM blocks b JOIN f ON b.doc_id = f.doc_id
    WHERE length(block) >= 6 AND length(block) <= 2048 AND NOT coalesce(hit_marked, false)
    """,
)
def font_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_items(page_words(spark, sf_dir), ["doc_id"], block_chunks("words", 2048), "chunk")


ARTICLE_LINE_SQL = collapse(zh_punct(WIKI_SQL.format(c="(l || chr(10))")))


@query(
    "article_samples",
    f"""
    WITH RECURSIVE a AS (SELECT doc_id, list_transform(string_split({HEAD_SQL} || ':' || chr(10) ||
            regexp_replace(regexp_replace(text, '^\\n+|\\n+$', '', 'g'), '\\n+', chr(10), 'g'), chr(10)),
            lambda l: {ARTICLE_LINE_SQL}) AS lines FROM documents),
    b AS (SELECT doc_id, lines[1] AS header, list_filter(lines[2:], lambda l: NOT suffix(l, '：')) AS body FROM a),
    st(doc_id, i, response, done) AS (
        SELECT doc_id, 1, '', false FROM b
        UNION ALL
        SELECT s.doc_id, i + 1, response || body[i], length(response) + length(body[i]) > 512
        FROM st s JOIN b USING (doc_id) WHERE NOT done AND i <= len(body)),
    last AS (SELECT doc_id, arg_max(response, i) AS response, arg_max(done, i) AS done FROM st GROUP BY doc_id)
    SELECT doc_id, replace(list_extract([{", ".join(map(lit, WIKI_QUESTIONS))}], ({hash32("doc_id::VARCHAR")} % 20 + 1)::BIGINT),
                           '{{}}', left(header, -1)) AS prompt,
           CASE WHEN done THEN response ELSE response || chr(10) END AS response
    FROM b JOIN last USING (doc_id) WHERE suffix(header, '：')
    """,
)
def article_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an article: its first sentence is the heading line."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    body = F.regexp_replace(F.regexp_replace("text", r"^\n+|\n+$", ""), r"\n+", "\n")
    articles = docs.select("doc_id", F.concat(first_sentence("text"), F.lit(":\n"), body).alias("article"))
    return wiki_samples(articles, "doc_id", "article").drop("sample")


@query(
    "chunk_documents",
    """
    WITH w AS (SELECT doc_id, text, unnest(range(0, greatest(ceil(length(text) / 500.0), 1)::BIGINT)) AS i
               FROM documents WHERE length(text) > 0)
    SELECT doc_id * 1000000 + i AS chunk_id, split_part(regexp_replace(substr(text, i * 500 + 1, 500), '^\\s+|\\s+$', '', 'g'), chr(9), 1) AS text,
           (doc_id * 1000000 + i)::VARCHAR AS id FROM w
    """,
)
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_chunks(documents(spark, sf_dir, "doc_id", "text"), split_overlap("text", 500), "fixed_500", "doc_id")
    keyed = rows.withColumn("chunk_key", F.col("doc_id") * 1_000_000 + F.col("pos"))
    return as_documents(keyed, "chunk_key", "chunk").select("chunk_id", "text", F.col("metadata")["id"].alias("id"))
