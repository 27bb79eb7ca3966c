"""Tagged sentences: spans, label tables, instruction rows, extraction.

Words of a document stand for characters: a capitalised word opens a span, a long
word continues one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.prompts import (
    ENTITY_QUESTIONS,
    ENTITY_TYPES,
    answer_part,
    entities_by_type,
    extract_entities,
    question_part,
)
from textmill.operators.exploding import explode_structs
from textmill.operators.tagging import bio_spans, label_inventory, map_labels, ner_instructions
from textmill.plans.registered import documents, query
from textmill.plans.registered.sqltext import hash32, lit

WORD = r"[\p{L}]+"
LATIN = "abcdefghijklmnopqrstuvwxyz"
GLYPHS = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    tokens = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    labels = F.transform(
        "chars",
        lambda w: F.when(F.rlike(w, F.lit(r"^\p{Lu}")), F.concat(F.lit("B-"), name_type(w)))
        .when(F.length(w) >= 8, F.concat(F.lit("I-"), name_type(w)))
        .otherwise("O"),
    )
    return docs.select("doc_id", tokens.alias("chars")).withColumn("labels", labels)


def name_type(w):
    return F.when(F.length(w) % 2 == 0, "even").otherwise("odd")


TAGS_SQL = rf"""
    t AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}]+') AS ws FROM documents)),
    lab AS (SELECT *, CASE WHEN length(w) % 2 = 0 THEN 'even' ELSE 'odd' END AS kind,
                   CASE WHEN regexp_matches(w, '^\p{{Lu}}') THEN 'B-' WHEN length(w) >= 8 THEN 'I-' ELSE 'O' END AS pre FROM t),
    st AS (SELECT *, CASE WHEN pre = 'B-' OR (pre = 'I-' AND coalesce(lag(pre) OVER (PARTITION BY doc_id ORDER BY i), 'O') = 'O') THEN 1 ELSE 0 END AS s FROM lab),
    gr AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM st WHERE pre <> 'O'),
    spans AS (SELECT doc_id, g, min(i) AS begin, arg_min(kind, i) AS type, string_agg(w, '' ORDER BY i) AS text FROM gr GROUP BY doc_id, g)
"""


@query(
    "tagged_spans",
    f"WITH {TAGS_SQL} SELECT doc_id, begin::INTEGER AS begin, type, text FROM spans",
)
def tagged_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged(spark, sf_dir)
    return explode_structs(rows, ["doc_id"], bio_spans("chars", "labels")).select("doc_id", "begin", "type", "text")


@query(
    "label_table",
    f"""
    WITH {TAGS_SQL}, l AS (SELECT DISTINCT CASE WHEN pre = 'O' THEN 'O' ELSE pre || kind END AS label FROM lab)
    SELECT (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_id, label, CASE WHEN length(label) > 1 THEN substr(label, 3) END AS type FROM l
    """,
)
def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_inventory(tagged(spark, sf_dir))


@query(
    "label_ids",
    f"""
    WITH {TAGS_SQL}, f AS (SELECT doc_id, i, CASE WHEN pre = 'O' THEN 'O' ELSE pre || kind END AS label FROM lab),
    l AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS id FROM (SELECT DISTINCT label FROM f))
    SELECT doc_id, md5(string_agg(id::VARCHAR, ',' ORDER BY i)) AS ids, count(*)::INTEGER AS n FROM f JOIN l USING (label) GROUP BY doc_id
    """,
)
def label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged(spark, sf_dir)
    mapped = map_labels(rows, label_inventory(rows)).filter(F.size("label_ids") > 0)
    return mapped.select("doc_id", F.md5(F.array_join("label_ids", ",")).alias("ids"), F.size("label_ids").alias("n"))


@query(
    "entity_instructions",
    f"""
    WITH {TAGS_SQL},
    choices AS (SELECT string_agg(kind, '，' ORDER BY kind) AS c FROM (SELECT DISTINCT kind FROM lab WHERE pre <> 'O')),
    body AS (SELECT doc_id, string_agg(w, '' ORDER BY i) AS text FROM t GROUP BY doc_id),
    tgt AS (SELECT doc_id, string_agg(type || '实体：' || text, chr(10) ORDER BY begin) AS lines FROM spans GROUP BY doc_id)
    SELECT 'ftrain_' || d.doc_id AS sample_id,
           replace(replace(list_extract([{", ".join(map(lit, ENTITY_QUESTIONS))}], ({hash32("d.doc_id::VARCHAR")} % 8 + 1)::BIGINT),
                   '[INPUT_TEXT]', coalesce(body.text, '')), '[LIST_LABELS]', c) AS input,
           '上述句子中的实体包含：' || chr(10) || coalesce(lines, '') AS target
    FROM documents d LEFT JOIN body USING (doc_id) LEFT JOIN tgt USING (doc_id), choices
    """,
)
def entity_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ner_instructions(tagged(spark, sf_dir), "train", key="doc_id")
    return rows.select("sample_id", "input", "target")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer texts with one typed line per capitalised word, in the glyphs the pattern expects."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    tokens = F.regexp_extract_all("text", F.lit(r"\p{Lu}[\p{L}]*"), F.lit(0))
    line = F.transform(
        tokens,
        lambda w: F.concat(
            F.element_at(F.array(*map(F.lit, ENTITY_TYPES)), F.length(w) % 10 + 1),
            F.lit("实体："),
            F.regexp_replace(F.translate(F.lower(w), LATIN, GLYPHS), r"[^一-龥]", ""),
        ),
    )
    return docs.select("doc_id", F.concat(F.lit("问题答："), F.array_join(line, "\n")).alias("reply"))


ANSWER_SQL = rf"""
    w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '\p{{Lu}}[\p{{L}}]*') AS ws FROM documents)),
    e AS (SELECT doc_id, i, list_extract([{", ".join(map(lit, ENTITY_TYPES))}], (length(w) % 10 + 1)::BIGINT) AS type,
                 regexp_replace(translate(lower(w), '{LATIN}', '{GLYPHS}'), '[^一-龥]', '', 'g') AS entity FROM w)
"""


@query(
    "extracted_entities",
    f"""
    WITH {ANSWER_SQL}
    SELECT doc_id, type, count(*)::INTEGER AS n, string_agg(entity, '|' ORDER BY i) AS entities FROM e
    WHERE entity <> '' GROUP BY doc_id, type
    """,
)
def extracted_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answers(spark, sf_dir).select("doc_id", entities_by_type(extract_entities(answer_part("reply"))).alias("found"))
    return rows.select("doc_id", F.explode("found").alias("type", "items")).select(
        "doc_id", "type", F.size("items").alias("n"), F.array_join("items", "|").alias("entities")
    )


@query(
    "answer_sections",
    f"""
    WITH {ANSWER_SQL}, b AS (SELECT doc_id, string_agg(type || '实体：' || entity, chr(10) ORDER BY i) AS body FROM e GROUP BY doc_id)
    SELECT doc_id, '问题' AS question, regexp_replace(coalesce(body, ''), '^\\s+|\\s+$', '', 'g') AS answer FROM documents LEFT JOIN b USING (doc_id)
    """,
)
def answer_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("doc_id", question_part("reply").alias("question"), answer_part("reply").alias("answer"))
