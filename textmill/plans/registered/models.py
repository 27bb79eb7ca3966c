"""Model hooks with deterministic stand-ins, vocabularies and markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.markup import html_to_text, normalize_title, page_url, wiki_clean, wiki_compact
from textmill.functions.prompts import parse_verdict, validate_verdict
from textmill.functions.text import first_sentence
from textmill.functions.tokens import nfkc, pretokenize
from textmill.functions.vectors import letter_vector
from textmill.operators.answers import (
    attach_texts,
    corrective_rag,
    decompose_answer,
    hyde,
    ranked_documents,
    refine,
    route,
    search_summaries,
    summary_index,
)
from textmill.operators.conversations import exchanges
from textmill.operators.exploding import explode_items
from textmill.operators.hooks import build_preference, embed, generate, grade, join_preference, map_batches, score_pairs
from textmill.operators.retrieval import bm25_search, lexical_retriever
from textmill.operators.vocabulary import encode, train_bpe, word_counts
from textmill.plans.registered import documents, query, spread, table
from textmill.plans.registered.chat import EXCHANGES_SQL
from textmill.plans.registered.search import letters_sql, lexical_sql, passages, stored_index, unit_sql
from textmill.session import cut_lineage


# ---- hooks -----------------------------------------------------------------
def respell():
    return lambda prompts: [p.split(".")[0].replace("e", "3") for p in prompts]


def length_share():
    return lambda left, right: [len(a) / (len(a) + len(b)) if a or b else 0.0 for a, b in zip(left, right)]


def vowel_vector():
    return lambda texts: [[float(t.count(v)) for v in "aeiou"] for t in texts]


def mentions_the():
    return lambda texts: ['{"score": "Yes"}' if " the " in t else '{"score": "no"}' for t in texts]


@query(
    "generated_preferences",
    f"""
    WITH {EXCHANGES_SQL}
    SELECT conv_id, turn, "user" AS prompt, assistant AS chosen, replace(split_part("user", '.', 1), 'e', '3') AS rejected FROM ex
    """,
)
def generated_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spread(exchanges(table(spark, sf_dir, "conversations")))
    return build_preference(pairs, respell, "user", "assistant")


@query(
    "joined_preferences",
    f"""
    WITH {EXCHANGES_SQL}
    SELECT conv_id, turn, "user" AS prompt, assistant AS chosen, replace(split_part("user", '.', 1), 'e', '3') AS rejected FROM ex
    """,
)
def joined_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stored table of generations."""
    key = F.concat_ws(":", "conv_id", "turn").alias("exchange")
    pairs = spread(exchanges(table(spark, sf_dir, "conversations"))).select("*", key)
    stored = cut_lineage(generate(pairs, respell, "user").select("exchange", "generation"), "generations")
    joined = join_preference(pairs, stored, "exchange")
    return joined.select("conv_id", "turn", F.col("user").alias("prompt"), F.col("assistant").alias("chosen"), "rejected")


@query(
    "hook_outputs",
    f"""
    WITH {EXCHANGES_SQL},
    v AS (SELECT *, [{", ".join(f"(length(assistant) - length(replace(assistant, '{x}', '')))::DOUBLE" for x in "aeiou")}] AS raw FROM ex)
    SELECT conv_id, turn, round(length("user")::DOUBLE / (length("user") + length(assistant)), 6) AS score,
           CASE WHEN contains(assistant, ' the ') THEN 'yes' ELSE 'no' END AS grade,
           round(({unit_sql('raw')})[1], 6) AS first_entry FROM v
    """,
)
def hook_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spread(exchanges(table(spark, sf_dir, "conversations")))
    scored = score_pairs(pairs, length_share, "user", "assistant")
    graded = grade(scored, mentions_the, ["assistant"])
    vectors = embed(graded, vowel_vector, "assistant")
    return vectors.select(
        "conv_id", "turn", F.round("score", 6).alias("score"), "grade", F.round(F.get("embedding", 0), 6).alias("first_entry")
    )


@query(
    "batch_map",
    "SELECT doc_id, length(text)::BIGINT AS n FROM documents",
)
def batch_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return map_batches(docs, lambda f: f.assign(n=f["text"].str.len())[["doc_id", "n"]], "doc_id long, n long")


@query(
    "verdicts",
    """
    WITH v AS (SELECT doc_id, CASE quality WHEN 1 THEN 'Vectorstore' ELSE CASE toxic WHEN 1 THEN 'other' ELSE 'web_search' END END AS s FROM labels)
    SELECT doc_id, CASE WHEN lower(s) IN ('vectorstore', 'web_search') THEN lower(s) END AS value,
           CASE WHEN lower(s) NOT IN ('vectorstore', 'web_search') THEN lower(s) END AS rejected FROM v
    """,
)
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("quality") == 1, "Vectorstore").when(F.col("toxic") == 1, "other").otherwise("web_search")
    raw = table(spark, sf_dir, "labels").select("doc_id", F.to_json(F.struct(label.alias("datasource"))).alias("answer"))
    checked = raw.withColumn("v", validate_verdict(parse_verdict("answer", "datasource"), ["vectorstore", "web_search"]))
    return checked.select("doc_id", "v.value", "v.rejected")


@query(
    "routed_documents",
    """
    SELECT doc_id, CASE WHEN lang = 'en' THEN upper(source) WHEN lang = 'fr' THEN lang || ':' || source ELSE lower(source) END AS answer FROM documents
    """,
)
def routed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    branches = {
        "en": lambda d: d.select("doc_id", F.upper("source").alias("answer")),
        "fr": lambda d: d.select("doc_id", F.concat_ws(":", "lang", "source").alias("answer")),
    }
    return route(docs, "lang", branches, lambda d: d.select("doc_id", F.lower("source").alias("answer")))


# ---- answers ---------------------------------------------------------------
def take_note():
    return lambda questions, docs, so_far: [f"{a}|{len(q)}:{len(d)}" for q, d, a in zip(questions, docs, so_far)]


@query(
    "refined_answers",
    f"""
    WITH {lexical_sql()}
    SELECT query_id, '没有回复' || string_agg('|' || length(b.text) || ':' || length(d.text), '' ORDER BY rank) AS generation
    FROM br JOIN documents d ON d.doc_id = br.chunk_id JOIN benchmark b ON b.item_id = br.query_id WHERE rank <= 5 GROUP BY query_id
    """,
)
def refined_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = passages(spark, sf_dir)
    hits = attach_texts(bm25_search(asked, stored_index(spark, sf_dir), 5), table(spark, sf_dir, "documents"), "doc_id")
    ready = ranked_documents(hits).join(asked.withColumnRenamed("text", "question"), "query_id")
    return refine(ready, take_note).select("query_id", "generation")


@query(
    "hypothetical_search",
    f"""
    WITH qv AS (SELECT item_id, {unit_sql('v')} AS q FROM (SELECT item_id, {letters_sql("replace(split_part(text, '.', 1), 'e', '3')")} AS v FROM benchmark)),
    dv AS (SELECT doc_id, {unit_sql('v')} AS d FROM (SELECT doc_id, {letters_sql('text')} AS v FROM documents)),
    vs AS (SELECT item_id AS query_id, doc_id AS chunk_id, round(list_distance(q, d), 9) AS score FROM qv, dv),
    vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, chunk_id) AS rank FROM vs)
    SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM vr WHERE rank <= 4
    """,
)
def hypothetical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated text is embedded and searched instead of the question."""
    asked = passages(spark, sf_dir).withColumnRenamed("text", "question")
    corpus = documents(spark, sf_dir, "doc_id", "text").select(
        F.col("doc_id").alias("chunk_id"), letter_vector("text").alias("embedding")
    )
    hits = hyde(asked, respell, letters_of, corpus)
    return hits.withColumn("score", F.round("score", 6))


def letters_of(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("embedding", letter_vector(text))


@query(
    "summary_search",
    f"""
    WITH qv AS (SELECT item_id, {unit_sql('v')} AS q FROM (SELECT item_id, {letters_sql('text')} AS v FROM benchmark)),
    dv AS (SELECT doc_id, {unit_sql('v')} AS d FROM (SELECT doc_id, {letters_sql("replace(split_part(text, '.', 1), 'e', '3')")} AS v FROM documents)),
    vs AS (SELECT item_id AS query_id, doc_id, round(list_distance(q, d), 9) AS score FROM qv, dv),
    vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, doc_id) AS rank FROM vs)
    SELECT query_id, doc_id, round(score, 6) AS score, n_chars FROM vr JOIN documents USING (doc_id) WHERE rank <= 1
    """,
)
def summary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries are searched, whole documents are returned."""
    summaries = summary_index(documents(spark, sf_dir, "doc_id", "text"), respell, letters_of)
    asked = letters_of(passages(spark, sf_dir), "text")
    found = search_summaries(asked, summaries, table(spark, sf_dir, "documents").select("doc_id", "n_chars"))
    return found.select("query_id", "doc_id", F.round("score", 6).alias("score"), "n_chars")


def halves():
    return lambda texts: [f"{t[: len(t) // 2]}\n{t[len(t) // 2 :]}" for t in texts]


def shorten():
    return lambda questions, contexts: [f"{len(q)}/{len(c)}" for q, c in zip(questions, contexts)]


@query("decomposed_answers")
def decomposed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of a passage are asked on their own, then merged."""
    asked = passages(spark, sf_dir).select(F.col("query_id").alias("question_id"), F.col("text").alias("question"))
    corpus = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    retriever = lexical_retriever(stored_index(spark, sf_dir), 3)
    return decompose_answer(asked, corpus, retriever, halves, shorten, shorten).select("question_id", "generation")


def shares_start():
    return lambda questions, docs: ['{"score": "yes"}' if q[:24] in d else '{"score": "no"}' for q, d in zip(questions, docs)]


def drop_first_word():
    return lambda queries: [q.partition(" ")[2] for q in queries]


def has_context():
    return lambda questions, contexts, answers: ['{"score": "yes"}' if c else '{"score": "no"}' for c in contexts]


@query("corrective_answers")
def corrective_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions without a relevant document are rewritten and asked again, three rounds at most."""
    asked = passages(spark, sf_dir).select(F.col("query_id").alias("question_id"), F.col("text").alias("question"))
    corpus = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    retriever = lexical_retriever(stored_index(spark, sf_dir), 4)
    state = corrective_rag(asked, corpus, retriever, shares_start, drop_first_word, shorten, has_context)
    return state.select("question_id", "generation", F.size("documents").alias("n_documents"), "status", "round")


# ---- vocabularies ----------------------------------------------------------
PIECES_SQL = r"""
    pieces AS (SELECT doc_id, list_transform(regexp_extract_all(translate(text, ' ', '▁'), '[\p{P}$+<=>^`|~]|\p{N}|[^\p{P}$+<=>^`|~\p{N}]+'),
                      lambda p: CASE WHEN starts_with(p, '▁') THEN p ELSE '▁' || p END) AS ps FROM documents)
"""


@query(
    "piece_counts",
    f"""
    WITH {PIECES_SQL}, w AS (SELECT unnest(regexp_extract_all(p, '▁[^▁]*')) AS word FROM (SELECT unnest(ps) AS p FROM pieces))
    SELECT word, count(*) AS freq FROM w GROUP BY word HAVING count(*) >= 10
    """,
)
def piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(documents(spark, sf_dir, "text"), "text", min_freq=10)


@query("trained_merges")
def trained_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All merges of the corpus, in order, up to the default size and frequency."""
    vocabulary = train_bpe(documents(spark, sf_dir, "text"), "text", normalise=True)
    rows = [(i, a, b) for i, (a, b) in enumerate(vocabulary.merges)]
    return spark.createDataFrame(rows, "merge_no int, left string, right string")


@query(
    "character_ids",
    f"""
    WITH {PIECES_SQL}, c AS (SELECT doc_id, list_filter(string_split(array_to_string(ps, ''), ''), lambda z: z <> '') AS cs FROM pieces),
    f AS (SELECT doc_id, unnest(cs) AS ch, generate_subscripts(cs, 1) AS i FROM c),
    v AS (SELECT ch, row_number() OVER (ORDER BY ch) + 6 AS id FROM (SELECT DISTINCT ch FROM f))
    SELECT doc_id, count(*)::INTEGER AS n, md5(string_agg(id::VARCHAR, ',' ORDER BY i)) AS digest FROM f JOIN v USING (ch) GROUP BY doc_id
    """,
)
def character_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding with the alphabet only; ids follow the special tokens."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    vocabulary = train_bpe(docs, "text", max_merges=0)
    coded = docs.select("doc_id", encode("text", vocabulary).alias("ids"))
    kept = coded.filter(F.size("ids") > 0)
    return kept.select("doc_id", F.size("ids").alias("n"), F.md5(F.array_join("ids", ",")).alias("digest"))


@query("merged_ids")
def merged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document under all learned merges."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    vocabulary = train_bpe(docs, "text", normalise=True)
    coded = docs.select("doc_id", encode("text", vocabulary, normalise=True).alias("ids"))
    return coded.select("doc_id", F.size("ids").alias("n"), F.md5(F.array_join("ids", ",")).alias("digest"))


@query("normalised_forms")
def normalised_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("form", nfkc("text"))
    return docs.select("doc_id", F.md5("form").alias("digest"), F.size(pretokenize("form")).alias("pieces"))


# ---- markup ----------------------------------------------------------------
def entities_sql(c: str) -> str:
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        c = f"replace({c}, '&{name};', '{char}')"
    return c


BARE_SQL = "html"
for _pattern in (r"(?s)<script[^>]*>.*?</script>", r"(?s)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"<[^>]+>"):
    BARE_SQL = f"regexp_replace({BARE_SQL}, '{_pattern}', '', 'g')"


@query(
    "page_texts",
    f"""
    SELECT page_id, {entities_sql(BARE_SQL)} AS text,
           {entities_sql("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS ads FROM pages
    """,
)
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", html_to_text("html").alias("text"), html_to_text("html", ("ad",)).alias("ads"))


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dressed as wiki pages."""
    docs = documents(spark, sf_dir, "doc_id", "lang", "source", "text")
    text = F.concat(
        F.lit("{{box|{{inner}}}}\n'''"), first_sentence("text"), F.lit("'''\n== Body ==\n"), F.col("text"),
        F.lit("\n=== Empty ===\n== Links ==\n* item\nSee [[Page|"), F.col("source"), F.lit("]]s &amp;amp; [[File:a.png|b]]."),
    )
    return docs.select("doc_id", F.concat_ws("_", "lang", "source").alias("title"), text.alias("text"))


@query("wiki_lines")
def wiki_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and compacted lines of every page."""
    cleaned = wiki_pages(spark, sf_dir).select("doc_id", wiki_clean("text").alias("text"))
    return explode_items(cleaned, ["doc_id"], wiki_compact("text"), "line")


@query(
    "wiki_titles",
    """
    SELECT doc_id, upper(substr(lang, 1, 1)) || substr(lang, 2) || ' ' || source AS title, 'http://wiki?curid=' || doc_id AS url FROM documents
    """,
)
def wiki_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("_ ", "lang", "source").alias("title"))
    return pages.select("doc_id", normalize_title("title").alias("title"), page_url("http://wiki", "doc_id").alias("url"))
