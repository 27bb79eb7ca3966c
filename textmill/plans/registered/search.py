"""Vector and lexical search over whole tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from textmill.functions.text import chars
from textmill.functions.tokens import ngrams, words
from textmill.functions.vectors import (
    cosine,
    dequantize_groups,
    l2_distance,
    l2_normalise,
    letter_vector,
    norm,
    quantize_groups,
)
from textmill.operators.chunking import split_overlap
from textmill.operators.exploding import explode_items
from textmill.operators.filters import SearchSpec, metadata_filter
from textmill.operators.quantise import quantize_tensor, quantize_zero_point
from textmill.operators.retrieval import (
    bm25_search,
    document_frequency,
    expand_to_parent,
    fuse_searches,
    knn,
    lexical_docs,
    meet_hits,
    multi_query,
    rerank,
    route_semantic,
    rrf,
    tfidf_index,
    tfidf_search,
)
from textmill.operators.metrics import retrieval_metrics
from textmill.plans.registered import documents, query, table
from textmill.plans.registered.sqltext import words as sql_words
from textmill.session import cut_lineage

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letters_sql(c: str) -> str:
    raw = ", ".join(f"length(lower({c})) - length(replace(lower({c}), '{x}', ''))" for x in LETTERS)
    return f"[{raw}]"


def unit_sql(v: str) -> str:
    return f"list_transform({v}, lambda x: CASE WHEN list_sum(list_transform({v}, lambda y: y * y)) > 0 THEN x / sqrt(list_sum(list_transform({v}, lambda y: y * y))) ELSE x END)"


# ---- embeddings ------------------------------------------------------------
def label_centroids(vectors: DataFrame) -> DataFrame:
    """Mean vector per label; entries are averaged before the shuffle."""
    entries = vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = entries.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One list per label, as long as a vector.
    return means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("centroid")
    )


CENTROID_SQL = """
    entries AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    means AS (SELECT label, i, avg(x) AS x FROM entries GROUP BY label, i),
    centroid AS (SELECT label, list(x ORDER BY i) AS c FROM means GROUP BY label)
"""


@query(
    "vector_measures",
    f"""
    WITH {CENTROID_SQL}
    SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))), 6) AS norm,
           round(list_cosine_similarity(embedding::DOUBLE[], c), 6) AS cosine,
           round(list_distance(embedding::DOUBLE[], c), 6) AS distance,
           round(embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))), 6) AS first_unit
    FROM embeddings JOIN centroid USING (label)
    """,
)
def vector_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    joined = vectors.join(label_centroids(vectors), "label")
    return joined.select(
        "vec_id",
        F.round(norm("embedding"), 6).alias("norm"),
        F.round(cosine("embedding", "centroid"), 6).alias("cosine"),
        F.round(l2_distance("embedding", "centroid"), 6).alias("distance"),
        F.round(l2_normalise("embedding")[0], 6).alias("first_unit"),
    )


@query(
    "nearest_to_centroids",
    f"""
    WITH {CENTROID_SQL},
    d AS (SELECT c.label::BIGINT AS query_id, vec_id AS chunk_id, round(list_distance(embedding::DOUBLE[], c), 9) AS score
          FROM centroid c, embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, chunk_id) AS rank FROM d)
    SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM r WHERE rank <= 15
    """,
)
def nearest_to_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = knn(
        label_centroids(vectors), vectors, 15, query_id="label", query_vec="centroid", corpus_id="vec_id"
    )
    return hits.withColumn("score", F.round("score", 6))


@query(
    "nearest_route",
    f"""
    WITH {CENTROID_SQL},
    s AS (SELECT vec_id AS item_id, label::BIGINT AS route, round(list_cosine_similarity(embedding::DOUBLE[], c), 9) AS score
          FROM (SELECT vec_id, embedding FROM embeddings), centroid),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, route) AS rn FROM s)
    SELECT item_id, route, round(score, 6) AS score FROM r WHERE rn = 1
    """,
)
def nearest_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    routed = route_semantic(vectors, label_centroids(vectors), "vec_id", "embedding", "label", "centroid")
    return routed.withColumn("score", F.round("score", 6))


@query(
    "quantised_vectors",
    """
    WITH m AS (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi, max(abs(x))::DOUBLE AS top
               FROM (SELECT unnest(embedding) AS x FROM embeddings))
    SELECT vec_id,
           array_to_string(list_transform(embedding, lambda x: trunc(least(greatest((x::DOUBLE - lo) / ((hi - lo) / 255.0), 0), 255))::INTEGER), ',') AS zero_point,
           array_to_string(list_transform(embedding, lambda x: round_even(x::DOUBLE / (top / 127.0), 0)::INTEGER), ',') AS per_table
    FROM embeddings, m
    """,
)
def quantised_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    levels = quantize_zero_point(vectors).select("vec_id", F.array_join("embedding", ",").alias("zero_point"))
    signed = quantize_tensor(vectors).select("vec_id", F.array_join("embedding", ",").alias("per_table"))
    return levels.join(signed, "vec_id")


@query(
    "group_quantised_vectors",
    """
    WITH g AS (SELECT vec_id, (i - 1) // 8 AS g, i, x::DOUBLE AS x FROM (
                 SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)),
    s AS (SELECT *, max(abs(x)) OVER (PARTITION BY vec_id, g) / 127.0 AS scale FROM g),
    q AS (SELECT *, CASE WHEN scale > 0 THEN round_even(x / scale, 0) ELSE 0 END AS q FROM s)
    SELECT vec_id, string_agg(q::INTEGER::VARCHAR, ',' ORDER BY i) AS q, round(max(abs(x - q * scale)), 6) AS worst FROM q GROUP BY vec_id
    """,
)
def group_quantised_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", quantize_groups("embedding").alias("groups"))
    back = F.zip_with("embedding", dequantize_groups("groups"), lambda x, y: F.abs(x.cast("double") - y))
    return vectors.select(
        "vec_id",
        F.array_join(F.flatten(F.col("groups.q")), ",").alias("q"),
        F.round(F.array_max(back), 6).alias("worst"),
    )


@query(
    "metadata_search",
    """
    SELECT doc_id, n_chars FROM documents WHERE n_chars >= 500 AND n_chars < 5000 AND doc_id >= 10
    """,
)
def metadata_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SearchSpec(min_view_count=10, min_length_sec=500, max_length_sec=5000)
    docs = table(spark, sf_dir, "documents")
    return metadata_filter(docs, spec, views="doc_id", length="n_chars").select("doc_id", "n_chars")


# ---- passages against documents --------------------------------------------
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def vector_hits(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    asked = passages(spark, sf_dir).withColumn("embedding", letter_vector("text"))
    corpus = documents(spark, sf_dir, "doc_id", "text").select("doc_id", letter_vector("text").alias("embedding"))
    return knn(asked, corpus, k, corpus_id="doc_id")


VECTOR_SQL = f"""
    qv AS (SELECT item_id, {unit_sql('v')} AS q FROM (SELECT item_id, {letters_sql('text')} AS v FROM benchmark)),
    dv AS (SELECT doc_id, {unit_sql('v')} AS d FROM (SELECT doc_id, {letters_sql('text')} AS v FROM documents)),
    vs AS (SELECT item_id AS query_id, doc_id AS chunk_id, round(list_distance(q, d), 9) AS score FROM qv, dv),
    vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, chunk_id) AS rank FROM vs)
"""


@query(
    "letter_vector_hits",
    f"WITH {VECTOR_SQL} SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM vr WHERE rank <= 15",
)
def letter_vector_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest documents of every passage by letter-frequency vectors."""
    return vector_hits(spark, sf_dir, 15).withColumn("score", F.round("score", 6))


def lexical_sql(source: str = "SELECT doc_id AS id, text FROM documents") -> str:
    return f"""
    dt AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({sql_words('text')}) AS term FROM ({source})) GROUP BY id, term),
    dl AS (SELECT id, len({sql_words('text')}) AS n FROM ({source})),
    st AS (SELECT count(*) AS n_docs, avg(n) AS avg_n FROM dl),
    df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
    qt AS (SELECT item_id AS query_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({sql_words('text')}) AS term FROM benchmark) GROUP BY item_id, term),
    bs AS (SELECT query_id, id AS chunk_id, round(sum(qtf * ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.5
                  / (tf + 1.5 * (1 - 0.75 + 0.75 * n / avg_n))), 9) AS score
           FROM qt JOIN df USING (term) JOIN dt USING (term) JOIN dl USING (id), st GROUP BY query_id, id),
    br AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM bs WHERE score > 0),
    idf AS (SELECT term, ln((1.0 + n_docs) / (1.0 + df)) + 1.0 AS idf FROM df, st),
    dn AS (SELECT id, sqrt(sum((tf * idf) * (tf * idf))) AS norm FROM dt JOIN idf USING (term) GROUP BY id),
    qn AS (SELECT query_id, sqrt(sum((qtf * idf) * (qtf * idf))) AS norm FROM qt JOIN idf USING (term) GROUP BY query_id),
    ts AS (SELECT query_id, id AS chunk_id, round(sum((qtf * idf) * (tf * idf) / qn.norm / dn.norm), 9) AS score
           FROM qt JOIN idf USING (term) JOIN dt USING (term) JOIN dn USING (id) JOIN qn USING (query_id) GROUP BY query_id, id),
    tr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM ts WHERE score > 0)
    """


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_docs(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")


def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index written once: a search reads it for its statistics, its scores and each round anew."""
    return cut_lineage(index(spark, sf_dir), "lexical-index")


@query(
    "term_statistics",
    f"WITH {lexical_sql()} SELECT term, df FROM df",
)
def term_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_frequency(index(spark, sf_dir))


@query(
    "bm25_hits",
    f"WITH {lexical_sql()} SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM br WHERE rank <= 4",
)
def bm25_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_search(passages(spark, sf_dir), stored_index(spark, sf_dir), 4).withColumn("score", F.round("score", 6))


@query(
    "tfidf_hits",
    f"WITH {lexical_sql()} SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM tr WHERE rank <= 4",
)
def tfidf_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = tfidf_search(passages(spark, sf_dir), tfidf_index(stored_index(spark, sf_dir)), 4)
    return hits.withColumn("score", F.round("score", 6))


FUSED_SQL = f"""
    {lexical_sql()}, {VECTOR_SQL},
    lists AS (SELECT query_id, chunk_id, rank FROM br WHERE rank <= 15
              UNION ALL SELECT query_id, chunk_id, rank FROM vr WHERE rank <= 15),
    fs AS (SELECT query_id, chunk_id, round(sum(1.0 / (rank - 1 + 60)), 9) AS score FROM lists GROUP BY query_id, chunk_id),
    fr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM fs)
"""


def fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexical = bm25_search(passages(spark, sf_dir), stored_index(spark, sf_dir), 15)
    return fuse_searches(lexical, vector_hits(spark, sf_dir, 15), k=15)


@query(
    "fused_hits",
    f"WITH {FUSED_SQL} SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM fr WHERE rank <= 15",
)
def fused_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical and vector lists fused by reciprocal rank."""
    return fused(spark, sf_dir).withColumn("score", F.round("score", 6))


@query(
    "multi_query_documents",
    f"WITH {FUSED_SQL} SELECT DISTINCT query_id, chunk_id FROM lists",
)
def multi_query_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexical = bm25_search(passages(spark, sf_dir), stored_index(spark, sf_dir), 15)
    both = lexical.select("query_id", "chunk_id").unionByName(vector_hits(spark, sf_dir, 15).select("query_id", "chunk_id"))
    return multi_query(both, "query_id", "chunk_id")


@query(
    "hybrid_search",
    f"""
    WITH {FUSED_SQL},
    qs AS (SELECT item_id AS query_id, list_filter(list_distinct(string_split(lower(text), '')), lambda z: z <> '') AS q FROM benchmark),
    ds AS (SELECT doc_id AS chunk_id, list_filter(list_distinct(string_split(lower(text), '')), lambda z: z <> '') AS d FROM documents),
    rs AS (SELECT query_id, chunk_id, round(len(list_intersect(q, d)) / len(d), 9) AS score
           FROM (SELECT query_id, chunk_id FROM fr WHERE rank <= 15) JOIN qs USING (query_id) JOIN ds USING (chunk_id)),
    rr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM rs)
    SELECT query_id, chunk_id, round(score, 6) AS score, rank::INTEGER AS rank FROM rr WHERE rank <= 5
    """,
)
def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical and vector search, fusion, then a pair score over the fused hits."""
    hits = fused(spark, sf_dir).select("query_id", "chunk_id")
    asked = passages(spark, sf_dir).select("query_id", F.col("text").alias("q"))
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("d"))
    pairs = meet_hits(hits, texts, "chunk_id").join(asked, "query_id")
    sets = pairs.select(
        "query_id",
        "chunk_id",
        F.array_distinct(chars(F.lower("q"))).alias("q"),
        F.array_distinct(chars(F.lower("d"))).alias("d"),
    )
    score = F.round(F.size(F.array_intersect("q", "d")) / F.size("d"), 9)
    best = rerank(sets, score, 5)
    return best.select("query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


CHUNK_SOURCE = (
    "SELECT doc_id * 1000000 + i AS id, substr(text, i * 800 + 1, 1000) AS text FROM "
    "(SELECT doc_id, text, unnest(range(0, greatest(ceil((length(text) - 200) / 800.0), 1)::BIGINT)) AS i "
    "FROM documents WHERE length(text) > 0)"
)


@query(
    "parent_documents",
    f"""
    WITH {lexical_sql(CHUNK_SOURCE)}
    SELECT query_id, chunk_id // 1000000 AS doc_id, min(rank)::INTEGER AS rank, round(max(score), 6) AS score, any_value(d.n_chars) AS n_chars
    FROM br JOIN documents d ON d.doc_id = br.chunk_id // 1000000 WHERE rank <= 8 GROUP BY query_id, chunk_id // 1000000
    """,
)
def parent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks are searched, whole documents are returned."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    pieces = explode_items(docs, ["doc_id"], split_overlap("text", 1000, 200), "text")
    keyed = pieces.select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("chunk_id"), "text")
    pieces_index = cut_lineage(lexical_docs(keyed, "chunk_id", "text"), "lexical-index")
    hits = bm25_search(passages(spark, sf_dir), pieces_index, 8)
    owned = hits.withColumn("doc_id", F.expr("chunk_id div 1000000"))
    parents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return expand_to_parent(owned, parents).withColumn("score", F.round("score", 6))


#: Passages with fewer words have no window of eight whole words inside, as their first and last word can be cut.
INNER_WORDS = 10
BLOCK_CHARS = 1_000_000


def short_truth(asked: DataFrame, texts: DataFrame) -> list[DataFrame]:
    """``chunk_id, query_id`` of every text that contains a passage: one scan for each block of passages of bounded size."""
    schema = T.StructType([texts.schema["chunk_id"], asked.schema["query_id"]])
    parts, block, size = [], {}, 0

    def close() -> None:
        nonlocal block, size
        shared = texts.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = ahocorasick.Automaton()
            for passage, ids in shared.value.items():
                if passage:
                    machine.add_word(passage, ids)
            machine.make_automaton()
            for batch in batches:
                rows, found = [], []
                for r, text in enumerate(batch.column(1).to_pylist()):
                    met = set(shared.value.get("", ()))
                    if len(machine):
                        met.update(q for _, ids in machine.iter(text) for q in ids)
                    rows += [r] * len(met)
                    found += met
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, to_arrow_type(schema["query_id"].dataType))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        parts.append(texts.filter(F.col("text").isNotNull()).select("chunk_id", "text").mapInArrow(run, schema))
        block, size = {}, 0

    for row in asked.filter(F.col("text").isNotNull()).select("query_id", "text").toLocalIterator():
        block.setdefault(row["text"], []).append(row["query_id"])
        size += len(row["text"]) + 1
        if size >= BLOCK_CHARS:
            close()
    if block:
        close()
    return parts


def passage_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a passage word for word.

    Candidates meet on an eight-word window from inside the passage (an equi-join);
    the whole passage is then searched in the candidate.  Texts are scanned for shorter passages.
    """
    n_words = F.size(words("text"))
    asked = passages(spark, sf_dir).filter(n_words >= INNER_WORDS).select(
        "query_id", "text", F.array_join(F.slice(words("text"), 2, 8), " ").alias("window")
    )
    docs = documents(spark, sf_dir, "doc_id", "text")
    grams = F.array_distinct(ngrams(words("text"), 8))
    windows = explode_items(docs, [F.col("doc_id").alias("chunk_id")], grams, "window")
    pairs = windows.join(asked, "window").select("chunk_id", "query_id", F.col("text").alias("passage"))
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    found = pairs.join(texts, "chunk_id").filter(F.contains("text", F.col("passage"))).select("query_id", "chunk_id")
    for part in short_truth(passages(spark, sf_dir).filter(n_words < INNER_WORDS), texts):
        found = found.unionByName(part)
    return found.distinct()


@query(
    "retrieval_quality",
    f"""
    WITH {FUSED_SQL},
    truth AS (SELECT b.item_id AS query_id, d.doc_id AS chunk_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
    ranked AS (SELECT 'bm25' AS method, query_id, chunk_id, rank FROM br WHERE rank <= 15
               UNION ALL SELECT 'fused', query_id, chunk_id, rank FROM fr WHERE rank <= 15),
    firsts AS (SELECT method, t.query_id, min(rank) AS first FROM truth t JOIN ranked r
               ON r.query_id = t.query_id AND r.chunk_id = t.chunk_id GROUP BY method, t.query_id),
    asked AS (SELECT m.method, q.query_id FROM (SELECT DISTINCT query_id FROM truth) q, (VALUES ('bm25'), ('fused')) m(method))
    SELECT a.method, count(*) AS queries, round(avg(CASE WHEN first <= 5 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
           round(avg(CASE WHEN first <= 5 THEN 1.0 / first ELSE 0.0 END), 6) AS mrr
    FROM asked a LEFT JOIN firsts f ON a.method = f.method AND a.query_id = f.query_id GROUP BY a.method
    """,
)
def retrieval_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit rate and mean reciprocal rank at 5 of two search methods."""
    # Both are small and used twice: stored once.
    truth = cut_lineage(passage_truth(spark, sf_dir), "truth")
    lexical = cut_lineage(bm25_search(passages(spark, sf_dir), stored_index(spark, sf_dir), 15), "hits")
    methods = {"bm25": lexical, "fused": fuse_searches(lexical, vector_hits(spark, sf_dir, 15), k=15)}
    parts = [retrieval_metrics(hits, truth, 5).withColumn("method", F.lit(name)) for name, hits in methods.items()]
    union = reduce(DataFrame.unionByName, parts)
    return union.select("method", "queries", F.round("hit_rate", 6).alias("hit_rate"), F.round("mrr", 6).alias("mrr"))
