"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    exact_names,
    language_id,
    licenses,
    line_dedup,
    repeat_index,
    sharding,
    simhash_tree,
    token_counts,
    toxicity,
    whitening,
)
from textmill.llm.registry import QUERIES, TWINS, query, table

__all__ = ["QUERIES", "TWINS"]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# Windows of 200 bytes as 400 hexadecimal digits; a byte goes when a repeated window covers it.
REPEATS_SQL = """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    blocks AS (SELECT r, b, substr(h, 2000 * b + 1, 2398) AS h FROM (SELECT r, h, unnest(range(0, length(h) // 2000 + 1)) AS b FROM d)),
    w AS (SELECT r, 1000 * b + p AS p, md5(substr(h, 2 * p + 1, 400)) AS k
          FROM (SELECT r, b, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS p FROM blocks)),
    again AS (SELECT r, p FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1),
    runs AS (SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS run
             FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM again)),
    spans AS (SELECT r, run, min(p) AS a, max(p) + 200 AS b FROM runs GROUP BY r, run),
    edges AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM spans),
    parts AS (SELECT r, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head, max(b) AS b, sum(b - a) AS gone, count(*) AS n
              FROM edges JOIN d USING (r) GROUP BY r)
    SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(b, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN parts USING (r)
"""


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, RANKS, PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_block_names")
def op9_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_names.exact_groups(docs).drop("n_points")


@query("op10_simhash_trees")
def op10_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash_tree.near_groups(docs)
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op4_string_kernel_toxicity")
def op4_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    apart = language_id.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, labels.filter(~apart))
    return toxicity.score(docs, model).select("doc_id", apart.alias("held_out"), "score", "predicted")


@query("op8_language_filters")
def op8_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = language_id.held_out(F.col("doc_id"), 3, 1)
    model = language_id.fit(docs.filter(~apart), "doc_id", "text", "lang")
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", apart.alias("held_out"), "lang_pred", "score")


@query("op2_benchmark_alignment")
def op2_benchmark_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


@query("op3_bounded_ring")
def op3_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    keys = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.assign(keys, ["doc_id", "size", "text_crc32"], 16)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query("op1_token_lengths")
def op1_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    return token_counts.histogram(token_counts.lengths(docs, RANKS, PATTERN))


@query("op6_license_rules")
def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    met = F.filter("places", lambda p: p["n"] > 0)
    base = F.array_sort(F.transform(met, lambda p: p["label"]))
    own = F.transform(F.coalesce("detections", F.array().cast(found.schema["detections"].dataType)), lambda d: d["label"])
    weights = F.create_map(*[F.lit(x) for pair in licenses.WEIGHTS.items() for x in pair])
    best = F.array_min(F.transform("detections", lambda d: d["priority"]))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("places", F.lit(0).cast("long"), lambda n, p: n + p["n"]).alias("n_base"),
        F.array_min(F.transform(met, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(met, lambda p: p["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(F.coalesce(weights[best], F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"),
    )


@query("op7_site_lines")
def op7_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))


PHRASES_SQL = r"""
    WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
    g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k))),
    n AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
    f AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
    cuts AS (SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS x, array_to_string(w[c + 1:], ' ') AS y
             FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
    s AS (SELECT cuts.*, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * a * n.n) // (l.f::HUGEINT * r.f) AS score
          FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y JOIN n ON n.lang = cuts.lang),
    low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inner_phrases AS (SELECT lang, f, unnest([array_to_string(w[2:], ' '), array_to_string(w[1:k - 1], ' ')]) AS phrase FROM f WHERE k > 2),
    held AS (SELECT lang, phrase, max(f) AS most FROM inner_phrases GROUP BY lang, phrase)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM low LEFT JOIN held USING (lang, phrase) WHERE coalesce(most, 0) < a QUALIFY rank <= 2000
"""


@query("op11_fm_phrases", PHRASES_SQL)
def op11_fm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.best_phrases(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op12_suffix_levels", REPEATS_SQL)
def op12_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeat_index.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op13_whitened_vectors")
def op13_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
