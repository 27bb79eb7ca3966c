"""Lexical and vector search, ranking, fusion and routing.

Search is one pass over the corpus: the query side is turned into a matrix whose
size is checked, every Arrow batch of the corpus is scored against it with one
matrix product, and only the best ``k`` rows per query leave a batch.  Query sets
beyond the bound take a shuffle-based way with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.tokens import term_counts, words
from textmill.functions.vectors import l2_distance, l2_normalise
from textmill.operators.exploding import explode_structs
from textmill.session import cut_lineage

# --- fixed values -----------------------------------------------------------
BM25_K1 = 1.5
BM25_B = 0.75
FUSION_K = 60
FETCHED = 15
RERANKED = 5
DEFAULT_K = 4
# ----------------------------------------------------------------------------

# Values (terms or vector entries) of the query side that one task may hold.
MAX_QUERY_VALUES = 8_000_000
DIGITS = 9


# ---- ranking ---------------------------------------------------------------
def top_k(
    scored: DataFrame,
    k: int,
    query: str = "query_id",
    doc: str = "chunk_id",
    score: str = "score",
    ascending: bool = False,
) -> DataFrame:
    """Best ``k`` rows per query with a 1-based ``rank``; ties go to the lower id.

    The rank filter runs before the exchange too, so a hot query sends ``k`` rows
    per task.
    """
    order = F.col(score).asc() if ascending else F.col(score).desc()
    w = Window.partitionBy(query).orderBy(order, F.col(doc).asc())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rerank(hits: DataFrame, score: Column, k: int = RERANKED, query: str = "query_id", doc: str = "chunk_id") -> DataFrame:
    """Replace the scores and keep the best ``k`` per query."""
    return top_k(hits.drop("rank").withColumn("score", score), k, query, doc)


def rrf(hits: DataFrame, question: str = "question_id", doc: str = "chunk_id", k: int = FUSION_K) -> DataFrame:
    """Reciprocal-rank fusion of several result lists (ranks start at 1 here).

    ``hits`` is usually a union of lists that are each partitioned by question.
    The explicit exchange brings them together again: a runtime re-plan may turn
    such a union into plain concatenation, and then rows of one question would sit
    in two partitions.  Lists are top-k, so little is moved.
    """
    fused = hits.repartition(question, doc).groupBy(question, doc).agg(F.sum(1.0 / (F.col("rank") - 1 + k)).alias("score"))
    return fused.withColumn("score", F.round("score", DIGITS))


def multi_query(hits: DataFrame, question: str = "question_id", doc: str = "chunk_id") -> DataFrame:
    """Distinct documents found by any query of a question."""
    return hits.select(question, doc).repartition(question, doc).distinct()


# Rows of a stored hit table that may be broadcast.
MAX_BROADCAST_HITS = 2_000_000


def meet_hits(hits: DataFrame, big: DataFrame, key: str) -> DataFrame:
    """Join a hit table to a corpus by key.

    The hits are stored first, so their number is known: a small table is broadcast
    and the corpus is scanned in place, a large one meets the corpus in a shuffle.
    """
    stored = cut_lineage(hits, "hits")
    small = stored.count() <= MAX_BROADCAST_HITS
    return big.join(F.broadcast(stored) if small else stored, key)


def expand_to_parent(hits: DataFrame, docs: DataFrame, query: str = "query_id", parent: str = "doc_id") -> DataFrame:
    """Whole documents of the hits, once per query, best rank first kept."""
    best = hits.groupBy(query, parent).agg(F.min("rank").alias("rank"), F.max("score").alias("score"))
    return meet_hits(best, docs, parent)


# ---- bounded query side ----------------------------------------------------
def _bounded(queries: DataFrame, values: Column, limit: int) -> bool:
    total = queries.agg(F.sum(values)).first()[0] or 0
    return total <= limit


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and query positions of the best ``k`` per column (ties: lower id)."""
    keep = min(k, scores.shape[0])
    if keep < scores.shape[0]:
        # Everything at least as good as the k-th value stays, so ties are kept whole.
        limit = np.partition(scores, scores.shape[0] - keep, axis=0)[scores.shape[0] - keep]
        rows, cols = np.nonzero(scores >= limit)
    else:
        rows, cols = np.nonzero(np.ones_like(scores, dtype=bool))
    order = np.lexsort((ids[rows], -scores[rows, cols], cols))
    rows, cols = rows[order], cols[order]
    position = np.arange(len(cols)) - np.searchsorted(cols, cols, side="left")
    chosen = position < keep
    return rows[chosen], cols[chosen]


def _hits(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[cols]), pa.array(ids[rows]), pa.array(scores[rows, cols])],
        names=["query_id", "chunk_id", "score"],
    )


HIT_SCHEMA = "query_id long, chunk_id long, score double"


# Scores one task may hold at a time.
MAX_SCORES = 4_000_000
# Share of the squared lengths below which a squared distance is computed from the differences.
_CANCELLED = 1e-5


def _slice_rows(width: int, most: int = 512) -> int:
    """Rows per slice, so that a slice times ``width`` stays below the bound."""
    return max(1, min(most, MAX_SCORES // max(width, 1)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), dim)


# ---- vector search ---------------------------------------------------------
def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = FETCHED,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    corpus_id: str = "chunk_id",
    corpus_vec: str = "embedding",
    max_values: int = MAX_QUERY_VALUES,
) -> DataFrame:
    """Exact flat search by L2 distance: ``query_id, chunk_id, score, rank``."""
    left = queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(query_vec).cast("array<double>").alias("v"))
    right = corpus.select(F.col(corpus_id).cast("long").alias("chunk_id"), F.col(corpus_vec).cast("array<double>").alias("v"))
    if _bounded(left, F.size("v"), max_values):
        rows = left.toArrow()
        if rows.num_rows == 0:
            found = right.sparkSession.createDataFrame([], HIT_SCHEMA)
        else:
            query_ids = rows["query_id"].to_numpy()
            vectors = _matrix(rows["v"].combine_chunks(), len(rows["v"][0]))
            found = right.mapInArrow(_distance_pass(query_ids, vectors, k), HIT_SCHEMA)
    else:
        found = _knn_blocks(left, right, k, max_values)
    ranked = found.withColumn("score", F.round("score", DIGITS))
    return top_k(ranked, k, ascending=True)


def _near(vectors: np.ndarray, batch: np.ndarray) -> np.ndarray:
    """Distances rounded as the result is, so equal distances tie in every batch.

    The product form loses all digits of a small distance; pairs whose square is small against
    the lengths are computed again from the differences.
    """
    lengths = (batch**2).sum(1)[:, None] + (vectors**2).sum(1)[None, :]
    squared = np.maximum(lengths - 2.0 * batch @ vectors.T, 0.0)
    rows, cols = np.nonzero(squared < _CANCELLED * lengths)
    # Slices keep the differences as small as the scores of a task.
    step = max(1, MAX_SCORES // max(vectors.shape[1], 1))
    for at in range(0, len(rows), step):
        r, c = rows[at : at + step], cols[at : at + step]
        squared[r, c] = ((batch[r] - vectors[c]) ** 2).sum(1)
    return np.round(np.sqrt(squared), DIGITS)


def _distance_pass(query_ids: np.ndarray, vectors: np.ndarray, k: int) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = _slice_rows(len(query_ids))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                ids = batch["chunk_id"].to_numpy()
                near = _near(vectors, _matrix(batch["v"], vectors.shape[1]))
                rows, cols = _best(-near, ids, k)
                yield _hits(rows, cols, near, ids, query_ids)

    return score


def _knn_blocks(left: DataFrame, right: DataFrame, k: int, max_values: int) -> DataFrame:
    """Query sets beyond the bound: query blocks meet corpus cells in shuffled groups."""
    spark = left.sparkSession
    width = left.agg(F.max(F.size("v"))).first()[0]
    per_block = max(1, max_values // (8 * max(width, 1)))
    blocks = max(1, -(-left.count() // per_block))
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-right.count() // per_block))

    def bucket(c: str, n: int) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    asked = left.withColumn("block", bucket("query_id", blocks)).withColumn(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    )
    stored = right.withColumn("cell", bucket("chunk_id", cells)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def meet(queries: pa.Table, corpus: pa.Table) -> pa.Table:
        if queries.num_rows == 0 or corpus.num_rows == 0:
            return pa.table({"query_id": pa.array([], pa.int64()), "chunk_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        vectors = _matrix(queries["v"].combine_chunks(), len(queries["v"][0]))
        score = _distance_pass(queries["query_id"].to_numpy(), vectors, k)
        return pa.Table.from_batches(list(score(iter(corpus.combine_chunks().to_batches()))))

    return asked.groupBy("block", "cell").cogroup(stored.groupBy("block", "cell")).applyInArrow(meet, HIT_SCHEMA)


def exact_distances(hits: DataFrame, queries: DataFrame, corpus: DataFrame, **names: str) -> DataFrame:
    """Recompute the distance of every hit row by row (for checks)."""
    q = queries.select(F.col(names.get("query_id", "query_id")).alias("query_id"), F.col("embedding").alias("_q"))
    c = corpus.select(F.col(names.get("chunk_id", "chunk_id")).alias("chunk_id"), F.col("embedding").alias("_c"))
    return hits.join(q, "query_id").join(c, "chunk_id").withColumn("score", l2_distance("_q", "_c")).drop("_q", "_c")


def route_semantic(queries: DataFrame, routes: DataFrame, query_id: str, query_vec: str, route: str, route_vec: str) -> DataFrame:
    """Route whose vector is closest by cosine; ties go to the lower route."""
    units = queries.select(F.col(query_id).alias("chunk_id"), l2_normalise(query_vec).alias("v"))
    targets = routes.select(F.col(route).cast("long").alias("query_id"), l2_normalise(route_vec).alias("v"))
    if not _bounded(targets, F.size("v"), MAX_QUERY_VALUES):
        # For unit vectors the nearest by distance is the nearest by cosine.
        near = _knn_blocks(units.select(F.col("chunk_id").alias("query_id"), "v"), targets.select(F.col("query_id").alias("chunk_id"), "v"), 1, MAX_QUERY_VALUES)
        return top_k(near, 1, ascending=True).select(
            F.col("query_id").alias("item_id"),
            F.col("chunk_id").alias("route"),
            F.round(1 - F.col("score") ** 2 / 2, DIGITS).alias("score"),
        )
    table = targets.orderBy("query_id").toArrow()
    route_ids = table["query_id"].to_numpy()
    vectors = _matrix(table["v"].combine_chunks(), len(table["v"][0]))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cosines = np.round(_matrix(batch["v"], vectors.shape[1]) @ vectors.T, DIGITS)
            best = cosines.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["chunk_id"], pa.array(route_ids[best]), pa.array(cosines[np.arange(len(best)), best])],
                names=["item_id", "route", "score"],
            )

    return units.select(F.col("chunk_id").cast("long"), "v").mapInArrow(choose, "item_id long, route long, score double")


# ---- lexical search --------------------------------------------------------
def lexical_docs(corpus: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``chunk_id, terms array<struct<term, tf>>, n_terms``: the forward index.

    Terms are counted inside the row, so the index needs no shuffle.
    """
    tokens = corpus.select(F.col(doc_id).cast("long").alias("chunk_id"), words(text).alias("_tokens"))
    return tokens.select("chunk_id", term_counts(F.col("_tokens")).alias("terms"), F.size("_tokens").alias("n_terms"))


def postings(index: DataFrame) -> DataFrame:
    """``chunk_id, term, tf, n_terms``: one row per distinct term of a document."""
    return explode_structs(index, ["chunk_id", "n_terms"], F.col("terms"))


def document_frequency(index: DataFrame) -> DataFrame:
    """``term, df`` with map-side counting."""
    return postings(index).groupBy("term").agg(F.count("*").alias("df"))


def index_stats(index: DataFrame) -> DataFrame:
    """One row: number of documents and mean length."""
    return index.agg(F.count("*").alias("n_docs"), F.avg("n_terms").alias("avg_terms"))


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def tfidf_idf(n_docs: Column, df: Column) -> Column:
    return F.log((1.0 + n_docs) / (1.0 + df)) + 1.0


def _query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """``query_id, term, qtf`` counted inside the row."""
    counted = explode_structs(queries, [F.col(query_id).cast("long").alias("query_id")], term_counts(words(text)))
    return counted.withColumnRenamed("tf", "qtf")


# No token is empty, so the empty term can stand for "every document".
ANY_DOCUMENT = ""


def _asked_statistics(index: DataFrame, asked: DataFrame, small: bool) -> tuple[DataFrame, int, float]:
    """Document frequency of the asked terms, number of documents and mean length.

    One pass: every document also emits a marker row that counts it.
    """
    marker = F.struct(F.lit(ANY_DOCUMENT).alias("term"), F.lit(0).alias("tf"))
    rows = explode_structs(index, ["n_terms"], F.concat(F.array(marker), F.col("terms")))
    spark = index.sparkSession
    wanted = asked.select("term").unionByName(spark.createDataFrame([(ANY_DOCUMENT,)], "term string")).distinct()
    counted = (
        rows.join(F.broadcast(wanted) if small else wanted, "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("n_terms").alias("total"))
    )
    if small:
        # Bounded by the asked terms: keep the counts as a local table, so the pass runs once.
        counted = spark.createDataFrame(counted.toArrow())
    else:
        counted = cut_lineage(counted, "term-counts")
    every = counted.filter(F.col("term") == ANY_DOCUMENT).first()
    n_docs = every["df"] if every else 0
    mean = every["total"] / n_docs if n_docs else 1.0
    return counted.filter(F.col("term") != ANY_DOCUMENT).select("term", "df"), n_docs, mean or 1.0


def _fits(asked: DataFrame, max_values: int) -> bool:
    """True when a dense term x query table stays below the bound."""
    terms, queries = asked.agg(F.countDistinct("term"), F.countDistinct("query_id")).first()
    return 0 < terms * queries <= max_values


def _sparse_pass(query_ids: np.ndarray, weights: np.ndarray, vocabulary: list[str], k: int, saturate: Callable) -> Callable:
    """Score batches of ``chunk_id, terms, n_terms, scale`` against ``weights`` (term x query)."""
    lookup = {term: i for i, term in enumerate(vocabulary)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Small slices keep the dense document x term block modest.
            step = _slice_rows(max(len(vocabulary), len(query_ids)))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                ids = batch["chunk_id"].to_numpy()
                rows = np.repeat(np.arange(batch.num_rows), np.diff(batch["terms"].offsets.to_numpy()))
                flat = batch["terms"].flatten()
                cols = np.fromiter((lookup.get(t, -1) for t in flat.field("term").to_pylist()), np.int64, len(flat))
                known = cols >= 0
                rows, cols = rows[known], cols[known]
                tf = flat.field("tf").to_numpy(zero_copy_only=False)[known].astype(np.float64)
                block = np.zeros((batch.num_rows, len(vocabulary)))
                block[rows, cols] = saturate(tf, batch["scale"].to_numpy(zero_copy_only=False)[rows])
                scores = np.round(block @ weights, DIGITS)
                best_rows, best_cols = _best(scores, ids, k)
                shared = scores[best_rows, best_cols] > 0
                yield _hits(best_rows[shared], best_cols[shared], scores, ids, query_ids)

    return score


def _search(index: DataFrame, weighted: DataFrame, scale: Column, saturate: Callable, k: int, small: bool) -> DataFrame:
    """``weighted`` holds ``query_id, term, weight``; ``scale`` is per document.

    ``saturate(tf, scale)`` is plain arithmetic: it serves columns and arrays alike.
    """
    scaled = index.withColumn("scale", scale)
    if small:
        rows = weighted.toArrow()
        vocabulary = sorted(set(rows["term"].to_pylist()))
        query_ids = np.unique(rows["query_id"].to_numpy())
        place = {t: i for i, t in enumerate(vocabulary)}
        weights = np.zeros((len(vocabulary), len(query_ids)))
        term_at = np.array([place[t] for t in rows["term"].to_pylist()], dtype=np.int64)
        weights[term_at, np.searchsorted(query_ids, rows["query_id"].to_numpy())] = rows["weight"].to_numpy()
        found = scaled.select("chunk_id", "terms", "scale").mapInArrow(
            _sparse_pass(query_ids, weights, vocabulary, k, saturate), HIT_SCHEMA
        )
    else:
        # Many queries: meet on the term, add up per (query, document), rank.
        stored = explode_structs(scaled, ["chunk_id", "scale"], F.col("terms"))
        part = F.col("weight") * saturate(F.col("tf"), F.col("scale"))
        found = (
            stored.join(weighted, "term")
            .groupBy("query_id", "chunk_id")
            .agg(F.round(F.sum(part), DIGITS).alias("score"))
            .filter(F.col("score") > 0)
        )
    return top_k(found, k)


def bm25_search(
    queries: DataFrame,
    index: DataFrame,
    k: int = DEFAULT_K,
    query_id: str = "query_id",
    text: str = "text",
    max_values: int = MAX_QUERY_VALUES,
) -> DataFrame:
    """Best documents by BM25 (non-negative idf) over a :func:`lexical_docs` index."""
    asked = _query_terms(queries, query_id, text)
    small = _fits(asked, max_values)
    df, n_docs, mean = _asked_statistics(index, asked, small)
    idf = df.select("term", bm25_idf(F.lit(float(n_docs)), F.col("df")).alias("idf"))
    weighted = asked.join(idf, "term").select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"))
    scale = BM25_K1 * (1 - BM25_B + BM25_B * F.col("n_terms") / F.lit(float(mean)))
    return _search(index, weighted, scale, lambda tf, s: tf * (BM25_K1 + 1) / (tf + s), k, small)


# Terms a broadcast table of inverse document frequencies may hold.
MAX_BROADCAST_TERMS = 2_000_000


def _with_idf(rows: DataFrame, df: DataFrame, n_docs: int) -> DataFrame:
    """Attach ``idf`` to posting rows.

    A vocabulary within the bound is broadcast.  Beyond it only the common terms
    are (a term in every 10 000th document or more: their number is bounded by the
    mean number of terms per document), the rare rest meets in a shuffle without
    hot keys.
    """
    idf = df.select("term", "df", tfidf_idf(F.lit(float(n_docs)), F.col("df")).alias("idf"))
    if df.count() <= MAX_BROADCAST_TERMS:
        return rows.join(F.broadcast(idf.drop("df")), "term")
    common = F.broadcast(idf.filter(F.col("df") * 10_000 >= n_docs).drop("df"))
    rare = idf.filter(F.col("df") * 10_000 < n_docs).drop("df")
    return rows.join(common, "term").unionByName(rows.join(common, "term", "left_anti").join(rare, "term"))


def tfidf_index(index: DataFrame) -> DataFrame:
    """Forward index with the length of every document's TF-IDF vector.

    The vocabulary and the result are written once: searches read the stored index.
    """
    n_docs = index.count()
    vocabulary = cut_lineage(document_frequency(index), "vocabulary")
    rows = _with_idf(postings(index), vocabulary, n_docs)
    weighed = rows.groupBy("chunk_id", "n_terms").agg(
        F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("norm"),
        F.collect_list(F.struct("term", "tf")).alias("terms"),
    )
    return cut_lineage(weighed, "tfidf-index")


def tfidf_search(
    queries: DataFrame,
    index: DataFrame,
    k: int = DEFAULT_K,
    query_id: str = "query_id",
    text: str = "text",
    max_values: int = MAX_QUERY_VALUES,
) -> DataFrame:
    """Best documents by cosine of TF-IDF vectors over a :func:`tfidf_index` index."""
    asked = _query_terms(queries, query_id, text)
    small = _fits(asked, max_values)
    df, n_docs, _ = _asked_statistics(index, asked, small)
    idf = df.select("term", tfidf_idf(F.lit(float(n_docs)), F.col("df")).alias("idf"))
    raw = asked.join(idf, "term").withColumn("w", F.col("qtf") * F.col("idf"))
    lengths = raw.groupBy("query_id").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("query_norm"))
    weighted = raw.join(lengths, "query_id").select(
        "query_id", "term", (F.col("w") * F.col("idf") / F.col("query_norm")).alias("weight")
    )
    return _search(index, weighted, F.col("norm"), lambda tf, s: tf / s, k, small)


def fuse_searches(*results: DataFrame, k: int = FETCHED) -> DataFrame:
    """Union of result lists, fused by rank: ``query_id, chunk_id, score, rank``."""
    lists = [r.select("query_id", "chunk_id", "rank") for r in results]
    union = lists[0]
    for other in lists[1:]:
        union = union.unionByName(other)
    return top_k(rrf(union, "query_id", "chunk_id"), k)


class Retriever(Protocol):
    """Anything that answers a table of queries with a table of hits."""

    def __call__(self, queries: DataFrame) -> DataFrame: ...


def lexical_retriever(index: DataFrame, k: int = DEFAULT_K, method: str = "bm25", **names: str) -> Retriever:
    search = {"bm25": bm25_search, "tfidf": tfidf_search}[method]
    return lambda queries: search(queries, index, k, **names)


def vector_retriever(corpus: DataFrame, embed: Callable[[DataFrame], DataFrame], k: int = DEFAULT_K, **names: str) -> Retriever:
    return lambda queries: knn(embed(queries), corpus, k, **names)
