"""Question answering over tables of questions.

All questions move together: every step maps one table to the next.  Lists that
are collected per question hold top-k hits or generated lines, so they are bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.prompts import NO_REPLY, format_docs, format_qa, split_queries
from textmill.operators.filters import keep_relevant
from textmill.operators.hooks import Loader, call_model, generate, grade
from textmill.operators.retrieval import DEFAULT_K, Retriever, expand_to_parent, knn, meet_hits
from textmill.session import cut_lineage


def attach_texts(hits: DataFrame, corpus: DataFrame, chunk_id: str = "chunk_id", text: str = "text") -> DataFrame:
    """Hits with the text of their chunk."""
    return meet_hits(hits, corpus.select(F.col(chunk_id).alias("chunk_id"), F.col(text).alias("document")), "chunk_id")


def ranked_documents(hits: DataFrame, query: str = "query_id") -> DataFrame:
    """``documents``: texts of a query's hits in rank order (top-k, so bounded)."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "chunk_id", "document")))
    return hits.groupBy(query).agg(F.transform(ordered, lambda h: h["document"]).alias("documents"))


def refine(df: DataFrame, load: Loader, question: str = "question", documents: str = "documents", out: str = "generation") -> DataFrame:
    """Fold over the ranked documents; every call sees the answer so far.

    Rows of a batch advance together: call ``i`` handles all rows that still have
    an ``i``-th document.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    names = [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            asked = batch[question].to_pylist()
            docs = [d or [] for d in batch[documents].to_pylist()]
            answers = [NO_REPLY] * len(asked)
            for i in range(max(map(len, docs), default=0)):
                open_rows = [r for r, d in enumerate(docs) if len(d) > i]
                replies = model(
                    [asked[r] for r in open_rows], [docs[r][i] for r in open_rows], [answers[r] for r in open_rows]
                )
                for r, reply in zip(open_rows, replies):
                    answers[r] = reply
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], names=names)

    return df.mapInArrow(run, schema)


def decompose_answer(
    questions: DataFrame,
    corpus: DataFrame,
    retriever: Retriever,
    split: Loader,
    answer: Loader,
    merge: Loader,
    question_id: str = "question_id",
    question: str = "question",
) -> DataFrame:
    """Sub-questions are answered on their own, then merged into one answer."""
    # A model may answer differently when asked again, so its lines are stored before they are read twice.
    lines = cut_lineage(generate(questions.select(question_id, question), split, question, "_lines"), "lines")
    subs = lines.select(question_id, F.posexplode(split_queries("_lines")).alias("pos", "sub_question"))
    keyed = subs.withColumn("query_id", F.xxhash64(F.col(question_id), F.col("pos")))
    hits = attach_texts(retriever(keyed.select("query_id", F.col("sub_question").alias("text"))), corpus)
    found = keyed.join(ranked_documents(hits), "query_id", "left")
    with_context = found.withColumn(
        "context", format_docs(F.coalesce("documents", F.array().cast("array<string>")))
    )
    answered = call_model(with_context.drop("documents"), answer, ["sub_question", "context"], "answer", T.StringType())
    block = F.struct("pos", format_qa("sub_question", "answer", F.col("pos")).alias("text"))
    merged = answered.groupBy(question_id).agg(F.sort_array(F.collect_list(block)).alias("_blocks"))
    context = merged.select(question_id, format_docs(F.transform("_blocks", lambda b: b["text"])).alias("context"))
    return call_model(questions.join(context, question_id), merge, [question, "context"], "generation", T.StringType())


def route(
    df: DataFrame,
    label: str,
    branches: dict[str, Callable[[DataFrame], DataFrame]],
    otherwise: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Send rows to the branch of their label and union the results (one schema).

    Rows with another label or none go to ``otherwise``; without it they are left out.
    """
    parts = [branch(df.filter(F.col(label) == name)) for name, branch in branches.items()]
    if otherwise is not None:
        listed = F.coalesce(F.col(label).isin(*branches), F.lit(False))
        parts.append(otherwise(df.filter(~listed)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def hyde(questions: DataFrame, write: Loader, embed_fn: Callable[[DataFrame, str], DataFrame], corpus: DataFrame, k: int = DEFAULT_K, question: str = "question") -> DataFrame:
    """Search with a generated document instead of the question (``query_id`` keyed)."""
    written = cut_lineage(generate(questions, write, question, "hypothetical"), "written")
    return knn(embed_fn(written, "hypothetical"), corpus, k)


def summary_index(docs: DataFrame, summarise: Loader, embed_fn: Callable[[DataFrame, str], DataFrame], text: str = "text") -> DataFrame:
    """``doc_id, chunk_id, summary, embedding``: one searchable summary per document."""
    made = generate(docs, summarise, text, "summary").select("doc_id", F.col("doc_id").alias("chunk_id"), "summary")
    summaries = cut_lineage(made, "summaries")
    return embed_fn(summaries, "summary")


def search_summaries(queries: DataFrame, index: DataFrame, docs: DataFrame, k: int = 1) -> DataFrame:
    """Whole documents behind the best summaries."""
    hits = knn(queries, index, k).withColumn("doc_id", F.col("chunk_id"))
    return expand_to_parent(hits, docs)


def corrective_rag(
    questions: DataFrame,
    corpus: DataFrame,
    retriever: Retriever,
    relevance: Loader,
    rewrite: Loader,
    answer: Loader,
    check: Loader,
    max_rounds: int = 3,
    fallback: tuple[Retriever, DataFrame] | None = None,
) -> DataFrame:
    """Retrieve, grade, answer and check; open questions are rewritten and retried.

    ``questions`` has ``question_id, question``.  Only open rows take part in the
    next round and each round is written to the shared folder.  The last round asks
    the fallback source when there is one; rows still open then end as ``open``.
    """
    state = questions.select("question_id", "question", F.col("question").alias("query"))
    finished: list[DataFrame] = []
    for step in range(1, max_rounds + 1):
        last = step == max_rounds
        find, source = fallback if last and fallback else (retriever, corpus)
        asked = state.select(F.col("question_id").alias("query_id"), F.col("query").alias("text"))
        hits = attach_texts(find(asked), source).join(
            state.select(F.col("question_id").alias("query_id"), "question"), "query_id"
        )
        relevant = keep_relevant(grade(hits, relevance, ["question", "document"]))
        docs = ranked_documents(relevant).withColumnRenamed("query_id", "question_id")
        with_docs = state.join(docs, "question_id", "left").withColumn(
            "context", format_docs(F.coalesce("documents", F.array().cast("array<string>")))
        )
        replied = call_model(with_docs, answer, ["question", "context"], "generation", T.StringType())
        checked = grade(replied, check, ["question", "context", "generation"], "verdict")
        good = (F.size(F.coalesce("documents", F.array().cast("array<string>"))) > 0) & (F.col("verdict") == "yes")
        judged = cut_lineage(
            checked.select(
                "question_id",
                "question",
                "query",
                "generation",
                F.coalesce("documents", F.array().cast("array<string>")).alias("documents"),
                F.when(good, "useful").otherwise("open").alias("status"),
                F.lit(step).alias("round"),
            ),
            f"round-{step}",
        )
        finished.append(judged if last else judged.filter(F.col("status") == "useful"))
        if last:
            break
        still_open = judged.filter(F.col("status") == "open")
        if still_open.isEmpty():
            break
        rewritten = generate(still_open.select("question_id", "question", "query"), rewrite, "query", "query")
        state = cut_lineage(rewritten, f"rewritten-{step}")
    result = finished[0]
    for part in finished[1:]:
        result = result.unionByName(part)
    return result

