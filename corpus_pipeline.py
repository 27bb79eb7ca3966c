"""A corpus for training: what is toxic, copied or leaked goes, the rest is encoded.

Each stage is one operator over all rows that the stage before kept; its result is written
as Parquet and read again.  Null and empty texts pass all stages (as one text: copies of
it go), repeated rows go as exact copies.  Of rows whose fingerprints are linked (shingle
length and bit distance of the SimHash operator) the one with the smallest id stays; no id is
the largest.  Stages that hand whole texts to Python lower the rows of an Arrow batch in the
session; ``run`` puts the setting back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import byte_bpe, decontaminate, exact_names, simhash_tree, toxicity
from textmill.llm.registry import table
from textmill.session import BATCH_KEY, cut_lineage, small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine, trained on all labels, does not call toxic."""
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # Names of the machine's columns must not be those of the documents.
    names = tuple(n + "_" * len("".join(docs.columns)) for n in ("score", "predicted"))
    return toxicity.score(docs, model, names=names).filter(F.col(names[1]) == 0).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of all whose texts have the same block name."""
    return exact_names.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    small_batches(spark)
    who = "who_" + "_".join(docs.columns)
    # Ids can be null or repeat, so a row's place in the order ends with a number of its own.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"))
    rows = cut_lineage(docs.withColumn(who, order), "numbered")
    groups = simhash_tree.near_groups(rows, key=who)
    gone = cut_lineage(groups.filter(F.col(who) != F.col("component_id")).select(F.col(f"{who}.row").alias("gone")), "near-copies")
    return rows.join(gone, F.col(f"{who}.row") == F.col("gone"), "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a test item."""
    small_batches(spark)
    # Rows have a number of their own: ids can be null or repeat.
    row = "row_" + "_".join(docs.columns)
    rows = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = decontaminate.matches(rows, table(spark, sf_dir, "benchmark"), key=row)
    gone = cut_lineage(found.select(row).distinct(), "leaks")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and a digest of what they decode to."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode_texts),
]

#: Learned scores, alignment and merges are not SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH_KEY)
    try:
        for name, stage in STAGES:
            docs = cut_lineage(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(BATCH_KEY, before)
    return docs
