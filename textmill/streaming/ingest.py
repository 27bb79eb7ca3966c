"""Incremental corpus ingestion with the batch expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textmill.plans.prepare import SourceSpec, prepare
from textmill.sources.readers import CORRUPT, good_records

COUNTS = "source_file string, rows_read long, rows_rejected long, rows_kept long"


def ingest_stream(
    spark: SparkSession,
    spec: SourceSpec,
    schema: str,
    src: str,
    dst: str,
    checkpoint: str,
    compression: str = "gzip",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Prepare the files that are new since the last call and append them.

    The columns are stateless and the file sink commits through the checkpoint, so
    a restarted job neither loses nor repeats a file.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(src)
    return (
        prepare(raw, spec)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("compression", compression)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(dst)
    )


def ingest_counted(
    spark: SparkSession,
    spec: SourceSpec,
    schema: str,
    src: str,
    dst: str,
    rejects: str,
    counts: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Like ``ingest_stream``, but every line that is read is accounted for.

    Prepared rows go to ``dst``, unreadable lines with their file to ``rejects``, and ``counts`` gets,
    for each batch, a row per file and one over all files (null) with what was observed while the
    rows passed.  All three have one folder a batch (``batch=<id>``), which is overwritten: a batch
    that is run again after a failure replaces what its first try left.
    """
    full = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    raw = (
        spark.readStream.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch).json(src)
        .withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        session, folder = batch.sparkSession, f"batch={batch_id}"
        read, kept = Observation(), Observation()
        seen = batch.observe(read, F.count("*").alias("rows_read"), F.count(CORRUPT).alias("rows_rejected"))
        rows = prepare(good_records(seen), spec, ("source_file",)).observe(kept, F.count("*").alias("rows_kept"))
        rows.write.mode("overwrite").parquet(f"{dst}/{folder}")
        total = session.createDataFrame(
            [(None, read.get["rows_read"], read.get["rows_rejected"], kept.get["rows_kept"])], COUNTS
        )
        bad = batch.filter(F.col(CORRUPT).isNotNull()).select("source_file", F.col(CORRUPT).alias("line"))
        bad.write.mode("overwrite").parquet(f"{rejects}/{folder}")
        one = F.lit(1).cast("long")
        per_file = batch.select("source_file", one.alias("read"), F.col(CORRUPT).isNotNull().cast("long").alias("bad"), F.lit(0).cast("long").alias("kept"))
        stored = session.read.parquet(f"{dst}/{folder}").select("source_file", *[F.lit(v).cast("long").alias(c) for c, v in (("read", 0), ("bad", 0), ("kept", 1))])
        files = per_file.unionByName(stored).groupBy("source_file").agg(
            F.sum("read").alias("rows_read"), F.sum("bad").alias("rows_rejected"), F.sum("kept").alias("rows_kept")
        )
        files.unionByName(total).write.mode("overwrite").parquet(f"{counts}/{folder}")

    return (
        raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
