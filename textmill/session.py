"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SCRATCH_KEY = "spark.textmill.scratch"
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of whole texts that Python gets at a time; Spark's 10 000 are tens of megabytes on both sides of the pipe.
TEXT_ROWS = 1024


def build_session(app: str = "textmill", cpus: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Long expressions are built call by call; do not record a stack for each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # A union of equally partitioned inputs must not be taken as partitioned: the
        # adaptive re-plan may concatenate its inputs instead of zipping them.
        "spark.sql.unionOutputPartitioning": "false",
        "spark.driver.memory": "16g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where that is unset, ``spark.textmill.scratch`` may name one.  Only a local session,
    whose tasks share one disk, gets a folder of its own; elsewhere a missing setting
    is an error.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.conf.get(SCRATCH_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder")
        folder = tempfile.mkdtemp(prefix="textmill-")
        spark.conf.set(SCRATCH_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str = "step") -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; the stored table and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Iterative operators use this between rounds: the plan stays short and a
    lost executor only costs a re-read of the written files.
    """
    return store(df, label)[0]


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> str:
    """Hand Python ``rows`` rows at most at a time (a lower setting stays); the setting before."""
    before = spark.conf.get(BATCH_KEY)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH_KEY, str(rows))
    return before


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a stored intermediate that no later plan reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
