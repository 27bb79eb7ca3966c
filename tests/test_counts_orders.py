"""Counted ingestion over restarts, and orders that are computed."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from textmill.operators.ordering import permuted, permuted_positions
from textmill.plans.prepare import PAIR_SPECS
from textmill.sources.readers import INSTRUCTION
from textmill.streaming.ingest import ingest_counted


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_onto_for_any_size(spark, n):
    places = [r.p for r in spark.range(n).select(permuted(F.col("id"), n, 5).alias("p")).collect()]
    assert sorted(places) == list(range(n))
    if n > 60:
        other = [r.p for r in spark.range(n).select(permuted(F.col("id"), n, 6).alias("p")).collect()]
        assert places != other and places != list(range(n))
        # Neighbours are torn apart: a random order keeps about two of n next to each other.
        assert sum(abs(a - b) == 1 for a, b in zip(places, places[1:])) < 12


def test_permutation_of_large_positions_stays_in_range(spark):
    n = 10**13 + 7
    rows = spark.range(0, n, n // 500).select(permuted(F.col("id"), n, 1).alias("p")).collect()
    assert len({r.p for r in rows}) == len(rows) and all(0 <= r.p < n for r in rows)


def test_permuted_positions_under_any_partitioning(spark):
    df = spark.range(0, 9000, 3).withColumnRenamed("id", "k")
    one = permuted_positions(df.repartition(7), "k", 2)
    two = permuted_positions(df.coalesce(1), "k", 2)
    rows = {tuple(r) for r in one.collect()}
    assert rows == {tuple(r) for r in two.collect()}
    assert {r[1] for r in rows} == set(range(3000))
    assert permuted_positions(df.limit(0), "k", 2).count() == 0


def _file(folder, name, good, short, bad):
    lines = [json.dumps({"instruction": f"a question of some length {i}", "input": "", "output": f"an answer of some length {i}"}) for i in range(good)]
    lines += [json.dumps({"instruction": "a question of some length", "input": "", "output": "short"})] * short
    lines += ['{"instruction": broken'] * bad
    (folder / name).write_text("\n".join(lines) + "\n")


def test_counted_ingestion_over_restarts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    paths = {k: str(tmp_path / k) for k in ("dst", "rejects", "counts", "checkpoint")}

    def run():
        ingest_counted(spark, PAIR_SPECS["belle"], INSTRUCTION, str(src), **paths, files_per_batch=1).awaitTermination()

    def table(kind):
        return spark.read.parquet(paths[kind])

    _file(src, "a.json", 5, 2, 1)
    _file(src, "b.json", 3, 0, 0)
    run()
    _file(src, "c.json", 0, 1, 4)
    run()
    run()
    got = table("counts").collect()
    files = {r.source_file: tuple(r)[1:4] for r in got if r.source_file}
    assert files == {"a.json": (8, 1, 5), "b.json": (3, 0, 3), "c.json": (5, 4, 0)}
    totals = {r.batch: tuple(r)[1:4] for r in got if r.source_file is None}
    by_batch = {r.batch: tuple(r)[1:4] for r in got if r.source_file}
    assert totals == by_batch and len(totals) == 3
    assert table("dst").count() == 8
    assert {(r.source_file, r["count"]) for r in table("rejects").groupBy("source_file").count().collect()} == {("a.json", 1), ("c.json", 4)}
    assert table("rejects").first().line == '{"instruction": broken'
    # A batch that has to run again replaces its own output.
    last = tmp_path / "checkpoint" / "commits" / "2"
    last.unlink()
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert {tuple(r) for r in table("counts").collect()} == {tuple(r) for r in got}
    assert table("dst").count() == 8
