"""Filters, de-duplication, ordering, packing and array helpers."""

import datetime
import random

from pyspark.sql import functions as F

from textmill.functions import arrays as A
from textmill.operators import filters as P
from textmill.operators.dedup import dedup_exact, exclude_sources, merge_datasets
from textmill.operators.ordering import prefix_sum, row_numbers, shuffled_positions, split_rows
from textmill.operators.packing import pack, pack_groups


def test_task_filters(spark):
    rows = [("请翻译", "x"), ("Translate it", "x"), ("表格", "x"), ("ok", "a-----b"), ("ok", "translate"), ("ok", "fine")]
    df = spark.createDataFrame(rows, "t string, r string")
    assert P.drop_tasks(df, "t", "r").count() == 2
    kept = [tuple(r) for r in P.drop_tasks(df, "t", "r", "t5_sft").collect()]
    assert kept == [("Translate it", "x"), ("ok", "fine")]


def test_length_and_pair_filters(spark):
    df = spark.createDataFrame([("p", "a" * 256, "b"), ("p", "a" * 257, "b"), ("p", " b", "b "), ("", "a", "b")], "prompt string, chosen string, rejected string")
    ok = P.valid_pairs(P.max_len(df, prompt=256, chosen=256, rejected=256))
    assert [r["chosen"] for r in ok.collect()] == ["a" * 256]
    pair = spark.createDataFrame([("p" * 3, "r" * 600), ("p" * 3, "r" * 5)], "prompt string, response string")
    assert [(len(r[0]), len(r[1])) for r in P.truncate_pair(pair).collect()] == [(3, 512), (3, 5)]
    assert P.min_len(pair, prompt=3, response=6).count() == 1
    raw = spark.createDataFrame([(1, "p", "c", "r")], "id int, prompt string, chosen string, reject string")
    assert P.to_preference(raw, rejected="reject").columns == ["prompt", "chosen", "rejected"]


def test_page_filters(spark):
    rows = [("A/fr/x", None), ("w:b", None), ("Help:c", None), ("d", "y")]
    df = spark.createDataFrame(rows, "title string, redirect string")
    assert [r["title"] for r in P.article_pages(df).collect()] == ["A/fr/x", "w:b"]
    assert [r["title"] for r in P.incubator_pages(df, "fr").collect()] == ["x"]
    titles = spark.createDataFrame([("w:b", "t1"), ("w:b", "t1")], "title string, tags string")
    assert [tuple(r) for r in P.restrict_titles(df, titles).select("title", "tags").collect()] == [("w:b", "t1")]


def test_metadata_bounds(spark):
    day = datetime.date(2024, 1, 1)
    df = spark.createDataFrame([(1, day), (2, day), (3, datetime.date(2024, 1, 2))], "view_count int, publish_date date").withColumn("length_sec", F.lit(5))
    assert P.metadata_filter(df, P.SearchSpec()).count() == 3
    assert P.metadata_filter(df, P.SearchSpec(min_view_count=2, max_view_count=3)).count() == 1
    assert P.metadata_filter(df, P.SearchSpec(latest_publish_date=datetime.date(2024, 1, 2))).count() == 2


def test_noise_and_relevance(value, spark):
    page = "目录 1\n 12 \n" + "." * 20 + "x\n a b \n\nend"
    assert value(P.page_text("x"), [page]) == ["a bend"]
    graded = spark.createDataFrame([("Yes ",), ("no",)], "grade string")
    assert P.keep_relevant(graded).count() == 1


def test_dedup_first_wins_under_skew(spark):
    rows = [(i, "hot" if i % 3 else f"t{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, t string").repartition(7)
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    once = dedup_exact(df, "t", "id")
    assert sorted((r["t"], r["id"]) for r in once.collect()) == sorted(first.items())
    assert dedup_exact(once, "t", "id").count() == len(first)
    plan = once._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    merged = merge_datasets(a=df.limit(2), b=df.limit(1))
    assert {r["source"]: r["count"] for r in merged.groupBy("source").count().collect()} == {"a": 2, "b": 1}
    files = spark.createDataFrame([("/x/a.json",), ("/x/b.json",)], "source_file string")
    assert exclude_sources(files, "a.json").count() == 1


def test_running_sums(spark):
    rng = random.Random(5)
    keys = sorted(rng.sample(range(5000), 400))
    values = [rng.randint(0, 9) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, values)), "k long, v long").repartition(5)
    want, total = {}, 0
    for k, v in zip(keys, values):
        want[k] = total
        total += v
    for bucket in (7, 64, 10_000):
        got = {r["k"]: r["start"] for r in prefix_sum(df, "k", "v", bucket=bucket).collect()}
        assert got == want
    numbers = {r["k"]: r["row_no"] for r in row_numbers(df, "k", bucket=16).collect()}
    assert numbers == {k: i for i, k in enumerate(keys)}
    far = spark.createDataFrame([(2**62 + i, 1) for i in range(9)], "k long, v long")
    assert sorted(r["start"] for r in prefix_sum(far, "k", "v", bucket=4).drop("x").collect()) == list(range(9))
    negative = spark.createDataFrame([(-3, 1), (2, 1), (5, 1)], "k long, v long")
    assert sorted(r["start"] for r in prefix_sum(negative, "k", "v", bucket=4).collect()) == [0, 1, 2]


def test_splits_are_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    one = {r["k"]: r["split"] for r in split_rows(df, "k").collect()}
    two = {r["k"]: r["split"] for r in split_rows(df.repartition(9), "k").collect()}
    assert one == two and 0.06 < sum(v == "test" for v in one.values()) / 2000 < 0.14
    places = shuffled_positions(df, "k", seed=1, buckets=16).collect()
    assert sorted(r["place"] for r in places) == list(range(2000))


def test_pack_against_a_loop(spark):
    rng = random.Random(1)
    for block, bucket, partitions in ((4, 3, 1), (5, 100, 4), (8, 2, 37)):
        rows = [(i, [rng.randint(1, 99) for _ in range(rng.choice([0, 1, 3, 30]))]) for i in range(40)]
        flat = [x for _, ids in rows for x in ids]
        df = spark.createDataFrame(rows, "k long, input_ids array<int>").repartition(partitions)
        kept = sorted((r["block_id"], r["input_ids"]) for r in pack(df, "k", block=block, tail="keep", bucket=bucket).collect())
        assert kept == [(i // block, flat[i : i + block]) for i in range(0, len(flat), block)]
        full = pack(df, "k", block=block, bucket=bucket).count()
        assert full == len(flat) // block


def test_pack_groups_against_a_loop(spark):
    rng = random.Random(2)
    block, group, end = 4, 3, 0
    rows = [(i * 10, [rng.randint(1, 9) for _ in range(n)]) for i, n in enumerate([2, 1, 1, 0, 1, 1, 5, 6, 1, 0, 0, 0])]
    df = spark.createDataFrame([(k, ids, [-x for x in ids]) for k, ids in rows], "k long, input_ids array<int>, labels array<int>")
    want = []
    for g in range(0, len(rows), group):
        flat = [x for _, ids in rows[g : g + group] for x in ids]
        size = (len(flat) // block + 1) * block if len(flat) >= block else len(flat)
        ids = flat + [end] * (size - len(flat))
        labels = [-x for x in flat] + [A.IGNORED_LABEL] * (size - len(flat))
        want += [(g // group, i // block, ids[i : i + block], labels[i : i + block]) for i in range(0, size, block)]
    got = sorted(tuple(r) for r in pack_groups(df, "k", end, block=block, group=group).select("group_id", "block_id", "input_ids", "labels").collect())
    assert got == want


def test_array_helpers(spark):
    df = spark.createDataFrame([([1, 0, 2, 3, 0],), ([0, 0, 5],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(A.position_ids("ids", 0)).collect()] == [[0, 1, 0, 1, 2], [0, 0, 0], []]
    assert [r[0] for r in df.select(A.loss_mask("ids", 0)).collect()][0] == [1, 0, 1, 1, 0]
    assert [r[0] for r in df.select(A.pad_truncate("ids", 4, 9)).collect()] == [[1, 0, 2, 3], [0, 0, 5, 9], [9] * 4]
    assert [r[0] for r in df.select(A.clip_ids("ids", 2, 7)).collect()] == [[1, 0, 7], [0, 0, 7], [7]]
    shifted = df.select(A.shift_labels("ids").alias("s")).collect()
    assert shifted[0]["s"]["inputs"] == [1, 0, 2, 3] and shifted[0]["s"]["labels"] == [0, 2, 3, 0] and shifted[2]["s"]["inputs"] == []
    labels = spark.createDataFrame([([-100, 4, 5],)], "l array<int>")
    assert labels.select(A.shift_right("l", 1, 0)).first()[0] == [1, 0, 4]
    assert df.select(A.mask_prompt("ids", F.lit(2))).first()[0] == [-100, -100, 2, 3, 0]
    masks = spark.createDataFrame([([0, 1, 1], [7, 8, 9])], "t array<int>, x array<int>")
    assert masks.select(A.answer_mask("t", "x")).first()[0] == [0, 8, 9]
