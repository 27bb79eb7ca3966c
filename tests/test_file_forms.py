"""Tagged files with any line break, and arrays of objects as a sink."""

from __future__ import annotations

import json
import random

import pytest

from pyspark.sql import functions as F

from textmill.operators.hooks import prepare_where
from textmill.plans.prepare import PAIR_SPECS, prepare
from textmill.sources.readers import CORRUPT, read_conll, read_json_array, read_sep_text
from textmill.sources.writers import write_json_array, write_sep_text

BREAKS = {"lf": ["\n"], "crlf": ["\r\n"], "mixed": ["\n", "\r\n", "\r"]}


def _sentences(rng: random.Random, n: int) -> list[list[tuple[str, str]]]:
    return [[(rng.choice("abcdé中"), rng.choice(["O", "B-X", "I-X"])) for _ in range(rng.randint(1, 9))] for _ in range(n)]


def _write(path, sentences, rng, breaks):
    lines = []
    for s in sentences:
        lines += [f"{c} {t}" for c, t in s] + [""] * rng.choice([1, 1, 2, 3])
    whole = "".join(line + rng.choice(breaks) for line in lines)
    # A CR before a LF of the next, empty line would read as one break.
    path.write_bytes(whole.encode() if len(breaks) < 3 else _safe(lines, rng))


def _safe(lines, rng):
    out, last = "", ""
    for line in lines:
        choice = rng.choice(BREAKS["mixed"])
        if not line and last == "\r" and choice == "\n":
            choice = "\r\n" if rng.random() < 0.5 else "\r"
            out, choice = (out[:-1] + "\n", choice)
        out, last = out + line + choice, choice
    return out.encode()


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("form", list(BREAKS))
def test_conll_any_break_over_splits(spark, tmp_path, small_splits, form):
    rng = random.Random(form)
    want = []
    for name in ("one", "two"):
        sentences = _sentences(rng, 25)
        _write(tmp_path / f"{name}.txt", sentences, rng, BREAKS[form])
        want += [(f"{name}.txt", tuple(c for c, _ in s), tuple(t for _, t in s)) for s in sentences]
    df = read_conll(spark, str(tmp_path), line_break=None)
    got = [(r.source_file.rsplit("/", 1)[1], tuple(r.chars), tuple(r.labels)) for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_conll_without_last_break_and_sentence_longer_than_splits(spark, tmp_path, small_splits):
    (tmp_path / "a.txt").write_text("\n\n" + "\n".join(f"x L{i}" for i in range(60)) + "\n\ny O")
    (tmp_path / "b.txt").write_text("")
    (tmp_path / "c.txt").write_text("\n\n\n")
    got = sorted((tuple(r.chars), tuple(r.labels)) for r in read_conll(spark, str(tmp_path), line_break=None).collect())
    assert got == [(("x",) * 60, tuple(f"L{i}" for i in range(60))), (("y",), ("O",))]


def test_json_array_files_are_whole_arrays(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else f"line\n\"{i}\" é") for i in range(23)]
    df = spark.createDataFrame(rows, "k long, value string").repartition(3)
    out = tmp_path / "arrays"
    write_json_array(df, str(out), rows_per_file=4)
    sizes = [len(json.loads(p.read_text(encoding="utf-8"))) for p in out.glob("part-*")]
    assert sum(sizes) == 23 and max(sizes) == 4
    back = read_json_array(spark, str(out), "k long, value string")
    assert sorted((r.k, r.value) for r in back.collect()) == rows


@pytest.mark.parametrize("size", [1, 2, 8, 100])
def test_json_array_sizes_that_divide_or_not(spark, tmp_path, size):
    out = tmp_path / "arrays"
    write_json_array(spark.range(8).coalesce(1), str(out), rows_per_file=size, keep_nulls=True)
    files = [json.loads(p.read_text()) for p in sorted(out.glob("part-*"))]
    assert [o["id"] for f in files for o in f] == list(range(8))
    assert [len(f) for f in files] == [min(size, 8)] * max(8 // size, 1)


def test_empty_table_is_an_empty_array(spark, tmp_path):
    out = tmp_path / "arrays"
    write_json_array(spark.range(4).filter("id > 9").coalesce(1), str(out))
    assert read_json_array(spark, str(out), "id long").count() == 0


def test_unreadable_array_is_named(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"id": 1}, {"id": 2}]')
    (tmp_path / "bad.json").write_text('[{"id": 3}, {"id"')
    rows = read_json_array(spark, str(tmp_path), "id long", with_corrupt=True).collect()
    bad = {r.source_file.rsplit("/", 1)[1] for r in rows if r[CORRUPT] is not None}
    assert bad == {"bad.json"}
    assert sorted(r.id for r in rows if r.source_file.endswith("good.json")) == [1, 2]


def test_escaped_separator_lines_round_trip(spark, tmp_path):
    rng = random.Random(5)
    pieces = ["\n", "\r", "\\", "n", "r", "s", "[SEP]", "[SEP", "]", " ", "é", ""]
    rows = [tuple("".join(rng.choices(pieces, k=rng.randint(0, 8))) for _ in range(2)) for _ in range(400)]
    out = str(tmp_path / "sep")
    write_sep_text(spark.createDataFrame([*rows, (None, "x")], "prompt string, response string"), out, escape=True)
    got = [(r.prompt, r.response) for r in read_sep_text(spark, out).collect()]
    assert sorted(got) == sorted([*rows, ("", "x")])


@pytest.mark.parametrize("sep", ["", "nx", "aba", "\\t", "a\nb"])
def test_separators_that_escapes_could_form_are_refused(spark, tmp_path, sep):
    df = spark.createDataFrame([("a", "b")], "prompt string, response string")
    with pytest.raises(ValueError):
        write_sep_text(df, str(tmp_path / "sep"), sep=sep, escape=True)


def test_own_test_of_rows_reaches_prepare(spark):
    rows = [(f"a question of some length {i}", "", f"an answer of some length {i}", i) for i in range(12)]
    df = spark.createDataFrame(rows, "instruction string, input string, output string, star int")
    by_column = prepare(df, PAIR_SPECS["belle"], ("star",), where=F.col("star") > 6)
    by_batch = prepare(df, PAIR_SPECS["belle"], ("star",), where=lambda frame: frame["star"] > 6)
    want = sorted(map(tuple, by_column.collect()))
    assert len(want) == 5 and sorted(map(tuple, by_batch.collect())) == want


def test_a_missing_answer_drops_the_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string")
    kept = prepare_where(df, lambda f: f["x"].astype("string") == "a")
    assert [r.id for r in kept.collect()] == [1]
