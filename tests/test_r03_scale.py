"""Steps that must not grow faster than their input."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions.markup import drop_nested, unescape_entities
from textmill.functions.text import SLICE_TEXTS, by_text, map_phrases
from textmill.functions.vectors import letter_vector
from textmill.operators import vocabulary
from textmill.operators.chunking import build_chunks
from textmill.plans.registered import scores, search
from textmill.sources import readers, writers


def test_all_chunkings_move_no_text(spark):
    text = "one two three. four five six. seven eight nine. " * 8
    docs = spark.createDataFrame([(1, text), (2, text), (3, None), (4, "short one"), (None, "short one")], "doc_id long, text string")
    sizes = {"block_sizes": (64, 32), "slide_sizes": (16, 32), "rule_sizes": (16, 32), "stop": "."}
    whole = build_chunks(docs, "doc_id", "text", **sizes)
    digests = build_chunks(docs, "doc_id", "text", **sizes, kept=lambda c: {"n": F.length(c), "digest": F.md5(c)})
    expected = whole.select("doc_id", "method", "pos", F.length("chunk").alias("n"), F.md5("chunk").alias("digest"))
    assert sorted(map(str, digests.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    plan = digests._jdf.queryExecution().optimizedPlan()
    assert "chunk" not in [a.name() for a in _list(plan.children().head().output())]


def _list(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_pieces_are_encoded_in_bounded_slices(spark, monkeypatch):
    monkeypatch.setattr(vocabulary, "SLICE_PIECES", 3)
    lists = pa.array([["ab", "b"], [], None, ["ab", "ab"], ["c"] * 7, ["b"]], pa.list_(pa.string()))
    parts = list(vocabulary._sliced(lists.slice(1)))
    assert [len(p) for p in parts] == [3, 1, 1]
    ids = {"ab": np.array([5, 6], dtype=np.int32), "b": np.array([7], dtype=np.int32), "c": np.array([], dtype=np.int32)}
    got = [row for p in vocabulary._sliced(lists) for row in vocabulary._coded(p, ids.__getitem__).to_pylist()]
    assert got == [[5, 6, 7], [], [], [5, 6, 5, 6], [], [7]]


def test_text_functions_hold_a_slice_of_rows(spark):
    rows = [("a hand and ight",), (None,), ("",)] * 200
    values = pa.array([r[0] for r in rows], pa.string())
    seen = []

    class Spy:
        def __len__(self):
            return len(values)

        def slice(self, at, n):
            seen.append(n)
            return values.slice(at, n)

    run = by_text(str.upper).func
    assert run(Spy()).to_pylist() == [None if r[0] is None else r[0].upper() for r in rows]
    assert max(seen) <= SLICE_TEXTS and len(seen) > 1
    mapped = spark.createDataFrame(rows[:3], "x string").select(map_phrases("x", {"hand": "H", "and": "&"})).collect()
    assert [r[0] for r in mapped] == ["a H & ight", None, ""]


def test_wiki_helpers_keep_null_and_empty(value):
    assert value(unescape_entities("x"), ["a &amp;lt; b", None, ""]) == ["a < b", None, ""]
    assert value(drop_nested("x", "{{", "}}"), ["a{{b{{c}}}}d", None, ""]) == ["ad", None, ""]


def test_array_lines_go_out_in_slices():
    batch = pa.RecordBatch.from_arrays([pa.array([f'{{"a":{i}}}' for i in range(1000)])], names=["value"])
    out = list(writers._array_lines(iter([batch]), 300))
    assert max(b.num_rows for b in out) <= SLICE_TEXTS + 1
    lines = [x for b in out for x in b.column(0).to_pylist()]
    assert len(lines) == 1000 and [i for i, x in enumerate(lines) if x.endswith("]")] == [299, 599, 899, 999]


def test_score_tasks_grow_in_number_with_the_turns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scores, "TASK_TURNS", 10)
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"w{c} x y") for c in range(40) for t in range(4)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    pairs = scores.reply_pairs(spark, str(tmp_path))
    assert pairs.count() == 80
    assert pairs.rdd.getNumPartitions() == 16


def test_letter_vectors_count_once(value):
    got = value(letter_vector("x", "abc"), ["AaBé", None, "", "xyz"])
    assert got == [[2 / 5**0.5, 1 / 5**0.5, 0.0], [None] * 3, [0.0] * 3, [0.0] * 3]


def test_searches_read_a_stored_index(spark, tmp_path):
    docs = [(i, f"word{i % 7} common text number{i}") for i in range(50)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stored = search.stored_index(spark, str(tmp_path))
    assert all("documents.parquet" not in f for f in stored.inputFiles())
    assert sorted(map(str, stored.collect())) == sorted(map(str, search.index(spark, str(tmp_path)).collect()))


def test_any_break_files_are_read_once(spark, tmp_path):
    path = tmp_path / "mixed.txt"
    path.write_bytes(b"a B-x\nb I-x\n\nc O\r\nd B-y\r\n\r\ne O\r")
    found = readers.read_conll(spark, str(path), line_break=None)
    assert not any("mixed.txt" in f for f in found.inputFiles())
    assert sorted(r["chars"] for r in found.collect()) == [["a", "b"], ["c", "d"], ["e"]]


def test_merge_rounds_do_not_depend_on_rare_words(spark, monkeypatch):
    rng = random.Random(3)
    stock = [f"{a}{b}" for a in "bcdfgklm" for b in "aeiou"]
    lines = [" ".join("".join(rng.choices(stock, range(1, 41), k=3)) for _ in range(10)) for _ in range(600)]
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    want = vocabulary.train_bpe(df, "t", min_freq=40).merges
    rounds, confirmed = [], vocabulary.confirmed

    def spy(merges, *rest):
        rounds.append((confirmed(merges, *rest), len(merges)))
        return rounds[-1][0]

    monkeypatch.setattr(vocabulary, "confirmed", spy)
    # Far fewer than there are words.
    monkeypatch.setattr(vocabulary, "GUESS_WORDS", 1500)
    monkeypatch.setattr(vocabulary, "LEAST_TRIED", 16, raising=False)
    assert vocabulary.word_counts(df, "t").count() > 5000
    assert vocabulary.train_bpe(df, "t", min_freq=40).merges == want
    assert len(want) > 100 and all(kept == tried for kept, tried in rounds)


@pytest.mark.parametrize("long_word", [5, 512])
def test_words_are_folded_many_at_once(monkeypatch, long_word):
    monkeypatch.setattr(vocabulary, "LONG_WORD", long_word)
    rng = random.Random(1)
    for _ in range(150):
        letters = rng.choice(["ab", "aab", "abcd", "aé漢"])
        words = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(20)]
        merges, pool = [], list(letters)
        for _ in range(rng.randint(0, 9)):
            merges.append((rng.choice(pool), rng.choice(pool)))
            pool.append("".join(merges[-1]))
        freq, changes, tables = [rng.randint(1, 9) for _ in words], {}, []
        want = [vocabulary.fold(list(w), vocabulary._places(merges), changes, n) for w, n in zip(words, freq)]
        joined = [vocabulary.SEPARATOR.join(w) for w in words]
        batch = pa.RecordBatch.from_arrays([pa.array(freq, pa.int64()), pa.array(joined)], names=["freq", "symbols"])
        got = vocabulary.Merges(merges).fold_batch(batch, tables)
        assert sorted(zip(*got.to_pydict().values())) == sorted(zip(freq, map(vocabulary.SEPARATOR.join, want)))
        found = {}
        for r in (r for t in tables for r in t.to_pylist()):
            found[r["a"], r["b"], r["step"]] = found.get((r["a"], r["b"], r["step"]), 0) + r["n"]
        assert {k: n for k, n in found.items() if n} == {k: n for k, n in changes.items() if n}


def test_guesses_from_all_words_are_those_of_one_by_one_training():
    rng = random.Random(5)
    for _ in range(50):
        words = {"".join(rng.choices("aabcd", k=rng.randint(1, 12))): rng.randint(1, 9) for _ in range(40)}
        held = [(list(w), n) for w, n in words.items()]
        want = []
        while len(want) < 15:
            counts = Counter()
            for w, n in held:
                for pair in zip(w, w[1:]):
                    counts[pair] += n
            best = min(counts, key=lambda p: (-counts[p], p), default=None)
            if best is None or counts[best] < 2:
                break
            want.append(best)
            held = [(vocabulary.fold(w, {best: [0]}), n) for w, n in held]
        exact = Counter()
        for w, n in words.items():
            for pair in zip(w, w[1:]):
                exact[pair] += n
        symbols = pa.array([vocabulary.SEPARATOR.join(w) for w in words])
        assert vocabulary.guess_merges(symbols, np.array(list(words.values())), dict(exact), 15, 2) == want


def test_words_are_cut_between_pairs_that_are_not_live(spark):
    joined = vocabulary.SEPARATOR.join
    words = spark.createDataFrame([(2, joined("abcab")), (3, joined("xab")), (5, "a"), (7, "")], "freq bigint, symbols string")
    found = vocabulary.live_stretches(words, {("a", "b"), ("b", "c")}).collect()
    assert {(r["symbols"], r["freq"]) for r in found} == {(joined("abc"), 2), (joined("ab"), 5)}


def test_tagged_lines_are_matched_in_one_pass(spark, value):
    rng = random.Random(4)
    blocks = ["".join(rng.choices(["a", "B-x", "é", " ", "\t", "\n", "\r\n", "\r", "\xa0", "　", " ", "\x85", "\x1c"], k=rng.randint(0, 40))) for _ in range(400)]
    blocks += ["a O", "a O\r", "　a O\xa0", "a O b\nc O", "\n\na\tO\n", "天 B-x\r\n", "", None]
    blank = "[\t-\r \x85\xa0  -     　]+"
    for block, got in zip(blocks, value(readers.tagged_sentence("x"), blocks)):
        if block is None:
            assert got["chars"] is None and got["labels"] is None
            continue
        fields = [[w for w in re.split(blank, line) if w] for line in block.split("\n")]
        pairs = [f for f in fields if len(f) == 2]
        assert (got["chars"], got["labels"]) == ([p[0] for p in pairs], [p[1] for p in pairs]), block
    plan = spark.createDataFrame([("a O",)], "x string").select(readers.tagged_sentence("x"))._jdf.queryExecution().analyzed().toString()
    assert "lambda" not in plan
