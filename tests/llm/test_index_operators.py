"""Phrases, repeated byte strings and whitening against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from textmill.llm import collocations, repeat_index, whitening


# ---- phrases ---------------------------------------------------------------
def brute_phrases(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    frequent = {key: f for key, f in counts.items() if f >= least}
    held = set()
    for (lang, w), f in frequent.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if f >= frequent[lang, w[i : i + k]]:
                    held.add((lang, w[i : i + k]))
    found = []
    for (lang, w), a in frequent.items():
        if len(w) > 1 and (lang, w) not in held:
            cuts = [(1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((lang, " ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], totals[lang], score))
    out = set()
    for lang in totals:
        mine = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))[:top]
        out |= {(*f, i) for i, f in enumerate(mine, 1)}
    return out


def phrase_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["Der", "hund", "ä", "x y", "the", "cat", "sat", "on"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(["the cat sat on", rng.choice(words), rng.choice(words)]))
            parts.append(rng.choice([" ", "  ", "\t", " ", ". ", ",", "\r\n", "!?"]))
        rows.append((rng.choice(["de", "en", None]), "".join(parts)))
    return [*rows, ("en", None), ("en", ""), (None, " .,; "), ("fr", "the cat sat on")] + [("en", "the cat sat on")] * 3


@pytest.mark.parametrize(("seed", "parts"), [(1, 1), (2, 7)])
def test_phrases_equal_brute_force(spark, seed, parts):
    rows = phrase_rows(seed)
    df = spark.createDataFrame([(i, lang, text, "q", 1) for i, (lang, text) in enumerate(rows)], "shard int, lang string, text string, phrase string, n int")
    got = collocations.best_phrases(df.repartition(parts), least=4, top=15)
    got = {(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"], r["rank"]) for r in got.collect()}
    assert got == brute_phrases(rows, 4, 5, 15)


def test_phrases_that_share_a_hash(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HASH_BITS", 2)
    monkeypatch.setattr(collocations, "PART_WORDS", 500)
    rows = phrase_rows(3)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = {(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"], r["rank"]) for r in collocations.best_phrases(df, least=4, top=15).collect()}
    assert got == brute_phrases(rows, 4, 5, 15)


def test_rare_phrases_are_not_sent_as_texts(spark):
    rows = [("en", f"the cat {i} {i}a. {i}b {i}c") for i in range(300)]
    shards = collocations.first_shards(spark.createDataFrame(rows, "lang string, text string").repartition(3)).localCheckpoint()
    counts = collocations.shard_counts(shards, 2, 5, 32)
    # Less than four bytes for each phrase of a shard.
    sent = counts.selectExpr("sum(length(keys) + length(counts))", "sum(size)").first()
    assert sent[1] == 903 and sent[0] < 4 * sent[1] + 50 * counts.count()
    found = collocations.find_phrases(shards, collocations.hot_keys(counts, 100), 2, 5, 5, 32)
    assert found.selectExpr("explode(phrases) AS p").distinct().collect() == [("the cat",)]
    assert collocations.sum_phrases(found, 100).collect() == [("en", "the cat", 300)]


def test_phrases_of_an_empty_table_and_of_cut_texts(spark, monkeypatch):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.best_phrases(empty).count() == 0
    text = "one two three. " * 50 + "four five " * 40
    parts = _cut(text, 64, monkeypatch)
    assert "".join(p.decode() for p in parts) == text and len(parts) > 3
    assert all(p[:1] == b"." for p in parts[1:])


def _cut(text, held, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_BYTES", held)
    return list(collocations._sliced(text.encode()))


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a", 10**10, 1), ("en", "b", 10**10, 1), ("en", "a b", 9 * 10**9, 2)], "lang string, phrase string, f long, words int")
    totals = spark.createDataFrame([("en", 7 * 10**12 + 1)], "lang string, n long")
    row = collocations.score_phrases(phrases, totals).first()
    assert row["score"] == 1000 * 9 * 10**9 * (7 * 10**12 + 1) // 10**20


# ---- repeats ---------------------------------------------------------------
def brute_kept(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(d) else 0
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(14) for _ in range(3)]
    texts = [prose(rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 9) :] + prose(rng.randint(0, 20)) for _ in range(60)]
    edited = [t[:20] + "#" + t[21:] for t in texts[:15]]
    return [*texts, *edited, texts[0], texts[0], None, "", "a" * 150, "ab" * 90, "a" * 29, shared[0], shared[0] + shared[0]]


def kept_of(spark, texts, **sizes):
    df = spark.createDataFrame([(i, t, i, i) for i, t in enumerate(texts)], "doc_id int, text string, doc int, start int")
    rows = repeat_index.drop_repeats(df, width=30, **sizes).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in rows}
    assert len(rows) == len(texts)
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("seed_bytes", [8, 30])
def test_repeats_equal_brute_force(spark, seed_bytes):
    texts = repeat_texts(3)
    assert kept_of(spark, texts, seed=seed_bytes) == brute_kept(texts, 30)


def test_repeats_of_hot_seeds_small_batches_and_slices(spark, monkeypatch):
    texts = repeat_texts(4)
    monkeypatch.setattr(repeat_index, "HOT_FRAGMENTS", 2)
    monkeypatch.setattr(repeat_index, "PART_WINDOWS", 64)
    assert kept_of(spark, texts, seed=8) == brute_kept(texts, 30)


def test_levels_are_merged_geometrically():
    family = repeat_index.IndexFamily(48)
    windows = np.array([b"%02d" % (i % 40) for i in range(48)])
    for at in range(0, 48, 4):
        family.add(windows[at : at + 4], np.arange(at, at + 4))
        sizes = [len(level.keys) for level in family.levels if level]
        assert len(set(sizes)) == len(sizes) and all(np.log2(s // 4) % 1 == 0 for s in sizes)
    assert list(np.flatnonzero(family.found)) == [*range(8), *range(40, 48)]


def test_long_texts_are_read_in_slices(monkeypatch):
    monkeypatch.setattr(repeat_index, "SLICE", 1 << 9)
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 3000).astype(np.uint8)
    seen = []
    for at in range(0, len(data) - 29, repeat_index.SLICE - 29):
        part = data[at : at + repeat_index.SLICE]
        if len(part) >= 30:
            _, _, begin, count = repeat_index.anchors(part, 30, 8)
            seen += [at + b + k for b, c in zip(begin, count) for k in range(c)]
    assert seen == list(range(len(data) - 29))


def test_repeats_of_an_empty_table(spark):
    assert repeat_index.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- whitening -------------------------------------------------------------
def vector_rows(seed, n=60, d=5):
    rng = np.random.default_rng(seed)
    vectors = [[float(np.float32(v)) for v in row] for row in rng.normal(size=(n, d)) @ rng.normal(size=(d, d))]
    rows = [*enumerate(vectors), (None, vectors[0]), (0, vectors[1])] + [(100 + i, vectors[2]) for i in range(30)]
    return [*rows, (900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (904, [])]


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_whitening_equals_exact_sums(spark, weights):
    rows = vector_rows(5)
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<float>, x int, n int")
    got = whitening.whiten(df, "vec_id", "embedding", weights).collect()
    good = [(k, tuple(int(np.floor(64 * c)) + 1_000_000 for c in v)) for k, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good}) if weights == "one" else [x for _, x in good]
    n, sums = len(fit), [sum(x[j] for x in fit) for j in range(5)]
    centred = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(5)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    assert len(got) == 5 * len(good) and {r["n"] for r in got} == {n}
    keys = Counter(r["vec_id"] for r in got)
    assert keys == Counter({k: 5 * c for k, c in Counter(k for k, _ in good).items()})
    by_key = {(r["vec_id"], r["component"]): r for r in got}
    for k, x in good:
        if Counter(i for i, _ in good)[k] > 1:
            continue
        exact = [n * x[j] - sums[j] for j in range(5)]
        for i, o in enumerate(order):
            row = by_key[k, i + 1]
            assert row["deviation"] == sum(e * e for e in exact)
            want = float(np.array([float(Fraction(e, n)) for e in exact]) @ vectors[:, o] / np.sqrt(values[o]))
            assert abs(abs(row["whitened"]) - abs(want)) < 1e-8
            assert row["explained"] == pytest.approx(values[o] / values.sum(), rel=1e-9)
            assert row["identity_error"] < 1e-9


def test_whitening_of_flat_vectors_other_lengths_and_nothing(spark):
    rows = [(i, [float(i), 2.0]) for i in range(4)] + [(10, [1.0, 2.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    flat = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    assert flat[0, 2] is None and flat[0, 1] is not None and flat[10, 1] is None
    assert {r["n"] for r in got if r["vec_id"] < 10} == {4} and {r["n"] for r in got if r["vec_id"] == 10} == {1}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty, "vec_id", "embedding").count() == 0


def test_exact_differences_of_huge_entries():
    x = np.array([[1 << 55, -(1 << 55)], [3, 4]])
    got = whitening.centred(x, 2, (int(x[:, 0].sum()), int(x[:, 1].sum())))
    assert got.tolist() == [[(1 << 55) - 3, -(1 << 55) - 4], [3 - (1 << 55), 4 + (1 << 55)]]
