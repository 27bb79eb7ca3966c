"""Retrieval and metrics against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions.vectors import l2_normalise
from textmill.operators import metrics as M
from textmill.operators import quantise as Q
from textmill.operators import retrieval as R
from textmill.plans.registered import search


def vectors(spark, name, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"{name} long, embedding array<float>")


def test_knn_paths_agree_with_brute_force(spark):
    rng = np.random.default_rng(0)
    corpus = [(i, rng.integers(-3, 4, 6)) for i in range(120)] + [(200, np.zeros(6)), (201, np.zeros(6))]
    queries = [(i, rng.integers(-3, 4, 6)) for i in range(9)]
    q, c = vectors(spark, "query_id", queries), vectors(spark, "chunk_id", corpus).repartition(5)
    want = {}
    for qi, v in queries:
        order = sorted((round(float(np.linalg.norm(v - w)), 9), i) for i, w in corpus)[:7]
        want[qi] = [i for _, i in order]
    for limit in (10**6, 10):
        hits = R.knn(q, c, 7, max_values=limit)
        got = {}
        for r in hits.orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["chunk_id"])
        assert got == want
    assert R.knn(q.limit(0), c, 3).count() == 0


WORDS = "red blue green the of and tree house".split()


def texts(spark, seed, n, key):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices(WORDS, [1, 1, 1, 9, 9, 9, 1, 1], k=rng.randint(1, 30)))) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"{key} long, text string")


@pytest.mark.parametrize("limit", [10**6, 1])
def test_lexical_paths_agree_with_brute_force(spark, limit):
    docs, corpus = texts(spark, 1, 60, "chunk_id")
    asked, queries = texts(spark, 2, 6, "query_id")
    tf = {i: Counter(t.split()) for i, t in docs}
    df = Counter(w for c in tf.values() for w in c)
    n, mean = len(docs), sum(sum(c.values()) for c in tf.values()) / len(docs)

    def best(score):
        out = {}
        for q, text in asked:
            ranked = sorted((-round(score(Counter(text.split()), tf[i]), 9), i) for i in tf)
            out[q] = [i for s, i in ranked if s < 0][:4]
        return out

    def bm25(q, d):
        size = sum(d.values())
        return sum(
            k * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * d[w] * 2.5 / (d[w] + 1.5 * (0.25 + 0.75 * size / mean))
            for w, k in q.items()
            if w in d
        )

    def idf(w):
        return math.log((1 + n) / (1 + df[w])) + 1

    def tfidf(q, d):
        norm = lambda c: math.sqrt(sum((k * idf(w)) ** 2 for w, k in c.items()))
        return sum(k * idf(w) * d[w] * idf(w) for w, k in q.items() if w in d) / norm(q) / norm(d)

    def ids(hits):
        out = {}
        for r in hits.orderBy("query_id", "rank").collect():
            out.setdefault(r["query_id"], []).append(r["chunk_id"])
        return out

    index = R.lexical_docs(corpus, "chunk_id", "text")
    assert ids(R.bm25_search(queries, index, 4, max_values=limit)) == best(bm25)
    assert ids(R.tfidf_search(queries, R.tfidf_index(index), 4, max_values=limit)) == best(tfidf)


def test_common_and_rare_terms_meet_alike(spark, monkeypatch):
    _, corpus = texts(spark, 3, 40, "chunk_id")
    index = R.lexical_docs(corpus, "chunk_id", "text")
    plain = {r["chunk_id"]: round(r["norm"], 9) for r in R.tfidf_index(index).collect()}
    monkeypatch.setattr(R, "MAX_BROADCAST_TERMS", 1)
    split = {r["chunk_id"]: round(r["norm"], 9) for r in R.tfidf_index(index).collect()}
    assert plain == split


def test_fusion_and_ranking(spark):
    hits = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 11, 1)], "question_id long, chunk_id long, rank int")
    fused = {r["chunk_id"]: r["score"] for r in R.rrf(hits).collect()}
    assert fused == {10: round(1 / 60, 9), 11: round(1 / 61 + 1 / 60, 9)}
    assert R.multi_query(hits).count() == 2
    scored = spark.createDataFrame([(1, i, float(i % 3)) for i in range(9)], "query_id long, chunk_id long, score double")
    top = R.top_k(scored, 2)
    assert [(r["chunk_id"], r["rank"]) for r in top.orderBy("rank").collect()] == [(2, 1), (5, 2)]
    again = R.rerank(top, -F.col("chunk_id").cast("double"), 1)
    assert again.first()["chunk_id"] == 2
    truth = spark.createDataFrame([(1, 5), (2, 9)], "query_id long, chunk_id long")
    got = M.retrieval_metrics(top, truth, 5).first()
    assert (got["queries"], got["hit_rate"], got["mrr"]) == (2, 0.5, 0.25)


def test_bleu_goldens(spark):
    ref = "there is a pen on my desk a b d d fd".split()
    out = "i have a pen on my desk a b c d f f".split()
    df = spark.createDataFrame([(ref, out), (ref, ["x"]), (["a"] * 9, ["a"] * 5)], "r array<string>, o array<string>")
    got = [r[0] for r in df.select(M.bleu4(F.col("r"), F.col("o"))).collect()]
    assert abs(got[0] - 0.525225) < 1e-6 and got[1] == 0.0 and abs(got[2] - math.exp(1 - 9 / 5)) < 1e-9
    smooth = [r[0] for r in df.select(M.sentence_bleu(F.col("r"), F.col("o"))).collect()]
    assert abs(smooth[0] - math.exp(sum(map(math.log, (8 / 13, 6 / 12, 5 / 11, 4 / 10))) / 4)) < 1e-9 and smooth[1] == 0.0


def test_common_subsequence(spark):
    rng = random.Random(6)
    pairs = [(rng.choices("abc", k=rng.randint(0, 70)), rng.choices("abc", k=rng.randint(0, 70))) for _ in range(25)]

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
        return row[-1]

    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    assert [r[0] for r in df.select(M._common_length("a", "b")).collect()] == [longest(a, b) for a, b in pairs]
    whole = spark.createDataFrame([("abcd", "abcd"), ("abcd", "")], "reference string, output string")
    means = M.text_metrics(whole).first()
    assert means["rouge_l"] == 50.0 and means["bleu_4"] == 50.0


def test_entity_scores(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "a", "c"]), ([], []), (["a"], None)], "g array<string>, p array<string>")
    assert [round(r[0], 6) for r in df.select(M.f1_sets("g", "p")).collect()] == [0.4, 0.0, 0.0]
    items = spark.createDataFrame(
        [({"x": ["a"]}, {"x": ["a"], "y": ["b"]}), ({"x": ["a"]}, {})], "gold map<string,array<string>>, pred map<string,array<string>>"
    )
    assert {r["type"]: r["f1"] for r in M.f1_by_type(items).collect()} == {"x": 0.5, "y": 0.0}


def test_answer_scores(spark):
    gold = spark.createDataFrame([(1, "无答案"), (2, "无答案"), (3, "x"), (4, "x")], "id int, answer string")
    pred = spark.createDataFrame([(1, "y"), (2, "无答案"), (3, "y")], "id int, answer string")
    rows = M.pair_predictions(gold, pred, "id")
    unit = F.array(F.lit(1.0), F.lit(0.0))
    got = {r["id"]: r["s"] for r in rows.select("id", M.semantic_score("gold", "prediction", unit, unit).alias("s")).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 1.0, 4: 0.0}


def test_preference_metrics(spark):
    rows = [(0, 1.0, 0.5, 0.2, 0.4), (0, 0.0, 0.0, 0.0, 0.0), (1, -900.0, 900.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "step int, pc double, pr double, rc double, rr double")
    out = {r["step"]: r for r in M.preference_metrics(df.select("step", M.preference_loss("pc", "pr", "rc", "rr").alias("result"))).collect()}
    assert abs(out[0]["loss"] - (math.log1p(math.exp(-0.14)) + math.log(2)) / 2) < 1e-9
    assert out[0]["reward_accuracies"] == 1 and abs(out[0]["margins"] - 0.14) < 1e-9
    assert abs(out[1]["loss"] - 360.0) < 1e-9
    logs = spark.createDataFrame([([-1.0, -2.0, -3.0], [0, 5, 6]), ([-1.0], [0])], "x array<double>, m array<int>")
    assert [r[0] for r in logs.select(M.masked_mean("x", "m")).collect()] == [-2.5, None]


def test_quantisation(spark):
    df = vectors(spark, "id", [(1, [0.0, 1.0, 2.55])])
    assert np.abs(np.array(Q.quantize_zero_point(df).first()["embedding"]) - [0, 100, 255]).max() <= 1
    back = Q.dequantize_zero_point(Q.quantize_zero_point(df)).first()["embedding"]
    assert np.abs(np.array(back) - [0, 1, 2.55]).max() <= 0.0101
    assert Q.quantize_tensor(df).first()["embedding"] == [0, 50, 127]
    zero = vectors(spark, "id", [(1, [0.0, 0.0])])
    assert zero.select(l2_normalise("embedding")).first()[0] == [0.0, 0.0]


def test_near_distances_keep_their_digits():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(40, 16))
    batch = np.concatenate([vectors, vectors[:10] + 1e-6, vectors[:10] + 1e-4, rng.normal(size=(30, 16))])
    exact = np.sqrt(((batch[:, None, :] - vectors[None, :, :]) ** 2).sum(-1))
    near = R._near(vectors, batch)
    assert (near[np.arange(40), np.arange(40)] == 0).all()
    assert np.abs(near - exact).max() <= 10.0**-R.DIGITS


def test_passages_of_any_length_have_their_truth(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices(["lorem", "ipsum", "dolor", "sit", "amet", "Ut", "enim"], k=60))) for i in range(20)]
    docs += [(90, None), (91, "")]
    items = []
    for n in range(1, 13):
        parts = docs[n][1].split()
        items.append((2 * n, " ".join(parts[5 : 5 + n])))
        # The first and last word are cut.
        items.append((2 * n + 1, " ".join(parts[20 : 21 + n])[1:-1]))
    items += [(50, ""), (51, None), (52, "no such words"), (53, items[0][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted((i, d) for i, a in items for d, t in docs if a is not None and t is not None and a in t)
    assert {2 * n for n in range(1, 10)} <= {i for i, _ in want}
    for block in (search.BLOCK_CHARS, 20):
        monkeypatch.setattr(search, "BLOCK_CHARS", block)
        got = search.passage_truth(spark, str(tmp_path)).collect()
        assert sorted((r["query_id"], r["chunk_id"]) for r in got) == want
