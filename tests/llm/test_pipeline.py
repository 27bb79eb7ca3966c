"""The pipeline's stages on a small corpus with planted rows."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pyarrow as pa

from textmill.llm import decontaminate, simhash_tree
from textmill.session import BATCH_KEY, TEXT_ROWS


def test_stages_remove_what_they_should(spark, tmp_path):
    rng = np.random.default_rng(4)
    words = [a + b for a in ("ka", "lo", "mi", "ser", "tun", "vel") for b in ("ra", "den", "ost", "ing", "mu")]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [[i, text(80), "en", "s", 0] for i in range(60)]
    toxic = {i for i in range(40) if i % 2}
    for i in toxic:
        rows[i][1] += " you grumblor"
    item = text(30)
    rows[50][1] += " " + item
    rows[51][1] = rows[52][1] + " "
    rows.append([70, None, "en", "s", 0])
    docs = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(40)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    gone = toxic | {50, 52}
    assert {r.doc_id for r in got} == {r[0] for r in rows} - gone
    assert len(got) == len({r.doc_id for r in got})
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_one_row_of_each_component_of_fingerprints_stays(spark):
    rng = np.random.default_rng(8)
    texts = [None, "", "  ", "one", "two words"]
    for g in range(40):
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        for edits in (0, 0, 1, 1, 2, 4, 30):
            copy = list(base)
            for at in rng.choice(300, edits, replace=False):
                copy[at] = f"edited{g}"
            texts.append(" ".join(copy))
    texts += [texts[-1] + " ", texts[5].upper()]
    ids = [None, None, *range(len(texts) - 2)]
    rows = [(i, t, k, "mine") for k, (i, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, bits string")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    stay = {r.row for r in left.collect()}
    # Brute force over all pairs of fingerprints.
    prints = [simhash_tree.fingerprint((t or "").encode(), simhash_tree.WIDTH) for t in texts]
    root = list(range(len(texts)))
    order = sorted(root, key=lambda k: (ids[k] is None, ids[k] or 0, k))
    while True:
        before = list(root)
        for a in root:
            for b in range(len(texts)):
                if (int(prints[a]) ^ int(prints[b])).bit_count() <= simhash_tree.RADIUS:
                    root[a] = root[b] = min(root[a], root[b], key=order.index)
        if root == before:
            break
    assert stay == set(root)
    assert 40 < len(stay) < len(texts) - 80
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_leaks_go_by_row_not_by_id(spark, tmp_path):
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(1, f"some words {item} after"), (1, "clean namesake of the row"), (None, f"{item} without an id"), (None, "clean without an id")]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.drop_leaks(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(r.text for r in left) == ["clean namesake of the row", "clean without an id"]


def test_python_gets_few_texts_at_a_time(spark, tmp_path, monkeypatch):
    before = spark.conf.get(BATCH_KEY)
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    spark.createDataFrame([(1, "five six seven")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def stage(spark, docs, sf_dir):
        kept = corpus_pipeline.drop_leaks(spark, docs, sf_dir)
        seen.append(int(spark.conf.get(BATCH_KEY)))
        return kept

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("leaks", stage)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    assert seen == [TEXT_ROWS] and spark.conf.get(BATCH_KEY) == before
    batch = pa.RecordBatch.from_pydict({"t": ["x"] * (2 * decontaminate.ROWS_AT_ONCE + 1)})
    assert [len(b) for b in decontaminate._sliced(iter([batch]))] == [decontaminate.ROWS_AT_ONCE] * 2 + [1]
