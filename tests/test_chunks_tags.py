"""Chunkers, articles and tagged sentences."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textmill.functions.prompts import entities_by_type, extract_entities, fill_template
from textmill.operators import chunking as C
from textmill.operators.articles import wiki_samples
from textmill.operators.tagging import bio_spans, label_inventory, map_labels, ner_instructions, ner_target


def test_split_long_golden(value):
    rows = ["一二三四五六■七八■九十一二三四", "abcde", "a,b\tcdef", "一二三四五。六七八九十一二。"]
    got = value(C.split_long("x", 10), rows)
    assert got == [["一二三四五六", "九十一二三四"], [], ["abcdef"], ["六七八九十一二"]]


def loop_windows(text, kernel, stop="。"):
    out, held, gone = [], "", 0
    sentences = text.split(stop)
    for s in sentences:
        if len(held) + len(s) > kernel:
            out.append(held + s + stop)
            held = held[len(sentences[gone]) + 1 :]
            gone += 1
        held += s + stop
    return out


def loop_rule(text, most, stop="。"):
    if len(text) < 6:
        return []
    if len(text) < most:
        return [text]
    out, held = [], ""
    for s in text.split(stop):
        if len(held) + len(s) > most:
            out.append(held + s)
            held = s
        else:
            held += s
    return out + ([held] if held else [])


def test_greedy_chunkers_against_loops(value):
    rng = random.Random(4)
    rows = ["。".join("x" * rng.randint(0, 12) for _ in range(rng.randint(1, 30))) for _ in range(40)] + ["", "。", "y" * 50]
    assert value(C.sliding_chunks("x", 20), rows) == [loop_windows(r, 20) for r in rows]
    assert value(C.rule_chunks("x", 20), rows) == [loop_rule(r, 20) for r in rows]
    legacy = value(C.rule_chunks("x", 20, legacy_tail=True), ["aaaa。" * 9 + "zz"])[0]
    assert legacy == loop_rule("aaaa。" * 9 + "zz", 20)[:-1]


def test_text_blocks_and_windows(value):
    assert value(C.text_blocks("x", 5), ["abc\nde\nfgh\nij", "abcd", "abcd\n", ""]) == [["abc\nde\n", "fgh\nij"], [], ["abcd\n"], []]
    got = value(C.split_overlap("x", 4, 1), ["abcdefgh", "abcd", "abc", ""])
    assert got == [["abcd", "defg", "gh"], ["abcd"], ["abc"], []]


def test_page_header_and_blocks(spark):
    def page(*words):
        return ([{"text": t, "size": float(s), "top": float(y)} for t, s, y in words],)

    schema = "words array<struct<text: string, size: double, top: double>>"
    rows = [
        page(("a", 1, 5), ("head", 1, 18), ("目录", 1, 1)),
        page(("目录", 1, 1), ("head", 1, 18)),
        page(("first", 1, 5),),
        page(),
        page(("skip", 1, 1), ("7", 1, 1), ("abcdefgh", 2, 1), ("ijk", 2.000001, 1), ("□", 9, 1), ("small", 3, 1), ("another one here", 3, 1), ("big", 4, 1), ("警告！", 4, 1), ("tail words", 4, 1)),
    ]
    df = spark.createDataFrame(rows, schema)
    assert [r[0] for r in df.select(C.page_header("words")).collect()] == ["head", None, "first", None, "skip"]
    got = [r[0] for r in df.select(C.block_chunks("words", 100)).collect()]
    assert got[1] == [] and got[4] == ["abcdefghijksmallanother one here", "tail words"]


def test_build_chunks_removes_repeats(spark):
    df = spark.createDataFrame([(1, "aaaa bbbb。" * 3), (2, "aaaa bbbb。" * 3)], "id long, t string")
    chunks = C.build_chunks(df, "id", "t")
    assert chunks.select("chunk").distinct().count() == chunks.count()
    assert {r["id"] for r in chunks.collect()} == {1}


def test_articles(spark):
    long_line = "字" * 300
    rows = [
        (1, "标题:\n第一行\n小节：\n第二行"),
        (2, f"标题:\n{long_line}\n{long_line}\n没有"),
        (3, "没有标题\n正文"),
        (4, "末尾:\n正文\n"),
        (5, "\n\n空:"),
    ]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r["id"]: r["response"] for r in wiki_samples(df, "id", "t", templates=["{}?"]).collect()}
    assert got == {1: "第一行\n第二行\n\n", 2: f"{long_line}\n{long_line}\n", 4: "正文\n", 5: "\n"}
    cut = {r["id"]: r["response"] for r in wiki_samples(df, "id", "t", cut=True).collect()}
    assert len(cut[2]) == 512
    sample = wiki_samples(df, "id", "t", templates=["{}?"]).filter("id = 1").first()["sample"]
    assert sample == "标题?第一行\n第二行\n\n<EOS>"


SENTENCE = "活/B-方剂 络/I-方剂 加/O 当/B-中药 归/I-中药 丹/B-中药"


def sentences(spark, *lines):
    rows = [(i, *map(list, zip(*(p.split("/") for p in line.split())))) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "sent_id long, chars array<string>, labels array<string>")


def loop_spans(chars, labels):
    spans, kind = [], None
    for c, label in zip(chars, labels):
        if label == "O":
            kind = None
        elif kind is None or label.startswith("B-") or (label != kind and not label.startswith("I-")):
            kind = label
            spans.append([label[2:], c])
        else:
            spans[-1][1] += c
    return [tuple(s) for s in spans]


def test_spans(spark):
    df = sentences(spark, SENTENCE, "a/I-x b/I-x c/O d/I-y", "a/O", "a/S-x b/I-y c/S-x d/E-x")
    got = [[(s["type"], s["text"]) for s in r[0]] for r in df.select(bio_spans("chars", "labels")).collect()]
    assert got[0] == [("方剂", "活络"), ("中药", "当归"), ("中药", "丹")]
    rows = df.collect()
    assert got == [loop_spans(r["chars"], r["labels"]) for r in rows]
    legacy = df.select(bio_spans("chars", "labels", legacy_prefix=True).alias("s")).first()["s"]
    assert [s["type"] for s in legacy] == ["方剂", "B-中药", "中药"]


def test_spans_on_random_labels(spark):
    rng = random.Random(8)
    names = ["O", "B-a", "I-a", "B-b", "I-b", "S-a", "E-b"]
    lines = [" ".join(f"{rng.choice('xyz')}/{rng.choice(names)}" for _ in range(rng.randint(1, 25))) for _ in range(50)]
    df = sentences(spark, *lines)
    rows = df.select("sent_id", "chars", "labels", bio_spans("chars", "labels").alias("s")).collect()
    for r in rows:
        assert [(s["type"], s["text"]) for s in r["s"]] == loop_spans(r["chars"], r["labels"])


def test_instruction_rows(spark):
    df = sentences(spark, SENTENCE, "a/O b/O")
    rows = {r["sample_id"]: r for r in ner_instructions(df, "dev", templates=["[INPUT_TEXT]|[LIST_LABELS]"]).collect()}
    assert rows["fdev_0"]["input"] == "活络加当归丹|中药，方剂"
    assert rows["fdev_0"]["target"] == "上述句子中的实体包含：\n方剂实体：活络\n中药实体：当归\n中药实体：丹"
    assert rows["fdev_1"]["target"] == "上述句子中的实体包含：\n" and rows["fdev_1"]["answer_choices"] == ["中药", "方剂"]
    table = label_inventory(df)
    assert [(r["label_id"], r["type"]) for r in table.orderBy("label_id").collect()] == [(0, "中药"), (1, "方剂"), (2, "中药"), (3, "方剂"), (4, None)]
    assert map_labels(df, table).orderBy("sent_id").first()["label_ids"] == [1, 3, 4, 0, 2, 0]


def test_extraction(value):
    text = "中药实体：当归\n方剂实体：活络丹x\n未知实体：甲\n中药实体：丹参"
    got = value(extract_entities("x"), [text])[0]
    assert [(e["type"], e["entity"]) for e in got] == [("中药", "当归"), ("方剂", "活络丹"), ("中药", "丹参")]
    assert value(entities_by_type(extract_entities("x")), [text])[0] == {"中药": ["当归", "丹参"], "方剂": ["活络丹"]}
    filled = fill_template(F.lit("[INPUT_TEXT]:[LIST_LABELS]"), "x", F.array(F.lit("a"), F.lit("b")))
    assert value(filled, ["t"]) == ["t:a，b"]
    assert value(ner_target(F.array(F.struct(F.lit("k").alias("type"), F.col("x").alias("text")))), ["t"]) == ["上述句子中的实体包含：\nk实体：t"]


# ---- recursive splitter ----------------------------------------------------
def slow_recursive(text, size, overlap, separators):
    """Strings instead of offsets: pieces are regrouped by counting their lengths."""
    level = 0
    while separators[level] and separators[level] not in text:
        level += 1
    mark, later = separators[level], separators[level + 1 :]
    parts = re.split(f"({re.escape(mark)})", text) if mark else []
    pieces = [parts[0], *(parts[i] + parts[i + 1] for i in range(1, len(parts), 2))] if mark else list(text)
    out, small = [], []

    def pack():
        held = []
        for piece in small:
            if held and sum(map(len, held)) + len(piece) > size:
                out.append("".join(held))
                while held and (sum(map(len, held)) > overlap or sum(map(len, held)) + len(piece) > size):
                    held.pop(0)
            held.append(piece)
        if held:
            out.append("".join(held))
        small.clear()

    for piece in filter(None, pieces):
        if len(piece) < size:
            small.append(piece)
        else:
            pack()
            out += slow_recursive(piece, size, overlap, later) if later else [piece]
    pack()
    return [p for p in (o.strip() for o in out) if p]


@pytest.mark.parametrize(("size", "overlap"), [(1000, 200), (250, 0), (100, 50), (7, 3)])
def test_recursive_chunks_equal_brute_force(value, size, overlap):
    rng = random.Random(size)
    marks = ["\n\n", "\n", " ", " ", " ", "  ", "\n\n\n", ""]
    texts = ["".join("".join(rng.choices("abé", k=rng.randint(0, rng.choice([3, 9, 300])))) + rng.choice(marks) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    texts += [None, "", " ", "\n\n", "x" * 2500, "x" * size, "x" * (size - 1) + " y", "a b " * 700]
    got = value(C.split_recursive("x", size, overlap), texts)
    assert got == [slow_recursive(t, size, overlap, C.SEPARATORS) if t else [] for t in texts]


def test_recursive_chunks_are_short_and_whole(value):
    text = "alpha beta gamma\n\n" * 40 + "word " * 300
    chunks = value(C.split_recursive("x", 100, 0), [text])[0]
    assert max(map(len, chunks)) <= 100 and "".join(chunks).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
    with pytest.raises(ValueError):
        C.split_recursive("x", 10, 10)
