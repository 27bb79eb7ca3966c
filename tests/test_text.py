import random

from pyspark.sql import functions as F

from textmill.functions import text as X
from textmill.functions.tokens import multiset_overlap, ngrams, pretokenize, term_counts, words


def test_collapse_goldens(value):
    rows = ["你好，。世 界！！", "class", "", "。", "a\r\nb", "𠀀，，𠀀", "[]\\^-&~x"]
    assert value(X.collapse_punct("x"), rows) == ["你好，世，界！", "clas", "", "。", "a\r\nb", "𠀀，𠀀", "[x"]
    assert value(X.collapse_punct("x", variant="t5_sft"), ["你好，世界", "ab"]) == ["你好，界", "ab"]
    assert value(X.collapse_punct(X.to_zh_punct("x")), ["标题:\n", "a,(b)"]) == ["标题：", "a，b）"]


def test_collapse_is_idempotent_and_matches_a_loop(value):
    rng = random.Random(3)
    rows = ["".join(rng.choice("ab s,。！ 　\n\\") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    once = value(X.collapse_punct("x"), rows)
    assert value(X.collapse_punct("x"), once) == once
    for raw, got in zip(rows, once):
        kept = []
        for c in raw.replace(" ", "，").replace("　", "，"):
            if not (kept and kept[-1] in X.PUNCTUATION and c in X.PUNCTUATION):
                kept.append(c)
        assert got == "".join(kept)


def test_marks_and_lines(value):
    assert value(X.fix_wiki_marks("x"), ["「a」『b』", "x，）y；）", "（，z(，"]) == ['"a""b"', "x）y）", "（z（"]
    assert value(X.normalise_line("x", {"體": "体"}), ["體 a,b"]) == ["体，a，b"]
    assert value(X.map_phrases("x", {"頭髮": "头发", "髮": "发"}), ["頭髮髮", None]) == ["头发发", None]
    assert value(X.clean_chunk("x"), ["a,b\nc\td"]) == ["abcd"]
    assert value(X.to_document("x"), ["  a\tb \n", "c"]) == ["a", "c"]
    assert value(X.unescape_newline("x"), ["a\\nb"]) == ["a\nb"]
    assert value(X.strip("x"), ["　 a b\t\n"]) == ["a b"]


def test_dice_and_prompts(spark):
    rows = [("abc", "abd", 2 / 3), ("", "", 0.0), ("aab", "ab", 1.0), ("", "a", 0.0), ("𠀀", "𠀀", 1.0)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    got = df.select(X.dice_chars("a", "b").alias("s"), X.dice_chars("b", "a").alias("t"), "want").collect()
    for r in got:
        assert abs(r["s"] - r["want"]) < 1e-12 and r["s"] == r["t"]
    prompt = spark.createDataFrame([("ab", "ba"), ("ab", "xyz"), ("ab", None)], "t string, d string")
    assert [r[0] for r in prompt.select(X.compose_prompt("t", "d", " ")).collect()] == ["ab", "ab xyz", "ab "]
    optional = spark.createDataFrame([("i", "  "), ("i", ""), ("i", "x")], "t string, d string")
    assert [r[0] for r in optional.select(X.compose_optional("t", "d", ",", True)).collect()] == ["i", "i", "i,x"]
    assert [r[0] for r in optional.select(X.compose_optional("t", "d")).collect()] == ["i  ", "i", "ix"]


def test_ends_and_templates(value):
    assert value(X.clip_then_end("x", 8), ["abcdefgh", "ab"]) == ["abc[EOS]", "ab[EOS]"]
    assert value(X.add_end("x"), ["a", None]) == ["a<EOS>", "<EOS>"]
    picks = value(X.pick_template("x", ["p", "q", "r"]), ["k1", "k2", "k1"])
    assert picks[0] == picks[2] and set(picks) <= {"p", "q", "r"}


def test_tokens(value):
    assert value(words("x"), ["Ab c_1-é", ""]) == [["ab", "c_1", "é"], []]
    counts = value(term_counts(F.split("x", " ")), ["b a b", "a"])
    assert [[(r["term"], r["tf"]) for r in row] for row in counts] == [[("a", 1), ("b", 2)], [("a", 1)]]
    assert value(term_counts(F.filter(F.split("x", " "), lambda t: t != "")), [""]) == [[]]
    assert value(ngrams(F.split("x", " "), 2), ["a b c", "a"]) == [["a b", "b c"], []]
    both = value(multiset_overlap(F.split("x", " "), F.array(*map(F.lit, "aab"))), ["a a a c", "b b", "x"])
    assert both == [2, 1, 0]


def test_pretokenize_matches_the_public_library(value):
    import tokenizers
    from tokenizers.pre_tokenizers import Digits, Metaspace, Punctuation, Sequence

    cutter = Sequence([Punctuation(), Digits(individual_digits=True), Metaspace()])
    assert tokenizers
    rows = ["Hello, world 12!", " lead  two", "a$b+c", "你好，世界3", "", "tab\tx\ny", "½x²"]
    want = [[p for p, _ in cutter.pre_tokenize_str(r)] for r in rows]
    assert value(pretokenize("x"), rows) == want
