"""Hooks, answers, vocabularies, markup, files, streaming and the entry points."""

import random
import sys
from collections import Counter

import pytest
import tokenizers
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textmill.functions import markup as K
from textmill.functions import prompts as P
from textmill.functions.text import strip_cr
from textmill.operators import answers as S
from textmill.operators import conversations as C
from textmill.operators import hooks as H
from textmill.operators import vocabulary as V
from textmill.operators.retrieval import lexical_docs, lexical_retriever
from textmill.plans.registered import models
from textmill.plans.prepare import PAIR_SPECS, SAMPLE_SPECS, corpus_report, prepare, prepare_samples
from textmill.sources import readers as R
from textmill.sources import writers as W
from textmill.streaming.ingest import ingest_stream

# The stand-in models below travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---- hooks and answers -----------------------------------------------------
def upper():
    return lambda texts: [t.upper() for t in texts]


def batch_sizes():
    return lambda texts: [str(len(texts)) for _ in texts]


def test_generation_batches_and_hooks(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id long, prompt string").repartition(1)
    assert {r["generation"] for r in H.generate(df, batch_sizes, batch=4).collect()} == {"4", "2"}
    assert H.build_preference(df.withColumn("chosen", F.lit("c")), upper).first()["rejected"].startswith("T")
    scored = H.score_pairs(df, lambda: lambda a, b: [float(len(x + y)) for x, y in zip(a, b)], "prompt", "prompt")
    assert scored.first()["score"] == 4.0
    graded = H.grade(df, lambda: lambda t: ['{"score": "Yes"}', "broken"] * 5, ["prompt"])
    assert Counter(r["grade"] for r in graded.collect()) == {"yes": 5, None: 5}
    vector = H.embed(df, lambda: lambda t: [[3.0, 4.0]] * len(t), "prompt").first()["embedding"]
    assert vector == [0.6, 0.8]
    assert H.prepare_where(df, lambda r: r["id"] % 2 == 0).count() == 5
    assert H.prepare_where(df, F.col("id") < 3).count() == 3
    joined = H.join_preference(df.limit(1), H.generate(df, upper), "id").first()
    assert joined["rejected"] == joined["prompt"].upper()


def test_refine_folds_in_rank_order(spark):
    rows = [(1, "q", ["a", "b"]), (2, "r", []), (3, "s", None)]
    df = spark.createDataFrame(rows, "id int, question string, documents array<string>")
    fold = lambda: lambda q, d, a: [f"{x}{y}" for x, y in zip(a, d)]
    got = {r["id"]: r["generation"] for r in S.refine(df, fold).collect()}
    assert got == {1: "没有回复ab", 2: "没有回复", 3: "没有回复"}


def test_corrective_loop(spark):
    corpus = spark.createDataFrame([(1, "red house"), (2, "blue tree"), (3, "green bird")], "chunk_id long, text string")
    questions = spark.createDataFrame([(1, "red house"), (2, "xx tree"), (3, "zz zz")], "question_id long, question string")
    find = lexical_retriever(lexical_docs(corpus, "chunk_id", "text"), 1)
    yes_if_same = lambda: lambda q, d: ['{"score": "yes"}' if q.split()[-1] in d else '{"score": "no"}' for q, d in zip(q, d)]
    drop_word = lambda: lambda q: [x.split(" ", 1)[-1] for x in q]
    answer = lambda: lambda q, c: [f"{a}<{b}>" for a, b in zip(q, c)]
    grounded = lambda: lambda q, c, g: ['{"score": "yes"}' if x else '{"score": "no"}' for x in c]
    other = spark.createDataFrame([(9, "zz fallback")], "chunk_id long, text string")
    fallback = (lexical_retriever(lexical_docs(other, "chunk_id", "text"), 1), other)
    out = S.corrective_rag(questions, corpus, find, yes_if_same, drop_word, answer, grounded, 2, fallback)
    got = {r["question_id"]: (r["status"], r["round"], r["documents"]) for r in out.collect()}
    assert got[1] == ("useful", 1, ["red house"]) and got[2] == ("useful", 1, ["blue tree"])
    assert got[3] == ("useful", 2, ["zz fallback"])


def test_decomposed_answers(spark):
    corpus = spark.createDataFrame([(1, "red house"), (2, "blue tree")], "chunk_id long, text string")
    questions = spark.createDataFrame([(1, "red,tree")], "question_id long, question string")
    find = lexical_retriever(lexical_docs(corpus, "chunk_id", "text"), 1)
    split = lambda: lambda t: [x.replace(",", "\n") for x in t]
    echo = lambda: lambda q, c: [f"{a}={b}" for a, b in zip(q, c)]
    got = S.decompose_answer(questions, corpus, find, split, echo, echo).first()["generation"]
    assert got == "red,tree=Question0:red\nAnswer:red=red house\n\nQuestion1:tree\nAnswer:tree=blue tree"


def test_prompt_text(value):
    assert value(P.render_question("x"), [" 问题答： "]) == ["<|im_start|>问：\n问题\n答：\n"]
    assert value(P.render_reply("x"), [" a "]) == ["a\n<|im_end|>"]
    assert value(P.render_chat("x", None, "s"), ["q"]) == ["<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"]
    assert value(P.render_chat("x", fmt="raw"), ["q"]) == ["q"]
    got = value(P.trim_generation("x", ["S"], ["<end>"]), [" aS <end> b", "c"])
    assert [(r["text"], r["end_reason"]) for r in got] == [("a", "Gen '<end>'"), ("c", "Gen length 1")]
    assert value(P.split_queries("x"), ["a\nb"]) == [["a", "b"]]
    assert value(P.format_docs(F.array(F.lit("a"), F.col("x"))), ["b"]) == ["a\n\nb"]
    assert value(P.parse_verdict("x"), ['{"score": "Yes"}', "no json", None]) == ["yes", None, None]
    checked = value(P.validate_verdict("x", ["yes", "no"]), ["yes", "maybe", None])
    assert [(r["value"], r["rejected"]) for r in checked] == [("yes", None), (None, "maybe"), (None, None)]


def test_history_keeps_the_newest(spark):
    rows = [(1, t, "u" * 10, "a" * 10) for t in range(50)] + [(2, 0, "x" * 500, "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, user string, assistant string").repartition(5)
    fitted = C.fit_history(df, F.length("user") + F.length("assistant"), budget=61, least_cost=2)
    assert sorted((r["conv_id"], r["turn"]) for r in fitted.collect()) == [(1, 47), (1, 48), (1, 49)]
    history = C.collect_history(fitted).first()["history"]
    assert len(history) == 3 and history[0]["user"] == "u" * 10


# ---- vocabularies ----------------------------------------------------------
def slow_merges(words, most, least):
    words = {tuple(w): n for w, n in words.items()}
    merges = []
    while len(merges) < most:
        pairs = Counter()
        for w, n in words.items():
            for pair in zip(w, w[1:]):
                pairs[pair] += n
        if not pairs:
            break
        best, n = min(pairs.items(), key=lambda p: (-p[1], p[0]))
        if n < least:
            break
        merges.append(best)
        new = Counter()
        for w, n in words.items():
            out, i = [], 0
            while i < len(w):
                if w[i : i + 2] == best:
                    out.append(best[0] + best[1])
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            new[tuple(out)] += n
        words = new
    return merges


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_equal_one_by_one_training(spark, seed):
    rng = random.Random(seed)
    lines = [" ".join("".join(rng.choices("abcd", [5, 3, 2, 1], k=rng.randint(1, 7))) for _ in range(8)) for _ in range(30)]
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    counted = {r["word"]: r["freq"] for r in V.word_counts(df, "t").collect()}
    got = V.train_bpe(df, "t", min_freq=3, max_merges=25)
    assert got.merges == slow_merges(counted, 25, 3)
    ids = df.select(V.encode("t", got).alias("ids")).first()["ids"]
    assert "".join(got.tokens[i] for i in ids) == "▁" + lines[0].replace(" ", "▁")


def test_registered_merges_go_on_to_the_least_frequency(spark, tmp_path):
    rng = random.Random(6)
    stock = ["".join(rng.choices("abcdef", k=rng.randint(2, 6))) for _ in range(30)]
    lines = [" ".join(rng.choices(stock, k=30)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    counted = {r["word"]: r["freq"] for r in V.word_counts(df, "text").collect()}
    want = slow_merges(counted, V.VOCABULARY_SIZE, V.MIN_FREQUENCY)
    got = models.trained_merges(spark, str(tmp_path)).orderBy("merge_no").collect()
    assert len(want) > 40 and [(r["left"], r["right"]) for r in got] == want
    ranks = {pair: i for i, pair in enumerate(want)}
    for r in models.merged_ids(spark, str(tmp_path)).collect():
        assert r["n"] == sum(len(slow_pieces("▁" + w, ranks)) for w in lines[r["doc_id"]].split())


def slow_pieces(word, ranks):
    parts = list(word)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not found:
            return parts
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_guesses_are_kept_up_to_the_first_wrong_one():
    exact = {("a", "b"): 9, ("c", "d"): 8, ("b", "e"): 7}
    tried = [("a", "b"), ("c", "d"), ("b", "e"), ("ab", "e")]
    changes = {0: [(("a", "b"), -9), (("b", "e"), -2), (("ab", "e"), 6)], 1: [(("c", "d"), -8)], 2: [(("b", "e"), -5)]}
    assert V.confirmed(tried, exact, 0, changes, 1) == 2
    assert V.confirmed([*tried[:2], ("ab", "e")], exact, 0, changes, 1) == 3
    assert V.confirmed([*tried[:2], ("ab", "e")], exact, 6, changes, 1) == 2
    assert V.confirmed(tried, exact, 9, changes, 1) == 1
    assert V.confirmed(tried, exact, 0, changes, 10) == 0


@pytest.mark.parametrize("words_held", [3, 1000])
def test_merges_do_not_depend_on_the_words_guessed_from(spark, monkeypatch, words_held):
    rng = random.Random(9)
    lines = [" ".join("".join(rng.choices("aabc", k=rng.randint(1, 9))) for _ in range(9)) for _ in range(25)]
    df = spark.createDataFrame([(x,) for x in [*lines, "aaaaaaa aaaa aa", None, ""]], "t string")
    counted = {r["word"]: r["freq"] for r in V.word_counts(df, "t").collect()}
    monkeypatch.setattr(V, "GUESS_WORDS", words_held)
    monkeypatch.setattr(V, "TOP_PAIRS", 12)
    assert V.train_bpe(df, "t", min_freq=4, max_merges=20).merges == slow_merges(counted, 20, 4)


def test_changes_of_pair_counts_are_those_of_a_recount():
    rng = random.Random(3)
    for _ in range(300):
        word = rng.choices("aab", k=rng.randint(1, 12))
        merges = [("a", "a"), ("aa", "b"), ("a", "b"), ("b", "a"), ("aa", "a")]
        changes = {}
        got = V.fold(word, V._places(merges), changes, 2)
        counts = Counter(zip(word, word[1:]))
        for (a, b, _), n in changes.items():
            counts[a, b] += n / 2
        assert {p: n for p, n in counts.items() if n} == Counter(zip(got, got[1:])) and "".join(got) == "".join(word)


def test_ids_equal_those_of_the_public_library(spark):
    rng = random.Random(8)
    stock = ["".join(rng.choices("abcdefé", k=rng.randint(2, 7))) for _ in range(40)] + ["ﬁne", "x²", "a,b", "7up"]
    lines = [" ".join(rng.choices(stock, k=20)) for _ in range(60)] + ["a" * 3000, "", "   ", "ab" * 500 + ". 12"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string")
    got = V.train_bpe(df, "t", min_freq=5, normalise=True)
    library = tokenizers.Tokenizer(tokenizers.models.BPE(vocab=got.ids, merges=got.merges, unk_token=V.UNKNOWN))
    for r in df.select("t", V.pretokenize(V.nfkc("t")).alias("words"), V.encode("t", got, normalise=True).alias("ids")).collect():
        assert r["ids"] == [t.id for w in r["words"] for t in library.model.tokenize(w)]


# ---- markup ----------------------------------------------------------------
def test_wiki_markup(value):
    nested = ["{{a{{b}}c}}d", "x{{open", "a{{b {{c}} d", "{{a}} b }} c", "{{a }} {{b {{c }} x {{d"]
    assert value(K.drop_nested("x", "{{", "}}"), nested) == ["d", "x{{open", "a d", " b }} c", " x {{d"]
    links = ["[[A|b]]s", "[[A]]", "[[File:x|y]]", "[[w:x|y]]", "[[File:a|[[b]] c]]", "[http://x label]", "[[Foo|[[Category:x]] y]]"]
    assert value(K.expand_links("x"), links) == ["bs", "A", "", "y", "", "label", ""]
    assert value(K.unescape_entities("x"), ["&amp;nbsp;", "&#65;&#x42;", "&nope;"]) == ["\xa0", "AB", "&nope;"]
    clean = value(
        K.wiki_clean("x"),
        ["'''b''' ''i''", "a<!-- c -->b<br/>c<ref>d</ref>e", "<math>x</math> <math>y</math> <math>x</math>", "a....b  c\n pre\nd", "x __TOC__ <div>y</div>"],
    )
    assert clean == ['b "i"', "abce", "formula_1 formula_2 formula_1", "a...b c\n\nd", "x  y"]


def test_wiki_lines(value):
    page = "intro\n== A ==\n=== B ===\nbody\n* item\n== Empty ==\n== Full? ==\n(x)\n{|\nlast"
    assert value(K.wiki_compact("x"), [page, ""]) == [["intro", "A.", "B.", "body", "Empty.", "Full?", "last"][:4] + ["Full?", "last"], []]
    assert value(K.normalize_title("x"), [" _foo  bar", "help: x y", "w:ABC"]) == ["Foo bar", "Help: x y", "W:ABC"]
    assert value(K.page_url("p", "x"), ["7"]) == ["p?curid=7"]


def test_html(value):
    html = '<p>a<script>x</script><!-- c --><b class="k j">b&amp;<i>c</i></b><br>d</p>'
    assert value(K.html_to_text("x"), [html]) == ["ab&cd"]
    assert value(K.html_to_text("x", ("k",)), [html]) == ["b&c"]


# ---- files -----------------------------------------------------------------
INSTRUCTIONS = [
    ("介绍一下北京的历史和文化吧谢谢", "", "北京是中华人民共和国的首都历史悠久"),
    ("请翻译这句话请翻译这句话请翻译", "", "x" * 20),
    ("abcdefghijklmno", "abcdefghijklmno", "y\r" * 10),
    ("abcdefghijklmno", "!", "z" * 14),
    ("abcdefghijklmno", "!", "z" * 15),
]


def test_prepare_specs(spark):
    df = spark.createDataFrame(INSTRUCTIONS, "instruction string, input string, output string")
    pairs = [tuple(r) for r in prepare(df, PAIR_SPECS["belle"]).collect()]
    assert pairs == [(INSTRUCTIONS[0][0], INSTRUCTIONS[0][2]), ("abcdefghijklmno!", "z" * 15)]
    samples = [r["prompt"] for r in prepare_samples(df, SAMPLE_SPECS["alpaca"]).collect()]
    assert samples[1].endswith("x<EOS>") and len(samples) == 3
    rated = spark.createDataFrame([("t" * 15, "", "c" * 15, s) for s in (4, 5, 6)], "title string, desc string, content string, star int")
    assert prepare(rated, PAIR_SPECS["webtext"]).count() == 2
    report = corpus_report(df.withColumn("s", F.lit("f")), ["s"], "output", F.length(strip_cr("output")) >= 15).first()
    assert (report["rows_read"], report["rows_kept"]) == (5, 3)


def test_json_files(spark, tmp_path):
    flat = tmp_path / "a.jsonl"
    flat.write_text('{"instruction":"i","input":"","output":"o"}\nbroken\n', encoding="utf-8")
    read = R.read_jsonl(spark, str(flat), R.INSTRUCTION)
    assert len(read.collect()) == 2 and R.good_records(read).count() == 1
    (tmp_path / "b.json").write_text('[\n{"instruction":"i","output":"o"},\n{"instruction":"j","output":"p"}]', encoding="utf-8")
    assert R.read_json_array(spark, str(tmp_path / "b.json"), R.INSTRUCTION).count() == 2
    chat = tmp_path / "c.jsonl"
    chat.write_text('{"conversation":[{"human":"h","assistant":"a"},{"human":"x","assistant":"y"}]}\n{"conversation":[]}\n', encoding="utf-8")
    turns = [tuple(r) for r in C.first_turn(R.good_records(R.read_jsonl(spark, str(chat), R.CHAT))).collect()]
    assert turns == [("h", "a"), (None, None)]
    named = R.read_dir(spark, str(tmp_path), "json", R.INSTRUCTION, skip=("b.json", "c.jsonl"))
    assert {r["source_file"].rsplit("/", 1)[-1] for r in named.collect()} == {"a.jsonl"}


def test_text_files(spark, tmp_path):
    conll = tmp_path / "t.txt"
    conll.write_bytes("活 B-x\r\n络 I-x\r\nbad\r\n\r\n加 O\r\n".encode())
    got = sorted((r["chars"], r["labels"]) for r in R.read_conll(spark, str(conll)).collect())
    assert got == sorted([(["活", "络"], ["B-x", "I-x"]), (["加"], ["O"])])
    wiki = tmp_path / "w.txt"
    wiki.write_text("\nA:\nx\n\n\nB:\ny\n", encoding="utf-8")
    assert sorted(r["article"].strip("\n") for r in R.read_articles(spark, str(wiki)).collect()) == ["A:\nx", "B:\ny"]
    pair = spark.createDataFrame([("p", "r")], "prompt string, response string")
    W.write_sep_text(pair, str(tmp_path / "sep"))
    assert R.read_lines(spark, str(tmp_path / "sep")).first()["line"] == "p[SEP]r"
    W.write_parquet(pair, str(tmp_path / "pq"))
    W.write_parquet(pair, str(tmp_path / "pq"))
    assert R.read_parquet(spark, str(tmp_path / "pq"), "prompt").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        W.write_json(pair, str(tmp_path / "pq"))
    first, columns, rows = R.preview(pair)
    assert (first.count(), columns, rows) == (1, ["prompt", "response"], 1)


def test_wiki_dump(spark, tmp_path):
    dump = tmp_path / "d.xml"
    dump.write_text(
        '<mediawiki><page><title>A</title><id>1</id><revision><id>9</id><text xml:space="preserve">body &amp;amp; x</text></revision></page>'
        '<page><title>B</title><id>2</id><redirect title="A"/><revision><id>8</id><text>r</text></revision></page></mediawiki>',
        encoding="utf-8",
    )
    rows = {r["title"]: r for r in R.read_wiki_dump(spark, str(dump)).collect()}
    assert rows["A"]["text"] == "body &amp; x" and rows["A"]["redirect"] is None and rows["B"]["redirect"] == "A"


def test_stream_equals_batch(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = spark.createDataFrame(INSTRUCTIONS, "instruction string, input string, output string")
    W.write_json(df.limit(2), source)
    ingest_stream(spark, PAIR_SPECS["belle"], R.INSTRUCTION, source, target, state).awaitTermination()
    W.write_json(df, source, mode="append")
    ingest_stream(spark, PAIR_SPECS["belle"], R.INSTRUCTION, source, target, state).awaitTermination()
    batch = prepare(R.good_records(R.read_jsonl(spark, source, R.INSTRUCTION)), PAIR_SPECS["belle"])
    assert sorted(map(tuple, R.read_parquet(spark, target).collect())) == sorted(map(tuple, batch.collect()))


# ---- entry points ----------------------------------------------------------
def test_entry_points(spark):
    import __spark_entry__ as entry_points

    queries, twins = entry_points.queries(), entry_points.oracle_sql()
    assert set(twins) <= set(queries) and len(queries) > 80
    flagship = entry_points.entry(spark)
    assert flagship.columns == ["lang", "source", "docs", "chars"] and flagship.count() > 0


def test_headline_plans_have_no_cross_join(spark):
    import __spark_entry__ as entry_points

    queries = entry_points.queries()
    for name in ("clean_dedup_report", "packed_groups", "exact_dedup", "tagged_spans", "fused_hits", "chat_prompts"):
        plan = queries[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_route_keeps_unlisted_and_missing_labels(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "id long, label string")
    branches = {name: lambda d, name=name: d.select("id", F.lit(name).alias("by")) for name in "ab"}
    sent = S.route(rows, "label", branches, lambda d: d.select("id", F.lit("rest").alias("by")))
    assert sorted(map(tuple, sent.collect())) == [(1, "a"), (2, "b"), (3, "rest"), (4, "rest")]
    assert sorted(r.id for r in S.route(rows, "label", branches).collect()) == [1, 2]
