"""Each operator against a brute-force version on small fixtures with odd rows."""

from __future__ import annotations

import collections
import hashlib
import re
import struct
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

from textmill.llm import (
    byte_bpe,
    decontaminate,
    exact_names,
    flat,
    language_id,
    licenses,
    line_dedup,
    sharding,
    simhash_tree,
    token_counts,
    toxicity,
)

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

ODD = [
    (1, "The quick brown fox jumps over the lazy dog today"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (5, "The quick brown fox jumps over the lazy dog today"),
    (None, "The  quick brown fox jumps over the lazy dog today "),
    (7, "żółw 中文 😀 naïve it's we'll 12345"),
    (8, "a" * 3000),
    (8, "a" * 3000),
    (9, " " * 700 + "x"),
    (10, "ababababa abababa aaaa bababab"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def coder():
    ranks = {p: i for i, p in enumerate(byte_bpe.load_pieces(RANKS))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_the_librarys(spark, odd, none, coder):
    rng = np.random.default_rng(3)
    letters = list("abcdeéñ中 \n'1.😀")
    rows = ODD + [(100 + i, "".join(rng.choice(letters, 60))) for i in range(60)]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], SCHEMA + ", n_tokens double")
    got = collections.Counter(
        (r.doc_id, tuple(struct.unpack(f"<{r.n_tokens}I", r.token_ids)), bytes(r.decoded))
        for r in byte_bpe.encode(df, RANKS, PATTERN, decoded=True).collect()
    )
    assert got == collections.Counter((i, tuple(coder.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    back = byte_bpe.decode(byte_bpe.encode(odd, RANKS, PATTERN), RANKS)
    assert collections.Counter(bytes(r.decoded).decode() for r in back.collect()) == collections.Counter(t or "" for _, t in ODD)
    assert byte_bpe.encode(none, RANKS, PATTERN).count() == 0


def test_word_table_starts_anew(spark, coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "TABLE_WORDS", 7)
    monkeypatch.setattr(byte_bpe, "SLICE_WORDS", 5)
    rows = [(i, f"word{i} other{i % 3} same thing") for i in range(40)]
    for r in byte_bpe.encode(spark.createDataFrame(rows, SCHEMA).coalesce(1), RANKS, PATTERN).collect():
        assert list(struct.unpack(f"<{r.n_tokens}I", r.token_ids)) == coder.encode_ordinary(dict(rows)[r.doc_id])


@pytest.mark.parametrize("docs, words", [(10**6, 10**6), (10**6, 2), (10**6, 0), (1, 10**6)])
def test_common_words_change_nothing(spark, coder, monkeypatch, docs, words):
    monkeypatch.setattr(byte_bpe, "COMMON_DOCS", docs)
    monkeypatch.setattr(byte_bpe, "COMMON_WORDS", words)
    rows = [(i, f"Zwirblung quorfled Zwirblung x{i} Zwirblung quorfled {'na' * 300} unzusammen") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in byte_bpe.encode(df, RANKS, PATTERN).collect():
        assert np.frombuffer(r.token_ids, dtype="<u4").tolist() == coder.encode_ordinary(rows[r.doc_id][1])


def test_known_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(byte_bpe, "word_hashes", lambda words: np.array([len(w) for w in words.to_pylist()], dtype=np.uint64))
    known = byte_bpe.KnownWords(pa.array([b"ab", b"c", b"cd", b"ef", b"", b"x" * 900], pa.binary()))
    asked = pa.array([b"ef", b"ab", b"gh", b"", b"x" * 900, b"y" * 900, b"z" * 901, b"c", b"cd"], pa.binary())
    assert known.numbers(asked).tolist() == [3, 0, -1, 4, 5, -1, -1, 1, 2]
    assert byte_bpe.KnownWords(pa.array([], pa.binary())).numbers(asked).tolist() == [-1] * 9


def test_word_hashes_depend_on_the_bytes_alone():
    words = [b"", b"a", b"ab", b"ba", b"\x00", b"\x00\x00", b"x" * 64, b"x" * 65, "\u00e4".encode() * 900]
    whole = flat.word_hashes(pa.array(words, pa.binary()))
    assert len(set(whole.tolist())) == len(words)
    assert flat.word_hashes(pa.array([b"q", *words], pa.large_binary()).slice(1)).tolist() == whole.tolist()
    assert [int(flat.word_hashes(pa.array([w], pa.binary()))[0]) for w in words] == whole.tolist()


def test_length_histogram(odd, none, coder):
    lengths = sorted(len(coder.encode_ordinary(t or "")) for _, t in ODD)
    bars = token_counts.histogram(token_counts.lengths(odd, RANKS, PATTERN)).collect()
    assert [r.length for r in sorted(bars, key=lambda r: r.length)] == sorted(set(lengths))
    for r in bars:
        assert r.documents_from == sum(x >= r.length for x in lengths)
        assert r.tokens_from == sum(x for x in lengths if x >= r.length)
        assert r.truncated_tokens == sum(min(x, r.length) for x in lengths)
        assert r["rank"] == pytest.approx(sum(x <= r.length for x in lengths) / len(lengths))
    assert token_counts.histogram(token_counts.lengths(none, RANKS, PATTERN)).count() == 0


def test_totals_at_any_limit(spark):
    lengths = [0, 3, 3, 2000, 5000]
    bars = token_counts.histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens long"))
    limits = spark.createDataFrame([(x,) for x in (0, 1, 3, 1024, 4999, 9000)], "context_limit long")
    for r in token_counts.at_limits(bars, limits).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in lengths)
    assert token_counts.quantile(bars, 0.6).first().length == 3


def _shape(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


@pytest.mark.parametrize("block", [4, 64, 4096])
def test_exact_groups(odd, block):
    got = exact_names.exact_groups(odd, block=block).collect()
    groups = collections.defaultdict(list)
    for i, t in ODD:
        groups[_shape(t)].append((-len(t or ""), i is None, i))
    want = collections.Counter()
    for shape, rows in groups.items():
        best, digest, left = min(rows), hashlib.sha256(shape.encode()).hexdigest(), True
        for row in rows:
            kept = row == best and left
            left = left and not kept
            want[row[2], best[2], len(rows), kept, digest] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_exact_copies_go(odd, none):
    left = exact_names.drop_exact(odd.selectExpr("*", "1 AS identity")).collect()
    assert sorted(_shape(r.text) for r in left) == sorted({_shape(t) for _, t in ODD})
    assert exact_names.drop_exact(none).count() == 0


def _fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = max(1, len(words) - width + 1) if words else 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[j : j + width]).encode(), 42) for j in range(n)]
    return sum((2 * sum(h >> b & 1 for h in hashes) > n) << b for b in range(64))


def test_fingerprints(odd, none):
    for r in simhash_tree.fingerprints(odd).collect():
        assert r.bits % (1 << 64) in {_fingerprint(t) for i, t in ODD if i == r.doc_id}
    assert simhash_tree.near_groups(none).count() == 0


@pytest.mark.parametrize("shard_rows", [16, 4096])
def test_near_links_join_what_brute_force_joins(spark, shard_rows):
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    near = {base ^ sum(1 << int(b) * 5 for b in rng.choice(12, rng.integers(0, 6), replace=False)) for _ in range(300)}
    values = sorted(near | {int(x) for x in rng.integers(0, 1 << 62, 60)})
    links = simhash_tree.near_links(spark.createDataFrame([(v,) for v in values], "bits long"), 3, shard_rows)
    found = {r.node: r.root for r in simhash_tree.components(links).collect()}
    array = np.array(values, dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= 3)
    label = simhash_tree.join_sets(len(values), a, b)
    assert [found.get(v, v) for v in values] == [values[i] for i in label]


def test_leaks(spark, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    edited = item.replace("delta", "changed").replace("kappa", "new words here")
    rows = [(1, f"before {item} after"), (2, f"Some Text. {edited.upper()}!"), (3, "alpha beta gamma and nothing else at all"), (4, None), (1, f"before {item} after")]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "two words")], "item_id long, text string")
    got = decontaminate.matches(spark.createDataFrame(rows, SCHEMA), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 7), (1, 7), (2, 7)]
    assert {round(r.score, 3) for r in got if r.doc_id == 1} == {1.0}
    assert decontaminate.matches(none, bench).count() == 0
    assert decontaminate.matches(spark.createDataFrame(rows, SCHEMA), bench.limit(0)).count() == 0


def test_spans_begin_where_the_alignment_begins(spark):
    item = [f"q{i}" for i in range(20)]
    rng = np.random.default_rng(6)
    fill = lambda n: [f"w{x}" for x in rng.integers(0, 900, n)]
    texts = [
        fill(30) + item[:12] + fill(20),
        fill(30) + item[:10] + ["new"] * 3 + item[10:] + fill(9),
        fill(7) + item + fill(3),
        item[8:],
        fill(4) + item[:8] + fill(40),
        fill(60),
        [],
    ]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.score, r.first_word, r.end_word) for r in decontaminate.matches(docs, bench).collect()}
    assert got == {0: (0.6, 30, 42), 1: (37 / 40, 30, 53), 2: (1.0, 7, 27), 3: (0.6, 0, 12)}
    low = {r.doc_id: r.score for r in decontaminate.matches(docs, bench, threshold=0.3).collect()}
    assert low == {k: v[0] for k, v in got.items()} | {4: 0.4}


def test_span_has_the_score_of_the_whole_table():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (list(rng.choice(list("abcd"), rng.integers(1, 12))) for _ in range(2))
        score, first, end = decontaminate.local_span(a, b)
        # The span alone gives the score, and its first and last word are matches.
        assert decontaminate.local_score(a, b[first:end]) == (score, end - first)
        assert decontaminate.local_score(a, b)[0] == score
        assert score == 0 or (b[first] in a and b[end - 1] in a)


def test_local_score_is_smith_waterman():
    rng = np.random.default_rng(0)
    for _ in range(40):
        a, b = ([f"w{x}" for x in rng.integers(0, 4, rng.integers(1, 12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (2 if x == y else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
        assert decontaminate.local_score(a, b)[0] == table.max()


def test_every_copied_run_has_a_seed():
    grams = [f"g{i}" for i in range(30)]
    counts = {g: (i * 7) % 11 for i, g in enumerate(grams)}
    seeds = decontaminate.rare_seeds(grams, counts)
    assert all(any(i <= s < i + 3 for s in seeds) for i in range(28))


def test_shards_are_level_and_slots_gapless(spark, odd, none):
    got = sharding.assign(odd, ["doc_id", "text"], 4, rows_per_bucket=3).collect()
    assert len(got) == len(ODD)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.assign(none, ["doc_id"], 4).count() == 0


def test_ring_walk_moves_little():
    nodes = sharding.ring(8, 64)
    owners = [s for _, s in nodes]
    counts = np.random.default_rng(0).integers(0, 40, len(nodes)).tolist()
    room = sharding.capacities(sum(counts), 8, 0.1)
    parts = sharding.assign_arcs(counts, owners, room)
    loads = collections.Counter()
    for p in parts:
        loads[p.shard] += p.high - p.low
    assert sum(loads.values()) == sum(counts) and max(loads.values()) <= room[0]
    home = sum(p.high - p.low for p in parts if owners[p.arc] == p.shard)
    over = sum(max(0, sum(c for c, o in zip(counts, owners) if o == s) - room[s]) for s in range(8))
    assert home == sum(counts) - over


def _labelled(spark, n=160):
    rng = np.random.default_rng(5)
    plain = ["river", "stone", "house", "green", "walk", "table", "music", "light", "paper", "cloud"]
    rows = []
    for i in range(n):
        words = rng.choice(plain, 20).tolist()
        if i % 2:
            words.insert(int(rng.integers(20)), str(rng.choice(["grumblor", "snarvik"])))
        rows.append((i, " ".join(words), i % 2))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_rank_table_takes_little_of_the_driver():
    byte_bpe.load_pieces(RANKS)
    tracemalloc.start()
    try:
        shift, cells = byte_bpe.rank_table.__wrapped__(RANKS)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(shift) < len(cells) and peak < 45e6


def test_toxicity_finds_gapped_insults(spark, odd, none):
    train = _labelled(spark)
    model = toxicity.fit(train.select("doc_id", "text"), train.select("doc_id", "toxic"))
    ask = ["you g.r.u.m.b.l.o.r", "a s n a r v i k there", "snxarvxik walk", "Grumblor", "green river walk", "", None]
    got = toxicity.score(spark.createDataFrame(list(enumerate(ask)), SCHEMA), model)
    assert [r.predicted for r in got.orderBy("doc_id").collect()] == [1, 1, 1, 1, 0, 0, 0]
    assert toxicity.score(odd, model).filter("score between 0 and 1").count() == len(ODD)
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.fit(odd, train.select("doc_id", "toxic").limit(0))
    assert toxicity.score(odd, empty).count() == len(ODD)


def test_string_kernel_is_the_sum_over_subsequences():
    marks = toxicity.landmarks(["abcad"])
    profile = collections.Counter()
    word = "abcad"
    for i in range(5):
        for j in range(i + 1, 5):
            for k in range(j + 1, 5):
                profile[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
    assert marks.own[0] == pytest.approx(sum(v * v for v in profile.values()), rel=1e-5)
    assert toxicity.kernel_rows(marks, ["zz abcad zz", "qqq", ""])[:, 0] == pytest.approx([1, 0, 0], abs=1e-5)


def test_long_runs_hold_an_insult_at_every_place(monkeypatch):
    words = ["idiot", "clown", "worthless", "abcdefghijklmnopqrst"]
    marks = toxicity.landmarks(words)
    runs = ["語" * at + w + "語" * (150 - at) for w in [*words, "idxiot"] for at in range(151)]
    asked = runs + [" ".join(r) for r in runs[::3]]
    got = toxicity.kernel_rows(marks, asked)
    assert (got.max(axis=1) >= toxicity.FLOOR).all()
    with monkeypatch.context() as patch:
        patch.setattr(toxicity, "UNIT", 1 << 12)
        assert got == pytest.approx(toxicity.kernel_rows(marks, asked), abs=1e-5)
    limit = 1 << 21
    seams = ["語" * (limit - at) + "idiot" + "語" * 50 for at in range(7)]
    assert toxicity.kernel_rows(marks, seams)[:, 0] == pytest.approx(1, abs=1e-5)


def test_language(spark, odd, none):
    rng = np.random.default_rng(2)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["ßu", "ör", "tz"], "zz": ["ión", "que", "ña"]}
    rows = [(i, " ".join("".join(rng.choice(parts[g], 3)) for _ in range(30)), g) for i in range(90) for g in [list(parts)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df.filter("doc_id < 60"), "doc_id", "text", "lang")
    got = language_id.predict(df.filter("doc_id >= 60").drop("lang").withColumn("score", df.doc_id), model).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] and 0 <= r.score <= 1 for r in got)
    marks = {r.doc_id: r.lang_pred for r in language_id.predict(odd, model).collect()}
    assert marks[2] == marks[3] == marks[4] == "und" and marks[7] != "und"
    assert language_id.predict(none, model).count() == 0
    untrained = language_id.fit(none.selectExpr("*", "'' AS lang"), "doc_id", "text", "lang")
    assert language_id.predict(odd, untrained).count() == len(ODD)


def _overlaps(rules, text):
    found = []
    for rule in rules:
        if rule["keyword"] in text:
            found += [(m.start(), -m.end(), rule["priority"], rule["label"]) for m in re.finditer(rule["pattern"], text)]
    kept = []
    for x in sorted(found):
        if not any(y[0] <= x[0] and -y[1] >= -x[1] and y[2] <= x[2] for y in sorted(found)[: sorted(found).index(x)]):
            kept.append(x)
    return kept


def test_license_rules(spark, none):
    texts = [
        "Licensed under the Apache License, Version 2.0. See http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: GPL-3.0-or-later and the MIT License, MIT\nlicense",
        "GNU General Public License version 3; gnu lesser general public license v2.1",
        "no such thing", "", None, "This licence is the BSD license. BSD License",
        "copyright (c) 2020 someone, all rights reserved",
    ]
    rules = licenses.signature_rules()
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in licenses.scan(df).collect():
        text = (texts[r.doc_id] or "").lower()
        want = _overlaps(rules, text) if re.search("|".join(licenses.GATE), text) else []
        got = [(d.start, d.back, d.priority, d.label) for d in r.detections or []]
        assert [g[:3] for g in got] == [w[:3] for w in want]
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        assert r.n_words == len(words)
        for p in r.places:
            phrase = dict(licenses.BASE)[p.label]
            at = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
            assert (p.n, p["first"], p["last"]) == (len(at), min(at, default=None), max(at, default=None))
    assert licenses.scan(none).count() == 0


def _sample(tree, rng):
    """A string that a parsed pattern matches, look-arounds left out."""
    out = ""
    for op, value in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(value)
        elif op in ("ANY", "NOT_LITERAL"):
            out += "#"
        elif op == "IN":
            kind, what = value[int(rng.integers(len(value)))]
            out += {"LITERAL": lambda: chr(what), "NEGATE": lambda: "#", "CATEGORY": lambda: _category(what, rng)}[str(kind)]()
        elif op == "BRANCH":
            out += _sample(value[1][int(rng.integers(len(value[1])))], rng)
        elif op == "SUBPATTERN":
            out += _sample(value[3], rng)
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, part = value
            out += "".join(_sample(part, rng) for _ in range(int(rng.integers(low, min(int(high), low + 1) + 1))))
        else:
            assert op in ("ASSERT", "ASSERT_NOT", "AT"), op
    return out


def _category(what, rng):
    return {"SPACE": "\n \t"[int(rng.integers(3))], "NOT_SPACE": "x", "DIGIT": "7"}[str(what).removeprefix("CATEGORY_")]


def test_license_gate_and_keywords_lose_no_match(spark):
    rng = np.random.default_rng(11)
    rules = licenses.signature_rules()
    texts = ["see mozilla.org/MPL now", "a https://openfontlicense.org/x", "placed in the public\ndomain", "http://www.wtfpl.net/about"]
    texts += ["Lesser\nGeneral Public License", "Eclipse\nPublic License", "cc Creative\nCommons zero license", "q\tpublic license"]
    for rule in rules:
        tree = re._parser.parse(rule["pattern"])
        texts += [_sample(tree, rng) for _ in range(6)]
    for rule in rules:
        for text in texts:
            if re.search(rule["pattern"], text.lower()):
                assert rule["keyword"] in text.lower() and re.search("|".join(licenses.GATE), text.lower()), (rule, text)
    asked = texts[:8] + texts[8::6]
    got = {r.doc_id: r.detections for r in licenses.scan(spark.createDataFrame(list(enumerate(asked)), SCHEMA)).collect()}
    bare = [r | {"keyword": ""} for r in rules]
    for i, text in enumerate(asked):
        want = sorted(set(_overlaps(bare, text.lower())))
        assert want and [(d.start, d.back, d.priority) for d in got[i] or []] == [w[:3] for w in want], text


def test_site_lines(spark):
    rows = [(i, "https://a.example/x", f"<p>menu</p><p>page <b>{i}</b></p><script>menu</script>") for i in range(5)]
    rows += [(10, "http://b.example", "<p>menu</p>one&amp;only"), (11, None, "menu\nmenu"), (12, "no address", None)]
    got = {r.page_id: r for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3].text == "page 3" and (got[3].n_lines, got[3].n_dropped) == (2, 1)
    assert got[10].text == "menu\none&only" and got[11].text == "menu\nmenu" and got[12].n_lines == 0
