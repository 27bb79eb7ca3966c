"""Chunkers.  A page, document or file text is one row, so no chunker groups rows.

Greedy chunkers fold over sentence lengths and keep only offsets; the text is cut
once at the end.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import ColumnOrName, clean_chunk, col, let, strip, text_or_empty
from textmill.operators.dedup import dedup_exact
from textmill.operators.exploding import explode_items, explode_structs
from textmill.operators.filters import page_text

# --- fixed values -----------------------------------------------------------
STOP = "。"
BULLETS = ("■", "•", "\t")
SKIPPED_WORDS = ("□", "•")
WARNING_WORDS = ("警告！", "注意！", "说明！")
CONTENTS_MARKS = ("目录", "..........")
SEPARATORS = ("\n\n", "\n", " ", "")
SHORT_RUN = 15
SHORTEST = 6
HEADER_TOP = (17, 20)
# ----------------------------------------------------------------------------


def _no_spans() -> Column:
    return F.array().cast("array<struct<b:int,e:int>>")


def _span(b: Column, e: Column) -> Column:
    return F.struct(b.cast("int").alias("b"), e.cast("int").alias("e"))


def _cut(text: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.substring(text, s["b"] + 1, s["e"] - s["b"]))


def split_long(c: ColumnOrName, max_seq: int = 1024, stop: str = STOP) -> Column:
    """Pieces of one block: short blocks vanish, long ones split on the first bullet present."""

    def pieces(line: Column) -> Column:
        mark = F.lit(stop)
        for bullet in reversed(BULLETS):
            mark = F.when(F.contains(line, F.lit(bullet)), F.lit(bullet)).otherwise(mark)
        parts = F.split(line, F.concat(F.lit("\\Q"), mark, F.lit("\\E")))
        bare = F.transform(parts, lambda p: F.translate(p, "\n", ""))
        kept = F.filter(bare, lambda p: (F.length(p) < max_seq) & (F.length(p) >= SHORTEST))
        return (
            F.when(F.length(line) < SHORTEST, F.array().cast("array<string>"))
            .when(F.length(line) > max_seq, F.transform(kept, clean_chunk))
            .otherwise(F.array(clean_chunk(line)))
        )

    return let(text_or_empty(c), pieces)


def sliding_chunks(c: ColumnOrName, kernel: int = 512, stop: str = STOP) -> Column:
    """Windows over sentences.

    A window longer than ``kernel`` is emitted with its closing mark, then its
    oldest sentence leaves.  What is left at the end is not emitted.
    """

    def windows(s: Column) -> Column:
        lengths = s["lengths"]

        def step(acc: Column, n: Column) -> Column:
            over = (acc["pos"] - acc["begin"] + n) > kernel
            leaving = F.get(lengths, acc["slow"]) + len(stop)
            return F.struct(
                F.when(over, F.least(acc["begin"] + leaving, acc["pos"])).otherwise(acc["begin"]).alias("begin"),
                (acc["slow"] + over.cast("int")).alias("slow"),
                (acc["pos"] + n + len(stop)).alias("pos"),
                F.when(over, F.array_append(acc["spans"], _span(acc["begin"], acc["pos"] + n + len(stop))))
                .otherwise(acc["spans"])
                .alias("spans"),
            )

        zero = F.struct(
            F.lit(0).alias("begin"), F.lit(0).alias("slow"), F.lit(0).alias("pos"), _no_spans().alias("spans")
        )
        spans = F.aggregate(lengths, zero, step, lambda acc: acc["spans"])
        return _cut(F.concat(s["text"], F.lit(stop)), spans)

    text = text_or_empty(c)
    lengths = F.transform(F.split(text, "\\Q" + stop + "\\E"), F.length)
    return let(F.struct(text.alias("text"), lengths.alias("lengths")), windows)


def _greedy(lengths: Column, closes: Callable[[Column, Column], Column], begin_after: str, tail: bool) -> Column:
    """Spans of consecutive pieces: ``closes(held, n)`` ends a span with piece ``n``.

    ``begin_after="piece"`` starts the next span at the closing piece itself,
    ``"end"`` after it.
    """

    def step(acc: Column, n: Column) -> Column:
        end = acc["pos"] + n
        over = closes(acc["pos"] - acc["begin"], n)
        following = acc["pos"] if begin_after == "piece" else end
        return F.struct(
            F.when(over, following).otherwise(acc["begin"]).alias("begin"),
            end.alias("pos"),
            F.when(over, F.array_append(acc["spans"], _span(acc["begin"], end)))
            .otherwise(acc["spans"])
            .alias("spans"),
        )

    zero = F.struct(F.lit(0).alias("begin"), F.lit(0).alias("pos"), _no_spans().alias("spans"))

    def finish(acc: Column) -> Column:
        if not tail:
            return acc["spans"]
        rest = F.array_append(acc["spans"], _span(acc["begin"], acc["pos"]))
        return F.when(acc["pos"] > acc["begin"], rest).otherwise(acc["spans"])

    return F.aggregate(lengths, zero, step, finish)


def rule_chunks(
    c: ColumnOrName, max_seq: int = 512, min_len: int = SHORTEST, stop: str = STOP, legacy_tail: bool = False
) -> Column:
    """Sentences of a page packed until the next one passes ``max_seq``.

    The sentence that passes the limit closes a chunk and also opens the next.
    The rest is emitted too unless ``legacy_tail``.
    """

    def pack_page(text: Column) -> Column:
        sentences = F.split(text, "\\Q" + stop + "\\E")
        spans = _greedy(
            F.transform(sentences, F.length), lambda held, n: held + n > max_seq, "piece", tail=not legacy_tail
        )
        return (
            F.when(F.length(text) < min_len, F.array().cast("array<string>"))
            .when(F.length(text) < max_seq, F.array(text))
            .otherwise(_cut(F.replace(text, F.lit(stop), F.lit("")), spans))
        )

    return let(text_or_empty(c), pack_page)


def text_blocks(c: ColumnOrName, size: int = 2048) -> Column:
    """Whole lines until a block has ``size`` characters; a shorter rest is dropped."""

    def blocks(text: Column) -> Column:
        # Every line but the last keeps its line break.
        lengths = let(
            F.split(text, "\n"),
            lambda lines: F.transform(lines, lambda s, i: F.length(s) + (i < F.size(lines) - 1).cast("int")),
        )
        spans = _greedy(lengths, lambda held, n: held + n >= size, "end", tail=False)
        return _cut(text, spans)

    return let(text_or_empty(c), blocks)


def split_overlap(c: ColumnOrName, size: int, overlap: int = 0) -> Column:
    """Fixed windows of ``size`` characters; the last one ends with the text."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap

    def windows(text: Column) -> Column:
        count = F.greatest(F.ceil((F.length(text) - overlap) / F.lit(step)), F.lit(1)).cast("int")
        starts = F.sequence(F.lit(0), count - 1)
        return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(starts, lambda i: F.substring(text, i * step + 1, F.lit(size)))
        )

    return let(text_or_empty(c), windows)


def _piece_begins(text: str, begin: int, end: int, separator: str) -> list[int]:
    """Where pieces begin: at ``begin`` and at every separator, which stays with what follows it."""
    if not separator:
        return list(range(begin, end))
    begins, at = [begin], text.find(separator, begin, end)
    while at >= 0:
        if at > begin:
            begins.append(at)
        at = text.find(separator, at + len(separator), end)
    return begins


def _packed_spans(cuts: list[tuple[int, int]], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Spans of consecutive pieces up to ``size``; pieces at a span's end begin the next one while
    they hold at most ``overlap`` characters and leave room for the next piece."""
    held: deque[tuple[int, int]] = deque()
    for begin, end in cuts:
        if held and end - held[0][0] > size:
            yield held[0][0], held[-1][1]
            while held and (begin - held[0][0] > overlap or end - held[0][0] > size):
                held.popleft()
        held.append((begin, end))
    if held:
        yield held[0][0], held[-1][1]


def recursive_spans(text: str, begin: int, end: int, size: int, overlap: int, separators: tuple[str, ...]) -> Iterator[tuple[int, int]]:
    """Spans of a text cut at the first separator it holds; a piece of ``size`` or more is cut at the later ones.

    Runs of smaller pieces are packed.  The empty separator cuts between characters.
    """
    level = next((i for i, s in enumerate(separators) if text.find(s, begin, end) >= 0), len(separators) - 1)
    begins = _piece_begins(text, begin, end, separators[level])
    later = separators[level + 1 :] if separators[level] else ()
    small: list[tuple[int, int]] = []
    for a, b in zip(begins, [*begins[1:], end]):
        if b - a < size:
            small.append((a, b))
            continue
        yield from _packed_spans(small, size, overlap)
        small = []
        if later:
            yield from recursive_spans(text, a, b, size, overlap, later)
        else:
            yield a, b
    yield from _packed_spans(small, size, overlap)


def split_recursive(c: ColumnOrName, size: int, overlap: int = 0, separators: tuple[str, ...] = SEPARATORS) -> Column:
    """Chunks of up to ``size`` characters cut at the coarsest separator that makes them fit.

    Neighbours share up to ``overlap`` characters, in whole pieces.  Chunks are stripped and
    empty ones left out; null and empty texts have none.  Offsets are folded inside the row,
    and only the chunks are copied.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")

    @F.pandas_udf("array<string>")
    def chunks(texts: pd.Series) -> pd.Series:
        cut = ([t[a:b].strip() for a, b in recursive_spans(t, 0, len(t), size, overlap, separators)] if t else [] for t in texts)
        return pd.Series([[piece for piece in row if piece] for row in cut])

    return chunks(text_or_empty(c))


def page_header(words: ColumnOrName) -> Column:
    """Heading of a page from ``array<struct<text, size, top>>``.

    The first word in the heading zone wins, unless a contents mark comes first;
    without either the first word is taken.
    """

    def pick(items: Column) -> Column:
        def marked(w: Column) -> Column:
            return F.contains(w["text"], F.lit(CONTENTS_MARKS[0])) | F.contains(w["text"], F.lit(CONTENTS_MARKS[1]))

        low, high = HEADER_TOP
        hit = F.get(F.filter(items, lambda w: marked(w) | ((w["top"] > low) & (w["top"] < high))), 0)
        return F.when(hit.isNull(), F.get(items, 0)["text"]).when(~marked(hit), hit["text"])

    return let(col(words), pick)


def block_chunks(words: ColumnOrName, max_seq: int = 1024) -> Column:
    """Blocks of equal font size from ``array<struct<text, size, top>>`` of one page."""

    def usable(w: Column, i: Column) -> Column:
        return (
            (i > 0)
            & ~((i == 1) & F.rlike(w["text"], F.lit(r"^\p{Nd}+$")))
            & ~w["text"].isin(*SKIPPED_WORDS)
        )

    def step(acc: Column, w: Column) -> Column:
        held, size = acc["held"], F.format_string("%.5f", w["size"])
        warning = w["text"].isin(*WARNING_WORDS)
        joins = (size == acc["size"]) | ((F.length(held) > 0) & (F.length(held) < SHORT_RUN))
        flush = (F.length(held) > 0) & (warning | ~joins)
        return F.struct(
            F.when(warning, F.lit("")).when(joins, F.concat(held, w["text"])).otherwise(w["text"]).alias("held"),
            F.when(warning, acc["size"]).otherwise(size).alias("size"),
            F.when(flush, F.array_append(acc["blocks"], held)).otherwise(acc["blocks"]).alias("blocks"),
        )

    zero = F.struct(
        F.lit("").alias("held"), F.lit("0.00000").alias("size"), F.array().cast("array<string>").alias("blocks")
    )

    def finish(acc: Column) -> Column:
        return F.when(F.length(acc["held"]) > 0, F.array_append(acc["blocks"], acc["held"])).otherwise(acc["blocks"])

    blocks = F.aggregate(F.filter(col(words), usable), zero, step, finish)
    pieces = F.flatten(F.transform(blocks, lambda b: split_long(b, max_seq)))
    return F.when(page_header(words).isNotNull(), pieces).otherwise(F.array().cast("array<string>"))


def explode_chunks(df: DataFrame, chunks: Column, method: str, *keys: str) -> DataFrame:
    """One row per chunk: keys, method, position and text."""
    return explode_items(df, [*keys], chunks, "chunk").withColumn("method", F.lit(method))


def document_text(pages: ColumnOrName, min_len: int = SHORTEST) -> Column:
    """Text of a whole document from its ordered page texts."""
    texts = F.transform(col(pages), page_text)
    return F.array_join(F.filter(texts, lambda t: F.length(t) >= min_len), "")


def build_chunks(
    docs: DataFrame,
    key: str,
    text: str,
    words: str | None = None,
    block_sizes: tuple[int, ...] = (1024, 512),
    slide_sizes: tuple[int, ...] = (256, 512),
    rule_sizes: tuple[int, ...] = (256, 512),
    stop: str = STOP,
    kept: Callable[[Column], dict[str, Column]] | None = None,
) -> DataFrame:
    """All chunkings of every document, exact repeats removed.

    Each document is read once: its chunkings sit in one array that is exploded,
    so there is no union of six scans.  ``words`` adds the font-size blocks; without
    it long texts are split by :func:`split_long`.  Windows repeat a text many times over:
    with ``kept`` only these columns of a chunk and its digest are sorted and shuffled,
    not the chunk.
    """
    runs: list[tuple[str, Column]] = []
    for n in block_sizes:
        runs.append((f"block_{n}", block_chunks(words, n) if words else split_long(text, n, stop)))
    cleaned = page_text(text)
    runs += [(f"slide_{n}", sliding_chunks("_page", n, stop)) for n in slide_sizes]
    runs += [(f"rule_{n}", rule_chunks("_page", n, stop=stop)) for n in rule_sizes]
    prepared = docs.withColumn("_page", cleaned)
    packed = F.array(
        *(
            F.struct(F.lit(i).alias("method_no"), F.lit(name).alias("method"), chunks.alias("chunks"))
            for i, (name, chunks) in enumerate(runs)
        )
    )
    methods = explode_structs(prepared, [key], packed)
    rows = explode_items(methods, [key, "method_no", "method"], F.col("chunks"), "chunk")
    order = ["method_no", key, "pos"]
    if kept is None:
        return dedup_exact(rows, "chunk", order)
    first = dedup_exact(rows.drop("method"), "chunk", order, kept(F.col("chunk")))
    return first.withColumn("method", F.get(F.array(*(F.lit(name) for name, _ in runs)), F.col("method_no")))


def as_documents(chunks: DataFrame, chunk_id: str, text: str) -> DataFrame:
    """``chunk_id, text, metadata`` rows for an index."""
    return chunks.select(
        F.col(chunk_id).alias("chunk_id"),
        F.split_part(strip(text), F.lit("\t"), F.lit(1)).alias("text"),
        F.create_map(F.lit("id"), F.col(chunk_id).cast("string")).alias("metadata"),
    )
