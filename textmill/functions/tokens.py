"""Token arrays, run counts and n-grams as row-local expressions.

Counting inside the row keeps n-gram and term statistics of one document free
of shuffles: tokens are sorted, runs are found by comparing neighbours, and the
work is linear after the sort.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import ColumnOrName, by_text, col, let, text_or_empty

WORD_PATTERN = r"[\p{L}\p{N}_]+"
# One punctuation mark, one digit, or a run of anything else.
SPLIT_PATTERN = r"[\p{P}$+<=>^`|~]|\p{N}|[^\p{P}$+<=>^`|~\p{N}]+"
SPACE_MARK = "▁"


def words(c: ColumnOrName) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(WORD_PATTERN), F.lit(0))


def pretokenize(c: ColumnOrName) -> Column:
    """Punctuation and digits stand alone; white space starts a new piece.

    The space is kept at the head of the next piece as a visible mark, and each
    isolated piece that starts a text also carries the mark.
    """
    marked = F.translate(text_or_empty(c), " ", SPACE_MARK)
    pieces = F.regexp_extract_all(marked, F.lit(SPLIT_PATTERN), F.lit(0))
    with_head = F.transform(
        pieces,
        lambda p: F.when(F.startswith(p, F.lit(SPACE_MARK)), p).otherwise(F.concat(F.lit(SPACE_MARK), p)),
    )
    return F.flatten(
        F.transform(
            with_head,
            lambda p: F.regexp_extract_all(p, F.lit(f"{SPACE_MARK}[^{SPACE_MARK}]*"), F.lit(0)),
        )
    )


def nfkc(c: ColumnOrName) -> Column:
    return by_text(lambda text: unicodedata.normalize("NFKC", text))(col(c))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` sorted by term."""

    def runs(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        starts = F.filter(
            F.when(last < 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last)),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda begin: F.transform(
                begin,
                lambda b, j: F.struct(
                    F.get(ordered, b).alias("term"),
                    (F.coalesce(F.get(begin, j + 1), last + 1) - b).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(tokens), runs)


def ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """All n-grams, joined by ``sep``, in order."""

    def windows(items: Column) -> Column:
        count = F.size(items) - (n - 1)
        starts = F.when(count < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), count))
        return F.transform(starts, lambda i: F.array_join(F.slice(items, i, n), sep))

    return tokens if n == 1 else let(tokens, windows)


def _numbered(tokens: Column) -> Column:
    """Make repeats distinct by an occurrence number: a multiset as a set."""
    return F.flatten(
        F.transform(
            term_counts(tokens),
            lambda run: F.transform(
                F.sequence(F.lit(1), run["tf"]),
                lambda k: F.concat(run["term"], F.lit("\x01"), k.cast("string")),
            ),
        )
    )


def multiset_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two string arrays."""
    return F.size(F.array_intersect(_numbered(a), _numbered(b)))


def set_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def hash_ids(tokens: Column) -> Column:
    """16-bit ids by hashing, a vocabulary-free stand-in for an encoder."""
    return F.transform(
        tokens, lambda t: F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int")
    )
