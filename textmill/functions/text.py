"""Character-level cleaning and composition of prompts."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The punctuation set contains a backslash, the letter "s" and the newline.
PUNCTUATION = (
    "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    "《》？！“”‘’￥…×（）—【】；●，。～、s：\n"
)
ASCII_PUNCT = ",().!;:"
FULLWIDTH_PUNCT = "，（）。！；："
QUOTE_MARKS = "「」｢｣『』"
TRANSLATION_WORDS = ("翻译", "translate")
TABLE_WORDS = ("表格", "-----")
SIMILAR_ABOVE = 0.9
END_MARK = "<EOS>"
END_MARK_SEQ2SEQ = "[EOS]"
# ----------------------------------------------------------------------------

ColumnOrName = Column | str

#: Texts that a task holds as Python strings at a time.
SLICE_TEXTS = 256


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: ColumnOrName) -> Column:
    return F.coalesce(col(c), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def char_class(chars: str) -> str:
    """Body of a Java character class for exactly these characters."""
    return "".join("\\" + c if c in "\\[]^-&~" else c for c in dict.fromkeys(chars))


def chars(c: ColumnOrName) -> Column:
    """Code points as an array; the empty string gives an empty array."""
    text = col(c)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def strip(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def strip_cr(c: ColumnOrName) -> Column:
    return F.replace(col(c), F.lit("\r"), F.lit(""))


def to_zh_punct(c: ColumnOrName) -> Column:
    return F.translate(col(c), ASCII_PUNCT, FULLWIDTH_PUNCT)


def collapse_punct(c: ColumnOrName, punct: str = PUNCTUATION, variant: str = "default") -> Column:
    """Spaces become a comma and a run of punctuation keeps its first mark.

    ``variant="t5_sft"`` uses the ASCII comma and also swallows the character
    that follows a run.
    """
    members = char_class(punct)
    if variant == "t5_sft":
        spaced = F.translate(col(c), " 　", ",,")
        return F.regexp_replace(spaced, f"(?s)([{members}])[{members}]*[^{members}]?", "$1")
    if variant != "default":
        raise ValueError(f"unknown variant {variant!r}")
    spaced = F.translate(col(c), " 　", "，，")
    return F.regexp_replace(spaced, f"([{members}])[{members}]+", "$1")


def fix_wiki_marks(c: ColumnOrName) -> Column:
    quoted = F.translate(col(c), QUOTE_MARKS, '"' * len(QUOTE_MARKS))
    closed = F.regexp_replace(quoted, "[，；]）", "）")
    return F.regexp_replace(closed, "[（(]，", "（")


def map_chars(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """One-to-one character mapping from a user table (script conversion)."""
    if any(len(k) != 1 or len(v) != 1 for k, v in mapping.items()):
        raise ValueError("map_chars takes single characters; use map_phrases")
    return F.translate(col(c), "".join(mapping), "".join(mapping.values()))


def by_text(change: Callable[[str], str]) -> Callable[[Column], Column]:
    """A function of one text over Arrow batches, a slice of rows at a time; null stays null."""

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        parts = [
            pa.array([None if t is None else change(t) for t in values.slice(at, SLICE_TEXTS).to_pylist()], pa.string())
            for at in range(0, len(values), SLICE_TEXTS)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return run


def map_phrases(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Phrase mapping from a user dictionary, longest match first."""
    if not mapping:
        return col(c)
    longest_first = sorted(mapping, key=len, reverse=True)
    pattern = re.compile("|".join(map(re.escape, longest_first)))

    return by_text(lambda text: pattern.sub(lambda m: mapping[m.group()], text))(col(c))


def normalise_line(c: ColumnOrName, mapping: dict[str, str] | None = None) -> Column:
    """Script conversion, mark repair, full-width punctuation, collapsing."""
    converted = map_chars(c, mapping) if mapping else col(c)
    return collapse_punct(to_zh_punct(fix_wiki_marks(converted)))


def dice_chars(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Dice similarity of the two character sets, 0 when both are empty."""

    def score(pair: Column) -> Column:
        total = F.size(pair["a"]) + F.size(pair["b"])
        shared = F.size(F.array_intersect(pair["a"], pair["b"]))
        return F.when(total == 0, F.lit(0.0)).otherwise(2.0 * shared / total)

    sets = F.struct(
        F.array_distinct(chars(text_or_empty(a))).alias("a"),
        F.array_distinct(chars(text_or_empty(b))).alias("b"),
    )
    return let(sets, score)


def compose_prompt(title: ColumnOrName, desc: ColumnOrName, sep: str = "") -> Column:
    """Title alone when the description repeats it, else both."""
    both = F.concat(text_or_empty(title), F.lit(sep), text_or_empty(desc))
    return F.when(dice_chars(title, desc) > SIMILAR_ABOVE, text_or_empty(title)).otherwise(both)


def compose_optional(
    instruction: ColumnOrName, extra: ColumnOrName, sep: str = "", strip_extra: bool = False
) -> Column:
    """Instruction plus an optional input."""
    tested = strip(text_or_empty(extra)) if strip_extra else text_or_empty(extra)
    both = F.concat(text_or_empty(instruction), F.lit(sep), text_or_empty(extra))
    return F.when(F.length(tested) == 0, text_or_empty(instruction)).otherwise(both)


def to_sample(prompt: ColumnOrName, response: ColumnOrName, end: str = END_MARK) -> Column:
    return F.concat(text_or_empty(prompt), text_or_empty(response), F.lit(end))


def add_end(c: ColumnOrName, end: str = END_MARK) -> Column:
    return F.concat(text_or_empty(c), F.lit(end))


def clip_then_end(c: ColumnOrName, max_len: int, end: str = END_MARK_SEQ2SEQ) -> Column:
    """Cut to ``max_len`` minus the mark's own length, then append the mark."""
    return F.concat(F.substring(col(c), 1, max_len - len(end)), F.lit(end))


def unescape_newline(c: ColumnOrName) -> Column:
    return F.replace(col(c), F.lit("\\n"), F.lit("\n"))


def clean_chunk(c: ColumnOrName) -> Column:
    return F.translate(col(c), ",\n\t", "")


def to_document(c: ColumnOrName) -> Column:
    """First tab-separated field of the stripped line."""
    return F.split_part(strip(c), F.lit("\t"), F.lit(1))


def pick_template(key: ColumnOrName, templates: list[str]) -> Column:
    """Repeatable choice of a template by a hash of the key."""
    digest = F.conv(F.substring(F.md5(col(key).cast("string")), 1, 8), 16, 10).cast("long")
    index = (digest % len(templates)).cast("int") + 1
    return F.element_at(F.array(*map(F.lit, templates)), index)


def first_sentence(c: ColumnOrName, stop: str = ".") -> Column:
    return F.split_part(col(c), F.lit(stop), F.lit(1))


def after_first_sentence(c: ColumnOrName, stop: str = ".") -> Column:
    return F.substring(col(c), F.length(first_sentence(c, stop)) + 1 + len(stop), F.length(col(c)))
