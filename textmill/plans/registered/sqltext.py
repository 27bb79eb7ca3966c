"""SQL fragments shared by the twins."""

from __future__ import annotations

from textmill.functions.text import ASCII_PUNCT, FULLWIDTH_PUNCT, PUNCTUATION, char_class


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PUNCT_CLASS = char_class(PUNCTUATION).replace("'", "''")


def zh_punct(c: str) -> str:
    return f"translate({c}, {lit(ASCII_PUNCT)}, {lit(FULLWIDTH_PUNCT)})"


def collapse(c: str) -> str:
    return rf"regexp_replace(translate({c}, ' 　', '，，'), '([{PUNCT_CLASS}])[{PUNCT_CLASS}]+', '\1', 'g')"


def collapse_sft(c: str) -> str:
    return (
        rf"regexp_replace(translate({c}, ' 　', ',,'), "
        rf"'(?s)([{PUNCT_CLASS}])[{PUNCT_CLASS}]*[^{PUNCT_CLASS}]?', '\1', 'g')"
    )


def strip_cr(c: str) -> str:
    return f"replace({c}, chr(13), '')"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def dice(a: str, b: str) -> str:
    left, right = f"list_distinct(string_split({a}, ''))", f"list_distinct(string_split({b}, ''))"
    left, right = (f"list_filter({x}, lambda z: z <> '')" for x in (left, right))
    return (
        f"(CASE WHEN len({left}) + len({right}) = 0 THEN 0.0 ELSE "
        f"2.0 * len(list_intersect({left}, {right})) / (len({left}) + len({right})) END)"
    )


def hash32(c: str) -> str:
    return f"('0x' || substr(md5({c}), 1, 8))::BIGINT"


WORDS = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+')"


def words(c: str) -> str:
    return WORDS.format(c=c)
