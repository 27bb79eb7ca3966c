"""Templates, chat rendering, model-output parsing and label extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import ColumnOrName, col, let, strip, text_or_empty

# --- fixed values -----------------------------------------------------------
WIKI_QUESTIONS = [
    "什么是{}？",
    "介绍一下{}",
    "介绍一下什么是{}",
    "写一篇关于{}的介绍",
    "{}是什么？",
    "你知道{}吗？",
    "生成关于{}的介绍",
    "我想知道关于{}的详细信息",
    "你了解{}吗？",
    "请解释一下{}",
    "对于{}，你有什么了解或看法吗？",
    "请告诉我关于{}的信息",
    "请简要描述一下{}",
    "请提供有关{}的一些详细信息",
    "能否解释一下{}是什么?",
    "请分享一些关于{}的背景知识",
    "请简要概括一下{}",
    "能给我一些关于{}的背景资料吗?",
    "有关{}的信息可以分享一下吗？",
    "你能告诉我{}是什么吗？",
]
# The line breaks below are a backslash and an "n", as in the data they match.
ENTITY_QUESTIONS = [
    "找出指定的实体：\\n[INPUT_TEXT]\\n类型选项：[LIST_LABELS]\\n答：",
    "找出指定的实体：\\n[INPUT_TEXT]\\n实体类型选项：[LIST_LABELS]\\n答：",
    "找出句子中的[LIST_LABELS]实体：\\n[INPUT_TEXT]\\n答：",
    "[INPUT_TEXT]\\n问题：句子中的[LIST_LABELS]实体是什么？\\n答：",
    "生成句子中的[LIST_LABELS]实体：\\n[INPUT_TEXT]\\n答：",
    "下面句子中的[LIST_LABELS]实体有哪些？\\n[INPUT_TEXT]\\n答：",
    "实体抽取：\\n[INPUT_TEXT]\\n选项：[LIST_LABELS]\\n答：",
    "医学实体识别：\\n[INPUT_TEXT]\\n实体选项：[LIST_LABELS]\\n答：",
]
ENTITY_TYPES = [
    "临床表现", "中医治则", "方剂", "西医诊断", "其他治疗",
    "西医治疗", "中医证候", "中药", "中医治疗", "中医诊断",
]
ENTITY_SUFFIX = "实体"
ENTITY_PATTERN = r"(?U)(\w+实体)：([一-龥]+)"
TARGET_HEADER = "上述句子中的实体包含：\n"
ANSWER_MARK = "答："
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"
QUESTION_FORMAT = CHAT_START + "问：\n%s\n答：\n"
REPLY_FORMAT = "%s\n" + CHAT_END
NO_REPLY = "没有回复"
# ----------------------------------------------------------------------------


def fill_template(template: Column, text: ColumnOrName, labels: ColumnOrName) -> Column:
    joined = F.array_join(col(labels), "，")
    with_text = F.replace(template, F.lit("[INPUT_TEXT]"), text_or_empty(text))
    return F.replace(with_text, F.lit("[LIST_LABELS]"), joined)


def fill_title(template: Column, title: ColumnOrName) -> Column:
    return F.replace(template, F.lit("{}"), text_or_empty(title))


def extract_entities(c: ColumnOrName, types: Sequence[str] = ENTITY_TYPES) -> Column:
    """``array<struct<type, entity>>`` of the known types, in text order."""
    source = text_or_empty(c)
    found = F.zip_with(
        F.regexp_extract_all(source, F.lit(ENTITY_PATTERN), F.lit(1)),
        F.regexp_extract_all(source, F.lit(ENTITY_PATTERN), F.lit(2)),
        lambda t, e: F.struct(
            F.replace(t, F.lit(ENTITY_SUFFIX), F.lit("")).alias("type"), e.alias("entity")
        ),
    )
    return F.filter(found, lambda x: x["type"].isin(*types))


def entities_by_type(entities: ColumnOrName) -> Column:
    """``map<type, array<entity>>`` of an extracted entity list."""
    return let(
        col(entities),
        lambda items: F.map_from_entries(
            F.transform(
                F.array_distinct(F.transform(items, lambda x: x["type"])),
                lambda t: F.struct(
                    t, F.transform(F.filter(items, lambda x: x["type"] == t), lambda x: x["entity"])
                ),
            )
        ),
    )


def question_part(c: ColumnOrName) -> Column:
    return strip(F.split_part(col(c), F.lit(ANSWER_MARK), F.lit(1)))


def answer_part(c: ColumnOrName) -> Column:
    return strip(F.split_part(col(c), F.lit(ANSWER_MARK), F.lit(2)))


def render_question(c: ColumnOrName) -> Column:
    bare = strip(F.replace(strip(c), F.lit(ANSWER_MARK), F.lit("")))
    return F.format_string(QUESTION_FORMAT, bare)


def render_reply(c: ColumnOrName) -> Column:
    return F.format_string(REPLY_FORMAT, strip(c))


def chat_block(role: str, content: Column) -> Column:
    return F.concat(F.lit(f"{CHAT_START}{role}\n"), content, F.lit(CHAT_END))


def render_chat(
    query: ColumnOrName,
    history: ColumnOrName | None = None,
    system: ColumnOrName | str = "",
    fmt: str = "chatml",
) -> Column:
    """Prompt text of a conversation; ``history`` is array<struct<user, assistant>>."""
    if fmt == "raw":
        return col(query)
    if fmt != "chatml":
        raise ValueError(f"unknown chat format {fmt!r}")
    system_text = F.lit(system) if isinstance(system, str) else system
    parts = [chat_block("system", system_text)]
    if history is not None:
        turns = F.transform(
            col(history),
            lambda t: F.concat(
                F.lit("\n"), chat_block("user", t["user"]), F.lit("\n"), chat_block("assistant", t["assistant"])
            ),
        )
        parts.append(F.array_join(turns, ""))
    parts += [F.lit("\n"), chat_block("user", col(query)), F.lit(f"\n{CHAT_START}assistant\n")]
    return F.concat(*parts)


def trim_generation(
    c: ColumnOrName, stop_words: Sequence[str] = (), end_words: Sequence[str] = ()
) -> Column:
    """Struct of the trimmed text and the reason the text ended."""
    text = text_or_empty(c)
    reason = F.concat(F.lit("Gen length "), F.length(text).cast("string"))
    for word in stop_words:
        text = strip(F.replace(text, F.lit(word), F.lit("")))
    for word in end_words:
        reason = F.when(F.contains(text, F.lit(word)), F.lit(f"Gen {word!r}")).otherwise(reason)
        text = F.split_part(text, F.lit(word), F.lit(1))
    return F.struct(strip(text).alias("text"), reason.alias("end_reason"))


def format_docs(docs: ColumnOrName) -> Column:
    return F.array_join(col(docs), "\n\n")


def format_qa(question: ColumnOrName, answer: ColumnOrName, index: Column | None = None) -> Column:
    number = F.lit("") if index is None else index.cast("string")
    return strip(
        F.concat(F.lit("Question"), number, F.lit(":"), col(question), F.lit("\nAnswer:"), col(answer))
    )


def split_queries(c: ColumnOrName) -> Column:
    """Lines of a generated list of queries."""
    return F.split(col(c), "\n")


def parse_verdict(c: ColumnOrName, field: str = "score") -> Column:
    """Lower-cased value of one field of a JSON verdict; null when unreadable."""
    return F.lower(strip(F.get_json_object(col(c), f"$.{field}")))


def validate_verdict(value: ColumnOrName, allowed: Sequence[str]) -> Column:
    """Struct of the accepted value and the rejected raw value."""
    raw = col(value)
    good = raw.isin(*allowed)
    return F.struct(F.when(good, raw).alias("value"), F.when(~F.coalesce(good, F.lit(False)), raw).alias("rejected"))
