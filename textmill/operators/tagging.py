"""Tagged sentences to spans and instruction rows; one sentence is one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.prompts import ENTITY_QUESTIONS, ENTITY_SUFFIX, TARGET_HEADER, fill_template
from textmill.functions.text import ColumnOrName, col, let, pick_template
from textmill.operators.exploding import explode_items

OUTSIDE = "O"


def bio_spans(chars: ColumnOrName, labels: ColumnOrName, legacy_prefix: bool = False) -> Column:
    """``array<struct<type, text, begin>>`` of a sentence.

    ``B-`` opens a span, ``I-`` continues what is open (or opens one after ``O``),
    any other label opens one unless it repeats the governing label.  With
    ``legacy_prefix`` a span that is closed by the next span keeps its full label.
    """

    # Every helper list is bound once: an unbound list inside a lambda would be
    # rebuilt for each element.
    def with_index(s: Column) -> Column:
        n = F.size(s["l"])
        index = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 1))
        return let(index, lambda i: with_governing(s, i))

    def with_governing(s: Column, index: Column) -> Column:
        labels_ = s["l"]
        governing = F.filter(index, lambda i: ~F.startswith(F.get(labels_, i), F.lit("I-")))
        return let(governing, lambda g: let(borders(labels_, index, g), lambda edge: spans(s, edge)))

    def borders(labels_: Column, index: Column, governing: Column) -> Column:
        """Where something ends or begins, and the end of the sentence."""

        def begins(i: Column, j: Column) -> Column:
            here = F.get(labels_, i)
            return (
                F.startswith(here, F.lit("B-"))
                | (j == 0)
                | (here == OUTSIDE)
                | (here != F.get(labels_, F.get(governing, j - 1)))
            )

        orphan = F.filter(
            index,
            lambda i: F.startswith(F.get(labels_, i), F.lit("I-")) & ((i == 0) | (F.get(labels_, i - 1) == OUTSIDE)),
        )
        return F.sort_array(F.concat(F.filter(governing, begins), orphan, F.array(F.size(labels_))))

    def spans(s: Column, edges: Column) -> Column:
        n = F.size(s["l"])

        def label(i: Column) -> Column:
            return F.get(s["l"], i)

        def span(b: Column, j: Column) -> Column:
            end = F.get(edges, j + 1)
            kind = F.substring(label(b), 3, F.length(label(b)))
            if legacy_prefix:
                kind = F.when((end < n) & (label(end) != OUTSIDE), label(b)).otherwise(kind)
            return F.struct(
                kind.alias("type"),
                F.array_join(F.slice(s["c"], b + 1, end - b), "").alias("text"),
                b.alias("begin"),
            )

        cut = F.transform(edges, lambda b, j: F.when((b < n) & (label(b) != OUTSIDE), span(b, j)))
        return F.filter(cut, lambda x: x.isNotNull())

    return let(F.struct(col(chars).alias("c"), col(labels).alias("l")), with_index)


def ner_target(spans: ColumnOrName) -> Column:
    """Header line and one ``type: text`` line per span."""
    lines = F.transform(
        col(spans), lambda s: F.concat(s["type"], F.lit(f"{ENTITY_SUFFIX}："), s["text"])
    )
    return F.concat(F.lit(TARGET_HEADER), F.array_join(lines, "\n"))


def label_inventory(sentences: DataFrame, labels: str = "labels") -> DataFrame:
    """Distinct labels with sorted ids and their entity type (null for ``O``).

    Labels are reduced inside each row first, so the shuffle is tiny.
    """
    distinct = explode_items(sentences, [], F.array_distinct(labels), "label").select("label").distinct()
    # The label set is a small closed vocabulary: one ordered list, numbered.
    listed = distinct.agg(F.sort_array(F.collect_set("label")).alias("all"))
    return listed.select(F.posexplode("all").alias("label_id", "label")).withColumn(
        "type", F.when(F.length("label") > 1, F.substring("label", F.lit(3), F.length("label")))
    )


def map_labels(sentences: DataFrame, inventory: DataFrame, labels: str = "labels") -> DataFrame:
    """Label names to ids without exploding the sentences."""
    lookup = inventory.agg(
        F.map_from_arrays(F.collect_list("label"), F.collect_list("label_id")).alias("_ids")
    )
    return (
        sentences.withColumn("_ids", lookup.scalar())
        .withColumn("label_ids", F.transform(labels, lambda x: F.element_at(F.col("_ids"), x)))
        .drop("_ids")
    )


def entity_types(inventory: DataFrame) -> DataFrame:
    """One row with the sorted entity types."""
    return inventory.agg(F.sort_array(F.collect_set("type")).alias("answer_choices"))


def ner_instructions(
    sentences: DataFrame,
    split: str,
    key: str = "sent_id",
    chars: str = "chars",
    labels: str = "labels",
    legacy_prefix: bool = False,
    templates: list[str] = ENTITY_QUESTIONS,
) -> DataFrame:
    """Instruction rows of tagged sentences."""
    choices = entity_types(label_inventory(sentences, labels))
    joined = sentences.withColumn("answer_choices", choices.scalar())
    text = F.array_join(chars, "")
    return joined.select(
        F.concat(F.lit(f"f{split}_"), F.col(key).cast("string")).alias("sample_id"),
        fill_template(pick_template(key, templates), text, "answer_choices").alias("input"),
        F.lit("ner").alias("task_type"),
        F.lit("custom_data").alias("task_dataset"),
        "answer_choices",
        ner_target(bio_spans(chars, labels, legacy_prefix)).alias("target"),
    )
