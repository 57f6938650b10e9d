"""Document checks over normalised facts and paragraphs: a long table of findings, never a parse of files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmeter.scratch import dealt

#: Pages up to which a document needs no bookmarks.
LONG_DOCUMENT = 20


def _passes() -> dict[str, Column]:
    """By rule, when a document passes; null facts fail."""
    return {
        "doc-accessibility-permission": F.col("assistive_access"),
        "doc-not-image-only": F.col("text_pages") > 0,
        "doc-tagged": F.col("has_tags"),
        "doc-language": F.trim("lang") != "",
        "doc-display-title": F.col("display_title") & (F.trim("title") != ""),
        "doc-bookmarks": (F.col("pages") <= LONG_DOCUMENT) | F.col("has_outline"),
        "page-tab-order": F.col("pages_in_tab_order") == F.col("pages"),
        "page-no-flicker": F.col("flicker_objects") == 0,
        "page-no-scripts": F.col("scripts") == 0,
        "page-no-timed-responses": F.col("timed_actions") == 0,
    }


def document_checks(facts: DataFrame) -> DataFrame:
    """facts (a row a document) to doc_id, rule_id, status Passed or Failed: one row a rule, by one pass."""
    rows = F.array(*[F.struct(F.lit(k).alias("rule_id"), F.when(F.coalesce(v, F.lit(False)), "Passed").otherwise("Failed").alias("status")) for k, v in _passes().items()])
    return facts.select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.rule_id", "r.status")


def untagged(content: DataFrame, tagged: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Content, annotations, media or fields that no tag names."""
    return content.join(tagged.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(rule).alias("rule_id"))


def repeated_links(links: DataFrame, most: int = 1) -> DataFrame:
    """links(doc_id, page, text, target): texts on a page that lead to several targets."""
    out = links.where(F.trim("text") != "").groupBy("doc_id", "page", F.lower(F.trim("text")).alias("text")).agg(F.countDistinct("target").alias("targets"))
    return out.where(F.col("targets") > most)


def irregular_tables(cells: DataFrame, most_span: int = 1000) -> DataFrame:
    """cells(doc_id, table, row, col_span, row_span): tables whose rows cover different numbers of columns, row spans carried down; absurd spans count as 1."""
    span = lambda c: F.when(F.col(c).between(1, most_span), F.col(c)).otherwise(1)
    rows = dealt(cells.select("doc_id", "table", "row", span("col_span").alias("w"), span("row_span").alias("h")).where("doc_id is not null and table is not null"), "doc_id")
    last = F.max("row").over(Window.partitionBy("doc_id", "table"))
    covered = rows.withColumn("last", last).withColumn("row", F.explode(F.sequence(F.col("row"), F.least(F.col("row") + F.col("h") - 1, F.col("last")))))
    widths = covered.groupBy("doc_id", "table", "row").agg(F.sum("w").alias("width"))
    return widths.groupBy("doc_id", "table").agg(F.min("width").alias("narrowest"), F.max("width").alias("widest")).where("narrowest <> widest")


BULLETS = ["•", "-", "*"]
COLOURS = ["red", "green", "blue", "yellow", "orange", "purple", "pink"]
COLOURED_THINGS = ["text", "item", "items", "entries", "values", "field", "fields", "cell", "cells"]


def typed_bullet(text: Column) -> Column:
    """Whether a paragraph opens with a bullet sign or a number and a full stop or bracket, and goes on after it."""
    words = F.split(F.btrim(text, F.lit(" \t\n\r\x0b\x0c")), r"\s+")
    opening = F.get(words, F.lit(0))
    return (F.get(words, F.lit(1)) != "") & (opening.isin(*BULLETS) | opening.rlike(r"^\d+[.)]$"))


def told_by_colour(text: Column) -> Column:
    """Whether a colour's name stands after "in" or before a word for what is coloured."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\w+"), F.lit(0))
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: ((a == "in") & b.isin(*COLOURS)) | (a.isin(*COLOURS) & b.isin(*COLOURED_THINGS)))
    return F.exists(pairs, lambda hit: F.coalesce(hit, F.lit(False)))


def paragraph_findings(paragraphs: DataFrame) -> DataFrame:
    """paragraphs(doc_id, seq, text, level, is_heading, numbered, coloured) to doc_id, rule, seq.

    A heading missing altogether has a null seq; a first heading below level 1 is a skip.
    """
    by = Window.partitionBy("doc_id").orderBy("seq")
    text = F.coalesce("text", F.lit(""))

    def found(df: DataFrame, rule: str) -> DataFrame:
        return df.select("doc_id", F.lit(rule).alias("rule"), F.col("seq").cast("int").alias("seq"))

    none = paragraphs.groupBy("doc_id").agg(F.bool_or("is_heading").alias("any")).where("not any").withColumn("seq", F.lit(None))
    levels = paragraphs.where("level is not null").withColumn("before", F.coalesce(F.lag("level").over(by), F.lit(0)))
    opening = paragraphs.where(F.trim(text) != "").withColumn("k", F.row_number().over(by)).where("k = 1 and not is_heading")
    parts = [
        found(none, "headings_present"),
        found(levels.where("level > before + 1"), "heading_skip"),
        found(opening, "opens_without_heading"),
        found(paragraphs.where(F.coalesce(typed_bullet(text), F.lit(False)) & ~F.col("numbered")), "manual_bullet"),
        found(paragraphs.where(told_by_colour(text) & F.col("coloured")), "colour_only"),
    ]
    return reduce(DataFrame.unionByName, parts)


def table_header_findings(rows: DataFrame) -> DataFrame:
    """rows(doc_id, table, row, is_header, has_merged): first rows without a header mark or with merged cells."""
    first = rows.groupBy("doc_id", "table").agg(F.min_by(F.struct("is_header", "has_merged"), "row").alias("f")).select("doc_id", "table", "f.*")
    rule = F.array_compact(F.array(F.when(~F.coalesce("is_header", F.lit(False)), "header_unmarked"), F.when(F.col("has_merged"), "header_merged")))
    return first.select("doc_id", "table", F.explode(rule).alias("rule"))


def ratio_score(items: DataFrame, key: str, ok: Column, least: float, empty: float = 1.0, keys: DataFrame | None = None) -> DataFrame:
    """The judges' common shape: share of items that are ok, and whether it reaches ``least``; documents of ``keys`` without items score ``empty`` and don't apply."""
    out = items.groupBy(key).agg(F.count(F.lit(1)).alias("items"), F.count_if(ok).alias("good"))
    out = out.join(keys.select(key).distinct(), key, "right").na.fill(0, ["items", "good"]) if keys is not None else out
    score = F.when(F.col("items") == 0, F.lit(empty)).otherwise(F.round(F.col("good") / F.col("items"), 4))
    return out.select(key, "items", "good", score.alias("score"), (F.col("items") > 0).alias("applicable"), (score >= least).alias("passed"))
