"""Rules over whole texts: duplication, similarity, trust, link and alternative text, readability."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Link texts that say nothing, by vocabulary. Fixed values.
GENERIC_LINKS = {
    "judge": ["click here", "here", "read more", "more", "learn more", "download", "link", "this link", "visit website", "website"],
    "html": [
        "click here", "here", "read more", "more", "learn more", "link", "this link", "go", "details", "more details", "more info",
        "more information", "info", "download", "download here", "view", "view more", "see more", "continue", "continue reading",
        "full article", "full story",
    ],
}
LEAST_LINE = 20


def squeezed(text: Column) -> Column:
    """White space of any kind (NBSP too) as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def text_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, line: non-empty squeezed lines."""
    lines = df.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "raw"))
    return lines.select(key, "line_no", squeezed(F.col("raw")).alias("line")).where("line <> ''")


def duplicate_content_ratio(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Share of characters in repeated copies of lines of 20 characters or more; computed inside the row."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), squeezed), lambda x: x != "")
    rows = df.select(key, lines.alias("_lines")).withColumn("_long", F.filter("_lines", lambda x: (F.length(x) >= LEAST_LINE) & ~x.startswith("[Form:")))
    total = F.aggregate("_lines", F.lit(0), lambda a, x: a + F.length(x))
    long, distinct = (F.aggregate(c, F.lit(0), lambda a, x: a + F.length(x)) for c in (F.col("_long"), F.array_distinct("_long")))
    return rows.select(key, total.alias("total_chars"), (long - distinct).alias("redundant_chars"), F.when(total > 0, F.round((long - distinct) / total, 6)).otherwise(0.0).alias("ratio"))


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 3) -> DataFrame:
    """Lines of 20 characters or more that occur ``least`` times once adjacent copies collapse."""
    lines = text_lines(df, key, text)
    before = F.lag("line").over(Window.partitionBy(key).orderBy("line_no"))
    collapsed = lines.withColumn("_b", before).where(F.col("_b").isNull() | (F.col("_b") != F.col("line")))
    long = collapsed.where((F.length("line") >= LEAST_LINE) & ~F.col("line").startswith("[Form:"))
    return long.groupBy(key, "line").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= least)


def sentence_set(text: Column) -> Column:
    """Distinct lower-case sentences without leading bullets."""
    parts = F.split(squeezed(text), r"(?<=[.!?])\s+")
    clean = F.transform(parts, lambda s: F.lower(F.trim(F.regexp_replace(s, r"^[•\-*]\s*", ""))))
    return F.array_distinct(F.filter(clean, lambda s: (s != "") & (s != "•")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct items; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def containment(reference: Column, candidate: Column) -> Column:
    return F.when(F.size(reference) == 0, 0.0).otherwise(F.size(F.array_intersect(reference, candidate)) / F.size(reference))


def token_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), 0))


def contained_items(docs: DataFrame, items: DataFrame, least: float = 0.8, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """key, item, overlap of each document row and item of which the row's text holds a share ``least`` of distinct tokens, over all pairs. Items without tokens are in none.

    Tokens are joined and counted per document row (told apart by a running id, so repeated keys don't mix); Spark's size check decides whether the items' tokens are broadcast.
    """
    tokens = items.select(item, token_set(F.col(text)).alias("_a"))
    tokens = tokens.select(item, F.size("_a").alias("_n"), F.explode("_a").alias("_token"))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), key, token_set(F.col(text)).alias("_t"))
    words = rows.select("_row", key, F.explode("_t").alias("_token"))
    shared = words.join(tokens, "_token").groupBy("_row", key, item, "_n").agg(F.count(F.lit(1)).alias("_k"))
    return shared.where(F.col("_k") >= least * F.col("_n")).select(key, item, F.round(F.col("_k") / F.col("_n"), 6).alias("overlap"))


def word_fidelity(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Share of words (with repeats) that an edit kept: 1 - lost / words before, at least one."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        words = df.select(key, F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))).alias("word"))
        return words.groupBy(key, "word").agg(F.count(F.lit(1)).alias(name))

    both = counts(before, "_b").join(counts(after, "_a"), [key, "word"], "left")
    lost = both.groupBy(key).agg(F.sum(F.greatest(F.lit(0), F.col("_b") - F.coalesce("_a", F.lit(0)))).alias("lost"), F.sum("_b").alias("total"))
    out = before.select(key).distinct().join(lost, key, "left")
    total = F.greatest(F.coalesce("total", F.lit(0)), F.lit(1))
    return out.select(key, F.coalesce("lost", F.lit(0)).alias("lost_words"), F.round(1 - F.coalesce("lost", F.lit(0)) / total, 6).alias("fidelity"))


def suspicious(text: Column) -> Column:
    """A bullet or number sign between letters, three of them at least, or a dozen words cut into single letters: signs of a broken glyph map."""
    t = F.coalesce(text, F.lit(""))
    chunks = F.split(t, "[^A-Za-z0-9_#•]+")
    inside = F.exists(chunks, lambda w: (F.length(w) >= 4) & w.rlike("^[A-Za-z]+[#•][A-Za-z]+$"))
    singles = F.filter(F.split(t, r"\s+"), lambda w: (F.length(w) == 1) & w.rlike("[B-HJ-Zb-hj-z]"))
    return inside | (F.size(singles) >= 12)


def trust_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, facts and ``trustworthy``: whether extracted text will do for assistive use."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(key, t.alias("_t"), squeezed(t).alias("_s"))
    rows = rows.select(
        key,
        F.length("_s").alias("n_chars"),
        F.regexp_count("_t", F.lit("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]")).alias("n_control"),
        F.regexp_count("_s", F.lit("\\p{L}")).alias("n_letters"),
        F.regexp_count("_s", F.lit("[\\p{L}\\p{Nd}]")).alias("n_alnum"),
        F.regexp_count("_s", F.lit("[A-Za-z]{3,}")).alias("n_words"),
        F.regexp_count("_s", F.lit("\\b\\d+\\)")).alias("n_items"),
        F.regexp_count("_s", F.lit("\\b\\d+")).alias("n_numbers"),
        F.contains("_t", F.lit("�")).alias("has_replacement"),
        suspicious(F.col("_t")).alias("is_suspicious"),
    )
    sheet = (F.col("n_chars") >= 80) & (F.col("n_words") >= 3) & (F.col("n_numbers") >= 10) & (F.col("n_items") >= 8)
    few_letters = (F.col("n_chars") >= 80) & ((F.col("n_alnum") == 0) | (F.col("n_letters") / F.greatest("n_alnum", F.lit(1)) < 0.45)) & ~sheet
    few_words = (F.col("n_chars") >= 80) & (F.col("n_words") < 6) & ~sheet
    control = F.col("n_control") > F.greatest(F.lit(2), F.floor(F.col("n_chars") / 1000))
    bad = (F.col("n_chars") == 0) | F.col("is_suspicious") | F.col("has_replacement") | control | few_letters | few_words
    return rows.withColumn("trustworthy", ~bad)


def descriptive_link(text: Column, target: Column, vocabulary: str = "judge") -> Column:
    """Whether a link's text says where it goes without its surroundings."""
    t, goal = F.lower(squeezed(text)), F.regexp_replace(F.lower(F.trim(F.coalesce(target, F.lit("")))), "/+$", "")
    raw = t.rlike(r"^((https?://|www\.)\S+|[a-z0-9][a-z0-9.-]*\.[a-z]{2,}(/\S*)?)$")
    same = (goal != "") & (F.regexp_replace(t, "/+$", "") == goal)
    return (t != "") & ~t.isin(*GENERIC_LINKS[vocabulary]) & ~raw & ~same & (F.length(t) >= 4)


#: Kinds that a placeholder names, endings that stay generic in two words, verbs after which a phrase stops short, file endings. Fixed values.
ALT_KINDS = ["figure", "image", "img", "picture", "photo", "graphic"]
ALT_ENDINGS = ["image", "photo", "picture", "graphic", "figure", "chart", "diagram", "logo", "icon"]
ALT_VERBS = ["showing", "depicting", "displaying", "shows", "contains", "of"]
ALT_FILES = ["png", "jpg", "jpeg", "gif", "bmp", "tif", "tiff", "svg", "webp", "pdf"]


def generic_alt(alt: Column) -> Column:
    """Placeholder alternative text: empty, a file name or path, a kind with a number, a phrase that stops short, or two words ending in a kind."""
    t = F.lower(squeezed(alt))
    words = F.split(t, " ")
    n, first, second = F.size(words), F.get(words, F.lit(0)), F.get(words, F.lit(1))
    file = (n == 1) & F.contains(t, F.lit(".")) & F.element_at(F.split(t, r"\."), -1).isin(*ALT_FILES) & (F.length(F.substring_index(t, ".", 1)) > 0)
    path = (n == 1) & (F.length(t) > 1) & (t.startswith("/") | t.startswith("file:") | t.startswith("\\\\") | (F.substring(t, 2, 2) == ":\\"))
    kind = F.regexp_replace(t, "[0-9 ]+$", "").isin(*ALT_KINDS) & (n <= 2)
    phrase = F.when(first == "a", F.slice(words, 2, 9)).otherwise(words)
    short = (F.size(phrase) == 2) & F.get(phrase, F.lit(0)).isin(*ALT_KINDS, "chart", "diagram", "graph", "table") & F.get(phrase, F.lit(1)).isin(*ALT_VERBS)
    ending = (F.length(t) < 15) & (n <= 2) & F.exists(F.array(*[F.lit(e) for e in ALT_ENDINGS]), lambda e: t.endswith(e))
    return (t == "") | file | path | kind | F.coalesce(short, F.lit(False)) | ending


def alt_scores(alts: DataFrame, key: str, alt: str) -> DataFrame:
    """Per key: objects, described, reused, score = (described - reused) / objects; without objects 1."""
    norm = F.lower(squeezed(F.col(alt)))
    good = ~generic_alt(F.col(alt))
    each = alts.select(key, norm.alias("_t"), good.alias("_g")).groupBy(key, "_t", "_g").agg(F.count(F.lit(1)).alias("_n"))
    out = each.groupBy(key).agg(F.sum("_n").alias("objects"), F.sum(F.when(F.col("_g"), F.col("_n")).otherwise(0)).alias("described"), F.sum(F.when(F.col("_g"), F.col("_n") - 1).otherwise(0)).alias("reused"))
    return out.withColumn("score", F.round((F.col("described") - F.col("reused")) / F.col("objects"), 4))


def page_similarity_class(df: DataFrame) -> DataFrame:
    """Type of a document by its violations' leading clause: shares in a fixed order, then size, then variety."""
    n, t = F.col("total"), lambda *c: sum((F.coalesce(F.col(x), F.lit(0)) for x in c), F.lit(0))
    kind = (
        F.when(n == 0, "simple").when(t("tables") / n > 0.5, "table_heavy").when(t("structure") / n > 0.5, "untagged_content").when(t("ordering") / n > 0.3, "reading_order")
        .when(t("figures") / n > 0.3, "figure_alt").when((F.col("pages") > 10) | (n > 20), "complex").when(F.col("kinds") >= 3, "mixed_structure").otherwise("simple")
    )
    return df.withColumn("document_type", kind)


#: Most points of each part of a reader's score, and the rules whose findings cost points. Fixed values.
POINTS = {"text": 30.0, "tags": 25.0, "alternatives": 20.0, "headings": 15.0, "tables": 10.0}
HEADING_RULES = ["sr-heading-skip", "sr-no-headings", "sr-heading-start"]
TABLE_RULES = ["sr-table-no-headers", "sr-list-no-items"]


def reader_readability(texts: DataFrame, nodes: DataFrame, findings: DataFrame) -> DataFrame:
    """doc_id, text, tags, alternatives, headings, tables, score: how well a document reads aloud, 0 to 100, to a digit.

    texts: doc_id, pages, text. nodes: doc_id, page, tag, alt_text. findings: doc_id, rule_id, severity.

    * text: 30 by the share of characters that can be printed, or are line breaks, tabs or blanks; all without text,
    * tags: 25 by the share of pages with tags and, up to three, the tags a page,
    * alternatives: 20 by the share of figures and images with more than 10 characters; all without figures,
    * headings: 15 less 5 an error, 2 a warning of heading rules; tables: 10 less 5 an error of table and list rules.
    """
    text = F.coalesce("text", F.lit(""))
    printed = F.length(text) - F.regexp_count(text, F.lit(r"[\p{C}\p{Z}&&[^ \n\t\r]]"))
    figure = F.col("tag").isin("Figure", "Image")
    tags = nodes.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_distinct("page").alias("tagged"), F.count_if(figure).alias("figures"), F.count_if(figure & (F.length(F.coalesce("alt_text", F.lit(""))) > 10)).alias("described")
    )
    level, rule = F.lower("severity"), F.col("rule_id")
    costs = findings.groupBy("doc_id").agg(
        F.sum(F.when(rule.isin(*HEADING_RULES), F.when(level == "error", 5.0).when(level == "warning", 2.0).otherwise(0.0)).otherwise(0.0)).alias("heading_cost"),
        F.sum(F.when(rule.isin(*TABLE_RULES) & (level == "error"), 5.0).otherwise(0.0)).alias("table_cost"),
    )
    known = texts.join(tags, "doc_id", "left").join(costs, "doc_id", "left").fillna(0, ["nodes", "tagged", "figures", "described", "heading_cost", "table_cost"])
    pages = F.greatest(F.coalesce("pages", F.lit(1)), F.lit(1))
    parts = {
        "text": F.when(F.length(text) == 0, 1.0).otherwise(printed / F.length(text)) * POINTS["text"],
        "tags": F.least(F.lit(1.0), F.col("tagged") / pages) * F.least(F.lit(1.0), F.col("nodes") / pages / 3.0) * POINTS["tags"],
        "alternatives": F.when(F.col("figures") == 0, 1.0).otherwise(F.col("described") / F.col("figures")) * POINTS["alternatives"],
        "headings": F.greatest(F.lit(0.0), POINTS["headings"] - F.col("heading_cost")),
        "tables": F.greatest(F.lit(0.0), POINTS["tables"] - F.col("table_cost")),
    }
    total = sum(parts.values(), F.lit(0.0))
    return known.select("doc_id", *[F.round(c, 1).alias(n) for n, c in parts.items()], F.round(F.least(F.lit(100.0), total), 1).alias("score"))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _numbered_names(lists: pd.Series) -> pd.Series:
    def one(names) -> list[str]:
        used: set[str] = set()
        last: dict[str, int] = {}
        out = []
        for name in names:
            k = last.get(name, 1)
            new = name if k == 1 and name not in used else None
            while new is None:
                k += 1
                new = f"{name}-{k}" if f"{name}-{k}" not in used else None
            last[name] = k
            used.add(new)
            out.append(new)
        return out

    return lists.map(lambda x: None if x is None else one(x))


def unique_slugs(names: Column) -> Column:
    """Slugs of an array of headings in order; repeats get -2, -3 and on, never one that is taken already. About one step a heading."""
    return _numbered_names(F.transform(names, slug))


def heading_class(line: Column) -> Column:
    """What makes a line a heading: markdown, article, section, roman numeral, capitals; null if nothing does."""
    t = F.trim(line)
    return (
        F.when(t.rlike(r"^#{1,6}\s+\S"), "markdown").when(t.rlike(r"(?i)^article\s+[ivxlc\d]+"), "article").when(t.rlike(r"(?i)^section\s+\d+"), "section")
        .when(t.rlike(r"^[IVXLC]+\.\s+\S"), "roman").when(t.rlike(r"^[A-Z][A-Z0-9 ,&'-]{3,79}$"), "capitals")
    )


def json_in(text: Column) -> Column:
    """The JSON text inside a reply: fences stripped, else from the first bracket to the last; null if it doesn't parse."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    bare = F.regexp_extract(text, r"(?s)(\{.*\}|\[.*\])", 1)
    found = F.when(fenced != "", fenced).otherwise(bare)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)
