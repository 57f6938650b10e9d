"""What a reader of a document meets: transcripts, headings, blocks, alternatives, tables, sheets, slides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmeter.operators.checks import ratio_score
from docmeter.operators.text import generic_alt, squeezed


def heading_navigation(nodes: DataFrame, least: float = 0.85) -> DataFrame:
    """1 - issues / headings per document. nodes: doc_id, seq, level (null: an unnumbered heading, an issue that leaves the state as it is)."""
    by = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = nodes.withColumn("before", F.last("level", ignorenulls=True).over(by))
    issue = F.col("level").isNull() | F.coalesce(F.col("level") > F.col("before") + 1, F.lit(False))
    return ratio_score(rows, "doc_id", ~issue, least)


def reading_comprehension(findings: DataFrame, documents: DataFrame, least: float = 0.9) -> DataFrame:
    """1 - 0.5 an error - 0.1 a warning, not below 0. findings: doc_id, severity."""
    n = findings.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = documents.select("doc_id").distinct().join(n, "doc_id", "left").na.fill(0, ["errors", "warnings"])
    score = F.round(F.greatest(F.lit(0.0), 1 - 0.5 * F.col("errors") - 0.1 * F.col("warnings")), 4)
    return out.select("doc_id", "errors", "warnings", score.alias("score"), (score >= least).alias("passed"))


def alt_substitution(figures: DataFrame, least: float = 0.8, shortest: int = 10) -> DataFrame:
    """Share of figures whose alternative says something (long enough, not generic) and isn't another figure's of the document."""
    t = F.lower(squeezed(F.col("alt_text")))
    each = figures.select("doc_id", t.alias("t"), ((F.length(t) >= shortest) & ~generic_alt(F.col("alt_text"))).alias("ok")).groupBy("doc_id", "t", "ok").agg(F.count(F.lit(1)).alias("n"))
    out = each.groupBy("doc_id").agg(F.sum("n").alias("figures"), F.count_if("ok").alias("good"))
    score = F.round(F.col("good") / F.col("figures"), 4)
    return out.select("doc_id", "figures", "good", score.alias("score"), (score >= least).alias("passed"))


def alt_coverage(figures: DataFrame, documents: DataFrame) -> DataFrame:
    """Percentage of figures with an alternative, to a digit; null without figures."""
    n = figures.groupBy("doc_id").agg(F.count(F.lit(1)).alias("figures"), F.count_if(F.trim(F.coalesce("alt_text", F.lit(""))) != "").alias("described"))
    return documents.select("doc_id").distinct().join(n, "doc_id", "left").select("doc_id", F.round(F.try_divide(100 * F.col("described"), F.col("figures")), 1).alias("coverage"))


def repeated_blocks(lines: DataFrame, least: int = 3, least_chars: int = 40, least_words: int = 5) -> DataFrame:
    """Texts that a page holds ``least`` times or more, long enough to be content."""
    t = squeezed(F.col("text"))
    rows = lines.select("doc_id", "page", t.alias("block")).where((F.length("block") >= least_chars) & (F.size(F.split("block", " ")) >= least_words))
    return rows.groupBy("doc_id", "page", "block").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= least)


def markdown_blocks(text: Column) -> Column:
    """Array of (n, role, block): blocks between blank lines; a table rule of bars outranks a heading mark."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"\n\s*\n"), lambda b: F.trim(b) != "")
    role = lambda b: F.when(F.contains(b, F.lit("|")), "table").when(F.startswith(F.ltrim(b), F.lit("#")), "heading").otherwise("paragraph")
    return F.transform(parts, lambda b, i: F.struct(i.alias("n"), role(b).alias("role"), b.alias("block")))


def sentence_candidates(text: Column, least_words: int = 6, most: int = 10) -> Column:
    """The first ``most`` sentences of at least ``least_words`` words."""
    parts = F.split(squeezed(text), r"(?<=[.!?]) ")
    return F.slice(F.filter(parts, lambda s: F.size(F.split(s, " ")) >= least_words), 1, most)


def header_key(text: Column) -> Column:
    """Lower case, other characters than letters and digits as single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def common_prefix(names: Column, least: int = 4) -> Column:
    """The longest beginning that all names of an array share, which is that of the least and the greatest; empty below ``least`` characters."""
    return shared_beginning(F.array_min(names), F.array_max(names), least)


def shared_beginning(a: Column, b: Column, least: int = 4) -> Column:
    """The longest beginning of two texts; empty below ``least`` characters or where one is null."""
    cuts = F.sequence(F.least(F.length(a), F.length(b)), F.lit(0), F.lit(-1))
    found = F.get(F.filter(cuts, lambda k: F.substr(a, F.lit(1), k) == F.substr(b, F.lit(1), k)), F.lit(0))
    return F.when(found >= least, F.substr(a, F.lit(1), found)).otherwise("")


def common_prefixes(rows: DataFrame, by: str, name: str, least: int = 4) -> DataFrame:
    """by, prefix: the longest beginning that a group's names share; groups shrink to two names before they meet."""
    ends = rows.groupBy(by).agg(F.min(name).alias("lo"), F.max(name).alias("hi"))
    return ends.select(by, shared_beginning(F.col("lo"), F.col("hi"), least).alias("prefix"))


def announced(line: Column) -> Column:
    """What stays of a transcript line without its role words."""
    return F.trim(F.regexp_replace(F.lower(squeezed(line)), r"\b(link|button|heading|level \d|graphic|image|edit|checkbox|list item)\b", " "))


def transcript_findings(lines: DataFrame) -> DataFrame:
    """lines: doc_id, seq, text, level (of an announced heading). Long table of unlabelled objects, vague links and heading jumps."""
    t, said = F.lower(squeezed(F.col("text"))), announced(F.col("text"))
    by = Window.partitionBy("doc_id").orderBy("seq")
    heads = lines.where("level is not null").withColumn("before", F.lag("level").over(by)).where("level > before + 1")

    def rows(df: DataFrame, rule: str) -> DataFrame:
        return df.select("doc_id", "seq", F.lit(rule).alias("rule"))

    out = rows(lines.where(t.rlike(r"\b(graphic|image|button|edit|checkbox)\b") & (said == "")), "unlabelled")
    out = out.unionByName(rows(lines.where(t.rlike(r"\blink\b") & said.isin("", "here", "click here", "more", "read more")), "vague_link"))
    return out.unionByName(rows(heads, "heading_jump"))


def overlap_ratio(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> Column:
    """Share of the shorter of two spans that lies in both."""
    both = F.greatest(F.lit(0.0), F.least(a_hi, b_hi) - F.greatest(a_lo, b_lo))
    return F.coalesce(F.try_divide(both, F.least(a_hi - a_lo, b_hi - b_lo)), F.lit(0.0))


def slide_backtracking(boxes: DataFrame, least: float = 0.25) -> DataFrame:
    """boxes: doc_id, page, idx, left, bottom, right, top. Neighbours in reading order of which the second lies above or left of the first in the same column or row."""
    by = Window.partitionBy("doc_id", "page").orderBy("idx")
    rows = boxes.select("*", *[F.lag(c).over(by).alias(f"p_{c}") for c in ("left", "bottom", "right", "top")]).where("p_left is not null")
    column = overlap_ratio(F.col("left"), F.col("right"), F.col("p_left"), F.col("p_right")) >= least
    row = overlap_ratio(F.col("bottom"), F.col("top"), F.col("p_bottom"), F.col("p_top")) >= least
    back = (column & (F.col("bottom") >= F.col("p_top"))) | (row & (F.col("right") <= F.col("p_left")))
    return rows.where(back).select("doc_id", "page", "idx")


def sampled_pages(pages: Column, budget: int = 10, long: int = 50, long_budget: int = 2) -> Column:
    """Evenly spread page numbers, first and last among them; all pages within the budget."""
    n = F.when(pages > long, long_budget).otherwise(F.least(pages, F.lit(budget)))
    spread = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (1 + F.bround(i * (pages - 1) / F.greatest(n - 1, F.lit(1)))).cast("int"))
    return F.when(pages >= 1, F.array_distinct(spread)).otherwise(F.array().cast("array<int>"))


def criterion_code(text: Column) -> Column:
    """The first success criterion number (like 1.4.3) in a text; empty if there is none."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"\b([1-4]\.\d{1,2}\.\d{1,2})\b", 1)


def lookup_tables(tables: DataFrame, least: float = 0.95) -> DataFrame:
    """tables: doc_id, table, rows, columns, header_cells, filled_cells. Share of tables a cell can be looked up in; blank grids to be filled in don't count."""
    real = tables.where(~((F.col("filled_cells") <= F.col("header_cells")) & (F.col("rows") * F.col("columns") > 4)))
    return ratio_score(real, "doc_id", (F.col("header_cells") > 0) & (F.col("rows") > 1), least, keys=tables)


def tag_assertion(nodes: DataFrame, expected: DataFrame) -> DataFrame:
    """Tags whose number in a document isn't the expected one. expected: doc_id, tag, n."""
    found = nodes.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("found"))
    both = expected.join(found, ["doc_id", "tag"], "full_outer")
    return both.select("doc_id", "tag", F.coalesce("n", F.lit(0)).cast("long").alias("expected"), F.coalesce("found", F.lit(0)).alias("found")).where("expected <> found")
