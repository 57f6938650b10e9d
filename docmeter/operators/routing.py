"""Predicates that route rules, files and pages, and small verdicts over facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FONT_CLAUSE = "7.21"
#: Layouts that may need a second reading of the page image, and those that never do. Fixed values.
COMPLEX_LAYOUTS = ["brochure_sidebar", "schedule_grid", "mixed_graphic_flyer", "map_infographic", "unknown_complex", "hero_cover", "report_cover"]
PLAIN_LAYOUTS = ["single_column", "form_checklist", "table_directory"]
#: Failed checks that don't keep a reader from the content. Fixed values.
COSMETIC_CHECKS = ["doc-display-title", "page-tab-order", "doc-bookmarks", "page-char-encoding"]


def clean_rule(raw: Column) -> Column:
    """A rule id without its path and without the standard's name."""
    return F.regexp_replace(F.element_at(F.split(F.coalesce(raw, F.lit("")), "/"), -1), r"^ISO\s+\d+-\d+:\d+-", "")


def under_rule(rule: Column, clause: Column) -> Column:
    """The same rule or a part of it after a dot: 7.1-1.2 is under 7.1-1, 7.1-11 isn't."""
    return (rule == clause) | rule.startswith(F.concat(clause, F.lit(".")))


def routed(violations: DataFrame, clauses: Sequence[str], rule: str = "rule_id") -> DataFrame:
    """Adds route: rules under one of the (few) clauses are deterministic, others need judgement."""
    r = clean_rule(F.col(rule))
    hit = F.exists(F.array(*[F.lit(c) for c in clauses]), lambda c: under_rule(r, c)) if clauses else F.lit(False)
    return violations.withColumn("route", F.when(hit, "deterministic").otherwise("judgement"))


def only_font_clauses(ids: Column) -> Column:
    """Of an array of rule ids: some aren't empty, and all of those are font clauses."""
    named = F.filter(ids, lambda x: F.coalesce(x, F.lit("")) != "")
    return (F.size(named) > 0) & F.forall(named, lambda x: x.startswith(FONT_CLAUSE))


def oversize(pages: Column, size: Column, most_pages: int, most_mb: float) -> Column:
    """Why a file is too large, pages first; null if it isn't. A limit of 0 is none."""
    mb = size / (1024 * 1024)
    too_long = (pages > most_pages) if most_pages else F.lit(False)
    too_big = (mb > most_mb) if most_mb else F.lit(False)
    return F.when(too_long, "pages").when(too_big, "size")


def page_skip(blocks: Column, chars: Column, coverage: Column) -> Column:
    """Why a page needs no look; null if it does."""
    return F.when((blocks == 0) & (coverage < 0.05), "blank").when((chars < 10) & (coverage < 0.05), "near_blank")


def needs_second_reading(df: DataFrame) -> Column:
    """layout_class, requires_rebuild, structure_warning, visual_blocks, text_nodes, image_coverage, small_text: whether to escalate; rules in order."""
    few = (F.col("visual_blocks") >= 8) & (F.col("text_nodes") <= 2)
    complex_ = F.col("layout_class").isin(*COMPLEX_LAYOUTS) & (F.col("visual_blocks") >= 6) & (F.col("text_nodes") <= 3)
    return (
        F.when(F.col("requires_rebuild") | F.col("structure_warning"), True).when(F.col("layout_class").isin(*PLAIN_LAYOUTS), False)
        .otherwise(few | complex_ | ((F.col("image_coverage") >= 0.35) & F.col("small_text")))
    )


def head_to_head(pairs: DataFrame) -> DataFrame:
    """pairs with a_ and b_ conformance, edits, seconds: which is better and by what; conformance counts beyond 0.01, seconds beyond 5."""
    rate, edits, seconds = (F.col(f"a_{c}") - F.col(f"b_{c}") for c in ("conformance", "edits", "seconds"))
    verdict = (
        F.when(rate > 0.01, "a:conformance").when(rate < -0.01, "b:conformance").when(edits < 0, "a:edits").when(edits > 0, "b:edits")
        .when(seconds < -5, "a:seconds").when(seconds > 5, "b:seconds").otherwise("none")
    )
    return pairs.withColumn("better", verdict)


def conformance(checks: DataFrame, facts: DataFrame) -> DataFrame:
    """checks(doc_id, rule_id, status), facts(doc_id, openable, passed, reader_errors, fonts_only, tools_failed, warnings): conformant, partially or not."""
    bad = F.col("status") != "Passed"
    failed = checks.groupBy("doc_id").agg(F.count_if(bad).alias("failed"), F.count_if(bad & ~F.col("rule_id").isin(*COSMETIC_CHECKS)).alias("blocking"))
    both = facts.join(failed, "doc_id", "left").na.fill(0, ["failed", "blocking"])
    clean = (F.col("blocking") == 0) & (F.col("reader_errors") == 0) & F.col("fonts_only") & ~F.col("tools_failed")
    verdict = (
        F.when(~F.col("openable"), "not").when(F.col("passed") & (F.col("warnings") == 0), "conformant").when(clean, "conformant").when(F.col("warnings") > 0, "partially")
        .when(F.col("fonts_only") & (F.col("failed") <= 3) & (F.col("reader_errors") <= 2), "partially").otherwise("not")
    )
    return both.select("doc_id", "failed", "blocking", verdict.alias("conformance"))


def text_intact(before: Column, after: Column) -> Column:
    """Whether a rewrite kept a page's text: at least 80 % of its length, at most a tenth of positions changed, decimals of percentages kept."""
    a, b = F.trim(before), F.trim(after)
    n = F.least(F.length(a), F.length(b))
    changed = F.size(F.filter(F.zip_with(F.split(F.substring(a, F.lit(1), n), ""), F.split(F.substring(b, F.lit(1), n), ""), lambda x, y: x != y), lambda d: d))
    decimals = [F.regexp_count(x, F.lit(r"\b\d{1,3}\.\d+%")) for x in (a, b)]
    bad = (F.length(b) < 0.8 * F.length(a)) | ((n > 0) & (changed > 0.1 * n)) | ((decimals[0] >= 5) & (decimals[1] < 0.5 * decimals[0]))
    return F.when(F.coalesce(a, F.lit("")) == "", True).otherwise(~F.coalesce(bad, F.lit(True)))


def smaller_violations(before: Column, after: Column) -> Column:
    """Whether the ids after are a strict subset of those before."""
    return (F.size(F.array_except(after, before)) == 0) & (F.size(F.array_except(before, after)) > 0)


def slide_titles(slides: DataFrame) -> DataFrame:
    """slides(doc_id, slide, title, has_placeholder): issue and score 1, 0.6 for a repeated title, 0."""
    norm = F.lower(F.trim(F.regexp_replace(F.coalesce("title", F.lit("")), r"\s+", " ")))
    rows = slides.withColumn("_t", norm).withColumn("_own", F.when(~F.col("has_placeholder"), "missing_placeholder").when(norm == "", "empty_title"))
    same = F.count(F.when(F.col("_own").isNull(), 1)).over(Window.partitionBy("doc_id", "_t"))
    rows = rows.withColumn("issue", F.coalesce("_own", F.when(same > 1, "repeated_title")))
    return rows.withColumn("score", F.when(F.col("issue").isNull(), 1.0).when(F.col("issue") == "repeated_title", 0.6).otherwise(0.0)).drop("_t", "_own")
