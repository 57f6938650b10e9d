"""Experiments, variants and calibrations as tables: reads, breakdowns, comparisons, lifecycle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmeter.operators.evaluation import LIFT_LEAST, REGRESSION_MOST, WEAK_BELOW, cohens_kappa

#: Share of the cap that the best of the frontier must be beaten by.
PROMOTE_BY = 0.05


def listed(df: DataFrame, order: Sequence[Column], **equal: object) -> DataFrame:
    """Rows that match the given values (None: any), in order. Only predicates that are given reach the scan."""
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df.orderBy(*order)


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key isn't named."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def created(df: DataFrame, state: str, stage: str) -> DataFrame:
    """New rows in their initial state."""
    return df.withColumns({"status": F.lit(state), "stage": F.lit(stage), "progress": F.lit(0.0), "error": F.lit(None).cast("string")})


def run_id(*parts: Column) -> Column:
    """SHA-256 of the parts, sorted and joined by a bar: the same whatever their order."""
    return F.sha2(F.array_join(F.sort_array(F.array(*[p.cast("string") for p in parts])), "|"), 256)


def model_family(model: Column) -> Column:
    """A model's name in lower case without the path before it, the tag after a colon, and a cloud suffix; models of one family aren't independent judges."""
    name = F.split(F.element_at(F.split(F.lower(F.trim(F.coalesce(model, F.lit("")))), "/"), -1), ":")[0]
    return F.regexp_replace(F.regexp_replace(name, "-cloud$", ""), "_cloud$", "")


def score_label(score: Column, least: float = WEAK_BELOW) -> Column:
    return F.when(score.isNull(), None).when(score >= least, "pass").otherwise("fail")


def format_dimension_means(scores: DataFrame) -> DataFrame:
    """Mean a dimension: keyed by format and dimension if there are several formats, else by dimension alone."""
    many = scores.agg((F.count_distinct("document_format") > 1).alias("many"))  # one row
    out = scores.groupBy("document_format", "dimension").agg(F.avg("score").alias("m"), F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(many))
    name = F.when(F.col("many"), F.concat_ws(":", "document_format", "dimension")).otherwise(F.col("dimension"))
    return out.select(name.alias("key"), F.round("m", 6).alias("mean_score"), "n")


def _mark(by: str, value: Column) -> Column:
    return F.struct(F.lit(by).alias("pattern"), value.cast("string").alias("value"))


#: Beginnings of behavioural tests' names and the quality dimension that they speak for; the first that fits counts. Fixed values.
TEST_DIMENSIONS = [
    ("alt_text", "alt_text"), ("reading_order", "reading_order"), ("slide_reading_order", "reading_order"), ("screen_reader", "reading_order"), ("heading", "heading_semantics"), ("table", "table_structure"),
    ("decorative", "decorative"), ("link", "link_text"), ("complex", "complex_content"), ("slide_title", "slide_title"), ("sheet", "sheet_organization"),
]


def dimension_of_test(name: Column) -> Column:
    """The dimension of a behavioural test; a name that begins like none is its own."""
    out = name
    for start, dimension in reversed(TEST_DIMENSIONS):
        out = F.when(name.startswith(start), dimension).otherwise(out)
    return out


def failure_patterns(experiments: DataFrame, least: float = WEAK_BELOW) -> DataFrame:
    """pattern, format, type, value, n, mean of a harness's experiments, the eleven ways to look at its failures in long form.

    Counts: ``failing_doc_types``, ``failing_violation_types``, ``common_errors`` over failed experiments, ``destructive_docs`` (more violations
    after than before), ``compliance_passes_quality_fails`` (passed, with weak dimensions; value: document, type: the dimension) and
    ``behavioral_proxy_failures_by_dim`` and ``..._by_format`` over all. Means below ``least``: ``weak_dimensions_overall``, ``..._by_doc_type``, ``..._by_format``, ``..._by_format_and_doc_type``;
    without a document type an experiment has no part in the two by type.

    experiments: document_id, document_format, document_type, passed, violations_before, violations_after, violation_types, error, quality_dimensions, behavioral_results.
    """
    e, failed = experiments, ~F.col("passed")
    nothing = F.lit(None).cast("string")

    def marks(name: str, values: Column, form: Column = nothing, kind: Column = nothing) -> DataFrame:
        return e.select(F.lit(name).alias("pattern"), form.alias("format"), kind.alias("type"), F.explode(values).alias("value"))

    one = lambda when, value: F.array_compact(F.array(F.when(when, value.cast("string"))))
    missed = F.transform(F.filter(F.map_entries("behavioral_results"), lambda x: ~x["value"]), lambda x: dimension_of_test(x["key"]))
    weak = F.filter(F.map_entries("quality_dimensions"), lambda x: x["value"] < least)
    good = e.where("passed").select(F.lit("compliance_passes_quality_fails").alias("pattern"), nothing.alias("format"), F.explode(F.transform(weak, lambda x: x["key"])).alias("type"), F.col("document_id").cast("string").alias("value"))
    counted = [
        marks("failing_doc_types", one(failed, F.col("document_type"))),
        marks("failing_violation_types", F.when(failed, F.col("violation_types"))),
        marks("common_errors", one(failed & (F.col("error") != ""), F.col("error"))),
        marks("destructive_docs", one(F.col("violations_after") > F.col("violations_before"), F.col("document_id"))),
        good,
        marks("behavioral_proxy_failures_by_dim", missed),
        marks("behavioral_proxy_failures_by_format", missed, F.col("document_format")),
    ]
    counts = reduce(DataFrame.unionByName, counted).groupBy("pattern", "format", "type", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("mean", F.lit(None).cast("double"))
    scores = e.select(F.col("document_format").alias("format"), F.col("document_type").alias("type"), F.explode("quality_dimensions").alias("value", "score"))
    by_format, by_type = F.grouping("format") == 0, F.grouping("type") == 0
    pattern = F.when(by_format & by_type, "weak_dimensions_by_format_and_doc_type").when(by_format, "weak_dimensions_by_format").when(by_type, "weak_dimensions_by_doc_type").otherwise("weak_dimensions_overall")
    means = scores.cube("format", "type", "value").agg(pattern.alias("pattern"), F.grouping("value").alias("all"), F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"))
    typed = ~F.col("pattern").endswith("doc_type") | (F.coalesce("type", F.lit("")) != "")
    means = means.where((F.col("all") == 0) & typed & (F.col("mean") < least))
    return counts.unionByName(means.select("pattern", "format", "type", "value", "n", F.round("mean", 4).alias("mean")))


def behavioural_failures(experiments: DataFrame) -> DataFrame:
    """Failed behavioural tests by the dimension that they speak for."""
    return experiments.select(F.explode("behavioral_results").alias("test", "ok")).where("not ok").groupBy(dimension_of_test(F.col("test")).alias("dimension")).agg(F.count(F.lit(1)).alias("failures"))


def top_failing(experiments: DataFrame, k: int, order: str = "experiment_id") -> DataFrame:
    """The k document types that fail most; ties by first appearance."""
    out = experiments.where("not passed").groupBy("document_type").agg(F.count(F.lit(1)).alias("failures"), F.min(order).alias("first_seen"))
    return out.orderBy(F.desc("failures"), "first_seen").limit(k)


def calibration_summary(judged: DataFrame, annotated: DataFrame, by: Sequence[str], least: float = WEAK_BELOW) -> DataFrame:
    """Kappa and n a judge and slice. judged: judge, keys, score; annotated: keys, score, version; of a key's annotations the last version counts."""
    last = annotated.groupBy(*by).agg(F.max_by("score", "version").alias("truth"))
    both = judged.join(last, list(by)).select("judge", *by, score_label(F.col("score"), least).alias("said"), score_label(F.col("truth"), least).alias("is"))
    return cohens_kappa(both, ["judge"], "said", "is")


def pairwise_agreement(judged: DataFrame, annotated: DataFrame) -> DataFrame:
    """Agreement on which of two files is better. Both sides: format, dimension, a, b, winner (a, b or tie); pairs match in either order."""

    def ordered(df: DataFrame, name: str) -> DataFrame:
        swap = F.col("a") > F.col("b")
        winner = F.when(swap & (F.col("winner") == "a"), "b").when(swap & (F.col("winner") == "b"), "a").otherwise(F.col("winner"))
        return df.select("format", "dimension", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), winner.alias(name))

    both = ordered(judged, "said").join(ordered(annotated, "is"), ["format", "dimension", "a", "b"])
    return both.groupBy("format", "dimension").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg((F.col("said") == F.col("is")).cast("int")), 6).alias("agreement"))


def baseline_against_candidate(holdout: DataFrame, baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Per strategy: documents, missing ones on either side, mean lift over the covered, and the verdict; gaps block it.

    holdout: doc_id; baseline: doc_id, score; candidate: strategy, doc_id, score.
    """
    plan = candidate.select("strategy").distinct().join(holdout.select("doc_id").distinct().withColumn("one", F.lit(1)), F.lit(True))
    rows = plan.join(baseline.select("doc_id", F.col("score").alias("before")), "doc_id", "left").join(candidate.select("strategy", "doc_id", F.col("score").alias("after")), ["strategy", "doc_id"], "left")
    lift = F.avg(F.col("after") - F.col("before"))
    out = rows.groupBy("strategy").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("before").isNull()).alias("no_baseline"), F.count_if(F.col("after").isNull()).alias("no_candidate"), F.round(lift, 6).alias("lift"))
    gaps = F.col("no_baseline") + F.col("no_candidate") > 0
    verdict = F.when(gaps, "incomplete").when(F.col("lift") >= LIFT_LEAST, "promote").when(F.col("lift") < REGRESSION_MOST, "regress").otherwise("keep")
    return out.withColumn("verdict", verdict)


def controlled_series(runs: DataFrame, least_runs: int) -> DataFrame:
    """runs: strategy, fingerprint, lift. Runs of one fingerprint are one run; a series needs ``least_runs`` and all of them lifting."""
    once = runs.groupBy("strategy", "fingerprint").agg(F.min("lift").alias("lift"))
    out = once.groupBy("strategy").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("lift") >= LIFT_LEAST).alias("lifting"), F.round(F.min("lift"), 6).alias("worst"))
    return out.withColumn("holds", (F.col("runs") >= least_runs) & (F.col("lifting") == F.col("runs")))


def corpus_summary(annotations: DataFrame) -> DataFrame:
    """annotations: format, document_class, flags. Counts by format, class and flag in long form, with all."""
    marks = F.concat(F.array(_mark("all", F.lit("*")), _mark("format", F.col("format")), _mark("class", F.col("document_class"))), F.transform("flags", lambda f: _mark("flag", f)))
    return annotations.select(F.explode(marks).alias("m")).groupBy(F.col("m.pattern").alias("by"), "m.value").agg(F.count(F.lit(1)).alias("documents"))


def coverage_gate(summary: DataFrame, least: dict[str, int]) -> DataFrame:
    """Which of the required counts ("by:value") the summary doesn't reach."""
    spark = summary.sparkSession
    wanted = spark.createDataFrame([(*k.split(":", 1), n) for k, n in least.items()], "by string, value string, least long")
    return wanted.join(summary, ["by", "value"], "left").withColumn("documents", F.coalesce("documents", F.lit(0))).where("documents < least")


def priority_score(weak: Column, variances: Column, confidences: Column) -> Column:
    """Twice the number of weak dimensions, four times the largest variance, and the largest doubt."""
    most = lambda a: F.coalesce(F.array_max(a), F.lit(0.0))
    return 2 * F.size(weak) + 4 * most(variances) + most(F.transform(confidences, lambda c: 1 - c))


def retired(variants: DataFrame, frontier: DataFrame, cap: int, least_docs: int) -> DataFrame:
    """Active variants to retire, with the reason. variants: harness_id, conformance_rate, total_docs, experiments, created_at; frontier: harness_id.

    Variants that ran no document stay. Off the frontier, ``least_docs`` experiments or more retire a variant. If more than ``cap`` are
    left, the excess counts from the lowest conformance up (ties: the older first), members of the frontier included; those are counted but stay.
    """
    front = frontier.select("harness_id", F.lit(True).alias("front")).distinct()
    scored = variants.where("total_docs > 0").join(front, "harness_id", "left").withColumn("front", F.coalesce("front", F.lit(False)))
    old = ~F.col("front") & (F.col("experiments") >= least_docs)
    left = scored.where(~old)
    excess = max(0, left.count() - cap)
    lowest = left.orderBy("conformance_rate", "created_at", "harness_id").limit(excess).where(~F.col("front"))
    named = lambda df, why: df.select("harness_id", "conformance_rate", F.lit(why).alias("reason"))
    return named(scored.where(old), "not on the frontier").unionByName(named(lowest, "more than the cap"))


def promotable(variants: DataFrame, frontier: DataFrame, by: float = PROMOTE_BY) -> DataFrame:
    """Variants that beat the best of the frontier by more than ``by``."""
    best = frontier.agg(F.max("conformance_rate").alias("best"))  # one row
    return variants.crossJoin(F.broadcast(best)).where(F.col("conformance_rate") > F.col("best") + by).select("harness_id", "conformance_rate")


def by_provider(pages: DataFrame) -> DataFrame:
    """OCR benchmark. pages: provider, blocks, chars, overlap. Means over pages with text, empty pages counted apart."""
    full = F.col("chars") > 0
    mean = lambda c: F.round(F.avg(F.when(full, F.col(c))), 6)
    return pages.groupBy("provider").agg(F.count(F.lit(1)).alias("pages"), F.count_if(~full).alias("empty"), mean("blocks").alias("blocks"), mean("chars").alias("chars"), mean("overlap").alias("overlap"))


def criterion_rollup(verdicts: DataFrame) -> DataFrame:
    """verdicts: doc_id, page, criterion, status. Per failing criterion its pages in order, and counts."""
    failing = verdicts.where("status = 'fail'").groupBy("doc_id", "criterion").agg(F.array_sort(F.collect_set("page")).alias("p"), F.count(F.lit(1)).alias("findings"))
    return failing.select("doc_id", "criterion", F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("pages"), "findings")


def criterion_status(checks: DataFrame, reader: DataFrame, criteria: dict[str, list[str]]) -> DataFrame:
    """doc_id, criterion, status (PASS, FAIL, N/A) and remarks, for each criterion and the rules that speak for it.

    checks: doc_id, seq, rule_id, status, description, details (texts); reader: doc_id, seq, rule_id, severity, description. Without rules, or
    without a check or finding by one of them, a criterion isn't applicable. A failed check or a reader's error fails it; remarks are those, checks first, each
    check with its first two details. Criteria are a fixed map of a few dozen.
    """
    rules = [(c, r) for c, rules in criteria.items() for r in rules]
    of = F.explode(F.filter(F.array(*[F.struct(F.lit(c).alias("criterion"), F.lit(r).alias("rule")) for c, r in rules]), lambda x: x["rule"] == F.col("rule_id")))
    two = F.array_join(F.slice(F.coalesce("details", F.array().cast("array<string>")), 1, 2), "; ")
    said = F.when(two == "", F.col("description")).otherwise(F.concat("description", F.lit(": "), two))
    rows = checks.select("doc_id", of.alias("c"), (F.col("status") == "Failed").alias("bad"), F.lit(0).alias("from"), "seq", said.alias("said"))
    rows = rows.unionByName(reader.select("doc_id", of.alias("c"), (F.lower("severity") == "error").alias("bad"), F.lit(1).alias("from"), "seq", F.col("description").alias("said")))
    found = rows.groupBy("doc_id", F.col("c.criterion").alias("criterion")).agg(F.max("bad").alias("bad"), F.sort_array(F.collect_list(F.when(F.col("bad"), F.struct("from", "seq", "said")))).alias("bads"))
    names = F.array(*[F.struct(F.lit(c).alias("criterion"), F.lit(bool(r)).alias("ruled")) for c, r in criteria.items()])
    every = checks.select("doc_id").union(reader.select("doc_id")).distinct().select("doc_id", F.explode(names).alias("n")).select("doc_id", "n.criterion", "n.ruled")
    out = every.join(found, ["doc_id", "criterion"], "left")
    remarks = F.when(~F.col("ruled"), "Not applicable to static PDF documents").when(F.col("bad").isNull(), "No applicable checks for this document").otherwise(F.array_join(F.transform("bads", lambda x: x["said"]), "; "))
    return out.select("doc_id", "criterion", F.when(F.col("bad").isNull(), "N/A").when(F.col("bad"), "FAIL").otherwise("PASS").alias("status"), remarks.alias("remarks"))


def issue_list(checks: DataFrame, reader: DataFrame, violations: DataFrame) -> DataFrame:
    """Findings of three sources in one shape: doc_id, code, source, severity, fixable, blocking, description.

    checks: doc_id, rule_id, status, fixable, description, of which the failed count. reader: doc_id, rule_id, severity, description, errors and
    warnings of it. violations: doc_id, id, description, font_limited; those that come from a source's fonts can't be fixed. Nothing here blocks by itself.
    """

    def shaped(df: DataFrame, source: str, code: Column, severity: Column, fixable: Column) -> DataFrame:
        return df.select("doc_id", code.alias("code"), F.lit(source).alias("source"), severity.alias("severity"), fixable.alias("fixable"), F.lit(False).alias("blocking"), F.coalesce("description", F.lit("")).alias("description"))

    level = F.lower("severity")
    return reduce(DataFrame.unionByName, [
        shaped(checks.where("status = 'Failed'"), "checker", F.col("rule_id"), F.lit("error"), F.coalesce("fixable", F.lit(False))),
        shaped(reader.where(level.isin("error", "warning")), "screen-reader", F.col("rule_id"), level, F.lit(True)),
        shaped(violations, "verapdf", F.coalesce("id", F.lit("unknown-rule")), F.lit("error"), ~F.coalesce("font_limited", F.lit(False))),
    ])


def accepted(facts: DataFrame) -> DataFrame:
    """facts: doc_id, openable, checker_failures, reader_errors, verapdf_passed, visual_ok, text_ok. Gates that aren't met in order; unchecked ones (null) pass, but openable must be true."""
    gate = lambda name, ok: F.when(~F.coalesce(ok, F.lit(name != "openable")), F.lit(name))
    gates = F.array_compact(F.array(
        gate("openable", F.col("openable")), gate("checker", F.col("checker_failures") == 0), gate("screen_reader", F.col("reader_errors") == 0),
        gate("verapdf", F.col("verapdf_passed")), gate("visual", F.col("visual_ok")), gate("text", F.col("text_ok")),
    ))
    return facts.select("doc_id", F.array_join(gates, ",").alias("failed_gates"), (F.size(gates) == 0).alias("accepted"))


def office_level(facts: DataFrame) -> DataFrame:
    """doc_id, level (L0 to L4) and what blocks the next. facts: doc_id, openable, has_text, has_headings, has_table_headers, has_alternatives, failed_rules, quality_passed.

    Not evaluated (openable is null), not openable or without text is L0; without headings, table headers and alternatives L1; with failed rules
    L2; L3 until the quality layer ran and passed. L5 is never given. Null facts don't hold; null rules are none.
    """
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    rules = F.coalesce("failed_rules", F.array().cast("array<string>"))
    steps = [
        (F.col("openable").isNull(), "L0", F.array(F.lit("evaluation_error"))), (~ok("openable"), "L0", F.array(F.lit("not_openable"))), (~ok("has_text"), "L0", F.array(F.lit("no_text_layer"))),
        (~(ok("has_headings") | ok("has_table_headers") | ok("has_alternatives")), "L1", F.array(F.lit("no_structural_signal"))), (F.size(rules) > 0, "L2", rules),
        (F.col("quality_passed").isNull(), "L3", F.array(F.lit("quality_layer_not_run"))), (~ok("quality_passed"), "L3", F.array(F.lit("quality_failed"))),
    ]
    level, blocking = F.lit("L4"), F.array().cast("array<string>")
    for when, name, why in reversed(steps):
        level, blocking = F.when(when, name).otherwise(level), F.when(when, why).otherwise(blocking)
    return facts.select("doc_id", level.alias("level"), blocking.alias("blocking"))
