from __future__ import annotations

import colorsys

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.functions import color
from docmeter.operators import experiments, text


def luminance(c: tuple) -> float:
    return sum(w * (x / 12.92 if x <= 0.04045 else ((x + 0.055) / 1.055) ** 2.4) for w, x in zip((0.2126, 0.7152, 0.0722), c, strict=True))


def ratio(a: tuple, b: tuple) -> float:
    x, y = sorted((luminance(a), luminance(b)))
    return (y + 0.05) / (x + 0.05)


def nearest(fg: tuple, bg: tuple, least: float, away: bool) -> tuple:
    if ratio(fg, bg) >= least:
        return fg
    h, _, s = colorsys.rgb_to_hls(*fg)
    dark = luminance(bg) > 0.5
    lo, hi, best = 0.0, 1.0, 0.0 if dark else 1.0
    for _ in range(64):
        mid = (lo + hi) / 2
        ok = ratio(colorsys.hls_to_rgb(h, mid, s), bg) >= least
        best = mid if ok else best
        lo, hi = (lo, mid) if (ok == dark) == away else (mid, hi)
    return colorsys.hls_to_rgb(h, best, s)


CHANNEL = st.integers(0, 255) | st.sampled_from([0, 1, 128, 255])


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[CHANNEL] * 6), min_size=1, max_size=40), st.sampled_from([3.0, 4.5, 7.0]), st.booleans())
def test_nearest_colours_keep_their_hue(spark, rows, least, away):
    df = spark.createDataFrame(rows, "r int, g int, b int, x int, y int, z int")
    for row in df.select("*", color.nearest_passing(*[F.col(c) for c in "rgbxyz"], least, away=away).alias("n")).collect():
        want = nearest(tuple(v / 255 for v in row[:3]), tuple(v / 255 for v in row[3:6]), least, away)
        assert all(abs(got - 255 * w) <= 1 for got, w in zip(row.n, want, strict=True)), (row, want)


def test_full_saturation_leaves_the_least_channel_at_zero(spark):
    sizes = range(1, 51)
    df = spark.createDataFrame([(k * 37 % 256, z * 5, k * 11 % 256, k * 3 % 256, z * 4, k % 256) for k in (10323, 16211) for z in sizes], "r int, g int, b int, x int, y int, z int")
    for row in df.select("*", color.nearest_passing(*[F.col(c) for c in "rgbxyz"], away=True).alias("n")).collect():
        fg, bg = (tuple(v / 255 for v in row[i : i + 3]) for i in (0, 3))
        light = max(nearest(fg, bg, 4.5, True)) + min(nearest(fg, bg, 4.5, True))
        if row.r == 255 and ratio(fg, bg) < 4.5 and light <= 1.0 and luminance(bg) <= 0.5:
            assert row.n[min(range(3), key=lambda i: row[i])] == 0, row


def test_model_families(spark):
    names = {"openai/GPT-X:latest": "gpt-x", " a/b/Name-cloud ": "name", "name_cloud:7b": "name", "x-cloud_cloud": "x-cloud", "x_cloud-cloud": "x", "": "", None: "", "cloud": "cloud"}
    got = {r.n: r.f for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", experiments.model_family(F.col("n")).alias("f")).collect()}
    assert got == names


def test_dimensions_of_tests(spark):
    names = {"alt_text_x": "alt_text", "slide_reading_order": "reading_order", "screen_reader_walk": "reading_order", "headings": "heading_semantics", "slide_title_x": "slide_title", "sheet": "sheet_organization", "other": "other"}
    assert {r.n: r.f for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", experiments.dimension_of_test(F.col("n")).alias("f")).collect()} == names


def test_retiring_counts_the_frontier(spark):
    rows = [("old", 0.1, 5, 9, 1), ("young", 0.2, 5, 1, 2), ("front low", 0.05, 5, 9, 3), ("front", 0.9, 5, 9, 4), ("idle", 0.0, 0, 9, 5), ("young 2", 0.3, 1, 1, 6)]
    v = spark.createDataFrame(rows, "harness_id string, conformance_rate double, total_docs int, experiments int, created_at int")
    front = v.where("harness_id like 'front%'")
    reasons = lambda cap: {(r.harness_id, r.reason) for r in experiments.retired(v, front, cap, 5).collect()}
    assert reasons(4) == {("old", "not on the frontier")}
    assert reasons(3) == reasons(4)  # the one in excess is on the frontier: it counts, and stays
    assert reasons(2) == reasons(4) | {("young", "more than the cap")}


def test_office_levels_by_step(spark):
    rows = [(1, None, True, True, [], True), (2, False, True, True, [], True), (3, True, False, True, [], True), (4, True, True, False, ["r"], True), (5, True, True, True, ["r", "s"], True), (6, True, True, True, [], None), (7, True, True, True, None, False), (8, True, True, True, [], True)]
    df = spark.createDataFrame(rows, "doc_id int, openable boolean, has_text boolean, has_headings boolean, failed_rules array<string>, quality_passed boolean")
    got = [(r.level, r.blocking) for r in experiments.office_level(df.withColumns({"has_table_headers": F.lit(None).cast("boolean"), "has_alternatives": F.lit(False)})).orderBy("doc_id").collect()]
    assert got == [("L0", ["evaluation_error"]), ("L0", ["not_openable"]), ("L0", ["no_text_layer"]), ("L1", ["no_structural_signal"]), ("L2", ["r", "s"]), ("L3", ["quality_layer_not_run"]), ("L3", ["quality_failed"]), ("L4", [])]


def test_criteria_with_remarks(spark):
    checks = spark.createDataFrame([(1, 2, "a", "Failed", "A", ["x", "y", "z"]), (1, 1, "a", "Failed", "First", None), (1, 3, "b", "Passed", "B", [])], "doc_id int, seq int, rule_id string, status string, description string, details array<string>")
    reader = spark.createDataFrame([(1, 1, "a", "ERROR", "said"), (1, 2, "b", "WARNING", "not"), (2, 1, "z", "ERROR", "z")], "doc_id int, seq int, rule_id string, severity string, description string")
    got = {(r.doc_id, r.criterion): (r.status, r.remarks) for r in experiments.criterion_status(checks, reader, {"1": ["a"], "2": ["b"], "3": ["c"], "4": []}).collect()}
    none, static = ("N/A", "No applicable checks for this document"), ("N/A", "Not applicable to static PDF documents")
    assert got == {(1, "1"): ("FAIL", "First; A: x; y; said"), (1, "2"): ("PASS", ""), (1, "3"): none, (1, "4"): static, (2, "1"): none, (2, "2"): none, (2, "3"): none, (2, "4"): static}


def test_readers_score(spark):
    texts = spark.createDataFrame([(1, 2, "ab\u00a0\u0007"), (2, 1, None), (3, 1, "a b\n\t")], "doc_id int, pages int, text string")
    nodes = spark.createDataFrame([(1, 1, "Figure", "a long description"), (1, 1, "Image", "short"), (1, 1, "P", None), (3, 1, "P", None)], "doc_id int, page int, tag string, alt_text string")
    findings = spark.createDataFrame([(1, "sr-heading-skip", "ERROR"), (1, "sr-no-headings", "warning"), (1, "sr-list-no-items", "error"), (3, "sr-heading-start", "error")] + [(3, "sr-table-no-headers", "error")] * 3, "doc_id int, rule_id string, severity string")
    got = [tuple(r)[1:] for r in text.reader_readability(texts, nodes, findings).orderBy("doc_id").collect()]
    assert got == [(15.0, 6.3, 10.0, 8.0, 5.0, 44.3), (30.0, 0.0, 20.0, 15.0, 10.0, 75.0), (30.0, 8.3, 20.0, 10.0, 0.0, 68.3)]
