from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter import schemas
from docmeter.functions import color
from docmeter.operators import checks, evaluation, html, records, routing, structure, text
from docmeter.sources import files
from docmeter.streaming import events

PAGE = """<html><head></head><body><div id=top><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></div><h3>Deep</h3><h6></h6><h5>Deeper</h5>
<a href="/docs/user-guide.pdf"></a><p>Prices: <a href="/p">click here</a></p><a target="_blank" href="/x">Out</a><img src=a.png><a href="/logo"><img alt="" src=l.png></a>
<table><tr><td>H</td></tr><tr><td>1</td></tr></table><input name="first_name"><input type=hidden><p style="color:#777; background:#888; margin:0">x</p>
<div><img src=c.png alt=c><p class="caption">Figure 1</p></div></body></html>"""


GOOD = """<!doctype html><html lang="en"><head><title>T</title><meta name="viewport" content="x"></head><body><a href="#main" class="skip">Skip</a><nav></nav><main id="main"><h1>A</h1><h2>B</h2>
<table><caption>c</caption><tr><th>x</th></tr></table><table role=none><tr><td>y</td></tr></table><label for=q>Q</label><input id=q><label>N <input></label><a href="/a"><img alt="Home"></a>
<a target=_blank rel="noopener noreferrer" href="/x">Out (new tab)</a></main></body></html>"""


def test_fixes_needed(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, GOOD), (4, ""), (5, "<b>x</b>"), (None, "<html>")], "page_id long, html string")
    got = {(r.page_id, r.fix): r.places for r in html.fixes_needed(df).collect()}
    once = ("lang", "title", "viewport", "main", "skip_link", "empty_heading", "empty_link", "generic_link", "new_window", "img_alt", "linked_img_alt", "table_header", "table_caption", "form_label")
    assert got == {(1, f): 1 for f in once} | {(1, "heading_level"): 2, (None, "lang"): 1}


def test_heading_repair_fold(spark):
    rows = spark.createDataFrame([([3, 5, 2, 6, 1],), ([],), ([1, 2, 3],)], "l array<int>")
    assert [r[0] for r in rows.select(structure.repaired_levels(F.col("l"))).collect()] == [[1, 2, 2, 3, 1], [], [1, 2, 3]]


@pytest.mark.parametrize(("root", "want"), [("virtual", [0, 2, 4]), ("free", [2]), ("carry", [2, 4]), ("warn", [0, 2])])
def test_heading_policies(spark, root, want):
    levels = [2, 1, 3, None, 5]
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(levels)], "doc int, seq int, level int")
    assert sorted(r.seq for r in structure.heading_skips(rows, "doc", "seq", "level", root).collect()) == want


def test_tree_rules(spark):
    tree = [("Document", 0), ("Table", 1), ("TR", 2), ("TD", 3), ("TR", 1), ("L", 1), ("LI", 2), ("LBody", 3), ("LBody", 1), ("L", 1), ("P", 2), ("Figure", 1), ("Figure", 1)]
    alts = {11: None, 12: "image 3"}
    nodes = spark.createDataFrame([(1, i, d, t, "x", alts.get(i), 1, 0, True) for i, (t, d) in enumerate(tree)], schemas.STRUCT_NODES)
    parents = structure.tree_parents(nodes)
    assert {r.seq: r.parent_seq for r in parents.collect()} == {0: None, 1: 0, 2: 1, 3: 2, 4: 0, 5: 0, 6: 5, 7: 6, 8: 0, 9: 0, 10: 9, 11: 0, 12: 0}
    assert {(r.seq, r.rule_id) for r in structure.parent_findings(parents).collect()} == {(4, "tables-tr-parent"), (8, "lists-lbl-lbody-parent")}
    languages = spark.createDataFrame([(1, " ")], "doc_id long, lang string")
    found = {(r.seq, r.rule_id) for r in structure.node_findings(nodes, languages).collect()}
    assert found == {(1, "tables-headers"), (9, "lists-items"), (11, "alt-figures"), (12, "alt-generic"), (None, "doc-language")}


def test_levels(spark):
    cols = "openable has_text has_tags verapdf_passed has_lang display_title has_uaid conformant quality_passed".split()
    rows = [[True] * 9]
    for i in range(9):
        rows.append([j != i for j in range(9)])
    rows += [[*[True] * 8, None], [None] * 9]
    df = spark.createDataFrame(rows, ", ".join(f"{c} boolean" for c in cols))
    got = [(r.level, r.blocking) for r in structure.level_of(df).collect()]
    assert [g[0] for g in got] == ["L4", "L0", "L0", "L1", "L2", "L2", "L2", "L2", "L3", "L3", "L3", "L0"]
    assert got[0][1] == [] and got[10][1] == ["quality_layer_not_run"] and got[4][1] == ["verapdf_failed"]


def test_reading_order_of_two_columns(spark):
    boxes = [(1, 1, i, 0.0 if i < 3 else 300.0, 600.0 - 100 * (i % 3), 250.0 if i < 3 else 550.0, 680.0 - 100 * (i % 3)) for i in range(6)]
    out = structure.reading_order(spark.createDataFrame(boxes, schemas.BBOXES), density=1.0).collect()
    assert [r.idx for r in sorted(out, key=lambda r: r.place)] == [0, 1, 2, 3, 4, 5]


def test_link_and_alt_rules(spark):
    rows = [("click here", "", False), ("Prices 2024", "/p", True), ("http://a.b/c", "x", False), ("abc", "", False), ("/about/", "/about", False), (None, None, False), ("a\u00a0 guide", "", True)]
    df = spark.createDataFrame(rows, "t string, u string, want boolean")
    assert all(r.want == r.got for r in df.select("want", text.descriptive_link(F.col("t"), F.col("u")).alias("got")).collect())
    alts = [("", True), (None, True), ("image 12", True), ("scan_01.png", True), ("C:\\x\\y", True), ("A chart of", True), ("campus photo", True), ("Enrolment by term, 2019 to 2023", False)]
    assert all(r.want == r.got for r in spark.createDataFrame(alts, "a string, want boolean").select("want", text.generic_alt(F.col("a")).alias("got")).collect())


def test_trust(spark):
    good = "The committee met on Monday and agreed the budget for the coming year in full. " * 2
    rows = [(1, good, True), (2, "", False), (3, good + "\ufffd", False), (4, "wor#d test", False), (5, "\x01\x02\x03\x04 " + good, False), (6, "1234567890 " * 10, False), (7, " ".join(f"{i}) {i * 3}" for i in range(1, 30)) + " Solve these problems", True)]
    out = text.trust_columns(spark.createDataFrame(rows, "doc_id long, text string, want boolean"), "doc_id", "text").collect()
    assert {r.doc_id: r.trustworthy for r in out} == {r[0]: r[2] for r in rows}


def test_slugs_never_collide(spark):
    df = spark.createDataFrame([(["A b", "a-b", "A b 2", "a b"],)], "n array<string>")
    assert df.select(text.unique_slugs(F.col("n"))).first()[0] == ["a-b", "a-b-2", "a-b-2-2", "a-b-3"]


def test_json_in_replies(spark):
    rows = [('```json\n{"a": 1}\n```', '{"a": 1}'), ('Sure: {"a": [1]} done', '{"a": [1]}'), ("none", None), ("{broken", None)]
    assert all(r.want == r.got for r in spark.createDataFrame(rows, "t string, want string").select("want", text.json_in(F.col("t")).alias("got")).collect())


def test_colours(spark):
    df = spark.createDataFrame([("#fff",), ("#0000FF",), ("rgb(1, 2, 3)",), ("nope",)], "c string")
    assert [tuple(r[0]) if r[0] else None for r in df.select(color.channels(F.col("c"))).collect()] == [(255, 255, 255), (0, 0, 255), (1, 2, 3), None]
    one = df.limit(1).select(
        F.round(color.contrast(F.lit(1.0), F.lit(0.0)), 2), color.to_hex(F.lit(1), F.lit(171), F.lit(255)), color.threshold(F.lit(True), F.lit("AA")),
        color.nearest_passing(*[F.lit(119)] * 3, *[F.lit(255)] * 3), color.int_channels(F.lit(0x010203)),
    ).first()
    assert one[0] == 21 and one[1] == "#01abff" and one[2] == 3.0 and tuple(one[3]) == (118, 118, 118) and tuple(one[4]) == (1, 2, 3)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=25))
def test_frontier_by_brute_force(spark, points):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "k int, a double, b double, c double").repartition(3)
    beats = lambda x, y: x[0] >= y[0] and x[1] <= y[1] and x[2] <= y[2] and x != y
    want = {i for i, p in enumerate(points) if not any(beats(q, p) for q in points)}
    assert {r.k for r in evaluation.pareto_frontier(df, "k", ["a"], ["b", "c"]).collect()} == want


def test_kappa_of_one_class_and_of_opposites(spark):
    rows = [("one", 1, 1)] * 3 + [("split", 1, 1)] + [("opposite", 0, 1), ("opposite", 1, 0), ("null", None, 1)]
    got = {r.g: r.kappa for r in evaluation.cohens_kappa(spark.createDataFrame(rows, "g string, a int, b int"), ["g"], "a", "b").collect()}
    assert got == {"one": 1.0, "split": 1.0, "opposite": -1.0}


def test_split_never_leaves_a_side_empty(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    for ratio in (0.0, 1.0):
        assert {r.side for r in evaluation.holdout_split(df, "k", "s", ratio).collect()} == {"holdout", "proposal"}


def test_sample_and_examples(spark):
    df = spark.createDataFrame([(i, float(i % 7), i % 3, i % 2) for i in range(50)], "k long, priority double, kind int, sig int")
    out = evaluation.priority_sample(df, "k", 10, 0.3, "x").collect()
    assert len({r.k for r in out}) == 10 and sum(r.reason == "random" for r in out) == 3
    assert [r.k for r in evaluation.diverse_examples(df, "kind", "sig", [F.col("k")], 4).collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize("n", [0, 1, 37])
def test_numbers_are_gapless(spark, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 5).alias("g")).repartition(3)
    out = sorted((r.g, r.id, r.ordinal) for r in records.numbered(df, ["g", "id"]).collect())
    assert [r[2] for r in out] == list(range(n))


def test_jsonl_policies(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"source": "a", "status": "clean"}\nbroken{\n\n{"source": "a", "status": "error"}\n')
    good, bad = files.read_jsonl(spark, str(tmp_path / "m.jsonl"), schemas.MANIFEST)
    assert [r.status for r in good.collect()] == ["clean", "error"] and [r.line for r in bad.collect()] == ["broken{"]
    assert files.read_jsonl(spark, str(tmp_path / "m.jsonl"), schemas.MANIFEST, "drop")[1].count() == 0
    last = records.latest_by(files.read_jsonl_in_order(spark, str(tmp_path / "m.jsonl"), schemas.MANIFEST).where("source is not null"), ["source"], [F.desc("file"), F.desc("block"), F.desc("line")])
    assert [r.status for r in last.collect()] == ["error"]


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    files.append_jsonl(df, path)
    files.append_jsonl(df, path)
    assert spark.read.json(path).count() == 6
    files.rewrite(spark.read.json(path).distinct(), path)
    assert spark.read.json(path).count() == 3
    for stamp in ("1", "2", "3"):
        kept = files.backup(df, str(tmp_path / "b"), stamp, 2)
    assert kept == ["version=2", "version=3"]
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "e" / "x.pdf").write_bytes(b"%PDF-1.7")
    assert files.list_files(spark, str(tmp_path / "d")).count() == 1
    kinds = spark.createDataFrame([(bytearray(b"%PDF-1"), "pdf", True), (bytearray(b"PK\x03\x04"), "pdf", False), (bytearray(b"PK\x03\x04"), "docx", True)], "c binary, d string, want boolean")
    assert all(r.want == r.got for r in kinds.select("want", files.signature_matches("c", F.col("d")).alias("got")).collect())


def test_sheets(spark):
    cells = spark.createDataFrame([(1, "s", 1, 1, "a|b"), (1, "s", 1, 3, "c"), (1, "s", 2, 1, " "), (1, "s", 3, 2, "d")], "doc_id long, sheet string, row int, col int, value string")
    assert files.sheet_markdown(cells).first().markdown == "| a\\|b |  | c |\n| --- | --- | --- |\n|  | d |  |"


def test_streams_end_with_the_batch_rows(spark, small, tmp_path):
    rows = spark.read.parquet(f"{small}/events.parquet")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    stream = events.event_stream(spark, str(tmp_path / "in"))
    events.run_once(events.deduplicated(stream, ["event_id"]), str(tmp_path / "d"), str(tmp_path / "c1"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == events.deduplicated(batch, ["event_id"]).count()
    events.run_once(events.tumbling(stream, "1 hour"), str(tmp_path / "t"), str(tmp_path / "c2"))
    got = {(r.window_start, r.event_type): r.events for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    want = {(r.window_start, r.event_type): r.events for r in events.tumbling(batch, "1 hour").collect()}
    assert got.items() <= want.items() and len(got) > 0.9 * len(want)  # what the watermark hasn't passed waits
    events.upsert_latest(stream, str(tmp_path / "u"), str(tmp_path / "c3"), "user_id", "ts")
    assert spark.read.parquet(str(tmp_path / "u" / "version=0")).count() == rows.select("user_id").distinct().count()


def test_record_overlays(spark):
    now = datetime(2024, 1, 2)
    base = spark.createDataFrame([(1, "a", "x", now), (2, "b", None, now)], "id int, kind string, note string, updated_at timestamp")
    patch = spark.createDataFrame([(2, None, "new")], "id int, kind string, note string")
    out = {r.id: r for r in records.overlay(base, patch, ["id"], F.lit("2024-02-01").cast("timestamp")).collect()}
    assert (out[2].kind, out[2].note, out[2].updated_at.month) == ("b", "new", 2) and out[1].updated_at == now
    assert records.with_status(base.withColumn("status", F.lit("x")), []).count() == 0


def test_pages_without_parsing(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, GOOD)], "page_id long, html string")
    got = {r.page_id: r for r in html.landmark_findings(df).collect()}
    assert got[1].missing_doctype and got[1].missing_lang and got[1].images_without_alt == 1 and got[2].missing_title
    assert not any(getattr(got[3], c) for c in ("missing_doctype", "missing_lang", "missing_title", "missing_viewport", "missing_main", "missing_nav", "missing_skip_link", "images_without_alt"))
    assert html.elements(df).where("page_id = 1 and tag = 'td'").count() == 2


def test_routing_predicates(spark):
    df = spark.createDataFrame([(["7.21.3", ""], True), (["7.21.3", "7.1"], False), ([""], False), ([], False)], "ids array<string>, want boolean")
    assert all(r.want == r.got for r in df.select("want", routing.only_font_clauses(F.col("ids")).alias("got")).collect())
    rules = spark.createDataFrame([("7.1-1", "7.1-1", True), ("7.1-1.2", "7.1-1", True), ("7.1-11", "7.1-1", False)], "r string, c string, want boolean")
    assert all(r.want == r.got for r in rules.select("want", routing.under_rule(F.col("r"), F.col("c")).alias("got")).collect())
    same = "Growth was 12.5% " * 6
    texts = [(same, same, True), (same, same[:40], False), (same, same.replace("12.5", "125 "), False), ("", "x", True), (None, None, True), ("abcdefghij" * 5, "abcdefghij" * 4 + "zzzzzzzzzz", False)]
    assert all(r.want == r.got for r in spark.createDataFrame(texts, "a string, b string, want boolean").select("want", routing.text_intact(F.col("a"), F.col("b")).alias("got")).collect())
    sets = spark.createDataFrame([(["a", "b"], ["a"], True), (["a"], ["a"], False), (["a"], ["b"], False)], "x array<string>, y array<string>, want boolean")
    assert all(r.want == r.got for r in sets.select("want", routing.smaller_violations(F.col("x"), F.col("y")).alias("got")).collect())
    pages = spark.createDataFrame([(0, 0, 0.0, "blank"), (1, 3, 0.0, "near_blank"), (0, 0, 0.2, None), (2, 50, 0.0, None)], "b int, c int, i double, want string")
    assert all(r.want == r.got for r in pages.select("want", routing.page_skip(F.col("b"), F.col("c"), F.col("i")).alias("got")).collect())
    looks = [("single_column", False, False, 9, 0, 0.9, True, False), ("single_column", True, False, 0, 9, 0.0, False, True), ("hero_cover", False, False, 6, 3, 0.0, False, True), ("other", False, False, 8, 2, 0.0, False, True), ("other", False, False, 0, 9, 0.4, True, True), ("other", False, False, 0, 9, 0.4, False, False)]
    df = spark.createDataFrame(looks, "layout_class string, requires_rebuild boolean, structure_warning boolean, visual_blocks int, text_nodes int, image_coverage double, small_text boolean, want boolean")
    assert all(r.want == r.got for r in df.select("want", routing.needs_second_reading(df).alias("got")).collect())


def test_paragraph_and_table_checks(spark):
    rows = [
        (1, 0, "Body first", None, False, False, False), (1, 1, "Title", 2, True, False, False), (1, 2, "- item", None, False, False, False), (1, 3, "- item", None, False, True, False),
        (1, 4, "Required fields are in red", None, False, False, True), (1, 5, "Sub", 4, True, False, False), (2, 0, "Only text", None, False, False, False), (3, 0, "Top", 1, True, False, False),
    ]
    df = spark.createDataFrame(rows, "doc_id int, seq int, text string, level int, is_heading boolean, numbered boolean, coloured boolean")
    got = {(r.doc_id, r.rule, r.seq) for r in checks.paragraph_findings(df).collect()}
    assert got == {(1, "opens_without_heading", 0), (1, "heading_skip", 1), (1, "heading_skip", 5), (1, "manual_bullet", 2), (1, "colour_only", 4), (2, "headings_present", None), (2, "opens_without_heading", 0)}
    tables = spark.createDataFrame([(1, 1, 1, False, True), (1, 1, 2, True, False), (1, 2, 1, True, False), (1, 3, 1, None, None)], "doc_id int, table int, row int, is_header boolean, has_merged boolean")
    assert {(r.table, r.rule) for r in checks.table_header_findings(tables).collect()} == {(1, "header_unmarked"), (1, "header_merged"), (3, "header_unmarked")}
    cells = spark.createDataFrame([(1, 1, 1, 10**9, 1), (1, 1, 1, 1, 2), (1, 1, 2, 1, 1), (1, 2, 1, 2, 1), (1, 2, 2, 1, 1)], "doc_id int, table int, row int, col_span int, row_span int")
    assert [(r.table, r.narrowest, r.widest) for r in checks.irregular_tables(cells).collect()] == [(2, 1, 2)]
    content, tagged = spark.range(4).select(F.lit(1).alias("doc_id"), "id"), spark.range(2).select(F.lit(1).alias("doc_id"), "id")
    assert checks.untagged(content, tagged, ["doc_id", "id"], "page-content-tagged").count() == 2
