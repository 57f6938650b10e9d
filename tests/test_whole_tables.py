"""Queries over every row and whole texts, against counts by hand."""

from __future__ import annotations

from collections import Counter, defaultdict

from docmeter.plans.queries import QUERIES


def test_every_box_has_its_place(spark, small):
    got = defaultdict(list)
    for r in QUERIES["reading_order"](spark, small).collect():
        got[r.doc_id].append(r.place)
    want = Counter(r.l_orderkey for r in spark.read.parquet(f"{small}/lineitem.parquet").select("l_orderkey").collect())
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(n)) for k, n in want.items()}


def test_every_document_has_its_ensemble(spark, small):
    got = {(r.document_id, r.dimension): r.judges for r in QUERIES["judge_ensemble"](spark, small).collect()}
    want = Counter(r.l_orderkey for r in spark.read.parquet(f"{small}/lineitem.parquet").select("l_orderkey").collect())
    assert got == {(k, d): n for k, n in want.items() for d in ("alt_text", "headings", "links")}


def test_links_and_ranges_over_all_orders(spark, small):
    targets, pages = defaultdict(set), defaultdict(set)
    for r in spark.read.parquet(f"{small}/lineitem.parquet").collect():
        targets[r.l_suppkey, r.l_linenumber, r.l_returnflag.lower()].add(r.l_partkey)
        if r.l_quantity > 40:
            pages[r.l_suppkey].add(r.l_linenumber)
    found = {(r.doc_id, r.page, r.text): r.targets for r in QUERIES["repeated_link_texts"](spark, small).collect()}
    assert found == {k: len(v) for k, v in targets.items() if len(v) > 1}
    for r in QUERIES["page_range_format"](spark, small).collect():
        ends = [[int(x) for x in part.split("-")] for part in r.pages.split(", ")]
        assert {p for e in ends for p in range(e[0], e[-1] + 1)} == pages.pop(r.k)
    assert not pages


def test_titles_that_only_start_alike_are_not_repeated(spark, tmp_path):
    rows = [(1, 1, "Results of the north"), (1, 2, "Results of the south"), (1, 3, "results  OF the north "), (2, 1, "Results of the north")]
    spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.doc_id, r.slide): r.issue for r in QUERIES["slide_titles"](spark, str(tmp_path)).collect()}
    assert got == {(1, 1): "repeated_title", (1, 2): None, (1, 3): "repeated_title", (2, 1): None}
