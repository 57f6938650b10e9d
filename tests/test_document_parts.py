from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.operators import matching, spans, structure, tree
from docmeter.plans.document_queries import _tree


def test_a_chain_of_100000_nodes_and_cycles(spark):
    n = 100_000
    rows = [(1, k, k - 1 if k else None, k - 1 if k else None) for k in range(n)]
    rows[5] = (1, 5, 4, 6)  # a cycle of two
    rows[50] = (1, 50, 49, 50)  # of one
    rows[70] = (1, 70, 69, None)
    rows[80] = (1, 80, 79, 10**9)
    rows += [(1, n + 1, n + 2, n + 2), (1, n + 2, n + 1, n + 1), (1, n + 3, n + 9, 0), (2, 0, None, None), (2, 1, 0, 3), (2, 2, 1, 1), (2, 3, 2, 2), (3, 7, 8, 8)]
    nodes = spark.createDataFrame(rows, "doc_id long, node_id long, under_id long, parent_id long")
    entries = spark.createDataFrame([(1, 9), (1, n + 1), (1, n + 3), (1, -4), (1, -4), (3, 7), (9, 1)], "doc_id long, node_id long")
    found = Counter((r.doc_id, r.rule, r.node_id) for r in tree.tree_integrity(nodes, entries).collect())
    assert found == Counter({
        (1, "parent-cycle", 5): 1, (1, "parent-cycle", 6): 1, (1, "parent-cycle", 50): 1, (1, "missing-parent", 70): 1, (1, "unreachable-parent", 80): 1,
        **{(2, "parent-cycle", k): 1 for k in (1, 2, 3)}, (1, "orphan-entry", n + 1): 1, (1, "orphan-entry", n + 3): 1, (1, "orphan-entry", -4): 2, (3, "orphan-entry", 7): 1, (9, "orphan-entry", 1): 1,
    })
    assert tree.tree_integrity(nodes.limit(0), entries.limit(0)).count() == 0


def test_the_query_meets_all_rules(spark, small):
    nodes, entries = _tree(spark, small)
    assert {r.rule for r in tree.tree_integrity(nodes, entries).collect()} == {"missing-parent", "unreachable-parent", "parent-cycle", "orphan-entry"}


def test_subtrees_of_a_tree_100000_levels_deep(spark):
    n = 100_000
    rows = [(1, k, k) for k in range(n)] + [(1, n, 1), (2, 0, 3), (2, 1, 5), (2, 2, 4), (2, 3, 5), (2, 4, 3)]
    nodes = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "seq", "depth"]), "doc_id long, seq int, depth int")
    stops = tree.subtree_ends(nodes)
    got = {(r.doc_id, r.seq): r.stop for r in stops.collect()}
    assert got[(1, 0)] == n + 1 and got[(1, n)] == n + 1 and all(got[(1, k)] == n for k in range(1, n))
    assert [got[(2, k)] for k in range(5)] == [4, 2, 4, 4, 5]
    items = spark.createDataFrame([(1, n - 1), (1, n - 1), (1, n), (2, 1), (2, 3)], "doc_id long, seq int")
    below = {(r.doc_id, r.seq): r.below for r in tree.count_below(stops, items).collect()}
    assert below[(1, 0)] == 3 and below[(1, 5)] == below[(1, n - 1)] == 2 and below[(1, n)] == 1
    assert [below[(2, k)] for k in range(5)] == [2, 1, 1, 1, 0]


def test_a_page_with_100000_rectangles(spark):
    side = 316
    boxes = [(1, 1, k, (k % side) * 2.0, (k // side) * 2.0, (k % side) * 2.0 + 2, (k // side) * 2.0 + 2, k % 256, k // 256 % 256, 7) for k in range(side * side)]
    boxes += [(1, 1, -1, -5.0, -5.0, 5000.0, 5000.0, 1, 2, 3), (1, 1, 10**6, 100.0, 100.0, 101.0, 101.0, 9, 9, 9), (1, 1, 10**7, 50.0, 50.0, 50.0, 60.0, 8, 8, 8), (1, 2, 5, 0.0, 0.0, 4.0, 4.0, 6, 6, 6)]
    columns = "doc_id long, page int, paint long, x0 double, y0 double, x1 double, y1 double, r int, g int, b int"
    rectangles = spark.createDataFrame(pd.DataFrame(boxes, columns=re.findall(r"(\w+) \w+", columns)), columns)
    at = [(0, 1.0, 1.0), (1, 100.5, 100.5), (2, 4000.0, 3000.0), (3, -50.0, 0.0), (4, 51.0, 55.0)]
    texts = spark.createDataFrame([(1, 1, i, x - 1, y - 1, x + 1, y + 1) for i, x, y in at] + [(1, 3, 5, 0.0, 0.0, 2.0, 2.0)], "doc_id long, page int, span long, x0 double, y0 double, x1 double, y1 double")
    got = {r.span: (r.bg_r, r.bg_g, r.bg_b) for r in spans.backgrounds(texts, rectangles).collect()}
    k = 27 * side + 25
    assert got == {0: (0, 0, 7), 1: (9, 9, 9), 2: (1, 2, 3), 3: (None, None, None), 4: (k % 256, k // 256 % 256, 7), 5: (None, None, None)}


def test_tolerances_of_contrast(spark):
    span = lambda page, i, fg, size=12.0, wide=100.0, bg=None, text="x": (1, page, i, text, 0.0, 0.0, wide, 20.0, *fg, size, *(bg or (None,) * 3))
    white, grey, black = (255, 255, 255), (200, 200, 200), (0, 0, 0)
    rows = [span(1, i, grey) for i in range(2)] + [span(1, 2, black)]  # two fail
    rows += [span(2, 0, grey), span(2, 1, white, wide=10.0), span(2, 2, black, bg=(60, 60, 60)), span(2, 3, grey, size=6.0), span(2, 4, white, bg=black), span(2, 5, grey, text=" ")]  # one fails
    rows += [span(3, i, grey) for i in range(3)] + [span(3, i, black) for i in range(3, 300)]  # three of 300
    rows += [span(4, i, white) for i in range(4)] + [span(4, i, black) for i in range(4, 300)]  # four of 300
    df = spark.createDataFrame(rows, "doc_id long, page int, span long, text string, x0 double, y0 double, x1 double, y1 double, r int, g int, b int, size double, bg_r int, bg_g int, bg_b int")
    got = {r.page: (r.spans, r.failing, r.status) for r in spans.page_contrast(spans.failing_spans(df)).collect()}
    assert got == {1: (3, 2, "Failed"), 2: (5, 1, "Passed"), 3: (300, 3, "Passed"), 4: (300, 4, "Failed")}


def naive(headers: list[str], offered: list[tuple[str, str]], least: float) -> list[tuple]:
    normal = lambda x: re.sub("[^a-z0-9 ]", "", re.sub(r"\s+", " ", (x or "").lower())).strip()
    out = []
    for header in headers:
        a = normal(header)
        exact = next(((t, s) for t, s in offered if normal(t) == a), None)
        best, ratio = None, 0.0
        for t, s in offered:
            if a and normal(t) and SequenceMatcher(None, a, normal(t)).ratio() > ratio:
                best, ratio = (t, s), SequenceMatcher(None, a, normal(t)).ratio()
        out.append((header, *(exact or (best if ratio >= least else None) or (None, None))))
    return sorted(out, key=repr)


WORDS = st.lists(st.sampled_from(["total", "Total", "sum", " ", "  ", "2024", "Q1", "é", "-", "name of", "nmae"]), max_size=5).map("".join)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(WORDS | st.none(), min_size=1, max_size=8), st.lists(WORDS, max_size=8), st.sampled_from([0.6, 0.3, 0.9]))
def test_headers_match_as_difflib_has_it(spark, headers, offered, least):
    asked = spark.createDataFrame([(1, h) for h in headers], "table_id int, header string")
    given_ = spark.createDataFrame([(1, k, t, f"s{k}") for k, t in enumerate(offered)] + [(2, 0, headers[0], "other")], "table_id int, idx int, header string, scope string")
    got = sorted(((r.header, r.matched, r.scope) for r in matching.match_headers(asked, given_, least).collect()), key=repr)
    assert got == naive(headers, [(t, f"s{k}") for k, t in enumerate(offered)], least)


def test_pruned_pairs_are_reported(spark):
    asked = spark.createDataFrame([(1, "abcdef"), (1, "ABC-DEF"), (1, "x")], "table_id int, header string")
    offered = spark.createDataFrame([(1, 0, "abcxyz"), (1, 1, "uvwxyz"), (1, 2, "abcdefg"), (1, 3, "")], "table_id int, idx int, header string")
    assert [tuple(r) for r in matching.pairs_pruned(asked, offered).collect()] == [(1, 6, 3, 2)]


def test_rules_on_content(spark):
    nodes = spark.createDataFrame(
        [(1, 1, "Figure", "A view", 0), (1, 2, "Table", "T", 2), (1, 3, "Figure", "A dog", 0), (1, 4, "Custom", None, 0), (1, 5, "Custom", "image", 0), (1, 6, "Bodytext1", None, 0), (1, 7, "Div", "d", 3), (1, 8, "Link", "l", 0), (2, 1, "Figure", "A cat", 0)],
        "doc_id long, seq int, tag string, alt_text string, children int",
    )
    contents = spark.createDataFrame([(1, 3, "mcid", 1, 9), (1, 4, "mcid", 1, 8), (1, 5, "annotation", None, None), (1, 6, "object", None, None), (1, 8, "annotation", None, None), (2, 1, "mcid", 1, 1)], "doc_id long, seq int, kind string, page int, mcid int")
    rendered = spark.createDataFrame([(1, 1, 9, "  ", False), (1, 1, 8, None, True)], "doc_id long, page int, mcid int, text string, image boolean")
    pages = spark.createDataFrame([(1, 3), (2, 51)], "doc_id long, pages int")
    got = {tuple(r) for r in tree.alt_content_findings(nodes, contents, rendered, pages).collect()}
    assert got == {
        (1, 1, "alt-associated", "no content"), (1, 3, "alt-associated", "nothing rendered"), (1, 4, "alt-elements", "missing"), (1, 5, "alt-elements", "placeholder"),
        (1, 5, "alt-hides-annotation", "annotation"), (1, 7, "alt-associated", "no content"), (1, 7, "alt-redundant", "children are tagged"),
    }
    for depth, images in ((F.col("seq"), [1, 1]), (F.lit(1), [0, 0])):
        found = tree.figures_with_images(nodes.withColumn("depth", depth.cast("int")), contents, rendered)
        assert [r.images for r in found.where("doc_id = 1").orderBy("seq").collect()] == images


def test_reading_order_of_a_long_column(spark):
    rows = [(1, 1, k, 0.0, -10.0 * k, 50.0, -10.0 * k + 4) for k in range(2000)] + [(1, 2, 0, 0.0, 0.0, 1.0, 1.0)]
    boxes = spark.createDataFrame(rows, "doc_id long, page int, idx int, left double, bottom double, right double, top double")
    got = {(r.page, r.idx): r.place for r in structure.reading_order(boxes).collect()}
    assert got == {(1, k): k for k in range(2000)} | {(2, 0): 0}


def _cut_by_hand(boxes: list[tuple], gap: float, axes: str) -> list[tuple]:
    for axis in axes if len(boxes) > 1 else "":
        spans = sorted((-b[4], -b[2], b) if axis == "h" else (b[1], b[3], b) for b in boxes)
        reach, cuts = spans[0][1], []
        for k, (low, high, _) in enumerate(spans):
            cuts.append((low - reach, -k))
            reach = max(reach, high)
        free, k = max(cuts)
        if free >= gap:
            return _cut_by_hand([b for *_, b in spans[:-k]], gap, axes) + _cut_by_hand([b for *_, b in spans[-k:]], gap, axes)
    return sorted(boxes, key=lambda b: (-b[4], b[1], b[0]))


def test_reading_order_of_many_and_of_wide_pages(spark):
    rnd = random.Random(3)
    pages = {p: [(k, x := rnd.randrange(40) * 5.0, y := rnd.randrange(40) * 5.0, x + rnd.randrange(1, 60), y + rnd.randrange(1, 30)) for k in range(rnd.choice([1, 4, 12]))] for p in range(12000)}
    pages[-1] = [(k, 20.0 * k, 0.0, 20.0 * k + 8, 10.0) for k in range(5000)]  # a row
    pages[-2] = [(k, 20.0 * k, 3.0 * (5000 - k), 20.0 * k + 8, 3.0 * (5000 - k) + 5) for k in range(5000)]  # steps
    schema = "doc_id long, page int, idx int, left double, bottom double, right double, top double"
    boxes = spark.createDataFrame([(p, 1, *b) for p, bs in pages.items() for b in bs], schema).cache()
    boxes.count()
    for density, axes in ((1.0, "vh"), (0.0, "hv")):
        began, got = time.time(), defaultdict(list)
        for r in structure.reading_order(boxes, density=density).select("doc_id", "place", "idx").collect():
            got[r.doc_id].append((r.place, r.idx))
        assert time.time() - began < 30
        for p, bs in pages.items():
            want = [b[0] for b in _cut_by_hand(bs, 5.0, axes)] if p >= 0 else list(range(5000))
            assert [k for _, k in sorted(got[p])] == want
    boxes.unpersist()


def test_boxes_without_coordinates_are_read_last(spark):
    boxes = spark.createDataFrame([(1, None, 0, None, 0.0, 1.0, 1.0), (1, None, 1, 0.0, 0.0, 9.0, 9.0), (1, None, 2, 0.0, 30.0, 9.0, float("nan")), (1, None, 3, 0.0, 30.0, 9.0, 39.0)], "doc_id long, page int, idx int, left double, bottom double, right double, top double")
    assert [r.idx for r in structure.reading_order(boxes).orderBy("place").collect()][:2] == [3, 1]
