"""Steps whose time or memory used to grow faster than their tables."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docmeter.functions import color
from docmeter.operators import evaluation, matching, reading, spans, tree
from docmeter.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefixes_are_of_two_names_a_group(spark, small):
    rows = spark.createDataFrame([("a", "Report one"), ("a", "Report two"), ("a", None), ("b", "Été à"), ("b", "Été au"), ("c", "abc"), ("c", "abd"), ("d", None)], "k string, n string")
    assert {r.k: r.prefix for r in reading.common_prefixes(rows, "k", "n").collect()} == {"a": "Report ", "b": "Été à"[:4], "c": "", "d": ""}
    assert "collect_list" not in plan(QUERIES["common_prefixes"](spark, small))


def test_each_pair_of_colours_is_looked_for_once(spark, small):
    rows = spark.createDataFrame([(k, 119 if k % 2 else 255, 255 if k < 9 else None) for k in range(10)], "k int, v int, w int")
    found = color.with_nearest_passing(rows, "c", [F.col("v")] * 3 + [F.col("w")] * 3).orderBy("k").collect()
    assert [tuple(r.c) if r.c else None for r in found] == [(118,) * 3] * 9 + [None]
    for name in ("nearest_passing_colour", "nearest_passing_colour_away"):
        text = plan(QUERIES[name](spark, small))
        assert "REPARTITION_BY_NUM" in text and "HashAggregate" in text


@pytest.mark.parametrize("k", [1, 2, 3, 5, 9])
def test_examples_leave_the_map_tasks_as_one_a_kind_and_signature(spark, k):
    rows = [(n, "abcab"[n % 5], n * 7 % 4) for n in range(60)] + [(3, "d", 1), (3, "d", 1), (90, None, None)]
    df = spark.createDataFrame(rows, "k int, kind string, sig int")
    seen, late, kinds = set(), [], {}
    for row in sorted(rows, key=lambda r: r[0]):
        if row[1:] not in seen:
            (late.append(row) if row[1] in kinds else kinds.setdefault(row[1], row))
        seen.add(row[1:])
    out = evaluation.diverse_examples(df, "kind", "sig", [F.col("k")], k)
    assert [r.k for r in out.collect()] == [r[0] for r in [*kinds.values(), *late][:k]]
    assert "WindowGroupLimit [kind" in plan(out)


@pytest.mark.parametrize("name", ["readability_score", "table_regularity"])
def test_aggregates_of_lines_are_dealt_once_and_not_merged(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "REPARTITION_BY_NUM" in text and "_linenumber" in text
    assert not any(c in line for line in text.splitlines() if "ENSURE_REQUIREMENTS" in line for c in ("seq#", "row#", "table#"))


def test_content_of_nodes_is_dealt_once_and_meets_without_joins(spark, small):
    text = plan(QUERIES["alternatives_and_content"](spark, small))
    assert "REPARTITION_BY_NUM" in text and "ENSURE_REQUIREMENTS" not in text and "Join" not in text


def test_rows_with_null_keys_meet_no_content(spark):
    nodes = spark.createDataFrame([(None, 1, "Figure", "A", 0), (1, None, "Figure", "B", 0), (1, 2, "Figure", "C", 0), (1, 2, "Figure", "C", 0), (1, 3, "Figure", "D", 0)], "doc_id long, seq int, tag string, alt_text string, children int")
    contents = spark.createDataFrame([(None, 1, "mcid", 1, 1), (1, None, "mcid", 1, 1), (1, 2, "mcid", 1, None), (1, 3, None, 1, 1)], "doc_id long, seq int, kind string, page int, mcid int")
    rendered = spark.createDataFrame([(1, 1, None, "said", True), (None, 1, 1, "said", True)], "doc_id long, page int, mcid int, text string, image boolean")
    pages = spark.createDataFrame([(None, 90), (1, None)], "doc_id long, pages int")
    got = sorted((tuple(r) for r in tree.alt_content_findings(nodes, contents, rendered, pages).collect()), key=str)
    assert got == sorted([(None, 1, "alt-associated", "no content"), (1, None, "alt-associated", "no content"), *[(1, 2, "alt-associated", "nothing rendered")] * 2], key=str)


def test_header_pairs_are_dealt_over_tasks_and_matched_once(spark, monkeypatch):
    texts = ["annual sales", "sales by year", "total"]
    headers = spark.createDataFrame([(t, h.upper()) for t in range(4) for h in texts for _ in range(2)], "table_id int, header string")
    offered = spark.createDataFrame([(t, k, h) for t in range(4) for k, h in enumerate(["annual sale", "year of sales"])], "table_id int, idx int, header string")
    pairs = matching.header_ratios(headers, offered)
    assert "REPARTITION_BY_NUM" in plan(pairs)
    rows = pairs.collect()
    assert len(rows) == len({(r.table_id, r.a, r.b) for r in rows}) == 4 * len({(r.a, r.b) for r in rows})
    assert all(r.ratio == matching.block_ratio(r.a, r.b, 0.6) for r in rows)
    asked = []
    monkeypatch.setattr(matching, "block_ratio", lambda a, b, *rest: asked.append((a, b)) or 0.7)
    batch = pa.RecordBatch.from_pylist([{"table_id": t, "a": a, "b": "annual sale", "idx": 0} for a in texts for t in range(4)])
    assert [r for out in matching._ratios(0.6)(iter([batch, batch.slice(8)])) for r in out.column(4).to_pylist()] == [0.7] * 16
    assert asked == [(a, "annual sale") for a in texts]


def test_points_go_to_tiles_of_the_sizes_that_a_page_has(spark):
    texts = spark.createDataFrame([(1, p, k, 10 * k, 10, 10 * k + 4, 14) for p in range(3) for k in range(4)], "doc_id int, page int, span int, x0 int, y0 int, x1 int, y1 int")
    boxes = spark.createDataFrame([(1, 0, 1, 0, 0, 20, 20, 1, 2, 3), (1, 0, 2, 0, 0, 300, 300, 4, 5, 6), (1, 1, 1, 25, 0, 36, 20, 7, 8, 9)], "doc_id int, page int, paint int, x0 int, y0 int, x1 int, y1 int, r int, g int, b int")
    out = spans.backgrounds(texts, boxes)
    assert {(r.page, r.span): r.bg_r for r in out.collect()} == {(0, k): 4 for k in range(4)} | {(1, 0): None, (1, 1): None, (1, 2): None, (1, 3): 7} | {(2, k): None for k in range(4)}
    assert "explode(tiles" in plan(out) and "32768]" not in plan(out)
