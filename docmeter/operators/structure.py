"""Rules over ordered nodes: headings, trees, lists, tables, reading order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise
from math import isnan

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def heading_skips(headings: DataFrame, key: str, order: str, level: str, root: str = "virtual") -> DataFrame:
    """Headings deeper than the one before by more than a level.

    root: ``virtual`` lets the first follow level 0, ``free`` never counts the first,
    ``carry`` is free and lets null levels pass without becoming the one before,
    ``warn`` reports a first heading that isn't 1 as a warning of its own.
    """
    by = Window.partitionBy(key).orderBy(order)
    before = F.last(level, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)) if root == "carry" else F.lag(level).over(by)
    rows = headings.withColumn("previous", F.coalesce(before, F.lit(0)) if root == "virtual" else before)
    jump = F.col(level) > F.col("previous") + 1
    kind = F.when(jump, "skip")
    if root == "warn":
        kind = F.when((F.row_number().over(by) == 1) & (F.col(level) != 1), "first_not_1").when(jump, "skip")
    return rows.withColumn("finding", kind).where("finding is not null")


def repaired_levels(levels: Column) -> Column:
    """Each level at most one deeper than the repaired one before; the first becomes 1."""
    empty = F.array().cast("array<int>")
    return F.aggregate(levels, empty, lambda out, x: F.array_append(out, F.least(x.cast("int"), F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + 1)))


def walked(nodes: DataFrame, key: str, order: str, depth: str, extra: list[str], schema: str, step: Callable[[list, tuple], Iterator[tuple]], end: Callable[[list], Iterator[tuple]]) -> DataFrame:
    """Nodes in order, with the open ancestors of each on a stack: memory is a stack and a batch, time one step a node.

    ``step(stack, (key, order, depth, *extra))`` gets the stack of nodes less deep than this one, after ``end`` got those that
    close; both yield result rows. A document's nodes go to one task, which streams them.
    """
    columns = [key, order, depth, *extra]
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))

    def found(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                same = len(stack) if stack and stack[0][0][0] == row[0] else 0
                while same and stack[same - 1][0][2] >= row[2]:  # the stack gets deeper upward
                    same -= 1
                out += end(stack[same:])
                del stack[same:]
                out += step(stack, row)
                stack.append((row, {}))
            yield found(out)
        yield found(list(end(stack)))

    return nodes.select(*columns).repartition(key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def tree_parents(nodes: DataFrame, key: str = "doc_id", order: str = "seq", depth: str = "depth") -> DataFrame:
    """Adds parent_seq: the last node before with a smaller depth, null for roots."""
    types = dict(nodes.dtypes)
    parents = walked(nodes, key, order, depth, [], f"{key} {types[key]}, {order} {types[order]}, parent_seq {types[order]}", lambda stack, row: [(row[0], row[1], stack[-1][0][1] if stack else None)], lambda closed: [])
    return nodes.drop("parent_seq").join(parents, [key, order])


#: Tags and the parents that they may have. Fixed values.
PARENTS = {
    "tables-tr-parent": (["TR"], ["Table", "THead", "TBody", "TFoot"]),
    "tables-th-td-parent": (["TH", "TD"], ["TR"]),
    "lists-li-parent": (["LI"], ["L"]),
    "lists-lbl-lbody-parent": (["Lbl", "LBody"], ["LI"]),
}


def parent_findings(nodes: DataFrame) -> DataFrame:
    """Nodes (with parent_seq) under a parent that their tag doesn't allow."""
    parent = nodes.select("doc_id", F.col("seq").alias("parent_seq"), F.col("tag").alias("parent_tag"))
    both = nodes.join(parent, ["doc_id", "parent_seq"], "left")
    rule = F.lit(None).cast("string")
    for name, (tags, allowed) in PARENTS.items():
        rule = F.when(F.col("tag").isin(*tags) & ~F.coalesce(F.col("parent_tag").isin(*allowed), F.lit(False)), name).otherwise(rule)
    return both.select("doc_id", "seq", "tag", "parent_tag", rule.alias("rule_id")).where("rule_id is not null")


def subtree_lacks(nodes: DataFrame, root_tag: str, wanted: list[str]) -> DataFrame:
    """Roots without a wanted tag below them: a root's subtree ends at the next node no deeper than it."""
    types = dict(nodes.dtypes)

    def step(stack: list, row: tuple) -> list[tuple]:
        if row[3] in wanted:
            for _, facts in reversed(stack):  # up to the first ancestor that knows already
                if facts.get("found"):
                    break
                facts["found"] = True
        return []

    def end(closed: list) -> list[tuple]:
        return [(row[0], row[1], row[3]) for row, facts in closed if row[3] == root_tag and not facts.get("found")]

    return walked(nodes, "doc_id", "seq", "depth", ["tag"], f"doc_id {types['doc_id']}, seq {types['seq']}, tag string", step, end)


def node_findings(nodes: DataFrame, languages: DataFrame) -> DataFrame:
    """Long table of node rules: language, figure alternatives, empty nodes, tables without headers, lists without items."""
    from docmeter.operators.text import generic_alt

    def rows(df: DataFrame, rule: str, severity: str) -> DataFrame:
        return df.select("doc_id", F.col("seq").cast("int").alias("seq"), F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"))

    figures = nodes.where("tag = 'Figure'")
    missing = F.trim(F.coalesce("alt_text", F.lit(""))) == ""
    out = rows(figures.where(missing), "alt-figures", "error")
    out = out.unionByName(rows(figures.where(~missing & generic_alt(F.col("alt_text"))), "alt-generic", "warning"))
    empty = (F.trim(F.coalesce("text", F.lit(""))) == "") & (F.col("children_count") == 0) & ~F.col("has_content")
    out = out.unionByName(rows(nodes.where(empty & F.col("tag").isin("P", "H1", "H2", "H3", "H4", "H5", "H6", "Span")), "empty-node", "warning"))
    out = out.unionByName(rows(subtree_lacks(nodes, "Table", ["TH"]), "tables-headers", "error"))
    out = out.unionByName(rows(subtree_lacks(nodes, "L", ["LI"]), "lists-items", "error"))
    none = languages.where(F.trim(F.coalesce("lang", F.lit(""))) == "").withColumn("seq", F.lit(None).cast("int"))
    return out.unionByName(rows(none, "doc-language", "error"))


def level_of(facts: DataFrame) -> DataFrame:
    """Conformance level L0 to L4 with what blocks the next: openable, text, tags, machine gate, quality gate, in that order; nulls fail."""

    def ok(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False))

    def blockers(pairs: list[tuple[str, str]]) -> Column:
        return F.array_compact(F.array(*[F.when(~ok(c), F.lit(name)) for c, name in pairs]))

    machine = blockers([("verapdf_passed", "verapdf_failed"), ("has_lang", "missing_lang"), ("display_title", "missing_display_doc_title"), ("has_uaid", "missing_uaid")])
    quality = F.array_compact(F.array(F.when(~ok("conformant"), F.lit("not_conformant")), F.when(F.col("quality_passed").isNull(), F.lit("quality_layer_not_run")).when(~F.col("quality_passed"), F.lit("quality_failed"))))
    stop = (
        F.when(~ok("openable"), F.array(F.lit("not_openable"))).when(~ok("has_text"), F.array(F.lit("no_text_layer"))).when(~ok("has_tags"), F.array(F.lit("untagged")))
        .when(F.size(machine) > 0, machine).otherwise(quality)
    )
    level = F.when(~ok("openable") | ~ok("has_text"), "L0").when(~ok("has_tags"), "L1").when(F.size(machine) > 0, "L2").when(F.size(quality) > 0, "L3").otherwise("L4")
    return facts.withColumn("level", level).withColumn("blocking", stop)


def heading_tiers(lines: DataFrame, least_ratio: float = 1.15, most_words: int = 12) -> DataFrame:
    """Heading levels by font size: body is the most frequent size (ties: the smaller); larger sizes rank 1 to 6."""
    sizes = lines.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("_n"))
    body = sizes.groupBy("doc_id").agg(F.max_by("size", F.struct(F.col("_n"), -F.col("size"))).alias("body"))
    rows = lines.join(body, "doc_id").where((F.col("size") >= F.col("body") * least_ratio) & (F.size(F.split(F.trim("text"), r"\s+")) <= most_words))
    tier = F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.desc("size")))
    return rows.withColumn("level", tier).where("level <= 6")


def sections(lines: DataFrame, key: str, order: str, is_heading: Column) -> DataFrame:
    """Adds section_id: headings so far, 0 before the first."""
    by = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("section_id", F.sum(is_heading.cast("int")).over(by))


def carried_page(lines: DataFrame, key: str, order: str, marker: Column) -> DataFrame:
    """Adds page: the last marker seen."""
    by = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("page", F.last(marker, ignorenulls=True).over(by))


def backtracking(nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document the first node whose page is before that of the node before it."""
    by = Window.partitionBy(key).orderBy("seq")
    seen = nodes.where("page is not null").withColumn("_before", F.lag("page").over(by)).where("page < _before")
    return seen.groupBy(key).agg(F.min("seq").alias("seq"))


def _runs(part: list[int], lo: list[float], hi: list[float], gap: float) -> tuple[list[list[int]], list[float]]:
    """Boxes along an axis, parted at every gap of at least ``gap``, and those gaps."""
    order = sorted(part, key=lo.__getitem__)
    runs, gaps, reach = [[order[0]]], [], hi[order[0]]
    for i in order[1:]:
        free = lo[i] - reach
        if free > 0 and free >= gap:
            runs.append([])
            gaps.append(free)
        runs[-1].append(i)
        reach = max(reach, hi[i])
    return runs, gaps


def _cut_order(boxes: list[int], axes: list[tuple[list[float], list[float]]], gap: float) -> list[int]:
    """Order of boxes by XY cuts at the widest gap, along the first axis where that has one; within what isn't cut, that of their numbers.

    Parts keep the gaps of the first axis that they are cut along, so all of those are cut at once. A cut along the second
    can open gaps of the first; where columns can't, having none themselves and none from each to the next, they part at once too.
    """
    (lo, hi), second = axes
    out: list[int] = []
    waiting = [boxes] if boxes else []
    while waiting:
        part = waiting.pop()
        if len(part) == 1:
            out += part
            continue
        rows, _ = _runs(part, lo, hi, gap)
        if len(rows) > 1:
            waiting += reversed(rows)
            continue
        columns, gaps = _runs(part, *second, gap)
        if len(columns) == 1:
            out += sorted(part)
            continue
        ends = [(min(lo[i] for i in c), max(hi[i] for i in c)) for c in columns]
        free = [max(b[0] - a[1], a[0] - b[1]) for a, b in pairwise(ends)]
        if all(f <= 0 or f < gap for f in free) and all(len(c) == 1 or len(_runs(c, lo, hi, gap)[0]) == 1 for c in columns):
            for c in columns:
                out += sorted(c)
        else:
            k = gaps.index(max(gaps)) + 1
            waiting += [[i for c in side for i in c] for side in (columns[k:], columns[:k])]
    return out


def _page_order(left: list[float], bottom: list[float], right: list[float], top: list[float], gap: float, density: float, cross: float) -> list[int]:
    """Reading order of a page's boxes, which come from the top, equally high ones from the left; those without coordinates come last."""
    known = [i for i, c in enumerate(zip(left, bottom, right, top, strict=True)) if None not in c and not any(map(isnan, c))]
    none = sorted(set(range(len(top))).difference(known))
    widest = max((right[i] - left[i] for i in known), default=0.0)
    wide = [i for i in known if len(known) >= 3 and right[i] - left[i] >= cross * widest]
    main = sorted(set(known).difference(wide)) if wide else known
    area = sum((right[i] - left[i]) * (top[i] - bottom[i]) for i in main)
    region = (max(right[i] for i in main) - min(left[i] for i in main)) * (max(top[i] for i in main) - min(bottom[i] for i in main)) if main else 0.0
    across = [-1.0] * len(top), [-1.0] * len(top)
    down = [-1.0] * len(top), [-1.0] * len(top)
    for i in main:
        across[0][i], across[1][i] = sorted((left[i], right[i]))
        down[0][i], down[1][i] = sorted((-top[i], -bottom[i]))
    order = _cut_order(main, [down, across] if (min(1.0, area / region) if region > 0 else 1.0) > density else [across, down], gap)
    if wide:  # each goes before the first box that lies below its top
        out, at = [], 0
        for i in wide:
            while at < len(order) and top[order[at]] >= top[i]:
                out.append(order[at])
                at += 1
            out.append(i)
        order = out + order[at:]
    return order + none


def reading_order(boxes: DataFrame, gap: float = 5.0, density: float = 0.9, cross: float = 2.0) -> DataFrame:
    """Adds place, the reading order of boxes (left, bottom, right, top; y grows upward) on a page by recursive XY cuts.

    Pages come sorted, a task walks them one after another and holds an Arrow batch and one page.
    """
    sides, columns = ["left", "bottom", "right", "top"], boxes.columns
    schema = T.StructType([*boxes.schema.fields, T.StructField("place", T.LongType())])

    def placed(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        coordinates = [table[f"_{c}"].to_pylist() for c in sides]
        starts = np.flatnonzero(table["_n"].to_numpy() == 1).tolist()
        place = np.empty(len(table), np.int64)
        for a, b in pairwise([*starts, len(table)]):
            order = _page_order(*[c[a:b] for c in coordinates], gap, density, cross)
            for k, i in enumerate(order):
                place[a + i] = k
        out = table.select(columns).append_column("place", pa.array(place))
        yield from out.to_batches()

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # of the page that isn't over yet
        for batch in batches:
            starts = np.flatnonzero(batch.column("_n").to_numpy() == 1)
            if len(starts):
                last = int(starts[-1])
                whole = [p for p in [*waiting, batch.slice(0, last)] if len(p)]
                if whole:
                    yield from placed(whole)
                waiting = []
                batch = batch.slice(last)
            waiting.append(batch)
        if waiting:
            yield from placed(waiting)

    by = Window.partitionBy("doc_id", "page").orderBy(F.desc_nulls_last("top"), F.asc_nulls_last("left"), F.asc_nulls_last("idx"))
    rows = boxes.withColumns({"_n": F.row_number().over(by), **{f"_{c}": F.col(c).cast("double") for c in sides}})
    return rows.mapInArrow(pages, schema)
