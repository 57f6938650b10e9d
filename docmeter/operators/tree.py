"""Structure trees as node tables: reachability and cycles of a parent graph, subtrees as intervals, content of tagged nodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmeter.operators.structure import walked
from docmeter.operators.text import generic_alt
from docmeter.scratch import dealt, kept


def ends_of_pointers(nodes: DataFrame, pointer: str, key: str = "doc_id", node: str = "node_id") -> DataFrame:
    """Where a node comes to by following ``pointer``: key, node, ``ends`` (``root``, ``lost`` or ``cycle``), ``end`` and ``on_cycle``.

    A null pointer is a root, which ends at itself; one to a node that the document hasn't is lost. Pointers are
    doubled: round k goes 2**k steps, so the rounds grow with the logarithm of the longest way. After 2**k >= nodes of the
    largest document, whoever still goes on is led into a cycle, and stands on one: all such places together are the
    cycles' nodes. Of repeated nodes the one with the smallest pointer counts, nulls first.
    """
    once = nodes.groupBy(key, node).agg(F.min(F.struct(F.col(pointer).isNotNull().alias("set"), F.col(pointer).alias("to"))).alias("p"))
    there = once.select(key, F.col(node).alias("to"), F.lit(True).alias("there"))
    state = once.select(key, node, F.col("p.to").alias("to")).join(there, [key, "to"], "left")
    ends = F.when(F.col("to").isNull(), "root").when(F.col("there").isNull(), "lost")
    state = kept(state.select(key, node, F.when(F.col("there"), F.col("to")).alias("to"), ends.alias("ends"), F.when(F.col("to").isNull(), F.col(node)).alias("end")), "pointers")
    largest = state.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(largest.bit_length()):
        if state.where("ends is null").isEmpty():
            break
        ahead = state.select(F.col(key), F.col(node).alias("to"), F.col("to").alias("far"), F.col("ends").alias("far_ends"), F.col("end").alias("far_end"))
        open_, done = state.where("ends is null"), state.where("ends is not null")
        moved = open_.select(key, node, "to").join(ahead, [key, "to"]).select(key, node, F.col("far").alias("to"), F.col("far_ends").alias("ends"), F.col("far_end").alias("end"))
        state = kept(done.unionByName(moved), "pointers")
    turning = state.where("ends is null").select(key, F.col("to").alias(node), F.lit(True).alias("on_cycle")).distinct()
    return state.join(turning, [key, node], "left").select(key, node, F.coalesce("ends", F.lit("cycle")).alias("ends"), "end", F.coalesce("on_cycle", F.lit(False)).alias("on_cycle"))


def tree_integrity(nodes: DataFrame, entries: DataFrame) -> DataFrame:
    """Findings (doc_id, rule, node_id) of a structure tree.

    nodes: doc_id, node_id, under_id (the node that lists it as a kid; null for the root) and parent_id (its own parent
    reference). entries: doc_id, node_id, what the parent tree refers to. Nodes that the tree leads to are reachable; of those:

    * ``missing-parent``: no parent reference, and not the root,
    * ``unreachable-parent``: it refers to what the tree doesn't lead to,
    * ``parent-cycle``: following parent references comes back to it.

    ``orphan-entry``: the parent tree refers to what the tree doesn't lead to; one finding for each entry.
    """
    reachable = kept(ends_of_pointers(nodes, "under_id").where("ends = 'root'").select("doc_id", "node_id"), "reachable")
    walked_to = nodes.join(reachable, ["doc_id", "node_id"], "left_semi")
    missing = walked_to.where("under_id is not null and parent_id is null").select("doc_id", F.lit("missing-parent").alias("rule"), "node_id")
    parents = reachable.withColumnRenamed("node_id", "parent_id")
    bad = walked_to.where("under_id is not null and parent_id is not null").join(parents, ["doc_id", "parent_id"], "left_anti").select("doc_id", F.lit("unreachable-parent").alias("rule"), "node_id")
    turning = ends_of_pointers(walked_to, "parent_id").where("on_cycle").select("doc_id", F.lit("parent-cycle").alias("rule"), "node_id")
    orphans = entries.join(reachable, ["doc_id", "node_id"], "left_anti").select("doc_id", F.lit("orphan-entry").alias("rule"), "node_id")
    return reduce(DataFrame.unionByName, [missing, bad, turning, orphans])


def integrity_result(documents: DataFrame, findings: DataFrame) -> DataFrame:
    """doc_id, status (Passed or Failed) and the number of findings of each kind."""
    kinds = ["missing-parent", "unreachable-parent", "parent-cycle", "orphan-entry"]
    counts = findings.groupBy("doc_id").agg(*[F.count_if(F.col("rule") == k).alias(k.replace("-", "_")) for k in kinds])
    names = [k.replace("-", "_") for k in kinds]
    out = documents.select("doc_id").distinct().join(counts, "doc_id", "left").fillna(0, names)
    return out.select("doc_id", F.when(sum((F.col(n) for n in names), F.lit(0)) > 0, "Failed").otherwise("Passed").alias("status"), *names)


def subtree_ends(nodes: DataFrame) -> DataFrame:
    """doc_id, seq, stop: a node and all below it are the places seq to stop - 1 of its document, in order. A sorted walk with a stack; a chain of any depth is as cheap as a flat list.

    nodes: doc_id, seq (gapless in a document), depth.
    """
    types = dict(nodes.dtypes)

    def step(stack: list, row: tuple) -> list[tuple]:
        for _, facts in stack[-1:]:
            facts["to"] = row[1]
        return []

    def end(closed: list) -> list[tuple]:
        # deepest first: a node reaches as far as what closes with it, or as its last kid
        out, to = [], -1
        for row, facts in reversed(closed):
            to = max(to, facts.get("to", row[1]))
            out.append((row[0], row[1], to + 1))
        return out

    return walked(nodes, "doc_id", "seq", "depth", [], f"doc_id {types['doc_id']}, seq {types['seq']}, stop long", step, end)


def count_below(intervals: DataFrame, items: DataFrame) -> DataFrame:
    """Adds ``below`` to intervals (doc_id, seq, stop): items (doc_id, seq) with a place in them.

    Not a join of intervals with what lies in them, which has depth times items rows: running counts of items at either end, subtracted.
    """
    ends = intervals.select("doc_id", F.col("seq").cast("long").alias("seq"), F.explode(F.array(F.struct(F.col("seq").cast("long").alias("at"), F.lit(-1).alias("sign")), F.struct(F.col("stop").cast("long").alias("at"), F.lit(1).alias("sign")))).alias("e"))
    ends = ends.select("doc_id", "seq", "e.at", "e.sign", F.lit(0).alias("n"))
    marks = items.select("doc_id", F.lit(None).cast("long").alias("seq"), F.col("seq").cast("long").alias("at"), F.lit(0).alias("sign"), F.lit(1).alias("n"))
    before = Window.partitionBy("doc_id").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = ends.unionByName(marks).withColumn("so_far", F.sum("n").over(before)).where("sign <> 0")
    found = counted.groupBy("doc_id", "seq").agg(F.sum(F.col("sign") * F.col("so_far")).alias("below"))
    return intervals.drop("below").join(found, ["doc_id", "seq"], "left")


#: Structure types that convey text, types whose alternative text may stand beside annotations or children, and parts of names that say a type is no text. Fixed values.
TEXT_TYPES = """Document Part Sect Div Art P Span Link Reference Annot H H1 H2 H3 H4 H5 H6 L LI Lbl LBody TR TH TD THead TBody TFoot Table Caption
BlockQuote Quote Note TOC TOCI Index BibEntry Code Artifact NonStruct""".split()
ANNOTATED_TYPES = ["Link", "Reference", "Annot", "Form"]
KEEPS_ALT = ["Figure", "Table", "Form", "Formula", "Link", "Annot", "Reference", "Note", "BibEntry"]
NOT_TEXTUAL = ["figure", "image", "formula", "formfield", "artifact", "table", "chart", "graphic"]
TEXTUAL = """normal p paragraph subtitle covertitle coversubtitle reportnumber appleconvertedspace author toc hyperlink palhyperlink hyperlinkpalhyperlink""".split()
TEXTUAL_PARTS = ["title", "subtitle", "paragraph", "normal", "author", "hyperlink", "bodytext", "text"]
#: Documents of more pages aren't asked for rendered content.
DEEP_PAGES = 50


def looks_textual(name: Column) -> Column:
    """Whether a structure type that isn't a standard one says that it carries text; ``name`` in lower case, letters and digits only."""
    holds = lambda parts: F.exists(F.array(*map(F.lit, parts)), lambda x: F.contains(name, x))
    known = name.isin(*TEXTUAL) | name.startswith("toc") | name.startswith("heading")
    return (name != "") & ~holds(NOT_TEXTUAL) & (known | holds(TEXTUAL_PARTS))


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def _content_facts(nodes: DataFrame, contents: DataFrame, rendered: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, seq, tag, alt_text, children of nodes, what their own contents are (any, annotation, mcids, paged, shown (text or image), text) and their document's pages.

    All rows are dealt once by document and meet in windows: no join or aggregate deals them anew, to few tasks by their bytes. Rows with null keys meet nothing.
    """
    whole = lambda df, *keys: df.dropna(subset=list(keys))
    seen = whole(rendered, "doc_id", "page", "mcid").select("doc_id", "page", "mcid", (~_blank(F.col("text"))).alias("with_text"), F.coalesce("image", F.lit(False)).alias("with_image"))
    rows = nodes.select("doc_id", "seq", "tag", "alt_text", "children", F.lit(True).alias("node"))
    rows = rows.unionByName(whole(contents, "doc_id", "seq").select("doc_id", "seq", "page", "mcid", F.coalesce("kind", F.lit("")).alias("kind")), allowMissingColumns=True)
    rows = rows.unionByName(seen.where("with_text or with_image"), allowMissingColumns=True).unionByName(whole(pages, "doc_id").select("doc_id", "pages"), allowMissingColumns=True)
    place, node = Window.partitionBy("doc_id", "page", "mcid"), Window.partitionBy("doc_id", "seq")
    rows = dealt(rows, "doc_id").withColumn("with_text", F.max("with_text").over(place)).withColumn("with_image", F.max("with_image").over(place))
    rows = rows.where("node or kind is not null or pages is not null")
    own, kind = F.col("kind").isNotNull(), F.col("kind")
    facts = {
        "any": own,
        "annotation": kind == "annotation",
        "mcids": kind == "mcid",
        "paged": (kind == "mcid") & F.col("page").isNotNull(),
        "text": own & F.col("with_text"),
        "shown": own & (F.col("with_text") | F.col("with_image")),
    }
    facts = {c: F.coalesce(F.max(x).over(node), F.lit(False)) for c, x in facts.items()}
    return rows.select("doc_id", "seq", "tag", "alt_text", "children", "node", *[x.alias(c) for c, x in facts.items()], F.max("pages").over(Window.partitionBy("doc_id")).alias("pages")).where("node")


def alt_content_findings(nodes: DataFrame, contents: DataFrame, rendered: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, seq, rule_id, problem of alternative texts and content.

    nodes: doc_id, seq, tag, alt_text, children (structure elements among its kids). contents: doc_id, seq, kind (``mcid``, ``annotation``, ``object``),
    page, mcid. rendered: doc_id, page, mcid, text, image. pages: doc_id, pages.

    * ``alt-associated``: an alternative text on a node without content (Table and Formula may have children instead), or whose content shows neither
      text nor image; nodes with an annotation, without marked content, without a page and in documents of over 50 pages are taken as shown.
    * ``alt-hides-annotation``: an alternative text on a node, not a link or form, that has an annotation.
    * ``alt-elements``: a node with content, of a type that isn't text and without text in it, has no alternative text or a placeholder.
    * ``alt-redundant``: an alternative text on a container all of whose kids are tagged.
    """
    facts = _content_facts(nodes, contents, rendered, pages)
    has_alt, container = F.col("alt_text").isNotNull(), F.col("tag").isin("Table", "Formula")
    tied = F.col("any") | (container & (F.col("children") > 0))
    shown = F.col("annotation") | ~F.col("mcids") | ~F.col("paged") | (F.coalesce("pages", F.lit(0)) > DEEP_PAGES) | F.col("shown")
    name = F.regexp_replace(F.lower("tag"), "[^a-z0-9]+", "")
    textual = F.col("tag").isin(*TEXT_TYPES) | looks_textual(name)
    findings = F.array_compact(F.array(
        F.when(has_alt & ~tied, _found("alt-associated", "no content")),
        F.when(has_alt & tied & ~shown, _found("alt-associated", "nothing rendered")),
        F.when(has_alt & ~F.col("tag").isin(*ANNOTATED_TYPES) & F.col("annotation"), _found("alt-hides-annotation", "annotation")),
        F.when(F.col("any") & ~textual & ~F.col("text") & ~has_alt, _found("alt-elements", "missing")),
        F.when(F.col("any") & ~textual & ~F.col("text") & has_alt & generic_alt(F.col("alt_text")), _found("alt-elements", "placeholder")),
        F.when(has_alt & ~F.col("tag").isin(*KEEPS_ALT) & (F.col("children") > 0) & ~F.col("any"), _found("alt-redundant", "children are tagged")),
    ))
    return facts.select("doc_id", "seq", F.explode(findings).alias("f")).select("doc_id", "seq", "f.rule_id", "f.problem")


def _found(rule: str, problem: str) -> Column:
    return F.struct(F.lit(rule).alias("rule_id"), F.lit(problem).alias("problem"))


def figures_with_images(nodes: DataFrame, contents: DataFrame, rendered: DataFrame) -> DataFrame:
    """Figures (doc_id, seq) with the number of placed images among their content and that of all nodes below them."""
    images = rendered.where("image").select("doc_id", "page", "mcid").distinct()
    placed = contents.where("kind = 'mcid'").join(images, ["doc_id", "page", "mcid"], "left_semi").select("doc_id", "seq")
    figures = nodes.where("tag = 'Figure'").select("doc_id", "seq")
    return count_below(subtree_ends(nodes.select("doc_id", "seq", "depth")).join(figures, ["doc_id", "seq"], "left_semi"), placed).select("doc_id", "seq", F.col("below").alias("images"))


def undescribed_fields(fields: DataFrame) -> DataFrame:
    """Form fields without a description. fields: doc_id, origin (``form`` or ``widget``), name, description. A widget counts if it has a name, each name once a document; a field of the form always does, without a name as ``unnamed``."""
    bare = fields.where(_blank(F.col("description"))).where("origin = 'form' or coalesce(name, '') <> ''")
    return bare.select("doc_id", F.coalesce("name", F.lit("unnamed")).alias("name")).distinct()


def tables_without_summary(nodes: DataFrame) -> DataFrame:
    """Per document with tables: how many, and how many have neither an alternative text nor a summary."""
    tables = nodes.where("tag = 'Table'").groupBy("doc_id")
    return tables.agg(F.count(F.lit(1)).alias("tables"), F.count_if(F.col("alt_text").isNull() & F.col("summary").isNull()).alias("bare"))
