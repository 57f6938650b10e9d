"""Rules over pages: string-level findings on the JVM, element tables in Arrow batches, fixes needed over those."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN_SCHEMA = "seq int, depth int, tag string, attrs map<string,string>, text string"


def _has(pattern: str, html: str = "html") -> Column:
    return F.coalesce(F.col(html), F.lit("")).rlike(pattern)


def count_tags(tag: str, html: str = "html") -> Column:
    return F.regexp_count(F.lower(F.coalesce(F.col(html), F.lit(""))), F.lit(rf"<{tag}[\s/>]"))


def landmark_findings(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """A row a page: what the head and the landmarks lack. No parsing: a single pass of expressions."""
    t = F.lower(F.coalesce(F.col(html), F.lit("")))
    return pages.select(
        key,
        (~F.ltrim(t).startswith("<!doctype")).alias("missing_doctype"),
        (t.rlike(r"<html[\s>]") & ~t.rlike(r"<html[^>]*\slang\s*=\s*[\"']?[a-z]")).alias("missing_lang"),
        (~t.rlike(r"<title[^>]*>[^<]*[^<\s]")).alias("missing_title"),
        (~t.rlike(r"<meta[^>]*name\s*=\s*[\"']?viewport")).alias("missing_viewport"),
        (~t.rlike(r"<main[\s>]|role\s*=\s*[\"']main")).alias("missing_main"),
        (~t.rlike(r"<nav[\s>]")).alias("missing_nav"),
        (~t.rlike(r"href\s*=\s*[\"']#main|class\s*=\s*[\"'][^\"']*skip")).alias("missing_skip_link"),
        F.size(F.filter(F.regexp_extract_all(t, F.lit(r"<img[^>]*>"), F.lit(0)), lambda x: ~x.rlike(r"\salt\s*="))).alias("images_without_alt"),
    )


def link_counts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return pages.select(key, count_tags("a", html).alias("links"), count_tags("li", html).alias("items"), count_tags("p", html).alias("paragraphs"), count_tags("h[1-6]", html).alias("headings"))


def elements(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """A row an element: key, seq, depth, tag, attrs, text. Pages that don't parse have no rows."""
    from docmeter.operators import dom

    rows = pages.select(key, html)
    schema = T.StructType([rows.schema.fields[0], *T.StructType.fromDDL(TOKEN_SCHEMA).fields])
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                at, out = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    found = dom.tokens(text or "")
                    at += [i] * len(found)
                    out += found
                if out:
                    columns = [pa.array([list(v.items()) for v in c] if pa.types.is_map(k) else c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def fixes_needed(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, fix, places: how often a page needs each fix; fixes that it doesn't need, and pages without elements, have no row.

    A table cell or caption belongs to the last table that opened before it, a field to the label for its id or
    to one that it is the first element of. Empty headings don't count in the order of levels. One shuffle, by page.
    """
    from docmeter.operators.text import GENERIC_LINKS

    def has(name: str) -> Column:
        return F.trim(F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit(""))) != ""

    def attr(name: str) -> Column:
        return F.lower(F.trim(F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit(""))))

    tag, text, link = F.col("tag"), F.lower("text"), F.col("tag") == "a"
    told = F.concat_ws(" ", text, attr("aria-label"), attr("title"))
    safe = attr("rel").contains("noopener") & attr("rel").contains("noreferrer") & told.rlike("new (window|tab)")
    field = tag.isin("input", "select", "textarea") & ~attr("type").isin("hidden", "submit", "button", "reset", "image")
    #: What an element shows by itself; texts and attributes go no further than this.
    alone = {
        "blank": text == "",
        "lang": (tag == "html") & ~has("lang"),
        "nameless_link": link & has("href") & (text == "") & ~has("aria-label") & ~has("title"),
        "generic_link": link & text.isin(*GENERIC_LINKS["html"]) & ~has("aria-label"),
        "new_window": link & (attr("target") == "_blank") & ~safe,
        "img_alt": (tag == "img") & ~F.map_contains_key("attrs", F.lit("alt")),
        "img_mute": (tag == "img") & ~has("alt"),
        "nameless_field": field & ~has("aria-label") & ~has("aria-labelledby") & ~has("title"),
        "title": (tag == "title") & (text != ""),
        "viewport": (tag == "meta") & (attr("name") == "viewport"),
        "main": (tag == "main") | (attr("role") == "main"),
        "skip_link": link & (attr("href").startswith("#main") | attr("class").contains("skip") | text.contains("skip")),
        "data_table": (tag == "table") & ~attr("role").isin("presentation", "none"),
        "caption": (tag == "caption") | ((tag == "table") & has("aria-label")),
        "id": F.try_element_at("attrs", F.lit("id")),
        "for_id": F.when(tag == "label", F.try_element_at("attrs", F.lit("for"))),
    }
    page = Window.partitionBy(key)
    order = page.orderBy("seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.lead("depth").over(order) > F.col("depth"), F.lit(False))
    under = F.when(F.lag("depth").over(order) < F.col("depth"), F.lag("tag").over(order))
    heading = tag.rlike("^h[1-6]$")
    e = elements(pages, key, html).select(key, "seq", "depth", "tag", *[x.alias(n) for n, x in alone.items()])
    e = e.withColumns({"inside": inside, "under": F.coalesce(under, F.lit(""))})
    e = e.withColumn("level", F.when(heading & (~F.col("blank") | F.col("inside")), F.substring("tag", 2, 1).cast("int")))
    e = e.withColumns({
        "prior": F.coalesce(F.last("level", True).over(before), F.lit(0)),
        "tab": F.last(F.when(tag == "table", F.col("seq")), True).over(order),
        "labelled": F.collect_set("for_id").over(page),
    })
    places = {
        **{n: F.col(n) for n in ("lang", "generic_link", "new_window", "img_alt")},
        "empty_heading": heading & F.col("level").isNull(),
        "heading_level": F.col("level") > F.col("prior") + 1,
        "empty_link": F.col("nameless_link") & ~F.col("inside"),
        "linked_img_alt": F.col("img_mute") & (F.col("under") == "a"),
        "form_label": F.col("nameless_field") & (F.col("under") != "label") & ~F.coalesce(F.array_contains("labelled", F.col("id")), F.lit(False)),
    }
    #: What a page must have, if it has the element that it goes into.
    needed = {"title": "head", "viewport": "head", "main": "body", "skip_link": "body"}

    def count(x: Column) -> Column:
        return F.count(F.when(x, 1))

    by_table = e.groupBy(key, "tab").agg(
        *[count(x).alias(n) for n, x in places.items()], *[count(F.col(n)).alias(n) for n in needed],
        *[count(tag == n).alias(f"n_{n}") for n in ("head", "body")], count(F.col("data_table")).alias("tables"),
        count(tag == "th").alias("headers"), count(F.col("caption")).alias("captions"),
    )
    whole = by_table.groupBy(key).agg(
        *[F.sum(n).alias(n) for n in places],
        *[((F.sum(f"n_{holder}") > 0) & (F.sum(n) == 0)).cast("long").alias(n) for n, holder in needed.items()],
        count((F.col("tables") > 0) & (F.col("headers") == 0)).alias("table_header"),
        count((F.col("tables") > 0) & (F.col("captions") == 0)).alias("table_caption"),
    )
    names = [*places, *needed, "table_header", "table_caption"]
    found = F.explode(F.array(*[F.struct(F.lit(n).alias("fix"), F.col(n).alias("places")) for n in names]))
    return whole.select(key, found.alias("found")).select(key, "found.fix", "found.places").where("places > 0")


def heading_levels(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, seq, level of each heading tag in order."""
    tags = F.regexp_extract_all(F.lower(F.coalesce(F.col(html), F.lit(""))), F.lit(r"<h([1-6])[\s>]"), F.lit(1))
    return pages.select(key, F.posexplode(tags).alias("seq", "_l")).select(key, "seq", F.col("_l").cast("int").alias("level"))


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, link_index, text, target of each link, whatever its attributes' order, quotes and case and the markup inside."""
    from docmeter.operators import dom

    rows = pages.select(key, html)
    schema = T.StructType([rows.schema.fields[0], *T.StructType.fromDDL("link_index int, text string, target string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                at, out = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    found = dom.links(text or "")
                    at += [i] * len(found)
                    out += found
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int32(), pa.string(), pa.string()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)
