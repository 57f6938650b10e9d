"""Image references of recognised pages, repaired from the images that the pages really have."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A page marker and an image reference in markdown. Fixed values.
PAGE_MARKER = r"<!--\s*Page\s+(\d+)\s*-->"
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
_BLANK = r"\s\u000B\u001C-\u001F\u0085\p{Z}"
#: White space at a text's end; a run elsewhere is looked at once.
TAIL = f"(?<![{_BLANK}])[{_BLANK}]++\\z"
MISSING = "MISSING_IMAGE"


def repaired_references(documents: DataFrame, images: DataFrame) -> DataFrame:
    """documents (doc_id, text) with references to images that exist; images: doc_id, page, idx (their order on the page), filename.

    A text is cut at page markers; what stands before the first is page 1. In each section the k-th reference to a file that the document hasn't
    gets the page's k-th image, or ``MISSING_IMAGE`` when there are no more. Images of a page that nothing up to its first section with text
    refers to are added at that section's end. Documents without images stay as they are. References, sections and images meet by joins on rank;
    only a document's own pieces come together again, in order.
    """
    has = images.select("doc_id").distinct()
    asked = documents.join(has, "doc_id", "left_semi")
    pages = F.regexp_extract_all("text", F.lit(PAGE_MARKER), F.lit(1))
    parts = asked.select("doc_id", pages.alias("pages"), F.posexplode(F.split("text", PAGE_MARKER, -1)).alias("section", "body"))
    number = F.when(F.col("section") == 0, "1").otherwise(F.regexp_replace(F.get("pages", F.col("section") - 1), r"^0+(?=\d)", ""))
    sections = parts.select("doc_id", "section", number.alias("number"), number.try_cast("long").alias("page"), "body")

    found = sections.select("doc_id", "section", "page", F.posexplode(F.arrays_zip(F.regexp_extract_all("body", F.lit(IMAGE), F.lit(1)).alias("alt"), F.regexp_extract_all("body", F.lit(IMAGE), F.lit(2)).alias("path"))).alias("place", "m"))
    known = images.select("doc_id", F.col("filename").alias("path"), F.lit(True).alias("known")).distinct()
    refs = found.select("doc_id", "section", "page", "place", "m.alt", "m.path").join(known, ["doc_id", "path"], "left")
    in_section = Window.partitionBy("doc_id", "section", F.col("known").isNull()).orderBy("place")
    refs = refs.withColumn("rank", F.when(F.col("known").isNull(), F.row_number().over(in_section)))
    ranked = images.select("doc_id", "page", "filename", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("idx")).alias("rank"))
    refs = refs.join(ranked, ["doc_id", "page", "rank"], "left").withColumn("to", F.when(F.col("known"), F.col("path")).otherwise(F.coalesce("filename", F.lit(MISSING))))

    # a section's text between its references, and the references as they are now
    text = F.transform(F.split("body", IMAGE, -1), lambda x, k: F.struct((2 * k).alias("at"), x.alias("piece")))
    pieces = sections.select("doc_id", "section", F.explode(text).alias("p")).select("doc_id", "section", "p.at", "p.piece")
    put = refs.select("doc_id", "section", (2 * F.col("place") + 1).alias("at"), F.concat(F.lit("!["), "alt", F.lit("]("), "to", F.lit(")")).alias("piece"))
    joined = pieces.unionByName(put).groupBy("doc_id", "section").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "").alias("body"))
    whole = sections.select("doc_id", "section", "number", "page").join(joined, ["doc_id", "section"])

    first_full = whole.where(F.regexp_replace("body", TAIL, "") != "").groupBy("doc_id", "page").agg(F.min("section").alias("section"))
    used = refs.where(F.col("to") != MISSING).groupBy("doc_id", F.col("to").alias("filename")).agg(F.min("section").alias("used"))
    left = ranked.join(first_full, ["doc_id", "page"]).join(used, ["doc_id", "filename"], "left").where("used is null or used > section")
    # a file that several pages have is added by the first section that finds it unused
    left = left.withColumn("turn", F.dense_rank().over(Window.partitionBy("doc_id", "filename").orderBy("section"))).where("turn = 1")
    line = F.concat(F.lit("\n![Image from page "), F.col("page").cast("string"), F.lit("]("), "filename", F.lit(")\n"))
    more = left.groupBy("doc_id", "section").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "").alias("more"))
    body = F.when(F.col("more").isNull(), F.col("body")).otherwise(F.concat(F.regexp_replace("body", TAIL, ""), F.lit("\n"), "more"))
    marked = F.when(F.col("section") == 0, body).otherwise(F.concat(F.lit("<!-- Page "), "number", F.lit(" -->"), body))
    texts = whole.join(more, ["doc_id", "section"], "left").groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("section", marked.alias("t")))), lambda x: x["t"]), "").alias("repaired"))
    return documents.join(texts, "doc_id", "left").withColumn("text", F.coalesce("repaired", "text")).drop("repaired")
