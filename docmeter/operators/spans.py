"""Contrast of text spans against the rectangle that lies under them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmeter.functions.color import contrast, luminance

#: Tile sizes of the grid: a rectangle goes to the smallest tiles that are as large as it, so it covers four at most.
TILES = [8, 32, 128, 512, 2048, 8192, 32768]
#: Ratio below which text fails, and luminance below which a background under black text is taken for a photograph. Fixed values.
LEAST_CONTRAST = 3.0
PHOTOGRAPH = 0.4


def _tile(x: Column, size: Column) -> Column:
    return F.floor(x / size).cast("long")


def backgrounds(spans: DataFrame, rectangles: DataFrame) -> DataFrame:
    """Adds ``bg_r, bg_g, bg_b`` to spans: the colour of the topmost rectangle that holds the span's centre; null where none does.

    spans: doc_id, page, span, x0, y0, x1, y1 and others; rectangles: doc_id, page, paint (a later one lies on top), x0, y0, x1, y1, r, g, b.
    Points meet rectangles by tile: a rectangle is in four tiles of one size at most, a point in one tile of each size that the page has, so
    a page of any number of rectangles only compares those about as large as their distance. Of rectangles in one place only the topmost meets spans.
    Rectangles without area, or larger than the largest tile, hold nothing.
    """
    same = rectangles.where("x1 > x0 and y1 > y0").groupBy("doc_id", "page", "x0", "y0", "x1", "y1").agg(F.max(F.struct("paint", "r", "g", "b")).alias("top"))
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    size = F.lit(None).cast("int")
    for t in reversed(TILES):
        size = F.when(extent <= t, t).otherwise(size)
    sized = same.withColumn("tile", size).where("tile is not null")
    across = sized.withColumn("tx", F.explode(F.sequence(_tile(F.col("x0"), F.col("tile")), _tile(F.col("x1"), F.col("tile")))))
    tiled = across.withColumn("ty", F.explode(F.sequence(_tile(F.col("y0"), F.col("tile")), _tile(F.col("y1"), F.col("tile")))))
    tiled = tiled.select("doc_id", "page", "tile", "tx", "ty", *[F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")], "top")
    # a page's points only go to tiles of the sizes that its rectangles have
    used = sized.groupBy("doc_id", "page").agg(F.collect_set("tile").alias("tiles"))
    at = spans.join(used, ["doc_id", "page"]).select("doc_id", "page", "span", "tiles", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    at = at.select("*", F.explode("tiles").alias("tile")).drop("tiles").withColumns({"tx": _tile(F.col("cx"), F.col("tile")), "ty": _tile(F.col("cy"), F.col("tile"))})
    under = at.join(tiled, ["doc_id", "page", "tile", "tx", "ty"]).where("cx >= r_x0 and cx <= r_x1 and cy >= r_y0 and cy <= r_y1")
    top = under.groupBy("doc_id", "page", "span").agg(F.max("top").alias("top"))
    out = spans.drop("bg_r", "bg_g", "bg_b").join(top, ["doc_id", "page", "span"], "left")
    return out.select("*", *[F.col(f"top.{c}").alias(f"bg_{c}") for c in "rgb"]).drop("top")


def failing_spans(spans: DataFrame) -> DataFrame:
    """Adds ``fails`` to spans with backgrounds (text, size, r, g, b, x0 to y1, bg_r, bg_g, bg_b).

    Blank text never fails. Without a background the page is white; near-white text there that is narrow or low is hidden,
    not failing. Black text on a dark background lies on a photograph, text of up to 6 points is too small to tell.
    """
    unknown = F.col("bg_r").isNull()
    hidden = unknown & (F.least("r", "g", "b") >= 245) & ((F.greatest(F.col("x1") - F.col("x0"), F.lit(0)) <= 12) | (F.greatest(F.col("y1") - F.col("y0"), F.lit(0)) <= 16))
    under = F.when(unknown, 1.0).otherwise(luminance(F.col("bg_r"), F.col("bg_g"), F.col("bg_b")))
    photograph = (F.greatest("r", "g", "b") <= 32) & (under < PHOTOGRAPH)
    low = contrast(luminance(F.col("r"), F.col("g"), F.col("b")), under) < LEAST_CONTRAST
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    return spans.withColumn("fails", ~blank & ~hidden & ~photograph & low & (F.col("size") > 6))


def page_contrast(spans: DataFrame) -> DataFrame:
    """doc_id, page, spans, failing, status: a page fails if more spans do than one, or than one in a hundred. Blank spans don't count."""
    shown = spans.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    out = shown.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("spans"), F.count_if("fails").alias("failing"))
    tolerated = F.greatest(F.lit(1), F.floor(F.col("spans") / 100))
    return out.withColumn("status", F.when(F.col("failing") > tolerated, "Failed").otherwise("Passed"))
