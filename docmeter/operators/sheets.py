"""Workbook navigation: what a sheet's first cells are about, and what its name says of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words that say nothing of a sheet, words of sheets that belong first, and the score of each issue. Fixed values.
STOPWORDS = ["and", "data", "details", "info", "information", "sheet", "table", "the", "workbook"]
OVERVIEW = ["contents", "dashboard", "index", "overview", "summary"]
ISSUE_SCORES = {"non_descriptive_sheet_name": 0.0, "sheet_name_purpose_unclear": 0.5, "overview_sheet_not_first": 0.5, "data_sheet_hidden": 0.75}
#: Cells that are read, to the end of the row that reaches them, and terms that are kept. Fixed values.
CELLS, TERMS = 60, 8


def terms(text: Column) -> Column:
    """Different words of three letters or digits and more, a letter first, lower case, without stopwords."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z][a-z0-9]{2,}"), F.lit(0)))
    return F.array_except(found, F.array(*map(F.lit, STOPWORDS)))


def content_terms(cells: DataFrame, most_cells: int = CELLS, most_terms: int = TERMS) -> DataFrame:
    """Per sheet: terms (those in most cells, ties by name) and cells read. cells: book, sheet, row, value; sheets without a filled cell have no row.

    Whole rows are read until one reaches ``most_cells`` filled cells. As many filled rows suffice, so rows are ranked up to
    that number before any running count, and no sheet's rows meet in one task however long it is.
    """
    filled = cells.where(F.trim(F.coalesce("value", F.lit(""))) != "").select("book", "sheet", "row", "value")
    counts = filled.groupBy("book", "sheet", "row").agg(F.count(F.lit(1)).alias("n"))
    by_row = Window.partitionBy("book", "sheet").orderBy("row")
    near = counts.withColumn("place", F.row_number().over(by_row)).where(F.col("place") <= most_cells)
    read = near.withColumn("before", F.coalesce(F.sum("n").over(by_row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("before") < most_cells)
    size = read.groupBy("book", "sheet").agg(F.sum("n").alias("cells"))
    words = filled.join(read.select("book", "sheet", "row"), ["book", "sheet", "row"]).select("book", "sheet", F.explode(terms(F.col("value"))).alias("term"))
    ranked = words.groupBy("book", "sheet", "term").agg(F.count(F.lit(1)).alias("n"))
    top = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("book", "sheet").orderBy(F.desc("n"), "term"))).where(F.col("rank") <= most_terms)
    listed = top.groupBy("book", "sheet").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias("terms"))
    return size.join(listed, ["book", "sheet"], "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))


def sheet_issues(sheets: DataFrame) -> DataFrame:
    """Adds issues and score to sheets (name, place from 1, state, terms; others stay): the lowest score of an issue, 1 without any.

    A descriptive name has four characters and isn't ``sheet`` with a number. Hidden sheets with data, names that share no word with
    the content (where both have some to share), and an overview that isn't the first sheet are issues too.
    """
    name = F.lower(F.trim(F.coalesce("name", F.lit(""))))
    descriptive = (F.length(name) >= 4) & ~name.rlike(r"^sheet\d+$")
    own = terms(F.col("name"))
    overlap = lambda other: F.arrays_overlap(own, other)
    listed = F.coalesce("terms", F.array().cast("array<string>"))
    found = F.array_compact(F.array(
        F.when(~descriptive, "non_descriptive_sheet_name"),
        F.when(~F.col("state").eqNullSafe("visible"), "data_sheet_hidden"),
        F.when(descriptive & (F.size(listed) > 0) & ~overlap(listed), "sheet_name_purpose_unclear"),
        F.when((F.col("place") > 1) & overlap(F.array(*map(F.lit, OVERVIEW))), "overview_sheet_not_first"),
    ))
    scores = F.create_map(*[F.lit(x) for kv in ISSUE_SCORES.items() for x in kv])
    return sheets.withColumn("issues", found).withColumn("score", F.coalesce(F.array_min(F.transform("issues", lambda x: F.element_at(scores, x))), F.lit(1.0)))
