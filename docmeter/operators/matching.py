"""Fuzzy matching of headers by the ratio of their longest matching blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmeter.scratch import dealt

#: Least ratio of a match. Fixed value.
LEAST_RATIO = 0.6


def normal_header(text: Column) -> Column:
    """Lower case, white space as one blank, then letters a to z, digits and blanks only."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "), "[^a-z0-9 ]", ""))


def block_ratio(a: str, b: str, least: float, matcher: SequenceMatcher | None = None) -> float | None:
    """Twice the length of the matching blocks by the length of both; None where the letters in common already rule ``least`` out. A matcher given is reused; what it knows of ``b`` stays."""
    both = len(a) + len(b)
    if 2 * sum((Counter(a) & Counter(b)).values()) < least * both:
        return None
    matcher = matcher or SequenceMatcher(None)
    if matcher.b != b:
        matcher.set_seq2(b)
    matcher.set_seq1(a)
    return matcher.ratio()


def _ratios(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, last, ratio = SequenceMatcher(None), None, None
        for batch in batches:
            found = []
            for pair in zip(*(batch.column(k).to_pylist() for k in (1, 2)), strict=True):
                if pair != last:  # equal pairs of several tables follow one another
                    last, ratio = pair, block_ratio(*pair, least, matcher)
                found.append(ratio)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "ratio"])

    return run


def _texts(headers: DataFrame, name: str) -> DataFrame:
    """A table's different normalised headers that aren't empty; repeated headers are normalised once."""
    return headers.select("table_id", "header").distinct().select("table_id", normal_header(F.col("header")).alias(name)).where(F.col(name) != "").distinct()


def header_ratios(headers: DataFrame, suggested: DataFrame, least: float = LEAST_RATIO) -> DataFrame:
    """Ratios of a table's normalised headers with the suggestions for it, each pair of different texts once.

    A ratio is at most 2 min(m, n) / (m + n) of the lengths: pairs below ``least`` by that never leave the join. Those
    below it by the letters they share have a null ratio. Pairs are dealt over tasks by their texts, since the tables
    are far smaller than their pairs, and sorted, so that a pair of many tables is matched once.
    """
    a = _texts(headers, "a")
    firsts = suggested.groupBy("table_id", "header").agg(F.min("idx").alias("idx"))
    b = firsts.select("table_id", normal_header(F.col("header")).alias("b"), "idx").where("b <> ''").groupBy("table_id", "b").agg(F.min("idx").alias("idx"))
    pairs = a.join(b, (a["table_id"] == b["table_id"]) & (F.lit(2.0) * F.least(F.length("a"), F.length("b")) >= least * (F.length("a") + F.length("b")))).select(a["table_id"], "a", "b", "idx")
    types = dict(pairs.dtypes)
    return dealt(pairs, "a", "b").sortWithinPartitions("b", "a").mapInArrow(_ratios(least), f"table_id {types['table_id']}, a string, b string, idx {types['idx']}, ratio double")


def match_headers(headers: DataFrame, suggested: DataFrame, least: float = LEAST_RATIO) -> DataFrame:
    """Adds matched, scope and ratio to headers (table_id, header, others) from suggestions (table_id, idx, header, scope).

    A suggestion that is equal when normalised is taken first (the first of them, an empty header matches an empty one), else the one with the highest
    ratio of at least ``least``, the first of equals; headers that match nothing keep nulls.
    """
    asked = headers.drop("matched", "scope", "ratio").withColumn("_a", normal_header(F.col("header")))
    own = suggested.select("table_id", "idx", F.col("header").alias("matched"), "scope", normal_header(F.col("header")).alias("_a"))
    firsts = suggested.groupBy("table_id", "header").agg(F.min_by(F.struct(F.col("header").alias("matched"), "scope"), "idx").alias("e"), F.min("idx").alias("idx"))
    exact = firsts.withColumn("_a", normal_header(F.col("header"))).groupBy("table_id", "_a").agg(F.min_by("e", "idx").alias("e"))
    other = headers.select("table_id", "header").distinct().withColumn("_a", normal_header(F.col("header"))).join(exact, ["table_id", "_a"], "left_anti")
    ratios = header_ratios(other, suggested, least)
    best = ratios.where(F.col("ratio") >= least).groupBy("table_id", F.col("a").alias("_a")).agg(F.max(F.struct("ratio", (-F.col("idx")).alias("first"))).alias("best"))
    best = best.select("table_id", "_a", "best.ratio", (-F.col("best.first")).alias("idx")).join(own.select("table_id", "idx", F.struct("matched", "scope").alias("f")), ["table_id", "idx"])
    out = asked.join(exact, ["table_id", "_a"], "left").join(best.drop("idx"), ["table_id", "_a"], "left")
    found = F.coalesce("e", "f")
    return out.select(*[c for c in asked.columns if c != "_a"], found["matched"].alias("matched"), found["scope"].alias("scope"), F.when(F.col("e").isNotNull(), 1.0).otherwise(F.col("ratio")).alias("ratio"))


def pairs_pruned(headers: DataFrame, suggested: DataFrame, least: float = LEAST_RATIO) -> DataFrame:
    """Per table: pairs of different normalised texts, and how many of them lengths and letters ruled out before blocks were matched."""
    side = lambda df: _texts(df, "t").groupBy("table_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = side(headers).withColumnRenamed("n", "m").join(side(suggested), "table_id")
    met = header_ratios(headers, suggested, least).groupBy("table_id").agg(F.count(F.lit(1)).alias("met"), F.count("ratio").alias("matched"))
    out = sizes.join(met, "table_id", "left").fillna(0, ["met", "matched"])
    return out.select("table_id", (F.col("m") * F.col("n")).alias("pairs"), (F.col("m") * F.col("n") - F.col("met")).alias("by_length"), (F.col("met") - F.col("matched")).alias("by_letters"))
