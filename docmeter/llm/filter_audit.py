"""Filter interaction audit: what each filter removes at each place of every order of the filters.

Rows become a mask of the filters that they fail. Masks are counted by part, so all
that follows works on at most 2**n cells a part, however many rows those hold. Cells
meet the steps of all orders in long form: a running bit-or over a cell's steps
tells what failed before, conditional sums give a step's counts, and a window
over a part's rows of one filter gives its total.

Defined results: a null failure counts as passed, a null part is the part ''. Every
part of the input has a row for each order and step, zeros included. An empty
table has no part and gives an empty table. Repeated rows count as often as they come.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmeter.llm.common import WORD, table, text_of, unused, written

#: n filters have n! orders; more than this many make more rows than anyone reads.
MOST_FILTERS = 7


def cells(rows: DataFrame, filters: dict[str, Column], part: Column, losses: dict[str, Column]) -> DataFrame:
    """Rows counted by part and mask (bit k: fails the k-th filter), with the rows that meet each condition of ``losses``."""
    mask = sum((F.when(F.coalesce(fails, F.lit(False)), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())), F.lit(0))
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in losses.items()]]
    return rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"), *[c.alias(name) for name, c in losses.items()]).groupBy("part", "mask").agg(*counts)


def audit(counted: DataFrame, filters: list[str], losses: list[str]) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, ``losses``, shapley.

    ``counted`` comes from :func:`cells`. ``filter_order`` is the names one after the other.
    """
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters")
    # an order is the filters' numbers as digits: one literal, however many orders there are
    orders = F.split(F.lit(",".join("".join(map(str, p)) for p in permutations(range(len(filters))))), ",")
    # few rows for each key, and both the window and the sums below are by part and order
    in_order = counted.select("*", F.explode(orders).alias("digits")).repartition("part", "digits")
    long = in_order.select("*", F.posexplode(F.split("digits", "")).alias("at", "digit"))
    long = long.withColumn("bit", F.expr("shiftleft(1, cast(digit as int))")).withColumn("fails", F.col("mask").bitwiseAND(F.col("bit")))
    sooner = Window.partitionBy("part", "digits", "mask").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    long = long.withColumn("before", F.coalesce(F.bit_or("fails").over(sooner), F.lit(0)))
    fails, fresh = F.col("fails") > 0, F.col("before") == 0
    total = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("long")
    steps = long.groupBy("part", "digits", "at", "digit").agg(
        total("n", ~fails & fresh).alias("kept"),
        total("n", fails & fresh).alias("removed"),
        total("n", fails & ~fresh).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        *[total(c, fails & fresh).alias(c) for c in losses],
    )
    steps = steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "digit")))
    name = F.array_join(F.transform(F.split("digits", ""), lambda d: F.element_at(F.array(*map(F.lit, filters)), d.cast("int") + 1)), "")
    steps = steps.withColumn("filter_order", name).withColumn("step", F.col("at") + 1)
    return steps.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *losses, "shapley")


def repeats_flagged(rows: DataFrame, digest: str, key: str, flag: str) -> DataFrame:
    """Adds ``flag``: whether a row of a smaller key has the same digest. Rows without a key neither repeat nor are repeated.

    The smallest key of a digest is found with partial sums, and the rows meet it by digest and key together, so
    a digest of a third of all rows heats no task. ``rows`` are read twice; write them first.
    """
    [first] = unused(rows, "first")
    least = rows.groupBy(digest).agg(F.min(key).alias(key)).where(F.col(key).isNotNull()).withColumn(first, F.lit(True))
    found = rows.join(least, [digest, key], "left")
    return found.withColumn(flag, F.col(first).isNull() & F.col(key).isNotNull()).select(*[c for c in rows.columns if c != flag], flag)


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: too few words, repeated words, upper case, markup."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(65) * n,
        "C": F.lit(100) * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > F.lit(5) * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: five filters over all ``documents``, by source, with the ``labels`` that each step loses.

    Labels of one document count once: it is good, or toxic, if any of its rows says so. E compares texts by SHA-256.
    """
    docs = table(spark, sf_dir, "documents")
    fails = text_failures(text_of())
    narrow = docs.select("doc_id", F.col("source").alias("part"), F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest"), *[c.alias(f"fails_{k}") for k, c in fails.items()])
    flagged = repeats_flagged(written(narrow, "filter-masks"), "digest", "doc_id", "fails_E")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good_lost"), F.max(F.col("toxic") == 1).alias("toxic_lost"))
    names, losses = [*fails, "E"], ["good_lost", "toxic_lost"]
    counted = cells(flagged.join(labels, "doc_id", "left"), {k: F.col(f"fails_{k}") for k in names}, F.col("part"), {c: F.col(c) for c in losses})
    return audit(counted, names, losses)
