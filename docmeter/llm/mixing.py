"""Mixing sources to target weights, cut at each source's exact budget.

Rows get a hash-random key. Within a source they are ordered by it; the space
of keys is cut into ranges by leading hex digits, token counts are summed per
(source, range), prefix sums over the ranges place each range, and a window
inside a range places each row. No task holds a source, however hot. A budget
above the source's size repeats whole epochs first; the last, partial epoch
ends in the middle of a row if the budget does.

Defined results: null or negative sizes count as 0; the null source is a source
of its own; rows of size 0 are taken 0 times; an empty table gives an empty
table. Repeated rows are ordered by the rank that the window gives them, so the
sum taken is exact for them too. Result columns replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmeter.llm.common import WORD, facts, md5_key, table, text_of, unused, written
from docmeter.llm.sharding import hex_digits

#: By rank of the source's name, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row a source: source, source_size, target.

    ``sizes`` has source and size. Targets share ``share`` of all sizes by weight;
    a target above ``epochs`` times its source's size stops there and the excess
    goes to the others by weight, until none is above. Closed form: with sources in
    order of cap / weight, those before the first one that fits are at their caps
    and the rest share what is left. One row a source is all that meets here.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    each = each.withColumn("_w", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    each = each.withColumn("_cap", F.lit(float(epochs)) * F.col("source_size"))
    order = Window.orderBy((F.col("_cap") / F.col("_w")), F.col("source").asc_nulls_last())
    earlier, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    each = (
        each.withColumn("_left", F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
        .withColumn("_w_left", F.sum("_w").over(rest))
        .withColumn("_level", F.col("_left") / F.col("_w_left"))
    )
    fits = F.col("_cap") >= F.col("_w") * F.col("_level")
    first_fit = F.min(F.when(fits, F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(Window.partitionBy())
    each = each.withColumn("_final", first_fit["_level"])
    return each.select("source", "source_size", F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * F.col("_final"))).alias("target"))


def mix(df: DataFrame, size: Column, key: list[str], source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, epochs: int = MOST_EPOCHS, digits: int = 2) -> DataFrame:
    """The rows with size, source_size, target, taken.

    ``key`` columns seed the hash-random order and break its ties; rows equal in them are alike to the mix. ``digits`` hex digits cut a source
    into 16**digits ranges.
    """
    kept = [c for c in df.columns if c not in ("size", "source_size", "target", "taken")]
    by, order, part, base, total, goal, budget = unused(df, "by", "order", "part", "base", "total", "goal", "budget")
    ties = unused(df, *[f"tie{i}" for i in range(len(key))])
    size_col = F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).cast("long")
    rows = df.select(*kept, size_col.alias("size"), F.col(source).alias(by), md5_key(*key).alias(order), *[F.col(c).alias(t) for c, t in zip(key, ties, strict=True)])
    rows = rows.withColumn(part, F.substring(order, 1, digits))
    ranges = rows.groupBy(by, part).agg(F.sum("size").alias("n"))
    targets = source_targets(ranges.select(F.col(by).alias("source"), F.col("n").alias("size")), weights, share, epochs)
    earlier = Window.partitionBy(by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    placed = placed.join(targets, placed[by].eqNullSafe(targets["source"])).select(
        F.col(by).alias("s"), F.col(part).alias("r"), F.col("before").alias(base), F.col("source_size").alias(total), F.col("target").alias(goal), F.round("target").cast("long").alias(budget)
    )
    joined = rows.join(placed, rows[by].eqNullSafe(placed["s"]) & (rows[part] == placed["r"])).drop(placed["s"], placed["r"])
    inside = Window.partitionBy(by, part).orderBy(order, *[F.col(c).asc_nulls_first() for c in ties]).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col(base) + F.coalesce(F.sum("size").over(inside), F.lit(0))
    whole = F.when(F.col(total) > 0, F.floor(F.col(budget) / F.greatest(F.col(total), F.lit(1)))).otherwise(0).cast("long")
    last = F.col(budget) - whole * F.col(total)
    taken = whole * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), last - before))
    return joined.select(*kept, "size", F.col(total).alias("source_size"), F.col(goal).alias("target"), taken.cast("long").alias("taken"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: the mix over the whole ``documents`` table. Texts are read and their words counted once."""
    docs = written(table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size")), "word-counts")
    return mix(docs, F.col("size"), ["doc_id", "size"], digits=hex_digits(facts(docs)["rows"])).select("doc_id", "size", "source_size", "target", "taken")


def taken_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """A row of ``mixed`` for each epoch that takes it, the last cut after its last taken word; none for 0 taken."""
    [epoch] = unused(mixed, "epoch")
    part = F.col("taken") % F.greatest(F.col("size"), F.lit(1))
    epochs = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rows = mixed.where(epochs > 0).withColumn(epoch, F.explode(F.sequence(F.lit(1), epochs)))
    words = F.slice(F.expr(f"regexp_extract_all(`{text}`, '{WORD.replace(chr(92), chr(92) * 2)}', 0)"), 1, F.greatest(part, F.lit(1)).cast("int"))
    cut = (F.col(epoch) == epochs) & (part > 0)
    return rows.withColumn(text, F.when(cut, F.array_join(words, " ")).otherwise(F.col(text))).drop(epoch)
