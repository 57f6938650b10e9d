"""Jump consistent hashing: key and shard count decide a row's shard.

All on the JVM: the 64-bit recurrence runs in 32-bit halves, so no product
leaves a signed long even with ANSI arithmetic on. No ring table, no state, no
shuffle for the shard itself; only the gapless slot needs one narrow shuffle.

Defined results: a null key hashes as key 0. An empty table gives an empty
table. Repeated rows get the same shard and different slots. Columns that the
input has under the names of the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmeter.llm.common import crc32_text, md5_key, table, text_of, unused

#: Multiplier of the published jump-hash generator, in halves.
MULTIPLIER = 2862933555777941757
_C_LO, _C_HI = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_MASK = 0xFFFFFFFF


def _times(x: Column, factor: int) -> tuple[Column, Column]:
    """x (below 2^32) times factor (below 2^32): the low 32 bits and the rest."""
    low, high = x * (factor & 0xFFFF), x * (factor >> 16)
    total = low + F.shiftleft(high.bitwiseAND(0xFFFF), 16)
    return total.bitwiseAND(_MASK), F.shiftright(total, 32) + F.shiftright(high, 16)


def _stepped(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64, in halves."""
    new_lo, carry = _times(lo, _C_LO)
    bumped = new_lo + 1
    upper = carry + F.shiftright(bumped, 32) + _times(hi, _C_LO)[0] + _times(lo, _C_HI)[0]
    return upper.bitwiseAND(_MASK), bumped.bitwiseAND(_MASK)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a long key. Each jump goes forward, so ``shards`` steps always do."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(_MASK).alias("lo"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )

    def jump(s: Column, _: Column) -> Column:
        hi, lo = _stepped(s["hi"], s["lo"])
        ahead = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.when(s["j"] >= shards, s).otherwise(F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"), ahead.cast("long").alias("j")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["b"].cast("int"))


def assign_shards(df: DataFrame, key: str, shards: int, grown: int | None = None) -> DataFrame:
    """The rows with ``shard``, and with ``grown_shard`` for a larger count. A projection: no shuffle."""
    out = df.withColumn("shard", jump_shard(F.col(key), shards))
    return out.withColumn("grown_shard", jump_shard(F.col(key), grown)) if grown else out


#: Rows of one range of hashes, about; a window holds a range.
RANGE_ROWS = 50_000


def hex_digits(rows: int) -> int:
    """Hex digits of a hash that cut so many rows, all of one key, into ranges of about ``RANGE_ROWS``; 2 at least."""
    digits = 2
    while rows > RANGE_ROWS * 16**digits:
        digits += 1
    return digits


def number_slots(df: DataFrame, identity: list[str], digits: int) -> DataFrame:
    """Adds ``slot``: gapless from 0 in each shard, in the order of md5(identity), identity.

    ``identity`` columns must name a row up to exact repeats. Repeats collapse to
    a count before the shuffle, so no number of them heats a task. Each shard is
    cut by the first ``digits`` hex digits of the hash; per-cut counts are summed
    up in a table of 16**digits rows a shard, so no task ever holds a shard.
    """
    n, key, cut, base, first = unused(df, "n", "key", "cut", "base", "first")
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))
    counted = counted.withColumn(key, md5_key(*identity)).withColumn(cut, F.substring(key, 1, digits))
    cuts = counted.groupBy("shard", cut).agg(F.sum(n).alias(base))
    before = Window.partitionBy("shard").orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.select("shard", cut, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy("shard", cut).orderBy(key, *[F.col(c).asc_nulls_first() for c in identity]).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.join(cuts, ["shard", cut]).withColumn(first, F.col(base) + F.coalesce(F.sum(n).over(inside), F.lit(0)))
    kept = [c for c in df.columns if c != "slot"]
    return placed.select(*kept, F.explode(F.sequence(F.col(first), F.col(first) + F.col(n) - 1)).alias("slot"))


def op4_jump_shards(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    """Contract digest of the whole ``documents`` table under the law ``key``."""
    docs = table(spark, sf_dir, "documents")
    digits = hex_digits(docs.count())  # Parquet's own count
    docs = assign_shards(docs, "doc_id", shards, shards + 1)
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        crc32_text(text_of()).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "grown_shard",
    )
    return number_slots(narrow, ["doc_id", "size", "text_crc32"], digits).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
