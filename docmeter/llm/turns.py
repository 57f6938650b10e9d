"""Turns of conversations numbered in order, with no conversation in one task.

Rows are range-sorted by conversation and turn, numbered within their range, and
shifted by what a conversation has in ranges before. Only conversations that cross
from one range into the next need a shift: at most one a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmeter.llm.common import text_of, written


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """SHA-256 of a turn's role and text, nulls as empty; the role's length keeps them apart."""
    role, text = text_of(role), text_of(text)
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's number in its conversation (first column) so far, and whether the range has no more of it."""
    held: pa.RecordBatch | None = None
    before: tuple[object, int] = (object(), 0)

    def keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        c = batch.column(0)
        return np.asarray(c.fill_null(0)), np.asarray(c.is_null().to_numpy(zero_copy_only=False))

    def out(batch: pa.RecordBatch, after: object) -> pa.RecordBatch:
        nonlocal before
        value, null = keys(batch)
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(value)), 0))
        at = np.arange(len(value)) - start
        if batch.column(0)[0].as_py() == before[0]:
            at += np.where(start == 0, before[1], 0)
        last = batch.column(0)[len(value) - 1].as_py()
        before = last, int(at[-1]) + 1
        ends = np.append(new[1:], last != after)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array(ends)], names=[*batch.schema.names, "at", "ends"])

    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield out(held, batch.column(0)[0].as_py())
            held = batch
    if held is not None:
        yield out(held, object())


def numbered(rows: DataFrame, kept: list[str], turn: str = "turn", tie: str = "digest") -> DataFrame:
    """conv_id and ``kept`` columns with ``pos`` (from 0, by turn, nulls first, then ``tie``) and ``last``. Rows of a null conv_id are one conversation.

    Equal rows differ by their place in the input only, so that any number of them can be cut between ranges.
    """
    rows = rows.select("conv_id", *dict.fromkeys([turn, tie, *kept]), F.monotonically_increasing_id().alias("row_no"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", turn, tie, "row_no")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range_no", F.spark_partition_id())
    rows = rows.select("conv_id", "range_no", *kept)
    schema = T.StructType([*rows.schema.fields, T.StructField("at", T.LongType()), T.StructField("ends", T.BooleanType())])
    placed = written(rows.mapInArrow(_number, schema), "turns")
    ends = placed.where("ends").select("conv_id", "range_no", (F.col("at") + 1).alias("n"))
    cut = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("ranges")).where("ranges > 1").select(F.col("conv_id").alias("cut_id"))
    ends = ends.join(cut, F.col("conv_id").eqNullSafe(F.col("cut_id")), "left_semi")
    of = Window.partitionBy("conv_id").orderBy("range_no")
    shift = ends.select(F.col("conv_id").alias("cut_id"), F.col("range_no").alias("cut_no"), F.coalesce(F.sum("n").over(of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"), F.lead("range_no").over(of).isNotNull().alias("goes_on"))
    # two rows a range at most
    found = placed.join(F.broadcast(shift), F.col("conv_id").eqNullSafe(F.col("cut_id")) & (F.col("range_no") == F.col("cut_no")), "left")
    return found.select("conv_id", *kept, (F.col("at") + F.coalesce("shift", F.lit(0))).alias("pos"), (F.col("ends") & ~F.coalesce("goes_on", F.lit(False))).alias("last"))
