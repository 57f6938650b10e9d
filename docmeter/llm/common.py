"""What the operators share: tables, words, scratch tables, batches.

Column rule for every operator: it works on the columns named by its
parameters, keeps all other columns where it returns the input's rows, and
its result columns replace input columns of the same name. Columns that it needs
in between get names that the input doesn't have (``unused``).
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Characters that part words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
BLANKS = f"[{SPACE}]+"

_dropped_at_exit: set[str] = set()


#: Bytes of an Arrow batch where the session sets none: texts' lengths differ too much for a number of rows to bound one.
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches that go to Python hold about ``ARROW_BYTES``, unless the session says how much."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, ARROW_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bucket_crc(column: str, mod: int) -> Column:
    """crc32 of an id written as text, modulo ``mod``; null ids give null."""
    return F.crc32(F.col(column).cast("string")) % mod


def crc32_text(column: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes."""
    return F.crc32(F.encode(column, "UTF-8"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that the rows don't have yet, after these."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def md5_key(*columns: str) -> Column:
    """32 hex digits that order rows at random, the same in every run."""
    return F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]).cast("binary"))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; one of our own only where that is unset and driver and executors are one process (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='docmeter-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/docmeter-{spark.sparkContext.applicationId}"


def _drop(spark: SparkSession, root: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    except Exception:  # the session may be gone already
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; everything under it goes when the driver's Python ends."""
    root = scratch_root(spark)
    if root not in _dropped_at_exit:
        _dropped_at_exit.add(root)
        atexit.register(_drop, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *sums: Column) -> DataFrame:
    """The rows written as Parquet into the shared folder and read again: cuts lineage, outlives executors.

    The write counts the rows as they pass, and any ``sums`` (named aggregates), for :func:`facts`: no job of its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums).write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    # an empty plan may be cut short before anything is counted
    out._docmeter_facts = seen.get or out.agg(F.count(F.lit(1)).alias("rows"), *sums).first().asDict()
    return out


def facts(df: DataFrame) -> dict:
    """What was counted while a table from :func:`written` was written."""
    return df._docmeter_facts


#: Rows of narrow keys that may be broadcast; more go through a shuffle join.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows, from :func:`written`, with a broadcast hint if there are at most ``most``, else without."""
    known = getattr(df, "_docmeter_facts", None)
    return F.broadcast(df) if known and known["rows"] <= most else df


def sliced(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``most_bytes`` of the column's data (one row at least)."""
    for batch in batches:
        n, data = batch.num_rows, batch.column(column)
        if data.nbytes <= most_bytes:
            if n:
                yield batch
            continue
        start, held = 0, 0
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in data]
        for i, size in enumerate(sizes):
            if i > start and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start, n - start)
