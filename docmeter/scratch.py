"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``: cut lineage, outlive executors."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_at_exit: set[str] = set()


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='docmeter-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/docmeter-tables-{spark.sparkContext.applicationId}"


def _remove(spark: SparkSession, root: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    except Exception:  # the session may be gone already
        pass


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read again; the folder goes when the driver's Python ends."""
    spark = df.sparkSession
    root = _root(spark)
    if root not in _at_exit:
        _at_exit.add(root)
        atexit.register(_remove, spark, root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt over tasks by keys, for aggregates that take far more memory than their compressed rows: a number given isn't cut down to a few tasks by their bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism), *keys)
