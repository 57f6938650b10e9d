"""Structured Streaming over event rows; each function also runs on a batch DataFrame, with the same rows in the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """A stream of the Parquet files under ``path``, with ts as timestamp."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "events", F.round("total", 4).alias("total"))


def sliding(events: DataFrame, width: str, step: str, late: str = "1 hour") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width, step)).agg(F.count(F.lit(1)).alias("events"))
    return out.select(F.col("window.start").alias("window_start"), "events")


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return out.select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """First row a key within the watermark; on a batch plainly one row a key."""
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Works off what there is and stops; rows land as Parquet under ``path``, exactly once by the checkpoint."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_latest(stream: DataFrame, path: str, checkpoint: str, key: str, order: str, keep: int = 2) -> None:
    """Keeps a table of the latest row a key: each batch is merged with the newest version before it into one of its own number.

    A repeated batch writes the same version anew, so it changes nothing. Only a table without versions starts empty; a
    version that can't be read fails the batch. The newest ``keep`` versions stay.
    """
    from docmeter.operators.records import latest_by

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        top = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        found = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
        versions = sorted(int(x.removeprefix("version=")) for x in found if x.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{x}/_SUCCESS")))
        before = [v for v in versions if v < number]
        rows = batch.unionByName(spark.read.parquet(f"{path}/version={before[-1]}")) if before else batch
        latest_by(rows, [key], [F.desc(order)]).write.mode("overwrite").parquet(f"{path}/version={number}")
        for v in before[: max(0, len(before) + 1 - max(2, keep))]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={v}"), True)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
