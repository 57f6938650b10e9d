"""The driver's tables as record stores, once as DataFrames and once as SQL (for the oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmeter.scratch import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(k % 7 == 0, "failed").when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "running").otherwise("queued")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("kind"), status.alias("status"), F.lit("work").alias("stage"),
        F.lit(None).cast("string").alias("error"), F.col("o_totalprice").alias("cost"), F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


JOBS = """jobs as (select o_orderkey id, o_custkey owner, o_orderpriority kind, case when o_orderkey % 7 = 0 then 'failed' when o_orderstatus = 'F' then 'done'
 when o_orderstatus = 'P' then 'running' else 'queued' end status, 'work' stage, cast(null as varchar) error, o_totalprice "cost", o_orderdate created_at from orders)"""


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = F.create_map(F.lit("alt_text"), 1 - F.col("l_discount") * 4, F.lit("headings"), 1 - F.col("l_tax") * 2, F.lit("links"), F.col("l_quantity") / 50)
    behaviour = F.create_map(F.lit("headings"), F.col("l_tax") < 0.05, F.lit("tables"), F.col("l_discount") < 0.06)
    kind = F.when(F.col("l_partkey") % 5 == 0, "").otherwise(F.concat(F.lit("type"), (F.col("l_partkey") % 5).cast("string")))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("experiment_id"), F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("line"),
        (F.col("l_suppkey") % 12).alias("harness_id"), F.get(F.array(F.lit("pdf"), F.lit("docx"), F.lit("html")), (F.col("l_partkey") % 3).cast("int")).alias("document_format"),
        kind.alias("document_type"), F.col("l_quantity").cast("int").alias("violations_before"), (F.col("l_linenumber") * 6).cast("int").alias("violations_after"),
        (F.col("l_returnflag") != "R").alias("passed"), (F.col("l_tax") * 100).alias("elapsed_seconds"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), "timeout").alias("error"), dims.alias("quality_dimensions"), behaviour.alias("behavioral_results"),
    )


EXPERIMENTS = """experiments as (select l_orderkey * 10 + l_linenumber experiment_id, l_orderkey document_id, l_linenumber line, l_suppkey % 12 harness_id,
 case l_partkey % 3 when 0 then 'pdf' when 1 then 'docx' else 'html' end document_format, case when l_partkey % 5 = 0 then '' else concat('type', l_partkey % 5) end document_type,
 cast(l_quantity as int) violations_before, l_linenumber * 6 violations_after, l_returnflag <> 'R' passed, l_tax * 100 elapsed_seconds,
 case when l_returnflag = 'R' and l_linenumber = 1 then 'timeout' end error, 1 - l_discount * 4 alt_text, 1 - l_tax * 2 headings, l_quantity / 50 links,
 l_tax < 0.05 b_headings, l_discount < 0.06 b_tables from lineitem),
scores as (select harness_id, document_id, document_format, document_type, 'alt_text' dimension, alt_text score from experiments union all
 select harness_id, document_id, document_format, document_type, 'headings', headings from experiments union all select harness_id, document_id, document_format, document_type, 'links', links from experiments),
behaviours as (select harness_id, document_format, 'headings' dimension, b_headings ok from experiments union all select harness_id, document_format, 'tables', b_tables from experiments)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments(spark, sf_dir).select("harness_id", "document_id", "document_format", "document_type", F.explode("quality_dimensions").alias("dimension", "score"))


def calibrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    text = F.when(e % 97 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "events").select(
        e.alias("calibration_id"), F.col("event_type").alias("judge"), (F.col("user_id") % 40).alias("slice"), F.least(F.col("value") / 100, F.lit(1.0)).alias("kappa"),
        (e % 50 + 1).alias("sample_size"), text.alias("measured_at"),
    )


CALIBRATIONS = """calibrations as (select event_id calibration_id, event_type judge, user_id % 40 slice, least(value / 100, 1.0) kappa, event_id % 50 + 1 sample_size,
 case when event_id % 97 = 0 then 'not a time' else strftime(ts, '%Y-%m-%d %H:%M:%S') end measured_at from events)"""


TAGS = ["H1", "H2", "H3", "H4", "H5", "HX", "P", "Figure", "Table", "TR", "TH", "TD", "L", "LI", "Lbl", "LBody"]


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's nodes in order; a numberless heading has the tag HX. One row a line of an order, the first of repeats."""
    lines = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey")
    n = lines.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("seq")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    tag = F.get(F.array(*[F.lit(t) for t in TAGS]), (F.col("p") % len(TAGS)).cast("int"))
    alt = F.when(F.col("p") % 3 == 0, F.lit("Chart of sales")).when(F.col("p") % 3 == 1, F.lit("chart of  Sales"))
    return n.select("doc_id", "seq", (F.col("s") % 4 + 1).cast("int").alias("depth"), tag.alias("tag"), alt.alias("alt_text"))


_TAGS = "[" + ", ".join(f"'{t}'" for t in TAGS) + "]"
NODES = f"""nodes as (select l_orderkey doc_id, cast(l_linenumber as int) seq, cast(min(l_suppkey) % 4 + 1 as int) depth, {_TAGS}[cast(min(l_partkey) % {len(TAGS)} as int) + 1] tag,
 case when min(l_partkey) % 3 < 2 then 'Chart of sales' end alt_text from lineitem group by 1, 2)"""
