"""Readers and sinks: JSON lines with a bad-row policy, Parquet versions, file listings and signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: str, bad: str = "reject") -> tuple[DataFrame, DataFrame]:
    """(rows, rejected). bad: ``drop`` skips malformed lines, ``reject`` returns them with file and text, ``raise`` fails."""
    if bad == "raise":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path), spark.createDataFrame([], "file string, line string")
    fields = T.StructType.fromDDL(schema).fields
    full = T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_name").alias("file"))
    parsed = rows.where(F.trim("value") != "").select("file", "value", F.from_json("value", full, {"mode": "PERMISSIVE"}).alias("r"))
    broken = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    good = parsed.where(~broken).select(*[F.col("r").getField(f.name).alias(f.name) for f in fields])
    rejected = parsed.where(broken).select("file", F.col("value").alias("line"))
    return good, rejected.limit(0) if bad == "drop" else rejected


def read_jsonl_in_order(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows with file, block and line ordinals, so that the last line of a key can win."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    parsed = rows.select("file", "block", "line", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.where("r is not null").select("file", "block", "line", "r.*")


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def rewrite(df: DataFrame, path: str, kind: str = "json") -> None:
    """Replaces a table as a whole: writes beside it, then renames twice. Rows are never mixed, but a reader that lists the folder between the renames finds none."""
    spark = df.sparkSession
    jvm = spark._jvm
    final, staged, old = (jvm.org.apache.hadoop.fs.Path(path + x) for x in ("", ".new", ".old"))
    fs = final.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    df.write.mode("overwrite").format(kind).save(path + ".new")
    fs.delete(old, True)
    if fs.exists(final):
        fs.rename(final, old)
    fs.rename(staged, final)
    fs.delete(old, True)


def backup(df: DataFrame, root: str, stamp: str, keep: int) -> list[str]:
    """Writes version ``stamp`` under ``root`` and deletes all but the newest ``keep``; returns those kept."""
    df.write.mode("overwrite").parquet(f"{root}/version={stamp}")
    spark = df.sparkSession
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = sorted(s.getPath().getName() for s in fs.listStatus(top) if s.getPath().getName().startswith("version="))
    for name in names[: max(0, len(names) - max(keep, 1))]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), True)
    return names[-max(keep, 1) :]


def list_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """path, length and modificationTime of files below ``root``; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime").orderBy("path")


#: Leading bytes of file types. Fixed values.
SIGNATURES = {"pdf": "25504446", "docx": "504B0304", "pptx": "504B0304", "xlsx": "504B0304", "epub": "504B0304", "png": "89504E470D0A1A0A", "jpeg": "FFD8FF"}


def signature_matches(content: str, declared: str):
    """Whether a binary column begins as its declared type (a string column) says; null for unknown types."""
    head = F.hex(F.substring(F.col(content), 1, 8))
    out = F.lit(None).cast("boolean")
    for kind, magic in SIGNATURES.items():
        out = F.when(F.lower(declared) == kind, head.startswith(magic)).otherwise(out)
    return out


def sheet_markdown(cells: DataFrame) -> DataFrame:
    """cells(doc_id, sheet, row, col, value) to one markdown table a sheet: empty rows dropped, short ones padded, pipes escaped, a rule after the first row."""
    filled = cells.where(F.trim(F.coalesce("value", F.lit(""))) != "").groupBy("doc_id", "sheet").agg(F.max("col").alias("width"))
    rows = cells.groupBy("doc_id", "sheet", "row").agg(
        F.map_from_entries(F.collect_list(F.struct("col", F.replace(F.coalesce("value", F.lit("")), F.lit("|"), F.lit("\\|"))))).alias("cells"),
        F.bool_or(F.trim(F.coalesce("value", F.lit(""))) != "").alias("any"),
    )
    rows = rows.where("any").join(filled, ["doc_id", "sheet"])
    line = F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(1), F.col("width").cast("int")), lambda i: F.coalesce(F.element_at("cells", i), F.lit(""))), " | "), F.lit(" |"))
    rows = rows.withColumn("line", line).withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "sheet").orderBy("row")))
    rule = F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), F.col("width").cast("int")))
    rows = rows.withColumn("line", F.when(F.col("n") == 1, F.concat("line", rule)).otherwise(F.col("line")))
    return rows.groupBy("doc_id", "sheet").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("markdown"))
