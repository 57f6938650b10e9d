"""The corpus pipeline: language ID, quality rules, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept. All but the last return the columns of ``documents``, and any other columns
that come with them. Rows are told apart by hashes of what they hold, so neither a
missing nor a repeated doc_id costs a row of its own text. Null texts are texts
without letters or words. An empty table gives an empty table in every stage.

Stages run some of their jobs (training, counts, components) while they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmeter.llm import jaccard_join, language_id, mixing, packing, quality_rules, sharding
from docmeter.llm.common import bounded_batches, bucket_crc, facts, scratch_path, small, table, unused, written
from docmeter.llm.tokens import tokenizer_path


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """The rows with columns of these names renamed, and the columns that bring them back."""
    renamed = {c: unused(docs.select(*[x for x in docs.columns if x != c]), f"own_{c}")[0] for c in docs.columns if c in names}
    return docs.withColumnsRenamed(renamed), [F.col(renamed.get(c, c)).alias(c) for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts too), or whose language the calibrated model doubts, go. Repeated rows fare alike."""
    bounded_batches(spark)
    held = F.coalesce(bucket_crc("doc_id", language_id.HELD_OUT[0]) == language_id.HELD_OUT[1], F.lit(False))
    model = language_id.fit(docs, ~held)
    rows, back = set_aside(docs, "lang_pred", "score", "rejected")
    return language_id.identify(rows, model).where("not rejected").select(*back)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base (null and short texts too) or that the voting rules hold for bad go. Repeated rows fare alike."""
    bounded_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that five-word shingles link, one row stays: that with the smallest id, nulls last.

    Of rows with that id the one with the smallest hash of id and text stays, of exact repeats of it one, by a hash of
    all columns. Texts without words link with nothing and stay. Rows of one id whose texts don't link all stay.
    """
    bounded_batches(spark)
    named = written(jaccard_join.jaccard_classes(docs).where("part is not null").select("row", "row2", "id", "part"), "classes")
    best = named.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "row2")).alias("best"), F.count(F.lit(1)).alias("n"))
    gone = named.join(small(written(best.where("n > 1"), "best")), "part").where("row <> best.row or row2 <> best.row2").select("row", "row2").distinct()
    row, row2, whole = unused(docs, "row", "row2", "whole")
    twice = named.groupBy(F.col("row").alias(row), F.col("row2").alias(row2)).count().where("count > 1").select(row, row2)
    twice = written(twice, "repeated")
    keys = jaccard_join.row_hashes()
    stay = docs.select("*", keys[0].alias(row), keys[1].alias(row2))
    stay = stay.join(small(written(gone.toDF(row, row2), "near-copies")), [row, row2], "left_anti")
    if not facts(twice)["rows"]:
        return stay.select(*docs.columns)
    twice = small(twice)
    once = stay.join(twice, [row, row2], "left_semi").groupBy(row, row2).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(whole))
    return stay.join(twice, [row, row2], "left_anti").select(*docs.columns).unionByName(once.select(f"{whole}.*"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last time up to the budget's last word; texts without words aren't taken.

    Equal rows are alike to the mix; all others have an order of their own, so reruns agree.
    """
    bounded_batches(spark)
    rows, back = set_aside(docs, "size", "source_size", "target", "taken")
    [row] = unused(rows, "row")
    rows = rows.withColumn(row, F.xxhash64(*rows.columns))
    mixed = mixing.mix(rows, mixing.word_count(), ["doc_id", row], digits=sharding.hex_digits(docs.count()))
    return mixing.taken_documents(mixed).select(*back)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents (null text: the end token alone) in sequences of at most 2048 tokens, with their ids' checksum."""
    bounded_batches(spark)
    return packing.pieces_digest(packing.pack(docs.select("doc_id", "text"), tokenizer_path()))


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("mix_sources", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models, expectation-maximisation and tokenizers have no SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
