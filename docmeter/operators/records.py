"""Record-store operators: scans, overlays, retention, resumption, reconciliation, numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmeter.scratch import kept


def with_status(df: DataFrame, statuses: Sequence[str], column: str = "status") -> DataFrame:
    """Rows with one of the statuses; none for an empty list."""
    return df.where(F.col(column).isin(*statuses)) if statuses else df.limit(0)


def older_than(df: DataFrame, cutoff: Column, column: str = "created_at") -> DataFrame:
    return df.where(F.col(column) < cutoff)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key: the first under ``order``. Spark's window group limit keeps a row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").select(*keys, *rest)


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``new`` rows replace ``base`` rows of the same key."""
    return base.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def overlay(base: DataFrame, patch: DataFrame, keys: Sequence[str], stamp: Column | None = None, stamp_column: str = "updated_at") -> DataFrame:
    """Partial update: non-null patch values win; a patched row gets ``stamp`` even if nothing else changes."""
    patched = [c for c in patch.columns if c not in keys]
    renamed = patch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in patched], F.lit(True).alias("_hit"))
    joined = base.join(renamed, list(keys), "left")
    out = [F.coalesce(f"_new_{c}", c).alias(c) if c in patched else F.col(c) for c in base.columns]
    result = joined.select(*out, "_hit")
    if stamp is not None:
        result = result.withColumn(stamp_column, F.when(F.col("_hit"), stamp).otherwise(F.col(stamp_column)))
    return result.drop("_hit")


def fail_running(df: DataFrame, error: str) -> DataFrame:
    """Crash recovery: running rows become failed and interrupted."""
    running = F.col("status") == "running"
    return df.withColumns({"error": F.when(running, F.lit(error)).otherwise(F.col("error")), "stage": F.when(running, "interrupted").otherwise(F.col("stage")), "status": F.when(running, "failed").otherwise(F.col("status"))})


def prune_expired(df: DataFrame, now: Column, hours: float, statuses: Sequence[str] = ("done", "failed"), column: str = "created_at") -> DataFrame:
    """What stays after retention; hours <= 0 keeps all."""
    if hours <= 0:
        return df
    expired = (F.col(column) < now - F.make_dt_interval(hours=F.lit(int(hours)))) & F.col("status").isin(*statuses)
    return df.where(~F.coalesce(expired, F.lit(False)))


def manifest_done() -> Column:
    """Settled: clean, accepted and clean, or a final failure; an error stays retryable."""
    accepted = F.col("status").isin("clean", "accepted") & F.coalesce("clean", F.lit(False))
    return F.coalesce(accepted | F.col("status").isin("failed"), F.lit(False))


def remaining(files: DataFrame, manifest: DataFrame, key: str, done: Column | None = None) -> DataFrame:
    """Files whose latest manifest row isn't settled."""
    return files.join(manifest.where(manifest_done() if done is None else done).select(key).distinct(), key, "left_anti")


def page_of(df: DataFrame, order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """A page under a total order, with the number of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.orderBy(*order).offset(offset).limit(limit).crossJoin(F.broadcast(total))  # one row


def numbered(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Gapless global numbers from 0 under ``order``, without a task that sees all rows. Ranges are cut once and written: sizes and rows must come from the same cut, whatever executors are lost."""
    ranged = kept(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "ranges")
    ranged = ranged.withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ranged.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_id", "_part", "_at", "_start")  # a row a partition


def strided_shard(df: DataFrame, order: Sequence[str], shards: int) -> DataFrame:
    """Row k under ``order`` goes to shard k mod ``shards``."""
    return numbered(df, order, "_k").withColumn("shard", (F.col("_k") % shards).cast("int")).drop("_k")


def reconcile(expected: DataFrame, found: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Per key: missing, stale, duplicate, drifted or ok."""
    e = expected.groupBy(key).agg(F.count(F.lit(1)).alias("n_expected"), F.min(fingerprint).alias("_e"))
    f = found.groupBy(key).agg(F.count(F.lit(1)).alias("n_found"), F.min(fingerprint).alias("_f"))
    both = e.join(f, key, "full_outer")
    state = (
        F.when(F.col("n_found").isNull(), "missing").when(F.col("n_expected").isNull(), "stale").when(F.col("n_found") > 1, "duplicate")
        .when(~F.col("_e").eqNullSafe(F.col("_f")), "drifted").otherwise("ok")
    )
    return both.select(key, F.coalesce("n_expected", F.lit(0)).alias("n_expected"), F.coalesce("n_found", F.lit(0)).alias("n_found"), state.alias("state"))


def enqueue_new(new: DataFrame, queue: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First new row a key, unless the key waits in the queue already; completed items don't block."""
    waiting = queue.where(F.col("status") != "completed").select(key).distinct()
    return latest_by(new, [key], order).join(waiting, key, "left_anti")


def first_of_violations(df: DataFrame, severity: dict[str, int]) -> DataFrame:
    """Tool violations without repeats: key of tool, id, selector and the first 80 characters of the first snippet; first wins."""
    snippet = F.get("html_snippets", F.lit(0))
    key = F.concat_ws("|", "tool", "id", F.coalesce("selector", F.lit("")), F.when(snippet.isNotNull(), F.substring(snippet, 1, 80)))
    rank = F.create_map(*[F.lit(x) for kv in severity.items() for x in kv])
    rows = latest_by(df.withColumn("_key", key), ["doc_id", "_key"], [F.col("input_order")])
    return rows.withColumn("severity_rank", F.coalesce(F.try_element_at(rank, F.col("impact")), F.lit(len(severity)))).drop("_key")


def page_ranges(pages: DataFrame, key: str, page: str) -> DataFrame:
    """Page numbers as text, runs joined: ``1-3, 5``."""
    distinct = pages.select(key, page).distinct()
    island = distinct.withColumn("_g", F.col(page) - F.row_number().over(Window.partitionBy(key).orderBy(page)))
    runs = island.groupBy(key, "_g").agg(F.min(page).alias("a"), F.max(page).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return runs.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("a", text.alias("t")))), lambda x: x["t"]), ", ").alias("pages"))
