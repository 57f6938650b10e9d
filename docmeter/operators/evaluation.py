"""Evaluation analytics: metrics, agreement, drift, frontiers, promotion, sampling, splits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEAK_BELOW = 0.80
KAPPA_LEAST = 0.60
LIFT_LEAST = 0.05
REGRESSION_MOST = -0.02


def unit_interval(text: Column) -> Column:
    """A stable number in [0, 1]: the first 16 hex digits of SHA-256."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 16), 16, 10).cast("double") / F.lit(18446744073709551615.0)


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(F.round(part / whole, 4))


def success_rate(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.coalesce(F.round(F.avg(F.col("passed").cast("int")), 6), F.lit(0.0)).alias("success_rate"), F.count(F.lit(1)).alias("total"))


def variant_metrics(experiments: DataFrame) -> DataFrame:
    """Per variant: documents, passed, conformance, harmful edits, mean seconds of those that took any."""
    took = F.when(F.col("elapsed_seconds") > 0, F.col("elapsed_seconds"))
    return experiments.groupBy("harness_id").agg(
        F.count(F.lit(1)).alias("total_docs"),
        F.count_if("passed").alias("passed_docs"),
        F.round(F.avg(F.col("passed").cast("int")), 6).alias("conformance_rate"),
        F.count_if(F.col("violations_after") > F.col("violations_before")).alias("destructive_edits"),
        F.round(F.coalesce(F.avg(took), F.lit(0.0)), 4).alias("avg_seconds"),
    )


def dimension_metrics(experiments: DataFrame) -> DataFrame:
    """Mean score and pass rate a dimension over the union of their keys; n is the larger count."""
    scores = experiments.select(F.explode("quality_dimensions").alias("dimension", "score")).groupBy("dimension").agg(F.avg("score").alias("_mean"), F.count("score").alias("_ns"))
    passes = experiments.select(F.explode("behavioral_results").alias("dimension", "ok")).groupBy("dimension").agg(F.avg(F.col("ok").cast("int")).alias("_rate"), F.count("ok").alias("_np"))
    both = scores.join(passes, "dimension", "full_outer")
    return both.select("dimension", F.round("_mean", 6).alias("mean_score"), F.round("_rate", 6).alias("pass_rate"), F.greatest(F.coalesce("_ns", F.lit(0)), F.coalesce("_np", F.lit(0))).alias("n"))


def weak_dimensions(scores: DataFrame) -> DataFrame:
    """scores(document_format, document_type, dimension, score): means below WEAK_BELOW, compared unrounded, overall, by format, by type and by both; blank types count overall and by format only."""
    grain = F.grouping_id()
    means = scores.cube("document_format", "document_type", "dimension").agg(F.avg("score").alias("_mean"), F.count(F.lit(1)).alias("n"), grain.alias("_g"), F.grouping("dimension").alias("_d"), F.grouping("document_type").alias("_t"))
    kept = means.where((F.col("_d") == 0) & (F.col("_mean") < WEAK_BELOW) & ((F.col("_t") == 1) | (F.trim("document_type") != "")))
    return kept.select("document_format", "document_type", "dimension", F.round("_mean", 6).alias("mean_score"), "n", F.shiftright("_g", 1).cast("int").alias("grain"))


def usage_rollup(calls: DataFrame) -> DataFrame:
    """calls(provider, tokens_in, tokens_out): per provider and, with a null provider, in all."""
    return calls.rollup("provider").agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def level_burndown(documents: DataFrame) -> DataFrame:
    """Counts by root and level with totals; blanks get names."""
    named = documents.select(
        F.when(F.trim(F.coalesce("root", F.lit(""))) == "", "(unknown)").otherwise(F.col("root")).alias("root"),
        F.when(F.trim(F.coalesce("level", F.lit(""))) == "", "unclassified").otherwise(F.col("level")).alias("level"),
    )
    out = named.cube("root", "level").agg(F.count(F.lit(1)).alias("documents"))
    return out.select(F.coalesce("root", F.lit("*")).alias("root"), F.coalesce("level", F.lit("*")).alias("level"), "documents")


def cohens_kappa(pairs: DataFrame, by: Sequence[str], left: str, right: str) -> DataFrame:
    """Agreement of two label columns a group: kappa to 6 digits, n. With expected agreement 1: 1 if observed is, else 0."""
    cells = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(*by, left, right).agg(F.count(F.lit(1)).alias("_c"))
    total = cells.groupBy(*by).agg(F.sum("_c").alias("n"), F.sum(F.when(F.col(left) == F.col(right), F.col("_c")).otherwise(0)).alias("_same"))
    a = cells.groupBy(*by, F.col(left).alias("_v")).agg(F.sum("_c").alias("_a"))
    b = cells.groupBy(*by, F.col(right).alias("_v")).agg(F.sum("_c").alias("_b"))
    chance = a.join(b, [*by, "_v"]).groupBy(*by).agg(F.sum(F.col("_a") * F.col("_b")).alias("_ab"))
    whole = total.join(chance, list(by), "left") if by else total.crossJoin(F.broadcast(chance))  # one row each
    po, pe = F.col("_same") / F.col("n"), F.coalesce("_ab", F.lit(0)) / (F.col("n") * F.col("n"))
    kappa = F.when(pe == 1, F.when(po == 1, 1.0).otherwise(0.0)).otherwise((po - pe) / (1 - pe))
    return whole.select(*by, F.round(kappa, 6).alias("kappa"), "n")


def drift_alerts(calibrations: DataFrame, by: Sequence[str], window: int, least_n: int, least_kappa: float = KAPPA_LEAST) -> DataFrame:
    """Groups whose sample-weighted kappa over the last ``window`` measurements is below the threshold."""
    last = Window.partitionBy(*by).orderBy(F.desc("measured_at"), F.desc("calibration_id"))
    recent = calibrations.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= max(1, window))
    pooled = recent.groupBy(*by).agg(F.sum(F.col("kappa") * F.col("sample_size")).alias("_w"), F.sum("sample_size").alias("sample_size"), F.count(F.lit(1)).alias("measurements"))
    pooled = pooled.withColumn("weighted_kappa", F.col("_w") / F.col("sample_size")).where((F.col("sample_size") >= least_n) & (F.col("weighted_kappa") < least_kappa))
    return pooled.select(*by, F.round("weighted_kappa", 6).alias("weighted_kappa"), "sample_size", "measurements")


def calibration_status(required: DataFrame, calibrations: DataFrame, by: Sequence[str], now: Column, most_days: int, least_kappa: float = KAPPA_LEAST) -> DataFrame:
    """Per requirement: missing, malformed, stale, ok or below, tested in that order. Times that don't parse sort as latest, so they block."""
    parsed = F.try_to_timestamp("measured_at")
    order = [parsed.isNull().desc(), parsed.desc(), F.desc("measured_at"), F.desc("calibration_id")]
    latest = calibrations.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").withColumn("_at", parsed)
    both = required.join(latest.withColumn("_hit", F.lit(True)), list(by), "left")
    stale = F.lit(False) if most_days <= 0 else F.col("_at") < now - F.make_dt_interval(days=F.lit(most_days))
    status = F.when(F.col("_hit").isNull(), "missing").when(F.col("_at").isNull(), "malformed").when(stale, "stale").when(F.col("kappa") >= least_kappa, "ok").otherwise("below")
    return both.select(*by, "kappa", status.alias("status"))


def judge_ensemble(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population variance over judges; failing below WEAK_BELOW."""
    out = scores.groupBy(*by).agg(F.avg("score").alias("_m"), F.coalesce(F.var_pop("score"), F.lit(0.0)).alias("_v"), F.count(F.lit(1)).alias("judges"))
    return out.select(*by, F.round("_m", 6).alias("score"), F.round("_v", 6).alias("variance"), "judges", (F.col("_m") < WEAK_BELOW).alias("failing"))


def behaviour_overrides(verdicts: DataFrame, tests: DataFrame, by: Sequence[str]) -> DataFrame:
    """verdicts(by, failing), tests(by, applicable, passed): any applicable failure fails, all passing clears, none leaves the verdict."""
    ran = tests.where("applicable").groupBy(*by).agg(F.bool_and("passed").alias("_all"))
    final = F.when(F.col("_all").isNull(), F.col("failing")).otherwise(~F.col("_all"))
    return verdicts.join(ran, list(by), "left").select(*by, "failing", final.alias("final_failing"))


def promotion_decision(scores: DataFrame, target: Sequence[str] | str, by: Sequence[str]) -> DataFrame:
    """scores(by, dimension, baseline, candidate): promoted if the target's mean lift is enough and no other dimension regresses too far."""
    means = scores.groupBy(*by, "dimension").agg(F.avg(F.col("candidate") - F.col("baseline")).alias("_lift"))
    is_target = F.col("dimension") == target
    out = means.groupBy(*by).agg(F.max(F.when(is_target, F.col("_lift"))).alias("_t"), F.count_if(~is_target & (F.col("_lift") < REGRESSION_MOST)).alias("regressions"))
    return out.select(*by, F.round("_t", 6).alias("target_lift"), "regressions", F.coalesce((F.col("_t") >= LIFT_LEAST) & (F.col("regressions") == 0), F.lit(False)).alias("promoted"))


FRONTIER_TILE = 4000


def pareto_frontier(df: DataFrame, key: str, best_high: Sequence[str], best_low: Sequence[str], tile: int = FRONTIER_TILE) -> DataFrame:
    """Rows that no other row is at least as good as in all and better in one; exact ties survive, and so do rows with a null metric.

    Partitions first drop what their own rows dominate. The survivors are dealt into tiles; a task holds two tiles and
    tells which of the first the second dominates, so neither a task's memory nor its work grows with the frontier.
    """
    cols = [*best_high, *best_low]
    rows = df.select(F.col(key).alias("k"), *[F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(cols)])
    flip = np.array([-1.0] * len(best_high) + [1.0] * len(best_low))

    def dominated(v: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Which rows of v (smaller is better) a row of ``by`` is at least as good as in all and better in one."""
        out = np.zeros(len(v), bool)
        for i in range(0, len(by), 64):
            w = by[i : i + 64, None, :]
            out |= ((w <= v[None]).all(2) & (w < v[None]).any(2)).any(0)
        return out

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            v = frame.iloc[:, 1:].to_numpy(float) * flip
            best = v[np.argsort(np.nan_to_num(v, nan=np.inf).sum(1), kind="stable")[:256]]  # rows likely to dominate many
            yield frame[~dominated(v, best)]

    metrics = [f"m{i}" for i in range(len(cols))]

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        first, second = part[part["side"] != 1], part[part["side"] != 0]
        return first.loc[dominated(first[metrics].to_numpy(float) * flip, second[metrics].to_numpy(float) * flip), ["n"]]

    own = rows.mapInPandas(partial, rows.schema).withColumn("n", F.xxhash64(*rows.columns))
    t = max(1, -(-own.count() // tile))
    placed = own.withColumn("h", F.pmod("n", F.lit(t))).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(t - 1))))
    pair = lambda a, b: (F.col(a) * t + F.col(b)).alias("task")
    left = placed.select(pair("h", "o"), F.when(F.col("h") == F.col("o"), 2).otherwise(0).alias("side"), "n", *metrics)
    right = placed.where("h <> o").select(pair("o", "h"), F.lit(1).alias("side"), "n", *metrics)
    lost = left.unionByName(right).groupBy("task").applyInPandas(meet, "n long").distinct()
    names = [F.col(f"m{i}").cast(dict(df.dtypes)[c]).alias(c) for i, c in enumerate(cols)]
    return own.join(lost, "n", "left_anti").select(F.col("k").alias(key), *names)


def ranked(df: DataFrame, metric: str, k: int, high: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col("total_docs") > 0).orderBy(F.desc(metric) if high else F.asc(metric), *tie).limit(k)


def holdout_split(df: DataFrame, key: str, salt: str, ratio: float) -> DataFrame:
    """Adds unit and side; a side that would be empty gets the row nearest the cut. Two extreme rows decide, not a sort."""
    rows = df.withColumn("unit", unit_interval(F.concat(F.lit(f"{salt}:"), F.col(key).cast("string"))))
    edges = rows.agg(F.min("unit").alias("_lo"), F.max("unit").alias("_hi"))
    rows = rows.crossJoin(F.broadcast(edges))  # one row
    held = F.when(F.col("_lo") >= ratio, F.col("unit") == F.col("_lo")).when(F.col("_hi") < ratio, F.col("unit") < F.col("_hi")).otherwise(F.col("unit") < ratio)
    return rows.select(*df.columns, F.when(held, "holdout").otherwise("proposal").alias("side"))


def priority_sample(df: DataFrame, key: str, limit: int, random_share: float, salt: str) -> DataFrame:
    """``limit`` rows: a random quota by salted hash, the rest by priority; the limit is the feature."""
    quota = int(round(limit * random_share))
    rows = df.withColumn("_u", unit_interval(F.concat(F.lit(f"{salt}:"), F.col(key).cast("string"))))
    lucky = rows.orderBy("_u", key).limit(quota)
    rest = rows.join(F.broadcast(lucky.select(key)), key, "left_anti").orderBy(F.desc("priority"), "_u", key).limit(limit - quota)  # at most ``limit`` keys
    return lucky.withColumn("reason", F.lit("random")).unionByName(rest.withColumn("reason", F.lit("priority"))).drop("_u")


def consensus(votes: DataFrame, least_runs: int) -> DataFrame:
    """votes(doc_id, decision, run_id): decisions in at least so many distinct runs."""
    out = votes.groupBy("doc_id", "decision").agg(F.countDistinct("run_id").alias("runs"))
    return out.where(F.col("runs") >= least_runs)


def gold_against_bad(results: DataFrame) -> DataFrame:
    """results(doc_id, format, role, passed): per format the share of documents whose gold passes and whose bad fails; a missing side is a failure."""
    sides = results.groupBy("format", "doc_id").agg(F.bool_and(F.when(F.col("role") == "gold", F.col("passed"))).alias("_g"), F.bool_or(F.when(F.col("role") == "bad", F.col("passed"))).alias("_b"))
    told = F.coalesce(F.col("_g") & ~F.col("_b"), F.lit(False))
    return sides.groupBy("format").agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg(told.cast("int")), 6).alias("discrimination"))


def diverse_examples(df: DataFrame, kind: str, signature: str, order: Sequence[Column], k: int) -> DataFrame:
    """k rows: the first of each kind, then the first of each new (kind, signature). Map tasks pass on one row a (kind, signature)."""
    first = lambda df, *by: df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")
    own = first(df, kind, signature)
    heads = first(own, kind).orderBy(*order).limit(k).withColumn("_late", F.lit(False))
    # of twice k rows at least k are no heads, unless heads alone are enough
    rest = own.orderBy(*order).limit(2 * k).withColumn("_late", F.lit(True))
    once = Window.partitionBy(kind, signature).orderBy("_late")
    rows = heads.unionByName(rest).withColumn("_r", F.row_number().over(once)).where("_r = 1")
    return rows.orderBy("_late", *order).limit(k).drop("_late", "_r")
