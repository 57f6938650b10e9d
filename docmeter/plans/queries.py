"""Registered queries: each operator over the driver's tables, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmeter.functions import color
from docmeter.operators import evaluation as ev
from docmeter.operators import checks, html, records, routing, structure, text
from docmeter.plans.derived import CALIBRATIONS, EXPERIMENTS, JOBS, NODES, calibrations, experiments, jobs, nodes, scores, table
from docmeter.streaming import events as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_DAY = "yyyy-MM-dd HH:mm:ss"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Record store


@query(f"with {JOBS} select status, kind, count(*) n from jobs group by status, kind")
def job_status_counts(spark, sf):
    return jobs(spark, sf).groupBy("status", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {JOBS} select id, status from jobs where status in ('queued', 'running')")
def jobs_by_status(spark, sf):
    return records.with_status(jobs(spark, sf), ["queued", "running"]).select("id", "status")


@query(f"with {JOBS} select id, strftime(created_at, '%Y-%m-%d %H:%M:%S') created from jobs where created_at < timestamp '1996-01-01 00:00:00'")
def jobs_older_than(spark, sf):
    return records.older_than(jobs(spark, sf), F.lit("1996-01-01 00:00:00").cast("timestamp")).select("id", F.date_format("created_at", _DAY).alias("created"))


@query(f"with {JOBS} select id, kind, status from jobs where id = 42")
def job_get(spark, sf):
    return jobs(spark, sf).where("id = 42").select("id", "kind", "status")


@query(f"with {JOBS} select id, status from jobs where not (created_at < timestamp '1997-12-01 00:00:00' and status in ('done', 'failed'))")
def retention_prune(spark, sf):
    return records.prune_expired(jobs(spark, sf), F.lit("1997-12-02 00:00:00").cast("timestamp"), 24).select("id", "status")


@query(f"with {JOBS} select case when status = 'running' then 'failed' else status end status, case when status = 'running' then 'interrupted' else stage end stage, case when status = 'running' then 'restarted' end error, count(*) n from jobs group by all")
def fail_running_jobs(spark, sf):
    return records.fail_running(jobs(spark, sf), "restarted").groupBy("status", "stage", "error").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {JOBS}, patch as (select id, case when id % 3 = 0 then 'urgent' end kind from jobs where id % 5 = 0) select j.id, coalesce(p.kind, j.kind) kind, case when p.id is not null then 'patched' else j.stage end stage from jobs j left join patch p using (id)")
def partial_update(spark, sf):
    base = jobs(spark, sf)
    patch = base.where("id % 5 = 0").select("id", F.when(F.col("id") % 3 == 0, "urgent").alias("kind"))
    return records.overlay(base, patch, ["id"], F.lit("patched"), "stage").select("id", "kind", "stage")


@query(f"with {JOBS} select id, case when id % 10 = 0 then 'replaced' else kind end kind from jobs")
def variant_upsert(spark, sf):
    base = jobs(spark, sf).select("id", "kind")
    return records.upsert(base, base.where("id % 10 = 0").withColumn("kind", F.lit("replaced")), ["id"])


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r from events) where r = 1")
def manifest_latest(spark, sf):
    return records.latest_by(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("""with latest as (select user_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r from events) where r = 1)
select c_custkey user_id from customer where c_custkey not in (select user_id from latest where event_type in ('purchase', 'signup') and value >= 10)""")
def manifest_resume_antijoin(spark, sf):
    latest = records.latest_by(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    files = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return records.remaining(files, latest, "user_id", F.col("event_type").isin("purchase", "signup") & (F.col("value") >= 10))


@query("select p_partkey, cast((row_number() over (order by p_retailprice, p_partkey) - 1) % 4 as int) shard from part")
def shard_assign(spark, sf):
    return records.strided_shard(table(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 4).select("p_partkey", "shard")


@query("select s_suppkey, s_acctbal, (select count(*) from supplier) total from supplier order by s_acctbal desc, s_suppkey limit 10 offset 20")
def review_queue_page(spark, sf):
    return records.page_of(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), [F.desc("s_acctbal"), F.asc("s_suppkey")], 20, 10)


@query("""with e as (select c_custkey k, count(*) n, min(c_nationkey) f from customer where c_custkey % 3 <> 0 group by 1),
f as (select o_custkey k, count(*) n, min(o_custkey % 25) f from orders group by 1)
select coalesce(e.k, f.k) k, coalesce(e.n, 0) n_expected, coalesce(f.n, 0) n_found,
case when f.n is null then 'missing' when e.n is null then 'stale' when f.n > 1 then 'duplicate' when e.f is distinct from f.f then 'drifted' else 'ok' end state from e full join f on e.k = f.k""")
def manifest_reconcile_full_outer(spark, sf):
    expected = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_nationkey").cast("long").alias("f"))
    found = table(spark, sf, "orders").select(F.col("o_custkey").cast("long").alias("k"), (F.col("o_custkey") % 25).cast("long").alias("f"))
    return records.reconcile(expected, found, "k", "f")


@query("""with q as (select user_id from events where event_type = 'signup' and event_id % 3 = 0),
n as (select user_id, event_id from (select *, row_number() over (partition by user_id order by event_id) r from events where event_type = 'error') where r = 1)
select user_id, event_id from n where user_id not in (select user_id from q)""")
def queue_dedupe_semijoin(spark, sf):
    e = table(spark, sf, "events")
    queue = e.where("event_type = 'signup'").select("user_id", F.when(F.col("event_id") % 3 == 0, "open").otherwise("completed").alias("status"))
    return records.enqueue_new(e.where("event_type = 'error'"), queue, "user_id", [F.asc("event_id")]).select("user_id", "event_id")


@query("""select event_type tool, user_id % 20 id, min(event_id) input_order from events group by 1, 2""")
def violation_dedupe(spark, sf):
    e = table(spark, sf, "events").select(
        F.lit(1).alias("doc_id"), F.col("event_type").alias("tool"), (F.col("user_id") % 20).alias("id"), F.lit("x").alias("selector"), F.lit("serious").alias("impact"),
        F.array().cast("array<string>").alias("html_snippets"), F.col("event_id").alias("input_order"),
    )
    return records.first_of_violations(e, {"critical": 0, "serious": 1}).select("tool", "id", "input_order")


@query("""with d as (select distinct l_suppkey k, l_linenumber p from lineitem where l_quantity > 40), g as (select k, p, p - row_number() over (partition by k order by p) i from d),
r as (select k, min(p) a, max(p) b from g group by k, i) select k, string_agg(case when a = b then cast(a as varchar) else concat(a, '-', b) end, ', ' order by a) pages from r group by k""")
def page_range_format(spark, sf):
    rows = table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("p"))
    return records.page_ranges(rows, "k", "p")


# Evaluation


@query(f"with {EXPERIMENTS} select harness_id, count(*) total_docs, sum(cast(passed as int)) passed_docs, round(avg(cast(passed as int)), 6) conformance_rate, sum(cast(violations_after > violations_before as int)) destructive_edits, round(coalesce(avg(case when elapsed_seconds > 0 then elapsed_seconds end), 0), 4) avg_seconds from experiments group by 1")
def variant_metrics(spark, sf):
    return ev.variant_metrics(experiments(spark, sf))


@query(f"with {EXPERIMENTS} select document_format, round(avg(cast(passed as int)), 6) success_rate, count(*) total from experiments group by 1")
def success_rate(spark, sf):
    return ev.success_rate(experiments(spark, sf), ["document_format"])


@query(f"""with {EXPERIMENTS}, s as (select dimension, round(avg(score), 6) mean_score, count(*) a from scores group by 1), b as (select dimension, round(avg(cast(ok as int)), 6) pass_rate, count(*) b from behaviours group by 1)
select coalesce(s.dimension, b.dimension) dimension, mean_score, pass_rate, greatest(coalesce(a, 0), coalesce(b, 0)) n from s full join b on s.dimension = b.dimension""")
def dimension_metrics(spark, sf):
    return ev.dimension_metrics(experiments(spark, sf))


@query(f"with {EXPERIMENTS} select document_type, count(*) failures, count(error) errors, count(distinct document_id) documents from experiments where not passed group by 1")
def failure_doc_types(spark, sf):
    return experiments(spark, sf).where("not passed").groupBy("document_type").agg(F.count(F.lit(1)).alias("failures"), F.count("error").alias("errors"), F.countDistinct("document_id").alias("documents"))


@query(f"""with {EXPERIMENTS} select document_format, document_type, dimension, round(avg(score), 6) mean_score, count(*) n, cast(grouping(document_format) * 2 + grouping(document_type) as int) grain
from scores group by cube (document_format, document_type), dimension having avg(score) < 0.8 and (grouping(document_type) = 1 or trim(document_type) <> '')""")
def weak_dimensions_grouping_sets(spark, sf):
    return ev.weak_dimensions(scores(spark, sf))


@query("select o_orderpriority provider, count(*) calls, sum(o_custkey) tokens_in, sum(o_orderkey) tokens_out from orders group by rollup (o_orderpriority)")
def token_usage_rollup(spark, sf):
    calls = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("provider"), F.col("o_custkey").alias("tokens_in"), F.col("o_orderkey").alias("tokens_out"))
    return ev.usage_rollup(calls)


@query("""with d as (select case when p_brand = 'Brand#1' then '(unknown)' else p_brand end root, case when p_size % 6 = 5 then 'unclassified' else concat('L', p_size % 6) end level from part)
select coalesce(root, '*') root, coalesce(level, '*') level, count(*) documents from d group by cube (root, level)""")
def level_burndown(spark, sf):
    p = table(spark, sf, "part")
    d = p.select(F.when(F.col("p_brand") == "Brand#1", " ").otherwise(F.col("p_brand")).alias("root"), F.when(F.col("p_size") % 6 == 5, None).otherwise(F.concat(F.lit("L"), (F.col("p_size") % 6).cast("string"))).alias("level"))
    return ev.level_burndown(d)


@query(f"with {EXPERIMENTS} select harness_id, round(avg(cast(passed as int)), 6) conformance_rate from experiments group by 1 order by 2 desc, 1 limit 5")
def rank_variants_topk(spark, sf):
    return ev.ranked(ev.variant_metrics(experiments(spark, sf)), "conformance_rate", 5, tie=["harness_id"]).select("harness_id", "conformance_rate")


@query("""with v as (select p_brand k, round(avg(p_retailprice), 4) a, count(*) b, min(p_size) c from part group by 1)
select k, a, b, c from v x where not exists (select 1 from v y where y.a >= x.a and y.b <= x.b and y.c <= x.c and (y.a > x.a or y.b < x.b or y.c < x.c))""")
def pareto_frontier(spark, sf):
    v = table(spark, sf, "part").groupBy(F.col("p_brand").alias("k")).agg(F.round(F.avg("p_retailprice"), 4).alias("a"), F.count(F.lit(1)).alias("b"), F.min("p_size").alias("c"))
    return ev.pareto_frontier(v, "k", ["a"], ["b", "c"])


_HEURISTIC = "case when length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) * 20 > length(coalesce(text, '')) then 0 else 1 end"


@query(f"""with p as (select d.source, l.quality a, {_HEURISTIC} b from documents d join labels l using (doc_id)), c as (select source, a, b, count(*) c from p group by all),
t as (select source, sum(c) n, sum(case when a = b then c else 0 end) same from c group by 1), x as (select source, a v, sum(c) p from c group by 1, 2), y as (select source, b v, sum(c) p from c group by 1, 2),
e as (select source, sum(x.p * y.p) ab from x join y using (source, v) group by 1), k as (select source, n, same / n po, coalesce(ab, 0) / (n * n) pe from t left join e using (source))
select source, round(case when pe = 1 then case when po = 1 then 1.0 else 0.0 end else (po - pe) / (1 - pe) end, 6) kappa, cast(n as bigint) n from k""")
def cohens_kappa(spark, sf):
    t = F.coalesce("text", F.lit(""))
    marks = F.length(F.regexp_replace(t, "[^#*$%&|<>]", ""))
    d = table(spark, sf, "documents").select("doc_id", "source", F.when(marks * 20 > F.length(t), 0).otherwise(1).alias("guess"))
    return ev.cohens_kappa(d.join(table(spark, sf, "labels"), "doc_id"), ["source"], "quality", "guess")


@query(f"""with {CALIBRATIONS}, r as (select *, row_number() over (partition by judge, slice order by measured_at desc, calibration_id desc) r from calibrations)
select judge, slice, round(sum(kappa * sample_size) / sum(sample_size), 6) weighted_kappa, cast(sum(sample_size) as bigint) sample_size, count(*) measurements from r where r <= 5 group by 1, 2
having sum(sample_size) >= 60 and sum(kappa * sample_size) / sum(sample_size) < 0.6""")
def rolling_drift(spark, sf):
    return ev.drift_alerts(calibrations(spark, sf), ["judge", "slice"], 5, 60)


@query(f"""with {CALIBRATIONS}, r as (select *, try_cast(measured_at as timestamp) m_at, row_number() over (partition by judge, slice order by (try_cast(measured_at as timestamp) is null) desc, try_cast(measured_at as timestamp) desc, measured_at desc, calibration_id desc) r from calibrations),
q as (select distinct event_type judge, s.slice from events, (select unnest(range(45)) slice) s)
select q.judge, q.slice, kappa, case when r.judge is null then 'missing' when m_at is null then 'malformed' when m_at < timestamp '2024-01-10 00:00:00' - interval 2 day then 'stale' when kappa >= 0.6 then 'ok' else 'below' end status
from q left join (select * from r where r = 1) r on q.judge = r.judge and q.slice = r.slice""")
def latest_calibration_status(spark, sf):
    judges = table(spark, sf, "events").select(F.col("event_type").alias("judge")).distinct()
    required = judges.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(44).cast("long"))))
    return ev.calibration_status(required, calibrations(spark, sf), ["judge", "slice"], F.lit("2024-01-10 00:00:00").cast("timestamp"), 2)


@query(f"with {EXPERIMENTS} select document_id, dimension, round(avg(score), 6) score, round(coalesce(var_pop(score), 0), 6) variance, count(*) judges, avg(score) < 0.8 failing from scores group by 1, 2")
def judge_ensemble(spark, sf):
    return ev.judge_ensemble(scores(spark, sf), ["document_id", "dimension"])


@query(f"""with {EXPERIMENTS}, v as (select document_id, round(avg(score), 6) < 0.8 failing from scores group by 1), t as (select document_id, bool_and(passed) a from experiments where line <= 2 group by 1)
select v.document_id, failing, case when a is null then failing else not a end final_failing from v left join t using (document_id)""")
def behaviour_precedence(spark, sf):
    verdicts = scores(spark, sf).groupBy("document_id").agg((F.round(F.avg("score"), 6) < 0.8).alias("failing"))
    tests = experiments(spark, sf).select("document_id", "passed", (F.col("line") <= 2).alias("applicable"))
    return ev.behaviour_overrides(verdicts, tests, ["document_id"])


@query(f"""with {EXPERIMENTS}, m as (select harness_id, dimension, avg(score - 0.75) lift from scores group by 1, 2)
select harness_id, round(max(case when dimension = 'headings' then lift end), 6) target_lift, sum(cast(dimension <> 'headings' and lift < -0.02 as int)) regressions,
coalesce(max(case when dimension = 'headings' then lift end) >= 0.05 and sum(cast(dimension <> 'headings' and lift < -0.02 as int)) = 0, false) promoted from m group by 1""")
def promotion_decision(spark, sf):
    s = scores(spark, sf).select("harness_id", "dimension", F.lit(0.75).alias("baseline"), F.col("score").alias("candidate"))
    return ev.promotion_decision(s, "headings", ["harness_id"])


_UNIT = "cast(cast(concat('0x', substr(sha256({x}), 1, 16)) as ubigint) as double) / 18446744073709551615.0"


@query(f"select doc_id, case when {_UNIT.format(x="concat('split:', doc_id)")} < 0.2 then 'holdout' else 'proposal' end side from documents")
def holdout_split(spark, sf):
    return ev.holdout_split(table(spark, sf, "documents").select("doc_id"), "doc_id", "split", 0.2)


@query(f"""with d as (select doc_id, n_chars priority, {_UNIT.format(x="concat('s:', doc_id)")} u from documents), lucky as (select * from d order by u, doc_id limit 5),
rest as (select * from d where doc_id not in (select doc_id from lucky) order by priority desc, u, doc_id limit 15)
select doc_id, priority, 'random' reason from lucky union all select doc_id, priority, 'priority' from rest""")
def priority_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("priority"))
    return ev.priority_sample(d, "doc_id", 20, 0.25, "s")


@query("select user_id doc_id, event_type decision, count(distinct event_id % 6) runs from events group by 1, 2 having count(distinct event_id % 6) >= 5")
def consensus_vote(spark, sf):
    votes = table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("decision"), (F.col("event_id") % 6).alias("run_id"))
    return ev.consensus(votes, 5)


@query(f"""with {EXPERIMENTS}, s as (select document_format format, document_id doc_id, bool_and(passed) filter (where line % 2 = 1) g, bool_or(passed) filter (where line % 2 = 0) b from experiments group by 1, 2)
select format, count(*) documents, round(avg(cast(coalesce(g and not b, false) as int)), 6) discrimination from s group by 1""")
def gold_vs_bad(spark, sf):
    r = experiments(spark, sf).select(F.col("document_format").alias("format"), F.col("document_id").alias("doc_id"), F.when(F.col("line") % 2 == 1, "gold").otherwise("bad").alias("role"), "passed")
    return ev.gold_against_bad(r)


@query(f"with {EXPERIMENTS} select harness_id, document_id, least(min(alt_text), min(headings), min(links)) weakest from experiments where passed and (alt_text < 0.8 or headings < 0.8 or links < 0.8) group by 1, 2")
def complete_but_weak(spark, sf):
    e = experiments(spark, sf).where(F.col("passed") & F.exists(F.map_values("quality_dimensions"), lambda x: x < 0.8))
    return e.groupBy("harness_id", "document_id").agg(F.min(F.array_min(F.map_values("quality_dimensions"))).alias("weakest"))


# Text


@query(r"""with l as (select doc_id, trim(regexp_replace(x, '\s+', ' ', 'g')) line from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) x from documents)), c as (select doc_id, line, count(*) k from l where line <> '' group by 1, 2),
r as (select doc_id, sum(length(line) * k) total, coalesce(sum(case when length(line) >= 20 and line not like '[Form:%' then (k - 1) * length(line) end), 0) red from c group by 1)
select d.doc_id, cast(coalesce(total, 0) as bigint) total_chars, cast(coalesce(red, 0) as bigint) redundant_chars, case when coalesce(total, 0) > 0 then round(red / total, 6) else 0 end ratio from (select doc_id from documents) d left join r using (doc_id)""")
def duplicate_content_ratio(spark, sf):
    return text.duplicate_content_ratio(table(spark, sf, "documents"))


@query(r"""with l as (select doc_id, n, trim(regexp_replace(x, '\s+', ' ', 'g')) line from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) n from documents)),
k as (select doc_id, n, line, lag(line) over (partition by doc_id order by n) b from l where line <> '')
select doc_id, line, count(*) times from k where (b is null or b <> line) and length(line) >= 20 and line not like '[Form:%' group by 1, 2 having count(*) >= 3""")
def repeated_lines(spark, sf):
    return text.repeated_lines(table(spark, sf, "documents"))


@query(r"""with s as (select doc_id, list_distinct(list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: lower(trim(regexp_replace(x, '^[•\-*]\s*', '')))), lambda x: x <> '' and x <> '•')) a from documents)
select x.doc_id, round(case when len(x.a) = 0 or len(y.a) = 0 then 0 else len(list_intersect(x.a, y.a)) / len(list_distinct(list_concat(x.a, y.a))) end, 6) similarity from s x join s y on y.doc_id = x.doc_id + 1""")
def sentence_jaccard(spark, sf):
    s = table(spark, sf, "documents").select("doc_id", text.sentence_set(F.col("text")).alias("a"))
    nxt = s.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b"))
    return s.join(nxt, "doc_id").select("doc_id", F.round(text.jaccard(F.col("a"), F.col("b")), 6).alias("similarity"))


@query(r"""with b as (select item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) a from benchmark), d as (select doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) t from documents)
select doc_id, item_id, round(len(list_intersect(a, t)) / len(a), 6) overlap from d, b where len(a) > 0 and len(list_intersect(a, t)) >= 0.8 * len(a)""")
def token_containment(spark, sf):
    return text.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query(r"""with w as (select turn % 2 t, conv_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) word from conversations), b as (select conv_id, word, count(*) n from w where t = 0 group by 1, 2), a as (select conv_id, word, count(*) n from w where t = 1 group by 1, 2),
l as (select conv_id, sum(greatest(0, b.n - coalesce(a.n, 0))) lost, sum(b.n) total from b left join a using (conv_id, word) group by 1)
select c.conv_id, cast(coalesce(lost, 0) as bigint) lost_words, round(1 - coalesce(lost, 0) / greatest(coalesce(total, 0), 1), 6) fidelity from (select distinct conv_id from conversations where turn % 2 = 0) c left join l using (conv_id)""")
def word_fidelity(spark, sf):
    c = table(spark, sf, "conversations")
    return text.word_fidelity(c.where("turn % 2 = 0"), c.where("turn % 2 = 1"), "conv_id")


@query()
def text_trust(spark, sf):
    return text.trust_columns(table(spark, sf, "documents"), "doc_id", "text")


@query(f"""with {NODES}, t as (select doc_id, 1 + doc_id % 3 pages, coalesce(text, '') x from documents), n as (select doc_id, count(*) nodes, count(distinct seq) tagged, count(*) filter (where tag = 'Figure') figures, count(*) filter (where tag = 'Figure' and length(coalesce(alt_text, '')) > 10) described from nodes group by 1),
f as (select event_id % 1500 doc_id, sum(case when event_id % 3 = 0 then case when user_id % 2 = 0 then 5.0 else 2.0 end else 0.0 end) h, sum(case when event_id % 3 = 1 and user_id % 2 = 0 then 5.0 else 0.0 end) b from events where user_id % 3 = 0 group by 1),
p as (select t.doc_id, case when length(x) = 0 then 30.0 else (length(x) - len(list_filter(regexp_extract_all(x, '[\\p{{C}}\\p{{Z}}]'), lambda c: c not in (' ', chr(10), chr(9), chr(13))))) / length(x) * 30.0 end tx,
 least(1.0, coalesce(tagged, 0) / pages) * least(1.0, coalesce(nodes, 0) / pages / 3.0) * 25.0 tg, case when coalesce(figures, 0) = 0 then 20.0 else described / figures * 20.0 end al, greatest(0.0, 15.0 - coalesce(h, 0.0)) he, greatest(0.0, 10.0 - coalesce(b, 0.0)) tb
 from t left join n using (doc_id) left join f using (doc_id))
select doc_id, round(tx, 1) as text, round(tg, 1) tags, round(al, 1) alternatives, round(he, 1)::double headings, round(tb, 1)::double tables, round(least(100.0, tx + tg + al + he + tb), 1) score from p""")
def readability_score(spark, sf):
    texts = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 3 + 1).alias("pages"), "text")
    e, u = F.col("event_id"), F.col("user_id")
    rule = F.when(e % 3 == 0, "sr-heading-skip").when(e % 3 == 1, "sr-table-no-headers").otherwise("other")
    findings = table(spark, sf, "events").where("user_id % 3 = 0").select((e % 1500).alias("doc_id"), rule.alias("rule_id"), F.when(u % 2 == 0, "ERROR").otherwise("warning").alias("severity"))
    return text.reader_readability(texts, nodes(spark, sf).withColumn("page", F.col("seq")), findings)


@query("select conv_id, turn, sum(cast(role = 'user' as int)) over (partition by conv_id order by turn rows unbounded preceding) section_id from conversations")
def section_running_id(spark, sf):
    return structure.sections(table(spark, sf, "conversations"), "conv_id", "turn", F.col("role") == "user").select("conv_id", "turn", "section_id")


@query(r"""with s as (select p_partkey, lower(p_name) t from part) select p_partkey, trim(regexp_replace(t, '[^a-z0-9]+', '-', 'g'), '-') slug from s""")
def slugs(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query("""with v as (select l_orderkey doc_id, sum(cast(l_linenumber % 3 = 0 as int)) tables, sum(cast(l_linenumber % 3 = 1 as int)) structure, sum(cast(l_quantity > 45 as int)) ordering, sum(cast(l_discount > 0.08 as int)) figures, count(*) total, count(distinct l_returnflag) kinds, max(cast(l_quantity as int)) pages from lineitem group by 1)
select doc_id, case when total = 0 then 'simple' when tables / total > 0.5 then 'table_heavy' when structure / total > 0.5 then 'untagged_content' when ordering / total > 0.3 then 'reading_order' when figures / total > 0.3 then 'figure_alt' when pages > 10 or total > 20 then 'complex' when kinds >= 3 then 'mixed_structure' else 'simple' end document_type from v""")
def doc_type_classify(spark, sf):
    v = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        F.count_if(F.col("l_linenumber") % 3 == 0).alias("tables"), F.count_if(F.col("l_linenumber") % 3 == 1).alias("structure"), F.count_if(F.col("l_quantity") > 45).alias("ordering"),
        F.count_if(F.col("l_discount") > 0.08).alias("figures"), F.count(F.lit(1)).alias("total"), F.countDistinct("l_returnflag").alias("kinds"), F.max(F.col("l_quantity").cast("int")).alias("pages"),
    )
    return text.page_similarity_class(v).select("doc_id", "document_type")


# Pages


@query(r"""select page_id, not starts_with(ltrim(lower(html)), '<!doctype') missing_doctype, regexp_matches(lower(html), '<html[\s>]') and not regexp_matches(lower(html), '<html[^>]*\slang\s*=\s*["'']?[a-z]') missing_lang,
not regexp_matches(lower(html), '<title[^>]*>[^<]*[^<\s]') missing_title, not regexp_matches(lower(html), '<meta[^>]*name\s*=\s*["'']?viewport') missing_viewport, not regexp_matches(lower(html), '<main[\s>]|role\s*=\s*["'']main') missing_main,
not regexp_matches(lower(html), '<nav[\s>]') missing_nav, not regexp_matches(lower(html), 'href\s*=\s*["'']#main|class\s*=\s*["''][^"'']*skip') missing_skip_link,
len(list_filter(regexp_extract_all(lower(html), '<img[^>]*>'), lambda x: not regexp_matches(x, '\salt\s*='))) images_without_alt from pages""")
def html_landmarks(spark, sf):
    return html.landmark_findings(table(spark, sf, "pages"))


@query(r"""select page_id, len(regexp_extract_all(lower(html), '<a[\s/>]')) links, len(regexp_extract_all(lower(html), '<li[\s/>]')) items, len(regexp_extract_all(lower(html), '<p[\s/>]')) paragraphs, len(regexp_extract_all(lower(html), '<h[1-6][\s/>]')) headings from pages""")
def html_link_counts(spark, sf):
    return html.link_counts(table(spark, sf, "pages"))


@query(r"""with h as (select page_id, generate_subscripts(t, 1) - 1 seq, cast(unnest(t) as int) level from (select page_id, regexp_extract_all(lower(html), '<h([1-6])[\s>]', 1) t from pages)),
p as (select *, lag(level) over (partition by page_id order by seq) previous from h) select page_id, seq, level, case when previous is null and level <> 1 then 'first_not_1' else 'skip' end finding from p where level > previous + 1 or (previous is null and level <> 1)""")
def html_heading_skips(spark, sf):
    return structure.heading_skips(html.heading_levels(table(spark, sf, "pages")), "page_id", "seq", "level", "warn").select("page_id", "seq", "level", "finding")


@query()
def link_text_findings(spark, sf):
    found = html.links(table(spark, sf, "pages"))
    return found.select("page_id", "link_index", "text", text.descriptive_link(F.col("text"), F.col("target")).alias("descriptive"))


@query()
def html_elements(spark, sf):
    return html.elements(table(spark, sf, "pages")).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest"))


@query()
def html_fixes_needed(spark, sf):
    return html.fixes_needed(table(spark, sf, "pages"))


@query("""with c as (select p_partkey k, (p_partkey * 7) % 256 r, (p_partkey * 13) % 256 g, (p_partkey * 29) % 256 b from part), l as (select k, 0.2126 * case when r / 255.0 <= 0.04045 then r / 255.0 / 12.92 else pow((r / 255.0 + 0.055) / 1.055, 2.4) end
+ 0.7152 * case when g / 255.0 <= 0.04045 then g / 255.0 / 12.92 else pow((g / 255.0 + 0.055) / 1.055, 2.4) end + 0.0722 * case when b / 255.0 <= 0.04045 then b / 255.0 / 12.92 else pow((b / 255.0 + 0.055) / 1.055, 2.4) end y from c)
select k, round(1.05 / (y + 0.05), 4) on_white, 1.05 / (y + 0.05) >= 4.5 passes from l""")
def contrast_ratio(spark, sf):
    k = F.col("p_partkey")
    y = color.luminance((k * 7 % 256).cast("double"), (k * 13 % 256).cast("double"), (k * 29 % 256).cast("double"))
    ratio = color.contrast(y, F.lit(1.0))
    return table(spark, sf, "part").select(k.alias("k"), F.round(ratio, 4).alias("on_white"), (ratio >= 4.5).alias("passes"))


# Structure: lines of an order as an ordered tree


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), (F.col("l_quantity") % 4).cast("int").alias("depth"), (F.col("l_partkey") % 30).alias("page"))


@query("""with n as (select distinct l_orderkey doc_id, l_linenumber seq, cast(l_quantity % 4 as int) depth from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_quantity, l_partkey) = 1)
select doc_id, seq, (select max(m.seq) from n m where m.doc_id = n.doc_id and m.seq < n.seq and m.depth < n.depth) parent_seq from n""")
def tree_parents(spark, sf):
    n = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), "l_quantity", "l_partkey")
    n = records.latest_by(n, ["doc_id", "seq"], [F.asc("l_quantity"), F.asc("l_partkey")]).select("doc_id", "seq", (F.col("l_quantity") % 4).cast("int").alias("depth"))
    return structure.tree_parents(n).select("doc_id", "seq", "parent_seq")


@query("""with e as (select user_id doc_id, event_id seq, event_id % 30 page from events), p as (select *, lag(page) over (partition by doc_id order by seq) b from e) select doc_id, min(seq) seq from p where page < b group by 1""")
def page_backtracking(spark, sf):
    return structure.backtracking(table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), (F.col("event_id") % 30).alias("page")))


@query("""with l as (select user_id doc_id, event_id seq, 8 + event_id % 7 + case when event_id % 3 = 0 then 6 else 0 end size from events), s as (select doc_id, size, count(*) n from l group by 1, 2),
b as (select doc_id, size body from s qualify row_number() over (partition by doc_id order by n desc, size) = 1), h as (select l.doc_id, seq, l.size, dense_rank() over (partition by l.doc_id order by l.size desc) level from l join b using (doc_id) where l.size >= body * 1.15)
select doc_id, seq, level from h where level <= 6""")
def heading_tiers(spark, sf):
    e = F.col("event_id")
    lines = table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), e.alias("seq"), (8 + e % 7 + F.when(e % 3 == 0, 6).otherwise(0)).alias("size"), F.lit("a title").alias("text"))
    return structure.heading_tiers(lines).select("doc_id", "seq", "level")


@query()
def reading_order(spark, sf):
    p = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.col("l_linenumber").cast("int").alias("idx"), (F.col("l_suppkey") % 2 * 300.0).alias("left"),
        (700 - F.col("l_linenumber") * 60.0).alias("bottom"), (F.col("l_suppkey") % 2 * 300.0 + 250).alias("right"), (740 - F.col("l_linenumber") * 60.0).alias("top"),
    )
    return structure.reading_order(p).select("doc_id", "page", "idx", "place")


@query("""select s_suppkey, case when not (s_suppkey % 11 <> 0) or not (s_suppkey % 7 <> 0) then 'L0' when not (s_suppkey % 5 <> 0) then 'L1' when not (s_suppkey % 3 <> 0) then 'L2' when not (s_suppkey % 2 <> 0) then 'L3' else 'L4' end "level" from supplier""")
def level_classify(spark, sf):
    k = F.col("s_suppkey")
    facts = table(spark, sf, "supplier").select(
        k, (k % 11 != 0).alias("openable"), (k % 7 != 0).alias("has_text"), (k % 5 != 0).alias("has_tags"), (k % 3 != 0).alias("verapdf_passed"), F.lit(True).alias("has_lang"),
        F.lit(True).alias("display_title"), F.lit(True).alias("has_uaid"), (k % 2 != 0).alias("conformant"), F.lit(True).alias("quality_passed"),
    )
    return structure.level_of(facts).select("s_suppkey", "level")


# Event time (batch runs of the streaming functions)


@query("select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M:%S') window_start, event_type, count(*) events, round(sum(value), 4) total from events group by 1, 2")
def events_tumbling(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return st.tumbling(e, "1 hour").withColumn("window_start", F.date_format("window_start", _DAY))


@query("""select strftime(w, '%Y-%m-%d %H:%M:%S') window_start, count(*) events from (select time_bucket(interval 30 minute, ts) - to_minutes(30 * k) w from events, (select unnest(range(4)) k)) group by 1""")
def events_sliding(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return st.sliding(e, "2 hours", "30 minutes").withColumn("window_start", F.date_format("window_start", _DAY))


@query("""with g as (select user_id, ts, case when ts < lag(ts) over (partition by user_id order by ts) + interval 1 hour then 0 else 1 end n from events), s as (select user_id, ts, sum(n) over (partition by user_id order by ts rows unbounded preceding) k from g)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') session_start, strftime(max(ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S') session_end, count(*) events from s group by user_id, k""")
def events_session(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return st.sessions(e, "1 hour").withColumns({c: F.date_format(c, _DAY) for c in ("session_start", "session_end")})


@query("select user_id, event_type, count(*) n, round(sum(value), 4) total, count(distinct json_extract(props, '$.k')) keys from events group by 1, 2")
def events_json_props(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.countDistinct("k").alias("keys"))


# Relational breadth


@query("""select n_name, o_orderpriority, count(*) n, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2""")
def join_star(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    li = li.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return li.groupBy("n_name", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("select c_custkey, count(o_orderkey) orders, (exists (select 1 from orders x where x.o_custkey = c_custkey and o_orderstatus = 'P')) has_open from customer left join orders on o_custkey = c_custkey group by 1")
def join_left_semi(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("o_orderstatus") == "P").alias("p"))
    return table(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("p", F.lit(False)).alias("has_open"))


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def join_anti(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("select o_custkey, o_orderkey, rank() over w r, round(avg(o_totalprice) over (w rows between 2 preceding and current row), 4) moving from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)")
def window_frames(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.rank().over(w).alias("r"), F.round(F.avg("o_totalprice").over(w.rowsBetween(-2, 0)), 4).alias("moving"))


@query("(select l_suppkey k from lineitem where l_returnflag = 'R' intersect select l_suppkey from lineitem where l_quantity > 49) except select s_suppkey from supplier where s_acctbal < 0")
def set_operations(spark, sf):
    li = table(spark, sf, "lineitem")
    both = li.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("k")).intersect(li.where("l_quantity > 49").select("l_suppkey"))
    return both.subtract(table(spark, sf, "supplier").where("s_acctbal < 0").select("s_suppkey"))


@query("select p_type, count(*) filter (where p_size < 10) small, count(*) filter (where p_size between 10 and 29) medium, count(*) filter (where p_size >= 30) large from part group by 1")
def pivot_sizes(spark, sf):
    size = F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large")
    return table(spark, sf, "part").withColumn("s", size).groupBy("p_type").pivot("s", ["small", "medium", "large"]).count().na.fill(0)


# Routing


@query("""select p_partkey, case when c = '7.1-1' or starts_with(c, '7.1-1.') or c = '7.2-3' or starts_with(c, '7.2-3.') then 'deterministic' else 'judgement' end route from
(select p_partkey, concat('7.', p_partkey % 3, '-', p_size % 12, case when p_partkey % 5 = 0 then '.2' else '' end) c from part)""")
def violation_routing(spark, sf):
    k = F.col("p_partkey")
    clause = F.concat(F.lit("7."), (k % 3).cast("string"), F.lit("-"), (F.col("p_size") % 12).cast("string"), F.when(k % 5 == 0, ".2").otherwise(""))
    raw = F.when(k % 2 == 0, F.concat(F.lit("ISO 14289-1:2014-"), clause)).otherwise(F.concat(F.lit("clause/"), clause))
    return routing.routed(table(spark, sf, "part").select(k, raw.alias("rule_id")), ["7.1-1", "7.2-3"]).select("p_partkey", "route")


@query("select p_partkey, case when p_size > 45 then 'pages' when p_retailprice > 1400 then 'size' end reason from part")
def oversize_routing(spark, sf):
    reason = routing.oversize(F.col("p_size"), F.col("p_retailprice") * 1024 * 1024, 45, 1400)
    return table(spark, sf, "part").select("p_partkey", reason.alias("reason"))


@query(f"""with {EXPERIMENTS}, v as (select harness_id h, avg(cast(passed as int)) c, sum(cast(violations_after > violations_before as int)) e, avg(elapsed_seconds) s from experiments group by 1)
select a.h a, b.h b, case when round(a.c, 6) - round(b.c, 6) > 0.01 then 'a:conformance' when round(a.c, 6) - round(b.c, 6) < -0.01 then 'b:conformance' when a.e < b.e then 'a:edits' when a.e > b.e then 'b:edits' when a.s - b.s < -5 then 'a:seconds' when a.s - b.s > 5 then 'b:seconds' else 'none' end better from v a join v b on b.h = a.h + 1""")
def variant_head_to_head(spark, sf):
    v = experiments(spark, sf).groupBy("harness_id").agg(F.round(F.avg(F.col("passed").cast("int")), 6).alias("c"), F.count_if(F.col("violations_after") > F.col("violations_before")).alias("e"), F.avg("elapsed_seconds").alias("s"))
    a = v.select(F.col("harness_id").alias("a"), F.col("c").alias("a_conformance"), F.col("e").alias("a_edits"), F.col("s").alias("a_seconds"))
    b = v.select((F.col("harness_id") - 1).alias("a"), F.col("harness_id").alias("b"), F.col("c").alias("b_conformance"), F.col("e").alias("b_edits"), F.col("s").alias("b_seconds"))
    return routing.head_to_head(a.join(b, "a")).select("a", "b", "better")


@query("""with c as (select l_orderkey doc_id, sum(cast(l_returnflag = 'R' as int)) failed, sum(cast(l_returnflag = 'R' and l_linenumber not in (1, 2) as int)) blocking from lineitem group by 1),
f as (select o_orderkey doc_id, o_orderkey % 17 <> 0 openable, o_orderstatus = 'F' passed, o_custkey % 4 reader, o_orderkey % 3 <> 0 fonts, o_orderkey % 11 = 0 tools, o_orderkey % 5 % 2 warnings from orders)
select doc_id, coalesce(failed, 0) failed, coalesce(blocking, 0) blocking, case when not openable then 'not' when passed and warnings = 0 then 'conformant' when coalesce(blocking, 0) = 0 and reader = 0 and fonts and not tools then 'conformant'
when warnings > 0 then 'partially' when fonts and coalesce(failed, 0) <= 3 and reader <= 2 then 'partially' else 'not' end conformance from f left join c using (doc_id)""")
def conformance_verdict(spark, sf):
    rule = F.when(F.col("l_linenumber") == 1, "doc-bookmarks").when(F.col("l_linenumber") == 2, "page-tab-order").otherwise("alt-figures")
    checks = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), rule.alias("rule_id"), F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Passed").alias("status"))
    k = F.col("o_orderkey")
    facts = table(spark, sf, "orders").select(
        k.alias("doc_id"), (k % 17 != 0).alias("openable"), (F.col("o_orderstatus") == "F").alias("passed"), (F.col("o_custkey") % 4).alias("reader_errors"),
        (k % 3 != 0).alias("fonts_only"), (k % 11 == 0).alias("tools_failed"), (k % 5 % 2).alias("warnings"),
    )
    return routing.conformance(checks, facts)


@query("""with s as (select conv_id, turn, lower(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) t, role <> 'system' p from conversations), o as (select *, case when not p then 'missing_placeholder' when t = '' then 'empty_title' end own from s),
c as (select *, count(case when own is null then 1 end) over (partition by conv_id, t) n from o) select conv_id doc_id, turn slide, coalesce(own, case when n > 1 then 'repeated_title' end) issue from c""")
def slide_titles(spark, sf):
    s = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("slide"), F.col("text").alias("title"), (F.col("role") != "system").alias("has_placeholder"))
    return routing.slide_titles(s).select("doc_id", "slide", "issue")


# Document checks


@query("""with f as (select o_orderkey k from orders), r as (select k, 'doc-accessibility-permission' rule_id, k % 13 <> 0 ok from f union all select k, 'doc-not-image-only', k % 7 > 0 from f union all select k, 'doc-tagged', k % 5 <> 0 from f
union all select k, 'doc-language', k % 4 <> 0 from f union all select k, 'doc-display-title', k % 3 <> 0 from f union all select k, 'doc-bookmarks', k % 40 <= 20 or k % 2 = 0 from f union all select k, 'page-tab-order', k % 40 = k % 35 from f
union all select k, 'page-no-flicker', true from f union all select k, 'page-no-scripts', k % 6 = 0 from f union all select k, 'page-no-timed-responses', k % 9 = 0 from f)
select k doc_id, rule_id, case when ok then 'Passed' else 'Failed' end status from r""")
def document_checks(spark, sf):
    k = F.col("o_orderkey")
    facts = table(spark, sf, "orders").select(
        k.alias("doc_id"), (k % 13 != 0).alias("assistive_access"), (k % 7).alias("text_pages"), (k % 5 != 0).alias("has_tags"), F.when(k % 4 != 0, "en").alias("lang"),
        (k % 3 != 0).alias("display_title"), F.lit("t").alias("title"), (k % 40).alias("pages"), (k % 2 == 0).alias("has_outline"), (k % 35).alias("pages_in_tab_order"),
        F.lit(0).alias("flicker_objects"), (k % 6).alias("scripts"), (k % 9).alias("timed_actions"),
    )
    return checks.document_checks(facts)


@query("""select l_suppkey doc_id, l_linenumber page, lower(l_returnflag) "text", count(distinct l_partkey) targets from lineitem group by 1, 2, 3 having count(distinct l_partkey) > 1""")
def repeated_link_texts(spark, sf):
    links = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_returnflag").alias("text"), F.col("l_partkey").alias("target"))
    return checks.repeated_links(links)


@query("""with s as (select l_orderkey doc_id, l_linenumber as row_no, case when l_quantity % 4 = 0 then 2 else 1 end w, case when l_suppkey % 5 = 0 then 2 else 1 end h from lineitem), m as (select doc_id, max(row_no) last from s group by 1),
c as (select doc_id, unnest(range(row_no, least(row_no + h - 1, last) + 1)) row_no, w from s join m using (doc_id)), w as (select doc_id, row_no, sum(w) width from c group by 1, 2)
select doc_id, 1 "table", cast(min(width) as bigint) narrowest, cast(max(width) as bigint) widest from w group by 1 having min(width) <> max(width)""")
def table_regularity(spark, sf):
    cells = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("table"), F.col("l_linenumber").alias("row"), F.when(F.col("l_quantity") % 4 == 0, 2).otherwise(5000).alias("col_span"), F.when(F.col("l_suppkey") % 5 == 0, 2).alias("row_span"))
    return checks.irregular_tables(cells)


@query(r"""with c as (select conv_id, turn, regexp_split_to_array(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\s+') w from conversations), b as (select conv_id doc_id, 'manual_bullet' rule, turn seq from c where len(w) > 1 and w[2] <> '' and (w[1] in ('•', '-', '*') or regexp_full_match(w[1], '\d+[.)]'))),
n as (select conv_id doc_id, 'headings_present' rule, cast(null as bigint) seq from conversations group by 1 having not bool_or(role = 'system')), o as (select conv_id doc_id, 'opens_without_heading' rule, turn seq from (select *, row_number() over (partition by conv_id order by turn) k from conversations where trim(coalesce(text, '')) <> '') where k = 1 and role <> 'system'),
l as (select conv_id, turn, turn % 4 + 1 lv, lag(turn % 4 + 1) over (partition by conv_id order by turn) p from conversations where role = 'system'), s as (select conv_id doc_id, 'heading_skip' rule, turn seq from l where lv > coalesce(p, 0) + 1)
select rule, count(*) findings, count(distinct doc_id) documents, coalesce(sum(seq), 0) seqs from (select * from b union all select * from n union all select * from o union all select * from s) group by 1""")
def paragraph_findings(spark, sf):
    heading = F.col("role") == "system"
    p = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("seq"), "text", F.when(heading, F.col("turn") % 4 + 1).alias("level"), heading.alias("is_heading"), F.lit(False).alias("numbered"), F.lit(False).alias("coloured"))
    out = checks.paragraph_findings(p)
    return out.groupBy("rule").agg(F.count(F.lit(1)).alias("findings"), F.countDistinct("doc_id").alias("documents"), F.coalesce(F.sum("seq"), F.lit(0)).alias("seqs"))


@query(r"""with i as (select conv_id, length(coalesce(text, '')) >= 40 ok from conversations where role = 'assistant'), g as (select conv_id, count(*) items, sum(cast(ok as int)) good from i group by 1)
select k.conv_id, coalesce(items, 0) items, cast(coalesce(good, 0) as bigint) good, case when coalesce(items, 0) = 0 then 1 else round(good / items, 4) end score, coalesce(items, 0) > 0 applicable, case when coalesce(items, 0) = 0 then 1 else round(good / items, 4) end >= 0.85 passed
from (select distinct conv_id from conversations) k left join g using (conv_id)""")
def judge_ratio(spark, sf):
    c = table(spark, sf, "conversations")
    return checks.ratio_score(c.where("role = 'assistant'"), "conv_id", F.length(F.coalesce("text", F.lit(""))) >= 40, 0.85, keys=c)
