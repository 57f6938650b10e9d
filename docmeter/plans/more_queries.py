"""Further registered queries: experiment reads and comparisons, documents as readers meet them, routing and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docmeter.functions import color
from docmeter.operators import checks, experiments as ex, reading, records, routing, sheets, structure, text, tree
from docmeter.operators import evaluation as ev
from docmeter.plans.derived import CALIBRATIONS, EXPERIMENTS, JOBS, NODES, calibrations, experiments, jobs, nodes, scores, table
from docmeter.plans.queries import query

# Experiment store


@query(f"with {JOBS} select id, kind, status from jobs where id % 4 <> 0")
def job_delete(spark, sf):
    rows = jobs(spark, sf).select("id", "kind", "status")
    return ex.without(rows, "id", rows.where("id % 4 = 0"))


@query(f"with {JOBS} select id, kind, 'queued' status, 'created' stage, 0.0::double progress from jobs where status = 'failed'")
def job_create(spark, sf):
    return ex.created(jobs(spark, sf).where("status = 'failed'").select("id", "kind"), "queued", "created").drop("error")


@query(f"with {JOBS} select id, kind, status from jobs")
def job_public_columns(spark, sf):
    return jobs(spark, sf).drop("owner", "stage", "error", "cost", "created_at")


@query(f"with {JOBS} select id, status from jobs where status = 'failed' order by created_at, id")
def variants_listed(spark, sf):
    return ex.listed(jobs(spark, sf), [F.asc("created_at"), F.asc("id")], status="failed", kind=None).select("id", "status")


@query(f"with {EXPERIMENTS} select experiment_id, passed from experiments where harness_id = 3 and document_format = 'pdf' order by experiment_id")
def experiments_by_harness(spark, sf):
    return ex.listed(experiments(spark, sf), [F.asc("experiment_id")], harness_id=3, document_format="pdf").select("experiment_id", "passed")


@query(f"with {CALIBRATIONS} select calibration_id, kappa from calibrations where judge = 'click' and slice = 7 order by measured_at desc, calibration_id desc")
def calibrations_filtered(spark, sf):
    return ex.listed(calibrations(spark, sf), [F.desc("measured_at"), F.desc("calibration_id")], judge="click", slice=7, sample_size=None).select("calibration_id", "kappa")


@query("select event_id, event_type from events order by event_id desc limit 25")
def evolution_log_tail(spark, sf):
    return table(spark, sf, "events").orderBy(F.desc("event_id")).limit(25).select("event_id", "event_type")


@query("select event_id, sha256(array_to_string(list_sort([cast(user_id as varchar), event_type, cast(event_id as varchar)]), '|')) run_id from events")
def stable_run_id(spark, sf):
    return table(spark, sf, "events").select("event_id", ex.run_id(F.col("user_id"), F.col("event_type"), F.col("event_id")).alias("run_id"))


@query("""select p_partkey, concat('brand', p_size, '-', p_name) family from part""")
def model_family(spark, sf):
    suffix = F.get(F.array(*map(F.lit, ["", "-cloud", ":latest", "_cloud", "-Cloud:7b"])), (F.col("p_partkey") % 5).cast("int"))
    name = F.concat(F.lit(" vendor/x/Brand"), F.col("p_size").cast("string"), F.lit("-"), F.col("p_name"), suffix)
    return table(spark, sf, "part").select("p_partkey", ex.model_family(name).alias("family"))


@query(f"with {EXPERIMENTS} select dimension, case when score >= 0.8 then 'pass' else 'fail' end label, count(*) n from scores group by all")
def score_labels(spark, sf):
    return scores(spark, sf).select("dimension", ex.score_label(F.col("score")).alias("label")).groupBy("dimension", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {EXPERIMENTS} select concat(document_format, ':', dimension) \"key\", round(avg(score), 6) mean_score, count(*) n from scores group by 1")
def format_dimension_means(spark, sf):
    return ex.format_dimension_means(scores(spark, sf))


@query(f"with {EXPERIMENTS} select dimension \"key\", round(avg(score), 6) mean_score, count(*) n from scores where document_format = 'pdf' group by 1")
def one_format_dimension_means(spark, sf):
    return ex.format_dimension_means(scores(spark, sf).where("document_format = 'pdf'"))


_WEAK = "select '{pattern}' pattern, {f} format, {t} \"type\", dimension \"value\", count(*) n, round(avg(score), 4) mean from scores {where} group by {by} dimension having avg(score) < 0.8"


@query(f"""with {EXPERIMENTS}, f as (select *, list_filter([concat('v', violations_before % 7), case when violations_after % 4 = 2 then 'late' end], lambda x: x is not null) types from experiments where not passed),
m as (select 'failing_doc_types' pattern, null::varchar format, null::varchar "type", document_type "value" from f union all select 'failing_violation_types', null, null, unnest(types) from f
union all select 'common_errors', null, null, error from f where error <> '' union all select 'destructive_docs', null, null, document_id::varchar from experiments where violations_after > violations_before
union all select 'compliance_passes_quality_fails', null, unnest(list_filter([case when alt_text < 0.8 then 'alt_text' end, case when headings < 0.8 then 'headings' end, case when links < 0.8 then 'links' end], lambda x: x is not null)), document_id::varchar from experiments where passed
union all select 'behavioral_proxy_failures_by_dim', null, null, case dimension when 'headings' then 'heading_semantics' else 'table_structure' end from behaviours where not ok
union all select 'behavioral_proxy_failures_by_format', document_format, null, case dimension when 'headings' then 'heading_semantics' else 'table_structure' end from behaviours where not ok)
select pattern, format, "type", "value", count(*) n, null::double mean from m group by 1, 2, 3, 4
union all {_WEAK.format(pattern='weak_dimensions_overall', f='null', t='null', where='', by='')} union all {_WEAK.format(pattern='weak_dimensions_by_format', f='document_format', t='null', where='', by='document_format,')}
union all {_WEAK.format(pattern='weak_dimensions_by_doc_type', f='null', t='document_type', where="where document_type <> ''", by='document_type,')}
union all {_WEAK.format(pattern='weak_dimensions_by_format_and_doc_type', f='document_format', t='document_type', where="where document_type <> ''", by='document_format, document_type,')}""")
def failure_patterns(spark, sf):
    types = F.array_compact(F.array(F.concat(F.lit("v"), (F.col("violations_before") % 7).cast("string")), F.when(F.col("violations_after") % 4 == 2, "late")))
    return ex.failure_patterns(experiments(spark, sf).withColumn("violation_types", types))


@query(f"with {EXPERIMENTS} select case dimension when 'headings' then 'heading_semantics' else 'table_structure' end dimension, count(*) failures from behaviours where not ok group by 1")
def behavioural_failures(spark, sf):
    return ex.behavioural_failures(experiments(spark, sf))


@query(f"with {EXPERIMENTS} select document_type, count(*) failures, min(experiment_id) first_seen from experiments where not passed group by 1 order by 2 desc, 3 limit 3")
def top_failing_types(spark, sf):
    return ex.top_failing(experiments(spark, sf), 3)


@query("""with j as (select user_id % 7 judge, event_id % 300 doc_id, event_type dimension, value / 100 score from events), a as (select event_id % 300 doc_id, event_type dimension, value / 80 score, event_id v from events),
t as (select doc_id, dimension, max_by(score, v) truth from a group by 1, 2), p as (select judge, case when score >= 0.8 then 'pass' else 'fail' end a, case when truth >= 0.8 then 'pass' else 'fail' end b from j join t using (doc_id, dimension)),
c as (select judge, a, b, count(*) c from p group by all), n as (select judge, sum(c) n, sum(case when a = b then c else 0 end) s from c group by 1), x as (select judge, a v, sum(c) p from c group by 1, 2), y as (select judge, b v, sum(c) q from c group by 1, 2),
e as (select judge, sum(p * q) ab from x join y using (judge, v) group by 1), k as (select judge, n, s / n po, coalesce(ab, 0) / (n * n) pe from n left join e using (judge))
select judge, round(case when pe = 1 then case when po = 1 then 1.0 else 0.0 end else (po - pe) / (1 - pe) end, 6) kappa, cast(n as bigint) n from k""")
def calibration_summary(spark, sf):
    e = table(spark, sf, "events").select((F.col("user_id") % 7).alias("judge"), (F.col("event_id") % 300).alias("doc_id"), F.col("event_type").alias("dimension"), "value", F.col("event_id").alias("version"))
    judged = e.select("judge", "doc_id", "dimension", (F.col("value") / 100).alias("score"))
    return ex.calibration_summary(judged, e.select("doc_id", "dimension", (F.col("value") / 80).alias("score"), "version"), ["doc_id", "dimension"])


@query("""with o as (select event_id, event_type dimension, user_id a, event_id % 500 b, case event_id % 3 when 0 then 'a' when 1 then 'b' else 'tie' end w from events where user_id <> event_id % 500),
j as (select dimension, least(a, b) x, greatest(a, b) y, case when a > b and w = 'a' then 'b' when a > b and w = 'b' then 'a' else w end w from o where event_id % 2 = 0),
h as (select dimension, least(a, b) x, greatest(a, b) y, case when a < b and w = 'a' then 'b' when a < b and w = 'b' then 'a' else w end w from o where event_id % 2 = 1)
select 'pdf' format, j.dimension, count(*) pairs, round(avg(cast(j.w = h.w as int)), 6) agreement from j join h on j.dimension = h.dimension and j.x = h.x and j.y = h.y group by 2""")
def pairwise_agreement(spark, sf):
    w = F.get(F.array(F.lit("a"), F.lit("b"), F.lit("tie")), (F.col("event_id") % 3).cast("int"))
    e = table(spark, sf, "events").where("user_id <> event_id % 500").select("event_id", F.lit("pdf").alias("format"), F.col("event_type").alias("dimension"), F.col("user_id").alias("a"), (F.col("event_id") % 500).alias("b"), w.alias("winner"))
    judged, people = e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")
    return ex.pairwise_agreement(judged, people.select("format", "dimension", F.col("b").alias("a"), F.col("a").alias("b"), "winner"))


@query(f"""with {EXPERIMENTS}, h as (select distinct document_id doc_id from experiments where document_id % 50 = 0), b as (select document_id doc_id, avg(headings) s from experiments where line = 1 and document_id % 700 <> 0 group by 1),
c as (select line strategy, document_id doc_id, avg(alt_text) s from experiments group by 1, 2), r as (select strategy, h.doc_id, b.s x, c.s y from (select distinct strategy from c) p cross join h left join b using (doc_id) left join c using (strategy, doc_id)),
o as (select strategy, count(*) documents, count(*) filter (where x is null) no_baseline, count(*) filter (where y is null) no_candidate, round(avg(y - x), 6) lift from r group by 1)
select *, case when no_baseline + no_candidate > 0 then 'incomplete' when lift >= 0.05 then 'promote' when lift < -0.02 then 'regress' else 'keep' end verdict from o""")
def holdout_ab(spark, sf):
    e = experiments(spark, sf)
    dim = lambda k: F.col("quality_dimensions")[k]
    baseline = e.where("line = 1 and document_id % 700 <> 0").groupBy(F.col("document_id").alias("doc_id")).agg(F.avg(dim("headings")).alias("score"))
    candidate = e.groupBy(F.col("line").alias("strategy"), F.col("document_id").alias("doc_id")).agg(F.avg(dim("alt_text")).alias("score"))
    return ex.baseline_against_candidate(e.where("document_id % 50 = 0").select(F.col("document_id").alias("doc_id")), baseline, candidate)


@query("""with o as (select event_type strategy, event_id % 40 fingerprint, min(value / 100 - 0.2) lift from events where value > 5 group by 1, 2), s as (select strategy, count(*) runs, count(*) filter (where lift >= 0.05) lifting, round(min(lift), 6) worst from o group by 1)
select *, runs >= 3 and lifting = runs holds from s""")
def controlled_ab_series(spark, sf):
    runs = table(spark, sf, "events").where("value > 5").select(F.col("event_type").alias("strategy"), (F.col("event_id") % 40).alias("fingerprint"), (F.col("value") / 100 - 0.2).alias("lift"))
    return ex.controlled_series(runs, 3)


_SUMMARY = """s as (select 'all' "by", '*' "value", count(*) documents from documents union all select 'format', source, count(*) from documents group by 2 union all select 'class', lang, count(*) from documents group by 2
 union all select 'flag', f, count(*) from (select unnest(case when n_chars > 2000 then ['long', 'any'] else ['any'] end) f from documents) group by 2)"""


def _annotations(spark, sf):
    flags = F.when(F.col("n_chars") > 2000, F.array(F.lit("long"), F.lit("any"))).otherwise(F.array(F.lit("any")))
    return table(spark, sf, "documents").select(F.col("source").alias("format"), F.col("lang").alias("document_class"), flags.alias("flags"))


@query(f"with {_SUMMARY} select * from s")
def corpus_summary(spark, sf):
    return ex.corpus_summary(_annotations(spark, sf))


@query(f"""with {_SUMMARY}, w as (select * from (values ('all', '*', 100000000), ('flag', 'any', 1), ('flag', 'scanned', 5), ('class', 'en', 100000000)) t("by", "value", least))
select "by", "value", cast(least as bigint) least, coalesce(documents, 0) documents from w left join s using ("by", "value") where coalesce(documents, 0) < least""")
def corpus_coverage_gate(spark, sf):
    return ex.coverage_gate(ex.corpus_summary(_annotations(spark, sf)), {"all:*": 100_000_000, "flag:any": 1, "flag:scanned": 5, "class:en": 100_000_000})


@query(f"""with {EXPERIMENTS} select document_id, 2 * count(distinct dimension) filter (where score < 0.8) + 4 * max(score) + max(1 - score) priority from scores group by 1""")
def review_priority(spark, sf):
    each = scores(spark, sf).groupBy("document_id").agg(F.collect_set(F.when(F.col("score") < 0.8, F.col("dimension"))).alias("weak"), F.collect_set("score").alias("v"))
    return each.select("document_id", ex.priority_score(F.col("weak"), F.col("v"), F.col("v")).alias("priority"))


_VARIANTS = """v as (select p_brand harness_id, round(avg(p_retailprice) / 2000, 6) conformance_rate from part group by 1)"""


def _variants(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("harness_id")).agg(F.round(F.avg("p_retailprice") / 2000, 6).alias("conformance_rate"))


_RETIRED = """a as (select o_custkey harness_id, max(o_totalprice) conformance_rate, case when o_custkey % 20 = 0 then 0 else count(*) end total_docs, count(*) experiments, min(o_orderdate) created_at from orders group by 1),
s as (select *, harness_id % 7 = 2 front from a where total_docs > 0), l as (select * from s where front or experiments < 10), c as (select *, row_number() over (order by conformance_rate, created_at, harness_id) k from l)"""


@query(f"with {_RETIRED} select harness_id, conformance_rate, 'not on the frontier' reason from s where not front and experiments >= 10 union all select harness_id, conformance_rate, 'more than the cap' from c where k <= (select count(*) from l) - 50 and not front")
def variants_retired(spark, sf):
    k = F.col("o_custkey")
    v = table(spark, sf, "orders").groupBy(k.alias("harness_id")).agg(F.max("o_totalprice").alias("conformance_rate"), F.when(k % 20 == 0, 0).otherwise(F.count(F.lit(1))).alias("total_docs"), F.count(F.lit(1)).alias("experiments"), F.min("o_orderdate").alias("created_at"))
    return ex.retired(v, v.where("harness_id % 7 = 2"), 50, 10)


@query(f"with {_VARIANTS} select harness_id, conformance_rate from v where conformance_rate > (select min(conformance_rate) from v) + 0.00001")
def variants_promoted(spark, sf):
    v = _variants(spark, sf)
    return ex.promotable(v, v.orderBy("conformance_rate").limit(1), 0.00001)


@query(f"with {_VARIANTS} select harness_id, conformance_rate, 'active' status from v where harness_id like '%1' union all select harness_id, conformance_rate, 'promoted' from v where harness_id like '%3'")
def active_and_promoted(spark, sf):
    v = _variants(spark, sf)
    return v.where("harness_id like '%1'").withColumn("status", F.lit("active")).unionByName(v.where("harness_id like '%3'").withColumn("status", F.lit("promoted")))


@query("""select event_type provider, count(*) pages, count(*) filter (where event_id % 9 = 0) empty, round(avg(case when event_id % 9 <> 0 then user_id end), 6) blocks, round(avg(case when event_id % 9 <> 0 then event_id % 9 end), 6) chars, round(avg(case when event_id % 9 <> 0 then value end), 6) overlap from events group by 1""")
def ocr_benchmark(spark, sf):
    return ex.by_provider(table(spark, sf, "events").select(F.col("event_type").alias("provider"), F.col("user_id").alias("blocks"), (F.col("event_id") % 9).alias("chars"), F.col("value").alias("overlap")))


@query("""with f as (select l_orderkey doc_id, concat('1.', l_suppkey % 4) criterion, l_linenumber page from lineitem where l_returnflag = 'R') select doc_id, criterion, array_to_string(list_sort(list(distinct page)), ',') pages, count(*) findings from f group by 1, 2""")
def wcag_document_rollup(spark, sf):
    status = F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass")
    return ex.criterion_rollup(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.concat(F.lit("1."), (F.col("l_suppkey") % 4).cast("string")).alias("criterion"), status.alias("status")))


_CRITERIA = {"1.1.1": ["R0", "R1"], "1.3.1": ["R2"], "2.4.2": ["R3", "R1"], "3.1.1": ["R9"], "1.2.1": []}


@query("""with c as (select l_orderkey doc_id, l_linenumber * 100000 + l_suppkey seq, concat('R', l_suppkey % 5) rule_id, l_returnflag = 'R' bad, concat('Rule ', l_suppkey % 5, case when l_linenumber % 2 = 0 then concat(': line ', l_linenumber, '; part ', l_partkey) else '' end) said, 0 f from lineitem),
r as (select o_orderkey doc_id, o_custkey seq, concat('R', o_custkey % 12) rule_id, o_orderstatus = 'F' bad, concat('Reader ', o_custkey) said, 1 f from orders), u as (select * from c union all select * from r),
m as (select * from (values ('1.1.1', 'R0'), ('1.1.1', 'R1'), ('1.3.1', 'R2'), ('2.4.2', 'R3'), ('2.4.2', 'R1'), ('3.1.1', 'R9')) t(criterion, rule_id)), n as (select unnest(['1.1.1', '1.3.1', '2.4.2', '3.1.1', '1.2.1']) criterion),
g as (select doc_id, criterion, bool_or(bad) bad, string_agg(said, '; ' order by f, seq, said) filter (where bad) remarks from u join m using (rule_id) group by 1, 2)
select d.doc_id, n.criterion, case when bad is null then 'N/A' when bad then 'FAIL' else 'PASS' end status, case when n.criterion = '1.2.1' then 'Not applicable to static PDF documents' when bad is null then 'No applicable checks for this document' else coalesce(remarks, '') end remarks
from (select distinct doc_id from u) d cross join n left join g on g.doc_id = d.doc_id and g.criterion = n.criterion""")
def wcag_criterion_status(spark, sf):
    n = F.col("l_linenumber")
    details = F.when(n % 2 == 0, F.array(F.concat(F.lit("line "), n.cast("string")), F.concat(F.lit("part "), F.col("l_partkey").cast("string")), F.lit("more")))
    rule = F.concat(F.lit("R"), (F.col("l_suppkey") % 5).cast("string"))
    c = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (n * 100000 + F.col("l_suppkey")).cast("long").alias("seq"), rule.alias("rule_id"), F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Passed").alias("status"), F.concat(F.lit("Rule "), F.substring(rule, 2, 9)).alias("description"), details.alias("details"))
    k = F.col("o_custkey")
    r = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), k.alias("seq"), F.concat(F.lit("R"), (k % 12).cast("string")).alias("rule_id"), F.when(F.col("o_orderstatus") == "F", "Error").otherwise("warning").alias("severity"), F.concat(F.lit("Reader "), k.cast("string")).alias("description"))
    return ex.criterion_status(c, r, _CRITERIA)


@query("""select l_orderkey doc_id, concat('R', l_suppkey % 5) code, 'checker' source, 'error' severity, l_suppkey % 2 = 0 fixable, false blocking, l_linestatus description from lineitem where l_returnflag = 'R'
union all select o_orderkey, o_orderpriority, 'screen-reader', case when o_orderstatus = 'F' then 'error' else 'warning' end, true, false, '' from orders where o_orderstatus <> 'O'
union all select event_id, case when event_id % 3 > 0 then event_type else 'unknown-rule' end, 'verapdf', 'error', event_id % 4 > 0, false, event_type from events""")
def normalised_issues(spark, sf):
    checks = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("R"), (F.col("l_suppkey") % 5).cast("string")).alias("rule_id"), F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Passed").alias("status"), (F.col("l_suppkey") % 2 == 0).alias("fixable"), F.col("l_linestatus").alias("description"))
    reader = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("rule_id"), F.when(F.col("o_orderstatus") == "F", "ERROR").when(F.col("o_orderstatus") == "P", "Warning").otherwise("info").alias("severity"), F.lit(None).cast("string").alias("description"))
    e = F.col("event_id")
    violations = table(spark, sf, "events").select(e.alias("doc_id"), F.when(e % 3 > 0, F.col("event_type")).alias("id"), F.col("event_type").alias("description"), (e % 4 == 0).alias("font_limited"))
    return ex.issue_list(checks, reader, violations)


@query("""with f as (select o_orderkey doc_id, o_orderkey % 11 <> 0 a, o_custkey % 3 b, o_custkey % 4 c, case when o_orderstatus = 'P' then null else o_orderstatus = 'F' end d, case when o_orderkey % 2 = 0 then o_totalprice > 1000 end e, o_orderpriority <> '5-LOW' t from orders),
g as (select doc_id, list_filter([case when not a then 'openable' end, case when b <> 0 then 'checker' end, case when c <> 0 then 'screen_reader' end, case when not d then 'verapdf' end, case when not e then 'visual' end, case when not t then 'text' end], lambda x: x is not null) g from f)
select doc_id, array_to_string(g, ',') failed_gates, len(g) = 0 accepted from g""")
def acceptance_composite(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    facts = table(spark, sf, "orders").select(k.alias("doc_id"), (k % 11 != 0).alias("openable"), (c % 3).alias("checker_failures"), (c % 4).alias("reader_errors"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("verapdf_passed"), F.when(k % 2 == 0, F.col("o_totalprice") > 1000).alias("visual_ok"), (F.col("o_orderpriority") != "5-LOW").alias("text_ok"))
    return ex.accepted(facts)


@query("""with f as (select o_orderkey doc_id, case when o_orderkey % 17 > 0 then o_orderkey % 13 <> 0 end openable, o_orderkey % 7 <> 0 has_text, o_custkey % 2 = 0 or o_custkey % 3 = 0 or o_custkey % 7 = 0 signal,
list_filter([case when o_custkey % 5 = 1 then 'docx-title' end, case when o_custkey % 4 = 1 then 'docx-language' end], lambda x: x is not null) rules, case when o_orderstatus <> 'O' then o_orderstatus = 'F' end quality from orders)
select doc_id, case when openable is null or not openable or not has_text then 'L0' when not signal then 'L1' when len(rules) > 0 then 'L2' when coalesce(quality, false) then 'L4' else 'L3' end "level",
case when openable is null then 'evaluation_error' when not openable then 'not_openable' when not has_text then 'no_text_layer' when not signal then 'no_structural_signal' when len(rules) > 0 then array_to_string(rules, ',')
 when quality is null then 'quality_layer_not_run' when not quality then 'quality_failed' else '' end blocking from f""")
def office_levels(spark, sf):
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    rules = F.array_compact(F.array(F.when(c % 5 == 1, "docx-title"), F.when(c % 4 == 1, "docx-language")))
    named = {"doc_id": k, "openable": F.when(k % 17 > 0, k % 13 != 0), "has_text": k % 7 != 0, "has_headings": c % 2 == 0, "has_table_headers": c % 3 == 0, "has_alternatives": c % 7 == 0, "failed_rules": rules, "quality_passed": F.when(s != "O", s == "F")}
    levels = ex.office_level(table(spark, sf, "orders").select(*[v.alias(n) for n, v in named.items()]))
    return levels.withColumn("blocking", F.array_join("blocking", ","))


# Trees and headings

_HEADS = f"{NODES}, h as (select doc_id, seq, try_cast(substr(tag, 2) as int) lv from nodes where tag like 'H_')"


def _headings(spark, sf):
    return nodes(spark, sf).where("tag like 'H_'").select("doc_id", "seq", F.try_element_at(F.array(*[F.lit(i) for i in range(1, 7)]), F.substring("tag", 2, 1).try_cast("int")).alias("level"))


@query(f"with {_HEADS}, p as (select *, row_number() over w r, lag(lv) over w b from h window w as (partition by doc_id order by seq)) select doc_id, seq, case when r = 1 and lv <> 1 then 'first_not_1' else 'skip' end finding from p where (r = 1 and lv <> 1) or lv > b + 1")
def heading_skips_reader(spark, sf):
    return structure.heading_skips(_headings(spark, sf), "doc_id", "seq", "level", "warn").select("doc_id", "seq", "finding")


@query(f"with {_HEADS}, p as (select *, coalesce(lag(lv) over (partition by doc_id order by seq), 0) b from h) select doc_id, seq from p where lv > b + 1")
def heading_skips_checker(spark, sf):
    return structure.heading_skips(_headings(spark, sf), "doc_id", "seq", "level", "virtual").select("doc_id", "seq")


@query(f"with {_HEADS}, p as (select *, last_value(lv ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and 1 preceding) b from h) select doc_id, seq from p where lv > b + 1")
def heading_skips_navigation(spark, sf):
    return structure.heading_skips(_headings(spark, sf), "doc_id", "seq", "level", "carry").select("doc_id", "seq")


@query(f"""with recursive {_HEADS}, n as (select doc_id, seq, lv, row_number() over (partition by doc_id order by seq) r from h where lv is not null),
f as (select doc_id, r, least(lv, 1) lv from n where r = 1 union all select n.doc_id, n.r, least(n.lv, f.lv + 1) from f join n on n.doc_id = f.doc_id and n.r = f.r + 1) select doc_id, string_agg(lv, ',' order by r) levels from f group by 1""")
def heading_repair(spark, sf):
    by = _headings(spark, sf).where("level is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "level"))).alias("h"))
    return by.select("doc_id", F.array_join(F.transform(structure.repaired_levels(F.col("h.level")), lambda x: x.cast("string")), ",").alias("levels"))


@query(f"""with {_HEADS}, p as (select *, last_value(lv ignore nulls) over (partition by doc_id order by seq rows between unbounded preceding and 1 preceding) b from h),
s as (select doc_id, count(*) items, count(*) filter (where not (lv is null or coalesce(lv > b + 1, false))) good from p group by 1) select doc_id, items, good, round(good / items, 4) score, true applicable, round(good / items, 4) >= 0.85 passed from s""")
def heading_navigation_score(spark, sf):
    return reading.heading_navigation(_headings(spark, sf))


_PARENTS = f"{NODES}, p as (select doc_id, seq, tag, (select max(m.seq) from nodes m where m.doc_id = n.doc_id and m.seq < n.seq and m.depth < n.depth) parent_seq from nodes n), q as (select p.*, m.tag parent_tag from p left join nodes m on m.doc_id = p.doc_id and m.seq = p.parent_seq)"


@query(f"""with {_PARENTS}, r as (select *, case when tag = 'TR' and coalesce(parent_tag, '') not in ('Table', 'THead', 'TBody', 'TFoot') then 'tables-tr-parent' when tag in ('TH', 'TD') and coalesce(parent_tag, '') <> 'TR' then 'tables-th-td-parent'
when tag = 'LI' and coalesce(parent_tag, '') <> 'L' then 'lists-li-parent' when tag in ('Lbl', 'LBody') and coalesce(parent_tag, '') <> 'LI' then 'lists-lbl-lbody-parent' end rule_id from q) select doc_id, seq, tag, parent_tag, rule_id from r where rule_id is not null""")
def parent_rules(spark, sf):
    return structure.parent_findings(structure.tree_parents(nodes(spark, sf)))


def _lacks(root: str, wanted: str) -> str:
    return f"""with {NODES}, r as (select *, coalesce((select min(m.seq) from nodes m where m.doc_id = n.doc_id and m.seq > n.seq and m.depth <= n.depth), 1000) stop from nodes n where tag = '{root}')
select doc_id, seq, tag from r where not exists (select 1 from nodes m where m.doc_id = r.doc_id and m.seq > r.seq and m.seq < r.stop and m.tag = '{wanted}')"""


@query(_lacks("Table", "TH"))
def tables_without_headers(spark, sf):
    return structure.subtree_lacks(nodes(spark, sf), "Table", ["TH"])


@query(_lacks("L", "LI"))
def lists_without_items(spark, sf):
    return structure.subtree_lacks(nodes(spark, sf), "L", ["LI"])


@query(f"with {NODES}, k as (select *, (select count(*) from nodes m where m.doc_id = n.doc_id and m.seq > n.seq and m.depth = n.depth + 1 and not exists (select 1 from nodes b where b.doc_id = n.doc_id and b.seq > n.seq and b.seq < m.seq and b.depth <= n.depth)) kids from nodes n) select doc_id, seq from k where alt_text is not null and tag not in ('Figure', 'Table') and kids > 0")
def redundant_alternatives(spark, sf):
    n = nodes(spark, sf)
    kids = structure.tree_parents(n).where("parent_seq is not null").groupBy("doc_id", F.col("parent_seq").alias("seq"), F.col("depth")).agg(F.count(F.lit(1)).alias("n"))
    direct = kids.join(n.select("doc_id", "seq", F.col("depth").alias("own")), ["doc_id", "seq"]).where("depth = own + 1").select("doc_id", "seq", F.col("n").alias("children"))
    none = spark.createDataFrame([], "doc_id long, seq int, kind string, page int, mcid int")
    shown = spark.createDataFrame([], "doc_id long, page int, mcid int, text string, image boolean")
    facts = n.join(direct, ["doc_id", "seq"], "left").fillna(0, ["children"])
    return tree.alt_content_findings(facts, none, shown, n.select("doc_id", F.lit(1).alias("pages")).distinct()).where("rule_id = 'alt-redundant'").select("doc_id", "seq")


@query(f"with {NODES}, d as (select distinct doc_id from nodes), n as (select doc_id, count(*) f, count(*) filter (where trim(coalesce(alt_text, '')) <> '') a from nodes where tag = 'Figure' group by 1) select doc_id, round(100 * a / f, 1) coverage from d left join n using (doc_id)")
def alt_coverage(spark, sf):
    n = nodes(spark, sf)
    return reading.alt_coverage(n.where("tag = 'Figure'"), n)


@query(f"""with {NODES}, f as (select doc_id, tag, count(*) found from nodes group by 1, 2), e as (select doc_id, 'P' tag, 1 n from nodes group by 1) select coalesce(e.doc_id, f.doc_id) doc_id, coalesce(e.tag, f.tag) tag, cast(coalesce(n, 0) as bigint) expected, coalesce(found, 0) found
from e full join f on e.doc_id = f.doc_id and e.tag = f.tag where coalesce(n, 0) <> coalesce(found, 0)""")
def tag_assertion(spark, sf):
    n = nodes(spark, sf)
    return reading.tag_assertion(n, n.select("doc_id").distinct().select("doc_id", F.lit("P").alias("tag"), F.lit(1).alias("n")))


@query(f"""with {NODES}, c as (select doc_id, seq from nodes where tag in ('P', 'Figure')), t as (select doc_id, seq from nodes where depth > 1) select doc_id, seq, 'page-content-tagged' rule_id from c where (doc_id, seq) not in (select (doc_id, seq) from t)""")
def untagged_content(spark, sf):
    n = nodes(spark, sf)
    return checks.untagged(n.where("tag in ('P', 'Figure')"), n.where("depth > 1"), ["doc_id", "seq"], "page-content-tagged")


@query("""with f as (select *, row_number() over (partition by l_orderkey, l_suppkey % 2 order by l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey) r from lineitem), g as (select l_orderkey doc_id, cast(l_suppkey % 2 as int) "table", l_returnflag = 'A' h, l_tax > 0.06 m from f where r = 1)
select doc_id, "table", 'header_unmarked' rule from g where not h union all select doc_id, "table", 'header_merged' from g where m""")
def table_headers_marked(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_suppkey") % 2).cast("int").alias("table"), (F.col("l_linenumber") * 1_000_000_000_000 + F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("row"), (F.col("l_returnflag") == "A").alias("is_header"), (F.col("l_tax") > 0.06).alias("has_merged"))
    return checks.table_header_findings(rows)


@query("""with t as (select l_orderkey doc_id, l_linenumber % 3 header_cells, cast(l_quantity as int) % 6 "rows", 2 "columns", cast(l_quantity as int) % 4 filled_cells from lineitem), r as (select * from t where not (filled_cells <= header_cells and "rows" * 2 > 4)),
n as (select doc_id, count(*) items, count(*) filter (where header_cells > 0 and "rows" > 1) good from r group by 1), d as (select doc_id, coalesce(items, 0) items, coalesce(good, 0) good from (select distinct doc_id from t) left join n using (doc_id)),
s as (select *, case when items = 0 then 1.0 else round(good / items, 4) end score from d) select doc_id, items, good, score, items > 0 applicable, score >= 0.95 passed from s""")
def table_lookup_score(spark, sf):
    q = F.col("l_quantity").cast("int")
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("table"), (F.col("l_linenumber") % 3).alias("header_cells"), (q % 6).alias("rows"), F.lit(2).alias("columns"), (q % 4).alias("filled_cells"))
    return reading.lookup_tables(t)


# Pages, slides, sheets, transcripts


@query("""with f as (select conv_id doc_id, count(*) filter (where role = 'user' and length(coalesce(text, '')) < 40) e, count(*) filter (where role <> 'user' and length(coalesce(text, '')) < 40) w from conversations group by 1), s as (select doc_id, e errors, w warnings, round(greatest(0.0, 1 - 0.5 * e - 0.1 * w), 4) score from f)
select *, score >= 0.9 passed from s""")
def reading_comprehension_score(spark, sf):
    c = table(spark, sf, "conversations").withColumnRenamed("conv_id", "doc_id")
    found = c.where(F.length(F.coalesce("text", F.lit(""))) < 40).select("doc_id", F.when(F.col("role") == "user", "error").otherwise("warning").alias("severity"))
    return reading.reading_comprehension(found, c)


@query(r"""with l as (select doc_id, trim(regexp_replace(x, '\s+', ' ', 'g')) block from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) x from documents))
select doc_id, 1 page, block, count(*) times from l where length(block) >= 40 and len(string_split(block, ' ')) >= 5 group by 1, 3 having count(*) >= 2""")
def repeated_page_blocks(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.lit(1).alias("page"), F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("text"))
    return reading.repeated_blocks(lines, least=2)


@query(r"""with b as (select doc_id, x, i from (select doc_id, unnest(l) x, unnest(range(len(l))) i from (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\n\s*\n'), lambda b: trim(b, ' ') <> '') l from documents)))
select case when contains(x, '|') then 'table' when starts_with(ltrim(x, ' '), '#') then 'heading' else 'paragraph' end "role", count(*) blocks, cast(sum(i) as bigint) places, cast(sum(length(x)) as bigint) chars from b group by 1""")
def markdown_block_roles(spark, sf):
    b = table(spark, sf, "documents").select(F.explode(reading.markdown_blocks(F.col("text"))).alias("b")).select("b.*")
    return b.groupBy("role").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").cast("long").alias("places"), F.sum(F.length("block")).cast("long").alias("chars"))


@query(r"select p_partkey, trim(regexp_replace(lower(concat(p_name, ' (', p_brand, ')')), '[^a-z0-9]+', ' ', 'g')) header from part")
def header_keys(spark, sf):
    return table(spark, sf, "part").select("p_partkey", reading.header_key(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).alias("header"))


@query("""with n as (select p_brand, list(p_name order by p_partkey) l from part group by 1), k as (select p_brand, l, unnest(range(0, list_min(list_transform(l, lambda x: length(x))) + 1)) k from n),
b as (select p_brand, max(k) k, any_value(l[1]) f from k where len(list_distinct(list_transform(l, lambda x: substr(x, 1, k)))) = 1 group by 1) select p_brand, case when k >= 4 then substr(f, 1, k) else '' end prefix from b""")
def common_prefixes(spark, sf):
    return reading.common_prefixes(table(spark, sf, "part"), "p_brand", "p_name")


@query("""with p as (select p_partkey, p_size * 3 n from part), b as (select p_partkey, n, case when n > 50 then 2 else least(n, 10) end k from p)
select p_partkey, array_to_string(list_distinct_ordered, ',') pages from (select p_partkey, list_transform(range(k), lambda i: cast(1 + round_even(i * (n - 1)::double / greatest(k - 1, 1), 0) as int)) list_distinct_ordered from b)""")
def page_sample(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(reading.sampled_pages((F.col("p_size") * 3).cast("int")), lambda x: x.cast("string")), ",").alias("pages"))


@query(r"""with s as (select p_partkey, 1 + p_partkey % 3 place, case p_partkey % 5 when 0 then concat('Sheet', p_size) when 1 then '' when 2 then concat(p_name, ' ', p_brand) when 3 then 'Summary of parts' else left(p_name, 3) end t from part),
i as (select p_partkey, list_filter([case when length(trim(t)) < 4 or regexp_full_match(lower(trim(t)), 'sheet[0-9]+') then 'non_descriptive_sheet_name' end, case when place > 1 and t = 'Summary of parts' then 'overview_sheet_not_first' end], lambda x: x is not null) x from s)
select p_partkey, array_to_string(x, ',') issues, case when len(x) = 0 then 1.0 when list_contains(x, 'non_descriptive_sheet_name') then 0.0 else 0.5 end::double score from i""")
def sheet_names(spark, sf):
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, F.concat(F.lit("Sheet"), F.col("p_size").cast("string"))).when(k == 1, "").when(k == 2, F.concat_ws(" ", "p_name", "p_brand")).when(k == 3, "Summary of parts").otherwise(F.substring("p_name", 1, 3))
    rows = table(spark, sf, "part").select("p_partkey", name.alias("name"), (F.col("p_partkey") % 3 + 1).alias("place"), F.lit("visible").alias("state"), F.array().cast("array<string>").alias("terms"))
    return sheets.sheet_issues(rows).select("p_partkey", F.array_join("issues", ",").alias("issues"), "score")


@query("select event_id, concat('1.', event_id % 9, '.', user_id % 30) code from events where event_id % 3 = 0 union all select event_id, '' from events where event_id % 3 <> 0")
def criterion_codes(spark, sf):
    t = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Criterion 1."), (F.col("event_id") % 9).cast("string"), F.lit("."), (F.col("user_id") % 30).cast("string"), F.lit(" (A)"))).otherwise("none, see 7.1.2")
    return table(spark, sf, "events").select("event_id", reading.criterion_code(t).alias("code"))


@query("""with b as (select l_orderkey doc_id, 1 page, l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey idx, (l_suppkey % 4) * 100.0 l, (l_suppkey % 4) * 100.0 + 80 r, (l_partkey % 7) * 50.0 b, (l_partkey % 7) * 50.0 + 40 t from lineitem), p as (select *, lag(l) over w pl, lag(r) over w pr, lag(b) over w pb, lag(t) over w pt from b window w as (partition by doc_id order by idx))
select doc_id, page, idx from p where pl is not null and ((greatest(0, least(r, pr) - greatest(l, pl)) / 80 >= 0.25 and b >= pt) or (greatest(0, least(t, pt) - greatest(b, pb)) / 40 >= 0.25 and r <= pl))""")
def slide_backtracking(spark, sf):
    x, y = (F.col("l_suppkey") % 4) * 100.0, (F.col("l_partkey") % 7) * 50.0
    boxes = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), (F.col("l_linenumber") * 1_000_000_000_000 + F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("idx"), x.alias("left"), y.alias("bottom"), (x + 80).alias("right"), (y + 40).alias("top"))
    return reading.slide_backtracking(boxes)


@query("""with l as (select user_id doc_id, event_id seq, event_id % 5 k, event_id % 6 + 1 lv from events), h as (select *, lag(lv) over (partition by doc_id order by seq) b from l where k = 3)
select doc_id, seq, 'unlabelled' rule from l where k = 0 union all select doc_id, seq, 'vague_link' from l where k = 1 union all select doc_id, seq, 'heading_jump' from h where lv > b + 1""")
def transcript_findings(spark, sf):
    k = F.col("event_id") % 5
    said = F.when(k == 0, "graphic  Image").when(k == 1, "link Click here").when(k == 2, "link Annual report").when(k == 3, "heading Budget").otherwise("button Save")
    lines = table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), said.alias("text"), F.when(k == 3, F.col("event_id") % 6 + 1).alias("level"))
    return reading.transcript_findings(lines)


@query("select conv_id, turn, last_value(case when role = 'system' then turn end ignore nulls) over (partition by conv_id order by turn) page from conversations")
def page_carried_forward(spark, sf):
    c = table(spark, sf, "conversations")
    return structure.carried_page(c, "conv_id", "turn", F.when(F.col("role") == "system", F.col("turn"))).select("conv_id", "turn", "page")


# Routing and small functions


@query("""with v as (select l_orderkey doc_id, list(distinct case l_suppkey % 4 when 0 then '7.21.4.1-1' when 1 then '7.21.7-1' when 2 then '7.1-3' else '' end) r from lineitem group by 1), f as (select doc_id, list_filter(r, lambda x: x <> '') r from v)
select doc_id, len(r) > 0 and len(list_filter(r, lambda x: not starts_with(x, '7.21'))) = 0 fonts_only from f""")
def fonts_only(spark, sf):
    rule = F.get(F.array(F.lit("7.21.4.1-1"), F.lit("7.21.7-1"), F.lit("7.1-3"), F.lit("")), (F.col("l_suppkey") % 4).cast("int"))
    v = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.collect_set(rule).alias("r"))
    return v.select("doc_id", routing.only_font_clauses(F.col("r")).alias("fonts_only"))


@query("""select o_orderkey id, case when o_custkey % 4 = 0 and (o_orderkey % 10) / 100.0 < 0.05 then 'blank' when o_custkey % 30 < 10 and (o_orderkey % 10) / 100.0 < 0.05 then 'near_blank' end skip from orders""")
def page_skips(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("id"), routing.page_skip(F.col("o_custkey") % 4, F.col("o_custkey") % 30, (F.col("o_orderkey") % 10) / 100.0).alias("skip"))


@query("""with v as (select l_orderkey doc_id, list_sort(list(distinct concat('c', l_suppkey % 5))) a, list_sort(list(distinct concat('c', l_suppkey % 5)) filter (where l_returnflag <> 'R')) b from lineitem group by 1)
select doc_id, len(list_filter(coalesce(b, []), lambda x: not list_contains(a, x))) = 0 and len(list_filter(a, lambda x: not list_contains(coalesce(b, []), x))) > 0 smaller from v""")
def strict_subset_gate(spark, sf):
    c = F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string"))
    v = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.collect_set(c).alias("a"), F.collect_set(F.when(F.col("l_returnflag") != "R", c)).alias("b"))
    return v.select("doc_id", routing.smaller_violations(F.col("a"), F.col("b")).alias("smaller"))


@query(f"""with {EXPERIMENTS}, r as (select experiment_id, document_type, violations_before, row_number() over (partition by document_type order by experiment_id, violations_before) k, row_number() over (partition by document_type, violations_before order by experiment_id) s from experiments)
select experiment_id, document_type, violations_before from r where s = 1 order by k > 1, experiment_id, violations_before limit 12""")
def few_shot_examples(spark, sf):
    return ev.diverse_examples(experiments(spark, sf).select("experiment_id", "document_type", "violations_before"), "document_type", "violations_before", [F.asc("experiment_id"), F.asc("violations_before")], 12)


@query("""select p_partkey, printf('#%02x%02x%02x', p_partkey % 256, p_size % 256, (p_partkey * 7) % 256) hex, p_size >= 18 or (p_size >= 14 and p_partkey % 2 = 0) large, case when p_size >= 18 or (p_size >= 14 and p_partkey % 2 = 0) then 3.0 else 4.5 end threshold from part""")
def colour_thresholds(spark, sf):
    large = color.is_large(F.col("p_size"), F.col("p_partkey") % 2 == 0)
    return table(spark, sf, "part").select("p_partkey", color.to_hex((F.col("p_partkey") % 256).cast("int"), (F.col("p_size") % 256).cast("int"), ((F.col("p_partkey") * 7) % 256).cast("int")).alias("hex"), large.alias("large"), color.threshold(large, F.lit("AA")).alias("threshold"))


@query("""select p_partkey, concat('Art. ', p_size) line, 'none' kind from part where p_partkey % 5 = 4 union all select p_partkey, case p_partkey % 5 when 0 then concat('## ', p_name) when 1 then concat('Article ', p_size) when 2 then concat('Section ', p_size) else concat('IV. ', p_name) end,
case p_partkey % 5 when 0 then 'markdown' when 1 then 'article' when 2 then 'section' else 'roman' end from part where p_partkey % 5 < 4""")
def heading_classes(spark, sf):
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    line = F.when(k == 0, F.concat(F.lit("## "), "p_name")).when(k == 1, F.concat(F.lit("Article "), size)).when(k == 2, F.concat(F.lit("Section "), size)).when(k == 3, F.concat(F.lit("IV. "), "p_name")).otherwise(F.concat(F.lit("Art. "), size))
    return table(spark, sf, "part").select("p_partkey", line.alias("line"), F.coalesce(text.heading_class(line), F.lit("none")).alias("kind"))


@query("""with d as (select unnest(['alt_text', 'headings', 'links', 'tables', 'order']) d), a as (select p_brand, list(distinct case p_size % 3 when 0 then 'alt_text' when 1 then 'links' else 'order' end) l from part group by 1)
select p_brand, array_to_string(list_filter(['alt_text', 'headings', 'links', 'tables', 'order'], lambda x: not list_contains(l, x)), ',') missing from a""")
def dimensions_not_applicable(spark, sf):
    every = F.array(*[F.lit(d) for d in ("alt_text", "headings", "links", "tables", "order")])
    dim = F.get(F.array(F.lit("alt_text"), F.lit("links"), F.lit("order")), (F.col("p_size") % 3).cast("int"))
    a = table(spark, sf, "part").groupBy("p_brand").agg(F.collect_set(dim).alias("l"))
    return a.select("p_brand", F.array_join(F.array_except(every, F.col("l")), ",").alias("missing"))


@query("""select user_id % 20 doc_id, event_type tool, event_id % 7 id, min(event_id) input_order from (select *, row_number() over (partition by user_id % 20, event_type, event_id % 7, user_id % 3, case when event_id % 2 = 0 then repeat(chr(cast(97 + event_id % 5 as int)), 80) end order by event_id) r from events) where r = 1 group by 1, 2, 3, user_id % 3, case when event_id % 2 = 0 then event_id % 5 end""")
def violation_dedupe_snippets(spark, sf):
    letter = F.get(F.array(*[F.lit(c) for c in "abcde"]), (F.col("event_id") % 5).cast("int"))
    snippet = F.when(F.col("event_id") % 2 == 0, F.array(F.concat(F.repeat(letter, 80), F.col("event_id").cast("string")))).otherwise(F.array().cast("array<string>"))
    e = table(spark, sf, "events").select((F.col("user_id") % 20).alias("doc_id"), F.col("event_type").alias("tool"), (F.col("event_id") % 7).alias("id"), (F.col("user_id") % 3).cast("string").alias("selector"), F.lit("serious").alias("impact"), snippet.alias("html_snippets"), F.col("event_id").alias("input_order"))
    return records.first_of_violations(e, {"critical": 0, "serious": 1}).select("doc_id", "tool", "id", "input_order")


# Nearest colour that passes: 64 halvings of lightness at the same hue

_LIN = "case when {c} / 255.0 <= 0.04045 then {c} / 255.0 / 12.92 else pow(({c} / 255.0 + 0.055) / 1.055, 2.4) end"


def _lum(*channels: str) -> str:
    return "(" + " + ".join(f"{w} * {_LIN.format(c=c)}" for w, c in zip((0.2126, 0.7152, 0.0722), channels, strict=True)) + ")"


def _weight(shift: str) -> str:
    h = f"(t + {shift} - floor(t + {shift}))"
    return f"case when span = 0 then 0.0 when {h} < 1.0 / 6 then {h} * 6.0 when {h} < 0.5 then 1.0 when {h} < 2.0 / 3 then (2.0 / 3 - {h}) * 6.0 else 0.0 end"


_AT = "(2.0 * {l} - case when {l} <= 0.5 then {l} * (1.0 + s) else {l} + s - {l} * s end)"
_TO = "({low} + 2.0 * (case when {l} <= 0.5 then {l} * (1.0 + s) else {l} + s - {l} * s end - {l}) * {w})"


def _at(light: str, w: str) -> str:
    low = _AT.format(l=light)
    return f"(255.0 * {_TO.format(low=low, l=light, w=w)})"


def _nearest_sql(turn: str) -> str:
    return f"""with recursive p as (select p_partkey, p_partkey * 37 % 256 r, p_size * 5 % 256 g, case when p_partkey % 4 = 0 then p_partkey * 37 % 256 else p_partkey * 11 % 256 end b, p_partkey * 3 % 256 x, p_size * 4 % 256 y, p_partkey % 256 z from part),
q as (select *, {_lum('x', 'y', 'z')} bl, {_lum('r', 'g', 'b')} fl, greatest(r, g, b) / 255.0 high, least(r, g, b) / 255.0 low from p), k as (select *, high - low span, (greatest(fl, bl) + 0.05) / (least(fl, bl) + 0.05) >= 4.5 fine from q),
h as (select *, case when span = 0 then 0.0 when high + low <= 1 then span / (high + low) else span / (2.0 - high - low) end s, case when span = 0 then 0.0 when r / 255.0 = high then ((high - b / 255.0) - (high - g / 255.0)) / span
 when g / 255.0 = high then 2.0 + ((high - r / 255.0) - (high - b / 255.0)) / span else 4.0 + ((high - g / 255.0) - (high - r / 255.0)) / span end / 6.0 t from k),
w as (select *, {_weight('1.0 / 3')} w0, {_weight('0.0')} w1, {_weight('(-1.0 / 3)')} w2 from h),
c as (select 0 i, p_partkey, s, w0, w1, w2, bl, 0.0::double lo, 1.0::double hi, case when bl > 0.5 then 0.0 else 1.0 end::double best, 0.5::double l from w where not fine
 union all select i + 1, p_partkey, s, w0, w1, w2, bl, case when {turn} then lo else l end, case when {turn} then l else hi end, case when ok then l else best end, (case when {turn} then lo else l end + case when {turn} then l else hi end) / 2
 from (select *, (greatest(n, bl) + 0.05) / (least(n, bl) + 0.05) >= 4.5 ok from (select *, {_lum(_at('l', 'w0'), _at('l', 'w1'), _at('l', 'w2'))} n from c where i < 64))),
e as (select *, best as l0 from c where i = 64)
select p_partkey, r::int r, g::int g, b::int b from w where fine union all select p_partkey, greatest(0, least(255, case when bl > 0.5 then floor({_at('best', 'w0')}) else ceil({_at('best', 'w0')}) end))::int, greatest(0, least(255, case when bl > 0.5 then floor({_at('best', 'w1')}) else ceil({_at('best', 'w1')}) end))::int, greatest(0, least(255, case when bl > 0.5 then floor({_at('best', 'w2')}) else ceil({_at('best', 'w2')}) end))::int from e"""


def _nearest(spark, sf, away: bool):
    k, z = F.col("p_partkey"), F.col("p_size")
    red = k * 37 % 256
    pair = [red, z * 5 % 256, F.when(k % 4 == 0, red).otherwise(k * 11 % 256), k * 3 % 256, z * 4 % 256, k % 256]
    return color.with_nearest_passing(table(spark, sf, "part"), "c", pair, away=away).select("p_partkey", "c.r", "c.g", "c.b")


@query(_nearest_sql("ok <> (bl > 0.5)"))
def nearest_passing_colour(spark, sf):
    return _nearest(spark, sf, away=False)


@query(_nearest_sql("ok = (bl > 0.5)"))
def nearest_passing_colour_away(spark, sf):
    return _nearest(spark, sf, away=True)
