"""Registered queries over documents' parts: structure trees, content of tagged nodes, contrast of spans, header matching, reports, image references, sheets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docmeter.operators import images, matching, sheets, spans, tree
from docmeter.plans.derived import table
from docmeter.plans.queries import query
from docmeter.scratch import dealt
from docmeter.sources import reports

# Structure trees: a user's events are a document's nodes; most stand under one of the three before, some are cut off, some parent references are missing or point ahead

_TREE = """t as (select user_id doc_id, row_number() over (partition by user_id order by event_id) - 1 node_id, event_id, event_id * 7919 % 101 h from events),
n as (select doc_id, node_id, event_id, h, case when node_id = 0 then null when h = 3 then -1 else greatest(0, node_id - 1 - h % 3) end under_id,
 case when node_id = 0 or h % 19 = 5 then null when h % 23 = 7 then node_id + 1 when h = 3 then -1 else greatest(0, node_id - 1 - h % 3) end parent_id from t),
entries as (select doc_id, node_id + case when h = 50 then 100000 else 0 end node_id from t where event_id % 2 = 0),
reach as (select doc_id, node_id from n where under_id is null union all select n.doc_id, n.node_id from n join reach r on n.doc_id = r.doc_id and n.under_id = r.node_id),
w as (select n.* from n join reach using (doc_id, node_id)),
ahead as (select doc_id, node_id start, parent_id cur from w where parent_id is not null union select a.doc_id, a.start, w.parent_id from ahead a join w on w.doc_id = a.doc_id and w.node_id = a.cur where w.parent_id is not null),
findings as (select doc_id, 'missing-parent' rule, node_id from w where under_id is not null and parent_id is null
 union all select doc_id, 'unreachable-parent', node_id from w where under_id is not null and parent_id is not null and not exists (select 1 from reach r where r.doc_id = w.doc_id and r.node_id = w.parent_id)
 union all select distinct doc_id, 'parent-cycle', start from ahead where start = cur
 union all select doc_id, 'orphan-entry', node_id from entries e where not exists (select 1 from reach r where r.doc_id = e.doc_id and r.node_id = e.node_id))"""


def _tree(spark, sf):
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    t = table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), at.cast("long").alias("node_id"), "event_id", (F.col("event_id") * 7919 % 101).alias("h"))
    h, k = F.col("h"), F.col("node_id")
    under = F.when(k == 0, None).when(h == 3, -1).otherwise(F.greatest(F.lit(0), k - 1 - h % 3)).cast("long")
    parent = F.when((k == 0) | (h % 19 == 5), None).when(h % 23 == 7, k + 1).otherwise(under).cast("long")
    entries = t.where("event_id % 2 = 0").select("doc_id", (k + F.when(h == 50, 100000).otherwise(0)).alias("node_id"))
    return t.select("doc_id", "node_id", under.alias("under_id"), parent.alias("parent_id")), entries


@query(f"with recursive {_TREE} select * from findings")
def tree_integrity(spark, sf):
    return tree.tree_integrity(*_tree(spark, sf))


@query(f"""with recursive {_TREE}, c as (select doc_id, count(*) filter (where rule = 'missing-parent') missing_parent, count(*) filter (where rule = 'unreachable-parent') unreachable_parent,
count(*) filter (where rule = 'parent-cycle') parent_cycle, count(*) filter (where rule = 'orphan-entry') orphan_entry from findings group by 1)
select doc_id, case when c.doc_id is null then 'Passed' else 'Failed' end status, coalesce(missing_parent, 0) missing_parent, coalesce(unreachable_parent, 0) unreachable_parent, coalesce(parent_cycle, 0) parent_cycle, coalesce(orphan_entry, 0) orphan_entry
from (select distinct doc_id from n) d left join c using (doc_id)""")
def tree_integrity_by_document(spark, sf):
    nodes, entries = _tree(spark, sf)
    return tree.integrity_result(nodes, tree.tree_integrity(nodes, entries))


# Content of tagged nodes

_TAGS = ["Figure", "Formula", "Form", "Div", "Custom", "Bar Chart", "Body Text", "Table", "P", "Link", "Sect", "Normal Paragraph", "Image2"]
_LISTED = "[" + ", ".join(f"'{t}'" for t in _TAGS) + "]"
_CONTENT = f"""b as (select l_orderkey doc_id, cast(l_linenumber as int) seq, min(l_partkey) p, min(l_suppkey) s from lineitem group by 1, 2),
nodes as (select doc_id, seq, {_LISTED}[cast(p % {len(_TAGS)} as int) + 1] tag, case when p % 3 = 0 then 'Chart of sales in spring' when p % 3 = 1 then 'image' end alt_text, s % 3 children, cast(s % 4 + 1 as int) depth, case when p % 5 = 0 then 'totals' end summary from b),
contents as (select doc_id, seq, 'mcid' kind, case when p % 11 <> 0 then seq end page, p % 50 mcid from b where s % 4 in (1, 3) union all select doc_id, seq, 'annotation', null, null from b where s % 4 in (2, 3) and p % 2 = 0
 union all select doc_id, seq, 'object', null, null from b where s % 20 = 2),
rendered as (select doc_id, seq page, p % 50 mcid, case when p % 4 = 1 then 'said' when p % 4 = 2 then '  ' end as text, p % 7 = 0 image from b),
pages as (select doc_id, 1 + doc_id % 60 pages from b group by doc_id)"""


def _content(spark, sf):
    b = dealt(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("seq"), "l_partkey", "l_suppkey"), "doc_id")
    b = b.groupBy("doc_id", "seq").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    p, s = F.col("p"), F.col("s")
    alt = F.when(p % 3 == 0, "Chart of sales in spring").when(p % 3 == 1, "image")
    nodes = b.select("doc_id", "seq", F.get(F.array(*map(F.lit, _TAGS)), (p % len(_TAGS)).cast("int")).alias("tag"), alt.alias("alt_text"), (s % 3).alias("children"), (s % 4 + 1).cast("int").alias("depth"), F.when(p % 5 == 0, "totals").alias("summary"))
    own = lambda kind, when, page=None, mcid=None: b.where(when).select("doc_id", "seq", F.lit(kind).alias("kind"), F.lit(None).cast("int").alias("page") if page is None else page.alias("page"), F.lit(None).cast("long").alias("mcid") if mcid is None else mcid.alias("mcid"))
    contents = own("mcid", (s % 4).isin(1, 3), F.when(p % 11 != 0, F.col("seq")), p % 50).unionByName(own("annotation", (s % 4).isin(2, 3) & (p % 2 == 0))).unionByName(own("object", s % 20 == 2))
    rendered = b.select("doc_id", F.col("seq").alias("page"), (p % 50).alias("mcid"), F.when(p % 4 == 1, "said").when(p % 4 == 2, "  ").alias("text"), (p % 7 == 0).alias("image"))
    return nodes, contents, rendered, b.select("doc_id", (F.col("doc_id") % 60 + 1).alias("pages")).distinct()


@query(f"""with {_CONTENT}, r as (select doc_id, page, mcid, max(trim(coalesce(text, '')) <> '') t, max(image) i from rendered group by all),
f as (select n.*, count(c.kind) > 0 own, coalesce(max(c.kind = 'annotation'), false) ann, coalesce(max(c.kind = 'mcid'), false) mcids, coalesce(max(c.kind = 'mcid' and c.page is not null), false) paged, coalesce(max(t), false) t, coalesce(max(t or i), false) shown, any_value(g.pages) pages
 from nodes n left join contents c using (doc_id, seq) left join r on r.doc_id = n.doc_id and r.page = c.page and r.mcid = c.mcid left join pages g on g.doc_id = n.doc_id group by all),
k as (select *, own or (tag in ('Table', 'Formula') and children > 0) tied, ann or not mcids or not paged or pages > 50 or shown ok, tag in ('P', 'Link', 'Table', 'Div', 'Sect', 'Body Text', 'Normal Paragraph') textual from f)
select doc_id, seq, 'alt-associated' rule_id, case when not tied then 'no content' else 'nothing rendered' end problem from k where alt_text is not null and (not tied or not ok)
union all select doc_id, seq, 'alt-hides-annotation', 'annotation' from k where alt_text is not null and tag not in ('Link', 'Reference', 'Annot', 'Form') and ann
union all select doc_id, seq, 'alt-elements', case when alt_text is null then 'missing' else 'placeholder' end from k where own and not textual and not t and coalesce(alt_text, 'image') = 'image'
union all select doc_id, seq, 'alt-redundant', 'children are tagged' from k where alt_text is not null and tag not in ('Figure', 'Table', 'Form', 'Formula', 'Link') and children > 0 and not own""")
def alternatives_and_content(spark, sf):
    return tree.alt_content_findings(*_content(spark, sf))


@query(f"""with {_CONTENT}, m as (select c.doc_id, c.seq from contents c where kind = 'mcid' and exists (select 1 from rendered r where r.doc_id = c.doc_id and r.page = c.page and r.mcid = c.mcid and image)),
f as (select doc_id, seq, coalesce((select min(x.seq) from nodes x where x.doc_id = n.doc_id and x.seq > n.seq and x.depth <= n.depth), 1000) stop from nodes n where tag = 'Figure')
select f.doc_id, f.seq, count(m.seq) images from f left join m on m.doc_id = f.doc_id and m.seq >= f.seq and m.seq < f.stop group by 1, 2""")
def figures_with_images(spark, sf):
    nodes, contents, rendered, _ = _content(spark, sf)
    return tree.figures_with_images(nodes, contents, rendered)


@query(f"with {_CONTENT} select doc_id, count(*) tables, count(*) filter (where alt_text is null and summary is null) bare from nodes where tag = 'Table' group by 1")
def tables_without_summary(spark, sf):
    return tree.tables_without_summary(_content(spark, sf)[0])


@query("""with f as (select l_orderkey doc_id, case when l_linenumber % 2 = 0 then 'form' else 'widget' end origin, case l_partkey % 4 when 0 then null when 1 then '' else concat('field', l_partkey % 4) end as name, case when l_suppkey % 3 = 0 then ' ' when l_suppkey % 3 = 1 then 'Name' end d from lineitem)
select distinct doc_id, coalesce(name, 'unnamed') as name from f where trim(coalesce(d, '')) = '' and (origin = 'form' or coalesce(name, '') <> '')""")
def form_fields_undescribed(spark, sf):
    p, s = F.col("l_partkey") % 4, F.col("l_suppkey") % 3
    name = F.when(p == 0, None).when(p == 1, "").otherwise(F.concat(F.lit("field"), p.cast("string")))
    origin = F.when(F.col("l_linenumber") % 2 == 0, "form").otherwise("widget")
    return tree.undescribed_fields(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), origin.alias("origin"), name.alias("name"), F.when(s == 0, " ").when(s == 1, "Name").alias("description")))


# Contrast of spans

_SPANS = """l as (select l_suppkey doc_id, l_linenumber page, l_orderkey k, min(l_partkey) p, min(l_quantity) q, max(l_returnflag) f from lineitem group by 1, 2, 3),
spans as (select doc_id, page, k span, p % 560 x0, k % 760 y0, p % 560 + 4 + q x1, k % 760 + 8 + p % 5 y1, p * 31 % 256 r, k * 17 % 256 g, case when p % 3 = 0 then 250 else p * 13 % 256 end b, 5.0 + p % 12 size, case when p % 50 = 0 then ' ' else 'x' end as text from l),
rects as (select doc_id, page, k paint, k % 500 x0, p % 700 y0, k % 500 + 10 + p % 300 x1, p % 700 + k % 200 y1, k * 7 % 256 r, p * 5 % 256 g, p * 11 % 256 b from l where f = 'R' and k % 200 > 0),
under as (select s.doc_id, s.page, s.span, arg_max({'r': r.r, 'g': r.g, 'b': r.b}, r.paint) c from spans s join rects r on r.doc_id = s.doc_id and r.page = s.page and (s.x0 + s.x1) / 2 between r.x0 and r.x1 and (s.y0 + s.y1) / 2 between r.y0 and r.y1 group by 1, 2, 3)"""


def _lum(r: str, g: str, b: str) -> str:
    part = lambda w, c: f"{w} * case when {c} / 255.0 <= 0.04045 then {c} / 255.0 / 12.92 else pow(({c} / 255.0 + 0.055) / 1.055, 2.4) end"
    return "(" + " + ".join(part(w, c) for w, c in ((0.2126, r), (0.7152, g), (0.0722, b))) + ")"


def _spans(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_orderkey").alias("k")).agg(F.min("l_partkey").alias("p"), F.min("l_quantity").alias("q"), F.max("l_returnflag").alias("f"))
    p, k = F.col("p"), F.col("k")
    named = lambda **c: [v.alias(n) for n, v in c.items()]
    texts = rows.select("doc_id", "page", *named(span=k, x0=p % 560, y0=k % 760, x1=p % 560 + 4 + F.col("q"), y1=k % 760 + 8 + p % 5, r=p * 31 % 256, g=k * 17 % 256, b=F.when(p % 3 == 0, 250).otherwise(p * 13 % 256), size=5.0 + p % 12, text=F.when(p % 50 == 0, " ").otherwise("x")))
    boxes = rows.where("f = 'R'").select("doc_id", "page", *named(paint=k, x0=k % 500, y0=p % 700, x1=k % 500 + 10 + p % 300, y1=p % 700 + k % 200, r=k * 7 % 256, g=p * 5 % 256, b=p * 11 % 256))
    return texts, boxes


@query(f"""with {_SPANS}, x as (select s.*, c, case when c is null then 1.0 else {_lum('c.r', 'c.g', 'c.b')} end bg, {_lum('s.r', 's.g', 's.b')} fg from spans s left join under u using (doc_id, page, span) where text <> ' '),
f as (select doc_id, page, not (c is null and least(r, g, b) >= 245 and (x1 - x0 <= 12 or y1 - y0 <= 16)) and not (greatest(r, g, b) <= 32 and bg < 0.4) and size > 6 and (greatest(fg, bg) + 0.05) / (least(fg, bg) + 0.05) < 3.0 fails from x)
select doc_id, page, count(*) spans, count(*) filter (where fails) failing, case when count(*) filter (where fails) > greatest(1, count(*) // 100) then 'Failed' else 'Passed' end status from f group by 1, 2""")
def span_contrast(spark, sf):
    texts, boxes = _spans(spark, sf)
    return spans.page_contrast(spans.failing_spans(spans.backgrounds(texts, boxes)))


@query(f"with {_SPANS} select doc_id, page, span, c.r bg_r, c.g bg_g, c.b bg_b from spans left join under using (doc_id, page, span)")
def span_backgrounds(spark, sf):
    return spans.backgrounds(*_spans(spark, sf)).select("doc_id", "page", "span", "bg_r", "bg_g", "bg_b")


# Header matching: no SQL function gives the ratio of matching blocks


def _headers(spark, sf):
    part = table(spark, sf, "part")
    asked = part.select(F.col("p_size").alias("table_id"), F.concat_ws(" ", "p_name", "p_brand").alias("header"))
    offered = part.select(F.col("p_size").alias("table_id"), F.col("p_partkey").alias("idx"), F.concat_ws("-", "p_type", "p_name").alias("header"), F.when(F.col("p_partkey") % 2 == 0, "col").otherwise("row").alias("scope"))
    return asked, offered


@query()
def fuzzy_headers(spark, sf):
    return matching.match_headers(*_headers(spark, sf))


@query()
def fuzzy_header_pruning(spark, sf):
    return matching.pairs_pruned(*_headers(spark, sf))


# Reports: an order is a report, its lines are rules, assertions or checks; every fiftieth is cut off

_REPORTS = """l as (select l_orderkey k, cast(l_linenumber as int) n, min(l_partkey) p, min(l_suppkey) s from lineitem group by 1, 2),
good as (select *, concat('r', k) file from l where k % 50 <> 0)"""


def _reports(spark, sf):
    rows = dealt(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("int").alias("n"), "l_partkey", "l_suppkey"), "k")
    lines = rows.groupBy("k", "n").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    p, s, n = F.col("p"), F.col("s"), F.col("n").cast("string")
    said = F.concat(F.lit("Part "), p.cast("string"), F.when(p % 9 == 0, " has a .notdef glyph").otherwise(" & more"))
    rule = F.format_string('<v:rule specification="ISO 14289-1:2014" clause="7.%s" testNumber="%s" status="%s"><v:description>%s</v:description><v:location>root/%s</v:location></v:rule>', p % 30, n, F.when(s % 2 == 0, "Failed").otherwise("passed"), F.replace(said, F.lit("&"), F.lit("&amp;")), n)
    named = lambda **c: F.struct(*[v.alias(x.replace("__", ":")) for x, v in c.items()])
    test = named(dct__title=F.concat(F.lit("rule-"), (p % 40).cast("string")), earl__impact=F.when(s % 3 > 0, "serious"), help=F.struct(F.lit("how").alias("dct:title")))
    sub = named(earl__result=named(earl__outcome=F.when(s % 2 == 0, "earl:failed").otherwise("earl:passed"), dct__description=said, earl__pointer=F.struct(F.array(n, F.lit("b")).alias("cfi"))), earl__test=test)
    assertion = F.to_json(named(earl__testSubject=F.struct(n.alias("url")), assertions=F.array(sub)))
    check = F.to_json(F.struct(F.concat(F.lit("check-"), (p % 20).cast("string")).alias("Rule"), F.when(s % 2 == 0, " Failed ").otherwise("Passed").alias("Status"), said.alias("Description")))
    of_kind = lambda xml, assertions, checks: F.when(F.col("k") % 3 == 0, xml).when(F.col("k") % 3 == 1, assertions).otherwise(checks)
    rows = lines.groupBy("k").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", of_kind(rule, assertion, check).alias("t")))), lambda x: x["t"]).alias("parts"))
    kind = F.get(F.array(F.lit("verapdf"), F.lit("ace"), F.lit("adobe")), (F.col("k") % 3).cast("int"))
    listed = F.array_join("parts", ",")
    text = of_kind(
        F.concat(F.lit('<?xml version="1.0"?><report xmlns:v="x"><v:details>'), F.array_join("parts", ""), F.lit("</v:details></report>")),
        F.concat(F.lit('{"assertions":['), listed, F.lit("]}")), F.concat(F.lit('{"Summary":{"Failed":1},"Detailed Report":{"Forms":['), listed, F.lit("]}}")),
    )
    cut = F.when(F.col("k") % 50 == 0, F.substring(text, 1, 40)).otherwise(text)
    return rows.select(F.concat(F.lit("r"), F.col("k").cast("string")).alias("file"), kind.alias("kind"), cut.alias("text"))


@query(f"""with {_REPORTS}, a as (select *, concat('Part ', p, case when p % 9 = 0 then ' has a .notdef glyph' else ' & more' end) said, p % 9 = 0 limited from good),
v as (select *, concat('ISO 14289-1:2014-7.', p % 30, '-', n) rule from a where k % 3 = 0 and s % 2 = 0)
select file, 'verapdf' tool, '' category, rule id, 'Failed' status, 'serious' impact, said description, concat('PDF/UA-1 compliance failure: ', rule) help, concat('root/', n) location, limited or rule in ('ISO 14289-1:2014-7.21.4.1-1', 'ISO 14289-1:2014-7.21.7-1', 'ISO 14289-1:2014-7.21.7-2') font_limited from v
union all select file, 'ace', '', concat('rule-', p % 40), 'Failed', case when s % 3 > 0 then 'serious' else 'moderate' end, said, 'how', concat(n, ' ', n), false from a where k % 3 = 1 and s % 2 = 0
union all select file, 'adobe', 'Forms', concat('check-', p % 20), case when s % 2 = 0 then 'Failed' else 'Passed' end, '', said, '', '', false from a where k % 3 = 2""")
def report_findings(spark, sf):
    return reports.findings(_reports(spark, sf))


@query("select distinct concat('r', l_orderkey) file, case l_orderkey % 3 when 0 then 'verapdf' when 1 then 'ace' else 'adobe' end kind, case l_orderkey % 3 when 0 then 'no XML' else 'no JSON object' end reason from lineitem where l_orderkey % 50 = 0")
def report_rejects(spark, sf):
    return reports.rejects(_reports(spark, sf))


# Image references: an order is a document, its lines are markers, references and words; a fold over sections has no SQL


def _recognised(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("n")).agg(F.min("l_partkey").alias("p"))
    p, n = F.col("p"), F.col("n").cast("string")
    piece = F.when(p % 4 == 0, F.concat(F.lit("<!-- Page "), (p % 3).cast("string"), F.lit(" -->"))).when(p % 4 == 1, F.concat(F.lit("![alt "), n, F.lit("](img"), n, F.lit(".png)"))).when(p % 4 == 2, F.concat(F.lit("![]( https://x/"), n, F.lit(")"))).otherwise(F.lit("words \n"))
    texts = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", piece.alias("t")))), lambda x: x["t"]), " ").alias("text"))
    found = lines.where((p % 5 < 2) & (F.col("doc_id") % 7 > 0)).select("doc_id", (p % 3).alias("page"), F.col("n").alias("idx"), F.concat(F.lit("img"), n, F.lit(".png")).alias("filename"))
    return texts, found


@query()
def image_references(spark, sf):
    return images.repaired_references(*_recognised(spark, sf))


# Sheets

_CELLS = """c as (select l_suppkey book, l_linenumber sheet, l_orderkey "row", case when l_partkey % 6 = 0 then null when l_partkey % 6 = 1 then ' ' else concat('Term', l_partkey % 40, ' ', l_returnflag, 'alue and term', l_partkey % 13, ' the ', l_linestatus) end "value" from lineitem),
f as (select * from c where trim(coalesce("value", '')) <> ''), n as (select book, sheet, "row", count(*) n from f group by all), b as (select *, coalesce(sum(n) over (partition by book, sheet order by "row" rows between unbounded preceding and 1 preceding), 0) before from n),
r as (select * from b where before < 60), w as (select f.book, f.sheet, unnest(list_filter(list_distinct(regexp_extract_all(lower("value"), '[a-z][a-z0-9]{2,}')), lambda x: x not in ('and', 'data', 'details', 'info', 'information', 'sheet', 'table', 'the', 'workbook'))) term from f join r using (book, sheet, "row")),
t as (select book, sheet, term, row_number() over (partition by book, sheet order by count(*) desc, term) k from w group by 1, 2, 3), g as (select book, sheet, list(term order by k) terms from t where k <= 8 group by 1, 2),
s as (select book, sheet, sum(n)::bigint cells, coalesce(terms, []) terms from r left join g using (book, sheet) group by book, sheet, terms)"""


def _terms(spark, sf):
    p = F.col("l_partkey")
    value = F.when(p % 6 == 0, None).when(p % 6 == 1, " ").otherwise(F.concat(F.lit("Term"), (p % 40).cast("string"), F.lit(" "), "l_returnflag", F.lit("alue and term"), (p % 13).cast("string"), F.lit(" the "), "l_linestatus"))
    return sheets.content_terms(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("book"), F.col("l_linenumber").alias("sheet"), F.col("l_orderkey").alias("row"), value.alias("value")))


@query(f"with {_CELLS} select book, sheet, cells, array_to_string(terms, ',') terms from s")
def sheet_content_terms(spark, sf):
    return _terms(spark, sf).withColumn("terms", F.array_join("terms", ","))


@query(f"""with {_CELLS}, m as (select *, case (book + sheet) % 6 when 0 then 'Sheet12' when 1 then ' abc' when 2 then concat('Term', book % 40, ' by year') when 3 then 'Summary of Term' when 4 then 'Overview valuess' else 'Notes' end as name, case when book % 9 = 0 then 'hidden' else 'visible' end state from s),
k as (select *, list_filter(list_distinct(regexp_extract_all(lower(name), '[a-z][a-z0-9]{{2,}}')), lambda x: x not in ('and', 'data', 'details', 'info', 'information', 'sheet', 'table', 'the', 'workbook')) own, length(trim(name)) >= 4 and not regexp_full_match(lower(trim(name)), 'sheet[0-9]+') good from m),
i as (select *, list_filter([case when not good then 'non_descriptive_sheet_name' end, case when state <> 'visible' then 'data_sheet_hidden' end, case when good and len(terms) > 0 and not list_has_any(own, terms) then 'sheet_name_purpose_unclear' end,
 case when sheet > 1 and list_has_any(own, ['contents', 'dashboard', 'index', 'overview', 'summary']) then 'overview_sheet_not_first' end], lambda x: x is not null) issues from k)
select book, sheet, array_to_string(issues, ',') issues, case when len(issues) = 0 then 1.0 else list_min(list_transform(issues, lambda x: case x when 'non_descriptive_sheet_name' then 0.0 when 'data_sheet_hidden' then 0.75 else 0.5 end)) end::double score from i""")
def sheet_navigation(spark, sf):
    at = (F.col("book") + F.col("sheet")) % 6
    name = F.when(at == 0, "Sheet12").when(at == 1, " abc").when(at == 2, F.concat(F.lit("Term"), (F.col("book") % 40).cast("string"), F.lit(" by year"))).when(at == 3, "Summary of Term").when(at == 4, "Overview valuess").otherwise("Notes")
    rows = _terms(spark, sf).withColumns({"name": name, "place": F.col("sheet"), "state": F.when(F.col("book") % 9 == 0, "hidden").otherwise("visible")})
    return sheets.sheet_issues(rows).select("book", "sheet", F.array_join("issues", ",").alias("issues"), "score")
