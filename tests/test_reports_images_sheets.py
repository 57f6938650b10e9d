from __future__ import annotations

import re
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docmeter.operators import images, sheets
from docmeter.sources import reports

IMAGE, MARKER = re.compile(r"!\[([^\]]*)\]\(([^)]+)\)"), re.compile(r"<!--\s*Page\s+(\d+)\s*-->")


def fold(text: str, found: list[tuple[int, int, str]]) -> str:
    """Section after section, reference after reference. found: page, idx, filename."""
    if not found:
        return text
    known, used, page, out = {f for _, _, f in found}, set(), 1, ""
    for k, part in enumerate(MARKER.split(text)):
        if k % 2:
            page = int(part)
            out += f"<!-- Page {page} -->"
            continue
        own = [f for p, _, f in sorted(found) if p == page]
        waiting = iter(own)

        def put(m: re.Match, waiting=waiting) -> str:
            name = m[2] if m[2] in known else next(waiting, None)
            if name:
                used.add(name)
            return m[0] if m[2] in known else f"![{m[1]}]({name or 'MISSING_IMAGE'})"

        part = IMAGE.sub(put, part)
        left = [f for f in own if f not in used]
        if left and part.strip():
            part = part.rstrip() + "\n" + "".join(f"\n![Image from page {page}]({f})\n" for f in left)
            used.update(left)
        out += part
    return out


PIECE = st.sampled_from(["<!-- Page 1 -->", "<!--Page 02-->", "<!-- Page 3 -->", "![a](f1)", "![](x.png)", "![b c](y)", "![d](f4)", "text", " ", "\n ", "![broken](", "$1 \\"])


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(PIECE, max_size=14).map("".join), st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["f1", "f2", "f3", "f4", "f5$"])), max_size=6, unique_by=lambda x: x[1])), min_size=1, max_size=6))
def test_references_are_repaired_as_by_a_fold(spark, docs):
    documents = spark.createDataFrame([(i, t, "kept") for i, (t, _) in enumerate(docs)], "doc_id int, text string, page string")
    rows = [(i, p, k, f) for i, (_, found) in enumerate(docs) for k, (p, f) in enumerate(found)]
    got = {r.doc_id: r.text for r in images.repaired_references(documents, spark.createDataFrame(rows, "doc_id int, page long, idx int, filename string")).collect()}
    assert got == {i: fold(t, [(p, k, f) for k, (p, f) in enumerate(found)]) for i, (t, found) in enumerate(docs)}


def test_a_long_run_of_blanks_is_linear(spark):
    text = "a" + " " * 1_000_000 + "b" + " " * 1_000_000
    got = images.repaired_references(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string"), spark.createDataFrame([(1, 1, 0, "f")], "doc_id int, page long, idx int, filename string")).orderBy("doc_id").collect()
    assert got[0].text == "a" + " " * 1_000_000 + "b\n\n![Image from page 1](f)\n" and got[1].text is None


def test_reports_of_three_kinds(spark):
    rows = [
        ("a.xml", "verapdf", '<?xml version="1.0"?><r><d><rule status="failed" clause="7.2" testNumber="1" description=" an Embedded font program "/><rule status="passed"/><rule status="failed"><status>passed</status></rule></d><rule status="FAILED"/></r>'),
        ("b.xml", "verapdf", "<r><rule><status> Failed</status><ruleId> X-1 </ruleId><location>here</location></rule></r>"),
        ("cut.xml", "verapdf", "<r><rule>"),
        ("e.json", "ace", '{"assertions":{"earl:testSubject":{"url":"c1"},"assertions":[{"earl:result":{"earl:outcome":"earl:FAILED","earl:pointer":{"cfi":"/4/2"}},"earl:test":{"dct:identifier":"i"}},{"earl:result":{"earl:outcome":"pass"}},{"earl:result":{"earl:outcome":"failed"}}, 7]}}'),
        ("none.json", "ace", "{}"),
        ("f.json", "adobe", '{"detailed report":{"Tables":[{"check":"rows","status":" Failed "},"x"],"Bad":3},"Old":{"title":{"Status":"Passed","description":"d"},"n":{"x":1}},"List":[{"category":"Own","Rule":"r","Details":["p","q"]}]}'),
        ("list.json", "adobe", "[1]"), ("null", "adobe", None), ("other", "pdf", "{}"), ("empty", "verapdf", " "),
    ]
    df = spark.createDataFrame(rows, "file string, kind string, text string")
    got = Counter((r.file, r.category, r.id, r.status, r.impact, r.description, r.location, r.font_limited) for r in reports.findings(df).collect())
    assert got == Counter([
        ("a.xml", "", "7.2-1", "Failed", "serious", "an Embedded font program", "", True), ("a.xml", "", "unknown-rule", "Failed", "serious", "PDF/UA-1 rule  failed", "", False), ("b.xml", "", "X-1", "Failed", "serious", "PDF/UA-1 rule X-1 failed", "here", False),
        ("e.json", "", "i", "Failed", "moderate", "", "c1 /4/2", False), ("e.json", "", "ace-unknown-rule", "Failed", "moderate", "", "c1", False),
        ("f.json", "Tables", "rows", "Failed", "", "", "", False), ("f.json", "Old", "title", "Passed", "", "d", "", False), ("f.json", "Own", "r", "", "", "", '["p","q"]', False),
    ])
    assert {(r.file, r.reason) for r in reports.rejects(df).collect()} == {("cut.xml", "no XML"), ("list.json", "no JSON object"), ("null", "no text"), ("other", "unknown kind"), ("empty", "no XML")}


def test_terms_stop_with_the_row_that_reaches_the_cells(spark):
    rows = [(1, "s", r, f"alpha{r} The alpha alpha" if c else None) for r in range(40) for c in (0, 1, 2)] + [(1, "t", 10**6 - r, "beta") for r in range(5000)] + [(1, "u", 1, "  "), (2, "s", 1, "a 1b ab")] + [(3, "w", 1, "gamma")] * 500 + [(3, "w", 2, "late")]
    got = {(r.book, r.sheet): (r.cells, r.terms) for r in sheets.content_terms(spark.createDataFrame(rows, "book int, sheet string, row int, value string")).collect()}
    read, seen = 0, defaultdict(int)
    for r in range(40):
        if read >= 60:
            break
        read += 2
        seen[f"alpha{r}"] += 2
        seen["alpha"] += 2
    assert got == {(1, "s"): (60, sorted(seen, key=lambda t: (-seen[t], t))[:8]), (1, "t"): (60, ["beta"]), (2, "s"): (1, []), (3, "w"): (500, ["gamma"])}


def test_sheet_issues(spark):
    rows = [("Sheet1", 1, "visible", ["x"]), ("abc", 2, "hidden", None), ("Costs 2024", 2, "visible", ["costs"]), ("Costs", 2, None, ["sales"]), ("Summary", 2, "visible", ["summary"]), ("Summary", 1, "visible", []), (None, 1, "visible", [])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, name string, place int, state string, terms array<string>")
    got = [(r.issues, r.score) for r in sheets.sheet_issues(df).orderBy("i").collect()]
    assert got == [
        (["non_descriptive_sheet_name"], 0.0), (["non_descriptive_sheet_name", "data_sheet_hidden"], 0.0), ([], 1.0), (["data_sheet_hidden", "sheet_name_purpose_unclear"], 0.5),
        (["overview_sheet_not_first"], 0.5), ([], 1.0), (["non_descriptive_sheet_name"], 0.0),
    ]


def test_reports_are_built_and_each_piece_is_parsed_once(spark, small):
    from docmeter.plans.registry import QUERIES

    plan = QUERIES["report_findings"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    assert sum("Relation [" in x for x in lines) == 1 and "Union" not in plan and "RepartitionByExpression" in plan
    assert not any("from_xml" in x or "from_json" in x for x in lines if "Filter" in x and "coalesce((kind" not in x and "verapdf,ace,adobe" not in x)
