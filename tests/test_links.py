from __future__ import annotations

from docmeter.plans.queries import QUERIES

PAGE = """<p><A HREF="/a">Annual report</A> <a class=x href=/b>read more</a> <a title="t" href='/c?x=1&amp;y=2'>Opening  hours</a> <a href="/d"><b>click</b> <i>here</i></a>
<a name=top>anchor</a> <a href="/e"><img src=e.png alt="Town map"></a> <a href="/f" aria-label="Contact form"><svg></svg></a> <a href="/g"></a> <!-- <a href="/no">no</a> --> <a
href="/h">Left open <a href="/i">Minutes of May</a></p>"""


def test_links_in_any_markup(spark, tmp_path):
    spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, "u", "<p>none</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r.page_id, r.link_index, r.text, r.descriptive) for r in QUERIES["link_text_findings"](spark, str(tmp_path)).orderBy("page_id", "link_index").collect()]
    texts = ["Annual report", "read more", "Opening hours", "click here", "Town map", "Contact form", "", "Left open", "Minutes of May"]
    poor = {"read more", "click here", ""}
    assert got == [(1, i, t, t not in poor) for i, t in enumerate(texts)]
