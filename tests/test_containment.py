from __future__ import annotations

import re

from docmeter.plans.queries import QUERIES


def test_every_document_meets_every_item(spark, tmp_path):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(10))) for i in (0, 7, 150)] + [(151, "?!"), (152, "the the of")]
    docs = [(1, "the " + items[2][1]), (2, items[0][1] + " " + items[1][1].upper()), (3, "w7x0 w7x1 w7x2 w7x3 w7x4 w7x5 w7x6"), (3, "w7x7 w7x8 w7x9"), (4, "of, the w0x1 " * 3), (5, None), (6, items[2][1][:-5]), (None, items[0][1])]
    for name, rows in (("benchmark", items), ("documents", docs)):
        spark.createDataFrame(rows, f"{name[:1]} long, text string").toDF({"benchmark": "item_id", "documents": "doc_id"}[name], "text").write.parquet(f"{tmp_path}/{name}.parquet")
    want = set()
    for d, t in docs:
        for i, x in items:
            a, b = (set(re.findall("[a-z0-9]+", (v or "").lower())) for v in (x, t))
            if a and len(a & b) >= 0.8 * len(a):
                want.add((d, i, round(len(a & b) / len(a), 6)))
    got = [tuple(r) for r in QUERIES["token_containment"](spark, str(tmp_path)).collect()]
    assert set(got) == want and len(got) == len(want) == 6
