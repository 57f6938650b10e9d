from __future__ import annotations

import re
from itertools import permutations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    fails = []
    for i, text, source in docs:
        x = text or ""
        words = WORD.findall(x)
        own = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in x) > 5 * len(x),
            "D": any(c in "#$%&*|" for c in x),
            "E": i is not None and any(j is not None and j < i and (t or "") == x for j, t, _ in docs),
        }
        label = [(q, t) for j, q, t in labels if j is not None and j == i]
        fails.append((source or "", own, any(q == 1 for q, _ in label), any(t == 1 for _, t in label)))
    out = []
    for part in {f[0] for f in fails}:
        rows = [f for f in fails if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = rows
            for k, name in enumerate(order):
                removed = [r for r in left if r[1][name]]
                left = [r for r in left if not r[1][name]]
                gone_before = sum(r[1][name] and any(r[1][x] for x in order[:k]) for r in rows)
                alone = sum(r[1][name] and sum(r[1].values()) == 1 for r in rows)
                shapley[name] += len(removed)
                steps.append([part, "".join(order), k + 1, len(left), len(removed), gone_before, alone, sum(r[2] for r in removed), sum(r[3] for r in removed), name])
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return set(out)


def run(spark, tmp, docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("part", F.lit(3)).withColumn("first", F.lit("x")).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    got = filter_audit.op11_filter_audit(spark, str(tmp))
    assert dict(got.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) == 600 * len({s or "" for _, _, s in docs})
    return set(rows)


def test_counts_are_those_of_a_fold(spark, tmp_path):
    prose = " ".join(f"word{i}" for i in range(60))
    docs = [
        (1, prose, "a"), (2, prose, "b"), (2, prose, "b"), (3, prose, "a"), (None, prose, "a"), (None, None, None), (4, None, None), (5, "", ""), (6, " \t\n", "a"),
        (7, "WORD " * 200, "a"), (8, "x " * 60 + "#", "b"), (9, prose.upper() + " &", None), (10, "é" * 30_000 + " A", "b"), (11, prose + " $", "a"), (12, prose, "c"),
        *[(100 + i, "copy", "a") for i in range(40)],
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (None, 1, 1), (7, 0, 1), (100, 1, None), (101, 1, 0), (999, 1, 1)]
    assert run(spark, tmp_path, docs, labels) == brute(docs, labels)


def test_an_empty_table_has_no_part(spark, tmp_path):
    assert run(spark, tmp_path, [], []) == set()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6) | st.none(), st.sampled_from([None, "", "a b", "A#", "a " * 50, "w" * 9 + " b" * 60]), st.sampled_from(["s", "t", "", None])), min_size=1, max_size=25))
def test_any_rows(spark, tmp_path_factory, docs):
    labels = [(i, i % 2, i % 3 - 1) for i in range(5)]
    assert run(spark, tmp_path_factory.mktemp("audit"), docs, labels) == brute(docs, labels)


def test_other_filters_and_orders(spark):
    rows = spark.createDataFrame([(k, k % 2 == 0, None if k == 3 else k % 3 == 0) for k in range(12)], "k int, even boolean, third boolean")
    counted = filter_audit.cells(rows, {"even": F.col("even"), "third": F.col("third")}, F.lit(None), {})
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in filter_audit.audit(counted, ["even", "third"], []).collect()}
    assert got == {("eventhird", 1): (6, 6, 0, 4, 10), ("eventhird", 2): (5, 1, 2, 1, 4), ("thirdeven", 1): (9, 3, 0, 1, 4), ("thirdeven", 2): (5, 4, 2, 4, 10)}
