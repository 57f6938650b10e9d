from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from zlib import crc32

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.llm import oracles, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def brute(rows: list[tuple]) -> set[tuple]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}"), role, text))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        base, h = c - (c % 20 if c >= 0 else -(-c % 20)), crc32(str(c).encode()) % 4
        turns = (own.get(base, [])[:h]) + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for x in members:
        if x:
            kids[x[:-1]].append(x)
    leaves, saved = {}, {}
    for x in sorted(members, key=len, reverse=True):
        leaves[x] = sum(leaves[k] for k in kids[x]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        saved[x] = sum(saved[k] for k in kids[x]) + (len(members[x]) - 1) * words
    return {(min(m), len(x), min(members[x[:-1]]) if x else None, len(m), len(kids[x]), leaves[x], saved[x], sha(",".join(map(str, ends[x])))) for x, m in members.items()}


def run(spark, rows: list[tuple], group_turns: int = prefix_trie.GROUP_TURNS) -> set[tuple]:
    df = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("x")).withColumn("pos", F.lit(1))
    out = [tuple(r) for r in prefix_trie.prefix_trie(*prefix_trie.rebuilt(df), group_turns).select(*COLUMNS).collect()]
    assert len(out) == len(set(out))
    return set(out)


ROWS = [
    *[(c, t, "user" if t % 2 else "assistant", f"turn {t} {c % 3 if t > 1 else ''}") for c in range(40) for t in range(c % 7 + 1)],
    (None, 0, "user", "no id"), (45, None, None, None), (45, 3, "user", "a  b\tc"), (45, 3, "user", "a  b\tc"), (45, 3, "assistant", "a  b\tc"), (-5, 0, "user", "x"), (-25, 0, "user", "y z"), (-20, 0, "user", "w w"),
    (60, 0, "user", "word " * 100_000), *[(100 + k, t, "user", "same three") for k in range(30) for t in range(3)],
]


@pytest.mark.parametrize("group_turns", [1, 5, 40, 10_000])
def test_nodes_are_those_of_brute_force(spark, group_turns):
    assert run(spark, ROWS, group_turns) == brute(ROWS)


def test_query_equals_sql(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    got = {tuple(r) for r in prefix_trie.op13_prefix_trie(spark, str(tmp_path)).select(*COLUMNS).collect()}
    assert got == brute(ROWS) == set(con.sql(f"select {', '.join(COLUMNS)} from ({oracles.TRIE})").fetchall())


def test_long_shared_beginnings_take_two_rounds(spark, monkeypatch):
    """Twelve conversations that share 1,500 turns, and one of 2,500: cut where they part, not turn by turn."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    turns = [(c * 20, t, "user", f"t{t}" if t < 1500 else f"c{c % 4} {t}") for c in range(12) for t in range(1500 + c % 4)] + [(2000, t, "user", f"t{t}") for t in range(2500)]
    cuts: list[int] = []
    write = prefix_trie.written

    def counted(df, name):
        cuts.append(name == "cut")
        return write(df, name)

    monkeypatch.setattr(prefix_trie, "written", counted)
    df = spark.createDataFrame(pd.DataFrame(turns, columns=["conv_id", "turn", "role", "text"]), SCHEMA)
    got = prefix_trie.prefix_trie(*prefix_trie.rebuilt(df), 500).select(*COLUMNS).toPandas()
    assert sum(cuts) == 3  # the root, the shared 1,500, the single rest of 1,000 that is more than a task takes
    want = pd.DataFrame(sorted(brute(turns), key=repr), columns=COLUMNS)
    key = lambda d: sorted(d.astype({"parent_conv_id": "float64"}).fillna(-1).itertuples(index=False, name=None))
    assert key(got) == key(want)


def test_empty_table(spark):
    assert run(spark, []) == set()
    assert run(spark, [(None, 0, "user", "x")]) == set()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-21, 25), st.integers(0, 3) | st.none(), st.sampled_from(["user", None]), st.sampled_from(["a", "b c", None])), min_size=1, max_size=60), st.sampled_from([1, 3, 8, 1000]))
def test_any_rows(spark, rows, group_turns):
    assert run(spark, rows, group_turns) == brute(rows)
