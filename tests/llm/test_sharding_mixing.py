from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.llm import mixing, oracles, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, taken string"


def jump(key: int, shards: int) -> int:
    key, b, j = key % (1 << 64), -1, 0
    while j < shards:
        b = j
        key = (key * sharding.MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_is_the_published_function(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(50), *(k * 982_451_653 for k in range(50))]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", *[sharding.jump_shard(F.col("k"), n).alias(f"s{n}") for n in (1, 16, 17, 100)]).collect()
    for r in rows:
        assert [r.s1, r.s16, r.s17, r.s100] == [jump(r.k, n) for n in (1, 16, 17, 100)]
        assert r.s17 in (r.s16, 16)


def test_slots_are_gapless_with_repeats_and_nulls(spark):
    data = [(1, "a")] * 5 + [(None, None)] * 3 + [(i, "x" * i) for i in range(40)]
    docs = spark.createDataFrame([(i, t, None, None, None, 7, "old", "old") for i, t in data], DOCS)
    shards = sharding.assign_shards(docs, "doc_id", 4, 5)
    assert shards.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "grown_shard"]
    out = sharding.number_slots(shards.select("doc_id", F.col("text"), "shard"), ["doc_id", "text"], 1).collect()
    assert len(out) == len(data)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r.shard for r in out if r.doc_id is None} == {jump(0, 4)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert sharding.number_slots(sharding.assign_shards(docs, "doc_id", 3).select("doc_id", "shard"), ["doc_id"], 2).count() == 0
    assert mixing.mix(docs, mixing.word_count(), ["doc_id"]).count() == 0


def test_shards_match_sql(spark, small, compare):
    compare(sharding.op4_jump_shards(spark, small), oracles.JUMP)


def test_mix_matches_sql(spark, small, compare):
    compare(mixing.op7_mix_sources(spark, small), oracles.MIX)


def targets(sizes: list[int], weights=mixing.WEIGHTS, epochs: int = 3) -> list[float]:
    """Excess shared again and again."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        level = left / sum(w[i] for i in open_)
        full = {i for i in open_ if epochs * sizes[i] < w[i] * level - 1e-12}
        if not full:
            for i in open_:
                out[i] = w[i] * level
            break
        for i in full:
            out[i] = float(epochs * sizes[i])
            left -= out[i]
        open_ -= full
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=1, max_size=9))
def test_targets_by_refilling(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert all(abs(got[f"s{i}"] - x) < 1e-6 for i, x in enumerate(want))


def test_mix_is_exact_with_hot_repeated_and_null_rows(spark):
    rows = [(7, "one two three")] * 60 + [(i, "w " * (i % 9)) for i in range(200)] + [(None, None), (None, "")]
    data = [(i, t, None, None if k % 5 == 0 else f"s{k % 5}", None, None, "x", "y") for k, (i, t) in enumerate(rows)]
    out = mixing.mix(spark.createDataFrame(data, DOCS), mixing.word_count(), ["doc_id"]).collect()
    assert len(out) == len(data)
    total, taken, target = Counter(), Counter(), {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        total[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert set(total) == {None, "s1", "s2", "s3", "s4"}
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in total)
    assert abs(sum(target.values()) - sum(total.values())) < 1e-6


def test_taken_documents_cut_and_repeat(spark):
    data = [(1, "a b c", "s", 3, 7), (2, "d e", "s", 2, 2), (3, "f", "s", 1, 0), (4, " g  h\ti ", "s", 3, 2), (5, None, "s", 0, 0)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size long, taken long")
    got = sorted((r.doc_id, r.text) for r in mixing.taken_documents(df).collect())
    assert got == [(1, "a"), (1, "a b c"), (1, "a b c"), (2, "d e"), (4, "g h")]


def test_ranges_grow_in_number_with_the_rows():
    assert [sharding.hex_digits(n) for n in (0, 50_000 * 256, 50_000 * 256 + 1, 10**10)] == [2, 2, 3, 5]
