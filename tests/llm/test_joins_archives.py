from __future__ import annotations

import gzip
import hashlib
import heapq
from base64 import b32encode

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmeter.llm import embedding_join, jaccard_join, oracles, warc
from docmeter.llm import shingles as sets_of
from docmeter.llm.common import scratch_path
from docmeter.llm.components import connected_components


def closure(nodes: list, links: list[tuple]) -> dict:
    parent = {n: n for n in nodes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(i, (i * 7) % 50) for i in range(50)], [(5, 5), (9, 3), (3, 9)]])
@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, links, local):
    df = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    want = closure(sorted({x for p in links if p[0] != p[1] for x in p}), [p for p in links if p[0] != p[1]])
    assert {r.node: r.component for r in connected_components(df, local).collect()} == want


def vectors_by_brute_force(rows: list[tuple], cosine: float) -> dict:
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(k, np.array(v, float), label) for k, v, label in rows if usable(v, label)]
    links = []
    for i, (a, x, p) in enumerate(good):
        for b, y, q in good[:i]:
            if p == q and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                links.append((a, b))
    comp = closure([r[0] for r in rows], links)
    return {k: (sum(k in p for p in links), comp[k]) for k, *_ in rows}


def test_vectors_of_far_cells_never_meet(spark):
    """Chunks of a label's spread-out vectors: far fewer pairs are tested in a block than there are; all links are found."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + rng.normal(size=16) * 0.05).tolist(), 1, 1, 16) for i in range(3000)]
    reps = spark.createDataFrame(rows, "rep long, vector array<double>, label int, n long, dim int")
    found = embedding_join.vector_links(reps, 0.97, 100).collect()
    tested, pairs = sum(r.links for r in found if r.a is None), 3000 * 2999 // 2
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert sum(r.links for r in found if r.a is not None and r.b is None) == int((x @ x.T >= 0.97).sum()) - 3000
    assert tested < 0.35 * embedding_join.BLOCKS * pairs


@pytest.mark.parametrize("chunk", [5, 2000])
def test_vectors_by_brute_force(spark, chunk):
    rng = np.random.default_rng(chunk)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            centre = rng.normal(size=24)
            for _ in range(rng.integers(1, 9)):
                rows.append((k, [float(np.float32(x)) for x in centre + rng.normal(size=24) * rng.choice([0, 0.1, 0.27])], label))
                k += 1
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None, *[1.0] * 23], [float("inf")] * 24, [1.0, 2.0]]
    rows += [(k + i, v, 1) for i, v in enumerate(odd)] + [(k + 20, rows[0][1], None), (k + 21, [1.0, 2.0], 1), (k + 22, [-x for x in rows[0][1]], 0)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, n int").repartition(3)
    got = {r.id: (r.n_links, r.component_id) for r in embedding_join.link_vectors(df, chunk=chunk).collect()}
    assert got == vectors_by_brute_force(rows, embedding_join.COSINE)
    assert sum(n for n, _ in got.values()) > 50


def test_vectors_repeated_and_empty(spark):
    rows = [(1, [1.0, 0.0], 1)] * 3 + [(2, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted((r.id, r.n_links, r.component_id) for r in embedding_join.link_vectors(df).collect()) == [(1, 3, 1)] * 3 + [(2, 3, 1)]
    assert embedding_join.link_vectors(df.limit(0)).count() == 0
    # ids that are missing or stand for several vectors
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (6, [0.0, 1.0], 1), (6, [-1.0, 0.0], 1), (7, [0.01, 1.0], 1), (None, [-1.0, -1.0], 1)]
    got = embedding_join.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=str) == sorted([(None, 1, 5), (5, 1, 5), (6, 1, 6), (6, 0, 6), (7, 1, 6), (None, 0, None)], key=str)


def test_vectors_match_sql(spark, small, compare):
    compare(embedding_join.op5_subspace_join(spark, small), oracles.VECTORS)


def shingles(text: str | None, n: int = 5) -> frozenset:
    import re

    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBb \n\tÄä"), max_size=30), min_size=1, max_size=6))
def test_shingle_sets(texts):
    found = sets_of.shingle_sets(pa.array(texts))
    want = [shingles(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(found[i], found[j])) == len(want[i] & want[j])


def linked(rows: list[tuple]) -> tuple[list, int]:
    """(id, shingles, component) of rows, and how many pairs link, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    token: dict = {}
    numbered = [frozenset(token.setdefault(x, len(token)) for x in s) for s in sets]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if numbered[a] and numbered[b] and 100 * len(numbered[a] & numbered[b]) >= 75 * len(numbered[a] | numbered[b])]
    comp = closure(list(range(len(rows))), links)
    least: dict = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(comp[i], []).append(k)
    return [(k, len(sets[i]), min((x for x in least[comp[i]] if x is not None), default=k)) for i, (k, _) in enumerate(rows)], len(links)


@pytest.mark.parametrize(("long", "tile", "list_most", "bits"), [(2, 3, 20_000, 64), (2, 500, 4, 64), (16, 500, 20_000, 5), (3, 4, 5, 6)])
def test_jaccard_by_brute_force(spark, long, tile, list_most, bits, monkeypatch):
    """Also with lists dealt into parts, tiny tiles, and first digests that many sets share."""
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "LIST_TILE", tile)
    rng = np.random.default_rng(long + bits)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 60))
    rows, k = [], 0
    for _ in range(25):
        base = list(rng.choice(vocabulary, int(rng.integers(8, 120))))
        if rng.random() < 0.6:
            base = passage + base
        for _ in range(int(rng.integers(1, 8))):
            words = list(base)
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(len(words)))] = str(rng.choice(vocabulary))
            rows.append((k, " ".join(words)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \n "), (k + 3, "only three words"), (k + 4, "ONLY three\tWords"), (k + 5, rows[0][1].upper()), (k + 6, "w1 " * 20_000), (3, rows[3][1])]
    want, links = linked(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, n long").repartition(3)
    got = sorted((r.id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, long=long, list_most=list_most, name_bits=bits).collect())
    assert got == sorted(want)
    assert links > 40


def test_jaccard_hot_shingle_and_large_family(spark, monkeypatch):
    """A passage that all texts share, one family of 400 near copies, and 300 texts made of it that mostly don't link."""
    monkeypatch.setattr(jaccard_join, "TILE", 40)
    monkeypatch.setattr(jaccard_join, "LIST_TILE", 60)
    rng = np.random.default_rng(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    hot = list(rng.choice(vocabulary, 50))
    base = hot + list(rng.choice(vocabulary, 40))
    rows = []
    for k in range(400):
        words = list(base)
        for _ in range(int(rng.integers(0, 3))):
            words[int(rng.integers(50, 90))] = str(rng.choice(vocabulary))
        rows.append((k, " ".join(words)))
    for k in range(400, 700):
        rows.append((k, " ".join(hot + list(rng.choice(vocabulary, int(rng.integers(3, 30)))))))
    want, links = linked(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, long=8, list_most=50).collect())
    assert got == sorted(want) and links > 10_000 and len({c for *_, c in want}) > 20


def test_jaccard_postings_are_small_and_come_back():
    """Under 18 bytes a posting however many buckets there are (24 before); names, sizes and places come back with shared keys for shared shingles only."""
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    sublists = jaccard_join.Sublists(np.sort(tokens[:3]), np.array([50, 5, 90]), 20)
    sets = [(np.concatenate([tokens[:3], rng.choice(tokens[3:], 90, replace=False)]), int(rng.integers(-1 << 62, 1 << 62)), int(n)) for n in rng.integers(300, 60_000, 200)] + [(tokens[3:1000], 7, 1_000_000)]
    want = sorted((name, size, k, int(t)) for head, name, size in sets for k, t in enumerate(head))
    for buckets in (7, 900):
        batch = jaccard_join.pack_postings(sets, sublists, buckets)
        if buckets == 900:
            assert sum(len(x) for r in batch.to_pylist() for x in r.values() if isinstance(x, bytes)) < 18 * len(want)
        rows = [row for r in batch.to_pylist() for row in zip(*jaccard_join.unpack_postings(*r.values()), strict=True)]
        of = {(name, k): t for name, _, k, t in want}
        key = {of[int(i), int(p)]: int(x) for x, i, _, p in rows}
        assert sorted((int(i), int(n), int(p), of[int(i), int(p)]) for _, i, n, p in rows) == want
        assert all(key[of[int(i), int(p)]] == x for x, i, _, p in rows) and len(set(key.values())) == len(key)
        assert sum(x >= 1 << 63 for x in key.values()) == 2


@pytest.mark.parametrize("key_bits", [0, 2])
def test_jaccard_shingles_of_one_key(spark, key_bits):
    """Lists that hold many shingles, a set several times in one."""
    rng = np.random.default_rng(key_bits)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(120):
        words = rows[int(rng.integers(len(rows)))][1].split() if rows and rng.random() < 0.6 else list(rng.choice(vocabulary, int(rng.integers(6, 40))))
        words[int(rng.integers(len(words)))] = str(rng.choice(vocabulary))
        rows.append((k, " ".join(words)))
    want, links = linked(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, long=6, key_bits=key_bits).collect())
    assert got == sorted(want) and links > 5


def test_jaccard_tiles_of_lists_alike_are_dealt_together(spark):
    """Ten lists of the same 90 classes: a pair of tiles has one deal in all of them."""
    rows = [(t, i, 40, i, 7) for t in range(10) for i in range(90)]
    members = spark.createDataFrame(rows, "family long, id long, size int, part long, least long")
    placed, meet = jaccard_join.tiles_of(members, 75, 30, like="least")
    assert placed.count() == len(rows)
    found = [(r.deal, r.n) for r in meet.groupBy("deal").count().withColumnRenamed("count", "n").collect()]
    assert found and all(n == 10 for _, n in found)


def test_jaccard_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h"), (4, "a b c d e f g h"), (None, None), (None, "z")], "doc_id long, text string")
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 4, 4), (4, 4, 4), (None, 0, None), (None, 1, None)], key=str)
    assert jaccard_join.jaccard_components(df.limit(0)).count() == 0


def test_jaccard_matches_sql(spark, small, compare):
    compare(jaccard_join.op10_jaccard_skip(spark, small), oracles.JACCARD)


@settings(max_examples=60, deadline=None)
@given(*[st.lists(st.sets(st.integers(0, 40), max_size=30), min_size=1, max_size=8)] * 2)
def test_overlaps_derived_from_other_answers(left, right):
    a, b = ([np.array(sorted(x), np.uint64) for x in side] for side in (left, right))
    assert sets_of.overlaps(a, b).tolist() == [[len(x & y) for y in right] for x in left]


ENTRIES = st.lists(st.tuples(st.integers(0, 2), st.integers(1, 30), st.integers(0, 8)), max_size=25)


@settings(max_examples=80, deadline=None)
@given(ENTRIES, ENTRIES, st.integers(1, 40))
def test_blocks_meet_where_positions_allow_it(left, right, most):
    left, right = ([e for e in sorted(side) if e[2] < e[1]] for side in (left, right))
    blocks = [sets_of.Blocks(*(np.array([e[k] for e in side], np.int64) for k in (1, 2, 0))) for side in (left, right)]

    def ok(x: tuple, y: tuple) -> bool:
        return x[0] == y[0] and bool(sets_of.possible(*(np.array([v]) for v in (x[1], y[1], x[2], y[2])), 75)[0])

    got = sorted((int(a), int(b)) for i, j in sets_of.meeting(blocks[0], blocks[1], 75, most) for a, b in zip(i, j, strict=True))
    assert got == [(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if ok(x, y)]
    got = sorted((int(a), int(b)) for i, j in sets_of.meeting(blocks[0], None, 75, most) for a, b in zip(i, j, strict=True))
    assert got == [(i, j) for i, x in enumerate(left) for j, y in enumerate(left) if i < j and ok(x, y)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 400), max_size=90), min_size=2, max_size=6))
def test_sketches_never_rule_out_a_link(picked):
    from docmeter.llm.arrays import mix64

    sets = [np.sort(mix64(np.array(sorted(x), np.uint64) + np.uint64(1))) for x in picked]
    marks = sets_of.Sketches([sets_of.sketch(s) for s in sets])
    for i, x in enumerate(picked):
        for j, y in enumerate(picked):
            far = marks.far(np.array([i]), np.array([j]), np.array([len(x) + len(y)]), 75)[0]
            assert not (far and 100 * len(x & y) >= 75 * len(x | y) and x)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), max_size=6), max_size=9))
def test_loser_tree_merges(runs):
    streams = [iter([(x, (x, i)) for x in sorted(run)]) for i, run in enumerate(runs)]
    want = list(heapq.merge(*[[(x, i) for x in sorted(run)] for i, run in enumerate(runs)]))
    assert list(warc.LoserTree(streams)) == want


PAGES = [
    (1, "http://www.Example.com:80/a?b=2&a=1#x", "<p>same</p>"), (2, "https://example.com/a", "<p>same</p>"), (3, None, None), (4, "http://b.org", ""), (5, "not a url\r\nX: y", "WARC/1.1\r\n\r\nnested\r\n\r\n"),
    (6, "http://[bad", "é\r\n\r\n\r\n🙂"), (None, "http://b.org", "no id"), (7, "http://b.org", "x" * 400_000), (7, "http://b.org", "x" * 400_000), (8, "http://b.org/1", "x" * 400_000),
]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 99), min_size=1, max_size=12), max_size=7), st.integers(2, 4), st.integers(1, 5))
def test_blocks_of_runs_merge(runs, fan_in, size):
    """In the order of keys, whatever the blocks; no more than the blocks that overlap are held."""
    key = lambda x, r: f"{x:03d}-{r}"
    blocks = []
    for r, run in enumerate(runs):
        keys = [key(x, r) for x in sorted(run)]
        blocks += [(f"run{r}", keys[i], pa.RecordBatch.from_arrays([pa.array(keys[i : i + size])], names=["sort_key"])) for i in range(0, len(keys), size)]
    got = [k for b in warc.merged_blocks(iter(sorted(blocks, key=lambda b: b[1])), fan_in) for k in b.column(0).to_pylist()]
    assert got == sorted(key(x, r) for r, run in enumerate(runs) for x in run)


def test_many_runs_are_merged_in_passes(spark):
    rows = [(i, f"http://h{i * 7919 % 61}.org/{i % 13}", f"page {i % 50}") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(16)
    path = scratch_path(spark, "test-warc")
    warc.write_archives(df, path)
    runs = warc.sorted_runs(spark, path)
    assert runs.select("run").distinct().count() > 9
    got = warc.merge_runs(runs, range_rows=60, fan_in=3).orderBy("range_no", "place").collect()
    want = sorted(runs.collect(), key=lambda r: r.sort_key.encode())
    assert [(r.url_key, r.timestamp, r.page_id, r.archive, r.offset) for r in got] == [(r.url_key, r.timestamp, r.page_id, r.archive, r.offset) for r in want]
    assert len({r.range_no for r in got}) > 3


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, compression):
    df = spark.createDataFrame([(*p, "clash", 3) for p in PAGES], "page_id long, url string, html string, archive string, place int").repartition(3)
    path = scratch_path(spark, "test-warc")
    warc.write_archives(df, path, compression=compression)
    rows = warc.merge_runs(warc.sorted_runs(spark, path), range_rows=4).orderBy("range_no", "place").collect()
    assert len(rows) == len(PAGES)
    order = [(r.url_key.encode(), r.timestamp, r.page_id if r.page_id is not None else -(1 << 63)) for r in rows]
    assert order == sorted(order)
    leader = {}
    for k, _, html in PAGES:
        leader[html or ""] = max(leader.get(html or "", -1), -1 if k is None else k)
    html_of = {k: h or "" for k, _, h in PAGES}
    stored = {f.path.rsplit("/", 1)[-1]: bytes(f.content) for f in spark.read.format("binaryFile").load(path).collect()}
    for r in rows:
        data = html_of[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), b32encode(hashlib.sha1(data).digest()).decode())
        best = leader[html_of[r.page_id]]
        want = ("response", None) if r.page_id is None or best == r.page_id else ("revisit", best)
        assert (r.record_type, r.refers_to) == want
        archive = stored[r.archive]
        record = (gzip.decompress(archive) if compression == "gzip" else archive)[r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n" + data if r.record_type == "response" else b"\r\n\r\n")


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame([(i, "http://a.b", "abc" if i < 3 else "abcdef") for i in range(6)], "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc")
    warc.write_archives(df, path, least_bytes=4)
    got = {r.page_id: r.record_type for r in warc.merge_runs(warc.sorted_runs(spark, path)).collect()}
    assert got == {0: "response", 1: "response", 2: "response", 3: "revisit", 4: "revisit", 5: "response"}


def test_damage_is_noticed():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 48\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nabcdefgh"
    with pytest.raises(ValueError, match="damaged"):
        list(warc.capture("f", *r) for r in warc.parse_archive(record))


def test_no_pages(spark):
    path = scratch_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.merge_runs(warc.sorted_runs(spark, path)).count() == 0


def test_archives_match_sql(spark, small, compare):
    compare(warc.op2_warc_index(spark, small), oracles.WARC)
