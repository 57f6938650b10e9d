from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from docmeter.llm import quality_rules, tokens

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """Rows that go into and come out of each stage."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, small)
        result.write.parquet(str(root / name))
        out[name] = (docs.collect(), spark.read.parquet(str(root / name)).collect(), result.columns)
        docs = spark.read.parquet(str(root / name))
    return out


def test_stages_hand_on_documents(spark, small, stages):
    columns = spark.read.parquet(f"{small}/documents.parquet").columns
    assert len(corpus_pipeline.STAGES) == 5
    for name in list(stages)[:-1]:
        assert stages[name][2] == columns and 0 < len(stages[name][1])


def test_language_stage_keeps_what_has_letters(stages):
    before, after, _ = stages["language_id"]
    kept = {r.doc_id for r in after}
    lettered = {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
    assert kept <= lettered and len(lettered - kept) <= 0.02 * len(lettered)


def test_quality_stage_keeps_clean_documents(spark, small, stages):
    before, after, _ = stages["quality_rules"]
    kept = {r.doc_id for r in after}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    base = {r.doc_id for r in quality_rules.text_statistics(spark.createDataFrame(before).select("doc_id", "text")).where(quality_rules.base_failed()).collect()}
    assert not kept & base
    clean = [r.doc_id for r in before if labels.get(r.doc_id) == 1 and r.doc_id not in base]
    assert all(k in kept for k in clean)
    assert not any(labels.get(k) == 0 for k in kept)


def test_near_duplicate_stage_by_brute_force(stages):
    before, after, _ = stages["ngram_jaccard_join"]
    sets = {}
    for r in before:
        w = WORD.findall((r.text or "").translate(LOWER))
        sets[r.doc_id] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in after) == sorted(k for k in ids if root(k) == k)
    assert len(after) < len(before)


def test_mix_stage_takes_each_budget(stages):
    before, after, _ = stages["mix_sources"]
    size, got, most = Counter(), Counter(), Counter()
    for r in before:
        size[r.source] += len(WORD.findall(r.text or ""))
        most[r.doc_id] = len(WORD.findall(r.text or ""))
    taken = Counter()
    for r in after:
        n = len(WORD.findall(r.text))
        got[r.source] += n
        taken[r.doc_id] += n
    names = sorted(size)
    from test_sharding_mixing import targets

    for name, want in zip(names, targets([size[n] for n in names]), strict=True):
        assert abs(got[name] - want) <= 1
    assert all(taken[k] <= 3 * most[k] for k in taken)


def test_packing_stage_covers_every_copy(stages):
    before, after, _ = stages["packing"]
    library = Tokenizer.from_file(tokens.tokenizer_path())
    copies: dict[tuple, int] = Counter((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids) + (1,)) for r in before)
    whole: dict[int, set] = defaultdict(set)
    for k, ids in copies:
        whole[k].add(ids)
    length, sequences = Counter(), defaultdict(list)
    for p in after:
        assert any(zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for ids in whole[p.doc_id] if len(ids) == p.doc_tokens)
        length[p.doc_id] += p.length
        sequences[p.sequence_id].append((p.offset, p.length))
    want = Counter()
    for (k, ids), n in copies.items():
        want[k] += n * len(ids)
    assert length == want
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048


PROSE = "The old river runs past seven quiet towns and a mill. Nobody remembers who built the bridge there. It stands since {0} days, and children cross it each morning. In winter the water near house {0} freezes, and in spring number {0} is full of birds."
ROWS = "doc_id long, text string, lang string, source string, n_chars long, score double, taken string, row int, row2 string, own_score int"


def edge_rows(spark):
    """Null and repeated ids, null, empty and long texts, exact repeats, and columns whose names the stages use."""
    rows = []
    for k in range(60):
        rows.append((k, PROSE.format(k) + " " + " ".join(f"w{(k * 37 + j) % 997}x{'abcdefgh'[j % 8]}." for j in range(60)), "en", "abc"[k % 3], 9, 0.5, "t", 1, "r", k))
    other = [(r[1].replace("w", "v") + " And one more line.", *r[2:]) for r in rows[:3]]
    rows += [(5, *other[0]), (None, *other[1]), (None, *other[2])]  # an id twice with unlike texts, null ids with texts of their own
    rows += [rows[7], rows[7], (None, *rows[8][1:]), (3, rows[9][1], *rows[9][2:])]  # repeats, a copy without an id, a copy under another's id
    odd = [(100, None), (101, ""), (102, " \n"), (103, "12 ½ ②"), (104, "\n" * 1_000_000), (105, rows[10][1] + " " * 900_000 + "end. " + " ".join(f"z{i}." for i in range(300)))]
    rows += [(k, t, None, None, None, None, None, None, None, None) for k, t in odd]
    return rows, spark.createDataFrame(rows, ROWS).repartition(3)


def test_stages_on_edge_rows(spark, tmp_path):
    rows, docs = edge_rows(spark)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
        got[name], docs = out.collect(), out
    kept = {(r.doc_id, r.text) for r in got["quality_rules"]}
    assert {t for _, t in kept} >= {r[1] for r in rows[:63]} and not {100, 101, 102, 103, 104} & {k for k, _ in kept}
    assert all((r.score, r.taken, r.row, r.row2) == (0.5, "t", 1, "r") for r in got["ngram_jaccard_join"] if r.doc_id != 105)
    stay = Counter((r.doc_id, r.text) for r in got["ngram_jaccard_join"])
    assert max(stay.values()) == 1
    assert {(r[0], r[1]) for r in rows[:9]} | {(r[0], r[1]) for r in rows[60:63]} <= set(stay)  # unlike texts of one id and of none
    assert (None, rows[8][1]) not in stay and (3, rows[9][1]) in stay and (9, rows[9][1]) not in stay
    assert {r.doc_id for r in got["packing"]} == {r.doc_id for r in got["mix_sources"]}


def test_stages_on_no_rows(spark):
    docs = spark.createDataFrame([], ROWS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_mix_stage_reruns_agree(spark):
    _, docs = edge_rows(spark)
    once, again = (sorted(map(str, corpus_pipeline.mixing_stage(spark, docs.repartition(n), "").collect())) for n in (2, 5))
    assert once == again
