from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docmeter.llm import packing, tokens

PATH = tokens.tokenizer_path()
TEXTS = [
    "", None, " ", "Hello, world! it's 12 o'clock", "<|endoftext|> inside <|endoftext|>", "a" * 5000, "word " * 90_000, "x" * 300_000, "línea\n\n\t  dos ",
    "emoji \U0001f600 and 漢字 and ﬁ ͸", "​  nbsp", "tab\t\ttab", "é" * 100, "a  b   c    d",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library):
    texts = [t or "" for t in TEXTS]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert tokens.encoder(PATH).fast is not None
    assert [x.tolist() for x in tokens.encoder(PATH).ids(texts)] == want
    assert tokens.encoder(PATH).counts(texts) == [len(x) for x in want]


@pytest.mark.parametrize("white", list("\n \t\x0b\r\x85\xa0\u2003\u3000") + ["\r\n", " \n"])
def test_long_runs_of_white_space(library, white):
    """Runs alone, before and inside prose, and at a text's end; also what Python alone takes for white space."""
    e = tokens.encoder(PATH)
    for n in (70_000, 900_000) if white in "\n " else (70_000,):
        run = white * (n // len(white))
        texts = [run, f"Some words.{run}and more words 12", f"end{run}", f"{run}begin", f"a{run}\x1c b{run}{run}x"]
        assert e.counts(texts) == [len(x.ids) for x in library.encode_batch_fast(texts, add_special_tokens=False)]
        assert e.ids(texts[1:2])[0].tolist() == library.encode(texts[1], add_special_tokens=False).ids


@pytest.mark.parametrize("char", ["\n", " "])
def test_runs_of_five_million(spark, library, char):
    text = f"before{char * 5_000_000} after"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = library.encode_batch_fast([text], add_special_tokens=False)[0].ids
    assert tokens.count_tokens(frame, PATH).first().n_tokens == len(want)
    pieces = packing.pack(frame, PATH).collect()
    assert sum(p.length for p in pieces) == len(want) + 1 and check(pieces, {1: [*want, 1]}, 2048) == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t'sabcÄé12.,!?#-  漢"), max_size=60), st.integers(1, 12))
def test_safe_splits_keep_ids(text, most):
    library = tokens.encoder(PATH).slow
    parts = tokens.split_safely(text, most)
    assert "".join(parts) == text
    assert [i for p in parts for i in library.encode(p, add_special_tokens=False).ids] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_use_their_library(name):
    e = tokens.encoder(tokens.tokenizer_path(name))
    assert e.fast is None and e.counts(["Hello world", ""])[0] > 0


def test_counts(spark, library):
    rows = [(i, t, "keep", 5) for i, t in enumerate(TEXTS)] + [(0, "twice", "keep", 5)] * 2
    out = tokens.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, extra string, n_tokens long"), PATH, batch_bytes=1000)
    assert out.columns == ["doc_id", "extra", "n_bytes", "n_tokens"]
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in out.collect())
    assert got == sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def check(pieces, want: dict, window: int) -> float:
    """Every id once, sequences gapless and at most a window; returns the share of padding."""
    by, cover = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
        cover[p.doc_id].append((p.start, p.length))
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert ids.tolist() == want[p.doc_id][p.start : p.start + p.length] and p.doc_tokens == len(want[p.doc_id]) and p.length > 0
    for k, ids in want.items():
        at = 0
        for start, length in sorted(cover[k]):
            assert start == at
            at += length
        assert at == len(ids)
    padding = total = 0
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        full = at if at & (at - 1) == 0 else window
        padding, total = padding + full - at, total + full
    return padding / max(1, total)


def test_pack_round_trip(spark, library):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, start string, ids long").repartition(2), PATH, window=256, block_tokens=3000)
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t, *_ in rows}
    assert check(out.collect(), want, 256) == 0
    digest = packing.pieces_digest(out).first()
    assert digest.ids_crc32 == zlib.crc32(np.array(want[digest.doc_id][digest.start : digest.start + digest.length], "<u4").tobytes())
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60))
def test_plans_cover_every_length(lengths):
    plans, counted = packing.plan(np.array(lengths, np.int64), 64)
    assert all(sum(p[2] for p in one) == 64 for one in plans[:counted])
    cover = defaultdict(list)
    for one in plans:
        total = sum(p[2] for p in one)
        assert total == 64 or total & (total - 1) == 0
        for item, start, size in one:
            cover[item].append((start, size))
    for i, n in enumerate(lengths):
        at = 0
        for start, size in sorted(cover[i]):
            assert start == at
            at += size
        assert at == n


def test_repeat_counts_reach_the_least_squares():
    combos = np.array([[40, 24, 0], [34, 30, 0], [30, 24, 10], [40, 14, 10]])
    histogram = np.zeros(65)
    for row, n in zip(combos, (5, 7, 3, 2), strict=True):
        for v in row:
            histogram[v] += n * (v > 0)
    x = packing.repeat_counts(combos, histogram, 2000)
    assert np.allclose(x, [5, 7, 3, 2], atol=0.05)


def test_few_documents_are_cut_where_lengths_mix():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.3, 0.9, 4000).astype(int), 1, 2047)
    plans, counted = packing.plan(lengths)
    assert counted > 0.6 * len(plans)  # windows from rounded counts, before the greedy rest
    assert sum(len(p) for p in plans) < 1.15 * len(lengths)


def test_repeated_lengths_only():
    plans, _ = packing.plan(np.full(1000, 1500))
    assert len(plans) <= 1000 * 1500 // 2048 + 12
