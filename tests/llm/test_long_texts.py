from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmeter.llm import jaccard_join, line_crf
from docmeter.llm.arrays import flat, span_hashes, words
from docmeter.llm.shingles import shingle_sets


def thue_morse(n: int, a: str = "a", b: str = "b") -> str:
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_words_built_to_cancel_sums_of_powers_stay_apart(n):
    one, other = thue_morse(n), thue_morse(n, "b", "a")
    around = "four more words here"
    texts = [one, other, f"{one} {around}", f"{other} {around}", " ".join(thue_morse(n // 2, f"{x}", "c") for x in "abdef")]
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(texts))]
    assert all(not sets[i] & sets[j] for i in range(5) for j in range(i))


def test_no_link_of_such_words(spark):
    rows = [(1, thue_morse(1024)), (2, thue_morse(1024, "b", "a")), (3, thue_morse(1024).upper())]
    got = {r.id: r.component_id for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=20) | st.binary(min_size=250, max_size=270), min_size=1, max_size=30))
def test_hashes_tell_spans_apart_wherever_they_stand(spans):
    def hashes(order: list[bytes]) -> dict[bytes, int]:
        ends = np.cumsum([len(x) for x in order])
        found = span_hashes(np.frombuffer(b"".join(order), np.uint8), ends - [len(x) for x in order], ends)
        return dict(zip(order, found.tolist(), strict=True))

    one = hashes(spans)
    assert one == hashes(spans[::-1]) and len(set(one.values())) == len(set(spans))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB \n\té"), max_size=60), min_size=1, max_size=6), st.integers(1, 20), st.integers(1, 4))
def test_pieces_give_the_same_sets(texts, piece, n_words):
    column = pa.array([*texts, None])
    assert [s.tolist() for s in shingle_sets(column, n_words, piece)] == [s.tolist() for s in shingle_sets(column, n_words)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n"), max_size=20), max_size=6))
def test_words_of_texts(texts):
    data, offsets = flat(pa.array(texts, pa.string()))
    starts, ends, first = words(data, offsets)
    got = [[bytes(data[a:b]).decode() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert got == [t.split() for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 70), st.integers(1, 9), st.integers(0, 10**6))
def test_blocks_of_a_chain_give_the_same_marginals(n, block, seed):
    rng = np.random.default_rng(seed)
    emission, t = rng.normal(0, 3, n), rng.normal(0, 2, (2, 2))
    ahead, back = line_crf.Chains(np.array([0, n])).messages(emission, t)
    assert np.allclose(line_crf.chain_marginals(emission, t, block), 1 / (1 + np.exp(-(ahead + back))), atol=1e-9)


@pytest.fixture
def model():
    rng = np.random.default_rng(5)
    return line_crf.Model(rng.normal(0, 1, line_crf.N_FEATURES), rng.normal(0, 1, (2, 2)), (1.3, 0.2))


def test_long_texts_score_as_short_ones(model, monkeypatch):
    rng = np.random.default_rng(1)
    lines = ["", "a b c", "Repeated line, twice.", "### !!! $$$", "UPPER | lower 123", "é ü words"]
    texts = ["\n".join(rng.choice(lines, n).tolist()) for n in (1, 2, 7, 40, 300)] + ["", "\n", "\n\n", "x" * 500]
    column = pa.array([*texts, None])
    want = model.score(column)
    monkeypatch.setattr(line_crf, "LONG_LINES", 1)
    monkeypatch.setattr(line_crf, "SLICE_LINES", 3)
    monkeypatch.setattr(line_crf, "BATCH_BYTES", 40)
    assert np.allclose(model.score(column), want, atol=1e-9)


def test_training_takes_no_more_lines_than_allowed(spark):
    docs = spark.createDataFrame([(k, "good line here\n" * 9 if k % 2 else "### bad ###\n" * 9) for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    assert line_crf.fit(docs, labels, most_lines=5).w is None
    assert line_crf.fit(docs, labels, most_lines=100).w is not None


#: Work on one text of 16 and 32 MB, in a process that may take so much more memory than before.
LIMITED = """
import resource, numpy as np, pyarrow as pa
from docmeter.llm import line_crf, shingles
text = {text}
column = pa.array([text])
now = int(open("/proc/self/statm").read().split()[0]) * 4096
resource.setrlimit(resource.RLIMIT_AS, (now + {mb} * 1_000_000,) * 2)
{work}
"""


@pytest.mark.parametrize(
    ("text", "mb", "work"),
    [
        ("chr(10) * (16 << 20)", 1300, "line_crf.Model(np.ones(line_crf.N_FEATURES), np.eye(2)).score(column)"),
        ("'word and line' + chr(10) + 'x' * (16 << 20)", 900, "line_crf.Model(np.ones(line_crf.N_FEATURES), np.eye(2)).score(column)"),
        ("' '.join(str(k * 7919 % 1000) for k in range(8 << 20))", 500, "shingles.shingle_sets(column)"),
        ("'x' * (32 << 20)", 500, "shingles.shingle_sets(column)"),
    ],
)
def test_memory_for_one_long_text_is_bounded(text, mb, work):
    done = subprocess.run([sys.executable, "-c", LIMITED.format(text=text, mb=mb, work=work)], capture_output=True, text=True, timeout=300, env={**os.environ, "OPENBLAS_NUM_THREADS": "1"})
    assert done.returncode == 0, done.stderr[-500:]
