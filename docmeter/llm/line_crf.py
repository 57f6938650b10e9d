"""Document quality from a linear-chain CRF over lines.

Every line of a text is labelled good or bad. A line's features are ratios of its
bytes and words and those of its two neighbours; the chain's transitions tie
labels together. Forward-backward gives each line's marginal of good; weighted by
line length they give the document's share of good text, which a logistic curve,
fitted on the same rows, turns into a score.

Training takes at most ``TRAIN_ROWS`` labelled keys, first by hash, with texts of at
most ``TRAIN_BYTES``; tasks turn those into line features. Line labels are latent:
a good document's lines are all good, of a bad one's at least one is bad. The
driver maximises the likelihood of the documents' labels over the paths that agree with
them: for a good document that is one path, for a bad one all others, so their
expectations are those of all paths less the all-good path's share. Which lines
of a bad text are bad is for the model to find: those unlike good texts' lines.
Scoring is one pass over whole texts in bounded Arrow batches; only weights go to
the tasks.

Defined results: a null text counts as empty; an empty text is one empty line.
Without labelled rows of both classes every score is the share of label 1
(1 without any). Keys labelled twice take the smaller label, texts that repeat a
key the least text. Repeated rows are scored alike. Result columns replace columns
of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmeter.llm.arrays import flat, running, span_hashes, words
from docmeter.llm.common import bucket_crc, md5_key, sliced, table

TRAIN_ROWS = 2000
#: Bytes of a text that may be learned from; longer ones are only scored.
TRAIN_BYTES = 1 << 17
STEPS = 120
#: Lines that are learned from; texts are taken by hash of their key as long as they fit.
TRAIN_LINES = 500_000
BATCH_BYTES = 1 << 20
#: A text of more lines or bytes is worked on alone, its features in slices of so many lines.
LONG_LINES, SLICE_LINES = 4096, 20_000
#: Own features of a line; the first _SHARED of them also count for the lines before and after.
OWN = ("symbols", "bangs", "capitals", "repeats", "bars", "seen", "digits", "stops", "short", "long_words")
_SHARED = 6
N_FEATURES = len(OWN) + 2 * _SHARED + 1

_KINDS = np.zeros((6, 256), bool)
for _row, _chars in enumerate((b"#*$%&<>", b"!", bytes(range(65, 91)), b"|", b"0123456789", b".")):
    _KINDS[_row, list(_chars)] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def line_features(column: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x N_FEATURES), line lengths in bytes, and each text's first line (one more than texts). ``known``: which lines repeat an earlier one, if that is known."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    per_text = np.searchsorted(breaks, offsets)
    first = per_text + np.arange(n + 1)  # a text has a line more than breaks
    starts = np.zeros(first[-1], np.int64)
    ends = np.zeros(first[-1], np.int64)
    text_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    place = np.arange(len(breaks)) + text_of_break
    ends[place] = breaks
    starts[place + 1] = breaks + 1
    starts[first[:-1]] = offsets[:-1]
    ends[first[1:] - 1] = offsets[1:]
    length = ends - starts

    def count(flags: np.ndarray) -> np.ndarray:
        sums = running(flags)
        return sums[ends] - sums[starts]

    symbols, bangs, upper, bars, digits, stops = (count(kind[data]) for kind in _KINDS)
    letters = count(_LETTERS[data])
    w_start, w_end, _ = words(data, offsets)
    w_hash = span_hashes(data, w_start, w_end)
    w_first, w_last = np.searchsorted(w_start, starts), np.searchsorted(w_start, ends)
    n_words = w_last - w_first
    again = np.zeros(len(w_hash), bool)
    again[1:] = w_hash[1:] == w_hash[:-1]
    again[w_first[w_first < len(again)]] = False  # each line on its own
    repeat = running(again)
    repeats = repeat[w_last] - repeat[w_first]
    doc = np.repeat(np.arange(n), np.diff(first))
    seen = repeated(doc, span_hashes(data, starts, ends), n_words > 0) if known is None else known
    per_word, per_letter = np.maximum(n_words, 1), np.maximum(letters, 1)
    own = np.stack(
        [
            np.minimum(1, 2 * symbols / per_word),
            np.minimum(1, 2 * bangs / per_word),
            np.minimum(1, 2 * upper / per_letter),
            np.minimum(1, 2 * repeats / per_word),
            np.minimum(1, 4 * bars / per_word),
            seen,
            np.minimum(1, 4 * digits / np.maximum(length, 1)),
            np.minimum(1, 5 * stops / per_word),
            n_words < 3,
            np.minimum(1, length / (12 * per_word)),
        ],
        axis=1,
    ).astype(np.float64)
    before, after = np.zeros((len(doc), _SHARED)), np.zeros((len(doc), _SHARED))
    if len(doc):
        inner = np.ones(len(doc), bool)
        inner[first[:-1]] = False
        before[inner] = own[:, :_SHARED][np.flatnonzero(inner) - 1]
        after[np.flatnonzero(inner) - 1] = own[:, :_SHARED][inner]
    return np.hstack([own, before, after, np.ones((len(doc), 1))]), length, first


def repeated(doc: np.ndarray, hashes: np.ndarray, worded: np.ndarray) -> np.ndarray:
    """Lines with a word that an earlier line of their text has whole."""
    order = np.lexsort((np.arange(len(doc)), hashes, doc))
    out = np.zeros(len(doc), bool)
    out[order[1:]] = (doc[order][1:] == doc[order][:-1]) & (hashes[order][1:] == hashes[order][:-1]) & worded[order][1:]
    return out


def _as_text(data: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(data)], np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of lines, of ``SLICE_LINES`` lines and ``BATCH_BYTES`` bytes at most (one line at least)."""
    at = 0
    while at < len(ends):
        begin = int(ends[at - 1]) + 1 if at else 0
        stop = max(at + 1, min(at + SLICE_LINES, int(np.searchsorted(ends, begin + BATCH_BYTES, side="right"))))
        yield at, stop
        at = stop


def long_emissions(data: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each line's own label, and line lengths, of one text of any length: features exist for a slice of lines at a time."""
    ends = np.append(np.flatnonzero(data == 10), len(data)).astype(np.int64 if len(data) >> 31 else np.int32)
    at = lambda k: int(ends[k - 1]) + 1 if k else 0
    lines, hashes = [], []
    for a, b in _slices(ends):
        part = data[at(a) : int(ends[b - 1])]
        starts = np.append(0, ends[a : b - 1].astype(np.int64) + 1 - at(a))
        stops = ends[a:b].astype(np.int64) - at(a)
        w_start = words(part, np.array([0, len(part)]))[0]
        full = np.searchsorted(w_start, stops) > np.searchsorted(w_start, starts)
        lines.append((np.flatnonzero(full) + a).astype(ends.dtype))
        hashes.append(span_hashes(part, starts[full], stops[full]))
    worded, hashed = np.concatenate(lines), np.concatenate(hashes)
    seen = np.zeros(len(ends), bool)
    if len(worded):
        again = np.ones(len(worded), bool)
        again[np.unique(hashed, return_index=True)[1]] = False
        seen[worded[again]] = True
    emission = np.empty(len(ends))
    for a, b in _slices(ends):
        before, after = max(0, a - 1), min(len(ends), b + 1)  # neighbours count
        features, _, _ = line_features(_as_text(data[at(before) : int(ends[after - 1])]), seen[before:after])
        emission[a:b] = (features @ w)[a - before : b - before]
    length = np.diff(ends, prepend=-1) - 1
    return emission, length


def chain_marginals(emission: np.ndarray, t: np.ndarray, block: int = 1024) -> np.ndarray:
    """P(good) of each line of one long chain. Blocks are walked together: what a block makes of the message that enters it is a map of four
    numbers, from two walks; the maps are applied one after the other, and then all blocks are walked with what really enters them."""
    n = len(emission)
    first = np.append(np.arange(0, n, block), n)
    sizes = np.diff(first)
    count = len(sizes)

    def entered(order: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Log-odds that enter each block, walked in an order. step: per line and direction, log weights [from, to]."""
        maps = np.zeros((count, 2, 2))
        maps[:, 0, 1] = maps[:, 1, 0] = -np.inf
        for k in range(block):
            live = np.flatnonzero(sizes > k)
            at = first[:-1][live] + (k if order[0] == 0 else sizes[live] - 1 - k)
            s, m = step(at), maps[live]
            maps[live] = np.logaddexp(m[:, :, :1] + s[:, None, 0, :], m[:, :, 1:] + s[:, None, 1, :])
            maps[live] -= maps[live].max(axis=(1, 2), keepdims=True)
        out, r = np.zeros(count), None
        for b in order.tolist():
            out[b] = 0.0 if r is None else r
            low, high = (0.0, 0.0) if r is None else (min(0.0, -r), min(0.0, r))
            m = maps[b]
            r = float(np.logaddexp(low + m[0, 1], high + m[1, 1]) - np.logaddexp(low + m[0, 0], high + m[1, 0]))
        return out

    def forward(at: np.ndarray) -> np.ndarray:
        s = np.broadcast_to(t, (len(at), 2, 2)).copy()
        s[at == 0] = 0.0  # nothing before the first line
        s[:, :, 1] += emission[at][:, None]
        return s

    def backward(at: np.ndarray) -> np.ndarray:
        s = np.broadcast_to(t.T, (len(at), 2, 2)).copy()
        s[:, 1, :] += emission[at][:, None]  # the line's own label counts before the step to the line before
        return s

    ahead, back = np.empty(n), np.empty(n)
    r = entered(np.arange(count), forward)
    for k in range(block):
        live = np.flatnonzero(sizes > k)
        at = first[:-1][live] + k
        x = r[live]
        moved = np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0])
        moved[at == 0] = 0.0
        ahead[at] = r[live] = emission[at] + moved
    r = entered(np.arange(count)[::-1], backward)
    for k in range(block):
        live = np.flatnonzero(sizes > k)
        at = first[1:][live] - 1 - k
        back[at] = r[live]
        x = emission[at] + r[live]
        r[live] = np.logaddexp(x + t[1, 1], t[1, 0]) - np.logaddexp(x + t[0, 1], t[0, 0])
    return _sigmoid(ahead + back)


class Chains:
    """Chains of given lengths, walked together step by step, longest first."""

    def __init__(self, first: np.ndarray):
        sizes = np.diff(first)
        self.order = np.argsort(-sizes, kind="stable")
        self.first = first[:-1][self.order]
        self.sizes = sizes[self.order]
        self.active = np.searchsorted(-self.sizes, -np.arange(1, (self.sizes[0] if len(sizes) else 0) + 1), side="right")

    def messages(self, emission: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward (own emission included) and backward log-odds of good. t[i, j]: score of label i then j."""
        ahead, back = np.empty(len(emission)), np.zeros(len(emission))
        for k, n in enumerate(self.active):
            at = self.first[:n] + k
            if k:
                r = ahead[at - 1]
                ahead[at] = emission[at] + np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])
            else:
                ahead[at] = emission[at]
        for k in range(len(self.active) - 2, -1, -1):
            at = self.first[: self.active[k + 1]] + k
            s = emission[at + 1] + back[at + 1]
            back[at] = np.logaddexp(s + t[1, 1], t[1, 0]) - np.logaddexp(s + t[0, 1], t[0, 0])
        return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Model:
    """Weights, transitions, and the logistic curve from a document's share of good text to its score."""

    def __init__(self, w: np.ndarray | None, t: np.ndarray | None, curve: tuple[float, float] = (1.0, 0.0), share: float = 1.0):
        self.w, self.t, self.curve, self.share = w, t, curve, share

    def marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        ahead, back = Chains(first).messages(features @ self.w, self.t)
        return _sigmoid(ahead + back)

    def lines(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """P(good), line lengths and first lines of runs of texts, in order; a long text comes alone."""
        data, offsets = flat(column)
        breaks = np.diff(np.searchsorted(np.flatnonzero(data == 10), offsets))
        long = (breaks >= LONG_LINES) | (np.diff(offsets) > BATCH_BYTES)
        start = 0
        for i in [*np.flatnonzero(long).tolist(), len(column)]:
            if i > start:
                features, length, first = line_features(column.slice(start, i - start))
                yield (np.full(len(length), self.share) if self.w is None else self.marginals(features, first)), length, first
            if i < len(column):
                emission, length = long_emissions(data[offsets[i] : offsets[i + 1]], np.zeros(N_FEATURES) if self.w is None else self.w)
                yield (np.full(len(length), self.share) if self.w is None else chain_marginals(emission, self.t)), length, np.array([0, len(length)])
            start = i + 1

    def score(self, column: pa.Array) -> np.ndarray:
        if self.w is None:
            return np.full(len(column), self.share)
        return np.concatenate([np.zeros(0), *[self.curved(*run) for run in self.lines(column)]])

    def curved(self, good: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _sigmoid(self.curve[0] * _log_odds(good, length, first) + self.curve[1])


def _log_odds(good: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
    weight = length + 1.0
    if len(first) < 2:
        return np.zeros(0)
    share = np.add.reduceat(weight * good, first[:-1]) / np.add.reduceat(weight, first[:-1])
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def train(features: np.ndarray, length: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Model:
    """Penalised maximum likelihood of the documents' labels by Adam; both classes weigh the same, so that rare bad documents count."""
    if len(label) == 0:
        return Model(None, None)
    if len(set(label.tolist())) < 2:
        return Model(None, None, share=float(label.mean()))
    chains = Chains(first)
    sizes = np.diff(first)
    good = label == 1
    weight = np.where(good, 0.5 / good.sum() / sizes, 0.5 / (~good).sum())  # a good text counts by its mean line, a bad one as one event
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    right = np.flatnonzero(inner)
    left = right - 1
    doc = np.repeat(np.arange(len(label)), sizes)
    p = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, t = p[:N_FEATURES], p[N_FEATURES:].reshape(2, 2)
        e = (features @ w.astype(features.dtype)).astype(np.float64)
        ahead, back = chains.messages(e, t)
        one = _sigmoid(ahead + back)
        r, s = ahead[left], e[right] + back[right]
        joint = np.stack([np.full(len(r), t[0, 0]), s + t[0, 1], r + t[1, 0], r + s + t[1, 1]], 1)
        joint = np.exp(joint - joint.max(axis=1, keepdims=True))
        joint /= joint.sum(axis=1, keepdims=True)
        # log P(all lines good): the chain rule over neighbours' marginals
        log_one = np.log(np.clip(one, 1e-300, 1))
        log_all = np.add.reduceat(log_one, first[:-1])
        np.add.at(log_all, doc[right], np.log(np.clip(joint[:, 3], 1e-300, 1)) - log_one[left] - log_one[right])
        p_all = np.exp(np.minimum(log_all, -1e-12))
        # d log P(label): good texts pull to the all-good path, bad ones push off it by the odds that it is the path
        pull = weight * np.where(good, 1.0, -p_all / (1 - p_all))
        g_w = (features.T @ (pull[doc] * (1 - one)).astype(features.dtype)).astype(np.float64)
        none = np.zeros(4)
        none[3] = 1
        g_t = (pull[doc[right]][:, None] * (none - joint)).sum(0)
        g = np.concatenate([g_w, g_t]) - 1e-4 * p
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p = p + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    model = Model(p[:N_FEATURES], p[N_FEATURES:].reshape(2, 2))
    x = _log_odds(model.marginals(features, first), length, first)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton on the penalised logistic likelihood
        q = _sigmoid(a * x + b)
        h = q * (1 - q)
        grad = np.array([((label - q) * x).sum() - 0.1 * (a - 1), (label - q).sum() - 0.01 * b])
        hess = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.01]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a + np.clip(da, -1, 1), b + np.clip(db, -2, 2)
    model.curve = (float(max(a, 0.05)), float(b))
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES, most_lines: int = TRAIN_LINES) -> Model:
    """``labels``: the rows to learn from. At most ``most`` keys of them are used, first by hash, with texts of at most ``most_bytes``, as long as
    those have at most ``most_lines`` lines together. The driver holds 92 bytes a line."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(label).cast("int").alias("label"))
    chosen = chosen.orderBy(md5_key("k"), "k").limit(most)
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where(F.octet_length("text") <= most_bytes)
    rows = texts.join(F.broadcast(chosen), "k").groupBy("k").agg(F.min("label").alias("label"), F.min("text").alias("text"))  # at most ``most`` keys
    so_far = F.sum(F.regexp_count("text", F.lit("\n")) + 1).over(Window.orderBy(md5_key("k"), "k"))
    rows = rows.withColumn("lines", so_far).where(F.col("lines") <= most_lines).drop("lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2, BATCH_BYTES):
            f, length, first = line_features(batch.column(2))
            cut = lambda x: [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(cut(f.astype(np.float32)), pa.binary()), pa.array(cut(length), pa.binary())], names=["id", "label", "features", "length"])

    got = sorted((r.id, r.label, bytes(r.features), bytes(r.length)) for r in rows.mapInArrow(run, "id string, label int, features binary, length binary").collect())
    if not got:
        return Model(None, None)
    features = np.concatenate([np.frombuffer(r[2], np.float32).reshape(-1, N_FEATURES) for r in got])
    lengths = [np.frombuffer(r[3], np.int64) for r in got]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lengths])])
    return train(features, np.concatenate(lengths), first, np.array([r[1] for r in got]))


def score_quality(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows without the text, with ``score``: P(label 1)."""
    kept = [c for c in df.columns if c not in (text, "score")]
    rows = df.select(*kept, F.col(text).alias("score"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(kept), BATCH_BYTES):
            score = model.score(batch.column(len(kept)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(run, schema)


def label_lines(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """A row a line: the other columns, line_no from 0, n_bytes, p_good, good."""
    kept = [c for c in df.columns if c not in (text, "line_no", "n_bytes", "p_good", "good")]
    rows = df.select(*kept, F.col(text).alias("good"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("line_no", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("p_good", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(kept), BATCH_BYTES):
            start = 0
            for good, length, first in model.lines(batch.column(len(kept))):
                sizes = np.diff(first)
                row = np.repeat(np.arange(len(sizes)), sizes) + start
                line = np.arange(len(length)) - np.repeat(first[:-1], sizes)
                start += len(sizes)
                for k in range(0, len(length), SLICE_LINES):
                    cut = slice(k, k + SLICE_LINES)
                    yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row[cut])) for c in batch.columns[:-1]], pa.array(line[cut], pa.int64()), pa.array(length[cut], pa.int64()), pa.array(good[cut])], names=schema.names)

    return rows.mapInArrow(run, schema).withColumn("good", F.col("p_good") >= 0.5)


HELD_OUT = (5, 0)
LEAST_SCORE = 0.3


def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: the score of every whole text of ``documents``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(bucket_crc("doc_id", HELD_OUT[0]) != HELD_OUT[1]))
    rows = docs.select("doc_id", F.coalesce(bucket_crc("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False)).alias("held_out"), "text")
    scored = score_quality(rows, model)
    return scored.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
