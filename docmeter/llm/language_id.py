"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are byte 3- and 4-grams that don't cross a word's edge but may hold it,
hashed into ``BUCKETS`` rows. A text's embedding is the mean over all subwords of
the whole text. Embeddings and softmax are trained by stochastic gradient descent
in numpy on at most ``TRAIN_ROWS`` labelled keys, the first by hash, with texts of at
most ``TRAIN_BYTES``; of those, one in five isn't trained on and fits the temperature.
With probabilities so calibrated a prediction is rejected if its own is below
``LEAST_PROBABILITY``, where a wrong answer costs more than none. As the model is
linear, prediction looks up the product of embedding and softmax per subword: one
table of BUCKETS x languages goes to the tasks, which work on slices of the bytes.

Defined results: null texts and texts without a letter (Unicode category L) are
``und`` with score 0. Without any labelled row everything is ``und``. Of rows that
repeat a key the least (language, text) is learned from. Repeated rows are predicted
alike. Result columns replace columns of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmeter.llm.arrays import LOWER_BYTE, SPACE_BYTE, flat
from docmeter.llm.common import bucket_crc, md5_key, sliced, table

BUCKETS = 1 << 14
DIMENSION = 16
TRAIN_ROWS = 3000
EPOCHS = 3
#: Few rows are gone through more often, up to so many steps.
LEAST_STEPS = 300
BATCH_BYTES = 1 << 20
#: Bytes of a text that may be learned from; longer ones are left to prediction.
TRAIN_BYTES = 1 << 20
#: Cost of no answer as a share of a wrong one's, taken from 1: the least calibrated probability of an answer.
LEAST_PROBABILITY = 0.4
#: Floats that a slice of a batch may take.
SLICE_FLOATS = 1 << 21
_MAYBE_LETTER = re.compile(r"[^\W\d_]")
_CLEAN = np.where(SPACE_BYTE, np.uint8(32), LOWER_BYTE)


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode category L (numbers like one half or roman eight, which patterns call word characters, aren't)."""
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts of about ``most`` bytes: begin, end, the texts in it, and where they begin in the cut.

    Whole texts share a cut; a longer one is cut from its own start, so sums don't depend on its neighbours.
    """
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    at = 0
    while at < len(full):
        i = full[at]
        if sizes[i] > most:
            for lo in range(int(offsets[i]), int(offsets[i + 1]), most):
                yield lo, min(lo + most, int(offsets[i + 1])), np.array([i]), np.zeros(1, np.int64)
            at += 1
            continue
        end = int(np.searchsorted(offsets[full + 1], offsets[i] + most, side="right"))
        end = at + max(1, int(np.argmax(sizes[full[at:end]] > most)) if (sizes[full[at:end]] > most).any() else end - at)
        texts = full[at:end]
        yield int(offsets[i]), int(offsets[texts[-1] + 1]), texts, offsets[texts] - offsets[i]
        at = end


def subwords(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 3 and 4: the bucket of the n-gram at each byte from lo to hi, and whether it counts."""
    n = hi - lo
    b = _CLEAN[data[lo : min(hi + 3, len(data))]].astype(np.uint32)
    space = b == 32
    at = np.arange(lo, hi)
    texts = np.arange(np.searchsorted(offsets, lo, side="right") - 1, np.searchsorted(offsets, hi))
    last = np.repeat(offsets[texts + 1], np.minimum(offsets[texts + 1], hi) - np.maximum(offsets[texts], lo))
    shift = np.uint32(32 - (buckets.bit_length() - 1))

    def ahead(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, x.dtype)
        part = x[k : k + n]
        out[: len(part)] = part
        return out

    b0, b1, b2, b3, s1, s2 = ahead(b, 0), ahead(b, 1), ahead(b, 2), ahead(b, 3), ahead(space, 1), ahead(space, 2)
    three = b0 * np.uint32(0x9E3779B1) + b1 * np.uint32(0x85EBCA77) + b2 * np.uint32(0xC2B2AE3D)
    four = (three ^ (b3 * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    return [((three >> shift).astype(np.int64), ~s1 & (at + 3 <= last)), ((four >> shift).astype(np.int64), ~(s1 | s2) & (at + 4 <= last))]


def histograms(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text: buckets that occur, and their shares of its subwords."""
    data, offsets = flat(column)
    out = []
    for i in range(len(column)):
        counts = np.zeros(BUCKETS, np.int64)
        for lo in range(offsets[i], offsets[i + 1], SLICE_FLOATS):
            hi = min(lo + SLICE_FLOATS, offsets[i + 1])
            counts += np.bincount(np.concatenate([g[ok] for g, ok in subwords(data, offsets, lo, hi)]), minlength=BUCKETS)
        ids = np.flatnonzero(counts)
        out.append((ids.astype(np.int32), (counts[ids] / max(1, counts.sum())).astype(np.float32)))
    return out


class Model:
    """Table of BUCKETS + 1 rows (the last is 0) by language, the languages, temperature, rejection threshold."""

    def __init__(self, scores: np.ndarray, languages: list[str], temperature: float = 1.0, threshold: float = 0.0):
        self.scores, self.languages, self.temperature, self.threshold = scores, languages, temperature, threshold

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        data, offsets = flat(column)
        n, k = len(offsets) - 1, len(self.languages)
        total, count = np.zeros((n, k)), np.zeros(n)
        for lo, hi, texts, begins in slices(offsets, max(1, SLICE_FLOATS // max(4, k))):
            for grams, ok in subwords(data, offsets, lo, hi):
                total[texts] += np.add.reduceat(self.scores[np.where(ok, grams, BUCKETS)], begins, axis=0)
                count[texts] += np.add.reduceat(ok.astype(np.int64), begins)
        p = self.probabilities(total / np.maximum(count, 1)[:, None]) if k else np.zeros((n, 1))
        best = p.argmax(axis=1)
        score = p[np.arange(n), best]
        names = [self.languages[i] if k else "und" for i in best]
        for i, text in enumerate(column.to_pylist()):
            if text is None or not has_letter(text):
                names[i], score[i] = "und", 0.0
        return names, score


#: Largest norm of a language's weights and size of an embedding's entry: with classes that overlap steps would grow without end.
MOST_NORM = 3.0


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """rows: language, buckets, shares; the order of rows doesn't matter."""
    languages = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    if not languages:
        return Model(np.zeros((BUCKETS + 1, 0), np.float32), [])
    rows = sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    order = rng.permutation(len(rows))
    held = set(order[: len(rows) // 5].tolist())
    fit = [i for i in order.tolist() if i not in held]
    y = np.array([languages.index(r[0]) for r in rows])
    e = rng.normal(0, 1 / DIMENSION, (BUCKETS, DIMENSION))
    w = np.zeros((DIMENSION, len(languages)))
    size, steps = 16, 0
    for _ in range(max(epochs, min(60, LEAST_STEPS * size // max(1, len(fit))))):
        for k in range(0, len(fit), size):
            batch = fit[k : k + size]
            ids = np.concatenate([rows[i][1] for i in batch])
            share = np.concatenate([rows[i][2] for i in batch]).astype(float)
            doc = np.repeat(np.arange(len(batch)), [len(rows[i][1]) for i in batch])
            h = np.stack([np.bincount(doc, share * e[ids, d], len(batch)) for d in range(DIMENSION)], 1)
            z = h @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            rate = 8.0 / (1 + steps / 400)
            back = p @ w.T
            w -= rate * h.T @ p / len(batch)
            w *= min(1.0, MOST_NORM / np.sqrt((w * w).sum(axis=0).max()))
            np.add.at(e, ids, (-rate) * share[:, None] * back[doc])
            e[ids] = np.clip(e[ids], -MOST_NORM, MOST_NORM)
            steps += 1
    scores = np.vstack([e @ w, np.zeros(len(languages))]).astype(np.float32)
    model = Model(scores, languages, threshold=LEAST_PROBABILITY)
    check = sorted(held)
    if check:
        logits = np.stack([rows[i][2].astype(float) @ scores[rows[i][1]] for i in check])
        losses, doubt = [], 1 / (len(check) + 2)  # as if of two more rows one were wrong
        for t in np.geomspace(0.02, 20, 61):
            model.temperature = t
            p = np.log(model.probabilities(logits) + 1e-12)
            losses.append((-((1 - doubt) * p[np.arange(len(check)), y[check]] + doubt * p.mean(axis=1)).mean(), t))
        model.temperature = float(min(losses)[1])
    return model


def fit(df: DataFrame, allowed: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> Model:
    """A model from at most ``most`` keys of the ``allowed`` rows with text (of at most ``most_bytes``) and language, first by the hash of the key."""
    good = allowed & F.col(key).isNotNull() & F.col(lang).isNotNull() & (F.octet_length(text) <= most_bytes)
    rows = df.where(good).select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    keys = rows.select("k").distinct().orderBy(md5_key("k"), "k").limit(most)
    chosen = rows.join(F.broadcast(keys), "k").groupBy("k").agg(F.min(F.struct("lang", "text")).alias("r")).select("r.lang", "r.text")  # at most ``most`` keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, BATCH_BYTES):
            found = histograms(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x, _ in found], pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary())], names=["lang", "ids", "share"])

    got = chosen.mapInArrow(run, "lang string, ids binary, share binary").collect()
    return train([(r[0], np.frombuffer(bytes(r[1]), np.int32), np.frombuffer(bytes(r[2]), np.float32)) for r in got if len(r[1])])


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with lang_pred, score and rejected (und, or a score below the model's threshold)."""
    kept = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]
    fields = df.select(*kept).schema.fields
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at, BATCH_BYTES):
            names, score = model.predict(batch.column(at))
            rejected = pa.array([n == "und" or bool(s < model.threshold) for n, s in zip(names, score, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), rejected], names=[*batch.schema.names, "lang_pred", "score", "rejected"])

    return df.select(*kept).mapInArrow(run, schema)


HELD_OUT = (4, 2)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: the predicted language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(bucket_crc("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    model = fit(docs, ~held)
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
