"""Packing token pieces into fixed windows by non-negative least squares.

Documents are cut into whole windows, each a sequence of its own, and a
remainder. Remainders are planned block by block (a block is at most
``block_tokens`` tokens or ``BLOCK_ROWS`` remainders of one task, so memory is bounded at any input size and
nothing is shuffled):

1. shallow combinations of two or three lengths of the block's histogram that
   fill the window exactly are enumerated;
2. repeat counts x >= 0 minimise |A x - histogram| by projected gradient steps;
3. counts are rounded so that their running sums are kept, and taken as far as
   the histogram covers them; 1 to 3 repeat on the histogram's rest, ``ROUNDS`` times;
4. what is left is packed greedily, largest first; where nothing fits the gap,
   the next remainder is cut so that the window fills;
5. the block's last window is cut at powers of two, which need no padding.

``made_by`` tells for each piece whether its sequence is a ``whole`` window of one
document, comes from ``counts`` (2 and 3) or from the ``greedy`` rest (4 and 5).

Every id lies in exactly one piece. Plans follow the rows in a task, so other
partitionings give other sequences, all valid. ``sequence_id`` is the partition
number times 2**33 plus a count.

Defined results: null or empty text is the end token alone. Repeated rows are
packed as rows of their own. An empty table gives an empty table.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmeter.llm.common import sliced, table, text_of
from docmeter.llm.tokens import encoder, tokenizer_path

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 12 << 20
BLOCK_ROWS = 200_000
BATCH_BYTES = 4 << 20
#: Partners tried for each length in combinations of three.
PARTNERS = 12
STEPS = 60
ROUNDS = 4


def combinations(lengths: np.ndarray, window: int, partners: int = PARTNERS) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, of present lengths with a + b + c = window; c = 0 for pairs."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    pairs = lengths[present[window - lengths]] if len(lengths) else lengths
    rows = [np.stack([pairs, window - pairs, np.zeros_like(pairs)], 1)]
    if len(lengths):
        for k in range(1, partners + 1):  # b in even steps through the lengths at most half of what a leaves
            room = window - lengths
            upto = np.searchsorted(lengths, room // 2, side="right")
            b = lengths[np.minimum(upto * k // (partners + 1), len(lengths) - 1)]
            c = room - b
            ok = (c >= 1) & (b >= 1) & (b < room)
            ok[ok] = present[c[ok]]
            rows.append(np.stack([lengths[ok], b[ok], c[ok]], 1))
    both = np.sort(np.concatenate(rows), axis=1)[:, ::-1]
    return np.unique(both, axis=0)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|: accelerated projected gradient over the sparse A."""
    if not len(combos):
        return np.zeros(0)
    n = len(histogram)
    used = (combos > 0).astype(float)
    load = np.bincount(combos.ravel(), used.ravel(), n)
    # row sums of A times its largest column sum bound the largest eigenvalue of A'A
    rate = 1.0 / max(1.0, 3.0 * load[1:].max())
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(steps):
        made = np.bincount(combos.ravel(), (used * y[:, None]).ravel(), n)
        miss = made - histogram
        miss[0] = 0.0
        new = np.maximum(0.0, y - rate * miss[combos].sum(1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def rounded(x: np.ndarray) -> np.ndarray:
    """Whole counts whose running sums stay within one half of those of ``x``: many small counts don't all become 0."""
    return np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0.0).astype(np.int64)


def plan(lengths: np.ndarray, window: int = WINDOW) -> tuple[list[list[tuple[int, int, int]]], int]:
    """Sequences as lists of (item, start in the item, length), and how many of them, the first, come from repeat counts.

    Items are positions in ``lengths`` (1 to window - 1).
    """
    order = np.argsort(lengths, kind="stable")
    histogram = np.bincount(lengths, minlength=window + 1)
    ends = np.cumsum(histogram)
    at = ends - histogram  # next item of each length, in ``order``
    sequences: list[list[tuple[int, int, int]]] = []

    for _ in range(ROUNDS):
        rest = ends - at
        combos = combinations(np.flatnonzero(rest), window)
        before = len(sequences)
        for parts, repeats in zip(combos.tolist(), rounded(repeat_counts(combos, rest.astype(float))).tolist(), strict=True):
            parts = [v for v in parts if v]
            while repeats and all(ends[v] - at[v] >= parts.count(v) for v in parts):
                one = []
                for v in parts:
                    one.append((int(order[at[v]]), 0, v))
                    at[v] += 1
                sequences.append(one)
                repeats -= 1
        if len(sequences) == before:
            break
    present = np.flatnonzero(ends - at)
    counted = len(sequences)
    # greedy: pieces left, ascending (length, item, start)
    left = [(int(v), int(order[i]), 0) for v in present for i in range(at[v], ends[v])]
    while left:
        room, one = window, []
        while room and left:
            i = bisect.bisect_right(left, (room, 1 << 62, 0)) - 1
            if i < 0:  # nothing fits: cut the smallest that is left
                size, item, start = left.pop(0)
                one.append((item, start, room))
                bisect.insort(left, (size - room, item, start + room))
                room = 0
            else:
                size, item, start = left.pop(i)
                one.append((item, start, size))
                room -= size
        if room:
            sequences += _at_powers(one)
        else:
            sequences.append(one)
    return sequences, counted


def _at_powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces as sequences whose lengths are powers of two, largest first."""
    total, out, queue = sum(p[2] for p in pieces), [], list(pieces)
    while total:
        want = 1 << (total.bit_length() - 1)
        total -= want
        one = []
        while want:
            item, start, size = queue.pop(0)
            part = min(size, want)
            one.append((item, start, part))
            if part < size:
                queue.insert(0, (item, start + part, size - part))
            want -= part
        out.append(one)
    return out


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row a piece: key, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit), made_by."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    rows = df.select(F.col(key), text_of(text).alias("ids"))
    schema = T.StructType([rows.schema.fields[0], *[T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")], T.StructField("ids", T.BinaryType()), T.StructField("made_by", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        base = TaskContext.get().partitionId() << 33
        made = 0
        names = [f.name for f in schema.fields]
        keys: list = []  # of the block's remainders
        starts: list[int] = []
        totals: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def batch_of(columns: list[list], kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 5, pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def planned(kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal made, held
            out: list[list] = [[] for _ in names]
            sequences, counted = plan(np.fromiter(map(len, parts), np.int64, len(parts)), window)
            for number, one in enumerate(sequences):
                offset, how = 0, "counts" if number < counted else "greedy"
                for item, start, size in one:
                    row = (keys[item], starts[item] + start, size, totals[item], base + made, offset, parts[item][start : start + size].tobytes(), how)
                    for c, v in zip(out, row, strict=True):
                        c.append(v)
                    offset += size
                made += 1
                if len(out[0]) >= 2000:
                    yield batch_of(out, kind)
                    out = [[] for _ in names]
            if out[0]:
                yield batch_of(out, kind)
            for x in (keys, starts, totals, parts):
                x.clear()
            held = 0

        kind = None
        for batch in sliced(batches, 1, batch_bytes):
            kind = batch.schema.field(0).type
            whole: list[list] = [[] for _ in names]
            for k, ids in zip(batch.column(0).to_pylist(), encode.ids(batch.column(1).to_pylist()), strict=True):
                data = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                full = len(data) // window * window
                for start in range(0, full, window):
                    for c, v in zip(whole, (k, start, window, len(data), base + made, 0, data[start : start + window].tobytes(), "whole"), strict=True):
                        c.append(v)
                    made += 1
                if full < len(data):
                    keys.append(k)
                    starts.append(full)
                    totals.append(len(data))
                    parts.append(data[full:].copy())
                    held += len(data) - full
            if whole[0]:
                yield batch_of(whole, kind)
            if held >= block_tokens or len(parts) >= BLOCK_ROWS:
                yield from planned(kind)
        if parts:
            yield from planned(kind)

    return rows.mapInArrow(run, schema)


def pieces_digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns of packed pieces."""
    return pieces.select(key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "made_by")


def op1_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: all ``documents`` packed into windows of 2048."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces_digest(pack(docs, tokenizer_path()))
