"""Exact Jaccard join of word shingles with set-relation skipping.

Sets are distinct 64-bit hashes of five-word shingles; equal sets (by 128 bits) are one
class. Links are exact on those hashes: a wrong one needs shingles that collide by chance. Prefix filter: under one order of all shingles, sets with Jaccard >= t share one
of the first n - ceil(t n) + 1 of each. The order is by hash, frequent shingles
last: they are counted over all documents first, in the part of each set that
prefixes come from; at most ``MOST_FREQUENT`` of them (a few MB) go to the tasks.
The order changes how many candidates there are, never which pairs link.

Index lists hold (class, size, position), in blocks of one size by position:

* index level: of two blocks within the threshold's reach only the entries up to
  one position each can link; they meet, and the rest of either block is skipped;
* in a list longer than ``long``, the entries of a size step first meet one anchor.
  Classes that link with the anchor, or with what links with it, take over its answer:
  they are one component, and a list of one component is skipped whole;
* answer level: verification derives a set's overlaps from those of a similar set
  already answered, by the shingles in which the two differ.

Lists of one shingle longer than ``LIST_MOST`` are dealt into sublists by a hash of the
class; their anchors meet too. Classes of lists of several components are dealt
into tiles by size step, component and hash; a task gets two tiles, so neither memory nor
work of a task grows with a list. Two tiles of one component, or of sizes too far
apart, never meet. Pairs that positions and sketches allow make families; a task passes on
a spanning forest of them. The families' whole sets are compared tile by tile
again, exactly, on full 64-bit hashes, and a task emits a spanning forest of the links.

Sketches have a bit for each of two to four times as many ranges of hashes as the set
has shingles: whether an odd number of them lies there. The bits that differ are at
most the sets' symmetric difference, so pairs that they put below the threshold go.
Components need no other pairs: a skipped pair is in one component already.

Texts are read in three passes: sizes, digests, sketches and counts; index lists;
sets of candidates (picked by a Bloom filter of bounded size, whose errors only
send a set too many). Postings move as packed arrays, not as rows: a bucket gets a set's name and
size once a task, and 32 bits of a shingle beside the bucket's own; two shingles alike in
these share a list, which makes candidates, never links. Counting sends on what a task finds at least twice, so a shingle in more sets than there are
tasks is always found; one that is missed costs candidates, not links.

Defined results: null or empty texts and texts without words have the empty set
and link with nothing. Rows with a null id take part; the component is the
smallest id that isn't null. Repeated rows are rows of one class. Other columns
are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmeter.llm.arrays import mix64
from docmeter.llm.common import facts, sliced, small, table, written
from docmeter.llm.components import Forest, connected_components
from docmeter.llm.shingles import Blocks, Lately, Names, Sketches, begins, digests, meeting, overlaps, possible, prefix_length, shingle_sets, size_step, sketch

PERCENT = 75
LONG = 16
MOST_FREQUENT = 1 << 20
BATCH_BYTES = 1 << 20
POSTINGS_A_BUCKET = 500_000
#: Entries of one shingle's list that stay together.
LIST_MOST = 20_000
BLOOM_BITS = 1 << 25
#: Whole sets in a tile at most, and shingles; entries of mixed lists in a tile.
TILE, TILE_SHINGLES, LIST_TILE = 500, 500_000, 500
#: Pairs of tiles from lists much alike that stay together, so that a class's sketch is sent once for all of them.
TILES_TOGETHER = 64
#: Keys of lists that are dealt into sublists; other keys are below it.
HOT = np.uint64(1 << 63)
#: Shingles that a counting task holds at most before it sends what it has found twice among them; hash buckets they are counted in.
COUNT_BLOCK, COUNT_BUCKETS = 1_200_000, 1 << 10
#: Of a set, in the order of hashes, the share whose shingles are counted; more than prefixes reach without frequent ones.
COUNTED = 0.4


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix64(hashes) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _packed(buckets: np.ndarray, arrays: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    order = np.argsort(buckets, kind="stable")
    cut = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cut):
        if len(part):
            yield int(buckets[part[0]]), [x[part].tobytes() for x in arrays]


def _table(names: list[str], kinds: list[pa.DataType], **columns: object) -> pa.RecordBatch:
    """A batch of the given columns, the others null."""
    n = len(next(iter(columns.values())))  # type: ignore[arg-type]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names=names)


_FIRST = ["row", "row2", "id", "n", "d1", "d2", "sketch", "bucket", "packed", "times"]
_FIRST_KINDS = [*[pa.int64()] * 6, pa.binary(), pa.int32(), pa.binary(), pa.binary()]


def set_sizes(docs: DataFrame, percent: int, name_bits: int) -> DataFrame:
    """Rows of two kinds: row, row2, id, n, digests, sketch of every row; bucket and shingles found twice or more in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lately, held = Lately(), []

        def counted() -> Iterator[pa.RecordBatch]:
            tokens = np.sort(np.concatenate(held))
            held.clear()
            starts = begins(tokens)
            times = np.diff(np.append(starts, len(tokens))).astype(np.int32)
            tokens, times = tokens[starts[times > 1]], times[times > 1]
            found = list(_packed(_bucket(tokens, COUNT_BUCKETS), [tokens, times])) if len(tokens) else []
            if found:
                yield _table(_FIRST, _FIRST_KINDS, bucket=[b for b, _ in found], packed=[x[0] for _, x in found], times=[x[1] for _, x in found])

        size = 0
        for batch in sliced(batches, 3, BATCH_BYTES):
            sets = shingle_sets(batch.column(3))
            names = [digests(s, name_bits) for s in sets]
            yield _table(_FIRST, _FIRST_KINDS, row=batch.column(0), row2=batch.column(1), id=batch.column(2), n=[len(s) for s in sets], d1=[d[0] for d in names], d2=[d[1] for d in names], sketch=[sketch(s) for s in sets])
            for d, s in zip(names, sets, strict=True):
                if len(s) and lately.new(d[0] ^ d[1]):
                    held.append(s[: int(len(s) * max(COUNTED, 1.2 * (1 - percent / 100))) + 1])
                    size += len(held[-1])
            if size > COUNT_BLOCK:
                yield from counted()
                size = 0
        if held:
            yield from counted()

    return docs.mapInArrow(run, "row long, row2 long, id long, n long, d1 long, d2 long, sketch binary, bucket int, packed binary, times binary")


def frequent_shingles(packed: DataFrame, tasks: int, most: int = MOST_FREQUENT, above: int = LONG) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent of the counted shingles, those in more than ``above`` sets, at most ``most``; and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if parts:
                tokens, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
                often = n > above
                yield pa.RecordBatch.from_arrays([pa.array(tokens[often].astype(np.int64)), pa.array(n[often])], names=["shingle", "n"])

        bucket, parts = None, []
        for batch in batches:
            for i, b in enumerate(batch.column(0).to_pylist()):
                if b != bucket:
                    yield from counted(parts)
                    bucket, parts = b, []
                parts.append((np.frombuffer(batch.column(1)[i].as_py(), np.uint64), np.frombuffer(batch.column(2)[i].as_py(), np.int32)))
        yield from counted(parts)

    dealt = packed.select("bucket", "packed", "times").repartition(tasks, "bucket").sortWithinPartitions("bucket")
    rows = dealt.mapInArrow(run, "shingle long, n long").orderBy(F.desc("n"), "shingle").limit(most).collect()
    found = np.array([(r[0], r[1]) for r in rows], np.int64).reshape(-1, 2)
    tokens = found[:, 0].astype(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found[order, 1]


class Sublists:
    """The lists that are dealt into parts, by their shingles' numbers: -1 for all other shingles, whose lists are one part, 0."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, most: int):
        long = counts > most
        self.tokens, self.parts = tokens[long], -(-counts[long] // most)

    def numbers(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, at, -1)

    def part(self, numbers: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        hot = np.flatnonzero(numbers >= 0)
        out[hot] = mix64(ids[hot].view(np.uint64) + np.uint64(5)) % self.parts[numbers[hot]].astype(np.uint64)
        return out


def _narrow(x: np.ndarray) -> bytes:
    """One or two bytes a number where all fit, else four."""
    return x.astype(f"<u{1 if x.max() < 1 << 8 else 2 if x.max() < 1 << 16 else 4}").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int32)


_POSTINGS = ["bucket", "hot", "keys", "ids", "sizes", "times", "places"]


def pack_postings(sets: list[tuple[np.ndarray, int, int]], sublists: Sublists, buckets: int, key_bits: int = 32) -> pa.RecordBatch:
    """The postings of sets (prefix, name, size) by bucket: 32 bits of each shingle (fewer in tests), or its number if its list is dealt into parts (hot), and its place; each set's name and size once."""
    tokens = np.concatenate([x[0] for x in sets])
    count = [len(x[0]) for x in sets]
    of = np.repeat(np.arange(len(sets)), count)
    ids, sizes = np.array([x[1] for x in sets], np.int64), np.array([x[2] for x in sets], np.int64)
    places = np.concatenate([np.arange(c) for c in count])
    numbers = sublists.numbers(tokens)
    keys = np.where(numbers >= 0, numbers.astype(np.uint64), mix64(tokens) & np.uint64((1 << key_bits) - 1)).astype(np.uint32)  # a bucket comes from the other 32 bits
    dealt = _bucket(tokens + sublists.part(numbers, ids[of]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), buckets).astype(np.int64) * 2 + (numbers >= 0)
    order = np.argsort(dealt, kind="stable")
    rows = []
    for part in np.split(order, np.flatnonzero(np.diff(dealt[order])) + 1):
        first = begins(of[part])
        own = of[part[first]]
        rows.append((int(dealt[part[0]]) // 2, bool(dealt[part[0]] % 2), keys[part].tobytes(), ids[own].tobytes(), _narrow(sizes[own]), _narrow(np.diff(np.append(first, len(part)))), _narrow(places[part])))
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_POSTINGS)


def unpack_postings(bucket: int, hot: bool, keys: bytes, ids: bytes, sizes: bytes, times: bytes, places: bytes) -> list[np.ndarray]:
    """Keys of lists, names, sizes and places of a row of packed postings."""
    n = len(ids) // 8
    times = _wide(times, n)
    lists = np.frombuffer(keys, "<u4").astype(np.uint64) | (HOT if hot else np.uint64(bucket << 32))
    return [lists, np.repeat(np.frombuffer(ids, np.int64), times), np.repeat(_wide(sizes, n), times), _wide(places, len(lists))]


def index_postings(docs: DataFrame, frequent: np.ndarray, sublists: Sublists, names: Names, buckets: int, percent: int, key_bits: int) -> DataFrame:
    """Packed postings of each set's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lately = Lately()
        held: list[tuple[np.ndarray, int, int]] = []
        total = 0
        for batch in sliced(batches, 3, BATCH_BYTES):
            for s in shingle_sets(batch.column(3)):
                if not len(s) or not lately.new(name := names(s)):
                    continue
                p = prefix_length(len(s), percent)
                if len(frequent):
                    often = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                    rare = s[~often]
                    head = rare[:p] if len(rare) >= p else np.concatenate([rare, s[often][: p - len(rare)]])
                else:
                    head = s[:p]
                held.append((head, name, len(s)))
                total += p
            if total > 500_000:
                yield pack_postings(held, sublists, buckets, key_bits)
                held, total = [], 0
        if held:
            yield pack_postings(held, sublists, buckets, key_bits)

    return docs.mapInArrow(run, "bucket int, hot boolean, keys binary, ids binary, sizes binary, times binary, places binary")


_FOUND = ["a", "b", "token", "anchor", "ids", "sizes", "places"]
_FOUND_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]


def candidate_lists(postings: DataFrame, sublists: Sublists, buckets: int, percent: int, long: int) -> DataFrame:
    """Rows (a, b) of candidate pairs, and rows (token, ids, sizes, places) with pieces of long lists, or (anchor) their anchors.

    Long lists have met the anchors of their size steps only, and neighbouring steps' anchors each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def searched(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            tokens, ids, sizes, places = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            order = np.argsort(tokens, kind="stable")
            tokens = tokens[order]
            shared = np.zeros(len(tokens), bool)  # most shingles stand in one set only
            shared[1:] = tokens[1:] == tokens[:-1]
            shared[:-1] |= shared[1:]
            order, tokens = order[shared], tokens[shared]
            ids, sizes, places = ids[order], sizes[order].astype(np.int64), places[order].astype(np.int64)
            part = sublists.part(np.where(tokens >= HOT, tokens ^ HOT, np.uint64(0)).astype(np.int64) - (tokens < HOT), ids)
            order = np.lexsort((ids, places, sizes, part, tokens))
            order = order[begins(tokens[order], part[order], ids[order], sizes[order])]  # copies that other tasks sent
            tokens, part, ids, sizes, places = tokens[order], part[order], ids[order], sizes[order], places[order]
            if not len(tokens):
                return
            starts = begins(tokens, part)
            length = np.diff(np.append(starts, len(tokens)))
            lists = np.repeat(np.arange(len(starts)), length)
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            at = np.flatnonzero(length[lists] <= long)
            for i, j in meeting(Blocks(sizes[at], places[at], lists[at]), None, percent):
                pairs.append((ids[at[i]], ids[at[j]]))
            at = np.flatnonzero(length[lists] > long)
            if len(at):
                step = size_step(sizes[at], percent)
                first = begins(lists[at], step)
                group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
                by_hash = np.lexsort((mix64(ids[at].view(np.uint64)), group))  # mostly the same anchor in all lists of a group
                anchor = at[by_hash[first]]
                i, j = anchor[group], at
                near = np.flatnonzero((lists[anchor][1:] == lists[anchor][:-1]) & (step[first][1:] == step[first][:-1] + 1))
                i, j = np.concatenate([i, anchor[near]]), np.concatenate([j, anchor[near + 1]])
                ok = (i != j) & possible(sizes[i], sizes[j], places[i], places[j], percent)
                pairs.append((ids[i[ok]], ids[j[ok]]))
                several = anchor[tokens[anchor] >= HOT]
                cells = [(at[s:e], False) for s, e in _cuts(lists[at], 10_000)] + [(several[s:e], True) for s, e in _cuts(tokens[several], 10_000)]
                for cell, is_anchor in cells:
                    yield _table(_FOUND, _FOUND_KINDS, token=[int(tokens[cell[0]].astype(np.int64))], anchor=[is_anchor], ids=[ids[cell].tobytes()], sizes=[sizes[cell].tobytes()], places=[places[cell].tobytes()])
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)  # two of a set's shingles may share a key
                if len(both):
                    yield _table(_FOUND, _FOUND_KINDS, a=both[:, 0].copy(), b=both[:, 1].copy())

        bucket, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.column(0)[i].as_py()
                if b != bucket:
                    yield from searched(parts)
                    bucket, parts = b, []
                parts.append(unpack_postings(b, *(batch.column(k)[i].as_py() for k in range(1, 7))))
        yield from searched(parts)

    dealt = postings.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long, token long, anchor boolean, ids binary, sizes binary, places binary")


def _cuts(groups: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Pieces of at most ``most`` entries of one group."""
    edges = [*begins(groups).tolist(), len(groups)]
    return [(k, min(k + most, e)) for s, e in zip(edges[:-1], edges[1:], strict=True) for k in range(s, e, most)]


def opened(lists: DataFrame) -> DataFrame:
    """token, id, size, place of packed pieces of lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes, places = (np.frombuffer(batch.column(k)[i].as_py(), np.int64) for k in (1, 2, 3))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0)[i].as_py(), len(ids))), *[pa.array(x) for x in (ids, sizes, places)]], names=["token", "id", "size", "place"])

    return lists.select("token", "ids", "sizes", "places").mapInArrow(run, "token long, id long, size long, place long")


def _step(size: Column, percent: int) -> Column:
    return F.floor(F.round(F.log(size.cast("double")) / float(np.log(100 / percent)), 9)).cast("int")


def anchor_pairs(anchors: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b): anchors of one shingle's sublists with the first of them by hash, and that with the next size step's."""
    rows = anchors.withColumn("step", _step(F.col("size"), percent)).withColumn("h", F.xxhash64("id"))
    least = rows.groupBy("token", "step").agg(F.min(F.struct("h", "id", "size", "place")).alias("first"))
    least = least.select("token", "step", F.col("first.id").alias("a"), F.col("first.size").alias("size_a"), F.col("first.place").alias("place_a"))
    other = rows.select("token", "step", F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("place").alias("place_b"))
    after = least.select("token", (F.col("step") - 1).alias("step"), F.col("a").alias("b"), F.col("size_a").alias("size_b"), F.col("place_a").alias("place_b"))
    both = least.join(other.unionByName(after), ["token", "step"]).where("a <> b")
    reach = (100 + percent) * F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) >= percent * (F.col("size_a") + F.col("size_b"))
    return both.where(reach).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def tiles_of(members: DataFrame, percent: int, most: int, most_shingles: int = TILE_SHINGLES, like: str = "family") -> tuple[DataFrame, DataFrame]:
    """(members with their tile, pairs of tiles that must meet as left, right, and deal: the same for the same tiles of families alike in ``like``).

    members: family, id, size, part and more. A tile is family, size step, component (part) if it fills a tile
    there (else null) and a hash; two sets that link are at most one size step apart.
    """
    rows = members.withColumn("step", _step(F.col("size"), percent))
    full = F.greatest(F.lit(2), F.least(F.lit(most), F.floor(F.lit(most_shingles) / F.col("size")).cast("int")))
    sizes = rows.groupBy("family", "step", "part").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.min(like).alias("kind")).withColumn("own", F.when(F.col("n") >= full, F.col("part")))
    groups = sizes.groupBy("family", "step", "own").agg(F.sum("n").alias("n"), F.max("size").alias("size"), F.min("kind").alias("kind")).withColumn("t", F.ceil(F.col("n") / full).cast("int"))
    groups = written(groups.select("family", "step", "own", "t", "kind"), "tile-groups")
    rows = rows.join(sizes.select("family", "step", "part", "own"), ["family", "step", "part"])
    g = groups.select(F.col("family").alias("f"), F.col("step").alias("s"), F.col("own").alias("o"), "t")
    rows = rows.join(g, (rows["family"] == g["f"]) & (rows["step"] == g["s"]) & rows["own"].eqNullSafe(g["o"])).drop("f", "s", "o")

    def name(step: str, own: str, number: Column) -> Column:
        return F.xxhash64("family", F.col(step), F.coalesce(F.col(own), F.lit(0)), F.col(own).isNull(), number.cast("int"))

    rows = rows.withColumn("tile", name("step", "own", F.pmod(F.xxhash64("id"), F.col("t")))).drop("step", "own", "t")
    # groups meet first, then their tiles, dealt out anew in between: no key makes all pairs of a family's tiles
    other = groups.select("family", F.col("step").alias("step2"), F.col("own").alias("own2"), F.col("t").alias("t2"))
    meet = groups.withColumn("step2", F.explode(F.array(F.col("step"), F.col("step") + 1))).join(other, ["family", "step2"])
    meet = meet.where("own is null or own2 is null or own <> own2")
    meet = meet.withColumn("h", F.explode(F.sequence(F.lit(0), F.col("t") - 1))).repartition(F.col("family"), F.col("step"), F.col("own"), F.col("h"))
    meet = meet.withColumn("left", name("step", "own", F.col("h"))).withColumn("h2", F.explode(F.sequence(F.lit(0), F.col("t2") - 1)))
    meet = meet.withColumn("right", name("step2", "own2", F.col("h2"))).where("step < step2 or left <= right")
    one, two = F.xxhash64("step", "own", "h"), F.xxhash64("step2", "own2", "h2")
    deal = F.xxhash64("kind", F.least(one, two), F.greatest(one, two))
    return rows, meet.select("left", "right", deal.alias("deal"))


def sides_of(meet: DataFrame) -> DataFrame:
    """tile, task, side (0 and 1 of two tiles that meet, 2 of one that meets itself) and what else the pair has."""
    task = F.xxhash64("left", "right").alias("task")
    side = lambda tile, where, n: meet.where(where).select(F.col(tile).alias("tile"), task, F.lit(n).alias("side"), *[c for c in meet.columns if c not in ("left", "right")])
    return side("left", "left = right", 2).unionByName(side("left", "left <> right", 0)).unionByName(side("right", "left <> right", 1))


def _tasks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[tuple]]:
    """Rows (of the batches' first columns, without the task) of each task in turn; the task comes first."""
    task, held = None, []
    for batch in batches:
        for t, *row in zip(*[batch.column(k).to_pylist() for k in range(columns)], strict=True):
            if t != task and held:
                yield held
                held = []
            task = t
            held.append(tuple(row))
    if held:
        yield held


def mixed_families(lists: DataFrame, classes: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Classes of long lists that may link across components: id, row, size, part, family."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((3, 0), np.int64)  # key, a, b of pairs compared lately: a group's lists are much alike
        forest = Forest()
        for held in _tasks(batches, 7):
            side, ids, sizes, places, part = (np.array([h[k] for h in held], np.int64) for k in range(5))
            marks = Sketches([h[5] for h in held])
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if not len(left) or not len(right):
                continue
            own = side[0] == 2
            blocks = Blocks(sizes[left], places[left])
            for i, j in meeting(blocks, None if own else Blocks(sizes[right], places[right]), percent):
                i, j = left[i], right[j]
                a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
                key = (mix64(a.view(np.uint64) * np.uint64(3)) ^ b.view(np.uint64)).view(np.int64)
                at = np.minimum(np.searchsorted(seen[0], key), max(0, seen.shape[1] - 1))
                met = (seen[0][at] == key) & (seen[1][at] == a) & (seen[2][at] == b) if seen.shape[1] else np.zeros(len(key), bool)
                use = np.flatnonzero(~met & (part[i] != part[j]))
                i, j, a, b, key = i[use], j[use], a[use], b[use], key[use]
                if not len(key):
                    continue
                more = np.stack([key, a, b])
                seen = np.concatenate([seen, more], 1) if seen.shape[1] < 2_000_000 else more
                seen = seen[:, np.argsort(seen[0], kind="stable")]
                found = np.flatnonzero(~marks.far(i, j, sizes[i] + sizes[j], percent))
                edges = [e for e in zip(a[found].tolist(), b[found].tolist(), strict=True) if forest.join(*e)]
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array([e[n] for e in edges], pa.int64()) for n in (0, 1)], names=["a", "b"])

    entries = opened(lists).join(parts, F.col("id") == parts["node"], "left").select("token", "id", "size", "place", F.coalesce("component", "id").alias("part"))
    entries = written(entries, "long-lists")
    # lists of the same classes mostly have the same least class by hash
    mixed = entries.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min(F.xxhash64("id")).alias("least")).where("lo <> hi").select("token", "least")
    entries = entries.join(mixed, "token")
    met = written(entries.select(F.col("id").alias("name")).distinct(), "list-names")
    known = classes.join(small(met), "name", "left_semi").select(F.col("name").alias("id"), "sketch")
    placed, meet = tiles_of(entries.withColumnRenamed("token", "family"), percent, LIST_TILE, like="least")
    many = meet.groupBy("deal").agg(F.ceil(F.count(F.lit(1)) / TILES_TOGETHER).alias("shares"))
    meet = meet.join(many, "deal").withColumn("deal", F.xxhash64("deal", F.pmod(F.xxhash64("left", "right"), F.col("shares")))).drop("shares")
    placed = placed.join(written(sides_of(meet), "list-tiles"), "tile").join(known, "id")
    placed = placed.select("task", "side", "id", "size", "place", "part", "sketch", "deal").repartition("deal").sortWithinPartitions("deal", "task", "size", "place", "id")
    families = connected_components(placed.mapInArrow(near, "a long, b long"))
    members = classes.join(families, F.col("name") == families["node"]).select(F.col("name").alias("id"), "row", F.col("n").alias("size"), F.col("component").alias("family"))
    return members.join(parts, members["id"] == parts["node"], "left").select("id", "row", "size", F.coalesce(parts["component"], "id").alias("part"), "family")


def links_of(docs: DataFrame, places: DataFrame, names: Names, percent: int) -> DataFrame:
    """Links (a, b) between parts that meet in a task, enough of them to join what any link joins. places: r, id, task, side, part, size."""
    work = whole_sets(docs, places.select("r").distinct(), names).join(small(places), ["r", "id"])
    work = work.select("task", "side", "part", "id", "size", "s").repartition("task").sortWithinPartitions("task", "side", "part", "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tasks(batches, 6):
            held = [h for k, h in enumerate(rows) if not k or h[:3] != rows[k - 1][:3]]  # repeated rows send a set twice
            left, right = [h for h in held if h[0] != 1], [h for h in held if h[0] != 0]
            if not left or not right:
                continue
            common = overlaps([np.frombuffer(h[4], np.uint64) for h in left], [np.frombuffer(h[4], np.uint64) for h in right])
            part_a, part_b = (np.array([h[1] for h in side]) for side in (left, right))
            size_a, size_b = (np.array([h[3] for h in side]) for side in (left, right))
            u, v = np.nonzero((100 * common >= percent * (size_a[:, None] + size_b[None, :] - common)) & (part_a[:, None] != part_b[None, :]))
            forest = Forest()
            edges = [(left[i][2], right[j][2]) for i, j in zip(u.tolist(), v.tolist(), strict=True) if forest.join(left[i][1], right[j][1])]
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[n] for e in edges], pa.int64()) for n in (0, 1)], names=["a", "b"])

    return work.mapInArrow(compared, "a long, b long").distinct()


def alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) that their sketches don't rule out, with the row that stands for each (ra, rb) and the sizes (na, nb)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 5000):
                batch = whole.slice(start, 5000)
                n = batch.num_rows
                marks = Sketches(batch.column(4).to_pylist() + batch.column(5).to_pylist())
                far = marks.far(np.arange(n), np.arange(n, 2 * n), batch.column(6).to_numpy() + batch.column(7).to_numpy(), percent)
                yield batch.select([0, 1, 2, 3, 6, 7]).filter(pa.array(~far))

    wanted = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).distinct()
    known = written(classes.join(small(written(wanted, "pair-names")), "name", "left_semi").select("name", F.col("row").alias("r"), F.col("sketch").alias("s"), "n"), "sketches")
    both = pairs.join(known.select(F.col("name").alias("a"), F.col("r").alias("ra"), F.col("s").alias("sa"), F.col("n").alias("na")), "a")
    both = both.join(known.select(F.col("name").alias("b"), F.col("r").alias("rb"), F.col("s").alias("sb"), F.col("n").alias("nb")), "b")
    return both.select("a", "b", "ra", "rb", "sa", "sb", "na", "nb").mapInArrow(run, "a long, b long, ra long, rb long, na long, nb long")


def _bloom(rows: np.ndarray) -> list[np.ndarray]:
    d = rows.astype(np.int64).view(np.uint64)
    return [(mix64(d + np.uint64(k)) & np.uint64(BLOOM_BITS - 1)).astype(np.int64) for k in (1, 2, 3)]


def whole_sets(docs: DataFrame, wanted: DataFrame, names: Names) -> DataFrame:
    """r, id, s: row, name and hashes of the sets of the rows named in ``wanted`` (r) and of few others: texts that a Bloom filter leaves out aren't worked on."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS, bool)
        for batch in batches:
            for at in _bloom(batch.column(0).to_numpy()):
                bits[at] = True
        step = BLOOM_BITS // 16
        for k in range(0, BLOOM_BITS, step):
            if bits[k : k + step].any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.packbits(bits[k : k + step]).tobytes()], pa.binary())], names=["at", "bits"])

    bloom = np.zeros(BLOOM_BITS // 8, np.uint8)
    # 16 pieces of BLOOM_BITS / 128 bytes from each of 8 tasks at most
    for at, piece in wanted.repartition(8, F.pmod(F.hash("r"), F.lit(8))).mapInArrow(marks, "at long, bits binary").toLocalIterator():
        bloom[at // 8 : at // 8 + len(piece)] |= np.frombuffer(bytes(piece), np.uint8)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 3, BATCH_BYTES):
            hit = np.ones(batch.num_rows, bool)
            for at in _bloom(batch.column(0).to_numpy()):
                hit &= (bloom[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            if hit.any():
                chosen = batch.filter(pa.array(hit))
                found = shingle_sets(chosen.column(3))
                yield pa.RecordBatch.from_arrays([chosen.column(0), pa.array([names(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["r", "id", "s"])

    return docs.mapInArrow(sets, "r long, id long, s binary")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, names: Names, percent: int) -> DataFrame:
    """Links (a, b) among candidate pairs, enough of them to join what any link of them joins.

    What pairs connect is a family, cut into tiles by hash. A task gets the sets of two tiles that have a pair
    there, so an anchor's many partners spread over tasks and a set is sent about once a task.
    """
    near = written(alike(pairs, classes, percent), "pairs-alike")
    families = connected_components(near.select("a", "b"))
    ends = near.select(F.col("a").alias("id"), F.col("na").alias("size")).unionByName(near.select(F.col("b").alias("id"), F.col("nb").alias("size"))).distinct()
    members = ends.join(families, F.col("id") == F.col("node")).select("id", "size", "component")
    full = F.greatest(F.lit(2), F.least(F.lit(TILE), F.floor(F.lit(TILE_SHINGLES) / F.max("size")).cast("int")))
    counts = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / full).cast("int").alias("t"))
    tile = F.xxhash64("component", F.pmod(F.xxhash64("id"), F.col("t")).cast("int"))
    tiles = written(members.join(counts, "component").select("id", tile.alias("tile")), "pair-tiles")
    both = near.join(tiles.select(F.col("id").alias("a"), F.col("tile").alias("ta")), "a").join(tiles.select(F.col("id").alias("b"), F.col("tile").alias("tb")), "b")
    task = F.xxhash64(F.least("ta", "tb"), F.greatest("ta", "tb")).alias("task")

    def side(end: str, other: str) -> DataFrame:
        number = F.when(F.col("ta") == F.col("tb"), 2).when(F.col(f"t{end}") < F.col(f"t{other}"), 0).otherwise(1)
        return both.select(F.col(f"r{end}").alias("r"), F.col(end).alias("id"), task, number.alias("side"), F.col(end).alias("part"), F.col(f"n{end}").alias("size"))

    return links_of(docs, written(side("a", "b").unionByName(side("b", "a")).distinct(), "pair-places"), names, percent)


def family_links(docs: DataFrame, members: DataFrame, names: Names, percent: int) -> DataFrame:
    """Links (a, b) between parts of a family. members: id, row, size, part, family."""
    rows, meet = tiles_of(members, percent, TILE)
    places = rows.join(written(sides_of(meet.drop("deal")), "tile-pairs"), "tile").select(F.col("row").alias("r"), "id", "task", "side", "part", "size")
    return links_of(docs, written(places, "places"), names, percent)


def row_hashes(key: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two hashes of a row's id and text, 128 bits together."""
    k, t = F.col(key).cast("long"), F.col(text).cast("string")
    return F.xxhash64(k, t), F.xxhash64(t, k, F.lit(1))


def jaccard_classes(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, long: int = LONG, list_most: int = LIST_MOST, name_bits: int = 64, key_bits: int = 32) -> DataFrame:
    """One row a row of ``df``: row and row2 (two hashes of id and text), id, n_shingles, part (a name of its component; null for empty sets)."""
    row, row2 = row_hashes(key, text)
    docs = df.select(row.alias("row"), row2.alias("row2"), F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    first = written(set_sizes(docs, percent, name_bits), "set-sizes", F.sum("n").alias("shingles"))
    rows = first.where("bucket is null")
    # sets of unlike second digests under one first digest: about n^2 / 2^65 of n sets
    shared = [r[0] for r in rows.groupBy("d1").agg(F.min("d2").alias("lo"), F.max("d2").alias("hi")).where("lo <> hi").select("d1").collect()]
    names = Names(shared, name_bits)
    rows = rows.withColumn("name", F.when(F.col("d1").isin(shared), F.col("d2")).otherwise(F.col("d1")) if shared else F.col("d1"))
    # a row a class, so that copies of a text, however many, meet nothing later
    classes = written(rows.where("n > 0").groupBy("name").agg(F.min("row").alias("row"), F.min("n").alias("n"), F.min("sketch").alias("sketch")), "set-classes")
    shingles = facts(first)["shingles"] or 0
    frequent, counts = frequent_shingles(first.where("bucket is not null"), min(COUNT_BUCKETS, int(shingles // 4_000_000) + 4), above=long)
    sublists = Sublists(frequent, counts, list_most)
    buckets = int(shingles * (1 - percent / 100) / POSTINGS_A_BUCKET) + 1
    found = written(candidate_lists(index_postings(docs, frequent, sublists, names, buckets, percent, key_bits), sublists, buckets, percent, long), "candidates", F.count_if(~F.col("anchor")).alias("mixed"))
    pairs = found.where("a is not null").select("a", "b")
    if len(sublists.tokens):
        pairs = pairs.unionByName(anchor_pairs(opened(found.where("anchor")), percent))
    parts = connected_components(verified(docs, classes, written(pairs.distinct(), "pairs"), names, percent))
    lists = found.where("not anchor")
    if facts(found)["mixed"]:
        members = written(mixed_families(lists, classes, parts, percent), "families")
        if facts(members)["rows"]:
            stars = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
            parts = connected_components(stars.unionByName(family_links(docs, members, names, percent)))
    parts = small(parts)
    named = rows.join(parts, rows["name"] == parts["node"], "left")
    return named.select("row", "row2", "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "name")).alias("part"))


def jaccard_components(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, **options: int) -> DataFrame:
    """One row a row of ``df``: id, n_shingles, component_id."""
    named = jaccard_classes(df, key, text, percent, **options).select("id", "n_shingles", "part")
    named = written(named, "named")
    # only components of several rows need to meet them again
    least = named.where("part is not null").groupBy("part").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return named.join(small(written(least, "least-ids")), "part", "left").select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def op10_jaccard_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: components of the whole ``documents`` table."""
    return jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
