"""Prefix trie of conversations: nodes of all distinct beginnings, built by first turn, in parts that fit a task.

Conversations are grouped by the digest of their first turn. Groups of at most ``group_turns``
turns are dealt into buckets, and an applyInPandas call builds a bucket's tries
from dictionaries of child pointers, summed up by iterative postorder. A larger group
isn't built: the stretch that all its conversations share becomes a chain of nodes, from counts by
position, and the conversations are grouped anew by the turn that follows. Each such round
is one pass over the larger groups' turns, so there are as many rounds as branchings lie below one another in them, however
long shared beginnings are. Sums of subtrees then go back up, round by round.

Turns are digests and word counts from the beginning; no text is shuffled. A turn's digest is SHA-256,
a group's the first 128 bits of one.

Defined results: null roles and texts are empty, a null turn is before all others, turns of one number are in the
order of their digests, rows of a null conv_id belong to no conversation, a repeated row is a turn of its own, an empty table
has no nodes, not even a root. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmeter.llm.common import WORD, bucket_crc, table, text_of, written
from docmeter.llm.turns import numbered, turn_digest

#: Turns of a group that one task builds; larger groups are cut by their next turn.
GROUP_TURNS = 10_000
#: Positions of a chain that are summed up together.
BLOCK = 4096
#: Characters of a part of a list of ids before it is hashed.
PART_CHARS = 1_000_000
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
EMPTY = hashlib.sha256(b"").hexdigest()


def rebuilt(rows: DataFrame, every: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, pos, digest, words; conversations: conv_id, n), each conversation opened by the first turns of its base.

    The base of c is c - c % every; the first crc32(c) % (most + 1) turns come from it (all it has, if fewer), then c's own after as many.
    """
    rows = rows.where("conv_id is not null").select("conv_id", "turn", turn_digest().alias("digest"), F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("words"))
    own = numbered(rows, ["digest", "words"]).select("conv_id", "pos", "digest", "words", bucket_crc("conv_id", most + 1).alias("head"))
    opening = own.where(f"conv_id % {every} = 0 and pos < {most}").select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    convs = own.groupBy("conv_id", "head").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.expr(f"conv_id - conv_id % {every}"))
    convs = convs.join(opening.groupBy("base").agg(F.count(F.lit(1)).alias("there")), "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    convs = written(convs.select("conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("n")), "conversations")
    first = convs.where("taken > 0").join(opening, "base").where("pos < taken").select("conv_id", "pos", "digest", "words")
    rest = own.where("pos >= head").join(convs.select("conv_id", "taken"), "conv_id").select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "digest", "words")
    return written(first.unionByName(rest), "rebuilt"), convs.select("conv_id", "n")


def child_group(group: str, digest: str) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(group, digest), 256)), 1, 16)


def build_tries(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of a bucket's subtries. rows: grp, parent, above (the smallest member of the node above), conv_id, pos, digest, words."""
    rows = rows.iloc[np.lexsort((rows["pos"].to_numpy(), rows["conv_id"].to_numpy()))]
    child: list[dict[bytes, int]] = []
    up: list[int] = []
    conv, depth, words, n, ends = [], [], [], [], []
    roots: dict[bytes, int] = {}
    known: list[tuple[bytes, int]] = []  # of each root: its parent group and the member above

    def node(parent: int, c: int, at: int, w: int) -> int:
        child.append({})
        for column, value in ((up, parent), (conv, c), (depth, at), (words, w), (n, 0), (ends, [])):
            column.append(value)
        return len(up) - 1

    last, now = None, -1
    for group, parent, above, c, pos, digest, w in rows[["grp", "parent", "above", "conv_id", "pos", "digest", "words"]].itertuples(index=False, name=None):
        if c != last:
            if now >= 0:
                ends[now].append(last)
            last, now = c, -1
            pointers = roots
            digest = group  # a group's conversations share the turn that it begins with
        else:
            pointers = child[now]
        found = pointers.get(digest)
        if found is None:
            found = pointers[digest] = node(now, c, pos + 1, w)
            if now < 0:
                known.append((parent, above))
        now = found
        n[now] += 1
    if now >= 0:
        ends[now].append(last)
    leaves, saved = [0] * len(up), [0] * len(up)
    for root in roots.values():
        stack = [(root, iter(child[root].values()))]
        while stack:
            at, below = stack[-1]
            nxt = next(below, None)
            if nxt is not None:
                stack.append((nxt, iter(child[nxt].values())))
                continue
            stack.pop()
            leaves[at] = leaves[at] or 1
            saved[at] += (n[at] - 1) * words[at]
            if stack:
                leaves[stack[-1][0]] += leaves[at]
                saved[stack[-1][0]] += saved[at]
    top = dict(zip(roots.values(), known, strict=True))
    return pd.DataFrame(
        {
            "conv_id": conv,
            "depth": depth,
            "parent_conv_id": [top[k][1] if k in top else conv[up[k]] for k in range(len(up))],
            "n_convs": n,
            "n_children": [len(x) for x in child],
            "n_leaves": leaves,
            "saved_tokens": saved,
            "ends_sha256": [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() if x else EMPTY for x in ends],
            "parent": [top[k][0] if k in top else None for k in range(len(up))],
        }
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows grp, conv_id, as comma-joined parts of a list: grp, first id, part."""
    names = ["grp", "first_id", "part"]
    for batch in batches:
        group, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        start = 0
        while start < len(ids):
            stop, size = start, 0
            while stop < len(ids) and group[stop] == group[start] and size < PART_CHARS:
                size += len(str(ids[stop])) + 1
                stop += 1
            yield pa.RecordBatch.from_arrays([pa.array([group[start]], pa.binary()), pa.array([ids[start]], pa.int64()), pa.array([",".join(map(str, ids[start:stop]))])], names=names)
            start = stop


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each group's parts in order; holds a state and a part."""
    now, state, out = None, None, []
    names = ["grp", "ends_sha256"]

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.binary()), pa.array([s for _, s in out], pa.string())], names=names)

    for batch in batches:
        for group, part in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            if state is None or group != now:
                if state is not None:
                    out.append((now, state.hexdigest()))
                now, state = group, hashlib.sha256()
            else:
                state.update(b",")
            state.update(part.as_buffer())
    if state is not None:
        out.append((now, state.hexdigest()))
    yield done()


def hashed_ids(ended: DataFrame) -> DataFrame:
    """grp, ends_sha256 of each group's conv_id in ascending order, comma-joined.

    The list is cut by ranges and joined in parts; only parts, a thousandth of the rows, meet in the order that a hash needs.
    """
    parts = ended.repartitionByRange("grp", "conv_id").sortWithinPartitions("grp", "conv_id").mapInArrow(_joined, "grp binary, first_id long, part string")
    return parts.repartition("grp").sortWithinPartitions("grp", "first_id").mapInArrow(_hashed, "grp binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """All nodes. turns: conv_id, pos (gapless from 0), digest, words; convs: conv_id, n (turns of it, 0 too). Both are read many times: write them first."""
    none = F.lit(b"")
    # cut: groups that are not built in one task, with the stretch that all their conversations share, at first the root's, which is empty
    cut = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first")).where("n_convs > 0")
    cut = written(cut.select(none.alias("grp"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("above"), "n_convs", "first", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("shared")), "cut")
    open_turns, open_convs = turns.withColumn("grp", none), convs.withColumn("grp", none)
    cuts, chains, ended, small = [cut], [], [], []
    while True:
        at = cut.select(F.col("grp").alias("parent"), "shared", F.col("first").alias("above"))
        ours = open_convs.withColumnRenamed("grp", "parent").join(at, "parent")
        ended.append(ours.where("n = shared").select(F.col("parent").alias("grp"), "conv_id"))
        ours = ours.where("n > shared")
        heads = open_turns.withColumnRenamed("grp", "parent").join(at.select("parent", "shared"), "parent").where("pos = shared").select("conv_id", child_group("parent", "digest").alias("grp"))
        ours = written(ours.join(heads, "conv_id"), "members")
        sizes = ours.groupBy("grp").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first"), F.sum(F.col("n") - F.col("shared")).alias("turns"), F.first("parent").alias("parent"), F.first("above").alias("above"), F.first("shared").alias("start"))
        large = written(sizes.where(f"turns > {group_turns}").drop("turns"), "large")
        below = open_turns.select("conv_id", "pos", "digest", "words").join(ours.join(large.select("grp", F.lit(True).alias("large")), "grp", "left"), "conv_id").where("pos >= shared")
        if large.isEmpty():
            small.append(below)
            break
        below = written(below.select("conv_id", "pos", "digest", "words", "grp", "parent", "above", F.coalesce("large", F.lit(False)).alias("large")), "turns-below")
        small.append(below.where("not large"))
        open_turns = below.where("large").select("conv_id", "pos", "digest", "words", "grp")
        open_convs = ours.join(large.select("grp"), "grp").select("conv_id", "n", "grp")
        places = open_turns.groupBy("grp", "pos").agg(F.count(F.lit(1)).alias("k"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.max("words").alias("words"))
        places = written(places.join(large.select("grp", "n_convs"), "grp").select("grp", "pos", "words", ((F.col("k") == F.col("n_convs")) & (F.col("low") == F.col("high"))).alias("alike")), "places")
        shared = places.groupBy("grp").agg(F.coalesce(F.min(F.when(~F.col("alike"), F.col("pos"))), F.max("pos") + 1).alias("shared"))
        cut = written(large.join(shared, "grp").select(*cut.columns), "cut")
        cuts.append(cut)
        chains.append(places.join(cut.select("grp", "shared", "n_convs"), "grp").where("pos < shared").select("grp", "pos", ((F.col("n_convs") - 1) * F.col("words")).alias("own")))

    rows = reduce(DataFrame.unionByName, [s.select("grp", "parent", "above", "conv_id", "pos", "digest", "words") for s in small])
    total = turns.count()
    buckets = max(1, -(-total // group_turns))
    built = rows.withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets))).groupBy("bucket").applyInPandas(lambda pdf: build_tries(pdf), NODES + ", parent binary")
    built = written(built, "small-tries")
    sums = written(built.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")), "sums")

    # up again: what lies below each cut group, and its own chain's sum
    own = {k: chain.groupBy("grp").agg(F.sum("own").alias("own")) for k, chain in enumerate(chains, 1)}
    totals: list[DataFrame] = []
    for k in range(len(cuts) - 1, -1, -1):
        if totals:
            sums = sums.unionByName(totals[-1].groupBy("parent").agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum(F.col("saved") + F.col("own")).alias("saved")))
        below = sums.join(cuts[k].select(F.col("grp").alias("parent")), "parent").groupBy("parent").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]).withColumnRenamed("parent", "grp")
        out = cuts[k].join(below, "grp", "left")
        out = out.join(own[k], "grp", "left") if k else out.withColumn("own", F.lit(0).cast("long"))
        zero = F.lit(0).cast("long")
        totals.append(written(out.select(*cut.columns, F.coalesce("children", zero).alias("children"), F.coalesce("leaves", zero + 1).alias("leaves"), F.coalesce("saved", zero).alias("saved"), F.coalesce("own", zero).alias("own")), "totals"))

    upper = reduce(DataFrame.unionByName, totals)
    ends = hashed_ids(reduce(DataFrame.unionByName, ended))
    upper = written(upper.join(ends, "grp", "left"), "upper")
    root = upper.where("parent is null").select("grp", F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("after"))
    places = reduce(DataFrame.unionByName, [root, *[_sums_from_here(c) for c in chains]])
    ends_here = F.col("pos") + 1 == F.col("shared")
    nodes = places.join(upper, "grp").select(
        F.col("first").alias("conv_id"),
        (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") == F.col("start"), F.col("above")).when(F.col("pos") >= 0, F.col("first")).alias("parent_conv_id"),
        "n_convs",
        F.when(ends_here, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.col("after")).alias("saved_tokens"),
        F.when(ends_here, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )
    return nodes.unionByName(built.drop("parent"))


def _sums_from_here(chain: DataFrame) -> DataFrame:
    """grp, pos, after: the chain's sum of ``own`` from each position to its end, by blocks, so that no task has a whole chain."""
    chain = chain.withColumn("block", F.expr(f"pos div {BLOCK}"))
    on = Window.partitionBy("grp").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = chain.groupBy("grp", "block").agg(F.sum("own").alias("of_block"))
    blocks = blocks.select("grp", "block", F.coalesce(F.sum("of_block").over(on), F.lit(0)).alias("later"))
    inside = Window.partitionBy("grp", "block").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    return chain.join(blocks, ["grp", "block"]).select("grp", "pos", (F.sum("own").over(inside) + F.col("later")).alias("after"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: the trie of all rebuilt ``conversations``."""
    turns, convs = rebuilt(table(spark, sf_dir, "conversations"))
    return prefix_trie(turns, convs)
