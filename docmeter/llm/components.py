"""Connected components: few edges in one task, many by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmeter.llm.common import facts, written

MOST_ROUNDS = 50
#: Edges up to which one task does it, in bounded memory and without rounds.
LOCAL_EDGES = 200_000


class Forest:
    """Union-find over numbers; join tells whether an edge was new, roots are the smallest of their trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written, with a state that changes as they do."""
    h = F.xxhash64("a", "b")
    out = written(edges, "edges", F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 16)).alias("s"))
    found = facts(out)
    return out, (found["rows"], found["x"], found["s"])


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = list(forest.parent)
    for k in range(0, len(nodes), 10_000):
        part = nodes[k : k + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())], names=["node", "component"])


def connected_components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """edges: long columns a, b in any order; nulls and loops are ignored.

    Returns node, component (the smallest node that it reaches) for each node of
    an edge. Up to ``local_edges`` edges, by count, go through one task. Above that,
    large-star and small-star steps alternate until nothing changes; each round is
    written to the shared folder, so lost executors cost no earlier round. No list
    of neighbours is ever gathered: minima are aggregated map-side and joined back,
    and AQE splits hubs in the joins.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a > b").distinct()
    edges, state = _kept(edges)
    if state[0] <= local_edges:
        return written(edges.coalesce(1).mapInArrow(_in_one_task, "node long, component long"), "components")
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("_m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("_m").alias("b"))
        before = state
        edges, state = _kept(small.where("a > b").distinct())
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
