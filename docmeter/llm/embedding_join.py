"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors x, y have cosine >= c exactly when |x - y|^2 <= 2 (1 - c). A fixed
random rotation spreads that distance over all coordinates; these are cut into
``BLOCKS`` blocks, each with its share of the squared-distance budget. A pair
within the whole budget is within its share in at least one block, so the union of
the blocks' range joins misses none. A block's range join lays a grid as wide as the
block's radius over its first ``GRID`` coordinates: vectors within the radius stand
in cells at most one apart in each. Cells, in order, make chunks of about
``CHUNK`` vectors (a fuller cell is dealt into several by hash); chunks whose boxes are at
most one cell apart meet, and a task gets two chunks, so it never grows with a
cell. Pairs within a block's budget are then verified on the given vectors in double
precision. A linked pair counts in the first block whose budget it meets, so once.

Equal vectors (same label) are one class with a count, joined once. Tasks emit link
counts per class, a spanning forest, never pairs, so a dense group of n classes
yields O(n) rows a task, and how many pairs they tested in the block.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label, link with nothing. Vectors of
different lengths don't link. Repeated rows are vectors of their own. Columns
other than id, vector and label are not used.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmeter.llm.common import small, table, written
from docmeter.llm.components import Forest, connected_components
from docmeter.llm.jaccard_join import sides_of

BLOCKS = 8
GRID = 4
CHUNK = 2000
TILE = 256
COSINE = 0.93
_SLACK = 1e-9


@functools.lru_cache(maxsize=8)
def rotation(dimension: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20240 + dimension).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


class Geometry:
    """Blocks and budgets for vectors of one length."""

    def __init__(self, dimension: int, cosine: float, blocks: int = BLOCKS):
        blocks = min(blocks, dimension)
        edges = np.linspace(0, dimension, blocks + 1).round().astype(int)
        self.parts = list(zip(edges[:-1], edges[1:], strict=True))
        share = np.diff(edges) / dimension
        self.budget = 2 * (1 - cosine) * share + _SLACK
        self.width = np.sqrt(self.budget) * (1 + _SLACK)
        self.turn = rotation(dimension)

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated unit vectors; sums run row by row, so a row's result doesn't depend on its neighbours."""
        unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
        return np.einsum("ij,jk->ik", unit, self.turn)

    def cells(self, rotated: np.ndarray) -> np.ndarray:
        """rows x blocks x GRID cell numbers; short blocks have zeros at the end."""
        out = np.zeros((len(rotated), len(self.parts), GRID), np.int32)
        for k, (a, b) in enumerate(self.parts):
            m = min(GRID, b - a)
            out[:, k, :m] = np.floor(rotated[:, a : a + m] / self.width[k])
        return out

    def first_block(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The first block whose budget each pair of rotated rows meets."""
        square = (x - y) ** 2
        met = np.stack([square[:, a:b].sum(axis=1) <= self.budget[k] for k, (a, b) in enumerate(self.parts)], 1)
        return np.where(met.any(1), met.argmax(1), -1)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def with_usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, vector (double), label and whether the row can link at all."""
    v = F.col("vector")
    usable = F.col("label").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    return rows.withColumn("usable", F.coalesce(usable, F.lit(False)))


_CELL = [f"c{i}" for i in range(GRID)]


def placed_vectors(reps: DataFrame, cosine: float) -> DataFrame:
    """rep, label, dim, block and cell of each class in each block."""
    label_type = dict(reps.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                dims = batch.column(2).to_numpy()
                for d in np.unique(dims):
                    at = np.flatnonzero(dims == d)
                    geo = Geometry(int(d), cosine)
                    cells = geo.cells(geo.rotated(_matrix(batch.column(3).take(pa.array(at)), int(d))))
                    blocks = cells.shape[1]
                    row = pa.array(np.repeat(at, blocks))
                    number = pa.array(np.tile(np.arange(blocks, dtype=np.int32), len(at)))
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).take(row) for k in range(3)], number, *[pa.array(cells[:, :, i].ravel()) for i in range(GRID)]], names=["rep", "label", "dim", "block", *_CELL])

    return reps.select("rep", "label", "dim", "vector").mapInArrow(run, f"rep long, label {label_type}, dim int, block int, {', '.join(f'{c} int' for c in _CELL)}")


def chunked(placed: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(rep, block, chunk of each placed class, chunk, task, side of chunks that meet): sides 0 and 1 of two, 2 of one with itself."""
    where = ["label", "dim", "block"]
    counts = placed.groupBy(*where, *_CELL).count()
    before = Window.partitionBy(*where).orderBy(*_CELL).rowsBetween(Window.unboundedPreceding, -1)  # of a block's cells, whose number the grid bounds
    light = F.when(F.col("count") <= chunk, F.col("count")).otherwise(0)
    counts = counts.withColumn("run", F.floor(F.coalesce(F.sum(light).over(before), F.lit(0)) / chunk)).withColumn("t", F.when(F.col("count") > chunk, F.ceil(F.col("count") / chunk)).cast("int"))
    cells = written(counts.select(*where, *_CELL, "run", "t"), "vector-cells")

    def name(h: Column) -> Column:
        return F.when(F.col("t").isNull(), F.xxhash64(*where, "run")).otherwise(F.xxhash64(*where, *_CELL, h.cast("int"), F.lit("full")))

    own = placed.join(small(cells), [*where, *_CELL]).select("rep", "block", name(F.pmod(F.xxhash64("rep"), F.col("t"))).alias("chunk"))
    boxes = cells.withColumn("h", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("t"), F.lit(1)) - 1))).groupBy(*where, name(F.col("h")).alias("chunk"))
    boxes = written(boxes.agg(*[F.min(c).alias(f"lo_{c}") for c in _CELL], *[F.max(c).alias(f"hi_{c}") for c in _CELL]), "vector-chunks")
    lead = _CELL[0]
    left = boxes.withColumn("lead", F.explode(F.sequence(F.col(f"lo_{lead}"), F.col(f"hi_{lead}") + 1)))
    right = boxes.select(*where, F.col("chunk").alias("other"), *[F.col(f"{e}_{c}").alias(f"{e}2_{c}") for c in _CELL for e in ("lo", "hi")])
    right = right.withColumn("lead", F.explode(F.sequence(F.col(f"lo2_{lead}"), F.col(f"hi2_{lead}"))))
    meet = left.join(right, [*where, "lead"])
    for c in _CELL[1:]:
        meet = meet.where((F.col(f"lo_{c}") <= F.col(f"hi2_{c}") + 1) & (F.col(f"lo2_{c}") <= F.col(f"hi_{c}") + 1))
    meet = meet.select(F.least("chunk", "other").alias("left"), F.greatest("chunk", "other").alias("right")).distinct()
    return own, written(sides_of(meet).withColumnRenamed("tile", "chunk"), "vector-tasks")


def joined_chunks(cosine: float):
    """Rows (a, b, links) of tasks: link counts have a null b, edges of the forest 0 links, pairs tested in the block two nulls."""

    def emit(a: np.ndarray | None, b: np.ndarray | None, links: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(links), pa.int64())
        return pa.RecordBatch.from_arrays([none if a is None else pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])

    def links(rep: np.ndarray, n: np.ndarray, x: np.ndarray, side: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
        geo = Geometry(x.shape[1], cosine)
        lo, hi = geo.parts[block]
        turned, norm = geo.rotated(x), np.sqrt(np.einsum("ij,ij->i", x, x))
        part = np.ascontiguousarray(turned[:, lo:hi])
        square = np.einsum("ij,ij->i", part, part)
        cell = geo.cells(turned)[:, block]
        own = bool(side[0] == 2)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        # tiles of neighbouring cells, with their boxes
        left, right = (at[np.lexsort(cell[at].T[::-1])] for at in (left, right))
        tiles = [[(at[k : k + TILE], cell[at[k : k + TILE]].min(0), cell[at[k : k + TILE]].max(0)) for k in range(0, len(at), TILE)] for at in (left, right)]
        forest, found = Forest(), np.zeros(len(rep), np.int64)
        edges: list[tuple[int, int]] = []
        tested = 0
        for i, (p, p_lo, p_hi) in enumerate(tiles[0]):
            for j, (q, q_lo, q_hi) in enumerate(tiles[1]):
                if (own and j < i) or (p_lo > q_hi + 1).any() or (q_lo > p_hi + 1).any():
                    continue
                tested += len(p) * (len(p) - 1) // 2 if own and i == j else len(p) * len(q)
                near = square[p][:, None] + square[q][None, :] - 2 * (part[p] @ part[q].T) <= geo.budget[block] + 1e-7  # wider than rounding; first_block decides
                u, v = np.nonzero(np.triu(near, 1) if own and i == j else near)
                for k in range(0, len(u), 32_768):
                    a, b = p[u[k : k + 32_768]], q[v[k : k + 32_768]]
                    cos = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b])
                    a, b = a[cos >= cosine], b[cos >= cosine]
                    mine = geo.first_block(turned[a], turned[b]) == block
                    a, b = a[mine], b[mine]
                    np.add.at(found, a, n[b])
                    np.add.at(found, b, n[a])
                    edges += [e for e in zip(rep[a].tolist(), rep[b].tolist(), strict=True) if forest.join(*e)]
        some = found > 0
        if some.any():
            yield emit(rep[some], None, found[some])
            yield emit(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]), np.zeros(len(edges), np.int64))
        yield emit(None, None, np.array([tested]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Columns: task, side, block, rep, n, dim, vector; a task's rows stand together."""
        held: list[pa.RecordBatch] = []

        def emptied() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            dim = rows.column(5)[0].as_py()
            yield from links(rows.column(3).to_numpy(), rows.column(4).to_numpy(), _matrix(rows.column(6), dim), rows.column(1).to_numpy(), rows.column(2)[0].as_py())

        for batch in batches:
            task = batch.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), len(task)]
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                if held and e > s and held[0].column(0)[0].as_py() != task[s]:
                    yield from emptied()
                if e > s:
                    held.append(batch.slice(s, e - s))
        if held:
            yield from emptied()

    return run


def vector_links(reps: DataFrame, cosine: float, chunk: int) -> DataFrame:
    """Rows (a, b, links) as of ``joined_chunks`` over all classes. reps: rep, label, dim, vector, n."""
    own, sides = chunked(written(placed_vectors(reps, cosine), "placed-vectors"), chunk)
    near = own.join(small(sides), "chunk").select("task", "side", "block", "rep").join(reps.select("rep", "n", "dim", "vector"), "rep")
    near = near.select("task", "side", "block", "rep", "n", "dim", "vector").repartition("task").sortWithinPartitions("task", "rep")
    return written(near.mapInArrow(joined_chunks(cosine), "a long, b long, links long"), "vector-links")


def link_vectors(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label", chunk: int = CHUNK) -> DataFrame:
    """One row a vector: id, n_links, component_id."""
    rows = with_usable(vectors, key, vector, label)
    usable = rows.where("usable").select("id", "label", "vector", F.xxhash64("label", "vector").alias("h"))
    reps = usable.groupBy("h", "label", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    # classes are named by numbers of their own, since ids may repeat or be missing
    reps = written(reps.select("*", F.monotonically_increasing_id().alias("rep"), F.size("vector").alias("dim")), "vector-classes")
    found = vector_links(reps, cosine, chunk)
    parts = connected_components(found.where("b is not null").select("a", "b"))
    links = found.where("a is not null and b is null").groupBy("a").agg(F.sum("links").alias("links"))
    known = reps.join(links, F.col("rep") == links["a"], "left").join(parts, F.col("rep") == parts["node"], "left")
    known = known.select("h", F.col("label").alias("l"), F.col("vector").alias("v"), "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("part"))
    known = known.join(known.groupBy("part").agg(F.min("id").alias("component_id")), "part").drop("id", "part")
    linked = usable.join(known, (usable["h"] == known["h"]) & (usable["label"] == known["l"]) & (usable["vector"] == known["v"])).select("id", "n_links", F.coalesce("component_id", "id").alias("component_id"))
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def op5_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: links and components of all ``embeddings``."""
    linked = link_vectors(table(spark, sf_dir, "embeddings"))
    return linked.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
