"""Connected components of a table of links: local union-find on bounded parts, then star rounds until nothing changes.

Each task contracts up to PART_LINKS links to the stars of their trees, so most rounds' work is done where the links lie. Parts are
then joined by alternating large-star and small-star rounds over the whole table. Where all links fit one part the
first contraction is already the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import Tables, in_worker

PART_LINKS = 1 << 20


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the least node of its tree, where that is another."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    p, q = at[: len(a)].tolist(), at[len(a) :].tolist()
    up = list(range(len(nodes)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(p, q, strict=True):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))], np.int64)
    own = roots != np.arange(len(nodes))
    return nodes[own], nodes[roots[own]]


@in_worker
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        u, v = union_find(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        size += b.num_rows
        if size >= 2 * PART_LINKS:
            yield flush()
            size = 0
    if held:
        yield flush()


def _star(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and its other ends; a hot u's rows are split by the adaptive skew join."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.hint("merge").join(least, "u")


def components(links: DataFrame, tables: Tables) -> DataFrame:
    """node, component of every node in ``links`` (a, b: longs); a component's name is its least node."""
    links = links.select("a", "b").where("a <> b")
    n = links.count()
    parts = max(1, -(-n // PART_LINKS))
    edges = tables.cut(links.repartition(parts).mapInArrow(_contract, "u long, v long"))
    before = None
    while parts > 1:
        # Large star: larger neighbours hang on the least one of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = tables.cut(_star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: smaller neighbours and the node itself hang on the least one.
        got = _star(large)
        pairs = F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m"))))
        edges = tables.cut(got.select(pairs.alias("p")).select(F.col("p.u").alias("u"), F.col("p.m").alias("v")).where("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
