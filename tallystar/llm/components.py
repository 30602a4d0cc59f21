"""Connected components of links, each named by its smallest member.

Tasks first turn the links they hold into stars of their own (union-find over a bounded number of links). Then two
steps alternate until nothing changes: every node's larger neighbours are linked to its smallest neighbour, then every
node and its smaller neighbours are. Each round is written to the shared folder, so its lineage is one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.scratch import stage

HELD_LINKS = 200_000  # that a task turns into stars at once


def roots(links: Iterable[tuple[int, int]]) -> dict[int, int]:
    """The smallest member of each node's component."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []

    def emit() -> pa.RecordBatch:
        found = [(x, r) for x, r in roots(held).items() if x != r]
        held.clear()
        return pa.RecordBatch.from_pydict(
            {"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())}
        )

    for batch in batches:
        held.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        if len(held) >= HELD_LINKS:
            yield emit()
    if held:
        yield emit()


def _towards_smallest(links: DataFrame) -> DataFrame:
    """Links (a, b) with a > b, after one large and one small step."""
    both = links.union(links.select("b", "a")).toDF("x", "y")
    nearest = both.groupBy("x").agg(F.min("y").alias("m"))
    large = both.join(nearest, "x").where("y > x").select(F.col("y").alias("a"), F.least("x", "m").alias("b"))
    large = large.distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    small = small.select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("s"))
    return small.select(F.col("s.a").alias("a"), F.col("s.m").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` has two long columns. Returns ``node`` and ``component`` for every node of a link between two nodes."""
    now = links.toDF("a", "b").where("a <> b").mapInArrow(_stars, "a long, b long")
    now = stage(now.distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before, now = state, stage(_towards_smallest(now), "links")
    smallest = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(smallest)
