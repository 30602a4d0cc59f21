"""Near-duplicate embeddings by randomised-rotation binary codes with stored correction factors.

Equal vectors of a label are one representative first. A representative is rotated at random; the signs are its code,
and the inner product of code and vector is its correction factor. The code of one vector and the rotated other give an
unbiased estimate of their cosine whose error is bounded with the factor: a pair whose upper bound is under the
threshold is dropped, any other is computed anew in double precision, and that alone decides.

Pairs to estimate come from tables keyed by signs under further rotations. The number of signs grows with the largest
label so that a bucket keeps its size, and the number of tables with the signs so that a pair exactly at the threshold
shares a bucket with probability ``RECALL``. A pair is counted in the first table that it shares. Buckets above
``BLOCK`` are split into parts, and every two parts meet in a task of their own; a task returns a row per vector, not
per pair.

Defined results: a vector that is null, zero or has null or non-finite components, or a null label, links with
nothing; neither do vectors of different lengths. Every row gives a row; repeated rows link with each other. An empty table
gives no rows; other input columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import with_columns
from tallystar.llm.components import components, roots
from tallystar.scratch import stage

THRESHOLD = 0.98
RECALL = 0.9999
BUCKET = 64  # vectors that a bucket holds on average
BLOCK = 1024  # vectors of a part of a bucket
DEVIATIONS = 5.0  # of the estimate's error that the bound allows for
SEED = 20240101
PAIRS_AT_ONCE = 1 << 15


@dataclass(frozen=True)
class Plan:
    """Rotations for vectors of one length."""

    length: int
    signs: int  # per table
    tables: int

    @classmethod
    def for_count(cls, length: int, count: int, threshold: float, recall: float = RECALL) -> Plan:
        signs = min(60, max(1, math.ceil(math.log2(max(2, count / BUCKET)))))
        same = (1 - math.acos(threshold) / math.pi) ** signs
        return cls(length, signs, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same))))

    def rotation(self, number: int) -> np.ndarray:
        gauss = np.random.default_rng([SEED, self.length, number]).standard_normal((self.length, self.length))
        q, r = np.linalg.qr(gauss)
        return q * np.sign(np.diag(r))

    @cached_property
    def first(self) -> np.ndarray:
        return self.rotation(0)

    @cached_property
    def key_directions(self) -> np.ndarray:
        wanted = self.signs * self.tables
        return np.hstack([self.rotation(i) for i in range(1, 1 + -(-wanted // self.length))])[:, :wanted]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code bits, correction factor and bucket keys of each vector."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        rotated = unit @ self.first
        factors = np.abs(rotated).sum(axis=1) / math.sqrt(self.length)
        bits = (unit @ self.key_directions > 0).reshape(len(unit), self.tables, self.signs)
        return np.packbits(rotated > 0, axis=1), factors, bits @ (1 << np.arange(self.signs, dtype=np.int64))

    def upper_bounds(self, codes: np.ndarray, factors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Upper bounds of the cosine of each coded vector (rows) with each vector (columns)."""
        signs = np.unpackbits(codes, axis=1, count=self.length) * 2.0 - 1
        rotated = vectors @ self.first / np.linalg.norm(vectors, axis=1, keepdims=True)
        estimates = signs @ rotated.T / (math.sqrt(self.length) * factors[:, None])
        spread = np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(max(1, self.length - 1))
        return estimates + DEVIATIONS * spread[:, None]


def linked(
    plan: Plan, rows: dict[str, np.ndarray], parts: np.ndarray, table: int, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked pairs of one bucket (of two of its parts, if it has several) that no earlier table shares."""
    low, high = parts.min(), parts.max()
    left = np.flatnonzero(parts == low)
    right = left if low == high else np.flatnonzero(parts == high)
    vectors, keys = rows["vectors"], rows["keys"]
    norms = np.linalg.norm(vectors, axis=1)
    step = max(1, PAIRS_AT_ONCE // len(right))
    for start in range(0, len(left), step):
        some = left[start : start + step]
        bounds = plan.upper_bounds(rows["codes"][some], rows["factors"][some], vectors[right])
        i, j = np.nonzero(bounds >= threshold)
        a, b = some[i], right[j]
        if low == high:
            a, b = a[a < b], b[a < b]
        earlier = (keys[a, :table] == keys[b, :table]).any(axis=1)
        a, b = a[~earlier], b[~earlier]
        cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
        yield a[cosine >= threshold], b[cosine >= threshold]


def _links(plans: dict[int, Plan], threshold: float):
    """Per vector of each bucket that has links: ``rep``, ``root`` (of its links there) and ``links``."""

    def bucket(group: tuple, rows: list[dict]) -> pa.RecordBatch | None:
        _, length, table, _, cell = group
        if len(rows) < 2:
            return None
        plan = plans[length]
        data = {
            "vectors": np.array([np.frombuffer(r["vector"]) for r in rows]),
            "codes": np.array([np.frombuffer(r["code"], dtype=np.uint8) for r in rows]),
            "factors": np.array([r["factor"] for r in rows]),
            "keys": np.array([r["keys"] for r in rows]),
        }
        parts = np.array([r["part"] for r in rows])
        if cell != "" and len(set(parts)) < len(set(cell.split("-"))):
            return None
        copies = np.array([r["copies"] for r in rows])
        links, pairs = np.zeros(len(rows), dtype=np.int64), {}
        for a, b in linked(plan, data, parts, table, threshold):
            links += np.bincount(a, copies[b], len(rows)).astype(np.int64)
            links += np.bincount(b, copies[a], len(rows)).astype(np.int64)
            pairs = roots([*pairs.items(), *zip(a.tolist(), b.tolist(), strict=True)])
        if not pairs:
            return None
        reps = [r["rep"] for r in rows]
        lowest: dict[int, int] = {}
        for x, r in pairs.items():
            lowest[r] = min(lowest.get(r, reps[x]), reps[x])
        found = sorted(pairs)
        return pa.RecordBatch.from_pydict(
            {
                "rep": pa.array([reps[x] for x in found], pa.int64()),
                "root": pa.array([lowest[pairs[x]] for x in found], pa.int64()),
                "links": pa.array(links[found], pa.int64()),
            }
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        names = ("label", "length", "table", "key", "cell")
        for group, own in groupby(rows, key=lambda r: tuple(r[n] for n in names)):
            found = bucket(group, list(own))
            if found is not None:
                yield found

    return work


def near_duplicates(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``df``: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    rows = df.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{embedding}`").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable & F.col("vec_id").isNotNull(), F.lit(False)))
    used = rows.where("usable").drop("usable")
    reps = used.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = stage(reps.withColumn("length", F.size("vector")), "vectors")
    largest = reps.groupBy("length", "label").count().groupBy("length").agg(F.max("count").alias("n"))
    plans = {r["length"]: Plan.for_count(r["length"], r["n"], threshold) for r in largest.collect()}
    coded = stage(_coded(reps, plans), "codes")
    groups = ["label", "length", "table", "key"]
    keyed = coded.select("*", F.posexplode("keys").alias("table", "key"))
    # Most buckets hold a single vector or few; the large ones are listed to be split.
    counts = keyed.groupBy(*groups).count()
    large = stage(counts.where(F.col("count") > BLOCK).withColumnRenamed("count", "size"), "large-buckets")
    parts = F.ceil(F.coalesce("size", F.lit(0)) / BLOCK).cast("int")
    placed = keyed.join(large, groups, "left").withColumn("parts", parts)
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("rep"), F.col("parts"))).otherwise(0).cast("int")
    placed = placed.withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumn("other", other)
    cell = F.concat_ws("-", F.least("part", "other"), F.greatest("part", "other"))
    placed = placed.withColumn("cell", F.when(F.col("parts") > 1, cell).otherwise(""))
    placed = placed.select(*groups, "cell", "part", "rep", "copies", "vector", "code", "factor", "keys")
    placed = placed.repartition(*groups, "cell").sortWithinPartitions(*groups, "cell")
    links = stage(placed.mapInArrow(_links(plans, threshold), "rep long, root long, links long"), "vector-links")
    named = components(links.select("rep", "root")).toDF("rep", "component_id")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links")).join(named, "rep", "left")
    classes = reps.join(counted, "rep", "left").select(
        "label",
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    linked_rows = used.join(classes, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked_rows.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _coded(reps: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """Representatives with their vectors as bytes, code, correction factor and bucket keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column(batch.schema.get_field_index("length")))
            for length in set(lengths.tolist()):
                own = batch.filter(pa.array(lengths == length))
                flat = own.column(own.schema.get_field_index("vector")).flatten()
                vectors = np.array(flat, dtype=np.float64).reshape(-1, length)
                codes, factors, keys = plans[length].encode(vectors)
                yield with_columns(
                    own,
                    vector=pa.array([v.tobytes() for v in vectors], pa.binary()),
                    code=pa.array([c.tobytes() for c in codes], pa.binary()),
                    factor=pa.array(factors),
                    keys=pa.array(keys.tolist(), pa.list_(pa.int64())),
                ).select(["label", "length", "rep", "copies", "vector", "code", "factor", "keys"])

    schema = "label string, length int, rep long, copies long, vector binary, code binary, factor double, keys array<long>"
    return reps.mapInArrow(work, schema)
