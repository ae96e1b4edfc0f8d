"""Exact k-means in whole numbers, with clusters as balls.

Vectors are kept in blocks, one row each, that hold their vectors, the cluster
of each from the round before, and the sums that the next centroids need. A
round reads the blocks, assigns every vector and writes the blocks anew; the
driver sees only sums of k clusters. Nothing is shuffled by cluster, so a
cluster with most of the vectors is no burden to any task.

A round knows the squared distance of each vector to its own centroid. The
members of a cluster are a ball around it: a centroid that lies at twice the
ball's radius or farther is no neighbour, and is compared with none of them.
Neighbours, sorted by their distance from the ball's centre, cut it into a
core, whose members stay, and rings: a member of the t-th ring is compared
with the first t neighbours and no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import bound_batches, cut, drop


@dataclass(frozen=True)
class Settings:
    clusters: int = 8
    rounds: int = 10
    dimensions: int = 64
    #: Components are floor(scale * x).
    scale: int = 1024
    #: Centroids start as the vectors whose hash of ``seed:id`` is least.
    seed: int = 3
    #: Vectors of a block.
    block: int = 1024

    @property
    def largest(self) -> int:
        """Components below this have squared distances within 64 bits."""
        return isqrt(((1 << 63) - 1) // self.dimensions) // 2


def is_usable(vector: Column, settings: Settings) -> Column:
    """Whether a vector has the right number of components, none of them null, not finite, or too large to be squared."""
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * settings.scale) < float(settings.largest), F.lit(False)))  # NaN is larger than all
    return F.coalesce((F.size(vector) == settings.dimensions) & fits, F.lit(False))


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale).astype(np.int64)


def assign(points: np.ndarray, before: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, comparisons): the nearest centre of each point, of several the one with the least number.

    ``before`` is any assignment; the nearer it is to the truth, the fewer
    comparisons are made. A centre j can win a member of ball i, or draw, only
    if it lies within twice the member's distance from i.
    """
    between = ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    own = ((points - centres[before]) ** 2).sum(axis=1)
    best, gap, compared = before.copy(), own.copy(), len(points)
    for i in np.unique(before):
        members = np.flatnonzero(before == i)
        limits = between[i] // 4 + (between[i] % 4 > 0)  # a member reaches j if four times its distance is that of j, or more
        others = np.flatnonzero((limits <= own[members].max()) & (np.arange(len(centres)) != i))
        others = others[np.argsort(limits[others], kind="stable")]
        ring = np.searchsorted(limits[others], own[members], side="right")
        for t, j in enumerate(others):
            rows = members[ring > t]
            compared += len(rows)
            found = ((points[rows] - centres[j]) ** 2).sum(axis=1)
            nearer = (found < gap[rows]) | ((found == gap[rows]) & (j < best[rows]))
            best[rows[nearer]], gap[rows[nearer]] = j, found[nearer]
    return best, gap, compared


def _blocks(vectors: DataFrame, settings: Settings) -> DataFrame:
    """(ids, points): vectors in blocks, as whole numbers of 32 bits."""
    kind = vectors.schema["id"].dataType.simpleString()
    size, dims, scale = settings.block, settings.dimensions, settings.scale

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                x = np.asarray(part.column("vector").flatten().cast(pa.float64())).reshape(-1, dims)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([whole_numbers(x, scale).astype("<i4").tobytes()], pa.binary())], names=["ids", "points"])

    return vectors.mapInArrow(task, f"ids array<{kind}>, points binary")


def _assigned(blocks: DataFrame, centres: np.ndarray, dims: int) -> DataFrame:
    """The blocks with clusters by these centres and squared distances, and ``totals``: members and inertia of each cluster, sums of their components, comparisons."""
    k, first = len(centres), "cluster" not in blocks.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for r in range(batch.num_rows):
                x = np.frombuffer(batch.column("points")[r].as_py(), "<i4").reshape(-1, dims).astype(np.int64)
                before = np.zeros(len(x), np.int64) if first else np.frombuffer(batch.column("cluster")[r].as_py(), "<i4").astype(np.int64)
                cluster, gap, compared = assign(x, before, centres)
                totals = np.zeros((k, dims + 3), np.int64)
                np.add.at(totals, cluster, np.column_stack([np.ones(len(x), np.int64), gap >> 31, gap & (1 << 31) - 1, x]))  # distances in halves, whose sums fit
                rows.append((cluster.astype("<i4").tobytes(), gap.tobytes(), [*totals.ravel().tolist(), compared]))
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.binary(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("ids"), batch.column("points"), *made], names=["ids", "points", "cluster", "gap", "totals"])

    kind = blocks.schema["ids"].dataType.simpleString()
    return blocks.mapInArrow(task, f"ids {kind}, points binary, cluster binary, gap binary, totals array<bigint>")


def _totals(blocks: DataFrame, k: int, dims: int) -> tuple[list[list[int]], int]:
    """(members, inertia and sums of components of each cluster; comparisons) over all blocks: the only rows that reach the driver."""
    entries = blocks.select(F.posexplode("totals").alias("at", "n")).groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    flat = [int(r["n"]) for r in sorted(entries.collect())]
    each = [flat[i * (dims + 3) : (i + 1) * (dims + 3)] for i in range(k)]
    return [[n, (high << 31) + low, *sums] for n, high, low, *sums in each], flat[-1]


def _rows(blocks: DataFrame, name: str) -> DataFrame:
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("ids").slice(r, 1).flatten()
                columns = [np.frombuffer(batch.column(c)[r].as_py(), t) for c, t in (("cluster", "<i4"), ("gap", "<i8"))]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=["id", "cluster", "distance"])

    return blocks.select("ids", "cluster", "gap").mapInArrow(task, f"id {kind}, cluster int, distance bigint").withColumnRenamed("id", name)


@dataclass
class Model:
    """Centroids after the last round, and what each round compared (of rows times clusters)."""

    centres: np.ndarray
    blocks: DataFrame
    compared: list[int]
    spread: list[int]

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centres.tolist()]


def fit(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> Model | None:
    """Centroids by Lloyd's rounds from the first ones, and every usable vector assigned once more; None without such a vector.

    Vectors that ``is_usable`` refuses take no part. Fewer vectors than
    clusters make as many clusters as vectors. A null id ranks after all
    others among the first centroids; equal ids rank by their vectors.
    A cluster without members keeps its centroid.
    """
    bound_batches(df.sparkSession)
    usable = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("vector")).where(is_usable(F.col("vector"), settings))
    rank = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("id").cast("string")), 256)
    starts = usable.orderBy(rank.asc_nulls_last(), "vector").limit(settings.clusters).collect()
    if not starts:
        return None
    centres = whole_numbers(np.array([r["vector"] for r in starts], np.float64), settings.scale)
    dims, compared = settings.dimensions, []
    blocks = cut(_blocks(usable, settings), "balls")
    for turn in range(settings.rounds + 1):
        found = cut(_assigned(blocks, centres, dims), "balls")
        drop(blocks)
        blocks = found
        totals, n = _totals(blocks, len(centres), dims)
        compared.append(n)
        if turn < settings.rounds:
            for i, (members, _, *sums) in enumerate(totals):
                if members:
                    centres[i] = [s // members for s in sums]
    return Model(centres, blocks, compared, [t[1] for t in totals])


def cluster(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector; see ``fit``.

    One row comes out for each row that goes in, so repeated rows stay
    repeated; unusable vectors (null, of other lengths, with null or
    non-finite components, or beyond ``Settings.largest``, whose distances no
    64 bits hold) have none. Other columns are left behind, whatever their
    names. Inertias that 64 bits don't hold are null.
    """
    model = fit(df, id_column, vector, settings)
    if model is None:
        kind = df.schema[id_column].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"`{id_column}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")

    def fitting(n: int) -> Column:
        return F.lit(n if n < 1 << 63 else None).cast("bigint")

    of = F.col("cluster") + 1
    return _rows(model.blocks, id_column).select(
        f"`{id_column}`", "cluster", "distance", F.element_at(F.array(*map(fitting, model.spread)), of).alias("cluster_inertia"), fitting(sum(model.spread)).alias("inertia"),
        F.element_at(F.array(*map(F.lit, model.digests())), of).alias("centroid_sha256"),
    )
