"""Centroid clustering on bit planes: exact integer k-means by AND and popcount.

A vector of 64 integer components is turned, each component less the table's smallest, into one uint64 per bit: bit k
of plane b is bit b of component k. With every plane of a vector and of a centroid, the dot product is the sum of
2^(i + j) * popcount(x_i & c_j). The shift changes no distance, and a sum of components is the weighted count of set
bits, so distances, assignments and new centroids are exact for integers of any width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import written

COMPONENTS = 64
#: Vectors times centroids that one step of the kernel holds; a few arrays of this many words stay in the CPU's cache.
STEP = 1 << 15
#: Planes up to which a squared distance of 64 components fits a long; wider integers are computed as Python's.
LONG_PLANES = 28


@dataclass(frozen=True)
class Scale:
    """Components are ``floor(factor * x)``; planes hold them less ``low``, which takes ``planes`` bits."""

    factor: float
    low: int
    planes: int


def usable(vector: str, factor: float, components: int = COMPONENTS) -> Column:
    """Whether a vector has the right number of components, none null and all finite, also times ``factor``."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * factor) < float("inf")))
    return F.coalesce((F.size(vector) == components) & finite, F.lit(False))


def scale_of(vectors: DataFrame, factor: float) -> Scale:
    """The range of the components of ``vectors`` (vector array<double>) as integers, from one pass over all of them."""
    ends = vectors.agg(F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")).collect()[0]
    if ends["low"] is None:
        return Scale(factor, 0, 1)
    low, high = (int(np.floor(np.float64(v) * factor)) for v in (ends["low"], ends["high"]))
    return Scale(factor, low, max(1, (high - low).bit_length()))


def _kind(planes: int) -> type:
    return np.int64 if planes <= LONG_PLANES else object


def to_planes(integers: np.ndarray, planes: int) -> np.ndarray:
    """(n, 64) integers of at least 0 as (n, planes) uint64 words."""
    out = np.empty((len(integers), planes), np.uint64)
    for b in range(planes):
        bits = ((integers >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def dot_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) exact dot products of two sets of vectors given by their planes."""
    n, planes = x.shape
    kind = _kind(planes)
    out = np.empty((n, len(c)), kind)
    rows = max(1, STEP // max(1, len(c)))
    for at in range(0, n, rows):
        some = x[at : at + rows]
        total = np.zeros((len(some), len(c)), kind)
        for weight in range(2 * planes - 1):
            # A pair of planes counts 64 bits at most, so all pairs of one weight fit 16 bits up to 1,023 planes.
            ones = np.zeros(total.shape, np.uint16)
            for i in range(max(0, weight - planes + 1), min(planes, weight + 1)):
                ones += np.bitwise_count(some[:, i, None] & c[None, :, weight - i])
            total += ones.astype(kind) * (1 << weight)
        out[at : at + rows] = total
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Squared length of each vector from its planes."""
    planes = x.shape[1]
    kind = _kind(planes)
    out = np.zeros(len(x), kind)
    for i in range(planes):
        for j in range(planes):
            out += np.bitwise_count(x[:, i] & x[:, j]).astype(kind) * (1 << (i + j))
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector: the number of the nearest centroid, the smaller one among equals, and the squared distance."""
    apart = norms(x)[:, None] - 2 * dot_products(x, c) + norms(c)[None, :]
    cluster = apart.argmin(axis=1)
    return cluster, apart[np.arange(len(x)), cluster]


def _quantise(scale: Scale, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
        whole = np.floor(flat * scale.factor)
        if abs(scale.low) < 1 << 61 and scale.planes <= 61:
            integers = whole.astype(np.int64) - scale.low
        else:
            integers = np.array([[int(v) - scale.low for v in row] for row in whole], object).reshape(whole.shape)
        words = [row.tobytes() for row in to_planes(integers, scale.planes)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(words, pa.binary())], ["vec_id", "planes"])


def bit_planes(vectors: DataFrame, scale: Scale) -> DataFrame:
    """vec_id and ``planes``, a word of 8 bytes per bit, of ``vectors`` (vec_id, vector of 64 finite doubles)."""
    return vectors.select("vec_id", "vector").mapInArrow(partial(_quantise, scale), "vec_id long, planes binary")


def _words(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("planes").to_pylist()), np.uint64).reshape(-1, planes)


def _set_bits(scale: Scale, centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's vectors: members of each cluster, and how many of them have each bit of each plane set."""
    k = len(centroids)
    members, total = np.zeros(k, np.int64), np.zeros((k, scale.planes, COMPONENTS), np.int64)
    for batch in batches:
        x = _words(batch, scale.planes)
        cluster, _ = nearest(x, centroids)
        order = np.argsort(cluster, kind="stable")
        x, found = x[order], np.bincount(cluster, minlength=k)
        members += found
        ends = np.cumsum(found)
        for g in np.flatnonzero(found):
            mine = np.ascontiguousarray(x[ends[g] - found[g] : ends[g]]).view(np.uint8)
            bits = np.unpackbits(mine, axis=1, bitorder="little")
            total[g] += bits.sum(axis=0, dtype=np.int64).reshape(scale.planes, COMPONENTS)
    flat = np.r_[members, total.ravel()]
    cells = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(flat[cells])], ["cell", "n"])


def moved(table: DataFrame, scale: Scale, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: the floor of the mean of each cluster's components; empty ones stay.

    What tasks send is bounded by the model, clusters times planes times 64 counts, whatever the rows.
    """
    k = len(centroids)
    task = partial(_set_bits, scale, centroid_planes(centroids, scale))
    counts = table.select("planes").mapInArrow(task, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(k * (1 + scale.planes * COMPONENTS), np.int64)
    for row in counts.collect():
        flat[row["cell"]] = row["n"]
    members, total = flat[:k].tolist(), flat[k:].reshape(k, scale.planes, COMPONENTS)
    out = []
    for g, old in enumerate(centroids):
        sums = [sum(int(n) << b for b, n in enumerate(total[g, :, i])) for i in range(COMPONENTS)]
        out.append([s // members[g] + scale.low for s in sums] if members[g] else old)
    return out


def centroid_planes(centroids: list[list[int]], scale: Scale) -> np.ndarray:
    rows = np.array([[v - scale.low for v in c] for c in centroids], object).reshape(-1, COMPONENTS)
    return to_planes(rows, scale.planes)


def _assign(scale: Scale, centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster, apart = nearest(_words(batch, scale.planes), centroids)
        fits = [int(d) if d < 1 << 63 else None for d in apart]
        columns = [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])


def first_centroids(table: DataFrame, scale: Scale, k: int, order: Column) -> list[list[int]]:
    """Integer components of the ``k`` first vectors by ``order``, then by id and planes. ``k`` rows go to the driver."""
    chosen = table.orderBy(order.asc_nulls_last(), F.col("vec_id").asc_nulls_last(), "planes").limit(k).collect()
    out = []
    for row in chosen:
        words = np.frombuffer(row["planes"], np.uint64)
        bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out.append([sum(int(bits[b, i]) << b for b in range(scale.planes)) + scale.low for i in range(COMPONENTS)])
    return out


@dataclass(frozen=True)
class Clustering:
    """``assigned``: vec_id, cluster, distance (squared) of every vector kept. ``centroids``: components by number."""

    assigned: DataFrame
    centroids: list[list[int]]
    scale: Scale


def cluster(
    embeddings: DataFrame,
    k: int = 40,
    rounds: int = 5,
    factor: float = 256.0,
    order: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clustering:
    """Clusters of the vectors of ``embeddings`` that have 64 components, none null, NaN or infinite.

    Components become ``floor(factor * x)``. Centroids begin as the ``k`` first vectors by ``order`` (by default the
    sha256 of ``2:`` and the id), so fewer vectors give fewer centroids. Each of ``rounds`` rounds assigns every vector
    to the nearest centroid, the smaller number among equals, and moves every centroid with members to the floor of
    their mean; then all are assigned once more. Every row is a vector of its own: rows that repeat an id or a vector
    are each assigned and counted. A null id comes last in the order. A squared distance beyond a long is null. Null
    vectors and those of another length are in no row, an empty table gives no rows and no centroids, and other
    columns are not read.
    """
    source = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    kept = source.filter(usable("vector", factor)).withColumn("vector", F.col("vector").cast("array<double>"))
    scale = scale_of(kept, factor)
    table = written(bit_planes(kept, scale))
    by = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256) if order is None else order
    centroids = first_centroids(table, scale, k, by)
    for _ in range(rounds if centroids else 0):
        centroids = moved(table, scale, centroids)
    if not centroids:
        return Clustering(table.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), [], scale)
    task = partial(_assign, scale, centroid_planes(centroids, scale))
    return Clustering(written(table.mapInArrow(task, "vec_id long, cluster int, distance long")), centroids, scale)


def centroid_digest(centroid: list[int]) -> str:
    return sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_report(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector.

    Inertia is the sum of distances; one beyond a long is null, as is one with such a distance.
    """
    # A row per cluster, so the model bounds what is collected and broadcast.
    exact = F.when(F.count_if(F.col("distance").isNull()) == 0, F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r["cluster"]: r["n"] for r in found.assigned.groupBy("cluster").agg(exact.alias("n")).collect()}

    def long(n: int | None) -> int | None:
        return int(n) if n is not None and n < 1 << 63 else None

    whole = None if None in sums.values() else sum(sums.values())
    rows = [(i, long(sums[i]), long(whole), centroid_digest(c)) for i, c in enumerate(found.centroids) if i in sums]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    facts = found.assigned.sparkSession.createDataFrame(rows, kinds)
    out = found.assigned.join(F.broadcast(facts), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
