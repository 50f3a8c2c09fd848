"""Cluster vectors around centroids in whole numbers, with Orchard's search for the nearest one.

A vector counts if it has exactly the wanted number of components, none null, NaN or infinite. Its
components become ``floor(SCALE * x)``, so that every distance, sum and mean is exact and does not
depend on how the rows are spread. Centroids start as the vectors whose hash of seed and id is
smallest. Each round assigns every vector and replaces each centroid that has vectors by the floor
of their means; a last assignment follows.

The nearest centroid is found by Orchard's search: every centroid has the list of the others in
order of distance. A vector walks the list of its current centroid, jumps to a closer centroid's
list as soon as it meets one, never measures a centroid twice, and stops at the first entry that is
strictly farther from the current centroid than twice the vector is: all further ones are strictly
worse. Of centroids at the same distance the smaller number wins. All vectors of a batch walk
together.

Every task adds up its vectors per centroid, so a round sends ``k`` rows of a task to the
aggregation, and ``k`` centroids come to the driver. A cluster of any size is no group.

Vectors that do not count give no row. Null ids count as empty text in the hash; rows with equal
hashes, as repeated ids have, start in order of their components. Fewer vectors than centroids give
as many centroids as there are vectors; an empty table gives an empty result. Repeated rows are all
returned. Other columns are ignored. Components beyond ``LIMIT`` count as ``LIMIT``, so that squares
fit in 64 bits; sums of distances that do not are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import stored

SCALE, LIMIT = 64, 1 << 27
CENTROIDS, DIMENSIONS, ROUNDS, SEED = 16, 64, 3, "1"


@dataclass(frozen=True)
class Clusters:
    """``rows``: id, cluster, distance. ``centroids``: the final ones."""

    rows: DataFrame
    centroids: np.ndarray


def usable(vector: str, dimensions: int) -> Column:
    """Whether a vector counts."""
    infinite = F.lit(float("inf"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return F.coalesce((F.size(vector) == dimensions) & sound, F.lit(False))


def whole_numbers(vectors: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that count in a list array, and their components as whole numbers."""
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), dimensions), False)
    places = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    flat = vectors.take(pa.array(places)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dimensions)  # a null becomes NaN
    sound = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(x[sound] * SCALE), -LIMIT, LIMIT)
    return places[sound], scaled.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


class Search:
    """Orchard's search over a set of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        apart = squared(centroids[:, None], centroids[None])
        np.fill_diagonal(apart, -1)
        self.order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        # A bound beyond which no centroid is as close; the walk's end is beyond any distance.
        gaps = np.take_along_axis(apart, self.order, axis=1)
        self.gaps = np.concatenate([gaps, np.full((len(centroids), 1), np.iinfo(np.int64).max)], axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance to it, per vector."""
        n, k = len(vectors), len(self.centroids)
        best = np.zeros(n, np.int64)
        distance = squared(vectors, self.centroids[0])
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        while True:
            # Strictly beyond twice the distance: in squares, a gap over four times the distance.
            gap = self.gaps[best[walking], place[walking]]
            walking = walking[(place[walking] < k - 1) & (gap // 4 + (gap % 4 > 0) <= distance[walking])]
            if not len(walking):
                return best, distance
            met = self.order[best[walking], place[walking]]
            place[walking] += 1
            new = ~seen[walking, met]
            row, met = walking[new], met[new]
            seen[row, met] = True
            far = squared(vectors[row], self.centroids[met])
            closer = (far < distance[row]) | ((far == distance[row]) & (met < best[row]))
            row, met, far = row[closer], met[closer], far[closer]
            best[row], distance[row], place[row] = met, far, 0


def _batches(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))


def first_centroids(vectors: DataFrame, id: str, vector: str, k: int, dimensions: int, seed: str) -> np.ndarray:
    """The whole-number vectors with the smallest hashes; the hash's ties by components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    bound = F.lit(float(LIMIT))

    def whole(x: Column) -> Column:
        scaled = F.greatest(-bound, F.least(bound, x * SCALE))
        return F.floor(scaled).cast("long")

    rows = (
        _batches(vectors, id, vector)
        .where(usable("vector", dimensions))
        .select(F.sha2(name, 256).alias("hash"), F.transform("vector", whole).alias("vector"))
        .orderBy("hash", "vector")
        .limit(k)
        .collect()
    )
    return np.array([r["vector"] for r in rows], np.int64).reshape(len(rows), dimensions)


def _over(vectors: DataFrame, dimensions: int, take: Callable, schema: str) -> DataFrame:
    """``take(ids, whole vectors)`` over every batch, as rows of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, numbers = whole_numbers(batch.column("vector"), dimensions)
            yield from take(batch.column("id").take(pa.array(places)), numbers)

    return vectors.mapInArrow(run, schema)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over ``id, vector``."""
    k, dimensions = centroids.shape
    search = Search(centroids)

    def sums(ids: pa.Array, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        cluster, _ = search.nearest(numbers)
        order = np.argsort(cluster, kind="stable")
        found, start = np.unique(cluster[order], return_index=True)
        if len(found):
            total = np.add.reduceat(numbers[order], start, axis=0)
            counts = np.diff(np.append(start, len(order)))
            both = np.concatenate([counts[:, None], total], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(found, dimensions + 1)), pa.array(np.tile(np.arange(dimensions + 1), len(found))), pa.array(both.ravel())],
                names=["cluster", "part", "total"],
            )

    # As many rows as centroids have components: that bounds what comes to the driver.
    rows = (
        _over(vectors, dimensions, sums, "cluster long, part long, total long")
        .groupBy("cluster", "part")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    totals = {(r["cluster"], r["part"]): int(r["total"]) for r in rows}
    after = centroids.copy()
    for c in {c for c, _ in totals}:
        after[c] = [totals[c, i + 1] // totals[c, 0] for i in range(dimensions)]
    return after


def clustered(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    dimensions: int = DIMENSIONS,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> Clusters:
    """Cluster the vectors of a table; see the module."""
    centroids = first_centroids(vectors, id, vector, k, dimensions, seed)
    narrow = _batches(vectors, id, vector)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(narrow, centroids)
    search = Search(centroids) if len(centroids) else None

    def assigned(ids: pa.Array, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        if search:
            cluster, distance = search.nearest(numbers)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)], names=["id", "cluster", "distance"])

    kind = narrow.schema["id"].dataType.simpleString()
    rows = _over(narrow, dimensions, assigned, f"id {kind}, cluster long, distance long")
    return Clusters(rows.withColumnRenamed("id", id), centroids)


def cluster_rows(vectors: DataFrame, id: str = "vec_id", **options) -> DataFrame:
    """Per vector: id, cluster, distance, inertia of its cluster and of all, digest of its centroid."""
    found = clustered(vectors, id, **options)
    rows = stored(found.rows, "clusters")
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    per_cluster = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = {r["cluster"]: int(r["sum"]) for r in per_cluster.collect()}  # a row per centroid
    of = F.col("cluster").cast("int")

    def long(n: int) -> int | None:
        return n if n < 1 << 63 else None

    def looked_up(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>"), of)

    return rows.select(
        id,
        of.alias("cluster"),
        "distance",
        looked_up([long(sums.get(c, 0)) for c in range(len(digests))], "long").alias("cluster_inertia"),
        F.lit(long(sum(sums.values()))).cast("long").alias("inertia"),
        looked_up(digests, "string").alias("centroid_sha256"),
    )
