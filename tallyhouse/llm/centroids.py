"""Centroid clustering in integers, with Shallot search.

Every vector carries its nearest and second-nearest centroid with an upper bound on the distance to
the one and a lower bound on that to all others. After the centroids moved, the bounds are widened
by as much; where they still tell the nearest apart, nothing is computed. The rest measure both
remembered centroids, start from the closer one and go through its neighbours in ascending order of
distance. The ball that can hold a better centroid has the distance to the start plus that to the
second best as its radius, so it shrinks while they scan; a batch scans in lockstep, and a vector
drops out at the first neighbour beyond its ball. Whatever survives is compared by exact integer
distances. Bounds are floating point and widened by far more than their rounding errors, so they
only ever decide what is not computed.

Each round is one pass over the vectors, which are written with their bounds to the shared scratch
folder. Sums for the new centroids are partial sums per task and centroid, so a centroid that holds
most vectors is no hot key. The driver sees the centroids alone.

Defined results: vectors of another length, or with a null or non-finite component, are left out,
and so are null vectors; repeated rows count each; rows without an id are clustered but seed no
centroid; with fewer kept vectors than centroids every one of them is a centroid; without any there
are no rows. A component beyond 2^27 in integers (2^19 as a number) is an error, as squared
distances would not fit. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_staged, staged

LARGEST = 1 << 27
SLACK = 1e-9  # relative widening of every bound; rounding errors are below 1e-14


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(id, x): kept vectors as integers, floor(scale * component)."""
    number = F.transform(vector_col, lambda v: v.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), number.alias("v"))
    finite = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where((F.size("v") == size) & finite)
    fits = F.forall("v", lambda v: F.abs(v * scale) < LARGEST)
    whole = F.transform("v", lambda v: F.floor(v * scale).cast("int"))
    beyond = F.raise_error(F.lit(f"a component is beyond {LARGEST // scale}")).cast("array<int>")
    return rows.select("id", F.when(fits, whole).otherwise(beyond).alias("x"))


def first_centroids(kept: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.where("id IS NOT NULL").select(key.alias("key"), "x").orderBy("key", "x").limit(count).collect()
    return np.array([r.x for r in rows], np.int64)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to the centroid of its row."""
    apart = vectors - centroids
    return np.einsum("ij,ij->i", apart, apart)


class Geometry:
    """What a scan needs to know of the centroids: distances, neighbours in order, last moves."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.centroids = centroids
        apart = [np.sqrt(squared(centroids, np.broadcast_to(c, centroids.shape)).astype(float)) for c in centroids]
        self.apart = np.array(apart)
        self.order = np.argsort(self.apart + np.diag(np.full(len(centroids), -1.0)), axis=1)[:, 1:]  # itself is first
        self.sorted = np.take_along_axis(self.apart, self.order, axis=1)
        moved = np.zeros(len(centroids)) if before is None else np.sqrt(squared(centroids, before).astype(float))
        self.moved = moved * (1 + SLACK)
        rest = np.sort(self.moved)[::-1]
        # The farthest that any other centroid has moved.
        self.others_moved = np.where(self.moved == rest[0], rest[1] if (self.moved == rest[0]).sum() == 1 and len(rest) > 1 else rest[0], rest[0])
        self.half = self.sorted[:, 0] / 2 * (1 - SLACK) if len(centroids) > 1 else np.full(1, np.inf)


def _better(distance: np.ndarray, number: np.ndarray, best: np.ndarray, holder: np.ndarray) -> np.ndarray:
    """Nearer, or as near with a smaller number."""
    return (distance < best) | ((distance == best) & (number < holder))


def shallot_scan(vectors: np.ndarray, one: np.ndarray, two: np.ndarray, space: Geometry) -> tuple[np.ndarray, ...]:
    """(nearest, its squared distance, second nearest, its squared distance) from two remembered centroids."""
    centroids = space.centroids
    d_one, d_two = squared(vectors, centroids[one]), squared(vectors, centroids[two])
    swap = _better(d_two, two, d_one, one)
    near, far = np.where(swap, two, one), np.where(swap, one, two)
    d_near, d_far = np.where(swap, d_two, d_one), np.where(swap, d_one, d_two)
    start, from_start = near.copy(), np.sqrt(d_near.astype(float))
    other = far.copy()
    active = np.arange(len(vectors))
    for rank in range(space.order.shape[1]):
        radius = (from_start[active] + np.sqrt(d_far[active].astype(float))) * (1 + SLACK)
        active = active[space.sorted[start[active], rank] <= radius]
        if not len(active):
            break
        number = space.order[start[active], rank]
        fresh = number != other[active]
        rows, number = active[fresh], number[fresh]
        distance = squared(vectors[rows], centroids[number])
        nearer = _better(distance, number, d_near[rows], near[rows])
        second = ~nearer & _better(distance, number, d_far[rows], far[rows])
        up = rows[nearer]
        far[up], d_far[up] = near[up], d_near[up]
        near[up], d_near[up] = number[nearer], distance[nearer]
        down = rows[second]
        far[down], d_far[down] = number[second], distance[second]
    return near, d_near, far, d_far


STATE = "id {kind}, x array<int>, cluster int, second int, upper double, lower double"


def assigner(space: Geometry, exact: bool) -> Callable:
    """Arrow batches with the state after the centroids of ``space``; ``exact`` makes ``upper`` the squared distance itself."""

    def assign(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(n, -1).astype(np.int64)
            single = len(space.centroids) == 1
            if "cluster" in batch.schema.names:
                near = batch.column("cluster").to_numpy().astype(np.int64)
                far = batch.column("second").to_numpy().astype(np.int64)
                upper = (batch.column("upper").to_numpy() + space.moved[near]) * (1 + SLACK)
                lower = batch.column("lower").to_numpy() - space.others_moved[near]
                lower = np.where(lower > 0, lower * (1 - SLACK), 0.0)
                open_ = upper >= np.maximum(lower, space.half[near])
                # The first check is cheap: the distance to the centroid itself may already be enough.
                rows = np.flatnonzero(open_)
                upper[rows] = np.sqrt(squared(vectors[rows], space.centroids[near[rows]]).astype(float)) * (1 + SLACK)
                rows = rows[upper[rows] >= np.maximum(lower[rows], space.half[near[rows]])]
            else:
                near = np.zeros(n, np.int64)
                far = np.full(n, 0 if single else 1, np.int64)
                upper, lower, rows = np.zeros(n), np.full(n, np.inf), np.arange(n)
            if not single and len(rows):
                near[rows], d_near, far[rows], d_far = shallot_scan(vectors[rows], near[rows], far[rows], space)
                upper[rows] = np.sqrt(d_near.astype(float)) * (1 + SLACK)
                lower[rows] = np.sqrt(d_far.astype(float)) * (1 - SLACK)
            state = [pa.array(near.astype(np.int32)), pa.array(far.astype(np.int32))]
            names = ["cluster", "second", "upper", "lower"]
            if exact:
                columns, names = [state[0], pa.array(squared(vectors, space.centroids[near]))], ["cluster", "distance"]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *names])
            else:
                columns = [*state, pa.array(upper), pa.array(lower)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), *columns], ["id", "x", *names])

    return assign


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of each centroid's vectors; those without any stay."""
    sums = [F.sum(F.element_at("x", i + 1).cast("long")).alias(f"s{i}") for i in range(centroids.shape[1])]
    found = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    after = centroids.copy()
    for row in found:
        after[row.cluster] = [row[f"s{i}"] // row.n for i in range(centroids.shape[1])]
    return after


def shallot_clusters(
    vectors: DataFrame,
    centroids: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, squared distance) of every kept vector, and the final centroids."""
    kept = staged(integer_vectors(vectors, id_col, vector_col, size, scale), "integer-vectors")
    kind = kept.schema["id"].dataType.simpleString()
    places = first_centroids(kept, centroids, seed)
    if not len(places):
        nothing = kept.limit(0).select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return nothing, np.empty((0, size), np.int64)
    state, before = kept, None
    for _ in range(rounds):
        space = Geometry(places, before)
        after = staged(state.mapInArrow(assigner(space, exact=False), STATE.format(kind=kind)), "cluster-state")
        drop_staged(state)
        state, before = after, places
        places = moved_centroids(state, places)
    final = state.mapInArrow(assigner(Geometry(places, before), exact=True), f"id {kind}, cluster int, distance long")
    return staged(final, "clusters"), places


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the inertia of each vector's cluster and of all, and its centroid's digest."""
    exact = "decimal(38,0)"
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast(exact)).alias("inertia")).collect()
    total = sum(int(r.inertia) for r in sums)
    # One entry for each centroid.
    inertias = F.create_map(*[F.lit(v) for r in sums for v in (r.cluster, int(r.inertia))]) if sums else F.create_map()
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = F.create_map(*[F.lit(v) for i, d in enumerate(digests) for v in (i, d)]) if digests else F.create_map()
    own = F.element_at(inertias, F.col("cluster")).cast("long") if sums else F.lit(0).cast("long")
    digest = F.element_at(named, F.col("cluster")) if digests else F.lit("")
    return assigned.select(
        "id", "cluster", "distance", own.alias("cluster_inertia"), F.lit(total).cast("long").alias("inertia"), digest.alias("centroid_sha256")
    )
