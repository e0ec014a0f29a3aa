"""Exact k-means rounds by Shallot search.

Every vector carries an upper bound on the distance to its centroid, a lower bound on that to all
others, and the number of the second-nearest one. After a round the bounds are widened by how far the
centroids moved; a vector whose bounds still leave no doubt is passed over. Any other is compared
with both remembered centroids, and the search starts at the closer of the two: its neighbours are
visited in ascending distance, inside a ball that shrinks as nearer ones are found. Bounds are
floating-point numbers with a margin; what they leave is compared in integers.

A round is one pass over the vectors. A task adds up its members, so a centroid with most of the
vectors is a few numbers per task like any other, and only those reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged

MARGIN = 1e-9  # relative; the error of a distance and a few additions is below 1e-14
NARROW = 1 << 27  # up to here 64 squared differences add up to less than 2**63
LIMB = 10**18  # sums travel as digits of this base
COUNT, INERTIA = -1, -2  # places of a cluster's other sums, beside the components
STATE = (
    "vec_id long, v array<long>, wide array<string>, cluster int, second int, upper double, lower double, "
    "distance long, pos int, limb int, value long"
)
RESULT = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"


def _integer(x: float, scale: int) -> int:
    return math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale


def _array(rows: list[list[int]]) -> np.ndarray:
    """int64 where squared distances fit, Python integers elsewhere."""
    narrow = all(-NARROW <= x <= NARROW for row in rows for x in row)
    return np.array(rows, np.int64 if narrow else object).reshape(len(rows), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=1)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, rest, at = (-1 if total < 0 else 1), abs(total), 0
    while rest or at == 0:
        rest, digit = divmod(rest, LIMB)
        yield at, sign * digit
        at += 1


class Centroids:
    """The centroids of a round, what lies between them, and how far each has moved."""

    def __init__(self, rows: list[list[int]], before: list[list[int]] | None = None):
        self.rows = _array(rows)
        self.wide = self.rows.dtype == object
        if self.wide:
            return
        k = len(rows)
        self.apart = np.sqrt(
            np.stack([_squared(self.rows, row) for row in self.rows]).astype(float)
        )
        ordered = np.argsort(self.apart + np.where(np.eye(k) > 0, -1.0, 0.0), axis=1, kind="stable")
        self.near = ordered[:, 1:]
        self.half = self.apart[np.arange(k), self.near[:, 0]] / 2 if k > 1 else np.full(k, np.inf)
        moved = None if before is None else _array(before)
        known = moved is not None and moved.dtype != object
        self.moved = np.sqrt(_squared(self.rows, moved).astype(float)) if known else np.full(k, np.inf)
        others = np.sort(np.where(np.eye(k) > 0, -1.0, self.moved), axis=1)
        self.others_moved = others[:, -1] if k > 1 else np.zeros(k)

    def scan(self, vectors: np.ndarray) -> np.ndarray:
        """Nearest centroid by comparison with all of them, for numbers of any size."""
        best = _squared(vectors, self.rows[0])
        cluster = np.zeros(len(vectors), np.int32)
        for j in range(1, len(self.rows)):
            found = _squared(vectors, self.rows[j])
            nearer = (found < best).astype(bool)
            cluster[nearer], best = j, np.where(nearer, found, best)
        return cluster

    def search(self, vectors, cluster, second, upper, lower) -> int:
        """Bring the four arrays up to date in place; returns the number of distances computed."""
        upper += self.moved[cluster]
        lower -= self.others_moved[cluster]

        def doubtful(rows):
            bound = np.maximum(lower[rows], self.half[cluster[rows]])
            return rows[~(upper[rows] * (1 + MARGIN) + MARGIN < bound)]

        rows = doubtful(np.arange(len(vectors)))
        upper[rows] = np.sqrt(_squared(vectors[rows], self.rows[cluster[rows]]).astype(float))
        computed = len(rows)
        rows = doubtful(rows)
        if not len(rows) or len(self.rows) == 1:
            return computed
        own = vectors[rows]
        first, next_ = cluster[rows].copy(), second[rows].copy()
        best = _squared(own, self.rows[first])
        rest = _squared(own, self.rows[next_])
        computed += len(rows)
        swap = (rest < best) | ((rest == best) & (next_ < first))
        first[swap], next_[swap] = next_[swap], first[swap]
        best[swap], rest[swap] = rest[swap], best[swap]
        start, reach, other = first.copy(), np.sqrt(best.astype(float)), next_.copy()
        live = np.arange(len(rows))
        for step in range(self.near.shape[1]):
            j = self.near[start[live], step]
            ball = (reach[live] + np.sqrt(rest[live].astype(float))) * (1 + MARGIN) + MARGIN
            inside = self.apart[start[live], j] <= ball
            live, j = live[inside], j[inside]
            if not len(live):
                break
            fresh = j != other[live]
            at, j = live[fresh], j[fresh]
            found = _squared(own[at], self.rows[j])
            computed += len(at)
            nearer = (found < best[at]) | ((found == best[at]) & (j < first[at]))
            closer = ~nearer & (found < rest[at])
            n = at[nearer]
            rest[n], next_[n] = best[n], first[n]
            best[n], first[n] = found[nearer], j[nearer]
            rest[at[closer]], next_[at[closer]] = found[closer], j[closer]
        cluster[rows], second[rows] = first, next_
        upper[rows], lower[rows] = np.sqrt(best.astype(float)), np.sqrt(rest.astype(float))
        return computed


def _integers(batch: pa.RecordBatch, scale: int) -> pa.RecordBatch:
    """The first state of (vec_id, vector): integers, no bounds."""
    n, vectors = len(batch), batch.column(1)
    flat = np.floor(vectors.flatten().to_numpy() * float(scale)).reshape(n, -1)
    fits = (np.abs(flat) <= NARROW).all(axis=1)
    narrow, wide = [None] * n, [None] * n
    for at in range(n):
        if fits[at]:
            narrow[at] = flat[at].astype(np.int64)
        else:
            wide[at] = [str(_integer(x, scale)) for x in vectors[at].as_py()]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), pa.array(narrow, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.string())),
            pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, np.int32)),
            pa.array(np.full(n, np.inf)), pa.array(np.zeros(n)),
        ],
        ["vec_id", "v", "wide", "cluster", "second", "upper", "lower"],
    )


def _assigned(batch: pa.RecordBatch, centroids: Centroids) -> tuple[list, np.ndarray, np.ndarray]:
    """(state columns, vectors, squared distances as objects) of a batch after one search."""
    if batch.column(2).null_count == len(batch):
        vectors = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
    else:
        rows = [v if w is None else map(int, w) for v, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        vectors = np.array([list(row) for row in rows], object)
    n = len(batch)
    cluster, second, upper, lower = (batch.column(c).to_numpy().copy() for c in range(3, 7))
    if centroids.wide or vectors.dtype == object:
        cluster, second = centroids.scan(vectors), np.zeros(n, np.int32)
        second[cluster == 0] = min(1, len(centroids.rows) - 1)
        upper, lower = np.full(n, np.inf), np.zeros(n)
    else:
        centroids.search(vectors, cluster, second, upper, lower)
    distance = _squared(vectors, centroids.rows[cluster])
    return [*batch.columns[:3], *map(pa.array, (cluster, second, upper, lower))], vectors, distance


def _round(rows: DataFrame, centroids: Centroids, scale: int, first: bool) -> Staged:
    """Assign every vector, written with the sums of each task's clusters behind them."""
    components = centroids.rows.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        schema = None
        for batch in batches:
            if not len(batch):
                continue
            columns, vectors, distance = _assigned(_integers(batch, scale) if first else batch, centroids)
            for c in np.unique(columns[3]):
                members = columns[3].to_numpy() == c
                totals = [*vectors[members].sum(axis=0), members.sum(), sum(map(int, distance[members]))]
                for pos, total in zip([*range(components), COUNT, INERTIA], totals, strict=True):
                    sums[c, pos] = sums.get((c, pos), 0) + int(total)
            told = pa.array([int(d) if d < 1 << 63 else None for d in distance], pa.int64())
            nothing = [pa.nulls(len(batch), t) for t in (pa.int32(), pa.int32(), pa.int64())]
            out = pa.RecordBatch.from_arrays([*columns, told, *nothing], NAMES)
            schema = out.schema
            yield out
        told = [(c, pos, at, digit) for (c, pos), total in sums.items() for at, digit in _limbs(total)]
        if told:
            c, pos, at, digit = zip(*told)
            filled = {"cluster": c, "pos": pos, "limb": at, "value": digit}
            columns = [pa.array(filled[f.name], f.type) if f.name in filled else pa.nulls(len(c), f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return Staged(rows.mapInArrow(assign, STATE), "shallot")


NAMES = [field.split()[0] for field in STATE.split(", ")]


def _sums(state: Staged) -> dict[tuple[int, int], int]:
    """{(cluster, place): sum}, a few numbers per component."""
    digits = state.rows.where("pos is not null").groupBy("cluster", "pos", "limb")
    found = digits.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    out: dict[tuple[int, int], int] = {}
    for row in found:
        place = (row["cluster"], row["pos"])
        out[place] = out.get(place, 0) + int(row["value"]) * LIMB ** row["limb"]
    return out


def _long(total: int) -> int | None:
    return total if total < 1 << 63 else None


def usable(rows: DataFrame, key: str, vector: str, components: int) -> DataFrame:
    """(vec_id, vector) of the rows whose vector has so many components, all of them finite."""
    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return named.where(F.size("vector") == components).where(finite)


def starts(kept: DataFrame, count: int, seed: str, scale: int) -> list[list[int]]:
    """The ``count`` vectors with the smallest hashes of their keys; of one key, in the order of components."""
    named = kept.where("vec_id is not null")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = named.orderBy(order, "vector").limit(count).collect()
    return [[_integer(x, scale) for x in row["vector"]] for row in first]


def clustered(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    seed: str = "1",
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector with exactly
    ``components`` components, none of them null or not finite; other rows take no part.

    A component x is the integer floor(scale * x). The centroids start as the vectors with the
    smallest sha256 of ``seed:key``, numbered in that order. A round assigns every vector to the nearest
    centroid (squared distance; ties: smaller number) and moves non-empty centroids to the floor of their
    members' mean. After the last round all are assigned once more. ``inertia`` is the sum of the
    squared distances over the cluster and over all.

    Every row counts, repeated ones too; with repeated keys their vectors follow each other among the
    starts. A row with a null key is never a start. With fewer vectors than ``clusters`` there are as
    many centroids; without a start, as in an empty table, there are no rows. Numbers of any size are
    compared exactly; a distance or inertia beyond a long is null. Other columns are not read.
    """
    spark = rows.sparkSession
    kept = usable(rows, key, vector, components)
    centres = starts(kept, clusters, seed, scale)
    if not centres:
        return spark.createDataFrame([], f"{key} long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")  # fmt: skip
    state, before = None, None
    for turn in range(rounds + 1):
        source = kept if state is None else state.rows.where("pos is null").select(*NAMES[:7])
        after = _round(source, Centroids(centres, before), scale, state is None)
        if state is not None:
            state.drop()
        state, totals = after, _sums(after)
        if turn < rounds:
            before = centres
            centres = [
                [totals[c, pos] // totals[c, COUNT] for pos in range(components)] if (c, COUNT) in totals else row
                for c, row in enumerate(before)
            ]
    inertia = _long(sum(total for (_, pos), total in totals.items() if pos == INERTIA))
    told = [
        (c, _long(totals.get((c, INERTIA), 0)), inertia, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centres)
    ]
    # One row per centroid.
    described = F.broadcast(spark.createDataFrame(told, RESULT))
    vectors = state.rows.where("pos is null").select(F.col("vec_id").alias(key), "cluster", "distance")
    return vectors.join(described, "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
