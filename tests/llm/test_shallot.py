"""Centroid clustering against a plain comparison with all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest

from shelfcast.llm import shallot
from shelfcast.llm.shallot import Centroids, clustered

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(rows, components, scale, clusters, rounds):
    def whole(x):
        return math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale

    kept = [
        (key, [whole(x) for x in v])
        for key, v in rows
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((hashlib.sha256(f"1:{k}".encode()).hexdigest(), v) for k, v in kept if k is not None)
    centres = [v for _, v in named[:clusters]]
    if not centres:
        return []

    def assign():
        out = []
        for _, v in kept:
            gaps = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((min(range(len(gaps)), key=lambda j: (gaps[j], j)), min(gaps)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            own = [v for (_, v), (d, _) in zip(kept, found) if d == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    each = {c: sum(d for a, d in found if a == c) for c in range(len(centres))}

    def told(x):
        return x if x < 2**63 else None

    return [
        (k, c, told(d), told(each[c]), told(sum(each.values())),
         hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
        for (k, _), (c, d) in zip(kept, found)
    ]


def compare(spark, rows, components=3, scale=64, clusters=4, rounds=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumnRenamed("x", "y")
    for c in ("cluster", "pos", "v", "distance"):
        df = df.selectExpr("*", f"'no' AS {c}")
    got = clustered(df, components=components, scale=scale, clusters=clusters, rounds=rounds)
    assert tuple(got.columns) == COLUMNS
    want = brute(rows, components, scale, clusters, rounds)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_equals_all_comparisons(spark, spread):
    rng = random.Random(5)
    homes = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, spread) for x in rng.choice(homes)]) for i in range(700)]
    compare(spark, rows, components=8, clusters=12, rounds=4)


def test_rows_that_take_no_part_ties_and_repetitions(spark):
    rows = [(1, [0.0, 0.0, 0.0])] * 5 + [(2, [1.0, 0.0, 0.0])] * 4 + [
        (3, [0.5, 0.0, 0.0]), (3, [-0.5, 0.0, 0.0]), (4, None), (5, []), (6, [1.0, None, 2.0]),
        (7, [float("nan"), 0.0, 0.0]), (8, [float("inf"), 0.0, 0.0]), (9, [1.0, 2.0]), (10, [1.0] * 4),
        (None, [0.25, 0.0, 0.0]), (11, [-0.001, -0.02, 0.999]),
    ]
    compare(spark, rows)
    compare(spark, rows, clusters=1)
    compare(spark, rows, clusters=40)
    compare(spark, rows, rounds=0)
    compare(spark, [(None, [1.0, 2.0, 3.0]), (1, None)])
    compare(spark, [])


def test_numbers_of_any_size(spark):
    rng = random.Random(8)
    sizes = (1.0, 3e6, 1e12, 1e19, 1e300, 1.7e308)
    rows = [(i, [rng.choice(sizes) * rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    compare(spark, rows)
    compare(spark, [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(50)] + [(99, [2.5e6, 0.0, 0.0])])


def test_bounds_spare_most_distances():
    """On clusters, the second round computes far fewer distances than a full comparison."""
    rng = np.random.default_rng(3)
    homes = rng.integers(-500, 500, (32, 16))
    vectors = (homes[rng.integers(0, 32, 4000)] + rng.integers(-20, 21, (4000, 16))).astype(np.int64)
    first = [list(map(int, row)) for row in homes]
    second = [[x + (j % 3) for x in row] for j, row in enumerate(first)]
    state = [np.zeros(4000, np.int32), np.ones(4000, np.int32), np.full(4000, np.inf), np.zeros(4000)]
    full = Centroids(first).search(vectors, *state)
    assert (state[0] == Centroids(first).scan(vectors)).all()
    again = Centroids(second, first).search(vectors, *state)
    assert (state[0] == Centroids(second).scan(vectors)).all()
    assert again < 1.2 * 4000 < full


def test_clusters_are_spread_over_tasks(spark):
    """Sums of a task are a few rows, however many members a cluster has."""
    rows = [(i, [0.5, 0.25, 0.125]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    kept = shallot.usable(df, "vec_id", "embedding", 3)
    state = shallot._round(kept, Centroids([[1, 2, 3], [9, 9, 9]]), 64, True)
    assert state.rows.where("pos is not null").count() <= 3 * 2 * 5
    assert shallot._sums(state)[1, shallot.COUNT] == 3000
