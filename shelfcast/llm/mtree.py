"""Exact top-k by inner product with best-first search in M-trees.

Vectors of whole numbers get one more coordinate that brings all of them to the same norm; the
Euclidean distance to a query (with 0 there) then falls as the inner product rises. Rows go to the
nearest of a bounded number of routing pivots and on into trees of bounded size. A tree is a table of
pages: routing nodes with centre, covering radius and distance to their parent, and leaves whose entries
keep their distance to the leaf's centre. A search takes the node with the least lower bound
first and skips children and entries whose stored distances prove them too far, without computing
their distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged, spread
from shelfcast.llm.vectors import classes, matrix, meet, queries_of, ranked, usable

PIVOTS = 256  # at most; one for every PIVOT_ROWS rows
PIVOT_ROWS = 2048
TREE_ROWS = 8192
TREE_QUERIES = 2048
LEAF, FAN = 128, 16
EXACT = 1 << 53  # up to this squared norm all products are exact in doubles; beyond, they are Python's integers
LARGEST = 1 << 62  # of a component, either sign
PAGES = (
    "cell int, tree long, node int, parent int, leaf boolean, center array<double>, radius double, "
    "to_parent double, distances array<double>, ids array<array<long>>, vectors array<array<long>>"
)
FOUND = "query long, query_id long, vec_id long, score long"


def _lift(vectors: np.ndarray, norm: float) -> np.ndarray:
    """One more coordinate, so that every row has squared norm ``norm``."""
    points = np.asarray(vectors, float)
    rest = norm - (points * points).sum(axis=1)
    return np.column_stack([points, np.sqrt(np.maximum(rest, 0))])


def _to(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - center) ** 2).sum(axis=1))


def _groups(points: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(center, members) with at most ``most`` members each: members go to the nearest of evenly
    taken centers, full groups are cut in order of distance."""
    chosen = points[np.linspace(0, len(points) - 1, -(-len(points) // most)).astype(int)]
    squares = (points**2).sum(1)[:, None] - 2 * points @ chosen.T + (chosen**2).sum(1)
    home = squares.argmin(1)
    out = []
    for c in range(len(chosen)):
        members = np.flatnonzero(home == c)
        members = members[np.argsort(_to(points[members], chosen[c]), kind="stable")]
        out.extend((chosen[c], members[at : at + most]) for at in range(0, len(members), most))
    return out


def build(ids: list, vectors: np.ndarray, norm: int) -> list[dict]:
    """Pages of one tree, bottom up; node 0 is the root."""
    points = _lift(vectors, norm)
    level = []
    for center, members in _groups(points, LEAF):
        distances = _to(points[members], center)
        level.append({
            "leaf": True, "center": center, "radius": float(distances.max()), "children": [],
            "distances": distances, "ids": [ids[i] for i in members], "vectors": vectors[members],
        })
    while len(level) > 1:
        above = []
        for center, members in _groups(np.array([p["center"] for p in level]), FAN):
            below = [level[i] for i in members]
            reach = [float(_to(p["center"][None], center)[0]) for p in below]
            for page, far in zip(below, reach, strict=True):
                page["to_parent"] = far
            radius = max(far + p["radius"] for far, p in zip(reach, below, strict=True))
            above.append({
                "leaf": False, "center": center, "radius": radius, "children": below,
                "distances": [], "ids": [], "vectors": [],
            })
        level = above
    pages, waiting = [], [(level[0], -1)]
    while waiting:
        page, parent = waiting.pop()
        pages.append({"to_parent": 0.0, **page, "node": len(pages), "parent": parent})
        waiting.extend((child, len(pages) - 1) for child in page["children"])
    return pages


class Tree:
    """The pages of a tree, read back."""

    def __init__(self, pages: pd.DataFrame, norm: float):
        pages = pages.sort_values("node")
        self.norm = norm
        self.kind = float if norm < EXACT else object
        self.leaf = pages["leaf"].to_numpy()
        self.center, self.radius = matrix(pages["center"]), pages["radius"].to_numpy()
        self.to_parent = pages["to_parent"].to_numpy()
        parents = pages["parent"].to_numpy()
        self.children = [np.flatnonzero(parents == i) for i in range(len(pages))]
        self.distances = [np.asarray(d) for d in pages["distances"]]
        self.ids = pages["ids"].tolist()
        self.vectors = [np.array([list(map(int, v)) for v in vs], dtype=self.kind) for vs in pages["vectors"]]

    def search(self, query_id: int, query: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """(score, id) of the k best, by score and then smaller id, that reach ``floor``. ``query`` has whole numbers; bounds
        are floating-point numbers with a slack far above their error, whatever the size."""
        asked = np.array(list(map(int, query)), dtype=self.kind)
        query = np.asarray(query, float)
        square = float(query @ query) + self.norm
        slack = 1e-6 * (1 + square**0.5)
        point = np.append(query, 0.0)

        def reach(score: float) -> float:
            return max(0.0, square - 2 * score) ** 0.5 + slack

        best: dict[int, int] = {}  # the best score of each of the k best ids
        worst = -np.inf
        limit = reach(floor) if floor > -np.inf else np.inf
        far = float(_to(self.center[:1], point)[0])
        queue = [(max(0.0, far - self.radius[0]), 0, far)]
        while queue:
            bound, node, far = heapq.heappop(queue)
            if bound > limit:
                break
            if not self.leaf[node]:
                below = self.children[node]
                # Stored distances alone: no child further than this needs its distance computed.
                below = below[np.abs(far - self.to_parent[below]) - self.radius[below] <= limit]
                apart = _to(self.center[below], point)
                for child, own in zip(below.tolist(), apart.tolist(), strict=True):
                    low = max(0.0, own - self.radius[child], bound)
                    if low <= limit:
                        heapq.heappush(queue, (low, child, own))
                continue
            stored = self.distances[node]
            near = np.flatnonzero(np.abs(far - stored) <= limit)
            scores = self.vectors[node][near] @ asked if len(near) else np.zeros(0)
            if len(best) == k:
                ok = scores >= worst
                near, scores = near[ok], scores[ok]
            for i, score in zip(near.tolist(), scores.tolist(), strict=True):
                for v in self.ids[node][i]:
                    if v != query_id and score > best.get(v, -np.inf):
                        best[v] = min(max(int(score), -(1 << 63)), (1 << 63) - 1)
            if len(best) > k:
                best = dict(heapq.nlargest(k, best.items(), key=lambda e: (e[1], -e[0])))
            if len(best) == k:
                worst = min(best.values())
                limit = min(limit, reach(worst))
        return [(score, v) for v, score in best.items()]


def whole_numbers(rows: DataFrame, factor: int = 256) -> DataFrame:
    most = F.lit(float(LARGEST))
    return rows.withColumn(
        "vector",
        F.transform("vector", lambda x: F.floor(F.least(F.greatest(x.cast("double") * factor, -most), most)).cast("long")),
    )


def top_products(
    embeddings: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (id divisible by ``every``) the ``k`` rows
    with the largest inner product of whole-numbered vectors, ties to the smaller id, its own id
    left out; all candidates if there are fewer. The result is exact.

    Null and non-finite vectors, null ids and vectors of another than the table's most frequent length
    take no part. Rows repeated in id and vector count once; an id with several vectors is a query for
    each and a candidate with its best. Products are exact at any size; a component counts as at most
    2**62, and a product beyond a long as the end of the longs. An empty table gives no rows; other
    columns are not read.
    """
    good = usable(embeddings, key, vector, nonzero=False)
    rows = Staged(whole_numbers(good).distinct(), "whole").rows
    index = Staged(classes(rows, k + 1), "classes").rows
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, norm = index.agg(F.count(F.lit(1)), F.max(square)).first()
    norm = norm or 0.0
    count = min(PIVOTS, max(1, n // PIVOT_ROWS))
    drawn = index.orderBy(F.xxhash64("vector"), "vector").limit(count).select("vector").collect()
    pivots = _lift(np.array([list(r["vector"]) for r in drawn], np.int64), norm) if drawn else np.zeros((1, 1))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = _lift(np.array(batch.column("vector").to_pylist(), np.int64), norm)
            squares = -2 * points @ pivots.T + (pivots**2).sum(1)
            cell = squares.argmin(1)
            apart = np.sqrt(((points - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(apart), batch.column("ids"), batch.column("vector")],
                ["cell", "apart", "ids", "vector"],
            )

    placed = Staged(
        index.select("ids", "vector").mapInArrow(
            routed, "cell int, apart double, ids array<long>, vector array<long>"
        ),
        "cells",
    ).rows
    cells = placed.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / TREE_ROWS).alias("trees"), F.max("apart").alias("radius")
    )
    cells = Staged(cells, "routing").rows  # at most PIVOTS rows
    dealt = placed.join(F.broadcast(cells), "cell").withColumn(
        "tree", F.pmod(F.xxhash64("vector"), F.col("trees"))
    )

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        pages = build([list(i) for i in rows["ids"]], matrix(rows["vector"]), norm)
        for page in pages:
            del page["children"]
            page["vectors"] = [list(v) for v in page["vectors"]]
            page["distances"] = list(page["distances"])
        return pd.DataFrame(pages).assign(cell=rows["cell"].iloc[0], tree=rows["tree"].iloc[0])[
            [c.split()[0] for c in PAGES.split(", ")]
        ]

    pages = Staged(
        dealt.select("cell", "tree", "ids", "vector").groupBy("cell", "tree").applyInPandas(grow, PAGES), "pages"
    ).rows
    routing = {r["cell"]: (r["trees"], r["radius"]) for r in cells.collect()}
    used = np.array(sorted(routing), dtype=int)
    reach_of = np.array([routing[c][1] for c in used.tolist()])

    def sent(first: bool):
        """Queries to the trees of the nearest cell, or of all other cells within reach."""

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                vectors = np.array(batch.column("vector").to_pylist(), float)
                points = np.column_stack([vectors, np.zeros(len(vectors))])
                apart = np.sqrt(((points[:, None] - pivots[used][None]) ** 2).sum(2))
                low = np.maximum(0, apart - reach_of)
                nearest = apart.argmin(1)
                chosen = np.zeros(apart.shape, bool)
                chosen[np.arange(len(nearest)), nearest] = True
                if not first:
                    floor = batch.column("floor").to_numpy(zero_copy_only=False)
                    square = (vectors**2).sum(1) + norm
                    limit = np.sqrt(np.maximum(0, square - 2 * np.nan_to_num(floor, nan=-np.inf)))
                    chosen = ~chosen & (low <= (limit + 1e-6 * (1 + np.sqrt(square)))[:, None])
                row, at = np.nonzero(chosen)
                many = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used[at], pa.int32()), *(many.column(c) for c in batch.schema.names)],
                    ["cell", *batch.schema.names],
                )

        return send

    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(queries):
            tree = Tree(data, norm)
            for q in queries.itertuples(index=False):
                floor = -np.inf if q.floor is None or np.isnan(q.floor) else q.floor
                found = tree.search(q.query_id, q.vector, k, floor)
                out.extend((q.query, q.query_id, v, score) for score, v in found)
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        kind = "cell int, query long, query_id long, vector array<long>, floor double"
        to_cells = asked.select("query", "query_id", "vector", "floor").mapInArrow(sent(first), kind)
        to_trees = to_cells.join(F.broadcast(cells), "cell").withColumn(
            "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1))
        )
        to_trees = Staged(to_trees.drop("trees", "radius"), "sent").rows
        # A tree's pages stay together; only its queries are dealt out.
        return meet(pages, to_trees, ["cell", "tree"], F.lit(0), 1 << 40, TREE_QUERIES, search, FOUND)

    asked = spread(queries_of(rows, every), "query")
    opening = Staged(visit(asked.withColumn("floor", F.lit(None).cast("double")), True), "opening").rows
    kth = ranked_floor(opening, k)
    rest = visit(asked.join(kth, "query", "left"), False)
    return ranked(opening.union(rest), k)


def ranked_floor(found: DataFrame, k: int) -> DataFrame:
    """(query, floor): the k-th best score, one for each id, of queries that have k results."""
    once = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    best = once.select("query", "score", place.alias("_place")).where(F.col("_place") <= k)
    kth = best.groupBy("query").agg(F.min("score").cast("double").alias("floor"), F.count(F.lit(1)).alias("_n"))
    return kth.where(F.col("_n") == k).select("query", "floor")
