"""Approximate nearest neighbours by multiprobe p-stable hashing.

Unit vectors are projected on Gaussian directions (made orthogonal while there are dimensions
left), shifted and cut into intervals; a table's interval numbers name a bucket. For a query the
buckets around its own are visited in rising order of the squared distance from its projections
to their edges, the estimated order of success. Candidates of all tables are merged and ranked by
exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged, spread
from shelfcast.llm.vectors import classes, matrix, meet, queries_of, ranked, usable

TABLES, FUNCTIONS, WIDTH, PROBES = 8, 8, 2.0, 160
CELL_ROWS, CELL_QUERIES = 8192, 2048
BITS = 7  # an interval number, clipped to [-64, 63], in a bucket's key
FOUND = "query long, query_id long, vec_id long, score double"


class Family:
    """Hash functions of all tables; fixed by the seed and the dimension."""

    def __init__(self, dimension: int, seed: int = 29):
        source = np.random.default_rng(seed)
        total, blocks = TABLES * FUNCTIONS, []
        while sum(b.shape[1] for b in blocks) < total:
            square = np.linalg.qr(source.normal(size=(dimension, dimension)))[0]
            blocks.append(square * np.sqrt(dimension))
        self.directions = np.hstack(blocks)[:, :total]
        self.shifts = source.uniform(0, WIDTH, total)
        steps = np.array(sorted(product((-1, 0, 1), repeat=FUNCTIONS), key=lambda s: sum(map(abs, s))))
        self.steps = steps[np.abs(steps).sum(1) <= 5]
        self.up, self.down = (self.steps == 1).astype(float).T, (self.steps == -1).astype(float).T

    def places(self, unit: np.ndarray) -> np.ndarray:
        """Positions in intervals, by row, table and function."""
        return ((unit @ self.directions + self.shifts) / WIDTH).reshape(len(unit), TABLES, FUNCTIONS)

    def keys(self, numbers: np.ndarray) -> np.ndarray:
        digits = (np.clip(numbers, -64, 63) + 64).astype(np.int64)
        return (digits << (np.arange(FUNCTIONS) * BITS)).sum(-1)

    def probes(self, place: np.ndarray) -> np.ndarray:
        """Keys of the PROBES likeliest buckets for one query's places in one table."""
        floor = np.floor(place)
        inside = place - floor
        cost = (1 - inside) ** 2 @ self.up + inside**2 @ self.down
        best = np.argsort(cost, kind="stable")[:PROBES]
        return np.unique(self.keys(floor + self.steps[best]))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query; the sum of a row doesn't depend on the other rows."""
    return (_unit(vectors) * _unit(query[None])).sum(axis=1)


def nearest(
    embeddings: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (id divisible by ``every``) the ``k`` rows
    of largest cosine among those found, ties to the smaller id, its own id left out.

    Null, zero or non-finite vectors, null ids and vectors of another than the table's most
    frequent length take no part. Rows repeated in id and vector count once; an id with several vectors
    is a query for each and a candidate with its best. With fewer than ``k`` candidates found there
    are fewer rows; an empty table gives none. Other columns are not read.
    """
    rows = usable(embeddings, key, vector, nonzero=True)
    index = Staged(classes(rows, k + 1), "classes").rows
    n = index.count()
    first = index.select(F.size("vector").alias("size")).first()
    family = Family(first["size"] if first else 1)
    # How many of a bucket's numbers name a cell of tasks: so many that cells stay near CELL_ROWS.
    deep = min(FUNCTIONS, max(1, ceil(log(max(n, 1) / CELL_ROWS) / log(3))))
    mask = (1 << (BITS * deep)) - 1

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.arange(TABLES)
        for batch in batches:
            if not len(batch):
                continue
            keys = family.keys(np.floor(family.places(_unit(_rows(batch.column("vector"))))))
            many = batch.take(pa.array(np.repeat(np.arange(len(batch)), TABLES)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(tables, len(batch)), pa.int32()),
                    pa.array((keys & mask).ravel()),
                    pa.array(keys.ravel()),
                    many.column("ids"),
                    many.column("vector"),
                ],
                ["table", "cell", "bucket", "ids", "vector"],
            )

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], []
            if not len(batch):
                continue
            places = family.places(_unit(_rows(batch.column("vector"))))
            for row in range(len(batch)):
                for t in range(TABLES):
                    buckets = family.probes(places[row, t])
                    cells = buckets & mask
                    for cell in np.unique(cells):
                        for column, value in zip(out, (row, t, cell, buckets[cells == cell]), strict=True):
                            column.append(value)
            many = batch.take(pa.array(out[0], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[1], pa.int32()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3], pa.list_(pa.int64())),
                    *(many.column(c) for c in ("query", "query_id", "vector")),
                ],
                ["table", "cell", "buckets", "query", "query_id", "vector"],
            )

    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(queries):
            data = data.sort_values("bucket", kind="stable")
            buckets, ids = data["bucket"].to_numpy(), data["ids"].tolist()
            vectors = matrix(data["vector"]).astype(float)
            unit = _unit(vectors)
            for q in queries.itertuples(index=False):
                wanted = np.asarray(q.buckets)
                low = np.searchsorted(buckets, wanted)
                high = np.searchsorted(buckets, wanted, side="right")
                found = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])
                if not len(found):
                    continue
                own = np.asarray(q.vector, dtype=float)
                rough = unit[found] @ _unit(own[None])[0]
                least, seen = -np.inf, set()
                for at in np.argsort(-rough, kind="stable"):
                    seen.update(v for v in ids[found[at]] if v != q.query_id)
                    if len(seen) >= k:
                        least = rough[at]
                        break
                found = found[rough >= least - 1e-9]
                scores, top = cosines(vectors[found], own), {}
                for s, i in zip(scores, found, strict=True):
                    for v in ids[i]:
                        if v != q.query_id:
                            top[v] = max(s, top.get(v, s))
                best = sorted((-s, v) for v, s in top.items())[:k]
                out.extend((q.query, q.query_id, v, -s) for s, v in best)
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    vector_type = index.schema["vector"].dataType.simpleString()
    data = index.mapInArrow(
        hashed, f"table int, cell long, bucket long, ids array<long>, vector {vector_type}"
    )
    asked = spread(queries_of(rows, every), "query").mapInArrow(
        probed, f"table int, cell long, buckets array<long>, query long, query_id long, vector {vector_type}"
    )
    data, asked = Staged(data, "hashed").rows, Staged(asked, "probed").rows
    found = meet(data, asked, ["table", "cell"], F.xxhash64("vector"), CELL_ROWS, CELL_QUERIES, search, FOUND)
    return ranked(found, k)
