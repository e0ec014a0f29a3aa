"""Vector searches against brute force, the classifier on held-out labels, the pipeline's stages."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, canonical
from shelfcast.llm import lsh, mtree, queries
from shelfcast.llm.quality import pool_adjacent, quality_scores, statistics
from tests.llm.conftest import clashing, edge_rows

DATA = "/root/testdata/sf0.001"


def vectors(n=400, dimension=8):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(n, dimension)), 1)
    x[50:120] = x[50]  # one vector many times
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(1000, None), (1050, [None] * dimension), (1100, [float("nan")] * dimension), (None, rows[0][1]),
           (1150, [0.0] * dimension), (1200, [1.0]), (1250, []), (50, rows[50][1]), (1300, [float("inf")] * dimension)]
    return rows, odd


def frame(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def brute(rows, score):
    out = {}
    for q, x in rows:
        if q % 50 == 0:
            best = sorted((-score(x, y), v) for v, y in rows if v != q)[:5]
            out[q] = [(v, -s) for s, v in best]
    return out


def test_mtree_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PIVOT_ROWS", 60)
    monkeypatch.setattr(mtree, "TREE_ROWS", 50)
    monkeypatch.setattr(mtree, "LEAF", 8)
    monkeypatch.setattr(mtree, "FAN", 3)
    rows, odd = vectors()
    whole = [(i, np.floor(np.array(x, np.float32).astype(float) * 256)) for i, x in rows]
    want = brute([*whole, (1150, np.zeros(8))], lambda a, b: int(a @ b))
    got = mtree.top_products(frame(spark, rows + odd)).collect()
    for q in want:
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want[q]
    assert {r.query_id for r in got} == set(want)
    assert mtree.top_products(frame(spark, rows[:0])).count() == 0
    assert mtree.top_products(frame(spark, rows[:1])).count() == 0


def test_lsh_recall_and_scores(spark):
    rows, odd = vectors(600, 16)
    def cosine(a, b):
        a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
        return round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9)
    want = brute(rows, cosine)
    got = lsh.nearest(frame(spark, rows + odd)).collect()
    by_id = dict(rows)
    for r in got:
        assert abs(cosine(by_id[r.query_id], by_id[r.vec_id]) - r.score) < 1e-8
    hits = sum((r.vec_id in {v for v, _ in want[r.query_id]}) for r in got)
    assert {r.query_id for r in got} == set(want) and hits >= 0.9 * 5 * len(want)
    ties = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 50]
    assert ties == [51, 52, 53, 54, 55]
    assert lsh.nearest(frame(spark, rows[:0])).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    mine = queries.QUERIES[name](spark, DATA).toPandas()
    theirs = base.execute(queries.ORACLES[name]).df()
    assert canonical(mine[list(theirs.columns)]) == canonical(theirs)


def test_recall_on_the_table(spark):
    got = queries.op9_multiprobe_lsh(spark, DATA).toPandas()
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    unit = np.stack(rows["embedding"]).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids, hits = rows["vec_id"].to_numpy(), 0
    for q, found in got.groupby("query_id"):
        own = np.flatnonzero(ids == q)[0]
        scores = unit @ unit[own]
        scores[own] = -9
        hits += len(set(found["vec_id"]) & set(ids[np.argsort(-scores)[:5]]))
    assert hits >= 0.9 * len(got)


def test_isotonic_blocks():
    x, y = pool_adjacent(np.arange(5.0), np.array([0, 0.5, 0.2, 0.2, 1]), np.array([1, 1, 1, 2, 1.0]))
    assert np.allclose(y, [0, 0.275, 1]) and np.allclose(x, [0, 2.25, 4])


def test_statistics_are_finite():
    for text in ("", " ", "\n\n", "a", "A" * 100_000, "ß 🙂"):
        assert np.isfinite(statistics(text)).all()


def test_quality_on_held_out_labels(spark):
    scores = queries.op2_fourier_quality(spark, "/root/testdata/sf0.01")
    rows = scores.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean() > 0.97
    assert (rows.predicted == rows.quality).mean() > 0.95


def test_quality_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_scores(edges, labels).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, *_ in edge_rows()), key=repr)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0.5 for r in quality_scores(edges, labels.limit(0)).collect())
    assert quality_scores(nothing, labels).count() == 0


def test_pipeline_stages_follow_their_decisions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scores = quality_scores(docs, spark.read.parquet(f"{DATA}/labels.parquet")).where("score >= 0.3")
    first = corpus_pipeline.accept_quality(spark, docs, DATA)
    assert sorted(r.doc_id for r in first.collect()) == sorted(r.doc_id for r in scores.collect())
    second = corpus_pipeline.drop_near_duplicates(spark, first, DATA)
    verdicts = queries.ORACLES["op5_circulant_minhash"]
    base = duckdb.connect()
    base.register("documents", first.toPandas())
    want = [r[0] for r in base.execute(f"SELECT doc_id FROM ({verdicts}) WHERE kept").fetchall()]
    assert sorted(r.doc_id for r in second.collect()) == sorted(want)
    third = corpus_pipeline.mix_sources(spark, second, DATA)
    assert third.columns == docs.columns
    words = F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))
    ratio = third.agg(words).first()[0] / second.agg(words).first()[0]
    assert abs(ratio - 1.5) < 0.03
    last = corpus_pipeline.pack_sequences(spark, third, DATA)
    full = last.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in full) <= 2048


def test_pipeline_runs_on_nothing(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.count() == 0


def test_mtree_is_exact_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PIVOT_ROWS", 40)
    monkeypatch.setattr(mtree, "TREE_ROWS", 30)
    monkeypatch.setattr(mtree, "LEAF", 6)
    rng, kind = random.Random(12), "vec_id long, embedding array<double>"
    for sizes in ((1.0, 16384.0), (1.0, 3e6, 9e6)):
        rows = [(i, [rng.choice(sizes) * rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
        whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
        got = {}
        for r in mtree.top_products(clashing(spark.createDataFrame(rows, kind))).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        for q in (i for i in whole if i % 50 == 0):
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    # Beyond the longs: no error, and the ends of the longs instead.
    far = mtree.top_products(clashing(spark.createDataFrame([(0, [1e300, 0.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1.0, 1.0])], kind)))
    assert [(r.vec_id, r.score) for r in sorted(far.collect())][0] == (1, 2**63 - 1)
