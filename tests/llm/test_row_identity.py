"""Rows with null or shared ids keep their own verdicts."""

import corpus_pipeline
from shelfcast.llm import quality
from shelfcast.llm.near_dedup import near_duplicates
from tests.llm.conftest import SCHEMA, prose

DATA = "/root/testdata/sf0.001"


def rows():
    words = prose(31, 200).split()

    def changed(*places):
        return " ".join("other" if i in places else w for i, w in enumerate(words))

    # Five shingles change with each word: 1 and the null row are linked, the null row and 2, but not 1 and 2.
    chain = [(1, changed(20, 40, 60)), (None, changed()), (2, changed(100, 120, 140))]
    alone = prose(77, 90)
    nulls = [(None, alone), (None, alone), (None, alone + " tail")]
    shared = [(3, prose(5, 50)), (3, prose(6, 50)), (4, prose(6, 50) + " tail"), (3, prose(5, 50))]
    empty = [(None, None), (None, " "), (5, ""), (5, "")]
    return [(i, t, "en", "a", 0) for i, t in chain + nulls + shared + empty]


def test_links_of_null_and_shared_ids(spark):
    got = near_duplicates(spark.createDataFrame(rows(), SCHEMA)).collect()
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert {r.component_id for r in got if r.doc_id == 4} == {3}
    lone = [r for r in got if r.doc_id is None and r.n_shingles in (86, 87)]
    assert len(lone) == 3 and 1 <= sum(r.kept for r in lone) <= 2
    assert not any(r.kept for r in got if r.doc_id is None and r.n_shingles == 196)


def test_stage_keeps_one_text_of_each_group(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, DATA).collect()]
    assert [i for i, _ in kept if i in (1, 2, 4)] == [1]
    assert sorted(t for i, t in kept if i == 3) == sorted({t for i, t, *_ in rows() if i == 3})
    assert len([t for i, t in kept if i is None and (t or "").strip()]) == 1
    assert len([t for i, t in kept if not (t or "").strip()]) == 3


def test_a_rejected_text_without_id_does_not_come_back(spark, monkeypatch):
    monkeypatch.setattr(quality.Model, "score", lambda self, stats: (stats[:, 0] > 3) * 1.0)
    docs = spark.createDataFrame([(None, "a", "en", "a", 1), (None, prose(1, 300), "en", "a", 1)], SCHEMA)
    scores = {r.score for r in quality.quality_scores(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    kept = corpus_pipeline.accept_quality(spark, docs, DATA)
    assert scores == {0.0, 1.0} and kept.count() == 1
