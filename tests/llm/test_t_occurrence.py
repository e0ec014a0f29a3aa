"""T-occurrence join against a comparison of all pairs."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import t_occurrence
from shelfcast.llm.components import components, contracted
from shelfcast.llm.t_occurrence import Index, needed, occurring, signatures, similar_groups
from tests.llm.conftest import edge_rows, prose


def brute(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(3, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 90 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[root(i)] = min(best.get(root(i), key), key)
    return [(key, len(sets[i]), best.get(root(i))) for i, (key, _) in enumerate(rows)]


def compare(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for c in ("id", "n", "part", "shingle", "prefix", "block", "home", "first", "h0"):
        df = df.selectExpr("*", f"'no' AS {c}")
    got = [tuple(r) for r in similar_groups(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("block", [400, 1 << 18])
def test_groups_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(t_occurrence, "BLOCK_SHINGLES", block)
    rng = random.Random(4)
    rows, key = [], 0
    for group in range(12):
        base = prose(group, rng.choice([9, 11, 30, 120, 300])).split()
        for _ in range(rng.choice([1, 2, 30])):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 40)):
                words[rng.randrange(len(words))] = f"w{rng.random()}"
            rows.append((key * 7 % 1009, " ".join(words[: len(words) - rng.randrange(0, 3)])))
            key += 1
    compare(spark, rows)


def test_a_shared_passage_and_a_chain(spark, monkeypatch):
    """Boilerplate that fills most of unlinked texts, and links that only reach over steps."""
    monkeypatch.setattr(t_occurrence, "BLOCK_SHINGLES", 3000)
    passage = prose(99, 80)
    rows = [(i, f"{passage} {prose(1000 + i, 14)}") for i in range(60)]
    words = prose(5, 200).split()
    rows += [(500 - i, " ".join(words[4 * i : 4 * i + 100])) for i in range(20)]
    compare(spark, rows)


def test_edge_rows_and_nothing(spark, edges, nothing):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    got = [tuple(r) for r in similar_groups(edges).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert similar_groups(nothing).count() == 0
    compare(spark, [(1, None), (2, ""), (None, " "), (3, "a"), (4, "A"), (5, "a b"), (None, "a b")])
    compare(spark, [(1, prose(1, 50)), (1, prose(2, 50)), (1, prose(1, 50)), (0, prose(2, 50)), (None, prose(2, 50))])


def test_documents_in_enough_lists():
    rng = random.Random(6)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randrange(1, 30))) for _ in range(rng.randrange(1, 25))]
        lists.sort(key=len)
        least = rng.randrange(1, len(lists) + 1)
        count = Counter(doc for own in lists for doc in own)
        assert dict(occurring(lists, least)) == {doc: n for doc, n in count.items() if n >= least}


def test_search_of_an_index():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.append(rng.choice(base, 50, replace=False), rng.integers(0, 1 << 60, 3).astype(np.uint64))) for _ in range(80)]
    sets += [np.unique(np.append(base[: 60 - i], np.uint64(i))) for i in range(10)]
    sizes = np.array([len(s) for s in sets])
    part = np.arange(len(sets)) // 2
    index = Index(np.concatenate(sets), sizes, part)
    for q, query in enumerate(sets):
        want = {}
        for d in range(q):
            common = len(np.intersect1d(query, sets[d]))
            if part[d] != part[q] and 100 * common >= 90 * (len(query) + len(sets[d]) - common):
                want[d] = common
        assert dict(index.search(query, part[q], q)) == want


def test_linked_sets_share_a_key():
    """Sizes on both sides of every class, differences up to the last that links."""
    rng = np.random.default_rng(3)
    for n in [*range(1, 60), 99, 100, 101, 250, 640, 1500]:
        for extra in range(n // 9 + 2):
            both = rng.integers(0, 1 << 64, n - extra // 2, dtype=np.uint64)
            more = rng.integers(0, 1 << 64, extra, dtype=np.uint64)
            a, b = np.unique(np.append(both, more[: extra // 2])), np.unique(np.append(both, more[extra // 2 :]))
            common = len(both)
            if extra and 100 * common >= 90 * (len(a) + len(b) - common):
                assert len(np.intersect1d(signatures(a), signatures(b)))
                assert common >= max(needed(len(a)), needed(len(b)))


def test_unlinked_sets_share_few_keys():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 1 << 64, 120, dtype=np.uint64)
    sets = [np.unique(np.append(passage, rng.integers(0, 1 << 64, 40, dtype=np.uint64))) for _ in range(300)]
    keys = np.concatenate([signatures(s) for s in sets])
    assert len(np.unique(keys)) > 0.8 * len(keys)
    assert len(signatures(sets[0])) < 0.3 * len(sets[0])


def test_a_family_that_is_not_one_component_is_searched_quickly():
    """Variants of one text of which most pairs miss the similarity: every search has many candidates."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 145).astype(np.uint64)
    sets = []
    for _ in range(700):
        own = base.copy()
        changed = rng.choice(145, rng.integers(2, 14), replace=False)
        own[changed] = rng.integers(0, 1 << 62, len(changed)).astype(np.uint64)
        sets.append(np.unique(own))
    ids = pa.array(range(700), pa.int64())
    shingles = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
    rows = pa.table({"id": ids, "part": ids, "block": pa.array([0] * 700, pa.int64()), "shingles": shingles})
    began = time.process_time()
    u, v = t_occurrence._linked(rows)
    took = time.process_time() - began
    parent = list(range(700))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = np.array([np.isin(base, s) for s in sets]).astype(int)
    for a, b in zip(*np.nonzero(np.triu(held @ held.T * 100 >= 90 * (290 - held @ held.T), 1))):
        a, b = root(int(a)), root(int(b))
        parent[max(a, b)] = min(a, b)
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {x: root(x) for x in range(700) if root(x) != x}
    assert 1 < len(set(map(root, range(700)))) < 600
    assert took < 3  # 0.4 s; one entry after the other it was 8


def test_stars_are_settled_and_contracted(spark):
    stars = components(spark.createDataFrame([(5, 1), (5, 3), (8, 3), (9, 7), (4, 4)], "u long, v long"))
    assert {(3, 1), (5, 1), (8, 1), (9, 7)} == {tuple(r) for r in stars.rows.collect()}
    out = contracted(stars, spark.createDataFrame([(7, 1), (7, 2), (20, 21)], "u long, v long"))
    want = {(2, 1), (3, 1), (5, 1), (7, 1), (8, 1), (9, 1), (21, 20)}
    assert want == {tuple(r) for r in out.rows.collect()}
