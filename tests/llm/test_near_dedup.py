"""Near-duplicate groups against a comparison of all pairs."""

import random

from shelfcast.llm import near_dedup
from shelfcast.llm.components import components
from shelfcast.llm.near_dedup import near_duplicates
from tests.llm.conftest import edge_rows, prose


def brute(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) >= 5:
            sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
        else:
            sets.append({tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[root(i)] = min(best.get(root(i), key), key)
    return [(key, len(sets[i]), best.get(root(i))) for i, (key, _) in enumerate(rows)]


def test_groups_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 1500)  # several blocks for one group
    rng = random.Random(3)
    rows, key = [], 0
    for group in range(12):
        base = prose(group, rng.choice([8, 30, 120])).split()
        for _ in range(rng.choice([1, 2, 40])):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"w{rng.random()}"
            rows.append((key * 7 % 1009, " ".join(words)))
            key += 1
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = sorted(brute(rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_edge_rows(edges, nothing):
    got = near_duplicates(edges).collect()
    want = brute([(i, t) for i, t, *_ in edge_rows()])
    want = [(i, n, None if i is None else c) for i, n, c in want]  # no text of a null key equals a keyed one
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].kept and by_id[4].n_shingles == 0
    assert by_id[7].component_id == 6 and not by_id[7].kept
    assert near_duplicates(nothing).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    found = components(spark.createDataFrame(path + star + [(7, 7)], "u long, v long")).rows.collect()
    assert {(r.u, r.v) for r in found} == {(i, 100) for i in range(101, 161)} | {(i, 500) for i in range(501, 560)}
