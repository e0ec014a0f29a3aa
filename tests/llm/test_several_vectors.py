"""An id with several different vectors takes one of the k places."""

import pytest

from shelfcast.llm import lsh, mtree


@pytest.mark.parametrize("search", [mtree.top_products, lsh.nearest])
def test_an_id_takes_one_place(spark, search):
    rows = [(50, [1.0, 0.0, 0.0])] + [(7, [1.0, 0.01 * i, 0.0]) for i in range(1, 9)]
    rows += [(i, [0.9, 0.2 + i / 1000, 0.0]) for i in range(1, 7)]
    found = search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == [7, 1, 2, 3, 4]
