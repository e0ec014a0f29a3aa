"""The boosted fit against plain loops, and its members."""

import numpy as np
import pytest
from frames import rows_of, week

from shelfcast.functions.histograms import Settings, boost, tree_outputs
from shelfcast.operators import trees

KEY = "week_start date, store_nbr int, item_nbr int"


def loops(columns, actual, settings):
    """Trees by trying every cut of every node, without histograms or subtraction."""

    def soft(g):
        return np.sign(g) * max(abs(g) - settings.l1, 0.0)

    def score(g):
        return soft(g.sum()) ** 2 / (len(g) + settings.l2)

    forecast = np.full(len(actual), actual.mean())
    for _ in range(settings.rounds):
        gradient = forecast - actual
        step = np.zeros(len(actual))

        def grow(rows, depth):
            best = (1e-6, None)
            if depth < settings.depth:
                for c in range(len(columns)):
                    for cut in range(settings.bins - 1):
                        left = columns[c][rows] <= cut
                        if min(left.sum(), (~left).sum()) < settings.least_weight:
                            continue
                        g = gradient[rows]
                        gain = score(g[left]) + score(g[~left]) - score(g)
                        if gain > best[0] + 1e-9:
                            best = (gain, (rows[left], rows[~left]))
            if best[1] is None:
                step[rows] = -settings.rate * soft(gradient[rows].sum()) / (len(rows) + settings.l2)
            else:
                for side in best[1]:
                    grow(side, depth + 1)

        grow(np.arange(len(actual)), 0)
        forecast = forecast + step
    return forecast


@pytest.mark.parametrize("l1,l2,least", [(0.1, 1.0, 5.0), (30.0, 0.0, 1.0), (0.0, 50.0, 20.0)])
def test_equals_every_cut_tried(l1, l2, least):
    rng = np.random.default_rng(3)
    columns = rng.integers(0, 12, (4, 300)).astype(np.uint8)
    actual = 3.0 * columns[0] - 2.0 * (columns[1] > 5) * columns[2] + rng.normal(0, 1, 300)
    settings = Settings(rounds=6, depth=3, rate=0.4, row_share=1.0, column_share=1.0, least_weight=least, l2=l2, l1=l1, bins=12)
    forest = boost(columns, actual, settings)
    got = np.full(300, forest.base)
    for t in range(settings.rounds):
        got += tree_outputs(columns, forest.feature[t], forest.cut[t], forest.value[t], settings.depth)
    assert got == pytest.approx(loops(columns, actual, settings), abs=1e-8)


def test_penalties_shrink_leaves_and_small_nodes_stay_whole():
    rng = np.random.default_rng(1)
    columns = rng.integers(0, 30, (3, 400)).astype(np.uint8)
    actual = columns[0] * 1.0 + rng.normal(0, 0.1, 400)
    plain = boost(columns, actual, Settings(rounds=1, row_share=1.0, column_share=1.0, l1=0.0, l2=0.0))
    strict = boost(columns, actual, Settings(rounds=1, row_share=1.0, column_share=1.0, l1=0.0, l2=100.0))
    assert np.abs(strict.value).max() < np.abs(plain.value).max()
    none = boost(columns, actual, Settings(rounds=3, l1=1e9))
    assert (none.feature == -1).all() and not none.value.any()
    assert (boost(columns, actual, Settings(rounds=2, least_weight=300.0)).feature == -1).all()


def test_all_rounds_and_draws():
    rng = np.random.default_rng(2)
    columns = rng.integers(0, 50, (10, 500)).astype(np.uint8)
    actual = np.sin(columns[0] / 8.0) * 10 + columns[1] * 0.1
    settings = Settings()
    forest = boost(columns, actual, settings)
    assert forest.feature.shape == (500, 127)
    got = np.full(500, forest.base)
    errors = []
    for t in range(500):
        got += tree_outputs(columns, forest.feature[t], forest.cut[t], forest.value[t], settings.depth)
        errors.append(np.mean((got - actual) ** 2))
    assert errors[-1] < 0.05 * errors[0] and errors[-1] < errors[100]
    used = [set(row[row >= 0]) for row in forest.feature]
    assert all(len(u) <= 8 for u in used) and len(set(map(frozenset, used))) > 20
    assert boost(np.zeros((2, 0), np.uint8), np.zeros(0), Settings(rounds=2)).base == 0.0


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(5)
    rows = [
        (week(w), s, i, float(rng.normal()), float(rng.integers(0, 4)), None if i == 3 else float(rng.normal()))
        for w in range(50) for s in range(2) for i in range(6)
    ]
    df = spark.createDataFrame(rows, KEY + ", x double, z double, gap double").selectExpr(
        "*", "20 + 5 * z + if(x > 0, 10, 0) + gap * 0 AS weekly_units"
    )
    return df.na.drop().cache()


def test_members_cover_all_rows_and_do_not_depend_on_the_layout(spark, matrix, monkeypatch):
    one = trees.train_trees(matrix, ("x", "z"), rounds=20, rate=0.3)
    again = trees.train_trees(matrix.repartition(7, "x"), ("x", "z"), rounds=20, rate=0.3)
    assert len(one.forests) == 1
    assert rows_of(trees.predict(matrix, one)) == rows_of(trees.predict(matrix, again))
    monkeypatch.setattr(trees, "MEMBER_ROWS", 150)
    four = trees.train_trees(matrix, ("x", "z"), rounds=20, rate=0.3)
    assert len(four.forests) == 4
    mean = sum(f.base for f in four.forests) / 4
    assert mean == pytest.approx(one.forests[0].base, abs=1.0)

    def error(model):
        return trees.predict(matrix, model).selectExpr("avg(abs(xgb_forecast - weekly_units)) AS e").first()["e"]

    assert error(one) < 0.5 and error(four) < 1.0


def test_folds_train_together_and_score_every_round(matrix):
    scores = trees.fold_scores(matrix, ("x", "z"), n_splits=3, rounds=15, rate=0.3).toPandas()
    assert len(scores) == 3 * 15 and scores["n_rows"].gt(0).all()
    first, last = (scores[scores["rounds"] == r].set_index("fold")["mape"].sort_index() for r in (1, 15))
    assert (last < 0.3 * first).all()
    # A fold's last error is that of a model trained on its rows alone, but for the bins.
    folded = trees.with_test_fold(matrix, trees.fold_starts(matrix, 3)).cache()
    alone = trees.train_trees(folded.where("test_fold < 2"), ("x", "z"), rounds=15, rate=0.3)
    tested = trees.predict(folded.where("test_fold = 2"), alone)
    error = tested.selectExpr("avg(abs(xgb_forecast - weekly_units) / weekly_units) AS e").first()["e"]
    assert error == pytest.approx(last[2], abs=0.02)


def test_first_cut_is_the_best_stump(matrix):
    found = {r["feature"]: r for r in trees.stumps(matrix, ("x", "z")).collect()}
    best = max(found.values(), key=lambda r: r["gain"])
    fitted = trees.train_trees(matrix, ("x", "z"), rounds=1, depth=1, row_share=1.0, column_share=1.0, rate=1.0)
    forest = fitted.forests[0]
    assert fitted.columns[forest.feature[0, 0]] == best["feature"] == "z"
    assert forest.gain[0, 0] == pytest.approx(best["gain"])
    assert forest.value[0, 1] == pytest.approx(best["left_weight"])
    assert forest.value[0, 2] == pytest.approx(best["right_weight"])


def test_a_model_without_rows_forecasts_zero(spark, matrix):
    model = trees.train_trees(matrix.where("x > 1e9"), ("x", "z"), rounds=2)
    assert {r[0] for r in trees.predict(matrix, model).select("xgb_forecast").collect()} == {0.0}
