import math

import numpy as np
import pandas as pd
import pytest
from frames import design as design_frame, rows_of

from shelfcast import schemas
from shelfcast.functions.labels import elasticity_bucket
from shelfcast.functions.tails import normal_pvalue, student_t_pvalue
from shelfcast.operators import elasticity as el
from shelfcast.sources.staging import stage
from pyspark.sql import functions as F

COLUMNS = (
    "week_start date, store_nbr int, item_nbr int, year int, week_of_year int, "
    "weekly_units double, rolling_mean_4w double, any_promo int"
)


def frame(spark, pdf):
    rows = pdf.astype(object).where(pdf.notna(), None).to_numpy().tolist()
    return spark.createDataFrame([tuple(r) for r in rows], COLUMNS)


def one(spark, pdf):
    (row,) = el.run_elasticity(frame(spark, pdf), stage).collect()
    return row


def numpy_fits(pdf):
    """Both regressions by dense least squares, with the published formulas."""
    pdf = pdf.sort_values(["store_nbr", "week_start"]).reset_index(drop=True)
    y = np.log1p(pdf.weekly_units.to_numpy())
    base = np.log1p(pdf.rolling_mean_4w.fillna(0).to_numpy())
    t = pdf.groupby(["store_nbr", "item_nbr"])["week_start"].rank().to_numpy()
    post = (pdf.year >= pdf.year.median()).astype(float).to_numpy()
    promo, woy = pdf.any_promo.to_numpy(float), pdf.week_of_year.to_numpy(float)
    dummies = np.stack([(pdf.store_nbr == s).astype(float) for s in pdf.store_nbr.unique()], 1)
    x = np.column_stack([promo, base, woy, t, dummies])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    e = y - x @ beta
    n, k = x.shape
    inv = np.linalg.inv(x.T @ x)
    se = math.sqrt(e @ e / (n - k) * inv[0, 0])
    tss = ((y - y.mean()) ** 2).sum()
    aic = n * (math.log(2 * math.pi) + math.log(e @ e / n) + 1) + 2 * k
    ols = (beta[0], beta[1], 1 - e @ e / tss, n, beta[0] / se, n - k, aic)
    z = np.column_stack([np.ones(n), promo, post, promo * post, t, woy])
    gamma = np.linalg.lstsq(z, y, rcond=None)[0]
    u = y - z @ gamma
    zi = np.linalg.inv(z.T @ z)
    h = np.einsum("ij,jk,ik->i", z, zi, z)
    cov = zi @ (z.T * (u / (1 - h)) ** 2) @ z @ zi
    return ols, (gamma[3], math.sqrt(cov[3, 3]), 1 - u @ u / tss)


@pytest.mark.parametrize("stores", [(1,), (1, 2, 3)])
def test_fits_equal_dense_least_squares(spark, stores):
    pdf = design_frame(stores=stores)
    row = one(spark, pdf)
    ols, did = numpy_fits(pdf)
    assert (row["elasticity_promo"], row["elasticity_baseline"], row["r_squared"]) == pytest.approx(
        ols[:3], rel=1e-8)
    assert row["n_obs"] == ols[3]
    assert row["aic"] == pytest.approx(ols[6], rel=1e-9)
    assert row["p_value_promo"] == pytest.approx(t_tail(ols[4], ols[5]), rel=1e-6)
    assert (row["did_att"], row["did_se"], row["did_r2"]) == pytest.approx(did, rel=1e-8)
    assert row["did_pvalue"] == pytest.approx(math.erfc(abs(did[0] / did[1]) / math.sqrt(2)), rel=1e-6)
    assert 0 <= row["r_squared"] <= 1


def test_many_items_match_one_by_one(spark):
    frames = [design_frame(item=i, seed=i, stores=tuple(range(1, i + 2))) for i in range(1, 5)]
    got = {r["sku"]: r for r in el.run_elasticity(frame(spark, pd.concat(frames)), stage).collect()}
    for pdf in frames:
        ols, did = numpy_fits(pdf)
        row = got[str(pdf.item_nbr.iloc[0])]
        assert row["elasticity_promo"] == pytest.approx(ols[0], rel=1e-7)
        assert row["did_se"] == pytest.approx(did[1], rel=1e-7)


def test_too_few_rows_give_no_result(spark):
    pdf = design_frame(n_weeks=51, stores=(1,))
    result = el.run_elasticity(frame(spark, pdf), stage)
    assert result.count() == 0
    assert schemas.same_fields(result.schema, schemas.ELASTICITY)
    assert rows_of(el.elasticity_summary(result)) == [(None, None, None, 0)]


@pytest.mark.parametrize("promo", [0, 1])
def test_constant_promotion_is_not_identified(spark, promo):
    row = one(spark, design_frame().assign(any_promo=promo))
    assert row["elasticity_promo"] is None and row["p_value_promo"] is None
    assert row["did_att"] is None and row["did_se"] is None and row["did_pvalue"] is None
    assert row["elasticity_baseline"] is not None and 0 <= row["r_squared"] <= 1


def test_row_with_leverage_one_keeps_the_coefficient_only(spark):
    pdf = design_frame()
    pdf["any_promo"] = 0
    early = pdf.index[(pdf.year == 2018)][:10]
    pdf.loc[early, "any_promo"] = 1
    pdf.loc[pdf.index[(pdf.year > 2018)][:1], "any_promo"] = 1
    row = one(spark, pdf)
    assert row["did_att"] is not None
    assert row["did_se"] is None and row["did_pvalue"] is None


def test_rows_without_a_promotion_flag(spark):
    pdf = design_frame()
    pdf["any_promo"] = pdf["any_promo"].astype("object")
    pdf.loc[[0, 5, 90], "any_promo"] = None
    row = one(spark, pdf)
    assert row["n_obs"] == len(pdf) - 3
    assert row["elasticity_promo"] is not None
    assert row["did_att"] is None
    nothing = design_frame()
    nothing["any_promo"] = None
    assert el.run_elasticity(frame(spark, nothing), stage).count() == 0


def test_constant_units_have_no_r2(spark):
    row = one(spark, design_frame().assign(weekly_units=4.0))
    assert row["elasticity_promo"] == pytest.approx(0.0, abs=1e-12)
    assert row["p_value_promo"] is None


def test_design_columns(spark):
    pdf = design_frame(stores=(1, 2))
    pdf.loc[3, "rolling_mean_4w"] = None
    got = el.build_log_log_features(frame(spark, pdf)).toPandas()
    assert got["log_units"].notna().all()
    assert (got["log_demand_baseline"] == 0).sum() == 1
    expected = got.groupby(["store_nbr", "item_nbr"])["week_start"].rank()
    np.testing.assert_array_equal(got["t"], expected)
    np.testing.assert_array_equal(got["post"], (got.year >= pdf.year.median()).astype(int))


def test_tied_weeks_share_their_average_rank(spark):
    pdf = pd.concat([design_frame(n_weeks=3, stores=(1,)), design_frame(n_weeks=2, stores=(1,))])
    got = el.log_columns(frame(spark, pdf))
    assert rows_of(got, "t") == [(1.5,), (1.5,), (3.5,), (3.5,), (5.0,)]


def test_fractional_median_year(spark):
    pdf = design_frame(n_weeks=80, stores=(1,))
    got = el.build_log_log_features(frame(spark, pdf))
    assert rows_of(got.groupBy("year", "post").count()) == [(2018, 0, 40), (2019, 1, 40)]


def test_items_fitted_by_one_model_only_stay(spark):
    ols = spark.createDataFrame([("1", 0.1, 0.2, 0.3, 60, 0.4, 5.0)], schemas.OLS)
    did = spark.createDataFrame([("2", 0.5, 0.1, 0.01, 0.2)], schemas.DID)
    assert rows_of(el.combine(ols, did), "sku", "elasticity_promo", "did_att") == [
        ("1", 0.1, None), ("2", None, 0.5)]
    empty = spark.createDataFrame([], schemas.DID)
    assert el.combine(ols, empty).count() == 1


def test_summary_counts_missing_p_as_not_significant(spark):
    rows = [("1", 0.1, 0.0, 0.5, 60, 0.1, 1.0, 0.1, 0.1, 0.01, 0.1),
            ("2", 0.4, 0.0, 0.1, 60, 0.1, 1.0, 0.1, 0.1, None, 0.1)]
    assert rows_of(el.elasticity_summary(spark.createDataFrame(rows, schemas.ELASTICITY))) == [
        (0.25, 0.5, 0.3, 2)]


def test_bucket_edges_are_right_closed(spark):
    values = [-9.0, -0.5, -0.1, 0.1, 0.5, 0.51, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(elasticity_bucket(F.col("v"))).collect()]
    assert got == ["highly_elastic", "highly_elastic", "elastic", "inelastic",
                   "slightly_inelastic", "highly_inelastic", None, None]


def integral(of, low, high, pieces=200_000):
    x = np.linspace(low, high, 2 * pieces + 1)
    y = of(x)
    return (y[0] + y[-1] + 4 * y[1::2].sum() + 2 * y[2:-1:2].sum()) * (high - low) / (6 * pieces)


def t_tail(t, df):
    """By quadrature: the share of cos(x) ** (df - 1) beyond atan(|t| / sqrt(df))."""
    def of(x):
        return np.cos(x) ** (df - 1)
    return integral(of, math.atan(abs(t) / math.sqrt(df)), math.pi / 2) / integral(of, 0, math.pi / 2)


def test_t_tails_in_the_jvm(spark):
    pairs = [(t, df) for df in (1.0, 2.0, 3.0, 7.0, 30.0, 121.0, 1000.0, 20000.0) for t in (0.0, 1e-3, 0.5, -1.9, 2.6, 7.0, 40.0)]
    df = spark.createDataFrame(pairs, "t double, df double").select("t", "df", student_t_pvalue("t", "df").alias("p"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for t, free, p in df.collect():
        assert p == pytest.approx(t_tail(t, free), rel=1e-8, abs=1e-13)
    # Published table values: 95 % points with 1, 10 and 1000 degrees of freedom.
    points = spark.createDataFrame([(12.706205, 1.0), (2.228139, 10.0), (1.962339, 1000.0)], "t double, df double")
    for (p,) in points.select(student_t_pvalue("t", "df")).collect():
        assert p == pytest.approx(0.05, abs=2e-7)
    odd = spark.createDataFrame(
        [(None, 3.0), (float("nan"), 3.0), (float("inf"), 3.0), (1.0, 0.0), (1.0, None)], "t double, df double"
    )
    assert [r[0] for r in odd.select(student_t_pvalue("t", "df")).collect()] == [None] * 5


def test_normal_tails_in_the_jvm(spark):
    values = [0.0, 1e-9, 0.3, -1.0, 1.959963984540054, 3.5, -3.54, 6.0, 20.0, 38.0]
    df = spark.createDataFrame([(v,) for v in values], "z double").select("z", normal_pvalue("z").alias("p"))
    for z, p in df.collect():
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-12)
    assert spark.createDataFrame([(None,), (float("nan"),)], "z double").select(normal_pvalue("z")).distinct().collect() == [(None,)]
