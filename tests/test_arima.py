import numpy as np
import pandas as pd
import pytest
from frames import rows_of, week

from shelfcast import schemas
from shelfcast.functions import arma
from shelfcast.functions.arma import forecast_batch
from shelfcast.operators.arima import forecast_all_skus_arima, histories


def sales_series(n, seed=0, trend=0.5, noise=5.0):
    rng = np.random.default_rng(seed)
    return np.clip(100 + trend * np.arange(n) + noise * rng.standard_normal(n), 0, None)


def simulate(n, c, seed):
    phi1, phi2, th1, th2 = c
    e = np.random.default_rng(seed).standard_normal(n + 200)
    w = np.zeros(n + 200)
    for t in range(2, n + 200):
        w[t] = phi1 * w[t - 1] + phi2 * w[t - 2] + e[t] + th1 * e[t - 1] + th2 * e[t - 2]
    return w[200:]


def dense_criterion(w, c, p=2):
    """Concentrated exact Gaussian deviance of the values that are there, from the full covariance matrix."""
    phi, theta = list(c[:p]), [1.0, *c[p:]]
    psi = np.zeros(3000)
    for k in range(len(psi)):
        psi[k] = theta[k] if k < len(theta) else 0.0
        psi[k] += sum(phi[j] * psi[k - 1 - j] for j in range(min(p, k)))
    n = len(w)
    gamma = np.array([psi[: len(psi) - h] @ psi[h:] for h in range(n)])
    there = np.isfinite(w)
    cov = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))][np.ix_(there, there)]
    chol = np.linalg.cholesky(cov)
    z = np.linalg.solve(chol, w[there])
    n = there.sum()
    return n * np.log(z @ z / n) + 2 * np.log(np.diag(chol)).sum()


def criterion(w, c, p=2):
    """The same from the filter."""
    seen = np.isfinite(w)[None, :]
    residual, _ = arma._filter(np.nan_to_num(w)[None, :], seen, np.asarray(c, float)[None, :], p)
    return seen.sum() * np.log((residual**2).sum() / seen.sum())


def fitted(w, p=2, q=2):
    seen = np.isfinite(w)[None, :]
    w = np.nan_to_num(w)[None, :]
    start = arma._to_unconstrained(arma._start_values(w[0], p, q)[None, :], p)
    u, done = arma._maximise(w, seen, start, p)
    assert done.all()
    return arma._to_coefficients(u, p)[0]


def test_horizon_and_sign():
    got = forecast_batch([sales_series(104)], 12)
    assert got.shape == (1, 12) and (got >= 0).all() and got.max() > 0


def test_short_and_broken_series_give_zeros():
    broken, nothing = sales_series(60), np.full(60, np.nan)
    broken[7] = np.inf
    got, done = arma.fit_batch([sales_series(23), broken, np.array([]), nothing, sales_series(24)], 12)
    assert (got[:4] == 0).all() and (got[4] > 0).all()
    assert done.tolist() == [False] * 4 + [True]


def test_a_series_that_still_improves_is_not_fitted(monkeypatch):
    monkeypatch.setattr(arma, "MAX_STEPS", 1)
    got, done = arma.fit_batch([sales_series(104)], 12)
    assert not done.any() and not got.any()


ORDERS = [(2, 2, (0.5, -0.3, 0.4, 0.2)), (1, 0, (0.7,)), (0, 1, (0.5,)), (3, 1, (0.5, -0.2, 0.1, 0.4)), (1, 3, (0.6, 0.3, -0.2, 0.1))]


@pytest.mark.parametrize("p,q,c", ORDERS)
@pytest.mark.parametrize("gaps", [(), (0, 1, 7, 30, 31, 32, 58)])
def test_filter_equals_the_dense_likelihood(p, q, c, gaps):
    w = np.random.default_rng(1).standard_normal(60)
    w[list(gaps)] = np.nan
    assert criterion(w, c, p) == pytest.approx(dense_criterion(w, c, p), rel=1e-9)


@pytest.mark.parametrize("p,q,c", ORDERS)
def test_fit_of_any_order_is_a_maximum_over_gaps(p, q, c):
    rng = np.random.default_rng(p + 7 * q)
    e = rng.standard_normal(400)
    w = np.zeros(400)
    for t in range(5, 400):
        w[t] = sum(c[j] * w[t - 1 - j] for j in range(p)) + e[t] + sum(c[p + j] * e[t - 1 - j] for j in range(q))
    w = w[250:]
    w[rng.choice(150, 12, replace=False)] = np.nan
    best = fitted(w, p, q)
    at_best = dense_criterion(w, best, p)
    for k in range(p + q):
        for step in (-0.02, 0.02):
            assert dense_criterion(w, best + step * np.eye(p + q)[k], p) >= at_best - 1e-6


def test_coefficients_and_partial_autocorrelations_are_inverse():
    u = np.random.default_rng(2).normal(0, 0.8, (50, 7))
    np.testing.assert_allclose(arma._to_unconstrained(arma._to_coefficients(u, 4), 4), u, atol=1e-8)
    assert not arma._reflections(np.array([[1.5, 0.2]])).any()


@pytest.mark.parametrize("order", [(2, 1, 2), (1, 0, 0), (0, 1, 0), (0, 2, 1), (0, 0, 0), (1, 1, 1), (3, 2, 2)])
def test_every_order_forecasts(order):
    straight = 50 + 2.0 * np.arange(80) + 0.01 * np.random.default_rng(0).standard_normal(80)
    got, done = arma.fit_batch([straight, sales_series(60)], 6, order=order)
    assert done.all() and np.isfinite(got).all() and (got > 0).all()
    if order[1] == 2:
        np.testing.assert_allclose(got[0], 50 + 2.0 * np.arange(80, 86), atol=1.0)
    if order == (0, 1, 0):
        np.testing.assert_allclose(got[0], straight[-1])
    if order == (0, 0, 0):
        np.testing.assert_allclose(got[0], straight.mean())


def test_missing_values_are_stepped_over():
    whole = sales_series(120, noise=3.0)
    holes = whole.copy()
    holes[[5, 40, 41, 90]] = np.nan
    got, done = arma.fit_batch([whole, holes, np.r_[np.nan, np.nan, whole], np.r_[whole, np.nan, np.nan]], 8)
    assert done.all()
    np.testing.assert_allclose(got[1], got[0], rtol=0.1)
    np.testing.assert_allclose(got[2], got[0], rtol=1e-3)
    longer = arma.forecast_batch([whole], 10)[0]
    np.testing.assert_allclose(got[3], longer[2:], rtol=1e-3)


def test_falling_series_is_clipped_at_zero():
    got = forecast_batch([np.linspace(100, 0, 60) + np.random.default_rng(0).normal(0, 0.1, 60)], 12)
    assert (got >= 0).all() and got[0, -1] == 0


def test_constant_series_stays():
    np.testing.assert_allclose(forecast_batch([np.full(40, 7.0)], 12), 7.0)


@pytest.mark.parametrize("seed", range(4))
def test_fit_is_a_maximum_of_the_dense_likelihood(seed):
    w = simulate(150, (0.5, -0.3, 0.4, 0.2), seed)
    best = fitted(w)
    at_best = dense_criterion(w, best)
    for k in range(4):
        for step in (-0.02, 0.02):
            assert dense_criterion(w, best + step * np.eye(4)[k]) >= at_best - 1e-6


def test_parameters_are_recovered():
    # Autoregressive and moving-average roots lie apart, so the four numbers are well determined.
    true = np.array([1.1, -0.5, 0.6, 0.3])
    np.testing.assert_allclose(fitted(simulate(4000, true, 5)), true, atol=0.1)


@pytest.mark.parametrize("seed", range(6))
def test_fit_is_not_worse_than_the_true_parameters(seed):
    true = np.array([0.5, -0.3, 0.4, 0.2])
    w = simulate(1000, true, seed)

    def cost(c):
        return (arma._filter(w[None, :], np.ones((1, len(w)), bool), c[None, :], 2)[0] ** 2).sum()

    assert cost(fitted(w)) <= cost(true) * (1 + 1e-9)


def test_forecast_follows_the_recursion():
    w = simulate(200, (0.6, -0.2, 0.3, 0.1), 3)
    y = 500 + np.cumsum(w)
    got = forecast_batch([np.concatenate([[500.0], y])], 3)[0]
    c = fitted(w / np.sqrt(np.mean(w**2)))
    e = np.zeros(200)
    for t in range(200):
        e[t] = w[t] - c[0] * w[t - 1] * (t > 0) - c[1] * w[t - 2] * (t > 1)
        e[t] -= c[2] * e[t - 1] * (t > 0) + c[3] * e[t - 2] * (t > 1)
    w1 = c[0] * w[-1] + c[1] * w[-2] + c[2] * e[-1] + c[3] * e[-2]
    w2 = c[0] * w1 + c[1] * w[-1] + c[3] * e[-1]
    w3 = c[0] * w2 + c[1] * w1
    np.testing.assert_allclose(got, y[-1] + np.cumsum([w1, w2, w3]), atol=1e-6)


def test_result_does_not_depend_on_the_batch():
    series = [sales_series(n, seed=n) for n in (24, 40, 104, 300)]
    together = forecast_batch(series, 12)
    alone = np.concatenate([forecast_batch([s], 12) for s in series])
    np.testing.assert_allclose(together, alone, rtol=1e-4)


def test_every_series_on_spark(spark):
    rows = [(week(w), 1, 1, float(v)) for w, v in enumerate(sales_series(60))]
    rows += [(week(w), 2, 1, 9.0) for w in range(10)]
    df = spark.createDataFrame(
        pd.DataFrame(rows, columns=["week_start", "store_nbr", "item_nbr", "weekly_units"])
        .sample(frac=1.0, random_state=0)
    ).selectExpr("week_start", "int(store_nbr)", "int(item_nbr)", "weekly_units")
    got = forecast_all_skus_arima(df)
    assert schemas.same_fields(got.schema, schemas.ARIMA_FORECAST)
    values = rows_of(got.where("store_nbr = 1").orderBy("forecast_step"), "forecast_step", "arima_forecast")
    np.testing.assert_allclose(
        [v for _, v in sorted(values)], forecast_batch([sales_series(60)], 12)[0], rtol=1e-9)
    assert rows_of(got.where("store_nbr = 2"), "arima_forecast") == [(0.0,)] * 12
    (history,) = histories(df.where("store_nbr = 1")).collect()
    np.testing.assert_array_equal(history["history"], sales_series(60))
