"""Two-sided p-values as column expressions.

Series and continued fractions are folds over a fixed sequence (``aggregate``), so they stay inside the JVM
and need no function that Spark lacks; log gamma is Stirling's series behind a shift.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BETA_TERMS = 400  # of the fraction; it settles within about sqrt(a) of them, and sooner near its switch
ERFC_TERMS = 80
SHIFT = 8
LEAST = 1e-300
# Coefficients of Stirling's series, B(2k) / (2k (2k - 1)).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def _number(value: float) -> Column:
    return F.lit(float(value))


def log_gamma(z: Column) -> Column:
    """For positive ``z``; about 14 digits."""
    product = _number(1.0)
    for k in range(SHIFT):
        product = product * (z + k)
    far = z + SHIFT
    series = _number(0.0)
    for k, c in enumerate(STIRLING):
        series = series + c / F.pow(far, 2 * k + 1)
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < LEAST, _number(LEAST)).otherwise(x)


def beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function by Lentz's method, one term a step."""
    inputs = F.struct(a.alias("a"), b.alias("b"), x.alias("x"))

    def step(state: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        p, q, y = state["in"]["a"], state["in"]["b"], state["in"]["x"]
        even = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
        term = F.when(k % 2 == 0, even).otherwise(odd)
        d = 1.0 / _away_from_zero(1.0 + term * state["d"])
        c = _away_from_zero(1.0 + term / state["c"])
        return F.struct(state["in"].alias("in"), c.alias("c"), d.alias("d"), (state["total"] * c * d).alias("total"))

    first = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(inputs.alias("in"), _number(1.0).alias("c"), first.alias("d"), first.alias("total"))
    return F.aggregate(F.sequence(F.lit(2), F.lit(BETA_TERMS)), start, step, lambda state: state["total"])


def student_t_pvalue(t: str, df: str) -> Column:
    """P(|T| >= |t|): the regularised incomplete beta function at df / (df + t^2). NULL without a finite t or
    degrees of freedom."""
    value, free = F.col(t).cast("double"), F.col(df).cast("double")
    a, half = free / 2.0, _number(0.5)
    x, rest = free / (free + value * value), value * value / (free + value * value)
    log_beta = log_gamma(a) + 0.5 * math.log(math.pi) - log_gamma(a + 0.5)
    front = F.exp(a * F.log(x) + 0.5 * F.log(rest) - log_beta)
    below = front * beta_fraction(a, half, x) / a
    above = 1.0 - front * beta_fraction(half, a, rest) / 0.5
    tail = F.when(rest == 0, _number(1.0)).when(x == 0, _number(0.0))
    tail = tail.when(x < (a + 1.0) / (a + 2.5), below).otherwise(above)
    usable = value.isNotNull() & (F.abs(value) < float("inf")) & ~F.isnan(value) & (free > 0)
    return F.when(usable, F.least(F.greatest(tail, _number(0.0)), _number(1.0)))


def erfc(x: Column) -> Column:
    """Complementary error function of a column that is not negative: a series of positive terms near
    zero, a continued fraction from its far end beyond."""
    def term(state: Column, n: Column) -> Column:
        following = state["term"] * 2.0 * state["x"] * state["x"] / (2 * n + 1)
        return F.struct(state["x"].alias("x"), following.alias("term"), (state["sum"] + following).alias("sum"))

    near = F.aggregate(
        F.sequence(F.lit(1), F.lit(ERFC_TERMS)),
        F.struct(x.alias("x"), x.alias("term"), x.alias("sum")),
        term,
        lambda state: 1.0 - 2.0 / math.sqrt(math.pi) * F.exp(-state["x"] * state["x"]) * state["sum"],
    )
    far = F.aggregate(
        F.sequence(F.lit(ERFC_TERMS), F.lit(1), F.lit(-1)),
        F.struct(x.alias("x"), x.alias("rest")),
        lambda state, n: F.struct(state["x"].alias("x"), (state["x"] + n / 2.0 / state["rest"]).alias("rest")),
        lambda state: F.exp(-state["x"] * state["x"]) / (math.sqrt(math.pi) * state["rest"]),
    )
    return F.when(x < 2.5, near).otherwise(far)


def normal_pvalue(z: str) -> Column:
    """P(|Z| >= |z|) for the standard normal; NULL for a missing z."""
    value = F.col(z).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), erfc(F.abs(value) / math.sqrt(2.0)))
