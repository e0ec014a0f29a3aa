"""Promotion response per item: fixed-effect regression and difference-in-differences.

Nothing is gathered per item. Rows are reduced to count, means and covariances per (item,
store) series, and those to one row per item; the fits are column expressions on that row.
An item that holds a large share of the panel is therefore combined map-side like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.constants import MIN_OBS_PER_SKU, SERIES, SIGNIFICANCE
from shelfcast.functions.labels import elasticity_bucket
from shelfcast.functions.quantiles import quantiles
from shelfcast.functions.regression import (
    LEVERAGE_MARGIN,
    coefficient,
    factor_columns,
    factorise,
    pair,
    pairs,
    row_terms,
)
from shelfcast.functions.tails import normal_pvalue, student_t_pvalue
from shelfcast.operators.features import Stage
from shelfcast.schemas import DID, ELASTICITY, OLS

Y = "log_units"
# The coefficient asked for comes last.
OLS_FOR_PROMO = ("week_of_year", "t", "log_demand_baseline", "any_promo")
OLS_FOR_BASELINE = ("week_of_year", "t", "any_promo", "log_demand_baseline")
DID_ORDER = ("any_promo", "post", "t", "week_of_year", "treated_post")
VARIABLES = (
    "any_promo", "log_demand_baseline", "week_of_year", "t", "post", "treated_post", Y,
)
OLS_PAIRS = pairs((*OLS_FOR_PROMO, Y))
DID_PAIRS = pairs((*DID_ORDER, Y))
ALL_PAIRS = pairs((*OLS_FOR_PROMO, Y), (*DID_ORDER, Y))


def log_columns(features: DataFrame) -> DataFrame:
    """``log_units``, ``log_demand_baseline`` and the average rank ``t`` of the week in its
    series."""
    series = Window.partitionBy(*SERIES).orderBy("week_start")
    ties = F.count(F.lit(1)).over(series.rangeBetween(Window.currentRow, Window.currentRow))
    return features.withColumns(
        {
            "log_units": F.log1p("weekly_units"),
            "log_demand_baseline": F.log1p(F.coalesce("rolling_mean_4w", F.lit(0.0))),
            "t": F.rank().over(series) + (ties - 1) / 2.0,
        }
    )


def build_log_log_features(features: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Design columns of both regressions.

    ``post`` is 1 from the median year of all rows on (interpolated, so it may be x.5). The
    median needs a second look at the rows; with ``stage`` they are written before it.
    """
    rows = log_columns(features)
    if stage is not None:
        rows = stage(rows, "log-log")
    middle = rows.agg(F.median("year")).scalar()
    flagged = rows.withColumn("post", (F.col("year") >= middle).cast("int"))
    return flagged.na.drop(subset=["log_units", "log_demand_baseline"])


def series_moments(design: DataFrame) -> DataFrame:
    """Count, means and centered products of each (item, store) series.

    Plain sums, several times cheaper than ``covar_pop``. Flags, weeks and ranks sum exactly, and
    logs of units have means of the size of their spread, so subtracting the means loses no more
    than a few of the last digits.
    """
    flagged = design.selectExpr("*", "any_promo * post AS treated_post")
    cells = flagged.selectExpr(
        "item_nbr",
        "store_nbr",
        *[f"if(any_promo IS NOT NULL, double({v}), NULL) AS {v}" for v in VARIABLES],
    )
    return cells.groupBy("item_nbr", "store_nbr").agg(
        F.expr("count(1) AS n_rows"),
        F.expr("count(any_promo) AS n"),
        *[F.expr(f"avg({v}) AS mean_{v}") for v in VARIABLES],
        *[
            F.expr(f"sum({a} * {b}) - sum({a}) * sum({b}) / nullif(count(any_promo), 0)")
            .alias(pair(a, b))
            for a, b in ALL_PAIRS
        ],
    )


def item_moments(per_series: DataFrame) -> DataFrame:
    """One row per item: centered products within stores (``w_``) and about the item mean."""
    summed = per_series.groupBy("item_nbr").agg(
        F.expr("sum(n_rows) AS n_rows"),
        F.expr("sum(n) AS n"),
        F.expr("count_if(n > 0) AS n_stores"),
        *[F.expr(f"sum(n * mean_{v}) / nullif(sum(n), 0) AS mean_{v}") for v in VARIABLES],
        *[F.expr(f"sum({pair(a, b)}) AS w_{pair(a, b)}") for a, b in ALL_PAIRS],
        *[F.expr(f"sum(n * mean_{a} * mean_{b}) AS m_{pair(a, b)}") for a, b in DID_PAIRS],
    )
    return summed.selectExpr(
        "item_nbr", "n_rows", "n", "n_stores",
        *[f"mean_{v}" for v in VARIABLES],
        *[f"w_{pair(a, b)}" for a, b in OLS_PAIRS],
        *[
            f"w_{pair(a, b)} + (m_{pair(a, b)} - n * mean_{a} * mean_{b}) AS {pair(a, b)}"
            for a, b in DID_PAIRS
        ],
    )


def fit_ols(moments: DataFrame, min_obs: int = MIN_OBS_PER_SKU) -> DataFrame:
    """Promotion and baseline coefficients with store fixed effects absorbed.

    Store effects drop out by using the within-store products (Frisch-Waugh-Lovell); they still
    count in the degrees of freedom, and R2 refers to the variation about the item's grand mean.
    Rows without a promotion flag are left out, but count towards ``min_obs``.

    Write the result down before filtering on a coefficient: a filter pushed below the fit would
    spell out its nested expressions.
    """
    within = moments.where(F.col("n_rows") >= min_obs).where("n > 0").selectExpr(
        "item_nbr", "n", "n_stores",
        *[f"mean_{v}" for v in (*OLS_FOR_PROMO, Y)],
        f"{pair(Y, Y)} AS total_ss",
        *[f"w_{pair(a, b)} AS {pair(a, b)}" for a, b in OLS_PAIRS],
    )
    fitted = factorise(factorise(within, OLS_FOR_PROMO, Y, "p"), OLS_FOR_BASELINE, Y, "q")
    results = fitted.selectExpr(
        "string(item_nbr) AS sku",
        f"{coefficient('p', 'any_promo')} AS elasticity_promo",
        f"{coefficient('q', 'log_demand_baseline')} AS elasticity_baseline",
        "1 - p_ssr / if(total_ss > 0, total_ss, NULL) AS r_squared",
        "n AS n_obs",
        "double(n - p_rank - n_stores) AS df_resid",
        "sqrt(p_ssr / if(df_resid > 0, df_resid, NULL) / if(p_ok_any_promo, p_d_any_promo, NULL))"
        " AS promo_se",
        f"n * ({math.log(2 * math.pi)}D + ln(if(p_ssr > 0, p_ssr, NULL) / n) + 1)"
        " + 2 * (p_rank + n_stores) AS aic",
        "elasticity_promo / if(promo_se > 0, promo_se, NULL) AS t_value",
    )
    p_value = student_t_pvalue("t_value", "df_resid")
    return results.withColumn("p_value_promo", p_value).select(*OLS.fieldNames())


def did_factors(moments: DataFrame, min_obs: int = MIN_OBS_PER_SKU) -> DataFrame:
    """Difference-in-differences fit of every item without a missing promotion flag."""
    kept = moments.where(F.col("n_rows") >= min_obs).where("n = n_rows").select(
        "item_nbr", "n",
        *[f"mean_{v}" for v in (*DID_ORDER, Y)],
        *[pair(a, b) for a, b in DID_PAIRS],
    )
    return factorise(kept, DID_ORDER, Y, "f").select(
        "item_nbr", "n",
        *[f"mean_{v}" for v in (*DID_ORDER, Y)],
        *factor_columns(DID_ORDER, "f"),
        "f_ssr", F.col(pair(Y, Y)).alias("total_ss"),
    )


def fit_did(design: DataFrame, factors: DataFrame) -> DataFrame:
    """Effect of treated x post with HC3 errors: a second pass over the rows for the sandwich.

    ``factors`` is one row per item; pass it written down, so the join is planned on its size.
    """
    target = DID_ORDER[-1]
    rows = design.selectExpr(
        "item_nbr", "store_nbr", "any_promo", "post", "t", "week_of_year", Y,
        "any_promo * post AS treated_post",
    ).join(factors.drop("f_ssr", "total_ss"), "item_nbr")
    terms = row_terms(rows, DID_ORDER, Y, "f", keep=("item_nbr", "store_nbr"))
    clear = f"free >= {LEVERAGE_MARGIN}D"
    # First by series, on an exchange of its own: a hot item is one row per store after it.
    by_series = terms.repartition("item_nbr", "store_nbr").groupBy("item_nbr", "store_nbr").agg(
        F.expr(f"sum(if({clear}, power(v_{target} * e / free, 2), NULL)) AS meat"),
        F.expr(f"bool_and({clear}) AS robust"),
    )
    meat = by_series.groupBy("item_nbr").agg(
        F.sum("meat").alias("meat"), F.bool_and("robust").alias("robust")
    )
    fitted = factors.join(meat, "item_nbr").selectExpr(
        "string(item_nbr) AS sku",
        f"{coefficient('f', target)} AS did_att",
        f"if(robust AND f_ok_{target}, sqrt(meat) / f_d_{target}, NULL) AS did_se",
        "1 - f_ssr / if(total_ss > 0, total_ss, NULL) AS did_r2",
        "did_att / if(did_se > 0, did_se, NULL) AS z",
    )
    return fitted.withColumn("did_pvalue", normal_pvalue("z")).select(*DID.fieldNames())


def combine(ols: DataFrame, did: DataFrame) -> DataFrame:
    """Both results side by side; an item fitted by only one of them is kept."""
    return ols.join(did, "sku", "full").select(*ELASTICITY.fieldNames())


def run_elasticity(
    features: DataFrame, stage: Stage, min_obs: int = MIN_OBS_PER_SKU
) -> DataFrame:
    """Both fits of every item with at least ``min_obs`` rows, as a written table."""
    design = staged_design(features, stage)
    moments = stage(item_moments(series_moments(design)), "item-moments")
    factors = stage(did_factors(moments, min_obs), "did-factors")
    fitted = combine(fit_ols(moments, min_obs), fit_did(design, factors))
    return stage(fitted, "elasticity")


DESIGN_COLUMNS: Sequence[str] = (
    "week_start", "store_nbr", "item_nbr", "year", "week_of_year",
    "weekly_units", "rolling_mean_4w", "any_promo",
)


def staged_design(features: DataFrame, stage: Stage) -> DataFrame:
    return build_log_log_features(features.select(*DESIGN_COLUMNS), stage)


def elasticity_summary(results: DataFrame) -> DataFrame:
    """Run-level metrics; pass a written table. A missing p-value counts as not significant."""
    (median,) = quantiles(results, "elasticity_promo", [0.5])
    significant = F.coalesce(F.col("did_pvalue") < SIGNIFICANCE, F.lit(False))
    return results.agg(
        F.round(F.lit(median).cast("double"), 4).alias("median_promo_elasticity"),
        F.round(F.avg(significant.cast("int")), 4).alias("pct_did_significant_skus"),
        F.round(F.avg("r_squared"), 4).alias("mean_ols_r2"),
        F.count(F.lit(1)).alias("n_skus_modeled"),
    )


def with_elasticity_bucket(results: DataFrame) -> DataFrame:
    return results.withColumn("elasticity_bucket", elasticity_bucket(F.col("elasticity_promo")))
