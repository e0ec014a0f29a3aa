"""The same operators as SQL over the test tables, for checking.

Where the engine has a choice, these take another road: windows instead of grouped sketches,
plain distinct counts instead of bit masks, row numbers over the whole table instead of
narrowing down, and Gram-Schmidt over the rows instead of covariance matrices.
"""

from __future__ import annotations

# Written out again, so that a change of the library's values shows as a difference.
LAG_WEEKS = (1, 2, 4, 8, 12, 26, 52)
ROLLING_WINDOWS = (4, 12, 26)
CV_SPLITS = 5
BUCKET_EDGES = (-0.5, -0.1, 0.1, 0.5)
BUCKET_LABELS = ("highly_elastic", "elastic", "inelastic", "slightly_inelastic", "highly_inelastic")
RECOMMENDATION_COLOURS = {"OVERPRICED": "#E63946", "UNDERPRICED": "#2A9D8F", "MARKET_RATE": "#457B9D"}
FEATURE_COLUMNS = (
    *(f"units_lag_{n}w" for n in LAG_WEEKS),
    *(f"rolling_mean_{n}w" for n in ROLLING_WINDOWS),
    "rolling_std_4w", "rolling_std_12w", "any_promo", "promo_rate_4w", "week_of_year", "month", "quarter",
    "is_holiday_season", "yoy_growth", "price_gap_vs_family",
)

TRAIN = """train AS (
  SELECT CAST(l_shipdate AS DATE) AS date, n_regionkey + 1 AS store_nbr,
         CAST(substr(p_brand, 7) AS INTEGER) AS item_nbr,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS unit_sales,
         l_discount >= 0.095 AS onpromotion
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

DAILY = """daily AS (
  SELECT date, store_nbr, item_nbr, greatest(unit_sales, 0.0) AS unit_sales, onpromotion,
         CAST(date_trunc('week', date) AS DATE) AS week_start
  FROM train)"""

ITEMS = """items AS (
  SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS item_nbr,
         concat('FAM_', CAST(substr(p_brand, 7) AS INTEGER) % 5) AS family,
         CAST(substr(p_brand, 7) AS INTEGER) % 7 AS class,
         CAST(substr(p_brand, 7) AS INTEGER) % 2 = 0 AS perishable
  FROM part)"""

STORES = """stores AS (
  SELECT r_regionkey + 1 AS store_nbr, r_name AS city, r_name AS state,
         substr(r_name, 1, 1) AS type, r_regionkey % 2 AS cluster
  FROM region)"""

FACTS = """facts AS (
  SELECT week_start, store_nbr, item_nbr, sum(unit_sales) AS weekly_units,
         avg(unit_sales) AS avg_daily_units, CAST(max(onpromotion) AS INTEGER) AS any_promo,
         count(DISTINCT date) AS days_in_week
  FROM daily GROUP BY week_start, store_nbr, item_nbr)"""

WEEKLY = """weekly AS (
  SELECT f.*, i.family, i.class, i.perishable, s.city, s.state, s.type, s.cluster
  FROM facts f LEFT JOIN items i USING (item_nbr) LEFT JOIN stores s USING (store_nbr))"""

_LAGS = ", ".join(f"lag(weekly_units, {n}) OVER w AS units_lag_{n}w" for n in LAG_WEEKS)
_STATS = ", ".join(
    f"{fn}(weekly_units) OVER w{n} AS rolling_{name}_{n}w"
    for n in ROLLING_WINDOWS
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"))
)
_FRAMES = ", ".join(
    f"w{n} AS (PARTITION BY store_nbr, item_nbr ORDER BY week_start "
    f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    for n in ROLLING_WINDOWS
)
_CALENDAR = """CAST(week(week_start) AS INTEGER) AS week_of_year,
  CAST(month(week_start) AS INTEGER) AS month, CAST(quarter(week_start) AS INTEGER) AS quarter,
  CAST(year(week_start) AS INTEGER) AS year,
  CASE WHEN week(week_start) IN (48, 49, 50, 51, 52, 1) THEN 1 ELSE 0 END AS is_holiday_season"""

SERIES = f"""series AS (
  SELECT *, {_LAGS}, {_STATS}, avg(any_promo) OVER w4 AS promo_rate_4w, {_CALENDAR},
         quantile_disc(weekly_units, 0.5) OVER (PARTITION BY family, week_start)
           AS family_median_units
  FROM weekly
  WINDOW w AS (PARTITION BY store_nbr, item_nbr ORDER BY week_start), {_FRAMES})"""

FEATURES = """features AS (
  SELECT *, CASE WHEN units_lag_52w > 0
              THEN (weekly_units - units_lag_52w) / units_lag_52w END AS yoy_growth,
         CASE WHEN weekly_units > 0 AND family_median_units > 0
              THEN ln(weekly_units) - ln(family_median_units) ELSE 0.0 END AS price_gap_vs_family,
         coalesce(units_lag_52w, rolling_mean_4w) AS baseline_forecast
  FROM series)"""

WARM = "warm AS (SELECT * FROM features WHERE units_lag_52w IS NOT NULL)"

LABELLED = """labelled AS (
  SELECT *, CASE
    WHEN price_gap_vs_family > 0.15 AND baseline_forecast < rolling_mean_4w * 0.85 THEN 'OVERPRICED'
    WHEN price_gap_vs_family < -0.15 AND baseline_forecast > rolling_mean_4w * 1.10 THEN 'UNDERPRICED'
    ELSE 'MARKET_RATE' END AS pricing_recommendation
  FROM warm)"""

IDS = """store_ids AS (
  SELECT store_nbr, CAST(dense_rank() OVER (ORDER BY store_nbr) - 1 AS INTEGER) AS store_id
  FROM (SELECT DISTINCT store_nbr FROM warm)),
item_ids AS (
  SELECT item_nbr, CAST(dense_rank() OVER (ORDER BY item_nbr) - 1 AS INTEGER) AS item_id
  FROM (SELECT DISTINCT item_nbr FROM warm))"""

TREND = """trend AS (
  SELECT week_start, family, sum(baseline_forecast) AS total_forecast_units,
         sum(weekly_units) AS total_actual_units, count(DISTINCT item_nbr) AS n_skus
  FROM warm GROUP BY week_start, family)"""

DESIGN = """design AS (
  SELECT week_start, store_nbr, item_nbr, CAST(any_promo AS DOUBLE) AS any_promo,
         CAST(week_of_year AS DOUBLE) AS week_of_year,
         ln(1 + weekly_units) AS log_units,
         ln(1 + coalesce(rolling_mean_4w, 0)) AS log_demand_baseline,
         rank() OVER (PARTITION BY store_nbr, item_nbr ORDER BY week_start)
           + (count(*) OVER (PARTITION BY store_nbr, item_nbr, week_start) - 1) / 2.0 AS t,
         CAST(year >= (SELECT quantile_cont(year, 0.5) FROM warm) AS INTEGER) AS post
  FROM warm)"""

PANEL_STEPS = (TRAIN, DAILY, FACTS)
WEEKLY_STEPS = (*PANEL_STEPS, ITEMS, STORES, WEEKLY)
FEATURE_STEPS = (*WEEKLY_STEPS, SERIES, FEATURES)
WARM_STEPS = (*FEATURE_STEPS, WARM)


def _query(steps: tuple[str, ...], body: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n" + body


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _orthogonal(source: str, tag: str, order: tuple[str, ...], y: str) -> str:
    """Gram-Schmidt of ``order`` inside each item; ``source`` holds centered columns.

    Adds ``v_x`` (what is left of x), ``d_x`` (its sum of squares), ``ok_x`` and ``b_x`` (slope).
    """
    steps = []
    previous = source
    for i, x in enumerate(order):
        rest = f"{x}" + "".join(
            f" - CASE WHEN ok_{k} THEN v_{k} * sum({x} * v_{k}) OVER item / d_{k} ELSE 0 END"
            for k in order[:i]
        )
        steps.append(
            f"{tag}_v{i} AS (SELECT *, {rest} AS v_{x} FROM {previous} "
            f"WINDOW item AS (PARTITION BY item_nbr))"
        )
        steps.append(
            f"{tag}_d{i} AS (SELECT *, sum(v_{x} * v_{x}) OVER item AS d_{x}, "
            f"sum({x} * {x}) OVER item > 1e-12 * n * mean_{x} * mean_{x} "
            f"AND sum(v_{x} * v_{x}) OVER item > 1e-9 * sum({x} * {x}) OVER item AS ok_{x} "
            f"FROM {tag}_v{i} WINDOW item AS (PARTITION BY item_nbr))"
        )
        steps.append(
            f"{tag}_b{i} AS (SELECT *, CASE WHEN ok_{x} THEN sum({y} * v_{x}) OVER item / d_{x} "
            f"ELSE 0 END AS b_{x} FROM {tag}_d{i} WINDOW item AS (PARTITION BY item_nbr))"
        )
        previous = f"{tag}_b{i}"
    residual = y + "".join(f" - b_{x} * v_{x}" for x in order)
    leverage = "1.0 / n" + "".join(
        f" + CASE WHEN ok_{x} THEN v_{x} * v_{x} / d_{x} ELSE 0 END" for x in order
    )
    steps.append(f"{tag} AS (SELECT *, {residual} AS e, {leverage} AS h FROM {previous})")
    return ",\n".join(steps)


def _centered(name: str, columns: tuple[str, ...], by: str) -> str:
    """Columns minus their mean over ``by``; the item mean is kept for the constant test."""
    gone = ", ".join(f"{c} - avg({c}) OVER ({by}) AS {c}" for c in columns)
    means = ", ".join(f"avg({c}) OVER (PARTITION BY item_nbr) AS mean_{c}" for c in columns)
    return (
        f"{name} AS (SELECT item_nbr, store_nbr, {gone}, {means}, "
        "log_units - avg(log_units) OVER (PARTITION BY item_nbr) AS about_grand_mean, "
        "count(*) OVER (PARTITION BY item_nbr) AS n "
        "FROM (SELECT *, any_promo * post AS treated_post FROM design))"
    )


def _simpson(of: str, low: str, high: str) -> str:
    """The integral of ``of``, an expression in x, by Simpson's rule on 2,000 pieces."""
    x = f"({low} + ({high} - {low}) * i / 2000)"
    weight = "CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    body = of.replace("x", x)
    return f"(list_sum(list_transform(range(2001), lambda i: ({weight}) * {body})) * ({high} - {low}) / 6000)"


def _t_tail(t: str, df: str) -> str:
    """Share of the integral of cos(x) ** (df - 1) beyond atan(|t| / sqrt(df))."""
    of = f"pow(cos(x), {df} - 1)"
    return f"{_simpson(of, f'atan(abs({t}) / sqrt({df}))', 'pi() / 2')} / {_simpson(of, '0', 'pi() / 2')}"


def _normal_tail(z: str) -> str:
    inside = _simpson("ezp(-(x) * (x) / 2)", "0", f"abs({z})").replace("ezp", "exp")
    return f"CASE WHEN {z} IS NOT NULL THEN greatest(1 - sqrt(2 / pi()) * {inside}, 0) END"


_Y = "log_units"
_PROMO_LAST = ("week_of_year", "t", "log_demand_baseline", "any_promo")
_BASELINE_LAST = ("week_of_year", "t", "any_promo", "log_demand_baseline")
_DID = ("any_promo", "post", "t", "week_of_year", "treated_post")

OLS_STEPS = (
    *WARM_STEPS, DESIGN,
    _centered("within", (*_PROMO_LAST, _Y), "PARTITION BY item_nbr, store_nbr"),
    _orthogonal("within", "promo_fit", _PROMO_LAST, _Y),
    _orthogonal("within", "baseline_fit", _BASELINE_LAST, _Y),
    f"""ols AS (
  SELECT CAST(p.item_nbr AS VARCHAR) AS sku, p.elasticity_promo, q.elasticity_baseline,
         p.r_squared, p.n_obs, {_t_tail("elasticity_promo / nullif(promo_se, 0)", "df")} AS p_value_promo, p.aic
  FROM (SELECT *, CASE WHEN df > 0 THEN sqrt(ssr / df / d) END AS promo_se,
          CASE WHEN ssr > 0 THEN n_obs * (ln(2 * pi()) + ln(ssr / n_obs) + 1) + 2 * (n_obs - df) END AS aic
        FROM (SELECT item_nbr, any_value(CASE WHEN ok_any_promo THEN b_any_promo END) AS elasticity_promo,
               any_value(CASE WHEN ok_any_promo THEN d_any_promo END) AS d, sum(e * e) AS ssr,
               count(*) - count(DISTINCT store_nbr) - any_value(ok_week_of_year::INT + ok_t::INT
                 + ok_log_demand_baseline::INT + ok_any_promo::INT) AS df,
               CASE WHEN sum(about_grand_mean * about_grand_mean) > 0
                 THEN 1 - sum(e * e) / sum(about_grand_mean * about_grand_mean) END AS r_squared,
               count(*) AS n_obs
        FROM promo_fit GROUP BY item_nbr HAVING count(*) >= 52)) p
  JOIN (SELECT item_nbr, any_value(CASE WHEN ok_log_demand_baseline THEN b_log_demand_baseline END)
                 AS elasticity_baseline
        FROM baseline_fit GROUP BY item_nbr) q USING (item_nbr))""",
)

DID_ONLY = (
    _centered("about_mean", (*_DID, _Y), "PARTITION BY item_nbr"),
    _orthogonal("about_mean", "did_fit", _DID, _Y),
    f"""did AS (
  SELECT *, {_normal_tail("did_att / nullif(did_se, 0)")} AS did_pvalue FROM (
  SELECT CAST(item_nbr AS VARCHAR) AS sku,
         any_value(CASE WHEN ok_treated_post THEN b_treated_post END) AS did_att,
         CASE WHEN bool_and(ok_treated_post) AND min(1 - h) >= 1e-9
           THEN sqrt(sum(CASE WHEN 1 - h >= 1e-9
                         THEN v_treated_post * v_treated_post * e * e / ((1 - h) * (1 - h)) END))
                / any_value(d_treated_post) END AS did_se,
         CASE WHEN sum(log_units * log_units) > 0
           THEN 1 - sum(e * e) / sum(log_units * log_units) END AS did_r2
  FROM did_fit GROUP BY item_nbr HAVING count(*) >= 52))""",
)
DID_STEPS = (*WARM_STEPS, DESIGN, *DID_ONLY)
ELASTICITY_STEPS = (
    *OLS_STEPS, *DID_ONLY,
    "elasticity AS (SELECT * FROM ols FULL JOIN did USING (sku))",
)

_BUCKETS = (
    "CASE WHEN elasticity_promo IS NULL THEN NULL "
    + " ".join(
        f"WHEN elasticity_promo <= {edge} THEN '{label}'"
        for edge, label in zip(BUCKET_EDGES, BUCKET_LABELS)
    )
    + f" ELSE '{BUCKET_LABELS[-1]}' END AS elasticity_bucket"
)

_COLOURS = (
    "CASE pricing_recommendation "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RECOMMENDATION_COLOURS.items())
    + " ELSE '#888' END AS colour"
)

_STAT_NAMES = tuple(f"rolling_{s}_{n}w" for n in ROLLING_WINDOWS for s in ("mean", "std", "max"))
_KEY = "week_start, store_nbr, item_nbr"
_APE = "CASE WHEN weekly_units > 0 THEN abs(weekly_units - baseline_forecast) / weekly_units END"
_FRACTIONAL = tuple(
    c for c in FEATURE_COLUMNS
    if c.startswith("rolling_") or c in ("promo_rate_4w", "yoy_growth", "price_gap_vs_family")
)
_WHOLE = tuple(c for c in FEATURE_COLUMNS if c not in _FRACTIONAL)
_ATTRIBUTES = "family, class, perishable, city, state, type, cluster"
_PER_SKU = f"""per_sku AS (
  SELECT item_nbr, avg({_APE}) AS mape, count(*) FILTER (weekly_units > 0) AS n_rows
  FROM warm GROUP BY item_nbr)"""

ALIGNED = """parted AS (
  SELECT *, epoch(week_start) / 86400 >=
           (SELECT quantile_cont(epoch(week_start) / 86400, 0.85) FROM warm) AS is_holdout
  FROM warm),
levels AS (
  SELECT store_nbr, item_nbr, arg_max(weekly_units, week_start) AS arima_forecast,
         count(*) >= 24 AS eligible
  FROM parted WHERE NOT is_holdout GROUP BY store_nbr, item_nbr),
steps AS (
  SELECT week_start, store_nbr, item_nbr, weekly_units, baseline_forecast AS xgb_forecast,
         CAST(row_number() OVER (PARTITION BY store_nbr, item_nbr ORDER BY week_start) AS INTEGER)
           AS forecast_step
  FROM parted WHERE is_holdout),
aligned AS (
  SELECT s.*, l.arima_forecast, l.eligible,
         0.65 * s.xgb_forecast + 0.35 * l.arima_forecast AS ensemble_forecast
  FROM steps s LEFT JOIN (
    SELECT keys.store_nbr, keys.item_nbr, coalesce(arima_forecast, 0) AS arima_forecast,
           coalesce(eligible, FALSE) AS eligible
    FROM (SELECT DISTINCT store_nbr, item_nbr FROM parted) keys
    LEFT JOIN levels USING (store_nbr, item_nbr)) l USING (store_nbr, item_nbr))"""


def _member(name: str) -> str:
    error = f"CASE WHEN weekly_units > 0 THEN abs(weekly_units - {name}) / weekly_units END"
    return (
        f"SELECT '{name}' AS member, round(avg({error}), 6) AS mape, "
        "count(*) FILTER (weekly_units > 0) AS n_rows, "
        "count(DISTINCT CASE WHEN NOT eligible THEN store_nbr * 1000000 + item_nbr END) AS n_zero_series "
        "FROM aligned"
    )


def _calendar_lags() -> str:
    lags = [
        f"(SELECT max(p.weekly_units) FROM facts p WHERE p.store_nbr = f.store_nbr AND p.item_nbr = f.item_nbr "
        f"AND p.week_start = f.week_start - INTERVAL {n} WEEK) AS units_{n}w_ago"
        for n in (1, 2, 4, 8, 12, 26, 52)
    ]
    joins, stats = [], []
    for n in (4, 12, 26):
        joins.append(
            f"t{n} AS (SELECT f.week_start, f.store_nbr, f.item_nbr, avg(p.weekly_units) AS a, "
            "stddev_samp(p.weekly_units) AS s, max(p.weekly_units) AS m, count(p.weekly_units) AS c "
            "FROM facts f LEFT JOIN facts p ON p.store_nbr = f.store_nbr AND p.item_nbr = f.item_nbr "
            f"AND p.week_start < f.week_start AND p.week_start >= f.week_start - INTERVAL {n} WEEK GROUP BY ALL)"
        )
        stats.append(
            f"round(t{n}.a, 6) AS calendar_mean_{n}w, round(t{n}.s, 6) AS calendar_std_{n}w, "
            f"round(t{n}.m, 6) AS calendar_max_{n}w, t{n}.c AS weeks_seen_{n}w"
        )
    using = " ".join(f"JOIN t{n} USING (week_start, store_nbr, item_nbr)" for n in (4, 12, 26))
    return (
        ", " + ", ".join(joins)
        + f" SELECT week_start, store_nbr, item_nbr, {', '.join(lags)}, {', '.join(stats)} FROM facts f {using}"
    )


_CALENDAR_LAGS = _calendar_lags()

_STUMPS = """, rows AS (
  SELECT weekly_units - avg(weekly_units) OVER () AS r, any_promo, week_of_year, month, quarter,
         is_holiday_season, store_nbr FROM warm
), long AS (
  SELECT r, unnest(['any_promo', 'week_of_year', 'month', 'quarter', 'is_holiday_season', 'store_nbr']) AS feature,
         unnest([any_promo, week_of_year, month, quarter, is_holiday_season, store_nbr])::DOUBLE AS value FROM rows
), cuts AS (SELECT DISTINCT feature, value AS cut FROM long
), sides AS (
  SELECT c.feature, c.cut, -sum(r) FILTER (value <= cut) AS gl, -sum(r) FILTER (value > cut) AS gr, -sum(r) AS ga,
         count(*) FILTER (value <= cut) AS n_left, count(*) FILTER (value > cut) AS n_right
  FROM cuts c JOIN long l USING (feature) GROUP BY c.feature, c.cut
), kept AS (
  SELECT *, power(greatest(abs(gl) - 0.1, 0), 2) / (n_left + 1) + power(greatest(abs(gr) - 0.1, 0), 2) / (n_right + 1)
         - power(greatest(abs(ga) - 0.1, 0), 2) / (n_left + n_right + 1) AS gain
  FROM sides WHERE n_left >= 5 AND n_right >= 5)
SELECT feature, cut, round(gain, 4) AS gain,
       round(-sign(gl) * greatest(abs(gl) - 0.1, 0) / (n_left + 1), 4) AS left_weight,
       round(-sign(gr) * greatest(abs(gr) - 0.1, 0) / (n_right + 1), 4) AS right_weight, n_left, n_right
FROM kept QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 6) DESC, cut) = 1"""

RUNS = """runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, value / 1000 AS mape, value / 1200 AS cv_mape,
         '500' AS n_estimators, concat('models/', event_id) AS model_path
  FROM events)"""


def oracle_sql() -> dict[str, str]:
    weekly_columns = (
        f"{_KEY}, weekly_units, {_round('avg_daily_units')}, any_promo, days_in_week"
    )
    lags = ", ".join(f"units_lag_{n}w" for n in LAG_WEEKS)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)
    found = {
        "bucketed_features": _query(
            FEATURE_STEPS,
            f"SELECT {_KEY}, units_lag_1w, units_lag_2w, units_lag_4w, units_lag_8w, units_lag_12w, units_lag_26w, "
            f"units_lag_52w, {_round('rolling_mean_4w', 'rolling_mean_12w', 'rolling_mean_26w')} FROM features",
        ),
        "calendar_lags": _query(PANEL_STEPS, _CALENDAR_LAGS),
        "arima_contract": _query(
            WARM_STEPS,
            "SELECT store_nbr, item_nbr, 12 AS n_steps, 1 AS first_step, 12 AS last_step, "
            "count(*) >= 24 AS eligible, TRUE AS never_negative, TRUE AS zero_unless_fitted "
            "FROM warm GROUP BY store_nbr, item_nbr",
        ),
        "tree_stumps": _query(WARM_STEPS, _STUMPS),
        "load_train": _query((TRAIN, DAILY), "SELECT * FROM daily"),
        "load_items": _query((ITEMS,), "SELECT * FROM items"),
        "load_stores": _query((STORES,), "SELECT * FROM stores"),
        "oil_ffill": """WITH oil AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE WHEN isodow(CAST(o_orderdate AS DATE)) < 6 THEN max(o_totalprice) / 1000 END AS dcoilwtico
  FROM orders GROUP BY CAST(o_orderdate AS DATE))
SELECT date, last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dcoilwtico
FROM oil""",
        "sink_roundtrip": _query(
            PANEL_STEPS,
            "SELECT CAST(year(week_start) AS INTEGER) AS year, count(*) AS n_rows, "
            "sum(weekly_units) AS weekly_units, (SELECT count(*) FROM facts) AS rows_written "
            "FROM facts GROUP BY year(week_start)",
        ),
        "clustered_layout": _query(
            (TRAIN, DAILY),
            "SELECT date, store_nbr, count(*) AS n_sales, sum(unit_sales) AS unit_sales "
            "FROM daily GROUP BY date, store_nbr",
        ),
        "aggregate_weekly": _query(PANEL_STEPS, f"SELECT {weekly_columns} FROM facts"),
        "weekly_enriched": _query(
            WEEKLY_STEPS, f"SELECT {weekly_columns}, {_ATTRIBUTES} FROM weekly"
        ),
        "sku_coverage": _query(
            PANEL_STEPS,
            "SELECT count(DISTINCT item_nbr) AS n_skus, "
            "count(DISTINCT (store_nbr, item_nbr)) AS n_series, count(*) AS n_rows FROM facts",
        ),
        "lag_features": _query(FEATURE_STEPS, f"SELECT {_KEY}, {lags} FROM features"),
        "rolling_features": _query(
            FEATURE_STEPS, f"SELECT {_KEY}, {_round(*_STAT_NAMES)} FROM features"
        ),
        "yoy_features": _query(
            FEATURE_STEPS, f"SELECT {_KEY}, units_lag_52w, {_round('yoy_growth')} FROM features"
        ),
        "time_features": _query(
            PANEL_STEPS, f"SELECT {_KEY}, {_CALENDAR} FROM facts"
        ),
        "promo_rate": _query(
            FEATURE_STEPS, f"SELECT {_KEY}, {_round('promo_rate_4w')} FROM features"
        ),
        "price_gap": _query(
            FEATURE_STEPS,
            f"SELECT {_KEY}, family, family_median_units, {_round('price_gap_vs_family')} "
            "FROM features",
        ),
        "features_cold_start": _query(
            WARM_STEPS,
            f"SELECT {weekly_columns}, {_ATTRIBUTES}, {lags}, "
            f"{_round(*_STAT_NAMES, 'yoy_growth', 'promo_rate_4w', 'price_gap_vs_family')}, "
            "week_of_year, month, quarter, year, is_holiday_season, family_median_units FROM warm",
        ),
        "entity_ids": _query(
            (*WARM_STEPS, IDS),
            "SELECT 'store' AS entity, store_nbr AS nbr, store_id AS id FROM store_ids "
            "UNION ALL SELECT 'item', item_nbr, item_id FROM item_ids",
        ),
        "training_matrix": _query(
            (*WARM_STEPS, IDS),
            f"SELECT {_KEY}, {', '.join(_WHOLE)}, {_round(*_FRACTIONAL)}, store_id, item_id, "
            f"weekly_units FROM warm JOIN store_ids USING (store_nbr) "
            f"JOIN item_ids USING (item_nbr) WHERE {complete}",
        ),
        "cv_folds": _query(
            (
                *WARM_STEPS,
                f"placed AS (SELECT {_KEY}, row_number() OVER (ORDER BY {_KEY}) - 1 AS place, "
                f"count(*) OVER () AS total FROM warm WHERE {complete})",
            ),
            f"SELECT {_KEY}, CAST("
            + " + ".join(
                f"CAST(place >= total - {CV_SPLITS - i} * (total // {CV_SPLITS + 1}) AS INTEGER)"
                for i in range(CV_SPLITS)
            )
            + " AS INTEGER) AS test_fold FROM placed",
        ),
        "holdout_split": _query(
            WARM_STEPS,
            f"SELECT {_KEY}, epoch(week_start) / 86400 >= (SELECT "
            "quantile_cont(epoch(week_start) / 86400, 0.85) FROM warm) AS is_holdout FROM warm",
        ),
        "arima_eligibility": _query(
            WARM_STEPS,
            "SELECT store_nbr, item_nbr, count(*) AS n_points, count(*) >= 24 AS eligible "
            "FROM warm GROUP BY store_nbr, item_nbr",
        ),
        "log_log_features": _query(
            (*WARM_STEPS, DESIGN),
            f"SELECT {_KEY}, {_round('log_units', 'log_demand_baseline')}, t, post FROM design",
        ),
        "elasticity_ols": _query(
            OLS_STEPS,
            "SELECT sku, "
            + _round("elasticity_promo", "elasticity_baseline", "r_squared", "p_value_promo", "aic")
            + ", n_obs FROM ols",
        ),
        "elasticity_did": _query(
            DID_STEPS, f"SELECT sku, {_round('did_att', 'did_se', 'did_pvalue', 'did_r2')} FROM did"
        ),
        "elasticity_combined": _query(
            ELASTICITY_STEPS,
            "SELECT sku, "
            + _round(
                "elasticity_promo", "elasticity_baseline", "r_squared", "p_value_promo", "aic", "did_att",
                "did_se", "did_pvalue", "did_r2",
            )
            + ", n_obs FROM elasticity",
        ),
        "elasticity_summary": _query(
            ELASTICITY_STEPS,
            "SELECT round(quantile_cont(elasticity_promo, 0.5), 4) AS median_promo_elasticity, "
            "round(avg(CASE WHEN did_se > 0 AND abs(did_att / did_se) > 1.959963984540054 "
            "THEN 1 ELSE 0 END), 4) AS pct_did_significant_skus, "
            "round(avg(r_squared), 4) AS mean_ols_r2, count(*) AS n_skus_modeled FROM elasticity",
        ),
        "elasticity_buckets": _query(
            ELASTICITY_STEPS,
            f"SELECT sku, {_round('elasticity_promo')}, {_BUCKETS} FROM elasticity".replace(
                "round(elasticity_promo, 6) AS elasticity_promo",
                "round(elasticity.elasticity_promo, 6) AS elasticity_promo",
            ),
        ),
        "mape_overall": _query(
            WARM_STEPS,
            f"SELECT round(avg({_APE}), 6) AS mape, "
            "count(*) FILTER (weekly_units > 0) AS n_rows FROM warm",
        ),
        "mape_by_sku": _query(
            (*WARM_STEPS, _PER_SKU), "SELECT item_nbr, round(mape, 6) AS mape, n_rows FROM per_sku"
        ),
        "mape_distribution": _query(
            (*WARM_STEPS, _PER_SKU),
            "SELECT count(mape) AS n_skus, round(avg(mape), 6) AS mean_mape, "
            "round(quantile_cont(mape, 0.25), 6) AS p25_mape, "
            "round(quantile_cont(mape, 0.5), 6) AS median_mape, "
            "round(quantile_cont(mape, 0.75), 6) AS p75_mape, round(max(mape), 6) AS max_mape "
            "FROM per_sku",
        ),
        "ensemble_weighted": _query(
            WARM_STEPS,
            f"SELECT {_KEY}, {_round('baseline_forecast')}, "
            "round(0.65 * baseline_forecast + 0.35 * rolling_mean_12w, 6) AS ensemble_forecast "
            "FROM warm",
        ),
        "ensemble_alignment": _query(
            (*WARM_STEPS, ALIGNED),
            f"SELECT {_KEY}, forecast_step, eligible, "
            f"{_round('xgb_forecast', 'arima_forecast', 'ensemble_forecast')} FROM aligned",
        ),
        "ensemble_scores": _query(
            (*WARM_STEPS, ALIGNED),
            " UNION ALL ".join(
                _member(m) for m in ("xgb_forecast", "arima_forecast", "ensemble_forecast")
            ),
        ),
        "series_history": _query(
            (
                *WARM_STEPS,
                "placed AS (SELECT *, row_number() OVER (PARTITION BY store_nbr, item_nbr "
                "ORDER BY week_start) AS place FROM warm)",
            ),
            "SELECT store_nbr, item_nbr, CAST(count(*) AS INTEGER) AS n_points, "
            "arg_min(weekly_units, place) AS first_units, "
            "arg_max(weekly_units, place) AS last_units, "
            "sum(weekly_units * place) AS weighted_units FROM placed GROUP BY store_nbr, item_nbr",
        ),
        "pricing_recommendation": _query(
            (*WARM_STEPS, LABELLED), f"SELECT {_KEY}, pricing_recommendation FROM labelled"
        ),
        "recommendation_summary": _query(
            (*WARM_STEPS, LABELLED),
            "SELECT pricing_recommendation, count(*) AS sku_weeks, "
            "round(avg(baseline_forecast), 6) AS avg_forecast FROM labelled "
            "GROUP BY pricing_recommendation",
        ),
        "pricing_gaps_latest": _query(
            (*WARM_STEPS, LABELLED),
            "SELECT store_nbr, item_nbr, family, "
            f"{_round('price_gap_vs_family', 'baseline_forecast', 'rolling_mean_4w')}, "
            "pricing_recommendation, week_start, round(CASE WHEN labelled.rolling_mean_4w > 0 "
            "THEN labelled.baseline_forecast / labelled.rolling_mean_4w ELSE 1.0 END, 6) "
            f"AS forecast_vs_baseline_ratio, {_COLOURS} FROM labelled "
            "WHERE week_start = (SELECT max(week_start) FROM labelled)",
        ),
        "weekly_trend": _query(
            (*WARM_STEPS, TREND),
            f"SELECT week_start, family, {_round('total_forecast_units')}, total_actual_units, "
            "n_skus FROM trend ORDER BY week_start, family",
        ),
        "top_family_trend": _query(
            (*WARM_STEPS, TREND),
            f"SELECT week_start, family, {_round('total_forecast_units')}, total_actual_units, "
            "n_skus FROM trend WHERE family IN (SELECT family FROM trend GROUP BY family "
            "ORDER BY sum(total_actual_units) DESC, family LIMIT 5) ORDER BY family, week_start",
        ),
        "best_run": _query(
            (RUNS,),
            "SELECT run_id, model_path, round(mape, 6) AS mape, round(cv_mape, 6) AS cv_mape, "
            "n_estimators FROM runs WHERE runs.mape < 0.15 ORDER BY runs.mape, run_id LIMIT 1",
        ),
        "run_comparison": _query(
            (RUNS,),
            "SELECT run_id, round(mape, 6) AS mape, round(cv_mape, 6) AS cv_mape, n_estimators "
            "FROM runs ORDER BY runs.mape, run_id LIMIT 10",
        ),
    }
    return found | {"features_refresh": found["features_cold_start"]}
