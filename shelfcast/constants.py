"""Fixed values. They decide the results, so they are stated once, here."""

# Panel keys.
SERIES = ("store_nbr", "item_nbr")
PANEL_KEY = ("week_start", "store_nbr", "item_nbr")

# Feature engineering.
LAG_WEEKS = (1, 2, 4, 8, 12, 26, 52)
ROLLING_WINDOWS = (4, 12, 26)
PROMO_WINDOW = 4
COLD_START_LAG = 52
HOLIDAY_WEEKS = (48, 49, 50, 51, 52, 1)

# Elasticity.
MIN_OBS_PER_SKU = 52
SIGNIFICANCE = 0.05

# Forecasting.
FORECAST_HORIZON = 12
ARIMA_ORDER = (2, 1, 2)
MIN_SERIES_POINTS = 24
TREE_WEIGHT = 0.65
ARIMA_WEIGHT = 0.35
CV_SPLITS = 5
HOLDOUT_QUANTILE = 0.85
TARGET = "weekly_units"

# Boosted trees.
TREE_SETTINGS = {
    "rounds": 500,
    "depth": 6,
    "rate": 0.05,
    "row_share": 0.8,
    "column_share": 0.8,
    "least_weight": 5.0,
    "l2": 1.0,
    "l1": 0.1,
    "bins": 256,
    "seed": 42,
}

FEATURE_COLUMNS = (
    "units_lag_1w", "units_lag_2w", "units_lag_4w", "units_lag_8w",
    "units_lag_12w", "units_lag_26w", "units_lag_52w",
    "rolling_mean_4w", "rolling_mean_12w", "rolling_mean_26w",
    "rolling_std_4w", "rolling_std_12w",
    "any_promo", "promo_rate_4w",
    "week_of_year", "month", "quarter", "is_holiday_season",
    "yoy_growth", "price_gap_vs_family",
)
ID_COLUMNS = ("store_id", "item_id")

# Pricing recommendation.
GAP_LIMIT = 0.15
OVERPRICED_RATIO = 0.85
UNDERPRICED_RATIO = 1.10

# Elasticity buckets: right-closed upper edges, the last one is open.
BUCKET_EDGES = (-0.5, -0.1, 0.1, 0.5)
BUCKET_LABELS = (
    "highly_elastic", "elastic", "inelastic", "slightly_inelastic", "highly_inelastic",
)

# Recommendation colours of the scatter export.
RECOMMENDATION_COLOURS = {
    "OVERPRICED": "#E63946",
    "UNDERPRICED": "#2A9D8F",
    "MARKET_RATE": "#457B9D",
}

# Run selection.
REGISTER_THRESHOLD = 0.15
SCORING_THRESHOLD = 0.20
EXPERIMENT = "pricing/demand_forecast"
# Models on the 22 inputs that contain the current week are compared among themselves only.
PARITY_EXPERIMENT = "pricing/demand_forecast_parity"
ELASTICITY_EXPERIMENT = "pricing/elasticity"
HOLDOUT_METRIC = "ensemble_holdout_mape"
CV_METRIC = "xgb_cv_mape"
TREES_PARAM = "xgb_n_estimators"
