"""Declared schemas of the raw tables and of every stage output."""

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
}


def _struct(spec: str) -> T.StructType:
    """Fields from "name type, name type"; usable before a session exists."""
    fields = (field.split(" ") for field in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


TRAIN = _struct(
    "id bigint, date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean"
)
ITEMS = _struct("item_nbr int, family string, class int, perishable boolean")
STORES = _struct("store_nbr int, city string, state string, type string, cluster int")
OIL = _struct("date date, dcoilwtico double")
HOLIDAYS_EVENTS = _struct(
    "date date, type string, locale string, locale_name string, description string, "
    "transferred boolean"
)
RAW = {
    "TRAIN": TRAIN,
    "ITEMS": ITEMS,
    "STORES": STORES,
    "OIL": OIL,
    "HOLIDAYS_EVENTS": HOLIDAYS_EVENTS,
}

WEEKLY_FACTS = _struct(
    "week_start date, store_nbr int, item_nbr int, weekly_units double, "
    "avg_daily_units double, any_promo int, days_in_week bigint"
)
WEEKLY = _struct(
    "week_start date, store_nbr int, item_nbr int, weekly_units double, "
    "avg_daily_units double, any_promo int, days_in_week bigint, family string, class int, "
    "perishable boolean, city string, state string, type string, cluster int"
)
FEATURES = T.StructType(
    WEEKLY.fields
    + _struct(
        "units_lag_1w double, units_lag_2w double, units_lag_4w double, units_lag_8w double, "
        "units_lag_12w double, units_lag_26w double, units_lag_52w double, "
        "rolling_mean_4w double, rolling_std_4w double, rolling_max_4w double, "
        "rolling_mean_12w double, rolling_std_12w double, rolling_max_12w double, "
        "rolling_mean_26w double, rolling_std_26w double, rolling_max_26w double, "
        "yoy_growth double, week_of_year int, month int, quarter int, year int, "
        "is_holiday_season int, promo_rate_4w double, family_median_units double, "
        "price_gap_vs_family double"
    ).fields
)
OLS = _struct(
    "sku string, elasticity_promo double, elasticity_baseline double, r_squared double, "
    "n_obs bigint, p_value_promo double, aic double"
)
DID = _struct(
    "sku string, did_att double, did_se double, did_pvalue double, did_r2 double"
)
ELASTICITY = T.StructType(OLS.fields + DID.fields[1:])
ARIMA_FORECAST = _struct(
    "store_nbr int, item_nbr int, forecast_step int, arima_forecast double"
)
IMPORTANCE = _struct("feature string, importance double")
SCORED_EXTRA = _struct(
    "store_id int, item_id int, xgb_forecast double, pricing_recommendation string"
)
RUNS = _struct(
    "run_id string, experiment string, run_name string, ts timestamp, "
    "params map<string,string>, metrics map<string,double>, model_path string"
)


def same_fields(actual: T.StructType, expected: T.StructType) -> bool:
    """Names and types in order; nullability is not compared."""
    return [(f.name, f.dataType) for f in actual] == [(f.name, f.dataType) for f in expected]
