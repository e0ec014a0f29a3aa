"""Session defaults. Settings given to spark-submit win over these, apart from the time zone: weeks
and days are cut in UTC."""

import os

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

TIME_ZONE = {"spark.sql.session.timeZone": "UTC"}
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs the aggregation above it a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _submitted() -> dict[str, str]:
    """Settings of the spark-submit that started this process; none if there was none."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return {}
    SparkContext._ensure_initialized()
    return dict(SparkConf().getAll())


def build_session(app_name: str = "shelfcast", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = _submitted()
    defaults = {key: value for key, value in DEFAULTS.items() if key not in given}
    for key, value in {**defaults, **TIME_ZONE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
