"""Rule labels and guarded ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.constants import (
    BUCKET_EDGES,
    BUCKET_LABELS,
    GAP_LIMIT,
    OVERPRICED_RATIO,
    RECOMMENDATION_COLOURS,
    UNDERPRICED_RATIO,
)


def pricing_recommendation(gap: Column, forecast: Column, baseline: Column) -> Column:
    """High gap with weak demand, low gap with strong demand, or neither (also if unknown)."""
    rules = {
        "OVERPRICED": (gap > GAP_LIMIT) & (forecast < baseline * OVERPRICED_RATIO),
        "UNDERPRICED": (gap < -GAP_LIMIT) & (forecast > baseline * UNDERPRICED_RATIO),
    }
    label = F.lit("MARKET_RATE")
    for name, rule in rules.items():
        label = F.when(rule, name).otherwise(label)
    return label


def recommendation_colour(label: Column) -> Column:
    colours = F.create_map(*[F.lit(v) for item in RECOMMENDATION_COLOURS.items() for v in item])
    return F.coalesce(colours[label], F.lit("#888"))


def elasticity_bucket(value: Column) -> Column:
    """Right-closed bucket of a coefficient; NULL and NaN have none."""
    label = F.lit(BUCKET_LABELS[-1])
    for edge, name in reversed(list(zip(BUCKET_EDGES, BUCKET_LABELS))):
        label = F.when(value <= edge, name).otherwise(label)
    return F.when(value.isNotNull() & ~F.isnan(value), label)


def ratio_or(numerator: Column, denominator: Column, default: float = 1.0) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(default)


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    """Relative error of one row; NULL, hence outside any average, unless the actual is > 0."""
    return F.when(actual > 0, F.abs(actual - predicted) / actual)
