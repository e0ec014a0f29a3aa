"""Model inputs: training matrix, time-ordered folds and the holdout split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.constants import (
    CV_SPLITS,
    FEATURE_COLUMNS,
    HOLDOUT_QUANTILE,
    ID_COLUMNS,
    MIN_SERIES_POINTS,
    PANEL_KEY,
    SERIES,
    TARGET,
)
from shelfcast.operators.features import sku_window

# Both carry the current week's units: growth against a lag that is itself a feature gives the
# target away, and so does the gap to the family median.
LEAKING = ("yoy_growth", "price_gap_vs_family")


def existing(df: DataFrame, columns: Sequence[str], strict: bool = True) -> list[str]:
    """``columns`` that ``df`` has. Strict, the default, refuses to drop any silently."""
    missing = [c for c in columns if c not in df.columns]
    if missing and strict:
        raise ValueError(f"columns not in the table: {missing}")
    return [c for c in columns if c not in missing]


def feature_columns(leak_free: bool = False) -> tuple[str, ...]:
    """The 22 model inputs; leak-free, the two leaking ones come from the previous row."""
    names = [f"{c}_prev" if leak_free and c in LEAKING else c for c in FEATURE_COLUMNS]
    return (*names, *ID_COLUMNS)


def with_previous_week(features: DataFrame) -> DataFrame:
    """Last row's value of the leaking features, known before the current week is sold."""
    return features.withColumns(
        {f"{c}_prev": F.lag(c, 1).over(sku_window()) for c in LEAKING}
    )


def training_matrix(
    features: DataFrame, columns: Sequence[str] | None = None, strict: bool = True
) -> DataFrame:
    """Key, inputs and target; rows with a NULL in any input or in the target are dropped."""
    inputs = existing(features, columns or feature_columns(), strict)
    rows = features.select(*PANEL_KEY, *inputs, TARGET)
    return rows.na.drop(subset=[*inputs, TARGET])


def _levels() -> list[tuple[str, Column]]:
    """Sort key of a panel row, coarse to fine; an item block holds at most 65,536 items."""
    return [
        ("week_start", F.col("week_start")),
        ("store_nbr", F.col("store_nbr")),
        ("item_block", F.shiftright("item_nbr", 16)),
        ("item_nbr", F.col("item_nbr")),
    ]


def keys_at(rows: DataFrame, positions: Sequence[int]) -> list[tuple]:
    """(week, store, item) of the rows at these 0-based places of the (week, store, item) order.

    Found by narrowing down, without sorting or shuffling the rows: count per week, then per
    store inside the weeks that hold a wanted place, then per item block, then per item. Each
    step reads only the groups picked before it and returns one row per wanted place.
    """
    wanted = [((), place) for place in positions]
    names: list[str] = []
    for name, value in _levels():
        scoped = rows.select(*[expr.alias(n) for n, expr in _levels()])
        if names:
            scoped = scoped.where(_any(_equals(names, prefix) for prefix, _ in wanted))
        sizes = scoped.groupBy(*names, name).agg(F.count(F.lit(1)).alias("size"))
        running = Window.partitionBy(*names).orderBy(name)
        placed = sizes.withColumn("before", F.sum("size").over(running) - F.col("size"))
        holds = _any(
            _equals(names, prefix)
            & (F.col("before") <= place)
            & (F.col("before") + F.col("size") > place)
            for prefix, place in wanted
        )
        names.append(name)
        picked = placed.where(holds).collect()
        wanted = [
            (tuple(hit[n] for n in names), place - hit["before"])
            for prefix, place in wanted
            for hit in picked
            if tuple(hit[n] for n in names[:-1]) == prefix
            and hit["before"] <= place < hit["before"] + hit["size"]
        ]
    return [(week, store, item) for (week, store, _, item), _ in wanted]


def _equals(names: Sequence[str], values: Sequence) -> Column:
    return _all(F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(names, values))


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def _any(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def fold_starts(rows: DataFrame, n_splits: int = CV_SPLITS) -> list[tuple]:
    """First row of each test fold. Fold size is rows div (n_splits + 1), the rest trains."""
    total = rows.count()
    size = total // (n_splits + 1)
    if size == 0:
        raise ValueError(f"{total} rows cannot be cut into {n_splits + 1} blocks")
    return keys_at(rows, [total - (n_splits - fold) * size for fold in range(n_splits)])


def with_test_fold(rows: DataFrame, starts: Sequence[tuple]) -> DataFrame:
    """``test_fold`` i in 1..n for rows tested in fold i, 0 for rows that are only trained on.

    Fold i trains on every row with a smaller ``test_fold``. Ties of a week are broken by store
    and item, so the folds do not depend on row order.
    """
    key = F.struct(*PANEL_KEY)
    passed = [
        (key >= F.struct(*[F.lit(v).alias(n) for n, v in zip(PANEL_KEY, start)])).cast("int")
        for start in starts
    ]
    fold = F.lit(0)
    for reached in passed:
        fold = fold + reached
    return rows.withColumn("test_fold", fold)


def holdout_cutoff(rows: DataFrame, quantile: float = HOLDOUT_QUANTILE) -> DataFrame:
    """First day of the holdout: the row-weighted, interpolated quantile of the week.

    One row. The aggregation buffer holds one counter per distinct week.
    """
    day = F.percentile(F.unix_date("week_start"), quantile)
    return rows.agg(F.date_from_unix_date(F.ceil(day).cast("int")).alias("cutoff"))


def with_holdout(rows: DataFrame, quantile: float = HOLDOUT_QUANTILE) -> DataFrame:
    cutoff = holdout_cutoff(rows, quantile).scalar()
    return rows.withColumn("is_holdout", F.col("week_start") >= cutoff)


def arima_eligibility(panel: DataFrame, min_points: int = MIN_SERIES_POINTS) -> DataFrame:
    """Length of every series and whether it is long enough to be fitted."""
    return panel.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_points")).withColumn(
        "eligible", F.col("n_points") >= min_points
    )
