"""Exact quantiles of a column that may be too long for one task.

``percentile`` sends every distinct value to one reducer. That is fine for weeks and years, whose
number the calendar bounds, but not for one value per item. Here each round counts the values in
equal steps of the range that holds the wanted rank, and goes on inside that step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEPS = 65_536


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Linearly interpolated quantiles of the values that are neither NULL nor NaN; None if there
    are none. Infinite values are the ends of the order.

    Reads ``df`` a few times, so pass a written table.
    """
    known = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    endless = F.abs("v") == math.inf
    values = known.where(~endless)
    count, below_all, finite, low, high = known.agg(
        F.count("v"),
        F.count_if(F.col("v") == -math.inf),
        F.count_if(~endless),
        F.min(F.when(~endless, F.col("v"))),
        F.max(F.when(~endless, F.col("v"))),
    ).first()
    if count == 0:
        return [None for _ in shares]
    places = [share * (count - 1) for share in shares]
    ranks = {math.floor(p) for p in places} | {math.ceil(p) for p in places}
    inside = sorted(r - below_all for r in ranks if 0 <= r - below_all < finite)
    at = {r: -math.inf if r < below_all else math.inf for r in ranks}
    if inside:
        at |= {r + below_all: v for r, v in _by_rank(values, low, high, inside).items()}
    result = []
    for place in places:
        below, above = at[math.floor(place)], at[math.ceil(place)]
        share = place - math.floor(place)
        result.append(below if below == above or not share else below + share * (above - below))
    return result


def _by_rank(values: DataFrame, low: float, high: float, ranks: list[int]) -> dict[int, float]:
    """Value of each 0-based rank. Ranges are (low, high, rank of their first value)."""
    ranges = {rank: (low, high, 0) for rank in ranks}
    while open_ranges := {r for r in ranges.values() if r[0] < r[1]}:
        narrowed = _narrow(values, sorted(open_ranges), ranks)
        for rank, old in ranges.items():
            if old in open_ranges:
                ranges[rank] = next(
                    (lo, hi, first)
                    for source, lo, hi, first, size in narrowed
                    if source == old and first <= rank < first + size
                )
    return {rank: low for rank, (low, _, _) in ranges.items()}


def _narrow(values: DataFrame, ranges: list[tuple], ranks: list[int]) -> list[tuple]:
    """The steps of each range that hold a wanted rank: at most one per rank comes back."""
    which, step, base = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for i, (low, high, first) in enumerate(ranges):
        inside = (F.col("v") >= low) & (F.col("v") <= high)
        which = F.when(inside, i).otherwise(which)
        # Halves, so that the width of the whole range of doubles is still a double.
        share = (F.col("v") / 2 - low / 2) / (high / 2 - low / 2)
        step = F.when(inside, (share * STEPS).cast("int")).otherwise(step)
        base = F.when(F.col("which") == i, F.lit(first)).otherwise(base)
    sizes = (
        values.select("v", which.alias("which"), step.alias("step"))
        .where("which IS NOT NULL")
        .groupBy("which", "step")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("size"))
    )
    running = Window.partitionBy("which").orderBy("step")
    placed = sizes.withColumn("first", base + F.sum("size").over(running) - F.col("size"))
    holds = F.lit(False)
    for rank in ranks:
        holds = holds | ((F.col("first") <= rank) & (F.col("first") + F.col("size") > rank))
    hits = placed.where(holds).select("which", "lo", "hi", "first", "size").collect()
    return [(ranges[h["which"]], h["lo"], h["hi"], h["first"], h["size"]) for h in hits]
