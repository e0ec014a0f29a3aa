"""Small panels with fixed seeds, and collected rows to compare."""

from datetime import date, timedelta

import numpy as np
import pandas as pd

MONDAY = date(2018, 1, 1)


def week(n):
    return MONDAY + timedelta(weeks=n)


def panel(n_items=3, n_weeks=60, n_stores=1, seed=1, first_item=1):
    """Weekly rows of n_items x n_stores series, in shuffled order."""
    rng = np.random.default_rng(seed)
    rows = [
        {
            "week_start": week(w),
            "store_nbr": s,
            "item_nbr": i,
            "weekly_units": float(max(0.0, np.round(50 + 10 * i + 10 * rng.standard_normal()))),
            "avg_daily_units": 1.0,
            "any_promo": int(rng.integers(0, 2)),
            "days_in_week": 7,
            "family": f"FAM_{i % 2}",
            "class": i % 7,
            "perishable": bool(i % 2),
            "city": "c",
            "state": "s",
            "type": "t",
            "cluster": 1,
        }
        for i in range(first_item, first_item + n_items)
        for s in range(1, n_stores + 1)
        for w in range(n_weeks)
    ]
    return pd.DataFrame(rows).sample(frac=1.0, random_state=seed).reset_index(drop=True)


def design(n_weeks=80, stores=(1, 2, 3), item=7, seed=3):
    """Rows as the regressions see them."""
    rng = np.random.default_rng(seed)
    rows = []
    for s in stores:
        for w in range(n_weeks):
            promo = int(rng.integers(0, 2))
            year = 2018 + (w // 40)
            rows.append(
                {
                    "week_start": week(w),
                    "store_nbr": s,
                    "item_nbr": item,
                    "year": year,
                    "week_of_year": w % 52 + 1,
                    "weekly_units": float(
                        np.exp(2 + 0.3 * s + 0.4 * promo + 0.2 * promo * (year > 2018)
                               + 0.01 * w + 0.3 * rng.standard_normal())
                    ),
                    "rolling_mean_4w": float(np.exp(2 + 0.5 * rng.standard_normal())),
                    "any_promo": promo,
                }
            )
    return pd.DataFrame(rows)


def rows_of(df, *columns):
    """Collected tuples of the given (or all) columns, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
