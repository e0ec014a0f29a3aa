"""Least squares on centered cross-products, as SQL expressions over one row per group.

Regressors enter one after another; each is replaced by what the earlier ones do not explain
(Gram-Schmidt, i.e. an LDL' factorisation of the cross-product matrix). The coefficient of the
last regressor is then its own simple regression slope. A regressor with nothing left is
dropped: its coefficient is not identified.

Expressions refer to earlier ones of the same select by alias, so a whole fit is one select.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Share of a regressor's centered sum of squares that must be left for it to be identified.
IDENTIFIED_SHARE = 1e-9
# A centered sum of squares below this share of count * mean^2 is rounding of a constant.
CONSTANT_SHARE = 1e-12
# A row with less than this left of 1 - leverage fits itself; HC3 is then undefined.
LEVERAGE_MARGIN = 1e-9


def pair(a: str, b: str) -> str:
    """Column name of a cross-product, the same for (a, b) and (b, a)."""
    first, second = sorted((a, b))
    return f"{first}__{second}"


def pairs(*groups: Sequence[str]) -> list[tuple[str, str]]:
    """Unordered pairs, with repetition, of variables that share a group."""
    found = {tuple(sorted((a, b))) for names in groups for a in names for b in names}
    return sorted(found)


def factorise(moments: DataFrame, order: Sequence[str], y: str, tag: str) -> DataFrame:
    """Add the factors of regressing ``y`` on ``order``.

    Needs the centered products ``pair(a, b)``, the means ``mean_x`` and the count ``n``. Adds,
    all prefixed by ``tag``: ``l_x_k`` (weight of the k-th orthogonal regressor in x), ``d_x``
    (sum of squares left), ``ok_x`` (identified), ``b_x`` (slope of y on the orthogonal x), and
    ``ssr`` and ``rank`` of the whole fit.
    """
    added = []
    for i, x in enumerate(order):
        before = order[:i]
        for j, k in enumerate(before):
            shared = "".join(
                f" - {tag}_l_{x}_{m} * {tag}_l_{k}_{m} * {tag}_d_{m}" for m in before[:j]
            )
            added.append(
                f"if({tag}_ok_{k}, ({pair(x, k)}{shared}) / {tag}_d_{k}, 0D) AS {tag}_l_{x}_{k}"
            )
        own = pair(x, x)
        left = own + "".join(f" - {tag}_l_{x}_{k} * {tag}_l_{x}_{k} * {tag}_d_{k}" for k in before)
        slope = pair(x, y) + "".join(
            f" - {tag}_l_{x}_{k} * {tag}_b_{k} * {tag}_d_{k}" for k in before
        )
        added += [
            f"{left} AS {tag}_d_{x}",
            f"{own} > {CONSTANT_SHARE}D * n * mean_{x} * mean_{x} "
            f"AND {tag}_d_{x} > {IDENTIFIED_SHARE}D * {own} AS {tag}_ok_{x}",
            f"if({tag}_ok_{x}, ({slope}) / {tag}_d_{x}, 0D) AS {tag}_b_{x}",
        ]
    explained = "".join(f" - {tag}_b_{x} * {tag}_b_{x} * {tag}_d_{x}" for x in order)
    rank = " + ".join(f"int({tag}_ok_{x})" for x in order)
    added += [
        f"greatest({pair(y, y)}{explained}, 0D) AS {tag}_ssr",
        f"{rank} AS {tag}_rank",
    ]
    return moments.selectExpr("*", *added)


def coefficient(tag: str, x: str) -> str:
    """Coefficient of ``x``, the last regressor of the factorisation; NULL if not identified."""
    return f"if({tag}_ok_{x}, {tag}_b_{x}, NULL)"


def factor_columns(order: Sequence[str], tag: str) -> list[str]:
    """The factors that row_terms needs beside every row."""
    weights = [f"{tag}_l_{x}_{k}" for i, x in enumerate(order) for k in order[:i]]
    return weights + [f"{tag}_{kind}_{x}" for x in order for kind in ("d", "ok", "b")]


def row_terms(rows: DataFrame, order: Sequence[str], y: str, tag: str, keep: Sequence[str]
) -> DataFrame:
    """Per row: ``v`` (orthogonal part of the last regressor), ``free`` (1 - leverage) and ``e``
    (residual), for rows joined with their group's factors."""
    added = []
    for i, x in enumerate(order):
        rest = "".join(f" - {tag}_l_{x}_{k} * v_{k}" for k in order[:i])
        added.append(f"{x} - mean_{x}{rest} AS v_{x}")
    leverage = "".join(
        f" - if({tag}_ok_{x}, v_{x} * v_{x} / {tag}_d_{x}, 0D)" for x in order
    )
    residual = "".join(f" - {tag}_b_{x} * v_{x}" for x in order)
    added += [f"1D - 1D / n{leverage} AS free", f"{y} - mean_{y}{residual} AS e"]
    return rows.selectExpr(*keep, *added).select(*keep, f"v_{order[-1]}", "free", "e")
