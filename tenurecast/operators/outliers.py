"""Replace far values by a quartile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.order_stats import exact_quantiles
from ..schema import number, quoted
from .profile import ColumnStats, collect_profile


@dataclass(frozen=True)
class Fence:
    low: float
    high: float
    lower_quartile: float
    upper_quartile: float


def fit_fences(
    df: DataFrame,
    columns: list[str],
    profile: dict[str, ColumnStats] | None = None,
    sigmas: float = schema.OUTLIER_SIGMAS,
) -> dict[str, Fence]:
    """Mean plus or minus ``sigmas`` deviations, and both quartiles, per column."""
    if profile is None:
        profile = collect_profile(df, columns, columns)
    filled = [c for c in columns if profile[c].present > 0]
    quartiles = exact_quantiles(
        df, filled, [0.25, 0.75], {c: profile[c].present for c in filled}
    )
    return {
        c: Fence(
            profile[c].mean - sigmas * profile[c].deviation,
            profile[c].mean + sigmas * profile[c].deviation,
            *quartiles[c],
        )
        for c in filled
    }


def replace_outliers(df: DataFrame, fences: dict[str, Fence]) -> DataFrame:
    """Values at or beyond a fence become the quartile on that side.

    The upper side goes first and the lower test sees its result; missing
    values stay missing.
    """
    new = {}
    for c, fence in fences.items():
        value = f"double({quoted(c)})"
        upper = (
            f"case when {value} >= {number(fence.high)} then {number(fence.upper_quartile)} "
            f"else {value} end"
        )
        new[c] = F.expr(
            f"case when {upper} <= {number(fence.low)} then {number(fence.lower_quartile)} "
            f"else {upper} end"
        )
    return df.withColumns(new) if new else df
