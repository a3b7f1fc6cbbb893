"""Mean fill and standardisation with statistics of the training rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import number, quoted
from .profile import collect_profile


@dataclass(frozen=True)
class Scale:
    mean: float
    deviation: float


def fit_scales(train: DataFrame, columns: list[str]) -> dict[str, Scale]:
    """Mean and population deviation of each column after filling with its mean.

    Filling with the mean keeps the mean and spreads the same squared distance
    over all rows, so one pass over the unfilled column is enough.
    """
    profile = collect_profile(train, columns, columns)
    empty = [c for c in columns if profile[c].present == 0]
    if empty:
        raise ValueError(f"no value to learn from in {empty}")
    return {
        c: Scale(s.mean, s.deviation * math.sqrt(s.present / s.rows)) for c, s in profile.items()
    }


def fill_with_mean(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    return df.withColumns(
        {c: F.expr(f"coalesce(double({quoted(c)}), {number(s.mean)})") for c, s in scales.items()}
    )


def standardize(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    """Centre and scale; a constant column becomes 0 where it is present."""
    return df.withColumns(
        {
            c: F.expr(
                f"({quoted(c)} - {number(s.mean)}) "
                f"/ {number(s.deviation if s.deviation > 0 else 1.0)}"
            )
            for c, s in scales.items()
        }
    )
