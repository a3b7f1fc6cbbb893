"""One-pass column statistics and level lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..schema import quoted


@dataclass(frozen=True)
class ColumnStats:
    rows: int
    present: int
    mean: float | None = None
    deviation: float | None = None


def _stats_row(df: DataFrame, columns: list[str], measures: set[str]) -> DataFrame:
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        exprs.append(F.count(quoted(c)).alias(f"n{i}"))
        if c in measures:
            value = F.col(quoted(c)).cast("double")
            exprs += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"d{i}")]
    return df.agg(*exprs)


def column_profile(df: DataFrame, columns: list[str], measures: list[str]) -> DataFrame:
    """One row per column: rows, present values, mean, population deviation."""
    wide = _stats_row(df, columns, set(measures))
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("n_rows"),
            F.col(f"n{i}").alias("n_present"),
            (F.col(f"m{i}") if c in measures else F.lit(None).cast("double")).alias("mean"),
            (F.col(f"d{i}") if c in measures else F.lit(None).cast("double")).alias("deviation"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def collect_profile(
    df: DataFrame, columns: list[str], measures: list[str]
) -> dict[str, ColumnStats]:
    """The profile as a small mapping; its size is the number of columns."""
    row = _stats_row(df, columns, set(measures)).first()
    return {
        c: ColumnStats(
            row["rows"],
            row[f"n{i}"],
            *((row[f"m{i}"], row[f"d{i}"]) if c in measures else ()),
        )
        for i, c in enumerate(columns)
    }


def sparse_columns(profile: dict[str, ColumnStats], share: float = schema.SPARSE_SHARE) -> list[str]:
    """Columns with fewer present values than ``share`` of the rows."""
    return [c for c, s in profile.items() if s.present < share * s.rows]


def _pairs(df: DataFrame, features: list[str]) -> DataFrame:
    entries = [
        F.struct(F.lit(f).alias("feature"), F.col(quoted(f)).alias("level")) for f in features
    ]
    return df.select(F.inline(F.array(*entries))).filter(F.col("level").isNotNull())


def level_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """Number of distinct non-null levels per categorical feature.

    Levels are made distinct with a map-side combined aggregate before they are
    counted, so a feature with one dominant level costs no more than another.
    """
    return _pairs(df, features).distinct().groupBy("feature").agg(F.count("level").alias("n_levels"))


def collect_levels(
    df: DataFrame, features: list[str], most: int | None = None
) -> dict[str, list[str]]:
    """Sorted levels per feature. They become columns; a caller may bound their number."""
    found = _pairs(df, features).distinct()
    rows = (found if most is None else found.limit(most + 1)).collect()
    if most is not None and len(rows) > most:
        raise ValueError(f"more than {most} levels in {features}: consolidate them first")
    levels: dict[str, list[str]] = {f: [] for f in features}
    for r in rows:
        levels[r["feature"]].append(r["level"])
    return {f: sorted(values) for f, values in levels.items()}
