"""Keep businesses whose history can teach a model something.

Labels are reduced to counts, minima and maxima before any shuffle, which gives
one verdict per business. Verdicts of businesses that hold more rows than a
shuffle partition should are few by construction and are broadcast; only rows
of the others are shuffled to their verdict, so no task gets a hot business.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BUSINESS, LABEL, Calendar
from ..session import staged


def label_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group and label; groups with a missing key are left out."""
    keys = [*by, LABEL]
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _verdicts(df: DataFrame, year: str | None, keep: Column) -> DataFrame:
    """One row per business: its rows and whether ``keep`` holds.

    ``keep`` may use ``least`` and ``most`` (labels seen) and ``worst``, the
    highest yearly minimum: above 0 if nobody stayed in some year.
    """
    known_year = F.col(year) if year else F.lit(0)
    per_year = (
        df.filter(F.col(BUSINESS).isNotNull())
        .groupBy(BUSINESS, known_year.alias("year"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(LABEL).alias("least"), F.max(LABEL).alias("most"))
    )
    per_business = per_year.groupBy(BUSINESS).agg(
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.max(F.when(F.col("year").isNotNull(), F.col("least"))).alias("worst"),
    )
    return per_business.select(BUSINESS, "n", F.coalesce(keep, F.lit(False)).alias("keep"))


def _rows_of(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of the kept businesses."""
    verdicts = staged(verdicts, "verdicts")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = verdicts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Each of these holds more than one partition's share, so they are fewer than partitions.
    is_hot = F.col("n") > rows / partitions
    hot = verdicts.filter(is_hot)
    kept = F.col("keep")
    return df.join(F.broadcast(hot.filter(kept).select(BUSINESS)), BUSINESS, "left_semi").unionByName(
        df.join(F.broadcast(hot.select(BUSINESS)), BUSINESS, "left_anti").join(
            verdicts.filter(kept & ~is_hot).select(BUSINESS), BUSINESS, "left_semi"
        )
    )


_VARIED = "least < most"
_EMPTIED = "coalesce(worst > 0, false)"


def with_both_labels(df: DataFrame) -> DataFrame:
    """Rows of businesses that show at least two different labels.

    ``df`` is read more than once, so hand in a stored table.
    """
    return _rows_of(df, _verdicts(df, None, F.expr(_VARIED)))


def without_empty_years(df: DataFrame, calendar: Calendar) -> DataFrame:
    """Drop every business that has a year in which nobody stayed.

    Rows without a business belong to none and stay.
    """
    verdicts = _verdicts(df, calendar.year, F.expr(f"not {_EMPTIED}"))
    return _rows_of(df, verdicts).unionByName(df.filter(F.col(BUSINESS).isNull()))


def teaching_cohort(df: DataFrame, calendar: Calendar) -> DataFrame:
    """Both filters at once: one verdict per business answers both."""
    keep = F.expr(f"{_VARIED} and not {_EMPTIED}")
    return _rows_of(df, _verdicts(df, calendar.year, keep))
