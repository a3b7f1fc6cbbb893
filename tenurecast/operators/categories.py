"""Category consolidation and indicator columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..schema import indicator, quoted

MOST_BROADCAST = 10_000


def mapped(column: str, lookup: dict[str, str]) -> Column:
    """Value of a fixed lookup; unknown and NULL keys give NULL."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in lookup.items())
    return F.create_map(*pairs)[F.col(quoted(column))]


def consolidate(df: DataFrame) -> DataFrame:
    """Consolidate job titles and industries if present; unknown values become missing."""
    lookups = {"TITLE_CATEGORY_YR_END": schema.TITLE_LOOKUP, "INDUSTRY": schema.INDUSTRY_LOOKUP}
    new = {c: mapped(c, lookup) for c, lookup in lookups.items() if c in df.columns}
    return df.withColumns(new) if new else df


def lookup_join(df: DataFrame, column: str, lookup: dict[str, str], out: str) -> DataFrame:
    """Left join to a lookup; unmatched rows get NULL.

    A lookup of at most ``MOST_BROADCAST`` entries goes to every executor, so a
    value that fills a third of the rows is not shuffled to one task. A longer
    one is left to Spark, which sees its size at run time and splits hot keys.
    """
    table = df.sparkSession.createDataFrame(list(lookup.items()), "_raw string, _mapped string")
    if len(lookup) <= MOST_BROADCAST:
        table = F.broadcast(table)
    joined = df.join(table, F.col(quoted(column)) == F.col("_raw"), "left")
    return joined.drop("_raw").withColumnRenamed("_mapped", out)


def indicators(levels: dict[str, list[str]]) -> list[str]:
    return [indicator(f, level) for f, values in levels.items() for level in values]


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each categorical column by one 0/1 column per known level.

    Missing and unknown values give all zeros; a level that does not occur
    still gets its column, which keeps scoring aligned with training.
    """
    new = {
        indicator(f, level): F.coalesce((F.col(f) == level).cast("int"), F.lit(0))
        for f, values in levels.items()
        for level in values
    }
    return df.withColumns(new).drop(*levels)


def add_absent(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the listed indicator columns that are absent, as zeros."""
    absent = {c: F.lit(0) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def fixed_indicators() -> list[str]:
    """Indicator columns of the score-only layout."""
    return indicators(
        {
            "TITLE_CATEGORY_YR_END": schema.FIXED_TITLES,
            "INDUSTRY": schema.FIXED_INDUSTRIES,
            "OWNERSHIP": schema.FIXED_OWNERSHIP,
        }
    )


def conditional_indicators(present: list[str]) -> list[str]:
    """Ownership always; titles only if all five exist; one industry if it exists."""
    titles = [indicator("TITLE_CATEGORY_YR_END", t) for t in schema.FIXED_TITLES]
    industry = indicator("INDUSTRY", "SaaS & Cloud")
    chosen = [indicator("OWNERSHIP", o) for o in ("Public", "Private")]
    if all(t in present for t in titles):
        chosen += titles
    if industry in present:
        chosen.append(industry)
    return chosen
