"""Casts and column selections by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..schema import Calendar, quoted


def target_type(name: str) -> str:
    if name in schema.STRING_COLUMNS:
        return "string"
    return "bigint" if name in schema.INTEGER_COLUMNS else "double"


def cast_by_name(df: DataFrame, strict: bool = True) -> DataFrame:
    """Integer list to bigint, string list to string, all else to double.

    NaN becomes NULL on the way, so that one kind of "missing" is left. With
    ``strict=False`` values that do not parse become NULL instead of failing.
    """
    exprs = []
    for field in df.schema.fields:
        column, target = quoted(field.name), target_type(field.name)
        fractional = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        if fractional and target != "string":
            column = f"nullif({column}, double('NaN'))"
        cast = f"{'cast' if strict else 'try_cast'}({column} as {target})"
        if isinstance(field.dataType, T.StringType) and target == "double":
            cast = f"nullif({cast}, double('NaN'))"
        exprs.append(f"{cast} as {quoted(field.name)}")
    return df.selectExpr(*exprs)


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def key_projection(df: DataFrame, calendar: Calendar) -> DataFrame:
    return df.select(*calendar.keys)


def without_descriptive(df: DataFrame) -> DataFrame:
    """Drop the optional descriptive columns that are present."""
    return df.drop(*schema.DESCRIPTIVE)


def label_last(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != schema.LABEL]
    return df.select(*[quoted(c) for c in others + [schema.LABEL]])


def for_scoring(df: DataFrame) -> DataFrame:
    """Drop the columns that are unknown when a year is scored, by name."""
    return df.drop(schema.AS_OF, schema.LABEL)


def rename_calendar(df: DataFrame, old: Calendar, new: Calendar) -> DataFrame:
    return df.withColumnsRenamed({old.year: new.year})


def one_calendar(df: DataFrame, calendar: Calendar) -> DataFrame:
    """The rows of one calendar of a table that holds several, its year under its own name."""
    rows = df.filter(F.col(schema.CALENDAR) == calendar.name).drop(schema.CALENDAR)
    return rows.withColumnsRenamed({schema.YEAR: calendar.year})


def candidate_columns(columns: list[str], calendar: Calendar) -> list[str]:
    """Columns that may become features: no key, description or label."""
    held = {*calendar.keys, *schema.DESCRIPTIVE, schema.LABEL}
    return [c for c in columns if c not in held]


def measure_columns(columns: list[str], calendar: Calendar) -> list[str]:
    return [c for c in candidate_columns(columns, calendar) if c not in schema.CATEGORICAL]


def add_differences(df: DataFrame) -> DataFrame:
    """Add max-minus-min columns for the pairs whose inputs are present."""
    new = {
        name: F.col(a) - F.col(b)
        for name, (a, b) in schema.DIFFERENCES.items()
        if a in df.columns and b in df.columns
    }
    return df.withColumns(new) if new else df


def round_features(df: DataFrame, columns: list[str], places: int = 3) -> DataFrame:
    """Round half to even at ``places`` decimals."""
    factor = float(10**places)
    return df.withColumns(
        {c: F.expr(f"rint({quoted(c)} * {factor}D) / {factor}D") for c in columns}
    )


def check_grain(df: DataFrame, calendar: Calendar) -> None:
    """Fail if a key occurs twice; keyed joins and splits rely on it."""
    doubled = df.groupBy(*calendar.grain).count().filter("count > 1").limit(1).collect()
    if doubled:
        raise ValueError(f"more than one row for key {doubled[0].asDict()}")
