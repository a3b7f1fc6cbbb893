"""Small repeatable offset per row, from a hash of its values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import quoted

# Hash modulus and largest offset.
_MODULUS = 10**8
_LARGEST = 0.01
_NULL = "NULL"


def row_text(df: DataFrame, columns: list[str]) -> Column:
    """Values joined with ``|``; fractions at six decimals, NULL spelled out."""
    parts = []
    for c in columns:
        value = F.col(quoted(c))
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            value = value.cast("decimal(38,6)")
        parts.append(F.coalesce(value.cast("string"), F.lit(_NULL)))
    return F.concat_ws("|", *parts)


def hash_fraction(text: Column) -> Column:
    """SHA-256 of the text modulo 10^8, scaled into [0, 0.01).

    The 256-bit remainder is folded 32 bits at a time, so it fits in a bigint.
    """
    digest = F.sha2(text, 256)
    rest = F.lit(0).cast("bigint")
    for i in range(8):
        chunk = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(2**32) + chunk) % F.lit(_MODULUS)
    return rest.cast("double") / _MODULUS * _LARGEST


def with_jitter(
    df: DataFrame,
    probability: str,
    columns: list[str],
    keys: list[str] | None = None,
) -> DataFrame:
    """Add the offset to a probability; rows at 1 keep their differences and may exceed it.

    Rows with equal values get equal offsets; pass ``keys`` to tell them apart.
    """
    offset = hash_fraction(row_text(df, [*(keys or []), *columns]))
    return df.withColumn(probability, F.col(probability) + offset)
