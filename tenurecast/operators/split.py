"""Repeatable train/test splits that need no global sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.order_stats import values_at_ranks

# 13 hexadecimal digits are 52 bits, which a double holds exactly.
_DIGITS = 13


def row_digest(keys: list[str], seed: int = schema.SEED) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _leading(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def hash_test(keys: list[str], seed: int = schema.SEED, parts: int = 3) -> Column:
    """Test rows of the approximate split: one part in ``parts``, no pass needed."""
    return _leading(row_digest(keys, seed), 8) % parts == 0


def exact_test(
    df: DataFrame, keys: list[str], seed: int = schema.SEED, share: float = 1 / 3
) -> Column:
    """Test rows of the exact split: the ceil(share * n) smallest digests.

    Finds the boundary digest with a distributed rank search and returns a
    plain comparison, so every row is classified where it lies.
    """
    digest = row_digest(keys, seed)
    lead = _leading(digest, _DIGITS)
    digests = df.select(lead.alias("lead"), digest.alias("digest"), *keys)
    rows = digests.count()
    size = math.ceil(rows * share - 1e-9)
    if size == 0:
        return F.lit(False)
    boundary = int(values_at_ranks(digests, {"lead": [size - 1]}, {"lead": rows})["lead", size - 1])
    counts = digests.agg(
        F.count_if(F.col("lead") < boundary).alias("below"),
        F.count_if(F.col("lead") == boundary).alias("tied"),
    ).first()
    wanted = size - counts["below"]
    if wanted == counts["tied"]:
        return lead <= boundary
    # Some rows share the boundary's leading digits: order them by digest and key.
    tie_order = ["digest", *keys]
    tied = digests.filter(F.col("lead") == boundary).orderBy(*tie_order)
    last = tied.offset(wanted - 1).first()
    types = {f.name: f.dataType for f in digests.schema.fields}
    here = F.struct(digest.alias("digest"), *keys)
    there = F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in tie_order])
    return (lead < boundary) | ((lead == boundary) & (here <= there))
