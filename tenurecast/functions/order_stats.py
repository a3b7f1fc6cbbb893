"""Exact order statistics by a radix search, without sorting a column or holding it in one task.

A double is turned into a whole number that orders like it: its sign, exponent and fraction
as 64 bits, which Arrow batches hold already. A wanted rank is searched from the leading bits
on: one pass counts the rows of every value of the next ``BITS`` bits (per batch, then summed
map-side, so a task sends one row per bit pattern at most, however many rows share it), the
counts are added up in order, and the pattern that holds the rank is followed. A search ends
when all rows of its pattern are the same value or are few enough to fetch with their counts;
64 bits end it in any case. All searches of all columns share their passes.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import quoted

#: Bits that a pass counts, and rows that may be fetched for all searches together.
BITS = 16
FETCH_LIMIT = 20_000

_INFINITE = 2047 << 52


@dataclass(frozen=True)
class _Search:
    column: str
    rank: int  # zero-based rank in the column, the key of the result
    prefix: int | None  # leading bits that are known, None = none yet
    depth: int  # how many bits these are
    local: int  # rank among the rows with these leading bits
    inside: int  # how many rows that are


def _whole_numbers() -> Callable[[np.ndarray], np.ndarray]:
    """Doubles to 64-bit integers that order like them; -0.0 is 0, NaN above infinity.

    A function made here goes to the tasks whole, which need not find this module then.
    """

    def whole(values: np.ndarray) -> np.ndarray:
        missing = np.isnan(values)
        size = np.where(missing, 0.0, np.abs(values)).view(np.int64)
        bits = np.where(values < 0, -size, size)
        bits[missing] = _INFINITE + 1
        return bits

    return whole


def ordered_bits(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with a bigint that orders like the double ``value``, NaN and -0.0 too."""
    whole = _whole_numbers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(value)
            bits = pa.array(whole(values.fill_null(0.0).to_numpy(zero_copy_only=False)), mask=values.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, bits], names=[*batch.schema.names, out])

    return df.mapInArrow(run, StructType([*df.schema.fields]).add(out, "long"))


def from_ordered_bits(bits: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


def _slots(searches: list[_Search]) -> dict[tuple[str, int | None], list[_Search]]:
    """Searches that follow the same bits of the same column share their counts."""
    slots: dict[tuple[str, int | None], list[_Search]] = {}
    for s in searches:
        slots.setdefault((s.column, s.prefix), []).append(s)
    return slots


def _rows_inside(df: DataFrame, slots: dict, depth: int, step: int | None = None) -> DataFrame:
    """(slot, bits, most, n) of the rows that some search still follows.

    Rows of a batch that share the next ``step`` bits (by default, all bits) are one row: the
    least and the greatest of them, and how many they are.
    """
    followed: dict[str, list[tuple[int, int | None]]] = {}
    for slot, (column, prefix) in enumerate(slots):
        followed.setdefault(column, []).append((slot, prefix))
    low = 0 if step is None else 64 - depth - step
    whole = _whole_numbers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty((0, 4), np.int64)]
            for column, searches in zip(batch.columns, followed.values(), strict=True):
                bits = whole(column.drop_null().to_numpy(zero_copy_only=False))
                for slot, prefix in searches:
                    own = np.sort(bits if prefix is None else bits[bits >> (64 - depth) == prefix])
                    heads = own >> low
                    first = np.flatnonzero(np.append(True, heads[1:] != heads[:-1])) if len(own) else np.empty(0, np.int64)
                    ends = np.append(first[1:], len(own))[: len(first)]
                    found.append(np.stack([np.full(len(first), slot), own[first], own[ends - 1], ends - first], axis=1))
            rows = np.concatenate(found)
            slot, *rest = (np.ascontiguousarray(rows[:, i]) for i in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), *map(pa.array, rest)], names=["slot", "bits", "most", "n"])

    values = [F.expr(f"double({quoted(c)})").alias(f"c{i}") for i, c in enumerate(followed)]
    return df.select(*values).mapInArrow(run, "slot int, bits long, most long, n long")


def _narrow(df: DataFrame, searches: list[_Search], bits: int) -> tuple[dict, list[_Search]]:
    """Follow every search by the next bits; resolve those whose rows are all alike."""
    slots, depth = _slots(searches), searches[0].depth
    step = min(bits, 64 - depth)
    inside = _rows_inside(df, slots, depth, step)
    counts = inside.groupBy("slot", F.shiftright("bits", 64 - depth - step).alias("prefix")).agg(
        F.sum("n").alias("n"), F.min("bits").alias("least"), F.max("most").alias("most")
    )
    # At most one row per slot and pattern reaches this window.
    earlier = Window.partitionBy("slot").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranks = ", ".join(f"array({', '.join(f'{s.local}L' for s in group)})" for group in slots.values())
    holding = f"exists(array({ranks})[slot], r -> r >= before and r < before + n)"
    rows = counts.filter(holding).collect()
    found, pending = {}, []
    for slot, group in enumerate(slots.values()):
        for s in group:
            r = next(r for r in rows if r["slot"] == slot and r["before"] <= s.local < r["before"] + r["n"])
            if r["least"] == r["most"]:
                found[s.column, s.rank] = from_ordered_bits(r["least"])
            else:
                pending.append(_Search(s.column, s.rank, r["prefix"], depth + step, s.local - r["before"], r["n"]))
    return found, pending


def _fetch(df: DataFrame, searches: list[_Search]) -> dict:
    """Resolve searches whose remaining rows are known to be few."""
    slots = _slots(searches)
    inside = _rows_inside(df, slots, searches[0].depth)
    by_slot: dict[int, list[tuple[int, int]]] = {}
    for r in inside.groupBy("slot", "bits").agg(F.sum("n").alias("n")).collect():
        by_slot.setdefault(r["slot"], []).append((r["bits"], r["n"]))
    found = {}
    for slot, group in enumerate(slots.values()):
        values = sorted(by_slot[slot])
        for s in group:
            left = s.local
            for bits, count in values:
                if left < count:
                    found[s.column, s.rank] = from_ordered_bits(bits)
                    break
                left -= count
    return found


def values_at_ranks(
    df: DataFrame,
    wanted: dict[str, list[int]],
    counts: dict[str, int],
    bits: int = BITS,
    fetch_limit: int = FETCH_LIMIT,
) -> dict[tuple[str, int], float]:
    """``{(column, rank): value}`` for zero-based ranks among non-null values.

    ``counts`` holds the number of non-null values per column.
    """
    pending = []
    for column, ranks in wanted.items():
        for rank in sorted(set(ranks)):
            if not 0 <= rank < counts[column]:
                raise ValueError(f"rank {rank} out of range for {column}")
            pending.append(_Search(column, rank, None, 0, rank, counts[column]))
    found: dict[tuple[str, int], float] = {}
    while pending:
        sizes = {(s.column, s.prefix): s.inside for s in pending}
        if sum(sizes.values()) <= fetch_limit:
            found.update(_fetch(df, pending))
            break
        resolved, pending = _narrow(df, pending, bits)
        found.update(resolved)
    return found


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    counts: dict[str, int] | None = None,
    **limits: int,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, nulls skipped."""
    if counts is None:
        row = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        counts = {c: row[f"c{i}"] for i, c in enumerate(columns)}
    places = {
        c: [(counts[c] - 1) * p for p in probabilities] for c in columns if counts[c] > 0
    }
    wanted = {
        c: [r for h in hs for r in (math.floor(h), math.ceil(h))] for c, hs in places.items()
    }
    found = values_at_ranks(df, wanted, counts, **limits) if wanted else {}
    result: dict[str, list[float | None]] = {}
    for c in columns:
        if c not in places:
            result[c] = [None] * len(probabilities)
            continue
        result[c] = []
        for h in places[c]:
            low, high = found[c, math.floor(h)], found[c, math.ceil(h)]
            result[c].append(low + (high - low) * (h - math.floor(h)))
    return result
