"""Partitioned tables, delimited files, and upserts; replacing and deleting is in ``versions``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versions import delete_where, overwrite, without  # noqa: F401

RUN_KEYS = ["calendar", "run_id"]


def write_run(df: DataFrame, path: str, calendar: str, run_id: str) -> None:
    """Publish one run as its own partition.

    Only this run's partition is replaced, so a repeated run leaves no doubles
    and other runs stay in place.
    """
    tagged = df.withColumns({"calendar": F.lit(calendar), "run_id": F.lit(run_id)})
    replace_partitions(tagged, path, RUN_KEYS)


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Overwrite the partitions that occur in ``df``, keep all others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep=sep, header=True, nullValue="", emptyValue='""')


def write_table(
    df: DataFrame, fmt: str, options: dict[str, str], table: str, mode: str = "append"
) -> None:
    """Any Spark data sink that takes ``dbtable``."""
    df.write.format(fmt).options(**options).option("dbtable", table).mode(mode).save()


def upsert(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates, plus the current rows whose key has no update."""
    return current.join(updates.select(key), key, "left_anti").unionByName(updates)
