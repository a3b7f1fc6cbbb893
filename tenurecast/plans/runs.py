"""Gate, run log and retention of published runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.stamps import expired, parse_stamp
from ..session import delete_folder, folder_exists
from ..sources.readers import list_files
from ..sources.writers import RUN_KEYS


def flags(control: DataFrame, names: list[str]) -> DataFrame:
    """``(NAME, VALUE)`` of each name from one pass; a missing row counts as ``FALSE``."""
    found = control.agg(
        *[F.max(F.when(F.col("NAME") == n, F.col("VALUE"))).alias(f"v{i}") for i, n in enumerate(names)]
    )
    entries = [
        F.struct(F.lit(n).alias("NAME"), F.coalesce(f"v{i}", F.lit("FALSE")).alias("VALUE"))
        for i, n in enumerate(names)
    ]
    return found.select(F.inline(F.array(*entries)))


def may_run(flag: Column, *overrides: Column) -> Column:
    """A raised flag, or any override, lets a run start."""
    allowed = flag == "TRUE"
    for override in overrides:
        allowed = allowed | override
    return allowed


def gate(
    control: DataFrame,
    name: str,
    remote: bool = False,
    test_mode: bool = False,
) -> DataFrame:
    """One row: the flag found and whether to run.

    A remote or test run ignores the flag.
    """
    run = may_run(F.col("VALUE"), F.lit(remote), F.lit(test_mode))
    return flags(control, [name]).withColumn("run", run)


def should_run(control: DataFrame, name: str, **options) -> bool:
    return bool(gate(control, name, **options).first()["run"])


def reset_row(spark: SparkSession, name: str) -> DataFrame:
    """The control row that marks a finished run."""
    return spark.createDataFrame([(name, "FALSE")], "NAME string, VALUE string")


class RunLog:
    """Messages and metrics of one run, kept in order and stored as a table."""

    SCHEMA = (
        "calendar string, run_id string, seq int, step string, metric string, "
        "value double, message string"
    )

    def __init__(self, calendar: str, run_id: str) -> None:
        self.calendar, self.run_id = calendar, run_id
        self.rows: list[tuple] = []

    def add(self, step: str, message: str, metric: str | None = None, value: float | None = None):
        self.rows.append(
            (self.calendar, self.run_id, len(self.rows), step, metric,
             None if value is None else float(value), message)
        )

    def add_measures(self, step: str, kind: str, seen: Observation) -> None:
        """The measures of a written table, as ``kind_measure``."""
        for name, value in seen.get.items():
            self.add(step, f"{kind} {name}: {value}", f"{kind}_{name}", value)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the messages as this run's partition; they are a handful of lines."""
        (
            self.table(spark)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*RUN_KEYS)
            .parquet(path)
        )


def watched(df: DataFrame, *measures: Column) -> tuple[DataFrame, Observation]:
    """``df`` with measures that the job which writes it takes on the way, without a pass of their own."""
    seen = Observation()
    return df.observe(seen, *measures), seen


def score_measures(name: str = schema.PROBABILITY) -> list[Column]:
    """Rows, rows without a score, least and greatest score."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(name).isNull()).alias("unscored"),
        F.min(name).alias("least"),
        F.max(name).alias("greatest"),
    ]


def marked_runs(
    manifest: DataFrame, as_of: Column, days: int = schema.RETENTION_DAYS, name: str = "name"
) -> DataFrame:
    """The manifest with each name's time, whether it parses and whether it is due."""
    stamp = parse_stamp(F.col(name))
    return manifest.select(
        "*",
        stamp.alias("run_ts"),
        stamp.isNull().alias("malformed"),
        expired(stamp, as_of, days).alias("expired"),
    )


def retained(manifest: DataFrame, as_of: Column, days: int = schema.RETENTION_DAYS) -> DataFrame:
    """The manifest without the runs that are due."""
    return marked_runs(manifest, as_of, days).filter(~F.col("expired")).drop(
        "run_ts", "malformed", "expired"
    )


def listed_runs(spark: SparkSession, path: str) -> DataFrame:
    """(calendar, run_id, files, bytes, changed) of every run below a published table.

    The names come from Spark's own listing, which deals many folders to tasks; no file is
    opened. A table that was never published has no runs.
    """
    if not folder_exists(spark, path):
        return spark.createDataFrame([], "calendar string, run_id string, files long, bytes long, changed timestamp")
    keys = [F.regexp_extract("path", f"/{k}=([^/]+)/", 1).alias(k) for k in RUN_KEYS]
    files = list_files(spark, path).select(*keys, "bytes", "changed")
    files = files.filter(" and ".join(f"{k} <> ''" for k in RUN_KEYS))
    return files.groupBy(*RUN_KEYS).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("changed").alias("changed")
    )


def published_runs(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(calendar, run) of every run, in order."""
    return [tuple(r) for r in listed_runs(spark, path).select(*RUN_KEYS).orderBy(*RUN_KEYS).collect()]


def due_runs(listed: DataFrame, as_of: Column, days: int = schema.RETENTION_DAYS) -> DataFrame:
    """The listed runs with whether each is due; a malformed run identifier never is."""
    stamp = F.try_to_timestamp("run_id", F.lit("yyyy_MM_dd_HHmmss"))
    return listed.withColumn("expired", expired(stamp, as_of, days))


def drop_expired(
    spark: SparkSession, path: str, as_of: datetime, days: int = schema.RETENTION_DAYS
) -> list[tuple[str, str]]:
    """Delete the partitions of expired runs; returns what was deleted.

    One folder per run is touched, never single files or rows.
    """
    listed = due_runs(listed_runs(spark, path), F.lit(as_of), days)
    due = listed.filter("expired").select(*RUN_KEYS).orderBy(*RUN_KEYS).collect()
    for r in due:
        delete_folder(spark, f"{path}/calendar={r['calendar']}/run_id={r['run_id']}")
    return [(r["calendar"], r["run_id"]) for r in due]
