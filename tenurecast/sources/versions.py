"""Tables replaced without a moment in which they are missing.

Every write goes to a batch folder of its own; a small numbered file then names the batches,
and of a partitioned batch the partitions, that make up the table. Readers follow the highest
number, so they see the table before or after a change and nothing between. The last
``KEEP`` versions stay readable for jobs that started on them. One writer at a time; a second
one fails instead of undoing the first.

A Parquet folder without versions is read as it is and counts as version 0.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import child_names, delete_folder, folder_exists, move_folder, read_text, write_text

VERSIONS = "_versions"
KEEP = 2


@dataclass
class Version:
    number: int
    schema: str
    keys: list[str]
    # Batch folder -> its partitions that belong to the table; None for a batch without partitions.
    batches: dict[str, list[str] | None]

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = child_names(spark, f"{path}/{VERSIONS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _load(spark: SparkSession, path: str, number: int) -> Version:
    return Version(**json.loads(read_text(spark, f"{path}/{VERSIONS}/{number:08d}.json")))


def newest(spark: SparkSession, path: str) -> Version | None:
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def _scan(spark: SparkSession, path: str, version: Version, batches: dict[str, list[str] | None]) -> DataFrame:
    """The rows of some batches; one scan per batch, only of the partitions named."""
    parts = []
    for folder, partitions in batches.items():
        base = f"{path}/{folder}"
        reader = spark.read.schema(version.fields).option("basePath", base)
        if partitions is None:
            parts.append(reader.parquet(base))
        elif partitions:
            parts.append(reader.parquet(*[f"{base}/{p}" for p in partitions]))
    if not parts:
        return spark.createDataFrame([], version.fields)
    names = version.fields.names
    return reduce(DataFrame.unionByName, [p.select(*[F.col(f"`{n}`") for n in names]) for p in parts])


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table, or the plain Parquet folder if it has none."""
    path = path.rstrip("/")
    version = newest(spark, path)
    return spark.read.parquet(path) if version is None else _scan(spark, path, version, version.batches)


def _partitions(spark: SparkSession, base: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{at}/{n}" if at else n for at in found for n in child_names(spark, f"{base}/{at}") if "=" in n]
    return sorted(found)


def _write_batch(df: DataFrame, path: str, keys: list[str]) -> tuple[str, list[str] | None]:
    spark = df.sparkSession
    folder = f"_batch-{uuid.uuid4().hex[:12]}"
    base = f"{path}/{folder}"
    writer = df.write.partitionBy(*keys) if keys else df.write
    try:
        writer.parquet(base)
    except BaseException:
        delete_folder(spark, base)
        raise
    return folder, _partitions(spark, base, len(keys)) if keys else None


def commit(spark: SparkSession, path: str, version: Version) -> None:
    """Make a version the newest; the one step that readers notice."""
    final = f"{path}/{VERSIONS}/{version.number:08d}.json"
    draft = f"{path}/{VERSIONS}/.{uuid.uuid4().hex[:12]}"
    write_text(spark, draft, json.dumps(asdict(version)))
    if folder_exists(spark, final):
        delete_folder(spark, draft)
        raise RuntimeError(f"another writer made version {version.number} of {path}")
    move_folder(spark, draft, final)


def _commit_or_undo(spark: SparkSession, path: str, version: Version, new: str) -> None:
    try:
        commit(spark, path, version)
    except BaseException:
        delete_folder(spark, f"{path}/{new}")
        raise
    clean(spark, path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table, also with rows derived from itself."""
    spark, path, keys = df.sparkSession, path.rstrip("/"), list(partition_by or [])
    number = max(_numbers(spark, path), default=0) + 1
    folder, partitions = _write_batch(df, path, keys)
    _commit_or_undo(spark, path, Version(number, df.schema.json(), keys, {folder: partitions}), folder)


def without(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that a conditional delete would leave: the condition is false or unknown."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_where(
    spark: SparkSession, path: str, condition: Column, partition_by: list[str] | None = None
) -> list[str]:
    """Delete rows; only partitions that hold one are written again, and their names returned.

    A table without versions is written whole once, partitioned by ``partition_by``.
    """
    path = path.rstrip("/")
    version = newest(spark, path)
    if version is None or not version.keys:
        overwrite(without(read_current(spark, path), condition), path, partition_by)
        return []
    kept, hit = {}, {}
    for folder, partitions in version.batches.items():
        rows = _scan_with_file(spark, path, version, folder, partitions).filter(condition)
        named = F.regexp_extract("_file", f"/{folder}/(.*)/[^/]*$", 1).alias("partition")
        touched = {unquote(r["partition"]) for r in rows.select(named).distinct().collect()}
        kept[folder] = [p for p in partitions if p not in touched]
        hit[folder] = sorted(touched)
    if not any(hit.values()):
        return []
    left = without(_scan(spark, path, version, hit), condition)
    folder, partitions = _write_batch(left, path, version.keys)
    batches = {f: p for f, p in (kept | {folder: partitions}).items() if p}
    _commit_or_undo(spark, path, Version(version.number + 1, version.schema, version.keys, batches), folder)
    return sorted({p for touched in hit.values() for p in touched})


def _scan_with_file(
    spark: SparkSession, path: str, version: Version, folder: str, partitions: list[str]
) -> DataFrame:
    base = f"{path}/{folder}"
    reader = spark.read.schema(version.fields).option("basePath", base)
    return reader.parquet(*[f"{base}/{p}" for p in partitions]).withColumn("_file", F.col("_metadata.file_path"))


def clean(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Drop what only versions older than the last ``keep`` use, also plain files of version 0."""
    numbers = _numbers(spark, path)
    used = {f for n in numbers[-keep:] for f in _load(spark, path, n).batches}
    for number in numbers[:-keep]:
        delete_folder(spark, f"{path}/{VERSIONS}/{number:08d}.json")
    if numbers[-1] < keep:
        return
    for name in child_names(spark, path):
        if name != VERSIONS and name not in used:
            delete_folder(spark, f"{path}/{name}")
