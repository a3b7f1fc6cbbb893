"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str | int = 8, app: str = "tenurecast", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session without the setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or context.getConf().get(_CHECKPOINT_DIR)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors can reach")
        folder = os.path.join(tempfile.gettempdir(), "tenurecast")
    return f"{folder.rstrip('/')}/tenurecast-{context.applicationId}"


def checkpoint_ready(spark: SparkSession) -> None:
    """Give iterative fits a checkpoint folder if the cluster set none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


_paths: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; what is left is deleted at exit."""
    path = lasting_path(spark, label)
    _paths.append(path)
    return path


def lasting_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder that stays until the session's exit."""
    if not _paths:
        atexit.register(_release_all, spark)
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several jobs scan the same result: the table survives lost
    executors, cuts the lineage, and later scans read only the columns they use.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files when its write ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends."""
    before = len(_paths)
    try:
        yield
    finally:
        for path in _paths[before:]:
            delete_folder(spark, path)
        del _paths[before:]


def _located(spark: SparkSession, folder: str):
    """(file system, path) of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _located(spark, folder)
    files.delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _located(spark, folder)
    return files.exists(path)


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    files, path = _located(spark, folder)
    if not files.rename(path, _located(spark, to)[1]):
        raise OSError(f"cannot move {folder} to {to}")


def _release_all(spark: SparkSession) -> None:
    try:
        delete_folder(spark, shared_folder(spark))
    except Exception:  # the session may already be gone; the folder is only scratch
        pass


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    files, path = _located(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def read_text(spark: SparkSession, file: str) -> str:
    files, path = _located(spark, file)
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    files, path = _located(spark, file)
    stream = files.create(path, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
