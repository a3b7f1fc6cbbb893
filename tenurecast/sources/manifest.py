"""A Spark data source over Arrow files that a manifest lists, as format ``manifest``.

Writing is a two-phase commit. Tasks write files under names of their own and report them;
when all have ended, one numbered manifest names the files of the write, and only then are
they part of the table. A failed job, a failed or repeated task leaves no row visible. One
writer at a time: a commit that finds its number taken fails.

Reading takes filters from Spark: comparisons, ``IN``, null tests and string prefixes on
whole-number and string columns. They leave out files by the least and greatest values in
the manifest before any task starts, and rows while a file is read. A schema given to the
reader names the columns that are read. All other filters stay with Spark.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as source
from pyspark.sql import types as T

FORMAT = "manifest"
FILE_BYTES = 128 << 20
TASK_BYTES = 128 << 20
# Longer texts are not kept as least or greatest values.
BOUND_CHARS = 256

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def commits(files: fs.FileSystem, base: str) -> list[str]:
    """Paths of the manifests, oldest first."""
    found = files.get_file_info(fs.FileSelector(f"{base}/_commits", allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".json"))


def listed(path: str) -> tuple[T.StructType | None, list[dict]]:
    """Schema and files of a table, from its manifests; a replacing one forgets those before."""
    files, base = _located(path)
    fields, entries = None, []
    for commit in commits(files, base):
        with files.open_input_stream(commit) as stream:
            made = json.loads(stream.read())
        entries = made["files"] if made["replaces"] else entries + made["files"]
        fields = T.StructType.fromJson(made["schema"])
    return fields, entries


@dataclass
class Files(source.InputPartition):
    names: list[str]


@dataclass
class Written(source.WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class Manifest(source.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        fields, _ = listed(self.options["path"])
        if fields is None:
            raise FileNotFoundError(f"nothing was written to {self.options['path']}")
        return fields

    def reader(self, schema: T.StructType) -> ManifestReader:
        return ManifestReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options["path"], schema, overwrite)


# How a pushed filter reads on a column, and which files (least, greatest) may hold a match.
_COMPARED = {
    source.EqualTo: (lambda c, v: c == v, lambda low, high, v: low <= v <= high),
    source.GreaterThan: (lambda c, v: c > v, lambda low, high, v: high > v),
    source.GreaterThanOrEqual: (lambda c, v: c >= v, lambda low, high, v: high >= v),
    source.LessThan: (lambda c, v: c < v, lambda low, high, v: low < v),
    source.LessThanOrEqual: (lambda c, v: c <= v, lambda low, high, v: low <= v),
}


class ManifestReader(source.DataSourceReader):
    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.fields = path, schema
        self.pushed: list[source.Filter] = []

    def _takes(self, wanted: source.Filter) -> bool:
        name = getattr(wanted, "attribute", ())
        if len(name) != 1 or name[0] not in self.fields.names:
            return False
        kind = self.fields[name[0]].dataType
        if not isinstance(kind, _WHOLE) and kind != T.StringType():
            return False
        if isinstance(wanted, (source.IsNull, source.IsNotNull)):
            return True
        if isinstance(wanted, source.StringStartsWith):
            return kind == T.StringType()
        if isinstance(wanted, source.In):
            return all(v is not None for v in wanted.value)
        return type(wanted) in _COMPARED and wanted.value is not None

    def pushFilters(self, filters: list[source.Filter]) -> Iterable[source.Filter]:
        for wanted in filters:
            if self._takes(wanted):
                self.pushed.append(wanted)
            else:
                yield wanted

    def _may_match(self, entry: dict) -> bool:
        for wanted in self.pushed:
            name = wanted.attribute[0]
            nulls = entry["nulls"].get(name)
            if isinstance(wanted, source.IsNull):
                if nulls == 0:
                    return False
                continue
            if nulls == entry["rows"]:
                return False
            if name not in entry["low"]:
                continue
            low, high = entry["low"][name], entry["high"][name]
            if type(wanted) in _COMPARED:
                if not _COMPARED[type(wanted)][1](low, high, wanted.value):
                    return False
            elif isinstance(wanted, source.In):
                if not any(low <= v <= high for v in wanted.value):
                    return False
            elif isinstance(wanted, source.StringStartsWith):
                if high < wanted.value or low[: len(wanted.value)] > wanted.value:
                    return False
        return True

    def _condition(self):
        met = None
        for wanted in self.pushed:
            column = ds.field(wanted.attribute[0])
            if isinstance(wanted, source.IsNull):
                now = column.is_null()
            elif isinstance(wanted, source.IsNotNull):
                now = column.is_valid()
            elif isinstance(wanted, source.In):
                now = column.isin(list(wanted.value))
            elif isinstance(wanted, source.StringStartsWith):
                now = pc.starts_with(column, wanted.value)
            else:
                now = _COMPARED[type(wanted)][0](column, wanted.value)
            met = now if met is None else met & now
        return met

    def partitions(self) -> list[Files]:
        """Files that may match, put together to about ``TASK_BYTES`` a task."""
        tasks, size = [], 0
        for entry in listed(self.path)[1]:
            if not self._may_match(entry):
                continue
            if not tasks or size + entry["bytes"] > TASK_BYTES:
                tasks.append(Files([]))
                size = 0
            tasks[-1].names.append(entry["name"])
            size += entry["bytes"]
        return tasks or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, base = _located(self.path)
        for name in partition.names:
            table = ds.dataset(f"{base}/{name}", format="ipc", filesystem=files)
            yield from table.to_batches(columns=self.fields.names, filter=self._condition())


class _Bounds:
    """Rows, nulls, least and greatest values of one file, batch by batch."""

    def __init__(self, schema: T.StructType) -> None:
        self.rows = 0
        self.nulls = dict.fromkeys(schema.names, 0)
        self.low: dict = {}
        self.high: dict = {}
        self.open = [f.name for f in schema if isinstance(f.dataType, _WHOLE) or f.dataType == T.StringType()]

    def add(self, batch: pa.RecordBatch) -> None:
        self.rows += batch.num_rows
        for name in self.nulls:
            self.nulls[name] += batch.column(name).null_count
        for name in self.open:
            least, most = pc.min_max(batch.column(name)).as_py().values()
            if least is not None:
                self.low[name] = min(least, self.low.get(name, least))
                self.high[name] = max(most, self.high.get(name, most))

    def entry(self, name: str, size: int) -> dict:
        kept = [n for n in self.low if not isinstance(self.low[n], str) or max(len(self.low[n]), len(self.high[n])) <= BOUND_CHARS]
        return {
            "name": name, "rows": self.rows, "bytes": size, "nulls": self.nulls,
            "low": {n: self.low[n] for n in kept}, "high": {n: self.high[n] for n in kept},
        }


class ManifestWriter(source.DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool) -> None:
        self.path, self.fields, self.replaces = path, schema, overwrite
        files, base = _located(path)
        self.number = len(commits(files, base)) + 1

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One or more files of about ``FILE_BYTES``; none for a task without rows."""
        files, base = _located(self.path)
        files.create_dir(f"{base}/data", recursive=True)
        done = Written()
        sink = writer = bounds = name = None

        def close() -> None:
            writer.close()
            size = sink.tell()
            sink.close()
            done.files.append(bounds.entry(name, size))

        for batch in iterator:
            if batch.num_rows == 0:
                continue
            if writer is None:
                name, bounds = f"data/{uuid.uuid4().hex}.arrow", _Bounds(self.fields)
                sink = files.open_output_stream(f"{base}/{name}")
                writer = pa.ipc.new_file(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            writer.write_batch(batch)
            bounds.add(batch)
            if sink.tell() >= FILE_BYTES:
                close()
                writer = None
        if writer is not None:
            close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        files, base = _located(self.path)
        made = {
            "replaces": self.replaces,
            "schema": self.fields.jsonValue(),
            "files": [f for m in messages if m is not None for f in m.files],
        }
        final = f"{base}/_commits/{self.number:08d}.json"
        files.create_dir(f"{base}/_commits", recursive=True)
        if len(commits(files, base)) >= self.number:
            raise RuntimeError(f"another writer made commit {self.number} of {self.path}")
        draft = f"{base}/_commits/.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as stream:
            stream.write(json.dumps(made).encode())
        files.move(draft, final)

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what ended tasks reported; files of tasks that never ended stay unlisted."""
        files, base = _located(self.path)
        for message in messages:
            for entry in message.files if message is not None else ():
                files.delete_file(f"{base}/{entry['name']}")


def ready(spark: SparkSession) -> None:
    """Make the format known to a session, and let Spark push filters into it."""
    spark.dataSource.register(Manifest)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_manifest(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A table of this format, or only some of its columns."""
    ready(spark)
    reader = spark.read.format(FORMAT)
    if columns is not None:
        fields = listed(path)[0]
        reader = reader.schema(T.StructType([fields[c] for c in columns]))
    return reader.load(path)


def write_manifest(df: DataFrame, path: str, mode: str = "append") -> None:
    ready(df.sparkSession)
    df.write.format(FORMAT).mode(mode).save(path)
