"""Readers for the employee-year table, the control table and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import target_type
from ..schema import quoted

def read_table(
    spark: SparkSession,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    table: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Any Spark data source; options and table names are the caller's configuration.

    Connectors that take ``dbtable`` get the table name; file formats get a path.
    Nothing is pulled to the driver, so later filters and selections reach the
    source.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if path is not None:
        return reader.load(path)
    return reader.option("dbtable", table).load()


def control_value(control: DataFrame, name: str) -> DataFrame:
    """The control row of one name; the filter is pushed to the source."""
    return control.filter(F.col("NAME") == name).select("NAME", "VALUE")


def feature_schema(columns: list[str]) -> T.StructType:
    """Explicit schema of a delimited feature file."""
    return T.StructType.fromDDL(", ".join(f"{quoted(c)} {target_type(c)}" for c in columns))


def read_delimited(
    spark: SparkSession,
    path: str,
    fields: T.StructType,
    sep: str = "\t",
    null: str = "",
) -> DataFrame:
    """Text with a header line, read with an explicit schema."""
    return spark.read.schema(fields).csv(
        path, sep=sep, header=True, nullValue=null, enforceSchema=False
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name, change time and size of the files below a folder, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("modificationTime").alias("changed"),
        F.col("length").alias("bytes"),
    )
