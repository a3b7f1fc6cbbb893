"""The manifest source: pushed filters, pruned files, and writes that appear whole or not at all."""

import contextlib
import io
import os

import pytest
from pyspark.sql import datasource as source
from pyspark.sql import functions as F

from tenurecast.session import new_path
from tenurecast.sources import manifest
from tenurecast.sources.manifest import read_manifest, write_manifest


@pytest.fixture(scope="module")
def table(spark):
    """Ten files of a hundred ids each, with nulls, texts that sort by code point, and NaN."""
    path = new_path(spark, "manifest")
    df = spark.range(0, 1000, 1, 10).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("é-"), F.format_string("%04d", "id"))).alias("name"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 2).alias("x"),
        F.when(F.col("id") < 100, F.col("id")).alias("rare"),
        F.array("id").alias("list"),
    )
    write_manifest(df, path)
    return path


@pytest.mark.parametrize(
    "condition",
    [
        "id = 250",
        "id >= 300 and id < 500",
        "id in (1, 999)",
        "rare is not null",
        "rare is null and id > 950",
        "name like 'é-02%'",
        "name > 'é-0899'",
        "name <= 'é-0099'",
        "x > 490",  # fractions stay with Spark: NaN counts as greatest there
        "not (id = 3)",
        "id = 5 or id = 995",
        "size(list) = 1 and id > 1000",
        "id = null",
    ],
)
def test_filters_equal_a_plain_scan(spark, table, condition):
    df = read_manifest(spark, table)
    plain = spark.createDataFrame(df.collect(), df.schema)
    got = sorted(df.filter(condition).select("id", "name").collect())
    assert got == sorted(plain.filter(condition).select("id", "name").collect())


@pytest.mark.parametrize(
    "wanted, files",
    [
        (source.EqualTo(("id",), 250), 1),
        (source.LessThan(("id",), 250), 3),
        (source.GreaterThanOrEqual(("id",), 900), 1),
        (source.In(("id",), (1, 999)), 2),
        (source.StringStartsWith(("name",), "é-01"), 1),
        (source.IsNotNull(("rare",)), 1),
        (source.IsNull(("rare",)), 9),
        (source.IsNull(("id",)), 0),
    ],
)
def test_files_are_left_out_before_tasks_start(spark, table, wanted, files):
    reader = manifest.ManifestReader(table, read_manifest(spark, table).schema)
    left = source.GreaterThan(("x",), 3.0)
    assert list(reader.pushFilters([wanted, left])) == [left]
    assert sum(len(p.names) for p in reader.partitions()) == files


def test_filter_and_columns_in_the_plan(spark, table):
    df = read_manifest(spark, table, ["id", "rare"]).filter("id > 990")
    assert df.columns == ["id", "rare"] and df.count() == 9
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    plan = out.getvalue()
    assert "PushedFilters: [GreaterThan(id,990)]" in plan and "ReadSchema: struct<id:bigint,rare:bigint>" in plan
    assert "Condition" not in plan


def test_failing_task_leaves_no_row(spark):
    path = new_path(spark, "abort")
    write_manifest(spark.range(10), path)
    bad = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id")
    )
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="broken"):
            write_manifest(bad, path, mode)
        assert read_manifest(spark, path).count() == 10
    listed = {e["name"].split("/")[1] for e in manifest.listed(path)[1]}
    assert listed <= set(os.listdir(f"{path}/data"))


def test_append_and_overwrite(spark):
    path = new_path(spark, "modes")
    df = read_manifest
    write_manifest(spark.range(5), path)
    write_manifest(spark.range(5, 8), path)
    assert sorted(r["id"] for r in df(spark, path).collect()) == list(range(8))
    write_manifest(spark.range(2), path, "overwrite")
    assert sorted(r["id"] for r in df(spark, path).collect()) == [0, 1]
    write_manifest(spark.range(0), path, "overwrite")
    assert df(spark, path).collect() == [] and df(spark, path).columns == ["id"]
    with pytest.raises(Exception, match="nothing was written"):
        df(spark, new_path(spark, "never")).collect()


def test_a_second_writer_fails(tmp_path):
    from pyspark.sql import types as T

    fields = T.StructType([T.StructField("id", T.LongType())])
    first, second = (manifest.ManifestWriter(str(tmp_path), fields, False) for _ in range(2))
    first.commit([None])
    with pytest.raises(RuntimeError, match="another writer"):
        second.commit([manifest.Written()])
