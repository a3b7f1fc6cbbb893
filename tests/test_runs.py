from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tenurecast.functions.stamps import parse_stamp, run_file, run_id
from tenurecast.plans import runs
from tenurecast.session import child_names, new_path
from tenurecast.sources import readers, versions, writers
from tenurecast.sources.versions import read_current


@pytest.mark.parametrize(
    "name, stamp",
    [
        ("part_gregorian_pred_2024_01_31_10:15:59.tsv", "2024-01-31 10:15"),
        ("part_fiscal_pred_2024_01_31_101559", "2024-01-31 10:15"),
        ("log_file_fiscal_2024_1_3_10:15:00.tsv", "2024-01-03 10:15"),
        ("part_visual_fiscal_2024_01_31_00:00:00.tsv", "2024-01-31 00:00"),
        ("part_fiscal_pred_2024_13_31_101559", None),
        ("part_2024_01_31", None),
        ("_SUCCESS", None),
        ("", None),
    ],
)
def test_stamps(spark, name, stamp):
    df = spark.createDataFrame([(name,)], "n string")
    got = df.select(F.date_format(parse_stamp(F.col("n")), "yyyy-MM-dd HH:mm")).first()[0]
    assert got == stamp


def test_run_names_round_trip(spark):
    moment = F.lit(datetime(2024, 2, 3, 4, 5, 6))
    run = spark.range(1).select(run_id(moment)).first()[0]
    assert run == "2024_02_03_040506"
    names = [run_file(k, "fiscal", run) for k in ("predictions", "explanations", "log")]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0] for r in df.select(parse_stamp(F.col("n"))).collect()} == {datetime(2024, 2, 3, 4, 5)}


def test_retention_is_inclusive_and_keeps_malformed(spark):
    names = [
        "part_fiscal_pred_2024_01_17_00:00:00.tsv",  # exactly 14 days
        "part_fiscal_pred_2024_01_17_00:01:00.tsv",
        "part_fiscal_pred_2023_01_17_00:01:00.tsv",
        "notes.txt",
    ]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    marked = runs.marked_runs(df, F.lit(datetime(2024, 1, 31))).collect()
    assert [r["expired"] for r in marked] == [True, False, True, False]
    assert [r["malformed"] for r in marked] == [False, False, False, True]
    left = runs.retained(df, F.lit(datetime(2024, 1, 31)))
    assert [r["name"] for r in left.collect()] == [names[1], names[3]]


@pytest.mark.parametrize(
    "rows, options, run",
    [
        ([("flag", "TRUE"), ("other", "FALSE")], {}, True),
        ([("flag", "FALSE"), ("other", "TRUE")], {}, False),
        ([("other", "TRUE")], {}, False),
        ([], {}, False),
        ([("flag", "FALSE")], {"remote": True}, True),
        ([], {"test_mode": True}, True),
    ],
)
def test_gate(spark, rows, options, run):
    control = spark.createDataFrame(rows, "NAME string, VALUE string")
    assert runs.should_run(control, "flag", **options) is run


def test_upsert_and_delete(spark):
    path = new_path(spark, "control")
    rows = [("a", "TRUE"), ("b", "TRUE"), ("c", None)]
    spark.createDataFrame(rows, "NAME string, VALUE string").write.parquet(path)
    updates = spark.createDataFrame([("b", "FALSE"), ("d", "TRUE")], "NAME string, VALUE string")
    writers.overwrite(writers.upsert(read_current(spark, path), updates, "NAME"), path)
    found = {tuple(r) for r in read_current(spark, path).collect()}
    assert found == {("a", "TRUE"), ("b", "FALSE"), ("c", None), ("d", "TRUE")}
    writers.delete_where(spark, path, F.col("VALUE") == "TRUE")
    # NULL does not match the condition, so its row stays.
    assert {tuple(r) for r in read_current(spark, path).collect()} == {("b", "FALSE"), ("c", None)}
    writers.delete_where(spark, path, F.col("NAME") == "b")
    assert readers.control_value(read_current(spark, path), "b").count() == 0
    # Two versions are kept, and nothing of the plain table or older ones.
    assert len(child_names(spark, f"{path}/{versions.VERSIONS}")) == 2
    assert all(n.startswith("_") for n in child_names(spark, path)) and len(child_names(spark, path)) == 3


def test_a_broken_write_leaves_the_old_table(spark, monkeypatch):
    path = new_path(spark, "broken")
    spark.range(3).write.parquet(path)
    fails = F.raise_error(F.lit("broken")).cast("long").alias("id")
    with pytest.raises(Exception, match="broken"):
        versions.overwrite(read_current(spark, path).select(fails), path)
    assert read_current(spark, path).count() == 3
    versions.overwrite(spark.range(4), path)
    between = []

    def broken_move(spark_, draft, final):
        # The new rows are written whole, but not yet named: readers still see the old table.
        between.append(read_current(spark_, path).count())
        raise OSError("broken")

    monkeypatch.setattr(versions, "move_folder", broken_move)
    with pytest.raises(OSError, match="broken"):
        versions.overwrite(spark.range(5), path)
    assert between == [4] and read_current(spark, path).count() == 4


def test_readers_between_the_steps_of_a_delete(spark, monkeypatch):
    path = new_path(spark, "steps")
    rows = [(1, "x"), (2, "x"), (3, "y z/%"), (4, None)]
    versions.overwrite(spark.createDataFrame(rows, "id long, kind string"), path, ["kind"])
    early = read_current(spark, path)
    seen, real = [], versions.commit

    def watched(spark_, path_, version):
        seen.append(sorted(r["id"] for r in read_current(spark_, path_).collect()))
        real(spark_, path_, version)
        seen.append(sorted(r["id"] for r in read_current(spark_, path_).collect()))

    monkeypatch.setattr(versions, "commit", watched)
    before = versions.newest(spark, path).batches
    assert versions.delete_where(spark, path, F.col("id").isin(1, 3)) == ["kind=x", "kind=y z%2F%25"]
    assert seen == [[1, 2, 3, 4], [2, 4]]
    # The partition without a match is still that of the first batch; its files are not written again.
    (folder,) = before
    assert versions.newest(spark, path).batches[folder] == ["kind=__HIVE_DEFAULT_PARTITION__"]
    # A job that began on the old version ends on it.
    assert sorted(r["id"] for r in early.collect()) == [1, 2, 3, 4]
    assert versions.delete_where(spark, path, F.col("id") == 9) == []
    assert versions.delete_where(spark, path, F.lit(True)) != []
    assert read_current(spark, path).collect() == [] and read_current(spark, path).columns == ["id", "kind"]


def test_a_second_writer_fails(spark, monkeypatch):
    path = new_path(spark, "race")
    versions.overwrite(spark.range(1), path)
    stale = versions._numbers(spark, path)
    versions.overwrite(spark.range(2), path)
    monkeypatch.setattr(versions, "_numbers", lambda *_: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.overwrite(spark.range(3), path)
    monkeypatch.undo()
    assert read_current(spark, path).count() == 2


def test_runs_are_replaced_and_dropped(spark):
    path = new_path(spark, "published")
    df = spark.createDataFrame([(1, 0.5)], "k long, p double")
    for run in ("2024_01_01_000000", "2024_01_30_000000", "2024_01_30_000000"):
        writers.write_run(df, path, "fiscal", run)
    assert spark.read.parquet(path).count() == 2
    assert runs.drop_expired(spark, path, datetime(2024, 1, 31)) == [("fiscal", "2024_01_01_000000")]
    assert runs.published_runs(spark, path) == [("fiscal", "2024_01_30_000000")]
    assert runs.published_runs(spark, f"{path}-absent") == []


def test_log_and_listing(spark):
    path = new_path(spark, "log")
    log = runs.RunLog("fiscal", "2024_01_01_000000")
    log.add("load", "rows loaded", "rows", 3)
    log.add("end", "done")
    log.save(spark, path)
    log.save(spark, path)
    rows = spark.read.parquet(path).orderBy("seq").collect()
    assert [(r["seq"], r["metric"], r["value"]) for r in rows] == [(0, "rows", 3.0), (1, None, None)]
    names = [r["name"] for r in readers.list_files(spark, path).collect()]
    assert any(n.endswith(".parquet") for n in names)


def test_delimited_round_trip(spark):
    path = new_path(spark, "tsv")
    df = spark.createDataFrame(
        [(1, "a\tb", 0.1), (2, "", None), (3, None, 1e10)],
        "MASTER_PARTICIPANT_ID long, INDUSTRY string, YEAR_PAYMENT double",
    )
    writers.write_delimited(df, path)
    back = readers.read_delimited(spark, path, readers.feature_schema(df.columns))
    rows = sorted(map(tuple, back.collect()))
    assert [r[0] for r in rows] == [1, 2, 3] and [r[2] for r in rows] == [0.1, None, 1e10]
    assert rows[0][1] == "a\tb" and rows[2][1] is None


def test_connector_writer(spark, tmp_path):
    """Any source and sink is reached by format name and options."""
    df = spark.createDataFrame([(1,)], "k long")
    df.write.format("json").save(str(tmp_path / "t"))
    assert readers.read_table(spark, "json", {}, path=str(tmp_path / "t")).count() == 1


def test_runs_are_listed_from_their_files(spark):
    """Counts and sizes per run; marker files, other folders and missing tables are no runs."""
    path = new_path(spark, "runs")
    rows = [(1, "fiscal", "2024_01_01_000000"), (2, "fiscal", "2024_01_30_000000"), (3, "gregorian", "notes")]
    spark.createDataFrame(rows, "k long, calendar string, run_id string").write.partitionBy("calendar", "run_id").parquet(path)
    listed = runs.listed_runs(spark, path)
    assert sorted((r["calendar"], r["run_id"], r["files"]) for r in listed.collect()) == [(c, r, 1) for _, c, r in rows]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    marked = runs.due_runs(listed, F.lit(datetime(2024, 1, 31)))
    assert sorted((r["run_id"], r["expired"]) for r in marked.collect()) == [
        ("2024_01_01_000000", True), ("2024_01_30_000000", False), ("notes", False),
    ]
    assert runs.listed_runs(spark, new_path(spark, "never")).collect() == []
    assert runs.drop_expired(spark, new_path(spark, "never"), datetime(2024, 1, 31)) == []


def test_measures_need_no_job_of_their_own(spark):
    """The write takes them; an empty table has measures too."""
    df = spark.createDataFrame([(1, 0.25), (2, None), (3, 0.75)], "k long, PRED_TERM_PROB double")

    def jobs(group, action):
        spark.sparkContext.setJobGroup(group, group)
        try:
            action()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    rows, seen = runs.watched(df, *runs.score_measures())
    plain = jobs("plain", lambda: writers.write_run(df, new_path(spark, "plain"), "fiscal", "r"))

    def measured():
        writers.write_run(rows, new_path(spark, "watched"), "fiscal", "r")
        assert seen.get == {"rows": 3, "unscored": 1, "least": 0.25, "greatest": 0.75}

    assert jobs("watched", measured) == plain
    empty, seen = runs.watched(df.limit(0), *runs.score_measures())
    writers.write_run(empty, new_path(spark, "empty"), "fiscal", "r")
    assert seen.get == {"rows": 0, "unscored": 0, "least": None, "greatest": None}
    log = runs.RunLog("fiscal", "r")
    log.add_measures("publish", "predictions", seen)
    assert [(r[4], r[5]) for r in log.rows][:1] == [("predictions_rows", 0.0)] and log.rows[2][5] is None
