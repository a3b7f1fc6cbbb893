"""Both calendars from one scan, and the alternative forest's votes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tenurecast.operators import columns, explain, forest
from tenurecast.plans import pipeline, prep
from tenurecast.schema import CALENDAR, FISCAL, GREGORIAN, PROBABILITY, YEAR
from tenurecast.session import staged
from tenurecast.sources import standin


def test_calendar_tables_equal_single_ones_and_scan_once(spark, small, monkeypatch):
    read, plain = [], standin.table
    monkeypatch.setattr(standin, "table", lambda *a: read.append(a[2]) or plain(*a))
    tables = standin.calendar_tables(spark, small)
    assert read.count("orders") == read.count("lineitem") == 1
    assert list(tables) == ["gregorian", "fiscal"]
    for calendar in (GREGORIAN, FISCAL):
        single = standin.feature_table(spark, small, calendar)
        found = tables[calendar.name]
        assert found.columns == single.columns
        assert [f.dataType for f in found.schema] == [f.dataType for f in single.schema]
        assert found.exceptAll(single).isEmpty() and single.exceptAll(found).isEmpty()


def test_a_calendar_is_read_from_its_own_partition(spark, small):
    plan = standin.calendar_tables(spark, small)["fiscal"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar" in plan


def test_orders_without_lines_and_without_orders(spark, small, monkeypatch):
    plain = standin.table
    monkeypatch.setattr(standin, "table", lambda s, d, n: plain(s, d, n).limit(0) if n == "lineitem" else plain(s, d, n))
    rows = standin.all_calendars(spark, small)
    assert rows.filter("YEAR_PAYMENT is not null or COUNT_UNIQ_MGR_ID <> 0").isEmpty() and not rows.isEmpty()
    monkeypatch.setattr(standin, "table", lambda s, d, n: plain(s, d, n).limit(0) if n == "orders" else plain(s, d, n))
    assert standin.all_calendars(spark, small).isEmpty()


def test_one_calendar(spark):
    df = spark.createDataFrame([("fiscal", 2001, 1), ("gregorian", 2000, 2), (None, 1999, 3)], f"{CALENDAR} string, {YEAR} int, x int")
    rows = columns.one_calendar(df, FISCAL)
    assert rows.columns == [FISCAL.year, "x"] and [tuple(r) for r in rows.collect()] == [(2001, 1)]


def test_a_closed_gate_makes_no_tables(spark, tmp_path):
    control = str(tmp_path / "control")
    spark.createDataFrame([("go", "FALSE")], "NAME string, VALUE string").write.parquet(control)

    def inputs():
        raise AssertionError("made tables behind a closed gate")

    assert pipeline.run_all(spark, inputs, control, "go", str(tmp_path / "out"), datetime(2024, 1, 31)) == []


@pytest.mark.parametrize("looked_up", [explain.LOOKED_UP, 64])
def test_votes_of_trees_give_the_score(spark, small, looked_up):
    df = staged(standin.feature_table(spark, small), "features")
    state = prep.fit(df, GREGORIAN)
    rows = staged(prep.apply(df, state), "prepared")
    model = forest.fit_forest(rows, state.features, GREGORIAN, **{**forest.WIDE_FOREST, "numTrees": 5, "maxDepth": 5})
    votes = explain.tree_votes(rows, model, state.features, GREGORIAN, looked_up)
    both = votes.join(forest.score(rows, model, state.features, GREGORIAN.grain), GREGORIAN.grain)
    apart = both.filter((F.col("n_trees") != 5) | (F.abs(F.col("votes") / 5 - F.col(PROBABILITY)) > 1e-12))
    assert both.count() == df.count() and apart.isEmpty()
