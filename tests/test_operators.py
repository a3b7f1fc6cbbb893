import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenurecast import schema
from tenurecast.functions.jitter import hash_fraction, row_text, with_jitter
from tenurecast.operators import categories, cohort, columns, metrics, outliers, profile, scaling, scan, split
from tenurecast.schema import FISCAL, GREGORIAN


def test_lookup_sizes():
    assert len(schema.TITLE_LOOKUP) == 23 and len(schema.TITLE_GROUPS) == 5
    assert len(schema.INDUSTRY_LOOKUP) == 17 and len(schema.INDUSTRY_GROUPS) == 7


def test_nan_and_null_are_both_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "YEAR_PAYMENT double")
    found = profile.collect_profile(columns.cast_by_name(df), ["YEAR_PAYMENT"], ["YEAR_PAYMENT"])
    stats = found["YEAR_PAYMENT"]
    assert (stats.rows, stats.present, stats.mean, stats.deviation) == (4, 2, 2.0, 1.0)


def test_cast_types(spark):
    df = spark.createDataFrame(
        [("7", "x", "1.5", "nan"), ("8", "y", "oops", "2")],
        "MASTER_PARTICIPANT_ID string, INDUSTRY string, YEAR_PAYMENT string, SALARY_USD string",
    )
    cast = columns.cast_by_name(df, strict=False)
    assert [f.dataType.simpleString() for f in cast.schema] == ["bigint", "string", "double", "double"]
    assert [tuple(r) for r in cast.collect()] == [(7, "x", 1.5, None), (8, "y", None, 2.0)]


def test_double_keys_truncate(spark):
    df = spark.createDataFrame([(7.9,)], "BUSINESS_ID double")
    assert columns.cast_by_name(df).first()[0] == 7


def test_exactly_half_full_is_kept(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (None, None), (None, None)], "a double, b double")
    stats = profile.collect_profile(df, ["a", "b"], [])
    assert profile.sparse_columns(stats) == ["b"]


def test_unmapped_category_gives_all_zero(spark):
    df = spark.createDataFrame(
        [("SALES_DIRECTOR", "Energy"), ("INTERN", None)], "TITLE_CATEGORY_YR_END string, INDUSTRY string"
    )
    mapped = categories.consolidate(df)
    assert [tuple(r) for r in mapped.collect()] == [("DIRECTOR", "Government/Public Sector"), (None, None)]
    levels = profile.collect_levels(mapped, mapped.columns)
    shaped = categories.one_hot(mapped, levels)
    assert [sum(r) for r in shaped.collect()] == [2, 0]


def test_absent_and_new_levels(spark):
    levels = {"OWNERSHIP": ["Private", "Public"]}
    df = spark.createDataFrame([("Public",), ("State",)], "OWNERSHIP string")
    rows = categories.one_hot(df, levels).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (0, 0)]
    wider = categories.add_absent(df, ["INDUSTRY_SaaS & Cloud"])
    assert [r["INDUSTRY_SaaS & Cloud"] for r in wider.collect()] == [0, 0]


def test_conditional_layout():
    titles = [schema.indicator("TITLE_CATEGORY_YR_END", t) for t in schema.FIXED_TITLES]
    both = ["OWNERSHIP_Public", "OWNERSHIP_Private"]
    assert categories.conditional_indicators(titles) == both + titles
    assert categories.conditional_indicators(titles[1:]) == both
    assert categories.conditional_indicators(["INDUSTRY_SaaS & Cloud"]) == [*both, "INDUSTRY_SaaS & Cloud"]


def test_too_many_levels(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("OWNERSHIP"))
    with pytest.raises(ValueError, match="levels"):
        profile.collect_levels(df, ["OWNERSHIP"], most=10)


def test_level_counts_skip_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "OWNERSHIP string")
    assert profile.level_counts(df, ["OWNERSHIP"]).first()["n_levels"] == 2


def test_lookup_join_and_map_agree(spark):
    df = spark.createDataFrame([("Software",), ("Other",), ("?",), (None,)], "INDUSTRY string")
    joined = categories.lookup_join(df, "INDUSTRY", schema.INDUSTRY_LOOKUP, "new")
    direct = df.withColumn("new", categories.mapped("INDUSTRY", schema.INDUSTRY_LOOKUP))
    assert sorted(map(str, joined.collect())) == sorted(map(str, direct.collect()))


def brute_outliers(x):
    with np.errstate(invalid="ignore"):
        high, low = np.nanpercentile(x, [75, 25])
        mean, deviation = np.nanmean(x), np.nanstd(x)
        x = np.where(x >= mean + 3 * deviation, high, x)
        return np.where(x <= mean - 3 * deviation, low, x)


def test_outliers_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=500)
    x[:6] = [50, -50, np.nan, np.nan, 40, -60]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id long, v double")
    df = df.withColumn("v", columns.nan_to_null(F.col("v")))
    got = outliers.replace_outliers(df, outliers.fit_fences(df, ["v"])).orderBy("id").toPandas()["v"]
    assert np.allclose(got.to_numpy(), brute_outliers(x), equal_nan=True)


def test_outlier_edges(spark):
    # Constant: every value is at the fence; both quartiles equal it, so nothing changes.
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert {r["v"] for r in outliers.replace_outliers(df, outliers.fit_fences(df, ["v"])).collect()} == {5.0}
    # Exactly mean + 3 deviations is replaced.
    at_fence = [10.0] + [0.0] * 9
    df = spark.createDataFrame([(v,) for v in at_fence], "v double")
    got = outliers.replace_outliers(df, outliers.fit_fences(df, ["v"]))
    assert {r["v"] for r in got.collect()} == {0.0}


def test_scales_equal_filled_statistics(spark):
    x = [1.0, 2.0, None, 7.0, None, 4.0]
    df = spark.createDataFrame([(v, 3.0) for v in x], "a double, b double")
    scales = scaling.fit_scales(df, ["a", "b"])
    filled = np.array([3.5 if v is None else v for v in x])
    assert math.isclose(scales["a"].deviation, filled.std())
    out = scaling.standardize(scaling.fill_with_mean(df, scales), scales).toPandas()
    assert np.allclose(out["a"], (filled - filled.mean()) / filled.std())
    assert set(out["b"]) == {0.0}


def test_empty_column_is_an_error(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    with pytest.raises(ValueError, match="a"):
        scaling.fit_scales(df, ["a"])


def test_rounding_is_half_to_even(spark):
    x = [0.0005, 0.0015, 2.0005, -1.2345, 7.0]
    df = spark.createDataFrame([(v,) for v in x], "a double")
    got = [r["a"] for r in columns.round_features(df, ["a"]).collect()]
    assert got == list(np.round(np.array(x), 3))


@pytest.mark.parametrize("rows", [1, 2, 3, 100, 301])
def test_exact_split_size(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("k"))
    marked = df.withColumn("is_test", split.exact_test(df, ["k"]))
    chosen = {r["k"] for r in marked.filter("is_test").collect()}
    order = sorted(range(rows), key=lambda k: (hashlib.md5(f"{k}|42".encode()).hexdigest(), k))
    assert chosen == set(order[: math.ceil(rows / 3)])


def test_exact_split_with_shared_leading_digits(spark, monkeypatch):
    monkeypatch.setattr(split, "_DIGITS", 1)
    df = spark.range(200).select(F.col("id").alias("k"))
    marked = df.withColumn("is_test", split.exact_test(df, ["k"]))
    chosen = {r["k"] for r in marked.filter("is_test").collect()}
    order = sorted(range(200), key=lambda k: (hashlib.md5(f"{k}|42".encode()).hexdigest(), k))
    assert chosen == set(order[:67])


def brute_cohort(rows):
    labels, years = {}, {}
    for b, y, label in rows:
        labels.setdefault(b, set()).add(label)
        years.setdefault((b, y), []).append(label)
    bad = {b for (b, _), found in years.items() if min(found) > 0}
    one = [r for r in rows if len(labels[r[0]]) >= 2]
    return one, [r for r in one if r[0] not in bad]


def test_cohorts_against_brute_force(spark):
    rng = np.random.default_rng(3)
    # Business 0 holds a third of the rows.
    rows = [
        (0 if rng.random() < 0.33 else int(rng.integers(1, 40)), int(rng.integers(2000, 2004)),
         int(rng.random() < 0.3))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "BUSINESS_ID long, CAL_YEAR int, TERM_NEXT_YEAR int")
    one, two = brute_cohort(rows)
    assert sorted(map(tuple, cohort.with_both_labels(df).collect())) == sorted(one)
    assert sorted(map(tuple, cohort.teaching_cohort(df, GREGORIAN).collect())) == sorted(two)
    emptied = {b for b, y, _ in rows if min(r[2] for r in rows if r[:2] == (b, y)) > 0}
    left = cohort.without_empty_years(df, GREGORIAN)
    assert sorted(map(tuple, left.collect())) == sorted(r for r in rows if r[0] not in emptied)
    counts = {tuple(r)[:3]: r["n"] for r in cohort.label_counts(df, ["BUSINESS_ID", "CAL_YEAR"]).collect()}
    assert sum(counts.values()) == len(rows)


def test_cohort_edges(spark):
    """Missing businesses, labels and years follow the group-by rules for missing keys."""
    rows = [(None, 2000, 1), (1, 2000, 0), (1, None, 1), (2, 2000, 0), (2, 2001, None), (3, 2000, 1), (3, 2001, 0)]
    df = spark.createDataFrame(rows, "BUSINESS_ID long, CAL_YEAR int, TERM_NEXT_YEAR int")
    assert {r[0] for r in cohort.with_both_labels(df).collect()} == {1, 3}
    assert {r[0] for r in cohort.without_empty_years(df, GREGORIAN).collect()} == {None, 1, 2}
    assert {r[0] for r in cohort.teaching_cohort(df, GREGORIAN).collect()} == {1}
    assert cohort.teaching_cohort(df.limit(0), GREGORIAN).isEmpty()


def test_hot_business_is_not_shuffled(spark):
    """Without automatic broadcasts, only rows of ordinary businesses reach a shuffle."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 300).alias("BUSINESS_ID"),
        (F.col("id") % 4).cast("int").alias("CAL_YEAR"),
        (F.rand(1) < 0.4).cast("int").alias("TERM_NEXT_YEAR"),
    ).persist()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = cohort.with_both_labels(df)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
        labels = {}
        for b, _, label in map(tuple, df.collect()):
            labels.setdefault(b, set()).add(label)
        wanted = sum(1 for r in df.collect() if len(labels[r[0]]) > 1)
        assert kept.count() == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_grain_check(spark):
    df = spark.createDataFrame([(1, 2, 2000), (1, 2, 2000)], "BUSINESS_ID long, MASTER_PARTICIPANT_ID long, FISCAL_YEAR int")
    with pytest.raises(ValueError, match="more than one row"):
        columns.check_grain(df, FISCAL)


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_auc_against_brute_force(spark, ranges):
    rng = np.random.default_rng(11)
    labels = rng.integers(0, 2, 300)
    scores = np.where(rng.random(300) < 0.34, 0.5, np.round(rng.random(300) * 0.7 + labels * 0.3, 2))
    df = spark.createDataFrame(list(zip(scores.tolist(), labels.tolist())), "s double, y int")
    found = metrics.auc(df, "s", "y", ranges).first()
    assert math.isclose(found["auc"], brute_auc(scores, labels), rel_tol=1e-12)


def test_auc_agrees_with_the_library(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(500).select(F.rand(1).alias("s"), (F.rand(2) < 0.4).cast("double").alias("y"))
    df = df.persist()
    library = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert math.isclose(metrics.auc(df, "s", "y").first()["auc"], library, rel_tol=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert metrics.auc(df, "s", "y").first()["auc"] is None


def test_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "p int, y int")
    assert metrics.accuracy(df, "p", "y").first()["accuracy"] == 0.75


def test_hash_fraction_equals_big_integer(spark):
    texts = ["", "a", "1.000000|NULL|x", "ü|2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(hash_fraction(F.col("t"))).collect()]
    want = [int(hashlib.sha256(t.encode()).hexdigest(), 16) % 10**8 / 10**8 / 100 for t in texts]
    assert np.allclose(got, want, rtol=1e-15, atol=1e-18)


def test_jitter_bounds_and_keys(spark):
    df = spark.createDataFrame([(1, 0.9999, 2.0), (2, 0.9999, 2.0), (3, 0.1, None)], "k long, p double, x double")
    plain = [r["p"] for r in with_jitter(df, "p", ["x"]).orderBy("k").collect()]
    assert plain[0] == plain[1] and 0.9999 < max(plain) < 1.0099 and 0.1 <= plain[2] < 0.11
    keyed = [r["p"] for r in with_jitter(df.withColumn("p", F.lit(0.5)), "p", ["x"], ["k"]).collect()]
    assert len(set(keyed)) == 3
    texts = [r[0] for r in df.select(row_text(df, ["k", "x"])).collect()]
    assert texts == ["1|2.000000", "2|2.000000", "3|NULL"]


@pytest.mark.parametrize("ranges", [1, 3, None])
def test_prefix_sums_equal_brute_force(spark, ranges):
    """Ties, nulls and a key that a third of the rows share."""
    random = np.random.default_rng(8)
    rows = [(None if k == 0 else 5 if k % 3 == 0 else int(k), None if v == 0 else int(v)) for k, v in random.integers(0, 40, (300, 2))]
    df = spark.createDataFrame(rows, "k long, v long").repartition(4)
    found = scan.prefix_sums(df, "k", {"v": "below"}, ranges).collect()
    assert len(found) == len(rows)
    for r in found:
        smaller = [v or 0 for k, v in rows if r.k is not None and (k is None or k < r.k)]
        assert r.below == sum(smaller)


def test_prefix_sums_have_no_global_window(spark):
    df = spark.range(1000).withColumn("v", F.lit(1))
    text = scan.prefix_sums(df, "id", {"v": "below"})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "percentile" not in text
