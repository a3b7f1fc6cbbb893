from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenurecast import schema
from tenurecast.operators import explain, forest, impute
from tenurecast.plans import pipeline, prep
from tenurecast.schema import EXPECTED, FISCAL, GREGORIAN, LABEL, PROBABILITY
from tenurecast.session import new_path, staged
from tenurecast.sources.versions import read_current
from tenurecast.sources import writers
from tenurecast.sources.standin import feature_table

QUICK = {"numTrees": 5, "maxDepth": 8}


@pytest.fixture(scope="module")
def state(features):
    return prep.fit(features, GREGORIAN)


@pytest.fixture(scope="module")
def rows(features, state):
    return staged(prep.apply(features, state), "prepared")


@pytest.fixture(scope="module")
def model(rows, state):
    return forest.fit_forest(rows, state.features, GREGORIAN, **QUICK)


def test_state_round_trip(spark, state, features):
    path = new_path(spark, "state")
    state.save(spark, path)
    again = prep.PrepState.load(spark, path)
    assert again.features == state.features and again.levels == state.levels
    assert again.fences == state.fences and again.scales == state.scales
    assert prep.apply(features, again).exceptAll(prep.apply(features, state)).isEmpty()


@pytest.mark.parametrize("layout, count", [("learned", 14), ("conditional", 8), ("fixed", 13)])
def test_layouts_round_trip(spark, features, layout, count):
    state = prep.fit(features, GREGORIAN, layout=layout)
    assert len(state.indicators) == count
    path = new_path(spark, "state")
    state.save(spark, path)
    assert prep.PrepState.load(spark, path).indicators == state.indicators
    assert prep.apply(features, state).count() == features.count()


def test_sparse_feature_is_named(features):
    with pytest.raises(ValueError, match=schema.PAYEE_COUNT):
        prep.fit(features, GREGORIAN, [*schema.NUMERIC_FEATURES, schema.PAYEE_COUNT])


def test_sparse_category_leaves_the_other_consolidated(features):
    thin = features.withColumn("TITLE_CATEGORY_YR_END", F.lit(None).cast("string"))
    state = prep.fit(thin, GREGORIAN)
    assert "TITLE_CATEGORY_YR_END" in state.dropped
    assert set(state.levels["INDUSTRY"]) <= set(schema.INDUSTRY_GROUPS)
    industry = [c for c in state.indicators if c.startswith("INDUSTRY_")]
    got = prep.apply(thin, state).agg(*[F.sum(schema.quoted(c)) for c in industry]).first()
    assert min(got) > 0


def test_missing_column_is_named(features, state):
    with pytest.raises(ValueError, match="YEAR_PAYMENT"):
        prep.apply(features.drop("YEAR_PAYMENT"), state)


def test_scoring_input_without_label_and_with_new_levels(features, state):
    changed = features.drop(LABEL, "TERM_AS_OF_DATE").withColumn("INDUSTRY", F.lit("Mining"))
    out = prep.apply(changed, state)
    assert LABEL not in out.columns
    industry = [c for c in out.columns if c.startswith("INDUSTRY_")]
    assert out.agg(*[F.max(schema.quoted(c)) for c in industry]).first()[0] == 0


def test_forest_is_repeatable(rows, state, model):
    again = forest.fit_forest(rows.repartition(3), state.features, GREGORIAN, **QUICK)
    assert again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


def test_memory_of_a_pass_is_bounded_and_changes_no_tree(rows, state, model):
    for settings in (forest.FOREST, forest.WIDE_FOREST, forest.TREE):
        assert settings["maxMemoryInMB"] <= 64  # in each of four tasks beside each other
    for most in (1, 1024):
        other = forest.fit_forest(rows, state.features, GREGORIAN, **QUICK, maxMemoryInMB=most)
        assert other.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


def test_training_rows_are_chosen_by_key(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    assert forest.training_rows(df, ["k"]).count() == 4000
    some = forest.training_rows(df, ["k"], 1000)
    assert 800 < some.count() < 1200
    again = forest.training_rows(df.repartition(7), ["k"], 1000)
    assert {r["k"] for r in some.collect()} == {r["k"] for r in again.collect()}


def test_every_key_is_scored_once(rows, state, model):
    scored = forest.score(rows, model, state.features, GREGORIAN.grain)
    assert scored.count() == rows.count() == scored.select(*GREGORIAN.grain).distinct().count()
    low, high = scored.agg(F.min(PROBABILITY), F.max(PROBABILITY)).first()
    assert 0.0 <= low <= high <= 1.0


def brute_paths(model, values):
    """Contributions by walking the library's own node objects."""
    credit, base = np.zeros(len(values)), 0.0
    for tree in model.trees:
        node = tree._call_java("rootNode")

        def share(n):
            stats = list(n.impurityStats().stats())
            return stats[1] / sum(stats)

        base += share(node)
        while node.subtreeDepth() > 0:
            split = node.split()
            child = node.leftChild() if values[split.featureIndex()] <= split.threshold() else node.rightChild()
            credit[split.featureIndex()] += share(child) - share(node)
            node = child
    count = len(model.trees)
    return base / count, credit / count


@pytest.mark.parametrize("looked_up", [explain.LOOKED_UP, 60])
def test_contributions(rows, state, model, looked_up):
    found = explain.contributions(rows, model, state.features, GREGORIAN, looked_up=looked_up)
    frame = found.toPandas()
    total = frame[state.features].sum(axis=1) + frame[EXPECTED]
    assert np.allclose(total, frame[PROBABILITY], atol=1e-12)
    keys = GREGORIAN.grain
    inputs = rows.toPandas().set_index(keys)
    for _, r in frame.head(15).iterrows():
        values = inputs.loc[tuple(int(r[k]) for k in keys), state.features].to_numpy(dtype=float)
        base, credit = brute_paths(model, values)
        assert np.isclose(base, r[EXPECTED])
        assert np.allclose(credit, r[state.features].to_numpy(dtype=float), atol=1e-12)


def test_score_only_layout_hides_the_payee_count(features):
    """With enough payee counts, their contribution is reported under OTHER."""
    filled = features.withColumn(
        schema.PAYEE_COUNT, F.coalesce(schema.PAYEE_COUNT, F.col("YEAR_PAYMENT") / 7)
    )
    numeric = prep.score_only_features(GREGORIAN)
    assert schema.PAYEE_COUNT in numeric and schema.PAYEE_COUNT not in prep.score_only_features(FISCAL)
    state = prep.fit(filled, GREGORIAN, numeric, layout="fixed")
    rows = staged(prep.apply(filled, state), "prepared")
    model = forest.fit_forest(rows, state.features, GREGORIAN, **QUICK)
    trained = pipeline.Trained(state, model, {})
    frame = pipeline.explain_rows(filled, trained).toPandas()
    parts = [c for c in frame.columns if c not in (*GREGORIAN.grain, PROBABILITY)]
    assert explain.OTHER in parts and schema.PAYEE_COUNT not in parts
    assert not [c for c in parts if c in state.indicators]
    assert np.allclose(frame[parts].sum(axis=1), frame[PROBABILITY], atol=1e-12)


def test_wide_forest_settings(rows, state):
    small = {**forest.WIDE_FOREST, "numTrees": 6, "maxDepth": 6}
    model = forest.fit_forest(rows, state.features, GREGORIAN, **small)
    assert model.getNumTrees == 6 and model.getFeatureSubsetStrategy() == "log2"


def test_fit_does_not_depend_on_cluster_settings(spark, rows, state):
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    models = []
    try:
        for n in ("4", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            models.append(forest.fit_tree(rows, state.features, GREGORIAN, maxDepth=6).toDebugString)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert models[0].split("\n", 1)[1] == models[1].split("\n", 1)[1]


def test_published_explanations_add_up(rows, state, model):
    table = explain.explain(rows, model, state.features, state.levels, GREGORIAN)
    assert not [c for c in table.columns if c in state.indicators]
    hidden = explain.hide(table, ["SALARY_USD"]).toPandas()
    parts = [c for c in hidden.columns if c not in (*GREGORIAN.grain, PROBABILITY)]
    assert explain.OTHER in parts and "SALARY_USD" not in parts
    assert np.allclose(hidden[parts].sum(axis=1), hidden[PROBABILITY], atol=1e-12)


def test_tree_contributions(rows, state):
    tree = forest.fit_tree(rows, state.features, GREGORIAN, maxDepth=5)
    frame = explain.contributions(rows, tree, state.features, GREGORIAN).toPandas()
    total = frame[state.features].sum(axis=1) + frame[EXPECTED]
    assert np.allclose(total, frame[PROBABILITY], atol=1e-12)


def test_leaves_are_numbered_like_the_model(rows, state, model):
    """Every leaf that a row ends in is in the table, and its path ends at the leaf's share."""
    nodes = staged(explain.node_table(model), "nodes")
    width = len(state.features)
    leaves = explain.leaf_table(nodes, width).toPandas()
    assert len(leaves) == nodes.filter("left < 0").count()
    roots = {r.tree: r.share for r in nodes.filter("id = 0").collect()}
    shares = nodes.filter("left < 0").toPandas().sort_values(["tree", "id"])
    leaves = leaves.sort_values(["tree", "leaf"])
    paths = leaves[[f"c{i}" for i in range(width)]].to_numpy().sum(axis=1) + leaves["tree"].map(roots).to_numpy()
    assert np.allclose(paths, shares["share"].to_numpy(), atol=1e-12)
    groups = explain.tree_groups(staged(explain.leaf_table(nodes, width), "leaves"), width, 60)
    assert groups == [(t, t) for t in sorted(roots)]


def test_contributions_equal_path_sums(rows, state):
    model = forest.fit_forest(rows, state.features, GREGORIAN, numTrees=2, maxDepth=4)
    found = explain.contributions(rows, model, state.features, GREGORIAN).toPandas().set_index(GREGORIAN.grain)
    walked = explain.path_sums(rows, model, state.features, GREGORIAN).toPandas()
    dense = np.zeros((len(found), len(state.features)))
    place = {k: i for i, k in enumerate(found.index)}
    for *key, feature, moved in walked.itertuples(index=False):
        dense[place[tuple(key)], int(feature)] = moved
    assert np.allclose(dense, found[state.features].to_numpy(dtype=float), atol=1e-12)


def brute_chained(x, start, rounds):
    """The same rounds with numpy over the whole matrix, fewest gaps first."""
    gaps = np.isnan(x)
    filled = np.where(gaps, start, x)
    spread = np.nanstd(x, axis=0)
    for _ in range(rounds):
        for j in sorted(np.flatnonzero(gaps.any(axis=0)), key=lambda j: gaps[:, j].sum()):
            z = (filled - start) / spread
            others = [i for i in range(x.shape[1]) if i != j]
            known = ~gaps[:, j]
            a, y = z[known][:, others], z[known][:, j]
            ac, yc = a - a.mean(axis=0), y - y.mean()
            w = impute.bayesian_ridge(ac.T @ ac, ac.T @ yc, yc @ yc, len(y))
            fit = y.mean() + (z[:, others] - a.mean(axis=0)) @ w
            filled[gaps[:, j], j] = (fit * spread[j] + start[j])[gaps[:, j]]
    return filled


def test_chained_imputation_against_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(400, 2))
    x = np.column_stack([base, base @ [2.0, -1.0] + rng.normal(scale=0.1, size=400) + 5, rng.normal(size=400) * 30])
    truth = x.copy()
    x[rng.random(400) < 0.2, 2] = np.nan
    x[rng.random(400) < 0.1, 0] = np.nan
    names = ["a", "b", "c", "d"]
    data = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, d double")
    start = dict(zip(names, np.nanmean(x, axis=0).tolist()))
    fitted = impute.fit_chained(df, names, start)
    got = fitted.apply(df).orderBy("id").toPandas()[names].to_numpy()
    want = brute_chained(x, np.nanmean(x, axis=0), len(fitted.rounds))
    assert np.allclose(got, want, rtol=1e-6, atol=1e-6)
    gaps = np.isnan(x[:, 2])
    plain = np.abs(np.nanmean(x[:, 2]) - truth[gaps, 2]).mean()
    assert np.abs(got[gaps, 2] - truth[gaps, 2]).mean() < plain / 4
    path = new_path(spark, "chained")
    fitted.save(spark, path)
    again = impute.ChainedImputer.load(spark, path)
    assert again == fitted and [list(r) for r in again.rounds] == [["a", "c"]] * len(fitted.rounds)
    # Sums of more groups than the driver may hold stay in a table; the values are the same.
    stored = impute.fit_chained(df, names, start, max_groups=1)
    assert np.allclose(stored.apply(df).orderBy("id").toPandas()[names].to_numpy(), got, rtol=1e-9, atol=1e-9)


def test_columns_without_values_or_rows(spark):
    """A column that is never known keeps its start value, as does everything in an empty table."""
    df = spark.createDataFrame([(1.0, None, None), (2.0, 4.0, None), (3.0, 6.0, None)], "a double, b double, c double")
    start = {"a": 2.0, "b": 5.0, "c": 7.0}
    fitted = impute.fit_chained(df, list("abc"), start, estimator=impute.least_squares)
    rows = sorted(tuple(round(v, 9) for v in r) for r in fitted.apply(df).collect())
    assert rows == [(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 6.0, 7.0)]
    assert impute.fit_chained(df.limit(0), list("abc"), start).rounds == []


def test_nothing_to_impute(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    fitted = impute.fit_chained(df, ["a", "b"], {"a": 0.0, "b": 0.0})
    assert fitted.rounds == [] and fitted.apply(df).exceptAll(df).isEmpty()


def test_whole_job(spark, small, tmp_path):
    control, out = str(tmp_path / "control"), str(tmp_path / "out")
    spark.createDataFrame([("go", "TRUE"), ("x", "1")], "NAME string, VALUE string").write.parquet(control)
    inputs = {
        "gregorian": feature_table(spark, small),
        "fiscal": feature_table(spark, small, FISCAL).limit(0),
    }
    settings = pipeline.Settings(params=QUICK, split="hash", delimited=True)
    old = datetime(2024, 1, 1)
    writers.write_run(
        spark.createDataFrame([(1, 2, 2000, 0.5)], "BUSINESS_ID long, MASTER_PARTICIPANT_ID long, CAL_YEAR int, PRED_TERM_PROB double"),
        f"{out}/predictions_gregorian", "gregorian", old.strftime("%Y_%m_%d_%H%M%S"),
    )
    done = pipeline.run_all(spark, inputs, control, "go", out, datetime(2024, 1, 31, 10), settings)
    assert done == ["gregorian"]
    published = spark.read.parquet(f"{out}/predictions_gregorian")
    assert {r["run_id"] for r in published.select("run_id").distinct().collect()} == {"2024_01_31_100000"}
    expected = inputs["gregorian"].count()
    assert published.count() == expected == spark.read.parquet(f"{out}/explanations_gregorian").count()
    log = spark.read.parquet(f"{out}/log")
    assert log.filter("calendar = 'fiscal' and message like '%skipped%'").count() == 1
    assert log.filter("metric = 'auc'").count() == 1
    # The flag is reset, so the next scheduled run does nothing; a remote run would.
    assert pipeline.run_all(spark, inputs, control, "go", out, datetime(2024, 2, 1), settings) == []
    assert {tuple(r) for r in read_current(spark, control).collect()} == {("go", "FALSE"), ("x", "1")}
    again = pipeline.load_trained(spark, f"{out}/trained/gregorian")
    rescored = pipeline.predict(inputs["gregorian"], again)
    assert rescored.exceptAll(published.select(*rescored.columns)).isEmpty()
    moved = pipeline.predict(inputs["gregorian"], again, jitter=True)
    shift = moved.alias("m").join(rescored.alias("r"), GREGORIAN.grain).select(
        (F.col(f"m.{PROBABILITY}") - F.col(f"r.{PROBABILITY}")).alias("d")
    )
    low, high = shift.agg(F.min("d"), F.max("d")).first()
    assert 0.0 <= low and high < 0.01


def test_external_training_and_cohort(spark, small, tmp_path):
    fiscal = feature_table(spark, small, FISCAL)
    settings = pipeline.Settings(model="tree", params={"maxDepth": 4}, layout="conditional", jitter=True)
    trained = pipeline.run(
        spark, fiscal, FISCAL, str(tmp_path), datetime(2024, 1, 31), settings, training=fiscal
    )
    assert trained.metrics["auc"] is not None
    assert spark.read.parquet(f"{tmp_path}/predictions_fiscal").count() == fiscal.count()


def test_wide_forest_spreads_few_rows_over_few_partitions(rows, state, monkeypatch):
    """Every partition sends sums of every node of 500 trees, so small inputs get fewer of them."""
    seen = []
    usual = forest.fixed_order

    def watched(df, keys, partitions):
        seen.append((df.count(), partitions))
        return usual(df, keys, partitions)

    monkeypatch.setattr(forest, "fixed_order", watched)
    model = forest.fit_wide_forest(rows, state.features, GREGORIAN, numTrees=3, maxDepth=4)
    assert model.getNumTrees == 3 and model.getFeatureSubsetStrategy() == "log2"
    assert seen == [(rows.filter(F.col(LABEL).isNotNull()).count(), 8)]
    assert [forest.wide_partitions(n) for n in (0, 79_195, 100_000, 2_000_000)] == [8, 8, 10, 16]
