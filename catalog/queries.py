"""One registered query per operator, over the feature table of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast import schema
from tenurecast.functions.jitter import with_jitter
from tenurecast.functions.order_stats import exact_quantiles
from tenurecast.operators import (
    categories,
    cohort,
    columns,
    explain,
    forest,
    impute,
    metrics,
    outliers,
    profile,
    scaling,
    split,
)
from tenurecast.plans import pipeline, prep, runs
from tenurecast.schema import (
    CATEGORICAL,
    FISCAL,
    GREGORIAN,
    LABEL,
    NUMERIC_FEATURES,
    PROBABILITY,
    Calendar,
    quoted,
)
from tenurecast.session import new_path, staged
from tenurecast.sources import manifest as manifest_source
from tenurecast.sources import readers, versions, writers
from tenurecast.sources.standin import all_calendars, calendar_tables, feature_table, table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 31)
RUN_ID = "2024_01_31_101500"
GRAIN = GREGORIAN.grain


# ---- shared pieces --------------------------------------------------------


def stored(spark: SparkSession, sf_dir: str, calendar: Calendar = GREGORIAN, *names: str) -> DataFrame:
    """The feature table (or the named columns of it), stored once for several jobs."""
    df = feature_table(spark, sf_dir, calendar)
    return staged(df.select(*names) if names else df, f"features-{calendar.name}")


def labelled(df: DataFrame) -> DataFrame:
    """Rows that can teach: those of the last year have no label yet."""
    return df.filter(F.col(LABEL).isNotNull())


def measures(df: DataFrame, calendar: Calendar = GREGORIAN) -> list[str]:
    return columns.measure_columns(df.columns, calendar)


def rounded(df: DataFrame, names: list[str], places: int) -> list[Column]:
    """Rounded values; adding zero turns a negative zero into zero."""
    return [F.expr(f"round(double({quoted(c)}), {places}) + 0D as {quoted(c)}") for c in names]


def named(names: list[str]) -> list[str]:
    return [quoted(c) for c in names]


def with_score(df: DataFrame) -> DataFrame:
    """A deterministic stand-in score: this year's payments against the largest."""
    largest = df.agg(F.max("YEAR_PAYMENT")).first()[0]
    return df.withColumn(
        PROBABILITY, F.coalesce(F.col("YEAR_PAYMENT"), F.lit(0.0)) / F.lit(largest)
    )


def level_lists(df: DataFrame) -> dict[str, list[str]]:
    return profile.collect_levels(df, CATEGORICAL)


def prepared_rows(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, prep.PrepState]:
    df = stored(spark, sf_dir)
    state = prep.fit(df, GREGORIAN)
    return staged(prep.apply(df, state), "prepared"), state


# ---- sources and sinks ----------------------------------------------------


def scan_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(spark, sf_dir, GREGORIAN)


def scan_features_fiscal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(spark, sf_dir, FISCAL)


def scan_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = readers.read_table(spark, path=f"{sf_dir}/customer.parquet")
    flag = F.when(F.col("c_acctbal") >= 0, "TRUE").otherwise("FALSE")
    control = source.select(
        F.col("c_mktsegment").alias("NAME"), F.col("c_name").alias("OWNER"), flag.alias("VALUE")
    )
    return control.filter(F.col("NAME") == "BUILDING")


def scan_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of one ownership's later years, from a source that takes both filters."""
    path = new_path(spark, "source")
    rows = feature_table(spark, sf_dir).select(*GREGORIAN.keys, "OWNERSHIP", "SALARY_USD", LABEL)
    manifest_source.write_manifest(rows.repartitionByRange(GREGORIAN.year), path)
    df = manifest_source.read_manifest(spark, path, [*GRAIN, "OWNERSHIP", LABEL])
    return df.filter((F.col(GREGORIAN.year) >= 1996) & (F.col("OWNERSHIP") == "Private")).drop("OWNERSHIP")


def publish_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stale publication is replaced by one calendar, then the other is appended, each in one commit."""
    path = new_path(spark, "publish")
    for calendar, mode in ((FISCAL, "append"), (GREGORIAN, "overwrite"), (FISCAL, "append")):
        scored = with_score(stored(spark, sf_dir, calendar, *calendar.grain, "YEAR_PAYMENT"))
        rows = scored.select(
            schema.BUSINESS, "MASTER_PARTICIPANT_ID", F.col(calendar.year).alias("run_year"),
            *rounded(scored, [PROBABILITY], 9), F.lit(calendar.name).alias("calendar"),
        )
        manifest_source.write_manifest(rows, path, mode)
    return manifest_source.read_manifest(spark, path)


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = columns.cast_by_name(feature_table(spark, sf_dir)).withColumns(
        {"CAL_YEAR": F.col("CAL_YEAR").cast("int"), LABEL: F.col(LABEL).cast("int")}
    )
    path = new_path(spark, "tsv")
    writers.write_delimited(df, path)
    read = readers.read_delimited(spark, path, readers.feature_schema(df.columns))
    original = feature_table(spark, sf_dir).schema
    return read.select(*[F.col(f.name).cast(f.dataType) for f in original.fields])


def publish_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = []
    for calendar in (GREGORIAN, FISCAL):
        scored = with_score(stored(spark, sf_dir, calendar, *calendar.grain, "YEAR_PAYMENT"))
        path = new_path(spark, f"predictions-{calendar.name}")
        result = scored.select(*calendar.grain, *rounded(scored, [PROBABILITY], 9))
        writers.write_run(result, path, calendar.name, RUN_ID)
        # A repeated run replaces its own partition and leaves no doubles.
        writers.write_run(result, path, calendar.name, RUN_ID)
        published.append(spark.read.parquet(path).withColumnRenamed(calendar.year, "run_year"))
    return reduce(DataFrame.unionByName, published)


def control_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("NAME"),
        F.when(F.col("c_acctbal") >= 0, "TRUE").otherwise("FALSE").alias("VALUE"),
    )
    # One row per customer before the join: a customer may hold a third of all orders.
    owners = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    finished = control.join(owners, "c_custkey", "left_semi")
    new = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("NAME"))
    updates = finished.select("NAME").unionByName(new).withColumn("VALUE", F.lit("FALSE"))
    return writers.upsert(control.select("NAME", "VALUE"), updates, "NAME")


def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_score(stored(spark, sf_dir, GREGORIAN, *GRAIN, "YEAR_PAYMENT"))
    path = new_path(spark, "replace")
    rows = scored.select(*GRAIN, *rounded(scored, [PROBABILITY], 9))
    writers.replace_partitions(rows, path, ["CAL_YEAR"])
    even = rows.filter("CAL_YEAR % 2 = 0").withColumn(PROBABILITY, F.lit(0.0))
    writers.replace_partitions(even, path, ["CAL_YEAR"])
    return spark.read.schema(rows.schema).parquet(path)


def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "delete")
    feature_table(spark, sf_dir).select(*GRAIN, "OWNERSHIP").write.parquet(path)
    versions.delete_where(spark, path, F.col("OWNERSHIP") == "Private")
    return versions.read_current(spark, path)


def delete_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes from even years only; tells which rows stand in partitions written again."""
    path = new_path(spark, "delete")
    versions.overwrite(feature_table(spark, sf_dir).select(*GRAIN, "OWNERSHIP"), path, ["CAL_YEAR"])
    gone = (F.col("CAL_YEAR") % 2 == 0) & (F.col("OWNERSHIP") == "Private")
    touched = versions.delete_where(spark, path, gone)
    years = [int(p.split("=")[1]) for p in touched]
    return versions.read_current(spark, path).withColumn("rewritten", F.col("CAL_YEAR").isin(years))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "log")
    for calendar in (GREGORIAN, FISCAL):
        counted = (
            feature_table(spark, sf_dir, calendar)
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_distinct(schema.BUSINESS).alias("businesses"),
                F.sum(LABEL).alias("leavers"),
            )
            .first()
        )
        log = runs.RunLog(calendar.name, RUN_ID)
        for metric, value in counted.asDict().items():
            log.add("load", f"{metric}: {value}", metric, value)
        log.save(spark, path)
    return spark.read.parquet(path).select(
        "calendar", F.col("seq").cast("int").alias("seq"), "metric", "value"
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of the published rows, taken by the jobs that publish them."""
    path, logs = new_path(spark, "measured"), new_path(spark, "log")
    for calendar in (GREGORIAN, FISCAL):
        scored = with_score(stored(spark, sf_dir, calendar, *calendar.grain, "YEAR_PAYMENT"))
        rows = scored.select(*calendar.grain, *rounded(scored, [PROBABILITY], 9))
        rows, seen = runs.watched(rows, *runs.score_measures())
        writers.write_run(rows, f"{path}/{calendar.name}", calendar.name, RUN_ID)
        log = runs.RunLog(calendar.name, RUN_ID)
        log.add_measures("publish", "predictions", seen)
        log.save(spark, logs)
    return spark.read.parquet(logs).select("calendar", "step", "metric", "value")


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, state = prepared_rows(spark, sf_dir)
    model = forest.fit_forest(rows, state.features, GREGORIAN, numTrees=5, maxDepth=6)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    before = forest.score(rows, model, state.features, GRAIN)
    again = forest.load_model(spark, path)
    both = again.setProbabilityCol("again").setPredictionCol("p").setRawPredictionCol("r")
    reread = both.transform(forest.assemble(rows, state.features, GRAIN)).select(
        *GRAIN, F.get(forest.vector_to_array("again"), F.lit(1)).alias("again")
    )
    return before.join(reread, GRAIN).select(
        *GRAIN,
        F.round(F.abs(F.col(PROBABILITY) - F.col("again")), 9).alias("difference"),
        F.col(PROBABILITY).between(0.0, 1.0).alias("in_range"),
    )


def state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir)
    path = new_path(spark, "state")
    prep.fit(df, GREGORIAN).save(spark, path)
    state = prep.PrepState.load(spark, path)
    result = prep.apply(df, state)
    return result.select(
        *[F.col(c).cast(df.schema[c].dataType) for c in GREGORIAN.keys],
        *rounded(result, state.numeric, 6),
        *named(state.indicators),
        LABEL,
    )


def publish_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishes the whole explanation table; each row must add up to its score."""
    rows, state = prepared_rows(spark, sf_dir)
    model = forest.fit_forest(rows, state.features, GREGORIAN)
    path = new_path(spark, "explanations")
    table_ = explain.explain(rows, model, state.features, state.levels, GREGORIAN)
    writers.write_run(table_, path, GREGORIAN.name, RUN_ID)
    published = spark.read.parquet(path)
    parts = [c for c in table_.columns if c not in (*GRAIN, PROBABILITY)]
    total = reduce(lambda a, b: a + b, [F.col(quoted(c)) for c in parts])
    residual = F.round(F.abs(total - F.col(PROBABILITY)), 9).alias("residual")
    return published.select(*GRAIN, residual)


# ---- projections and filters ---------------------------------------------


def cast_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_table(spark, sf_dir)
    dirty = {"COUNT_AVG_MONTH_PAID_QUOTA": "NaN", "SUM_CREDIT_AMT_USD": "n/a"}
    raw = df.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit(dirty[c]) if c in dirty else F.lit(None)).alias(c)
            for c in df.columns
        ]
    )
    typed = columns.cast_by_name(raw, strict=False)
    return typed.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields])


def key_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.key_projection(feature_table(spark, sf_dir), GREGORIAN)


def drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir)
    df = categories.consolidate(columns.without_descriptive(df))
    candidates = columns.candidate_columns(df.columns, GREGORIAN)
    sparse = profile.sparse_columns(profile.collect_profile(df, candidates, []))
    return columns.label_last(df.drop(*sparse))


def rename_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_table(spark, sf_dir, FISCAL).select(*FISCAL.keys, LABEL)
    return columns.rename_calendar(df, FISCAL, GREGORIAN)


def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(
        spark, sf_dir, GREGORIAN, *GREGORIAN.keys, *CATEGORICAL,
        *prep.inputs_of([*NUMERIC_FEATURES, "DIFF_MONTH_ORDER"]), LABEL,
    )
    df = categories.consolidate(df)
    levels = level_lists(df)
    shaped = categories.one_hot(columns.add_differences(df), levels)
    return shaped.select(
        *GREGORIAN.keys,
        *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES],
        *named(categories.indicators(levels)),
        LABEL,
    )


def conditional_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = categories.consolidate(stored(spark, sf_dir, GREGORIAN, *GRAIN, *CATEGORICAL))
    levels = level_lists(df)
    chosen = categories.conditional_indicators(categories.indicators(levels))
    return categories.one_hot(df, levels).select(*GRAIN, *named(chosen))


def align_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir, GREGORIAN, *GRAIN, *CATEGORICAL)
    chosen = categories.fixed_indicators()
    shaped = categories.one_hot(df, level_lists(df))
    return categories.add_absent(shaped, chosen).select(*GRAIN, *named(chosen))


def cohort_both_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(stored(spark, sf_dir, GREGORIAN, *GRAIN, LABEL))
    return cohort.with_both_labels(df).select(*GRAIN, LABEL)


def cohort_no_empty_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(stored(spark, sf_dir, GREGORIAN, *GRAIN, LABEL))
    return cohort.teaching_cohort(df, GREGORIAN).select(*GRAIN, LABEL)


def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = (F.col("c_acctbal") > 9000) & (F.col("c_mktsegment") != "MACHINERY")
    control = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("NAME"),
        F.when(raised, "TRUE").otherwise("FALSE").alias("VALUE"),
    )
    flags = runs.flags(control, ["BUILDING", "MACHINERY", "ABSENT"])
    modes = F.explode(F.array(F.lit(False), F.lit(True))).alias("remote")
    return flags.select("*", modes).withColumn("run", runs.may_run(F.col("VALUE"), F.col("remote")))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run name per event, in the forms that occur and one malformed form."""
    ts = F.col("ts")
    kinds = {
        "click": ("part_gregorian_pred_", "yyyy_MM_dd_HH:mm:ss", ".tsv"),
        "view": ("part_fiscal_pred_", "yyyy_MM_dd_HHmmss", ""),
        "purchase": ("part_visual_fiscal_", "yyyy_MM_dd_HH:mm:ss", ".tsv"),
        "error": ("log_file_gregorian_", "yyyy_MM_dd_HH:mm:ss", ".tsv"),
    }
    name = F.concat(F.lit("part_"), F.date_format(ts, "yyyy_MM_dd"))
    for kind, (head, pattern, tail) in kinds.items():
        full = F.concat(F.lit(head), F.date_format(ts, pattern), F.lit(tail))
        name = F.when(F.col("event_type") == kind, full).otherwise(name)
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"))


def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.retained(manifest(spark, sf_dir), F.lit(AS_OF))


def list_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishes one run per kind of year, lists them from their files, and marks those due."""
    day = F.format_string("2024_01_%02d_101500", (F.col("CAL_YEAR") % 7 * 4 + 1).cast("int"))
    rows = feature_table(spark, sf_dir).select(*GRAIN, F.lit(GREGORIAN.name).alias("calendar"), day.alias("run_id"))
    path = new_path(spark, "runs")
    rows.write.partitionBy(*writers.RUN_KEYS).parquet(path)
    listed = runs.due_runs(runs.listed_runs(spark, path), F.lit(AS_OF)).filter("files > 0 and bytes > 0")
    held = spark.read.parquet(path).groupBy(*writers.RUN_KEYS).agg(F.count("*").alias("n_rows"))
    return listed.join(held, [*writers.RUN_KEYS]).select(*writers.RUN_KEYS, "expired", "n_rows")


def parse_run_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = runs.marked_runs(manifest(spark, sf_dir), F.lit(AS_OF))
    return marked.withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd HH:mm"))


# ---- joins ----------------------------------------------------------------


def join_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = categories.consolidate(stored(spark, sf_dir))
    numeric = df.select(*GRAIN, *[F.col(c).cast("double").alias(c) for c in measures(df)])
    levels = level_lists(df)
    indicators = categories.one_hot(df.select(*GRAIN, *CATEGORICAL), levels)
    return numeric.join(indicators, GRAIN, "inner")


def lookup_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_table(spark, sf_dir).select(*GRAIN, "TITLE_CATEGORY_YR_END")
    return categories.lookup_join(df, "TITLE_CATEGORY_YR_END", schema.TITLE_LOOKUP, "consolidated")


# ---- aggregations ---------------------------------------------------------


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.label_counts(feature_table(spark, sf_dir), [schema.BUSINESS, GREGORIAN.year])


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = categories.consolidate(feature_table(spark, sf_dir))
    numeric = measures(df)
    table_ = profile.column_profile(df, [*numeric, *CATEGORICAL], numeric)
    return table_.withColumns(
        {"mean": F.round("mean", 4), "deviation": F.round("deviation", 3)}
    )


def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.level_counts(categories.consolidate(feature_table(spark, sf_dir)), CATEGORICAL)


def exact_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir)
    found = exact_quantiles(df, measures(df), [0.25, 0.75])
    rows = [(c, *(round(q, 6) for q in quartiles)) for c, quartiles in found.items()]
    return spark.createDataFrame(rows, "column_name string, q25 double, q75 double")


def contribution_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = categories.consolidate(stored(spark, sf_dir, GREGORIAN, *GRAIN, *CATEGORICAL, "SALARY_USD"))
    levels = level_lists(df)
    shaped = categories.one_hot(df, levels)
    weighted = shaped.select(
        *GRAIN,
        *[
            (F.col(quoted(schema.indicator(f, level))) * F.col("SALARY_USD") / (i + 2)).alias(
                schema.indicator(f, level)
            )
            for f, values in levels.items()
            for i, level in enumerate(values)
        ],
    )
    rolled = explain.roll_up(weighted, levels)
    return rolled.select(*GRAIN, *rounded(rolled, CATEGORICAL, 6))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_score(stored(spark, sf_dir, GREGORIAN, *GRAIN, "YEAR_PAYMENT", LABEL))
    guessed = scored.withColumn("prediction", (F.col(PROBABILITY) < 0.25).cast("int"))
    found = metrics.accuracy(guessed, "prediction", LABEL, [GREGORIAN.year])
    return found.withColumn("accuracy", F.round("accuracy", 9))


def auc_rank_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_score(stored(spark, sf_dir, GREGORIAN, *GRAIN, "YEAR_PAYMENT", LABEL))
    return metrics.auc(scored, PROBABILITY, LABEL).withColumn("auc", F.round("auc", 9))


# ---- set operations, splits, scalar steps ---------------------------------


def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_table(spark, sf_dir).select(*GRAIN, LABEL)
    marked = staged(df.withColumn("is_test", split.hash_test(GRAIN)), "split")
    train = marked.filter("not is_test").select(*GRAIN, LABEL, F.lit("train").alias("part"))
    test = marked.filter("is_test").select(*GRAIN, LABEL, F.lit("test").alias("part"))
    return train.unionByName(test)


def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_table(spark, sf_dir).select(*GRAIN)
    return df.withColumn("is_test", split.hash_test(GRAIN))


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir, GREGORIAN, *GRAIN)
    return df.withColumn("is_test", split.exact_test(df, GRAIN))


def map_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.consolidate(feature_table(spark, sf_dir)).select(*GRAIN, *CATEGORICAL)


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = categories.consolidate(stored(spark, sf_dir, GREGORIAN, *GRAIN, *CATEGORICAL))
    return categories.one_hot(df, level_lists(df))


def difference_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = columns.add_differences(feature_table(spark, sf_dir))
    return df.select(*GRAIN, "DIFF_MONTH_ORDER", *rounded(df, ["DIFF_QUOTA_AMT_USD"], 4))


def outlier_to_quartile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir)
    names = measures(df)
    replaced = outliers.replace_outliers(df, outliers.fit_fences(df, names))
    return replaced.select(*GRAIN, *rounded(replaced, names, 6))


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir)
    result = prep.apply(df, prep.fit(df, GREGORIAN))
    return result.select(
        *[F.col(c).cast(df.schema[c].dataType) for c in GRAIN], *rounded(result, NUMERIC_FEATURES, 6)
    )


def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = columns.add_differences(stored(spark, sf_dir))
    train = df.filter(~split.exact_test(df, GRAIN))
    filled = scaling.fill_with_mean(df, scaling.fit_scales(train, NUMERIC_FEATURES))
    return filled.select(*GRAIN, *rounded(filled, NUMERIC_FEATURES, 5))


def round_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["COUNT_AVG_MONTH_PAID_QUOTA", "SALARY_USD"]
    df = feature_table(spark, sf_dir).select(*GRAIN, *names)
    return columns.round_features(df, names)


def hash_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [
        "PR_TARGET_USD",
        "SALARY_USD",
        "YEAR_PAYMENT",
        "COUNT_MONTH_EMPLOYED_TIL_DEC",
        "SUM_CREDIT_AMT_USD",
    ]
    scored = with_score(stored(spark, sf_dir, GREGORIAN, *GRAIN, *names))
    moved = with_jitter(scored, PROBABILITY, names)
    return moved.select(*GRAIN, *rounded(moved, [PROBABILITY], 9))


# ---- learned steps --------------------------------------------------------


def _imputed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = columns.add_differences(stored(spark, sf_dir))
    df = df.select(*GRAIN, *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES])
    stats = profile.collect_profile(df, NUMERIC_FEATURES, NUMERIC_FEATURES)
    start = {c: s.mean for c, s in stats.items()}
    return df, impute.fit_chained(df, NUMERIC_FEATURES, start).apply(df)


def chained_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir)[1]


def chained_impute_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps are filled, known values are untouched."""
    before, after = _imputed(spark, sf_dir)
    names = {c: f"_old_{i}" for i, c in enumerate(NUMERIC_FEATURES)}
    joined = after.join(before.withColumnsRenamed(names), GRAIN)
    counts = joined.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(o).isNull()).alias(f"f{o}") for o in names.values()],
        *[F.count_if(F.col(c).isNull()).alias(f"m{o}") for c, o in names.items()],
        *[F.count_if(F.col(c) != F.col(o)).alias(f"c{o}") for c, o in names.items()],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("n_rows"),
            F.col(f"f{o}").alias("n_filled"),
            F.col(f"m{o}").alias("n_missing"),
            F.col(f"c{o}").alias("n_changed"),
        )
        for c, o in names.items()
    ]
    return counts.select(F.inline(F.array(*entries)))


def chained_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of plain regressions; the second column sees what the first just got."""
    names = ["SALARY_USD", "YEAR_PAYMENT", "SUM_CREDIT_AMT_USD"]
    df = stored(spark, sf_dir, GREGORIAN, *GRAIN, *names)
    stats = profile.collect_profile(df, names, names)
    start = {c: s.mean for c, s in stats.items()}
    fitted = impute.fit_chained(df, names, start, max_rounds=2, estimator=impute.least_squares)
    filled = fitted.apply(df)
    return filled.select(*GRAIN, *rounded(filled, names, 4))


def prepare_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir, FISCAL)
    state = prep.fit(df, FISCAL, layout="conditional")
    result = prep.apply(df, state)
    return result.select(
        *[F.col(c).cast(df.schema[c].dataType) for c in FISCAL.keys],
        *rounded(result, state.numeric, 6),
        *named(state.indicators),
        LABEL,
    )


def _held_out(spark: SparkSession, sf_dir: str, fit: Callable) -> DataFrame:
    df = labelled(stored(spark, sf_dir))
    test = split.exact_test(df, GRAIN)
    state = prep.fit(df, GREGORIAN, test=test)
    rows = staged(prep.apply(df, state).withColumn(prep.IS_TEST, test), "prepared")
    model = fit(rows.filter(f"not {prep.IS_TEST}"), state.features, GREGORIAN)
    found = pipeline.evaluate(rows, model, state.features, GREGORIAN)
    return spark.createDataFrame(sorted(found.items()), "metric string, value double")


def forest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _held_out(spark, sf_dir, forest.fit_forest)


def tree_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _held_out(spark, sf_dir, forest.fit_tree)


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, state = prepared_rows(spark, sf_dir)
    model = forest.fit_forest(rows, state.features, GREGORIAN)
    return forest.score(rows, model, state.features, GRAIN).select(*GRAIN, PROBABILITY)


def explain_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, state = prepared_rows(spark, sf_dir)
    model = forest.fit_forest(rows, state.features, GREGORIAN)
    return explain.contributions(rows, model, state.features, GREGORIAN)


def explain_paths_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions from the table of leaves against path sums over the stored nodes."""
    rows, state = prepared_rows(spark, sf_dir)
    model = forest.fit_forest(rows, state.features, GREGORIAN, numTrees=4, maxDepth=5)
    found = explain.contributions(rows, model, state.features, GREGORIAN)
    number = {f: i for i, f in enumerate(state.features)}
    pairs = F.explode(F.map_from_arrays(F.lit(list(number.values())), F.array(*named(state.features))))
    long = found.select(*GRAIN, pairs.alias("feature", "credit"))
    walked = explain.path_sums(rows, model, state.features, GREGORIAN)
    both = long.join(walked, [*GRAIN, "feature"], "full").groupBy(*GRAIN)
    apart = both.agg(F.max(F.abs(F.coalesce("credit", F.lit(0.0)) - F.coalesce("moved", F.lit(0.0)))).alias("apart"))
    total = sum((F.col(quoted(f)) for f in state.features), F.col(schema.EXPECTED))
    sums = found.select(*GRAIN, F.abs(total - F.col(PROBABILITY)).alias("residue"))
    return apart.join(sums, GRAIN).select(
        *GRAIN, (F.round("apart", 9) + 0.0).alias("difference"), (F.round("residue", 9) + 0.0).alias("residue")
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on one calendar; returns the published scores."""
    out = new_path(spark, "job")
    pipeline.run(spark, feature_table(spark, sf_dir), GREGORIAN, out, AS_OF)
    return spark.read.parquet(f"{out}/predictions_{GREGORIAN.name}")


def _in_range(score: Column) -> Column:
    return F.coalesce(score.between(0.0, 1.0), F.lit(False))


def run_all_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled job on both calendars from one scan: every published row, and the flag after it.

    A row's score must be a probability, the same in both published tables, and what its
    contributions add up to.
    """
    out, control = new_path(spark, "job"), new_path(spark, "control")
    writers.overwrite(spark.createDataFrame([("RUN", "TRUE")], "NAME string, VALUE string"), control)
    pipeline.run_all(spark, lambda: calendar_tables(spark, sf_dir), control, "RUN", out, AS_OF)
    flag = versions.read_current(spark, control).filter("NAME = 'RUN'").select(F.col("VALUE").alias("flag"))
    found = []
    for calendar in (GREGORIAN, FISCAL):
        scored = spark.read.parquet(f"{out}/predictions_{calendar.name}")
        explained = spark.read.parquet(f"{out}/explanations_{calendar.name}")
        parts = [c for c in explained.columns if c not in (*calendar.grain, PROBABILITY, *writers.RUN_KEYS)]
        total = reduce(lambda a, b: a + b, [F.col(quoted(c)) for c in parts])
        sums = explained.select(*calendar.grain, total.alias("total"), F.col(PROBABILITY).alias("again"))
        both = scored.join(sums, calendar.grain, "full")
        found.append(
            both.select(
                F.lit(calendar.name).alias("calendar"),
                schema.BUSINESS,
                schema.PARTICIPANT,
                F.col(calendar.year).alias("YEAR"),
                _in_range(F.col(PROBABILITY)).alias("in_range"),
                (F.round(F.abs(F.col("total") - F.col(PROBABILITY)), 9) + 0.0).alias("residue"),
                F.coalesce(F.col("again") == F.col(PROBABILITY), F.lit(False)).alias("agreed"),
            )
        )
    return reduce(DataFrame.unionByName, found).join(F.broadcast(flag))


def scan_calendars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both calendars' tables from one scan of orders and one of order lines."""
    return all_calendars(spark, sf_dir)


def external_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored by a model taught by another table, a delimited file.

    The file holds the labelled rows themselves, so the scores must be those of a model that
    the rows taught without it.
    """
    df = stored(spark, sf_dir)
    path = new_path(spark, "external")
    writers.write_delimited(labelled(df), path)
    external = staged(readers.read_delimited(spark, path, labelled(df).schema), "external")
    settings = pipeline.Settings(model="tree")
    scored = pipeline.predict(columns.for_scoring(df), pipeline.train(external, GREGORIAN, settings))
    own = pipeline.predict(df, pipeline.train(df, GREGORIAN, settings)).withColumnRenamed(PROBABILITY, "own")
    return scored.join(own, GRAIN, "full").select(
        *GRAIN,
        _in_range(F.col(PROBABILITY)).alias("in_range"),
        (F.round(F.abs(F.col(PROBABILITY) - F.col("own")), 9) + 0.0).alias("difference"),
    )


def score_only_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed features with the payee count filled from payments, its contribution hidden in ``OTHER``."""
    df = stored(spark, sf_dir)
    filled = df.withColumn(schema.PAYEE_COUNT, F.coalesce(schema.PAYEE_COUNT, F.col("YEAR_PAYMENT") / 7))
    state = prep.fit(filled, GREGORIAN, prep.score_only_features(GREGORIAN), layout="fixed")
    rows = staged(prep.apply(filled, state), "prepared")
    trained = pipeline.Trained(state, forest.fit_forest(rows, state.features, GREGORIAN, numTrees=10), {})
    table_ = pipeline.explain_rows(columns.for_scoring(filled), trained)
    parts = [c for c in table_.columns if c not in (*GRAIN, PROBABILITY)]
    total = reduce(lambda a, b: a + b, [F.col(quoted(c)) for c in parts])
    return table_.select(
        *GRAIN,
        _in_range(F.col(PROBABILITY)).alias("in_range"),
        (F.round(F.abs(total - F.col(PROBABILITY)), 9) + 0.0).alias("residue"),
        F.lit(schema.PAYEE_COUNT in parts).alias("shown"),
        F.col(quoted(explain.OTHER)).isNotNull().alias("other"),
    )


def wide_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alternative forest of 500 trees; its votes, tree by tree, must give its score."""
    rows, state = prepared_rows(spark, sf_dir)
    model = forest.fit_wide_forest(rows, state.features, GREGORIAN)
    scored = forest.score(rows, model, state.features, GRAIN)
    voted = explain.tree_votes(rows, model, state.features, GREGORIAN)
    return scored.join(voted, GRAIN, "full").select(
        *GRAIN,
        "n_trees",
        _in_range(F.col(PROBABILITY)).alias("in_range"),
        (F.round(F.abs(F.col("votes") / F.col("n_trees") - F.col(PROBABILITY)), 9) + 0.0).alias("difference"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_features,
        scan_features_fiscal,
        scan_calendars,
        scan_pushdown,
        scan_source,
        publish_source,
        tsv_roundtrip,
        publish_predictions,
        publish_explanations,
        control_upsert,
        replace_partition,
        delete_where,
        delete_partition,
        run_log,
        run_metrics,
        model_roundtrip,
        state_roundtrip,
        cast_by_name,
        key_projection,
        drop_sparse_columns,
        rename_calendar,
        select_features,
        conditional_levels,
        align_levels,
        cohort_both_labels,
        cohort_no_empty_year,
        run_gate,
        retention_expired,
        list_runs,
        parse_run_stamp,
        join_blocks,
        lookup_broadcast,
        label_counts,
        column_profile,
        level_counts,
        exact_quartiles,
        contribution_rollup,
        accuracy,
        auc_rank_sum,
        union_splits,
        split_hash,
        split_exact,
        map_categories,
        one_hot,
        difference_features,
        outlier_to_quartile,
        standardize,
        mean_impute,
        round_features,
        hash_jitter,
        chained_impute,
        chained_impute_checks,
        chained_order,
        prepare_training,
        forest_fit,
        tree_fit,
        score,
        explain_paths,
        explain_paths_checks,
        flagship,
        run_all_job,
        external_training,
        score_only_layout,
        wide_forest,
    )
}
