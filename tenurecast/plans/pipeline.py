"""The whole job: prepare, train, score, explain and publish."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.jitter import with_jitter
from ..functions.stamps import run_file
from ..operators import categories, columns, explain, forest, metrics
from ..operators.cohort import teaching_cohort
from ..operators.split import exact_test, hash_test
from ..schema import LABEL, PROBABILITY, Calendar, quoted
from ..session import released, staged
from ..sources import writers
from ..sources.versions import read_current
from . import prep
from .runs import RunLog, drop_expired, reset_row, score_measures, should_run, watched

PREDICTION = "prediction"


@dataclass
class Settings:
    """What a run may choose."""

    model: str = "forest"  # or "tree"
    params: dict = field(default_factory=dict)
    layout: str = "learned"
    split: str = "exact"  # or "hash"
    impute: str = "mean"  # or "chained"
    cohort: bool = False
    jitter: bool = False
    delimited: bool = False  # also write tab-separated files named after the run
    numeric: list[str] | None = None


@dataclass
class Trained:
    state: prep.PrepState
    model: forest.Model
    metrics: dict[str, float | None]

    def save(self, spark: SparkSession, path: str) -> None:
        self.state.save(spark, f"{path}/state")
        self.model.write().overwrite().save(f"{path}/model")


def load_trained(spark: SparkSession, path: str) -> Trained:
    state = prep.PrepState.load(spark, f"{path}/state")
    return Trained(state, forest.load_model(spark, f"{path}/model"), {})


def _fit(df: DataFrame, features: list[str], calendar: Calendar, settings: Settings) -> forest.Model:
    fit = {"forest": forest.fit_forest, "tree": forest.fit_tree}[settings.model]
    return fit(df, features, calendar, **settings.params)


def _test_rows(df: DataFrame, calendar: Calendar, settings: Settings):
    if settings.split == "exact":
        return exact_test(df, calendar.grain)
    return hash_test(calendar.grain)


def evaluate(df: DataFrame, model: forest.Model, features: list[str], calendar: Calendar) -> dict:
    """Accuracy on both parts and the area under the curve on the test part."""
    scored = staged(
        forest.score(df, model, features, [*calendar.grain, LABEL, prep.IS_TEST]), "evaluate"
    )
    found = {
        "test_accuracy" if r[prep.IS_TEST] else "train_accuracy": r["accuracy"]
        for r in metrics.accuracy(scored, PREDICTION, LABEL, [prep.IS_TEST]).collect()
    }
    found["auc"] = metrics.auc(scored.filter(prep.IS_TEST), PROBABILITY, LABEL).first()["auc"]
    return found


def train(
    df: DataFrame, calendar: Calendar, settings: Settings | None = None, log: RunLog | None = None
) -> Trained:
    """Fit the preparation, measure a model on held-out rows, refit it on all rows.

    Only rows with a label teach; those of the current year have none yet.
    """
    settings = settings or Settings()
    df = df.filter(F.col(LABEL).isNotNull())
    if settings.cohort:
        df = staged(teaching_cohort(df, calendar), "cohort")
    columns.check_grain(df, calendar)
    test = _test_rows(df, calendar, settings)
    state = prep.fit(
        df, calendar, settings.numeric, settings.layout, test=test, impute=settings.impute
    )
    prepared = staged(prep.apply(df, state).withColumn(prep.IS_TEST, test), "prepared")
    trial = _fit(prepared.filter(f"not {prep.IS_TEST}"), state.features, calendar, settings)
    measured = evaluate(prepared, trial, state.features, calendar)
    final = _fit(
        columns.round_features(prepared, state.features), state.features, calendar, settings
    )
    if log is not None:
        log.add("prepare", "dropped sparse columns: " + ", ".join(state.dropped))
        for name, value in sorted(measured.items()):
            log.add("evaluate", name, name, value)
    return Trained(state, final, measured)


def predict(df: DataFrame, trained: Trained, jitter: bool = False) -> DataFrame:
    """Key columns and probability of leaving for every input row."""
    state = trained.state
    calendar, features = state.calendar, state.features
    rows = columns.round_features(prep.apply(df, state), features)
    if not jitter:
        return forest.score(rows, trained.model, features, calendar.grain).select(
            *calendar.grain, PROBABILITY
        )
    scored = forest.score(rows, trained.model, features, [*calendar.grain, *map(quoted, features)])
    return with_jitter(scored, PROBABILITY, features).select(*calendar.grain, PROBABILITY)


def explain_rows(df: DataFrame, trained: Trained) -> DataFrame:
    """Key columns, probability, rolled-up contributions and base value."""
    state = trained.state
    rows = columns.round_features(prep.apply(df, state), state.features)
    levels = {f: state.levels.get(f, []) for f in schema.CATEGORICAL}
    if any(c in categories.fixed_indicators() for c in state.indicators):
        fixed = {
            "TITLE_CATEGORY_YR_END": schema.FIXED_TITLES,
            "INDUSTRY": schema.FIXED_INDUSTRIES,
            "OWNERSHIP": schema.FIXED_OWNERSHIP,
        }
        levels = {f: sorted({*levels[f], *fixed[f]}) for f in levels}
    return explain.explain(rows, trained.model, state.features, levels, state.calendar)


def run(
    spark: SparkSession,
    df: DataFrame,
    calendar: Calendar,
    out: str,
    as_of: datetime,
    settings: Settings | None = None,
    training: DataFrame | None = None,
    trained: Trained | None = None,
) -> Trained | None:
    """Train (unless a trained job is given), then publish scores and explanations.

    ``training`` is an external labelled table; by default the input trains its
    own model. Results appear as a new run partition; earlier runs stay
    readable until retention drops them. An empty input is logged and skipped.
    """
    settings = settings or Settings()
    run_id = as_of.strftime("%Y_%m_%d_%H%M%S")
    log = RunLog(calendar.name, run_id)
    log.add("start", f"run {run_id} for {calendar.name}")
    with released(spark):
        try:
            return _run(spark, df, calendar, out, run_id, settings, training, trained, log)
        except Exception as error:
            log.add("error", f"{type(error).__name__}: {error}"[:2000])
            raise
        finally:
            log.save(spark, f"{out}/log")


def _run(spark, df, calendar, out, run_id, settings, training, trained, log) -> Trained | None:
    df, seen = watched(df, F.count(F.lit(1)).alias("rows"))
    df = staged(df, "input")
    rows = seen.get["rows"]
    if rows == 0:
        log.add("load", "no input rows, skipped", "rows", 0)
        return None
    log.add("load", "rows loaded", "rows", rows)
    if trained is None:
        source = df if training is None else staged(training, "training")
        trained = train(source, calendar, settings, log)
        trained.save(spark, f"{out}/trained/{calendar.name}")
    explained = staged(explain_rows(df, trained), "explained")
    scored = (
        predict(df, trained, jitter=True)
        if settings.jitter
        else explained.select(*calendar.grain, PROBABILITY)
    )
    for kind, result in (("predictions", scored), ("explanations", explained)):
        measured, seen = watched(result, *score_measures())
        writers.write_run(measured, f"{out}/{kind}_{calendar.name}", calendar.name, run_id)
        if settings.delimited:
            name = run_file(kind, calendar.name, run_id)
            writers.write_delimited(result, f"{out}/files/{name}")
        log.add("publish", f"{kind} published")
        log.add_measures("publish", kind, seen)
    return trained


def run_all(
    spark: SparkSession,
    inputs: dict[str, DataFrame] | Callable[[], dict[str, DataFrame]],
    control_path: str,
    flag: str,
    out: str,
    as_of: datetime,
    settings: Settings | None = None,
    remote: bool = False,
) -> list[str]:
    """The scheduled job: gate, every calendar, retention, flag reset.

    ``inputs`` may be a function that makes the tables of all calendars; it is called only
    once the gate is open. Returns the calendars that were published; none if it is closed.
    """
    if not should_run(read_current(spark, control_path), flag, remote=remote):
        return []
    done = []
    with released(spark):
        for name, df in (inputs() if callable(inputs) else inputs).items():
            if run(spark, df, schema.calendar(name), out, as_of, settings) is not None:
                done.append(name)
                for kind in ("predictions", "explanations"):
                    drop_expired(spark, f"{out}/{kind}_{name}", as_of)
        drop_expired(spark, f"{out}/log", as_of)
        control = read_current(spark, control_path)
        writers.overwrite(writers.upsert(control, reset_row(spark, flag), "NAME"), control_path)
    return done
