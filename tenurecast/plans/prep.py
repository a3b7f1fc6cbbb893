"""Preparation with learned state: fit once, apply to any rows.

``fit`` runs a handful of aggregate jobs and keeps only what they learned, a
few numbers per column. ``apply`` is one lazy projection over the input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators import categories, columns, outliers, profile, scaling
from ..operators.impute import ChainedImputer, fit_chained
from ..operators.outliers import Fence
from ..operators.scaling import Scale
from ..operators.split import exact_test
from ..schema import LABEL, Calendar, quoted
from ..session import folder_exists

IS_TEST = "is_test"


@dataclass
class PrepState:
    """Everything learned from the training data."""

    calendar: Calendar
    dropped: list[str]
    levels: dict[str, list[str]]
    fences: dict[str, Fence]
    scales: dict[str, Scale]
    numeric: list[str]
    indicators: list[str]
    chained: ChainedImputer | None = None
    present: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.indicators]

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the state as two small tables."""
        names = sorted({*self.present, *self.fences, *self.scales, *self.numeric, *self.dropped})
        rows = []
        for c in names:
            fence, scale = self.fences.get(c), self.scales.get(c)
            rows.append(
                (
                    self.calendar.name,
                    c,
                    self.present.get(c),
                    c in self.dropped,
                    self.numeric.index(c) if c in self.numeric else None,
                    *((fence.low, fence.high, fence.lower_quartile, fence.upper_quartile)
                      if fence else (None,) * 4),
                    *((scale.mean, scale.deviation) if scale else (None,) * 2),
                )
            )
        spark.createDataFrame(rows, _COLUMN_STATE).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/columns"
        )
        chosen = {c: i for i, c in enumerate(self.indicators)}
        levels = [
            (f, level, i, chosen.get(schema.indicator(f, level)))
            for f, values in self.levels.items()
            for i, level in enumerate(values)
        ]
        known = {schema.indicator(f, level) for f, level, _, _ in levels}
        extra = [(None, c, None, i) for c, i in chosen.items() if c not in known]
        empty = [(f, None, None, None) for f, values in self.levels.items() if not values]
        spark.createDataFrame(levels + extra + empty, _LEVEL_STATE).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/levels")
        if self.chained is not None:
            self.chained.save(spark, f"{path}/chained")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PrepState:
        """The stored state, with its chained imputer if it was saved with one."""
        chained = folder_exists(spark, f"{path}/chained")
        rows = spark.read.schema(_COLUMN_STATE).parquet(f"{path}/columns").collect()
        levels: dict[str, list[tuple[int, str]]] = {}
        chosen: dict[int, str] = {}
        for r in spark.read.schema(_LEVEL_STATE).parquet(f"{path}/levels").collect():
            if r["feature"] is not None:
                known = levels.setdefault(r["feature"], [])
                if r["level"] is not None:
                    known.append((r["position"], r["level"]))
            if r["chosen"] is not None:
                name = schema.indicator(r["feature"], r["level"]) if r["feature"] else r["level"]
                chosen[r["chosen"]] = name
        ordered = sorted((r for r in rows if r["feature_position"] is not None),
                         key=lambda r: r["feature_position"])
        return PrepState(
            calendar=schema.calendar(rows[0]["calendar"]),
            dropped=sorted(r["name"] for r in rows if r["dropped"]),
            levels={f: [v for _, v in sorted(values)] for f, values in levels.items()},
            fences={
                r["name"]: Fence(r["low"], r["high"], r["q25"], r["q75"])
                for r in rows
                if r["low"] is not None
            },
            scales={
                r["name"]: Scale(r["mean"], r["deviation"])
                for r in rows
                if r["mean"] is not None
            },
            numeric=[r["name"] for r in ordered],
            indicators=[chosen[i] for i in sorted(chosen)],
            chained=ChainedImputer.load(spark, f"{path}/chained") if chained else None,
            present={r["name"]: r["present"] for r in rows if r["present"] is not None},
        )


_COLUMN_STATE = (
    "calendar string, name string, present double, dropped boolean, feature_position int, "
    "low double, high double, q25 double, q75 double, mean double, deviation double"
)
_LEVEL_STATE = "feature string, level string, position int, chosen int"


def inputs_of(features: list[str]) -> list[str]:
    """Source columns behind a list of numeric features."""
    found: list[str] = []
    for f in features:
        for c in schema.DIFFERENCES.get(f, (f,)):
            if c not in found:
                found.append(c)
    return found


def score_only_features(calendar: Calendar) -> list[str]:
    """Numeric features of the score-only layout, to go with ``layout="fixed"``."""
    extra = [schema.PAYEE_COUNT] if calendar is schema.GREGORIAN else []
    return [*schema.NUMERIC_FEATURES, *extra]


def choose_indicators(levels: dict[str, list[str]], layout: str) -> list[str]:
    """Indicator columns of a layout.

    ``learned``: every level seen at fit. ``conditional``: ownership, the five
    titles if all occur, one industry if it occurs. ``fixed``: the score-only
    list, whatever occurred.
    """
    learned = categories.indicators(levels)
    if layout == "learned":
        return learned
    if layout == "conditional":
        return categories.conditional_indicators(learned)
    if layout == "fixed":
        return categories.fixed_indicators()
    raise ValueError(f"unknown layout {layout!r}")


def require_features(wanted: list[str], available: list[str], dropped: list[str]) -> None:
    sparse = [c for c in inputs_of(wanted) if c in dropped]
    if sparse:
        raise ValueError(f"selected features rest on columns dropped as sparse: {sparse}")
    missing = [c for c in inputs_of(wanted) if c not in available]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")


def fit(
    df: DataFrame,
    calendar: Calendar,
    numeric: list[str] | None = None,
    layout: str = "learned",
    test: Column | None = None,
    impute: str = "mean",
) -> PrepState:
    """Learn the preparation from a feature table.

    ``df`` is read by several jobs, so hand in a stored table, not a long plan.
    Levels, sparse columns and outlier fences come from all rows, fill values
    and scales from the training rows.
    """
    numeric = list(numeric or schema.NUMERIC_FEATURES)
    df = categories.consolidate(columns.cast_by_name(df))
    candidates = columns.candidate_columns(df.columns, calendar)
    measures = [c for c in candidates if c not in schema.CATEGORICAL]
    needed = [c for c in inputs_of(numeric) if c in measures]
    stats = profile.collect_profile(df, candidates, needed)
    dropped = profile.sparse_columns(stats)
    require_features(numeric, df.columns, dropped)

    kept_categories = [c for c in schema.CATEGORICAL if c in df.columns and c not in dropped]
    levels = profile.collect_levels(df, kept_categories)
    fences = outliers.fit_fences(df, needed, stats)
    if test is None:
        test = exact_test(df, calendar.grain)
    shaped = columns.add_differences(outliers.replace_outliers(df, fences))
    train = shaped.filter(~test)
    scales = scaling.fit_scales(train, numeric)
    state = PrepState(
        calendar=calendar,
        dropped=dropped,
        levels=levels,
        fences=fences,
        scales=scales,
        numeric=numeric,
        indicators=choose_indicators(levels, layout),
        present={c: s.present / s.rows if s.rows else 0.0 for c, s in stats.items()},
    )
    if impute == "chained":
        state.chained = fit_chained(train, numeric, {c: s.mean for c, s in scales.items()})
        filled = state.chained.apply(train)
        state.scales = scaling.fit_scales(filled, numeric)
    elif impute != "mean":
        raise ValueError(f"unknown imputation {impute!r}")
    return state


def apply(df: DataFrame, state: PrepState, carry: list[str] | None = None) -> DataFrame:
    """Keys, prepared features and, if present, the label.

    Only columns that feed a feature are touched, so a columnar scan reads no
    others.
    """
    calendar = state.calendar
    keys = [c for c in calendar.keys if c in df.columns]
    carry = [c for c in [*(carry or []), LABEL] if c in df.columns]
    sources = inputs_of(state.numeric)
    require_features(state.numeric, df.columns, [])
    held = [c for c in state.levels if c in df.columns]
    rows = columns.cast_by_name(df.select(*dict.fromkeys([*keys, *sources, *held, *carry])))
    rows = categories.consolidate(rows)
    rows = outliers.replace_outliers(rows, {c: f for c, f in state.fences.items() if c in sources})
    rows = columns.add_differences(rows)
    if state.chained is not None:
        rows = state.chained.apply(rows)
    rows = scaling.standardize(scaling.fill_with_mean(rows, state.scales), state.scales)
    rows = categories.one_hot(rows, {c: v for c, v in state.levels.items() if c in held})
    rows = categories.add_absent(rows, state.indicators)
    return rows.select(
        *keys,
        *[quoted(c) for c in state.features],
        *[F.col(c).cast("int").alias(c) if c == LABEL else F.col(quoted(c)) for c in carry],
    )
