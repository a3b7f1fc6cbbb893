"""Chained imputation: every column with gaps is predicted from all others.

The columns with gaps are updated one after another, each from the newest values of the
others, for several rounds. Rows that lack the same columns go through the same linear
steps, so the product sums of such a group follow from those before a step. One pass adds
them up per group of gaps; every regression of every round is then solved on these sums
(their size is the number of columns, not of rows), and no row is read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import number, quoted
from ..session import staged

# Round limit and stopping tolerance.
MAX_ROUNDS = 10
TOLERANCE = 1e-3
# Groups of gaps whose sums the driver holds; more stay in a stored table.
MAX_GROUPS = 4096


def bayesian_ridge(
    gram: np.ndarray, cross: np.ndarray, square: float, n: int, steps: int = 300
) -> np.ndarray:
    """Ridge weights whose penalty maximises the evidence, from centred sums.

    ``gram`` holds the products of predictors, ``cross`` those with the target
    and ``square`` the target's own.
    """
    if n == 0 or square <= 0:
        return np.zeros(len(cross))
    values, vectors = np.linalg.eigh(gram)
    values = np.clip(values, 0.0, None)
    projected = vectors.T @ cross
    tiny = 1e-6
    noise, weight = n / square, 1.0
    previous = None
    for _ in range(steps):
        rotated = projected / (values + weight / noise)
        error = max(square - 2 * rotated @ projected + (values * rotated) @ rotated, 0.0)
        used = float(np.sum(noise * values / (weight + noise * values)))
        weight = (used + 2 * tiny) / (rotated @ rotated + 2 * tiny)
        noise = (n - used + 2 * tiny) / (error + 2 * tiny)
        if previous is not None and np.sum(np.abs(previous - rotated)) < 1e-3:
            break
        previous = rotated
    return vectors @ (projected / (values + weight / noise))


def least_squares(gram: np.ndarray, cross: np.ndarray, square: float, n: int) -> np.ndarray:
    """Weights without a penalty; of equally good ones those of least length."""
    return np.linalg.lstsq(gram, cross, rcond=None)[0]


@dataclass
class ChainedImputer:
    """Start values and, per round, an intercept and weights of each target in order of update."""

    columns: list[str]
    start: dict[str, float]
    centers: dict[str, float]
    spreads: dict[str, float]
    rounds: list[dict[str, tuple[float, list[float]]]]

    def apply(self, df: DataFrame) -> DataFrame:
        """Fill gaps; known values stay as they are."""
        targets = sorted({t for r in self.rounds for t in r})
        known = {t: f"_known_{i}" for i, t in enumerate(targets)}
        out = df.withColumns({known[t]: F.col(quoted(t)).isNotNull() for t in targets}) if targets else df
        out = self.begin(out)
        for fitted in self.rounds:
            out = self.advance(out, fitted, known)
        return out.drop(*known.values())

    def begin(self, df: DataFrame) -> DataFrame:
        """Gaps filled with the start values."""
        return df.withColumns(
            {c: F.coalesce(F.col(quoted(c)).cast("double"), F.lit(self.start[c])) for c in self.columns}
        )

    def advance(self, df: DataFrame, fitted: dict, known: dict[str, str]) -> DataFrame:
        """One round on filled rows; ``known`` names the flag of each target's given values."""
        for t, (intercept, weights) in fitted.items():
            value = f"case when {known[t]} then {quoted(t)} else {self._predict(t, intercept, weights)} end"
            df = df.withColumn(t, F.expr(value))
        return df

    def _predict(self, target: str, intercept: float, weights: list[float]) -> str:
        others = [c for c in self.columns if c != target]
        terms = [
            f"({quoted(c)} - {number(self.centers[c])}) * {number(w / self.spreads[c])}"
            for c, w in zip(others, weights)
        ]
        return " + ".join([number(intercept), *terms])

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (i, c, self.start[c], self.centers[c], self.spreads[c], None, None, None, None)
            for i, c in enumerate(self.columns)
        ]
        for r, fitted in enumerate(self.rounds):
            for step, (target, (intercept, weights)) in enumerate(fitted.items()):
                rows.append((None, target, None, None, None, r, step, intercept, weights))
        spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ChainedImputer:
        rows = spark.read.schema(_STATE).parquet(path).collect()
        base = sorted((r for r in rows if r["position"] is not None), key=lambda r: r["position"])
        count = max((r["round"] + 1 for r in rows if r["round"] is not None), default=0)
        rounds: list[dict[str, tuple[float, list[float]]]] = [{} for _ in range(count)]
        steps = [r for r in rows if r["round"] is not None]
        for r in sorted(steps, key=lambda r: (r["round"], r["step"])):
            rounds[r["round"]][r["name"]] = (r["intercept"], list(r["weights"]))
        return ChainedImputer(
            [r["name"] for r in base],
            {r["name"]: r["start"] for r in base},
            {r["name"]: r["center"] for r in base},
            {r["name"]: r["spread"] for r in base},
            rounds,
        )


_STATE = (
    "position int, name string, start double, center double, spread double, "
    "round int, step int, intercept double, weights array<double>"
)


@dataclass
class _Step:
    """Column ``at`` of the rows that lack target ``target`` becomes ``row`` times the row."""

    target: int
    at: int
    row: np.ndarray

    def moved(self, sums: np.ndarray) -> np.ndarray:
        change = np.eye(len(sums))
        change[self.at] = self.row
        return change @ sums @ change.T


def _groups(df: DataFrame, scaled: list[str], known: list[str]) -> DataFrame:
    """(gaps, sums): per set of missing targets the flat matrix of sums of ``x_i * x_j``, ``x_0 = 1``.

    ``gaps`` has one character per target, ``1`` where it is known.
    """
    width = len(scaled) + 1

    def partial(batches):
        for batch in batches:
            block = np.ones((len(batch), width))
            block[:, 1:] = batch[scaled].to_numpy(dtype=float)
            flags = batch[known].to_numpy(dtype=bool)
            kinds, place = np.unique(flags, axis=0, return_inverse=True)
            place = place.ravel()
            for k, kind in enumerate(kinds):
                rows = block[place == k]
                yield pd.DataFrame(
                    {
                        "gaps": "".join("1" if flag else "0" for flag in kind),
                        "cell": np.arange(width * width, dtype=np.int32),
                        "s": (rows.T @ rows).ravel(),
                    }
                )

    cells = (
        df.select(*scaled, *known)
        .mapInPandas(partial, "gaps string, cell int, s double")
        .groupBy("gaps", "cell")
        .agg(F.sum("s").alias("s"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("cell", "s")))
    return cells.groupBy("gaps").agg(F.transform(ordered, lambda c: c["s"]).alias("sums"))


class _Held:
    """Sums of few groups, on the driver."""

    def __init__(self, groups: DataFrame, width: int) -> None:
        self.sums = {r["gaps"]: np.array(r["sums"]).reshape(width, width) for r in groups.collect()}

    def known(self, target: int) -> np.ndarray:
        return sum(s for gaps, s in sorted(self.sums.items()) if gaps[target] == "1")

    def update(self, step: _Step) -> None:
        for gaps, sums in self.sums.items():
            if gaps[step.target] == "0":
                self.sums[gaps] = step.moved(sums)

    def end_round(self) -> None:
        """Nothing to store."""


class _Stored:
    """Sums of many groups, in a table; steps since it was stored are applied on reading."""

    def __init__(self, groups: DataFrame, width: int) -> None:
        self.groups, self.width, self.steps = groups, width, []

    def _current(self) -> DataFrame:
        steps, width = list(self.steps), self.width

        def moved(batches):
            for batch in batches:
                new = []
                for gaps, flat in zip(batch["gaps"], batch["sums"]):
                    sums = np.array(flat).reshape(width, width)
                    for step in steps:
                        if gaps[step.target] == "0":
                            sums = step.moved(sums)
                    new.append(sums.ravel())
                yield pd.DataFrame({"gaps": batch["gaps"], "sums": new})

        return self.groups.mapInPandas(moved, self.groups.schema) if steps else self.groups

    def known(self, target: int) -> np.ndarray:
        rows = self._current().filter(F.substring("gaps", target + 1, 1) == "1")
        cells = rows.select(F.posexplode("sums").alias("cell", "s")).groupBy("cell")
        total = np.zeros(self.width**2)
        for r in cells.agg(F.sum("s").alias("s")).collect():
            total[r["cell"]] = r["s"]
        return total.reshape(self.width, self.width)

    def update(self, step: _Step) -> None:
        self.steps.append(step)

    def end_round(self) -> None:
        self.groups, self.steps = staged(self._current(), "gap-sums"), []


def fit_chained(
    df: DataFrame,
    columns: list[str],
    start: dict[str, float],
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
    estimator: Callable = bayesian_ridge,
    max_groups: int = MAX_GROUPS,
) -> ChainedImputer:
    """Learn the rounds from a stored table.

    In a round the column with the fewest gaps comes first (ties in the given order); each
    sees the values the ones before it just got. Columns without gaps, or without any known
    value, only take their start values. ``max_groups`` decides where the sums are kept, not
    what they are.
    """
    stats = df.agg(
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(quoted(c)).alias(f"d{i}") for i, c in enumerate(columns)],
        F.count(F.lit(1)).alias("rows"),
    ).first()
    spreads = {c: (stats[f"d{i}"] or 1.0) for i, c in enumerate(columns)}
    given = {c: stats[f"n{i}"] for i, c in enumerate(columns)}
    targets = sorted((c for c in columns if 0 < given[c] < stats["rows"]), key=lambda c: -given[c])
    imputer = ChainedImputer(list(columns), dict(start), dict(start), spreads, [])
    if not targets:
        return imputer
    scaled = [f"z{i}" for i in range(len(columns))]
    known = [f"k{t}" for t in range(len(targets))]
    flags = [F.col(quoted(t)).isNotNull().alias(k) for t, k in zip(targets, known)]
    filled = imputer.begin(df.select(*[quoted(c) for c in columns], *flags)).selectExpr(
        *[
            f"({quoted(c)} - {number(imputer.centers[c])}) / {number(spreads[c])} as {z}"
            for c, z in zip(columns, scaled)
        ],
        *known,
    )
    groups = staged(_groups(filled, scaled, known), "gap-sums")
    width = len(columns) + 1
    kept = (_Held if groups.count() <= max_groups else _Stored)(groups, width)
    for _ in range(max_rounds):
        fitted, change = {}, 0.0
        for t, target in enumerate(targets):
            y = columns.index(target) + 1
            others = [i for i in range(1, width) if i != y]
            m = kept.known(t)
            n = m[0, 0]
            means, mean = m[0, others] / n, m[0, y] / n
            gram = m[np.ix_(others, others)] - n * np.outer(means, means)
            cross = m[others, y] - n * means * mean
            weights = estimator(gram, cross, m[y, y] - n * mean**2, int(n))
            intercept = mean - weights @ means
            row = np.zeros(width)
            row[0], row[others] = intercept, weights
            kept.update(_Step(t, y, row))
            scale = spreads[target]
            fitted[target] = (float(imputer.centers[target] + scale * intercept), [float(w * scale) for w in weights])
            if imputer.rounds:
                old = imputer.rounds[-1][target]
                before, now = np.array([old[0], *old[1]]), np.array([fitted[target][0], *fitted[target][1]])
                change = max(change, float(np.abs(before - now).max()) / scale)
        settled = bool(imputer.rounds) and change < tolerance
        imputer.rounds.append(fitted)
        if settled:
            break
        kept.end_round()
    return imputer
