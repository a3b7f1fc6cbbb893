"""Accuracy and area under the ROC curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import prefix_sums


def accuracy(df: DataFrame, prediction: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Share of rows with a label whose prediction equals it."""
    hit = (F.col(prediction).cast("int") == F.col(label).cast("int")).cast("double")
    return df.filter(F.col(label).isNotNull()).groupBy(*(by or [])).agg(F.avg(hit).alias("accuracy"), F.count(hit).alias("n_rows"))


def auc(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve: one row, NULL if a class is missing.

    Rows are first reduced to one per distinct score, so a score that most rows share is one
    row; a two-phase prefix sum then counts the negatives below each score.
    """
    positive = F.col(label).cast("long")
    scores = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    )
    below = prefix_sums(scores, "score", {"neg": "below"}, ranges)
    pairs = F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2)
    total = below.agg(F.sum(pairs).alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    possible = F.col("pos").cast("double") * F.col("neg").cast("double")
    return total.select(
        F.when(possible > 0, F.col("pairs") / possible).alias("auc"),
        F.coalesce("pos", F.lit(0)).alias("n_positive"),
        F.coalesce("neg", F.lit(0)).alias("n_negative"),
    )
