"""Model quality metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordering import running_total, with_even_bucket
from ..sources.sinks import stored

# Fixed value: lower bound of both sides of the percentage error.
FLOOR = 1e-8


def mape(actual: str, predicted: str) -> Column:
    y = F.greatest(F.col(actual).cast("double"), F.lit(FLOOR))
    p = F.greatest(F.col(predicted).cast("double"), F.lit(FLOOR))
    return F.avg(F.abs(y - p) / y)


def finite_or_one(value: Column) -> Column:
    """A mean score that is missing or not finite counts as 1.0."""
    return F.when(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")), value).otherwise(F.lit(1.0))


def fold_mean(scores: DataFrame, column: str = "score") -> DataFrame:
    return scores.agg(F.avg(column).alias("m")).select(finite_or_one(F.col("m")).alias("metric_value"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row, ``roc_auc``: exact, equal scores count half; NULL when a class is missing.

    Rows are reduced to one per distinct score before anything is ordered.
    """
    # Stored, since cuts, offsets and ranks all read it.
    counts = stored(
        df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y"))
        .filter(F.col("s").isNotNull() & F.col("y").isNotNull())
        .groupBy("s")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")),
        "score-counts",
    )
    ranked = running_total(with_even_bucket(counts, "s", "part"), F.col("neg"), F.col("part"), [F.col("s")], name="below")
    wide = "decimal(38,0)"
    pairs = F.sum((F.col("pos").cast("decimal(18,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)")).cast(wide))
    return ranked.agg(
        pairs.cast("double").alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    ).select(
        F.when(
            (F.col("p") > 0) & (F.col("n") > 0),
            F.col("w") / (2.0 * F.col("p").cast("double") * F.col("n").cast("double")),
        ).alias("roc_auc")
    )
