"""Exact quantiles, histograms by explicit edges, and the population stability index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.sinks import stored
from .ordering import running_total, with_even_bucket


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their counts: repeated values collapse before the shuffle."""
    return (
        df.select(F.col(column).cast("double").alias("v"))
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """One row, ``quantiles array<double>``: linear interpolation between order statistics.

    ``percentile`` would hold all distinct values in one task; this finds the
    order statistics by their rank in a distributed running total.
    """
    # Stored, since cuts, offsets and ranks all read it: one row per distinct value.
    counts = stored(value_counts(df, column), "value-counts")
    ranked = running_total(with_even_bucket(counts, "v", "part"), F.col("n"), F.col("part"), [F.col("v")], grand_total="total")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("v")))

    picked = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = at(F.floor(position)), at(F.ceil(position))
        picked += [low.alias(f"lo{i}"), high.alias(f"hi{i}"), F.max(position - F.floor(position)).alias(f"t{i}")]
    values = [
        F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"t{i}") for i in range(len(probs))
    ]
    return ranked.agg(*picked).select(F.array_compact(F.array(*values)).alias("quantiles"))


def decile_cuts(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """One row, ``cuts array<double>``: distinct quantile edges in ascending order."""
    edges = exact_quantiles(df, column, [i / bins for i in range(bins + 1)])
    return edges.select(F.array_sort(F.array_distinct("quantiles")).alias("cuts"))


def bin_of(value: Column, cuts: Column, bins: int) -> Column:
    """1-based bin of a value: left-closed bins, the last one closed on both sides,
    NULL outside the edges. A sum of comparisons keeps it inside generated code."""
    reached = sum(
        (F.coalesce((F.get(cuts, F.lit(i)) <= value).cast("int"), F.lit(0)) for i in range(bins + 1)), F.lit(0)
    )
    last = F.size(cuts) - 1
    inside = (value >= F.get(cuts, F.lit(0))) & (value <= F.get(cuts, last))
    return F.when(inside, F.least(reached, last))


def _binned(df: DataFrame, column: str, cuts: DataFrame, bins: int, *keep: str) -> DataFrame:
    """Bin and number of edges beside the kept columns; the edges are one subquery, used once."""
    return (
        df.select(F.col(column).cast("double").alias("_v"), *keep)
        .filter(F.col("_v").isNotNull())
        .withColumn("_cuts", cuts.scalar())
        .select(*keep, bin_of(F.col("_v"), F.col("_cuts"), bins).alias("bin"), F.size("_cuts").alias("edges"))
    )


def histogram(df: DataFrame, column: str, cuts: DataFrame, bins: int = 10) -> DataFrame:
    """Rows per bin for the edges in the one-row frame ``cuts``; at most ``bins`` rows."""
    return (
        _binned(df, column, cuts, bins)
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def psi(baseline: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """One row, ``psi_score``: 0 for an empty side, fewer than three edges or a non-finite sum.

    Both sides are binned in one pass; values outside the edges are counted under
    a NULL bin, which only tells that the side is not empty.
    """
    cuts = decile_cuts(baseline, column, bins)
    sides = baseline.select(column, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        current.select(column, F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    counts = (
        _binned(sides, column, cuts, bins, "e", "a")
        .groupBy("bin")
        .agg(F.sum("e").alias("e"), F.sum("a").alias("a"), F.max("edges").alias("edges"))
    )
    inside = F.col("bin").isNotNull()
    everything = Window.partitionBy()  # at most ``bins`` + 1 rows

    def share(side: str) -> Column:
        total = F.sum(F.when(inside, F.col(side))).over(everything)
        return F.greatest(F.col(side) / F.greatest(total, F.lit(1)), F.lit(1e-6))

    parts = counts.select(inside.alias("inside"), "edges", F.col("a").alias("rows"), share("e").alias("e"), share("a").alias("a"))
    term = (F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))
    score = F.col("s")
    return parts.agg(
        F.sum(F.when(F.col("inside"), term)).alias("s"), F.max("edges").alias("edges"), F.sum("rows").alias("rows")
    ).select(
        F.when(
            (F.col("edges") >= 3) & (F.col("rows") > 0) & ~F.isnan(score) & (F.abs(score) != float("inf")), score
        )
        .otherwise(F.lit(0.0))
        .alias("psi_score")
    )
