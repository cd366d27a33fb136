"""Drift check, champion/challenger registry and audit rows.

Tables are immutable: a promotion is a function from the old registry to the new
one, written as a new version by the caller.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.clock import moment
from ..operators import quantiles

DRIFT_LIMIT = 0.25
# Fixed values per model type: metric name, whether lower is better, score to beat without a champion.
MODEL_TYPES = {
    "forecast": ("MAPE", True, 9999.0),
    "delay_risk": ("ROC_AUC", False, -1.0),
}


def drift_score(baseline: DataFrame, current: DataFrame, column: str = "payment_value") -> DataFrame:
    """One row: ``psi_score`` and ``drift_flag``."""
    score = quantiles.psi(baseline, current, column)
    return score.select("psi_score", (F.col("psi_score") >= DRIFT_LIMIT).alias("drift_flag"))


def drift_audit(drift: DataFrame, run_ts: datetime | None = None, feature: str = "payment_value") -> DataFrame:
    row = drift.select(moment(run_ts).alias("run_ts"), F.lit(feature).alias("feature_name"), "psi_score", "drift_flag")
    return schemas.conform(row, schemas.OUTPUT["drift_audit"])


def champions(registry: DataFrame) -> DataFrame:
    """Newest champion per model type; equal times are broken by name."""
    newest = F.max(
        F.struct(
            F.col("updated_at").isNull().alias("undated"),
            F.col("updated_at"),
            F.col("model_resource_name"),
            F.col("metric_value"),
        )
    )
    return (
        registry.filter(F.col("is_champion"))
        .groupBy("model_type")
        .agg(newest.alias("c"))
        .select(
            "model_type",
            F.col("c.model_resource_name").alias("model_resource_name"),
            F.col("c.metric_value").alias("metric_value"),
            F.col("c.updated_at").alias("updated_at"),
        )
    )


def _by_type(position: int) -> Column:
    value = F.lit(None)
    for model_type, facts in MODEL_TYPES.items():
        value = F.when(F.col("model_type") == model_type, F.lit(facts[position])).otherwise(value)
    return value


def decide(registry: DataFrame, challengers: DataFrame, drift: DataFrame) -> DataFrame:
    """One row per challenger: the score to beat, whether it wins, and the resulting champion.

    ``challengers`` has model_type, model_resource_name, metric_value; ``drift`` is
    the one-row frame of :func:`drift_score`. Drift stops every promotion.
    """
    old = champions(registry).select(
        "model_type",
        F.col("model_resource_name").alias("old_model"),
        F.col("metric_value").alias("old_metric"),
    )
    to_beat = F.coalesce(F.col("old_metric"), _by_type(2))
    value = F.col("metric_value")
    wins = F.when(_by_type(1), value < to_beat).otherwise((value > to_beat) & ~F.isnan(value))
    result = challengers.join(old, "model_type", "left").select(
        "model_type",
        "model_resource_name",
        _by_type(0).alias("metric_name"),
        "metric_value",
        to_beat.alias("metric_to_beat"),
        "old_model",
        (F.coalesce(wins, F.lit(False)) & ~drift.select("drift_flag").scalar()).alias("promoted"),
    )
    kept = F.when(F.col("old_model") != "", F.col("old_model"))
    return result.withColumn(
        "champion",
        F.when(F.col("promoted"), F.col("model_resource_name")).otherwise(
            F.coalesce(kept, F.col("model_resource_name"))
        ),
    )


def promote(registry: DataFrame, challengers: DataFrame, drift: DataFrame, at: datetime | None = None) -> DataFrame:
    """The registry after the run: winners added as champions, earlier champions of their type demoted."""
    winners = decide(registry, challengers, drift).filter("promoted")
    won = winners.select(F.col("model_type"), F.lit(True).alias("_won"))
    kept = registry.join(won, "model_type", "left").withColumn(
        "is_champion", F.when(F.col("_won") & F.col("is_champion"), F.lit(False)).otherwise(F.col("is_champion"))
    )
    added = winners.select(
        "model_type",
        "model_resource_name",
        "metric_name",
        "metric_value",
        F.lit(True).alias("is_champion"),
        drift.select("psi_score").scalar().alias("drift_score"),
        moment(at).alias("updated_at"),
    )
    schema = schemas.OUTPUT["model_registry"]
    return schemas.conform(kept.drop("_won"), schema).unionByName(schemas.conform(added, schema))


def resulting_champions(registry: DataFrame, challengers: DataFrame, drift: DataFrame) -> DataFrame:
    return decide(registry, challengers, drift).select("model_type", "champion", "promoted")
