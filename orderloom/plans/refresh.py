"""The full refresh: text files to stored staging, fact, marts, features, models, registry and brief."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas, session
from ..sources import csv_tables, sinks
from . import brief, features, marts, models, registry, staging


@dataclass(frozen=True)
class ModelRun:
    """Sizes of the model step; the defaults are the full sizes."""

    forecast_trees: int = 400
    forecast_depth: int = 7
    delay_trees: int = 500
    delay_depth: int = 6


def refresh_tables(
    spark: SparkSession, src: str, dst: str, files: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Load the files and store every table once, each stage reading what the stage before stored."""
    landed = csv_tables.land(spark, src, f"{dst}/landed", files)
    raw = {table: csv_tables.good_rows(parsed) for table, parsed in landed.items()}
    stored = {
        table: sinks.full_refresh(df, f"{dst}/staging/{table}") for table, df in staging.build_staging(raw).items()
    }
    tables = {f"stg_{name}": df for name, df in stored.items()}
    tables["rejects"] = sinks.full_refresh(csv_tables.rejects_by_table(landed), f"{dst}/rejects")

    fct = marts.fct_orders(stored).withColumn(
        "order_month", F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("unknown"))
    )
    fct = sinks.full_refresh(fct, f"{dst}/mart/fct_orders", partition_by="order_month")
    tables["fct_orders"] = fct
    for name, df in marts.build_marts(fct).items():
        tables[name] = sinks.full_refresh(df, f"{dst}/mart/{name}")

    base = sinks.full_refresh(
        features.demand_base(fct, stored["order_items"], stored["products"]), f"{dst}/features/demand_base"
    )
    tables["demand_features_train"] = sinks.full_refresh(
        features.demand_features_train(base), f"{dst}/features/demand_features_train"
    )
    tables["demand_features_scoring"] = sinks.full_refresh(
        features.demand_features_scoring(base), f"{dst}/features/demand_features_scoring"
    )
    delay = sinks.full_refresh(
        features.delay_features_train(fct, stored["order_items"], stored["sellers"], stored["payments"]),
        f"{dst}/features/delay_features_train",
    )
    tables["delay_features_train"] = delay
    tables["delay_features_scoring"] = sinks.full_refresh(
        features.delay_features_scoring(delay), f"{dst}/features/delay_features_scoring"
    )
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def utc_now() -> datetime:
    """One moment for all rows of a run, in UTC and without a zone."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def drift_samples(payments: DataFrame, dst: str, baseline: DataFrame | None, current: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The two samples to compare, each stored once.

    By default the payments of this load against those of the run before, which are read
    before they are replaced; the first run has no earlier one and is its own baseline.
    """
    spark, path = payments.sparkSession, f"{dst}/features/drift_current_sample"
    current = features.drift_sample(payments) if current is None else current
    if baseline is None:
        baseline = sinks.read_latest(spark, path, current.schema) if sinks.is_stored(spark, path) else current
    baseline = sinks.full_refresh(baseline, f"{dst}/features/drift_baseline_sample")
    return baseline, sinks.full_refresh(current, path)


def output_views(spark: SparkSession, dst: str) -> dict[str, DataFrame]:
    """Forecasts, risk scores, registry, audit and briefs as tables and as views by their names."""
    found = {"model_registry": sinks.read_latest_or_empty(spark, f"{dst}/mart/model_registry", "model_registry")}
    for name in ("demand_forecast_daily", "delay_risk_scores", "drift_audit", "client_daily_brief"):
        # An empty append makes the folder, so that a view exists before the first rows.
        found[name] = sinks.append(schemas.empty_table(spark, name), f"{dst}/mart/{name}", schemas.OUTPUT[name])
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return found


def run_models(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    dst: str,
    baseline: DataFrame,
    current: DataFrame,
    sizes: ModelRun = ModelRun(),
    at: datetime | None = None,
    version: str | None = None,
) -> DataFrame:
    """Train, score, check drift and update the registry; returns the resulting champions.

    ``baseline`` and ``current`` are the two payment samples to compare.
    """
    at = at or utc_now()
    version = version or at.strftime("%Y%m%d%H%M%S")
    train = {"forecast": tables["demand_features_train"], "delay_risk": tables["delay_features_train"]}
    fitted = {
        "forecast": models.train_forecast(train["forecast"], sizes.forecast_trees, sizes.forecast_depth),
        "delay_risk": models.train_delay(train["delay_risk"], sizes.delay_trees, sizes.delay_depth),
    }
    rows = []
    for kind, (model, scores) in fitted.items():
        path = f"{dst}/models/{kind}/{version}"
        models.save_model(model, path, train[kind])
        rows.append((kind, path, models.mean_score(spark, scores)))
    challengers = spark.createDataFrame(rows, "model_type string, model_resource_name string, metric_value double")
    drift = sinks.full_refresh(registry.drift_score(baseline, current), f"{dst}/features/drift_score")
    registry_path = f"{dst}/mart/model_registry"
    old = sinks.read_latest_or_empty(spark, registry_path, "model_registry")
    result = sinks.full_refresh(
        registry.resulting_champions(old, challengers, drift), f"{dst}/mart/champion_result"
    )
    sinks.full_refresh(registry.promote(old, challengers, drift, at), registry_path)
    sinks.append(registry.drift_audit(drift, at), f"{dst}/mart/drift_audit", schemas.OUTPUT["drift_audit"])
    score_champions(spark, result, tables, dst, at)
    return result


def score_champions(spark: SparkSession, champions: DataFrame, tables: dict[str, DataFrame], dst: str, at: datetime) -> None:
    """Append forecasts and risks by the models in use, which need not be the ones just trained.

    The version of a score is the last part of its model's path.
    """
    jobs = {
        "forecast": ("demand_features_scoring", models.score_demand, "demand_forecast_daily"),
        "delay_risk": ("delay_features_scoring", models.score_delay, "delay_risk_scores"),
    }
    for row in champions.collect():  # one per model type
        source, score, output = jobs[row["model_type"]]
        path = row["champion"]
        model = models.load_model(spark, path, tables[source])
        scores = score(model, tables[source], path.rsplit("/", 1)[-1], at)
        sinks.append(scores, f"{dst}/mart/{output}", schemas.OUTPUT[output])


def store_brief(daily: DataFrame, dst: str, **given) -> DataFrame:
    """Append today's brief; an error when there is no KPI day."""
    brief.require_brief(brief.brief_kpis(daily))
    return sinks.append(
        brief.client_daily_brief(daily, **given), f"{dst}/mart/client_daily_brief", schemas.OUTPUT["client_daily_brief"]
    )


def validation_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the stored tables, read after they were written."""
    return staging.table_counts(tables)


def refresh_all(
    spark: SparkSession,
    src: str,
    dst: str,
    with_models: bool = True,
    sizes: ModelRun = ModelRun(),
    files: dict[str, str] | None = None,
    baseline: DataFrame | None = None,
    current: DataFrame | None = None,
    at: datetime | None = None,
    **brief_args,
) -> dict[str, DataFrame]:
    """Everything in dependency order; a failing step stops the run.

    ``baseline`` and ``current`` are payment samples for the drift check, see
    :func:`drift_samples`. Intermediate data of the run is removed at its end.
    """
    at = at or utc_now()
    with session.scratch_scope(spark):
        tables = refresh_tables(spark, src, dst, files)
        if with_models:
            samples = drift_samples(tables["stg_payments"], dst, baseline, current)
            tables["champions"] = run_models(spark, tables, dst, *samples, sizes, at)
        store_brief(tables["daily_kpi"], dst, **brief_args)
    return tables | output_views(spark, dst)
