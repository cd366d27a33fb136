from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from orderloom import schemas
from orderloom.plans import dashboard, refresh, registry
from orderloom.sources import csv_tables, sinks, star_tables

AT = datetime(2024, 5, 1)


def _registry(spark, *entries):
    return spark.createDataFrame(
        [(t, n, "m", v, c, 0.0, at) for t, n, v, c, at in entries], schemas.OUTPUT["model_registry"]
    )


def _challengers(spark, forecast, delay):
    return spark.createDataFrame(
        [("forecast", "new-f", forecast), ("delay_risk", "new-d", delay)],
        "model_type string, model_resource_name string, metric_value double",
    )


def _drift(spark, score=0.01):
    return spark.createDataFrame([(score, score >= 0.25)], "psi_score double, drift_flag boolean")


def _state(df):
    return {(r["model_resource_name"], r["is_champion"]) for r in df.collect()}


def test_empty_registry_takes_both(spark):
    new = registry.promote(_registry(spark), _challengers(spark, 0.4, 0.5), _drift(spark), AT)
    assert _state(new) == {("new-f", True), ("new-d", True)}
    assert {(r["metric_name"], r["drift_score"], r["updated_at"]) for r in new.collect()} == {("MAPE", 0.01, AT), ("ROC_AUC", 0.01, AT)}


def test_better_wins_equal_and_worse_do_not(spark):
    old = _registry(
        spark,
        ("forecast", "f1", 0.5, True, datetime(2024, 1, 1)),
        ("forecast", "f2", 0.3, True, datetime(2024, 2, 1)),
        ("delay_risk", "d1", 0.7, True, datetime(2024, 1, 1)),
        ("delay_risk", "d0", 0.9, False, datetime(2024, 3, 1)),
    )
    assert rows(registry.champions(old), "model_type", "model_resource_name") == [("delay_risk", "d1"), ("forecast", "f2")]
    assert rows(dashboard.champion_rows(old, "forecast"), "model_resource_name") == [("f1",), ("f2",)]
    # 0.4 beats f1 but not f2, the newest champion; an equal AUC does not win.
    same = registry.promote(old, _challengers(spark, 0.4, 0.7), _drift(spark), AT)
    assert rows(same) == rows(old)
    new = registry.promote(old, _challengers(spark, 0.2, 0.71), _drift(spark), AT)
    assert _state(new) == {("f1", False), ("f2", False), ("d1", False), ("d0", False), ("new-f", True), ("new-d", True)}
    result = registry.resulting_champions(old, _challengers(spark, 0.2, 0.7), _drift(spark))
    assert rows(result) == [("delay_risk", "d1", False), ("forecast", "new-f", True)]


def test_drift_blocks_everything(spark):
    old = _registry(spark, ("forecast", "f1", 0.5, True, AT))
    drifted = _drift(spark, 0.25)
    assert rows(registry.promote(old, _challengers(spark, 0.1, 0.9), drifted, AT)) == rows(old)
    result = registry.resulting_champions(old, _challengers(spark, 0.1, 0.9), drifted)
    assert rows(result) == [("delay_risk", "new-d", False), ("forecast", "f1", False)]
    assert rows(registry.drift_audit(drifted, AT)) == [(AT, "payment_value", 0.25, True)]


def test_null_metric_counts_as_no_score_and_null_challenger_loses(spark):
    old = _registry(spark, ("forecast", "f1", None, True, AT), ("delay_risk", "d1", None, True, AT))
    new = registry.promote(old, _challengers(spark, 9998.0, 0.0), _drift(spark), AT)
    assert ("new-f", True) in _state(new) and ("new-d", True) in _state(new)
    assert rows(registry.promote(old, _challengers(spark, None, float("nan")), _drift(spark), AT)) == rows(old)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "reg")
    assert sinks.read_latest_or_empty(spark, path, "model_registry").isEmpty()
    first = _registry(spark, ("forecast", "f1", 0.5, True, AT))
    sinks.full_refresh(first, path)
    second = registry.promote(sinks.read_latest_or_empty(spark, path, "model_registry"), _challengers(spark, 0.1, 0.9), _drift(spark), AT)
    sinks.full_refresh(second, path)
    assert _state(sinks.read_latest_or_empty(spark, path, "model_registry")) == {("f1", False), ("new-f", True), ("new-d", True)}

    sinks.full_refresh(first.limit(0), path)
    assert sinks.read_latest_or_empty(spark, path, "model_registry").isEmpty()

    audit = registry.drift_audit(_drift(spark), AT)
    out = str(tmp_path / "audit")
    sinks.append(audit, out, schemas.OUTPUT["drift_audit"])
    assert sinks.append(audit, out, schemas.OUTPUT["drift_audit"]).count() == 2
    with pytest.raises(ValueError):
        sinks.append(audit.withColumn("psi_score", F.lit("x")), out, schemas.OUTPUT["drift_audit"])
    with pytest.raises(ValueError):
        sinks.append(audit.drop("psi_score"), out, schemas.OUTPUT["drift_audit"])


def test_failed_refresh_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.full_refresh(spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    assert sinks.read_latest(spark, path, "id long").count() == 3
    sinks.full_refresh(spark.range(4), path)
    assert sinks.read_latest(spark, path, "id long").count() == 4


def test_drift_compares_with_the_run_before(spark, tmp_path):
    dst = str(tmp_path / "dst")
    values = lambda low: spark.range(400).select((F.col("id") % 50 + low).cast("decimal(18,2)").alias("payment_value"))
    first = refresh.drift_samples(values(0), dst, None, None)
    assert rows(registry.drift_score(*first))[0][0] == pytest.approx(0.0)
    same = refresh.drift_samples(values(0), dst, None, None)
    assert not registry.drift_score(*same).first()["drift_flag"]
    moved = refresh.drift_samples(values(30), dst, None, None)
    drift = registry.drift_score(*moved)
    assert drift.first()["drift_flag"]
    old = _registry(spark, ("forecast", "f1", 0.5, True, AT))
    assert rows(registry.promote(old, _challengers(spark, 0.1, 0.9), drift, AT)) == rows(old)


def test_newest_run_of_scores(spark):
    data = [("a", 1.0, "v9", AT), ("a", 5.0, "v10", AT.replace(year=AT.year + 1)), ("a", 7.0, "v1", None)]
    df = spark.createDataFrame(data, "k string, x double, model_version string, scored_at timestamp_ntz")
    assert rows(dashboard.latest_run(df), "x") == [(5.0,)]
    assert dashboard.latest_run(df.limit(0)).count() == 0


def test_full_refresh_from_files(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    for table, df in star_tables.raw_tables(spark, SMALL).items():
        csv_tables.write_csv(df, f"{src}/{csv_tables.FILES[table]}")
    sizes = refresh.ModelRun(forecast_trees=1, forecast_depth=2, delay_trees=1, delay_depth=2)
    tables = refresh.refresh_all(spark, src, dst, sizes=sizes, run_id="r1", today=date(2024, 5, 1))
    counts = {r["table_name"]: r["row_count"] for r in refresh.validation_counts(tables).collect()}
    assert counts["fct_orders"] == counts["stg_orders"] == 1500 and counts["rejects"] == 0
    assert counts["daily_kpi"] == tables["fct_orders"].select("order_date").distinct().filter("order_date is not null").count()
    assert counts["client_daily_brief"] == 1 and counts["champions"] == 2
    assert spark.sql("select count(*) from exec_dashboard").first()[0] == counts["exec_dashboard"]
    stored = sinks.read_latest_or_empty(spark, f"{dst}/mart/model_registry", "model_registry")
    assert spark.sql("select count(*) from delay_risk_scores").first()[0] == counts["delay_features_scoring"]
    assert rows(stored, "model_type", "is_champion") == [("delay_risk", True), ("forecast", True)]
    assert spark.read.parquet(f"{dst}/mart/drift_audit").first()["psi_score"] == pytest.approx(0.0)
    assert spark.read.parquet(f"{dst}/mart/delay_risk_scores").count() == counts["delay_features_scoring"]
