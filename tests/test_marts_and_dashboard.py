from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom import schemas
from orderloom.plans import brief, dashboard, marts


def _empty(spark):
    return {t: spark.createDataFrame([], s) for t, s in schemas.STAGING.items()}


def _fct(spark, data):
    """(order_id, customer_unique_id, state, day, payment, review, delayed)"""
    schema = (
        "order_id string, customer_unique_id string, customer_state string, order_date date, "
        "payment_total decimal(28,2), avg_review_score double, is_delayed int"
    )
    return spark.createDataFrame(data, schema)


D1, D2, D3 = date(2018, 1, 1), date(2018, 1, 2), date(2018, 1, 5)


def test_empty_input(spark):
    fct = marts.fct_orders(_empty(spark))
    assert fct.isEmpty()
    assert marts.daily_kpi(fct).isEmpty() and marts.exec_dashboard(fct).isEmpty()
    assert rows(marts.customer_repeat_metrics(fct)) == [(0, 0, 0.0)]
    with pytest.raises(ValueError):
        brief.require_brief(brief.brief_kpis(marts.daily_kpi(fct)))


def test_fact_keeps_order_grain_and_flags(spark, staging):
    fct = marts.fct_orders(staging).cache()
    assert fct.count() == staging["orders"].count() == fct.select("order_id").distinct().count()
    assert marts.daily_kpi(fct).agg(F.sum("total_orders")).first()[0] == fct.filter("order_date is not null").count()
    fct.unpersist()


def test_delay_flag_is_three_valued(spark):
    ts = datetime(2018, 1, 10, 12)
    s = _empty(spark)
    s["orders"] = spark.createDataFrame(
        [
            ("late", "c", "x", ts, None, None, datetime(2018, 1, 20), datetime(2018, 1, 19)),
            ("on time", "c", "x", ts, None, None, datetime(2018, 1, 19), datetime(2018, 1, 19)),
            ("open", "c", "x", ts, None, None, None, datetime(2018, 1, 19)),
            ("no promise", "c", "x", None, None, None, datetime(2018, 1, 20), None),
        ],
        schemas.STAGING["orders"],
    )
    got = {r["order_id"]: (r["is_delayed"], r["order_date"], r["payment_total"]) for r in marts.fct_orders(s).collect()}
    assert got == {
        "late": (1, date(2018, 1, 10), None),
        "on time": (0, date(2018, 1, 10), None),
        "open": (None, date(2018, 1, 10), None),
        "no promise": (None, None, None),
    }


def test_kpis_count_distinct_orders_and_ignore_null_flags(spark):
    fct = _fct(
        spark,
        [
            ("a", "u1", "SP", D1, Decimal("10.00"), 4.0, 1),
            ("a", "u1", "SP", D1, Decimal("10.00"), 4.0, None),
            ("b", "u1", "SP", D1, None, None, 0),
            ("c", "u2", None, D1, Decimal("1.50"), 2.0, None),
            ("d", None, "SP", None, Decimal("9.00"), 1.0, 1),
        ],
    )
    (day,) = marts.daily_kpi(fct).collect()
    assert (day["total_orders"], day["gmv"], day["aov"]) == (3, Decimal("21.50"), 21.5 / 3)
    assert day["avg_review_score"] == 10 / 3 and day["delayed_order_pct"] == 50.0
    assert rows(marts.customer_repeat_metrics(fct)) == [(2, 1, 50.0)]


def test_exec_rows_look_back_by_row_within_the_state(spark):
    fct = _fct(
        spark,
        [
            ("a", "u", "SP", D1, Decimal("0.00"), 4.0, 1),
            ("b", "u", "SP", D2, Decimal("5.00"), 4.0, 0),
            ("c", "u", "SP", D3, Decimal("15.00"), None, None),
            ("d", "u", "RJ", D3, None, None, None),
        ],
    )
    exec_rows = marts.exec_dashboard(fct)
    got = {(r["customer_state"], r["kpi_date"]): r for r in exec_rows.collect()}
    assert got["SP", D3]["prev_day_gmv"] == Decimal("5.00") and got["SP", D3]["prev_day_delayed_pct"] == 0.0
    assert got["RJ", D3]["prev_day_gmv"] is None and got["RJ", D3]["gmv"] == 0
    dod = {(r["customer_state"], r["kpi_date"]): r for r in dashboard.exec_dod_pct(exec_rows).collect()}
    assert dod["SP", D3]["gmv_dod"] == 2.0
    assert dod["SP", D2]["gmv_dod"] is None  # not the newest day
    assert dod["SP", D3]["delayed_order_pct_dod"] is None and dod["RJ", D3]["gmv_dod"] is None
    shown = {(r[1], r[0]): r[2] for r in dashboard.latest_delay_pct(exec_rows).collect()}
    assert shown["SP", D3] == 0.0 and shown["SP", D2] is None
    assert {r["is_latest_day"] for r in dashboard.latest_day_flag(exec_rows).filter("kpi_date = '2018-01-05'").collect()} == {True}
    by_state = {(r["customer_state"], r["order_date"]): r["gmv_dod"] for r in dashboard.fct_gmv_dod(fct).collect()}
    assert by_state["SP", D2] is None and by_state["SP", D3] == 2.0
    assert dashboard.in_window(exec_rows, last_n_days=3).count() == 3
    assert [r["customer_state"] for r in dashboard.top_states(exec_rows).collect()] == ["SP", "RJ"]


def test_headline_kpis(spark):
    fct = _fct(
        spark,
        [
            ("a", "u", "SP", D3, Decimal("8.00"), 4.0, None),
            ("b", "u", "RJ", D3, Decimal("2.00"), 2.0, None),
            ("c", "u", "RJ", D1, Decimal("99.00"), 2.0, 1),
        ],
    )
    assert rows(dashboard.headline_kpis(fct)) == [(D3, 10.0, 2, 5.0, 3.0, 0.0)]
    assert rows(dashboard.headline_kpis(fct, ["RJ"])) == [(D3, 2.0, 1, 2.0, 2.0, 0.0)]
    assert rows(dashboard.headline_kpis(fct, ["XX"])) == [(None, None, 0, None, None, 0.0)]


def test_small_dashboard_pieces(spark):
    geo = spark.createDataFrame(
        [("SP", "x", 30, Decimal("1.00")), ("SP", "x", 20, Decimal("2.00")), ("SP", "y", 49, None)],
        "customer_state string, customer_city string, total_orders long, gmv decimal(38,2)",
    )
    assert rows(dashboard.city_min_volume(geo)) == [("SP", "x", 50, Decimal("3.00"))]
    scores = spark.createDataFrame([(0.8,), (0.6,), (0.3,), (0.29,), (None,)], "delay_risk_score double")
    assert [r[0] for r in rows(dashboard.risk_buckets(scores), "risk_bucket")] == ["High", "Low", "Low", "Medium", "Very High"]
    audit = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("c", None)], "feature_name string, drift_flag boolean")
    assert rows(dashboard.drift_flag_count(audit)) == [(1,)]
    assert dashboard.drift_flagged(audit).count() == 2
    briefs = spark.createDataFrame([(D1, "x"), (D2, "y"), (D2, "z")], "brief_date date, run_id string")
    assert rows(dashboard.latest_brief(briefs), "run_id") == [("y",), ("z",)]
    daily = spark.createDataFrame([(D1, 5)], "kpi_date date, total_orders long")
    forecast = spark.createDataFrame(
        [(D1, "SP", 2.0, "v1"), (D1, "SP", 3.0, "v1"), (D2, "SP", 1.0, "v1"), (D2, "RJ", 9.0, "v1"), (D2, "SP", 8.0, "v0")],
        "forecast_date date, customer_state string, predicted_orders_7d double, model_version string",
    )
    forecast = forecast.withColumn("scored_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert rows(dashboard.actual_vs_forecast(daily, forecast)) == [(D1, 5, 5.0), (D2, None, 1.0)]


def test_brief_with_one_day_and_with_nulls(spark):
    import json

    schema = "kpi_date date, total_orders long, gmv decimal(38,2), aov double, avg_review_score double, delayed_order_pct double"
    one = spark.createDataFrame([(D2, 4, Decimal("8.00"), 2.0, None, None)], schema)
    payload = json.loads(brief.brief_json(brief.brief_kpis(one)).first()["kpi_json"])
    assert payload == {
        "kpi_date": "2018-01-02", "orders_latest": 4.0, "orders_prev": 0.0, "gmv_latest": 8.0, "gmv_prev": 0.0,
        "aov_latest": 2.0, "aov_prev": 0.0, "review_latest": 0.0, "review_prev": 0.0, "delay_latest": 0.0, "delay_prev": 0.0,
    }
    two = one.union(spark.createDataFrame([(D1, 5, Decimal("8.00"), 1.6, 3.0, 10.0)], schema))
    moves = {r["kpi"]: r["verdict"] for r in brief.brief_movements(brief.brief_kpis(two)).collect()}
    assert moves == {
        "orders": "needs attention", "gmv": "unchanged", "aov": "improved", "review": "needs attention", "delay": "improved",
    }
    row = brief.client_daily_brief(two, run_id="r", today=D3, now=datetime(2018, 1, 5, 8)).first()
    assert row["ai_summary"] == "Improved: aov, delay. Needs attention: orders, review."
    assert (row["brief_date"], row["generated_at"], row["channel"], row["run_id"]) == (
        D3, datetime(2018, 1, 5, 8), "automated_pipeline", "r",
    )
