"""Dashboard calculations over marts, scores, registry and briefs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import kpis

# Defaults of the dashboard parameters.
LAST_N_DAYS = 60
MIN_CITY_ORDERS = 50
# The payment types of the data set.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
NO_PAYMENT = "no_payment"
FORECAST_STATE = "SP"


def latest(df: DataFrame, day: str) -> Column:
    """Newest day of the whole table as a scalar subquery: evaluated once, no join, no window."""
    return df.agg(F.max(day)).scalar()


def in_window(
    df: DataFrame, day: str = "kpi_date", last_n_days: int = LAST_N_DAYS, states: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the last n days up to the table's newest day, both ends included, optionally for some states."""
    rows = df.filter(F.col(day) >= F.date_sub(latest(df, day), last_n_days))
    return rows.filter(F.col("customer_state").isin(*states)) if states else rows


def latest_day_flag(exec_rows: DataFrame) -> DataFrame:
    top = latest(exec_rows, "kpi_date")
    return exec_rows.select(
        "kpi_date",
        "customer_state",
        (F.col("kpi_date") == top).alias("is_latest_day"),
        F.concat(F.lit("Data as of: "), top.cast("string")).alias("as_of_text"),
    )


def latest_delay_pct(exec_rows: DataFrame) -> DataFrame:
    """Delay share shown for the newest day only, 0 when unknown; NULL on other days."""
    shown = F.when(F.col("kpi_date") == latest(exec_rows, "kpi_date"), kpis.zero_if_null("delayed_order_pct"))
    return exec_rows.select("kpi_date", "customer_state", shown.alias("delayed_pct_display"))


def exec_dod_pct(exec_rows: DataFrame) -> DataFrame:
    """Five day-over-day ratios, given for the newest day only."""
    is_latest = F.col("kpi_date") == latest(exec_rows, "kpi_date")
    pairs = {
        "gmv": "prev_day_gmv",
        "total_orders": "prev_day_orders",
        "aov": "prev_day_aov",
        "delayed_order_pct": "prev_day_delayed_pct",
        "avg_review_score": "prev_day_avg_review_score",
    }
    return exec_rows.select(
        "kpi_date",
        "customer_state",
        *[F.when(is_latest, kpis.change_ratio(now, before)).alias(f"{now}_dod") for now, before in pairs.items()],
    )


def fct_gmv_dod(fct: DataFrame) -> DataFrame:
    """Percent difference of daily GMV along the order date, per state, straight from the fact."""
    daily = (
        fct.filter(F.col("order_date").isNotNull() & F.col("customer_state").isNotNull())
        .groupBy("customer_state", "order_date")
        .agg(F.sum("payment_total").alias("gmv"))
    )
    w = Window.partitionBy("customer_state").orderBy("order_date")
    return daily.withColumn("prev_gmv", F.lag("gmv").over(w)).withColumn(
        "gmv_dod", kpis.change_ratio("gmv", "prev_gmv")
    )


def headline_kpis(fct: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """KPIs of the newest order day of the whole fact, optionally for some states."""
    rows = fct.filter(F.col("order_date") == latest(fct, "order_date"))
    if states:
        rows = rows.filter(F.col("customer_state").isin(*states))
    n = F.count_distinct("order_id")
    amount = F.sum("payment_total").cast("double")
    return rows.agg(
        F.max("order_date").alias("order_date"),
        amount.alias("gmv"),
        n.alias("total_orders"),
        (amount / F.when(n != 0, n)).alias("aov"),
        F.avg("avg_review_score").alias("avg_review_score"),
        kpis.zero_if_null(kpis.delayed_pct()).alias("delayed_order_pct"),
    )


def top_states(
    exec_rows: DataFrame, n: int = 10, last_n_days: int = LAST_N_DAYS, states: Sequence[str] | None = None
) -> DataFrame:
    """The n states with the highest GMV in the window."""
    return (
        in_window(exec_rows, last_n_days=last_n_days, states=states)
        .groupBy("customer_state")
        .agg(F.sum("gmv").alias("gmv"), F.sum("total_orders").alias("total_orders"))
        .orderBy(F.desc("gmv"), F.asc("customer_state"))
        .limit(n)
    )


def national_strip(daily: DataFrame, last_n_days: int = LAST_N_DAYS) -> DataFrame:
    return in_window(daily, last_n_days=last_n_days)


def latest_brief(briefs: DataFrame) -> DataFrame:
    return briefs.filter(F.col("brief_date") == latest(briefs, "brief_date"))


def city_min_volume(geo: DataFrame, min_orders: int = MIN_CITY_ORDERS) -> DataFrame:
    """Cities that reach the order volume."""
    return (
        geo.groupBy("customer_state", "customer_city")
        .agg(F.sum("total_orders").alias("total_orders"), F.sum("gmv").alias("gmv"))
        .filter(F.col("total_orders") >= min_orders)
    )


def risk_buckets(scores: DataFrame) -> DataFrame:
    return scores.withColumn("risk_bucket", kpis.risk_bucket("delay_risk_score"))


def latest_run(scores: DataFrame) -> DataFrame:
    """Rows of the newest scoring run: the latest moment, then the highest version."""
    run = F.struct(F.coalesce("scored_at", F.lit("0001-01-01").cast("timestamp_ntz")).alias("at"), F.coalesce("model_version", F.lit("")).alias("v"))
    newest = scores.agg(F.max(run)).scalar()
    return scores.filter(run == newest)


def risk_heatmap(scores: DataFrame) -> DataFrame:
    scores = latest_run(scores)
    return scores.groupBy("customer_state", "payment_type").agg(F.avg("delay_risk_score").alias("avg_risk"))


def risk_heatmap_grid(scores: DataFrame, payment_types: Sequence[str] = PAYMENT_TYPES) -> DataFrame:
    """The heat map as a grid: a row per state, a column per payment type and one for orders without payment."""
    kinds = F.coalesce("payment_type", F.lit(NO_PAYMENT)).alias("payment_type")
    cells = latest_run(scores).select("customer_state", kinds, "delay_risk_score")
    return cells.groupBy("customer_state").pivot("payment_type", [*payment_types, NO_PAYMENT]).agg(F.avg("delay_risk_score"))


def forecast_by_state(forecast: DataFrame, state: str = FORECAST_STATE) -> DataFrame:
    return forecast.filter(F.col("customer_state") == state)


def actual_vs_forecast(daily: DataFrame, forecast: DataFrame, state: str = FORECAST_STATE) -> DataFrame:
    """National orders per day beside the chosen state's newest forecast, days of either side kept."""
    actual = daily.select(F.col("kpi_date").alias("day"), F.col("total_orders").alias("actual_orders"))
    predicted = (
        forecast_by_state(latest_run(forecast), state)
        .groupBy(F.col("forecast_date").alias("day"))
        .agg(F.sum("predicted_orders_7d").alias("predicted_orders_7d"))
    )
    return actual.join(predicted, "day", "full")


def champion_rows(registry: DataFrame, model_type: str) -> DataFrame:
    """All champion rows of a model type, as the registry table shows them."""
    return registry.filter((F.col("model_type") == model_type) & F.col("is_champion"))


def drift_flagged(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("drift_flag"))


def drift_flag_count(audit: DataFrame) -> DataFrame:
    return audit.agg(F.count_distinct(F.when(F.col("drift_flag"), F.col("feature_name"))).alias("drifted_features"))
