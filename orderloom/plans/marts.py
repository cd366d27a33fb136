"""Order fact and KPI marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import kpis


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum("price").alias("items_total"), F.sum("freight_value").alias("freight_total")
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_total"))


def review_scores(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("avg_review_score"))


def geo_dedup(geolocation: DataFrame) -> DataFrame:
    """One centroid per zip prefix."""
    return geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("geolocation_lat"), F.avg("geolocation_lng").alias("geolocation_lng")
    )


def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id", "left")


def customer_geo(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Customers with the centroid of their zip prefix.

    Joined at customer grain, so that the order stream is never shuffled on the
    zip prefix, where big cities would make hot partitions.
    """
    centroid = geo_dedup(geolocation).select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("geolocation_lat").alias("customer_lat"),
        F.col("geolocation_lng").alias("customer_lng"),
    )
    return customers.join(centroid, "customer_zip_code_prefix", "left")


def delay_flag() -> Column:
    """1 for a late order, 0 for one in time, NULL where a date is missing."""
    delivered, promised = F.col("order_delivered_customer_ts"), F.col("order_estimated_delivery_ts")
    return F.when(delivered.isNotNull() & promised.isNotNull(), (delivered > promised).cast("int"))


def fct_orders(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Order-grain fact.

    The three detail tables are summed per order before they are joined, so every
    right side is unique and the fact keeps the grain of the orders table. The
    order_id joins come last: the result stays hash-partitioned on order_id and
    distinct order counts over it need no further exchange of rows. Marts that
    use no column of a detail table lose that join in the optimizer, because an
    aggregate is known to be unique on its key.
    """
    customer = customer_geo(staging["customers"], staging["geolocation"])
    joined = (
        orders_with_customer(staging["orders"], customer)
        .join(item_totals(staging["order_items"]), "order_id", "left")
        .join(payment_totals(staging["payments"]), "order_id", "left")
        .join(review_scores(staging["reviews"]), "order_id", "left")
    )
    return joined.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_lat",
        "customer_lng",
        "order_status",
        "order_purchase_ts",
        "order_delivered_customer_ts",
        "order_estimated_delivery_ts",
        "items_total",
        "freight_total",
        "payment_total",
        "avg_review_score",
        delay_flag().alias("is_delayed"),
        F.col("order_purchase_ts").cast("date").alias("order_date"),
    )


def daily_kpi(fct: DataFrame) -> DataFrame:
    return (
        fct.filter(F.col("order_date").isNotNull())
        .groupBy(F.col("order_date").alias("kpi_date"))
        .agg(*kpis.day_kpis())
    )


def geo_kpi(fct: DataFrame) -> DataFrame:
    return (
        fct.filter(F.col("customer_lat").isNotNull() & F.col("customer_lng").isNotNull())
        .groupBy(
            "customer_state",
            "customer_city",
            F.round("customer_lat", 4).alias("customer_lat"),
            F.round("customer_lng", 4).alias("customer_lng"),
        )
        .agg(
            kpis.order_count().alias("total_orders"),
            F.sum("payment_total").alias("gmv"),
            kpis.delayed_pct().alias("delayed_order_pct"),
        )
    )


def customer_repeat_metrics(fct: DataFrame) -> DataFrame:
    per_customer = (
        fct.filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(kpis.order_count().alias("order_count"))
    )
    total, repeat = F.count(F.lit(1)), F.count_if(F.col("order_count") > 1)
    return per_customer.agg(
        total.alias("total_customers"),
        repeat.alias("repeat_customers"),
        F.when(total == 0, F.lit(0.0))
        .otherwise(repeat.cast("double") * 100.0 / F.when(total != 0, total))
        .alias("repeat_customer_pct"),
    )


def state_day_kpi(fct: DataFrame) -> DataFrame:
    return (
        fct.filter(F.col("order_date").isNotNull() & F.col("customer_state").isNotNull())
        .groupBy(F.col("order_date").alias("kpi_date"), "customer_state")
        .agg(*kpis.day_kpis())
    )


def exec_dashboard(fct: DataFrame) -> DataFrame:
    """Day by state KPIs with the state's previous row beside them.

    The window runs after the aggregate: one row per state and day, so its
    partitions are bounded by the calendar whatever the order volume.
    """
    w = Window.partitionBy("customer_state").orderBy("kpi_date")
    return state_day_kpi(fct).select(
        "*",
        F.lag("gmv").over(w).alias("prev_day_gmv"),
        F.lag("total_orders").over(w).alias("prev_day_orders"),
        F.lag("aov").over(w).alias("prev_day_aov"),
        F.lag("delayed_order_pct").over(w).alias("prev_day_delayed_pct"),
        F.lag("avg_review_score").over(w).alias("prev_day_avg_review_score"),
    )


def build_marts(fct: DataFrame) -> dict[str, DataFrame]:
    """KPI marts over a (preferably stored) fact table."""
    return {
        "daily_kpi": daily_kpi(fct),
        "geo_kpi": geo_kpi(fct),
        "customer_repeat_metrics": customer_repeat_metrics(fct),
        "exec_dashboard": exec_dashboard(fct),
    }
