"""Feature tables for the demand and the delay model, and drift samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import left_join_details
from ..operators.ordering import capped_sample


def demand_base(fct: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Day by state by category. An order's payment and review count once per item row.

    Items are counted per order and category before they meet the fact, so an
    order or a product that fills much of the items table is reduced map-side;
    sums over item rows become products with that count.
    """
    per_order = (
        items.select("order_id", "product_id")
        .join(products.select("product_id", "product_category_name"), "product_id", "left")
        # Serves the grouping and the join with the fact: one shuffle for both.
        .repartition("order_id")
        .groupBy("order_id", "product_category_name")
        .agg(F.count(F.lit(1)).alias("_items"))
    )
    fact = fct.filter(F.col("order_date").isNotNull()).select(
        "order_id", F.col("order_date").alias("kpi_date"), "customer_state", "payment_total", "avg_review_score"
    )
    n = F.coalesce(F.col("_items"), F.lit(1))
    reviewed = F.when(F.col("avg_review_score").isNotNull(), n)
    return (
        fact.join(per_order, "order_id", "left")
        .groupBy(
            "kpi_date",
            "customer_state",
            F.coalesce("product_category_name", F.lit("unknown")).alias("product_category_name"),
        )
        .agg(
            F.count_distinct("order_id").alias("daily_orders"),
            F.sum((F.col("payment_total") * n.cast("decimal(10,0)"))).alias("daily_gmv"),
            (F.sum(F.col("avg_review_score") * n) / F.sum(reviewed)).alias("daily_review"),
        )
    )


def _demand_features(base: DataFrame) -> DataFrame:
    # One row per series and day: window partitions are bounded by the calendar.
    w = Window.partitionBy("customer_state", "product_category_name").orderBy("kpi_date")
    return base.select(
        "*",
        F.lag("daily_orders", 1).over(w).alias("lag_1_orders"),
        F.lag("daily_orders", 7).over(w).alias("lag_7_orders"),
        F.avg("daily_orders").over(w.rowsBetween(-7, -1)).alias("rolling_7_orders"),
        (F.dayofweek("kpi_date") - 1).alias("dow"),
        F.month("kpi_date").alias("month_num"),
        F.lead("daily_orders", 7).over(w).alias("target_orders_next_7d"),
    )


def demand_features_train(base: DataFrame) -> DataFrame:
    return _demand_features(base).filter(F.col("target_orders_next_7d").isNotNull())


def demand_features_scoring(base: DataFrame, from_full: bool = False) -> DataFrame:
    """Newest row of every series: of the training rows, or with ``from_full`` of all rows."""
    rows = _demand_features(base) if from_full else demand_features_train(base)
    newest = Window.partitionBy("customer_state", "product_category_name").orderBy(F.desc("kpi_date"))
    return (
        rows.withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") == 1)
        .select(
            F.col("kpi_date").alias("forecast_date"),
            "customer_state",
            "product_category_name",
            "daily_orders",
            "daily_gmv",
            "daily_review",
            "lag_1_orders",
            "lag_7_orders",
            "rolling_7_orders",
            "dow",
            "month_num",
        )
    )


def delay_features_train(
    fct: DataFrame, items: DataFrame, sellers: DataFrame, payments: DataFrame
) -> DataFrame:
    """Order by item by payment rows with the delay label (0 when unknown)."""
    fact = fct.filter(F.col("order_purchase_ts").isNotNull()).select(
        "order_id", "order_purchase_ts", "customer_state", "order_delivered_customer_ts", "is_delayed"
    )
    item_rows = (
        items.select("order_id", "seller_id", "price", "freight_value")
        .join(sellers.select("seller_id", "seller_state"), "seller_id", "left")
        .drop("seller_id")
    )
    rows = left_join_details(fact, "order_id", item_rows, payments.select("order_id", "payment_type"))
    zero = F.lit(0).cast("decimal(18,2)")
    return rows.select(
        "order_id",
        "order_purchase_ts",
        "customer_state",
        "seller_state",
        "payment_type",
        F.coalesce("price", zero).alias("item_price"),
        F.coalesce("freight_value", zero).alias("freight_value"),
        F.datediff("order_delivered_customer_ts", "order_purchase_ts").alias("delivery_days"),
        F.when(F.col("is_delayed") == 1, 1).otherwise(0).alias("is_delayed"),
    )


def delay_features_scoring(train: DataFrame) -> DataFrame:
    """One row per order; ties on the purchase time are broken by the remaining columns.

    The rank filter becomes a per-task top-1 before the shuffle, so an order with
    very many rows sends one row per task.
    """
    tie = ["seller_state", "payment_type", "item_price", "freight_value"]
    first = Window.partitionBy("order_id").orderBy(
        F.desc("order_purchase_ts"), *[F.col(c).asc_nulls_last() for c in tie]
    )
    return (
        train.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") == 1)
        .drop("_rn", "is_delayed")
    )


def drift_sample(payments: DataFrame, cap: int | None = None) -> DataFrame:
    """All known payment values, or a repeatable sample of ``cap`` of them."""
    known = payments.filter(F.col("payment_value").isNotNull())
    if cap is None:
        return known.select("payment_value")
    return capped_sample(known, ["order_id", "payment_sequential"], ["payment_value"], cap)
