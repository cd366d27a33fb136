"""Declared schemas of every table. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(18, 2),
    "ts": T.TimestampNTZType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns.items()])


def _text_table(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


# Column names of the input files are fixed values, misspellings included.
RAW = {
    "customers": _text_table(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ),
    "orders": _text_table(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "order_items": _text_table(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ),
    "payments": _text_table(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ),
    "products": _text_table(
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "reviews": _text_table(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ),
    "sellers": _text_table("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "geolocation": _text_table(
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state",
    ),
}

STAGING = {
    "orders": _table(
        order_id="string", customer_id="string", order_status="string", order_purchase_ts="ts",
        order_approved_ts="ts", order_delivered_carrier_ts="ts", order_delivered_customer_ts="ts",
        order_estimated_delivery_ts="ts",
    ),
    "order_items": _table(
        order_id="string", order_item_id="long", product_id="string", seller_id="string",
        shipping_limit_ts="ts", price="money", freight_value="money",
    ),
    "payments": _table(
        order_id="string", payment_sequential="long", payment_type="string", payment_installments="long",
        payment_value="money",
    ),
    "customers": _table(
        customer_id="string", customer_unique_id="string", customer_zip_code_prefix="string",
        customer_city="string", customer_state="string",
    ),
    "products": _table(
        product_id="string", product_category_name="string", product_weight_g="long",
        product_length_cm="long", product_height_cm="long", product_width_cm="long",
    ),
    "reviews": _table(
        review_id="string", order_id="string", review_score="long", review_comment_title="string",
        review_comment_message="string", review_creation_date="date", review_answer_ts="ts",
    ),
    "sellers": _table(
        seller_id="string", seller_zip_code_prefix="string", seller_city="string", seller_state="string",
    ),
    "geolocation": _table(
        geolocation_zip_code_prefix="string", geolocation_lat="double", geolocation_lng="double",
        geolocation_city="string", geolocation_state="string",
    ),
}

# Tables the engine appends to; 64-bit floats throughout.
OUTPUT = {
    "demand_forecast_daily": _table(
        forecast_date="date", customer_state="string", product_category_name="string",
        predicted_orders_7d="double", model_version="string", scored_at="ts",
    ),
    "delay_risk_scores": _table(
        order_id="string", order_purchase_ts="ts", customer_state="string", seller_state="string",
        payment_type="string", delay_risk_score="double", model_version="string", scored_at="ts",
    ),
    "model_registry": _table(
        model_type="string", model_resource_name="string", metric_name="string", metric_value="double",
        is_champion="bool", drift_score="double", updated_at="ts",
    ),
    "drift_audit": _table(run_ts="ts", feature_name="string", psi_score="double", drift_flag="bool"),
    "client_daily_brief": _table(
        brief_date="date", generated_at="ts", kpi_json="string", ai_summary="string", channel="string",
        run_id="string",
    ),
}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A typed, empty output table."""
    return spark.createDataFrame([], OUTPUT[name])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the declared columns; fail early on a missing column or another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"missing column {field.name}")
        if have[field.name] != field.dataType:
            raise ValueError(f"column {field.name} is {have[field.name]}, declared {field.dataType}")
    return df.select(*schema.names)
