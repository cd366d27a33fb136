"""Maps the star-schema parquet tables onto the order data set.

``typed_tables`` gives the eight staging tables, ``raw_tables`` the same rows as
all-text tables with some unreadable values, as they would arrive in files.
Values depend on keys only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Declared, so that opening a table starts no job; only the columns in use.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def files(sf_dir: str) -> list[str]:
    """Where the tables in use lie."""
    return [f"{sf_dir}/{name}.parquet" for name in _SCHEMAS]


class LazyTables(Mapping[str, DataFrame]):
    """Named frames, each built when it is first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = makers
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._makers[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def _add(unit: str, amount: str, ts: str) -> Column:
    return F.expr(f"timestampadd({unit}, {amount}, {ts})")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    o = o.withColumn("p", _add("second", "cast(o_orderkey * 37 % 86400 as int)", "o_orderdate"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.expr(
            "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end"
        ).alias("order_status"),
        F.col("p").alias("order_purchase_ts"),
        _add("hour", "1", "p").alias("order_approved_ts"),
        _add("day", "1", "p").alias("order_delivered_carrier_ts"),
        F.when(F.col("o_orderstatus") != "P", _add("day", "cast(3 + o_orderkey * 7 % 23 as int)", "p")).alias(
            "order_delivered_customer_ts"
        ),
        _add("day", "cast(10 + o_orderkey % 9 as int)", "o_orderdate").alias("order_estimated_delivery_ts"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_ts"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("freight_value"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both payment rows of an order come from one scan: an array of 0-2 structs.
    o = _read(spark, sf_dir, "orders")
    first = F.struct(
        F.lit(1).cast("bigint").alias("payment_sequential"),
        F.expr(
            "case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'boleto' "
            "when '3-MEDIUM' then 'voucher' else 'debit_card' end"
        ).alias("payment_type"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("payment_value"),
    )
    second = F.struct(
        F.lit(2).cast("bigint").alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit("10.00").cast("decimal(18,2)").alias("payment_value"),
    )
    rows = F.array_compact(
        F.array(
            F.when(F.col("o_orderkey") % 50 != 49, first),
            F.when(F.col("o_orderkey") % 4 == 0, second),
        )
    )
    return o.select("o_orderkey", F.explode(rows).alias("r")).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        "r.payment_sequential",
        "r.payment_type",
        (1 + F.col("o_orderkey") % 10).alias("payment_installments"),
        "r.payment_value",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").join(
        _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
        "c_nationkey",
        "left",
    )
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad((F.col("c_custkey") % 200).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.when(F.col("c_nationkey") != 24, F.col("n_name")).alias("customer_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").filter(F.col("c_custkey") % 20 != 0)
    c = c.join(
        _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
        "c_nationkey",
        "left",
    )
    return c.select(
        F.lpad((F.col("c_custkey") % 200).cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        (F.lit(-33.0) + (F.col("c_custkey") % 97).cast("double") / 64).alias("geolocation_lat"),
        (F.lit(-46.0) + (F.col("c_custkey") % 89).cast("double") / 64).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    scores = F.array_compact(
        F.array(
            F.when(key % 3 != 0, (1 + key * 13 % 5)),
            F.when(key % 10 == 0, (1 + key % 4)),
        )
    )
    return o.select(
        F.concat(F.lit("R"), key.cast("string")).alias("review_id"),
        key.cast("string").alias("order_id"),
        F.explode(scores).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.col("o_orderdate").cast("date").alias("review_creation_date"),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_ts"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("bigint")
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 41 != 0, F.col("p_type")).alias("product_category_name"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 20).alias("product_height_cm"),
        (size % 15).alias("product_width_cm"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").join(
        _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"),
        "s_nationkey",
        "left",
    )
    return s.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


_TABLES = {
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "customers": customers,
    "products": products,
    "reviews": reviews,
    "sellers": sellers,
    "geolocation": geolocation,
}


def typed_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables({name: (lambda make=make: make(spark, sf_dir)) for name, make in _TABLES.items()})


def _text(ts: str) -> Column:
    return F.col(ts).cast("string")


def _damage(value: Column, every: int, text: str, key: str = "order_id") -> Column:
    """Replace the value by unreadable text on every n-th key."""
    return F.when(F.col(key).cast("bigint") % every == 0, F.lit(text)).otherwise(value)


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The data set as text, before any cast."""
    t = typed_tables(spark, sf_dir)
    price = _damage(
        _damage(_damage(F.col("price").cast("string"), 83, "1.005"), 89, ""), 97, "n/a"
    )
    null_text = F.lit(None).cast("string")
    return LazyTables({
        "orders": lambda: t["orders"].select(
            "order_id",
            "customer_id",
            "order_status",
            _damage(_text("order_purchase_ts"), 79, "bad-date").alias("order_purchase_timestamp"),
            _damage(_text("order_approved_ts"), 71, "2017").alias("order_approved_at"),
            _text("order_delivered_carrier_ts").alias("order_delivered_carrier_date"),
            _damage(_text("order_delivered_customer_ts"), 73, "").alias("order_delivered_customer_date"),
            _text("order_estimated_delivery_ts").alias("order_estimated_delivery_date"),
        ),
        "order_items": lambda: t["order_items"].select(
            "order_id",
            _damage(F.col("order_item_id").cast("string"), 67, "1.7").alias("order_item_id"),
            "product_id",
            "seller_id",
            _damage(
                F.concat(F.col("shipping_limit_ts").cast("date").cast("string"), F.lit(" 10:56:33")), 79, "bad-date"
            ).alias("shipping_limit_date"),
            price.alias("price"),
            F.col("freight_value").cast("string").alias("freight_value"),
        ),
        "payments": lambda: t["payments"].select(
            "order_id",
            F.col("payment_sequential").cast("string").alias("payment_sequential"),
            "payment_type",
            _damage(F.col("payment_installments").cast("string"), 61, "many").alias("payment_installments"),
            _damage(F.col("payment_value").cast("string"), 97, "n/a").alias("payment_value"),
        ),
        "customers": lambda: t["customers"],
        "products": lambda: t["products"].select(
            "product_id",
            "product_category_name",
            F.length("product_category_name").cast("string").alias("product_name_lenght"),
            null_text.alias("product_description_lenght"),
            F.lit("1").alias("product_photos_qty"),
            _damage(F.col("product_weight_g").cast("string"), 59, "heavy", "product_id").alias("product_weight_g"),
            F.col("product_length_cm").cast("string").alias("product_length_cm"),
            F.col("product_height_cm").cast("string").alias("product_height_cm"),
            F.col("product_width_cm").cast("string").alias("product_width_cm"),
        ),
        "reviews": lambda: t["reviews"].select(
            "review_id",
            "order_id",
            _damage(F.col("review_score").cast("string"), 101, "five").alias("review_score"),
            "review_comment_title",
            "review_comment_message",
            _damage(F.col("review_creation_date").cast("string"), 103, "soon").alias("review_creation_date"),
            F.concat(F.col("review_creation_date").cast("string"), F.lit(" 08:30:00")).alias(
                "review_answer_timestamp"
            ),
        ),
        "sellers": lambda: t["sellers"],
        "geolocation": lambda: t["geolocation"].select(
            "geolocation_zip_code_prefix",
            _damage(F.col("geolocation_lat").cast("string"), 53, "south", "geolocation_zip_code_prefix").alias(
                "geolocation_lat"
            ),
            F.col("geolocation_lng").cast("string").alias("geolocation_lng"),
            "geolocation_city",
            "geolocation_state",
        ),
    })
