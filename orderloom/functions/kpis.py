"""KPI formulas shared by marts, the dashboard and the brief."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def order_count(order_id: str = "order_id") -> Column:
    return F.count_distinct(order_id)


def gmv(amount: str = "payment_total") -> Column:
    return F.coalesce(F.sum(amount), F.lit(0))


def average_order_value(order_id: str = "order_id", amount: str = "payment_total") -> Column:
    n = order_count(order_id)
    return F.when(n == 0, F.lit(0.0)).otherwise(gmv(amount).cast("double") / n)


def delayed_pct(flag: str = "is_delayed") -> Column:
    """Share of late orders in percent; orders without a flag do not count."""
    return F.avg(F.col(flag).cast("double")) * 100


def day_kpis() -> list[Column]:
    """The five KPIs of every day-grain mart, in output order."""
    return [
        order_count().alias("total_orders"),
        gmv().alias("gmv"),
        average_order_value().alias("aov"),
        F.avg("avg_review_score").alias("avg_review_score"),
        delayed_pct().alias("delayed_order_pct"),
    ]


def zero_if_null(value: Column | str) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.coalesce(c.cast("double"), F.lit(0.0))


def change_ratio(current: str, previous: str) -> Column:
    """(current - previous) / previous, NULL when there is no usable previous value."""
    cur, prev = F.col(current).cast("double"), F.col(previous).cast("double")
    return F.when(prev.isNotNull() & (prev != 0), (cur - prev) / prev)


def risk_bucket(score: str = "delay_risk_score") -> Column:
    s = F.col(score)
    # Lower bounds of the buckets. A NULL score falls through to Low.
    return (
        F.when(s >= 0.8, "Very High").when(s >= 0.6, "High").when(s >= 0.3, "Medium").otherwise("Low")
    )
