"""Global order without a global sort in one task.

A running total over a total order is split in two: totals per bucket, where
buckets follow the order and their number is bounded, and a window inside each
bucket. Only bucket totals ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Parts that a column of numbers is dealt out in where its order matters.
EVEN_BUCKETS = 256


def running_total(
    df: DataFrame,
    weight: Column,
    bucket: Column,
    order: Sequence[Column],
    within: Sequence[str] = (),
    name: str = "before",
    grand_total: str | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows that come earlier.

    Rows are ordered by ``bucket``, then ``order``; totals restart for each
    combination of ``within``. ``bucket`` must be deterministic and its number
    of values bounded, and must not contradict ``order``. ``grand_total`` names a
    column for the sum over all rows. ``df`` is read twice; store it first when it
    is costly to compute.
    """
    # Keys that are never NULL: the window and the equi-join then ask for the same
    # partitioning, and the rows are shuffled once.
    keys = [f"_key{i}" for i in range(len(within) + 1)]
    rows = df.withColumn("_bucket", bucket).withColumn("_weight", weight.cast("bigint"))
    sources = [*within, "_bucket"]
    rows = rows.withColumns(
        {k: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("null")) for k, c in zip(keys, sources)}
    )
    groups = keys[:-1]
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        # By the bucket too, which its key stands for: a least text would have the rows sorted.
        rows.groupBy(*keys, "_bucket")
        .agg(F.sum("_weight").alias("_total"))
        .select(
            *keys,
            F.sum("_total").over(earlier).alias("_offset"),
            F.sum("_total").over(Window.partitionBy(*groups)).alias("_grand"),
        )
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.sum("_weight").over(inside))
    total = F.coalesce(F.col("_offset"), F.lit(0)) + F.coalesce(F.col("_local"), F.lit(0))
    extra = [F.col("_grand").alias(grand_total)] if grand_total else []
    return local.join(offsets, keys).select(*df.columns, total.cast("bigint").alias(name), *extra)


def with_even_bucket(df: DataFrame, column: str, name: str, buckets: int = EVEN_BUCKETS) -> DataFrame:
    """Add an order-preserving bucket of a number; each has about as many rows.

    The cuts are approximate quantiles of the values, so values crowded into a small
    range spread over as many buckets as any others. They only deal rows out; results
    do not depend on where they lie. The cuts, a fixed number, are fetched when the plan
    is made.
    """
    shares = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.agg(F.percentile_approx(column, shares, 10 * buckets)).first()[0] or []))
    if not cuts:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, F.size(F.filter(F.lit(cuts), lambda cut: cut <= F.col(column))))


def hash_text(*columns: str) -> Column:
    """Pseudo-random but repeatable sort key of a row's key columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def capped_sample(df: DataFrame, key: Sequence[str], values: Sequence[str], cap: int, digits: int = 5) -> DataFrame:
    """The ``cap`` rows that come first by (hash of key, key, values); all rows if there are fewer.

    A plain ``orderBy().limit(cap)`` would send ``cap`` rows of every input task
    to one task. Here counts per hash prefix (at most 16**digits) give the prefix
    at which the cap is reached, rows beyond it are dropped where they are read,
    and equal rows are counted before they are shuffled.
    """
    columns = [*key, *[v for v in values if v not in key]]
    rows = df.select(*columns, hash_text(*key).alias("_hash"))
    prefix = F.substring("_hash", 1, digits)
    upto = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        rows.groupBy(prefix.alias("_prefix"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_cum", F.sum("_n").over(upto))
        .filter(F.col("_cum") >= cap)
        .agg(F.min("_prefix"))
        .scalar()
    )
    order = [F.col(c).asc_nulls_first() for c in ("_hash", *columns)]
    first = (
        rows.filter(reached.isNull() | (prefix <= reached))
        .groupBy("_hash", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .orderBy(*order)
        .limit(cap)
    )
    before = F.coalesce(
        F.sum("_copies").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        first.withColumn("_before", before)
        .filter(F.col("_before") < cap)
        .withColumn("_take", F.least(F.col("_copies"), F.lit(cap) - F.col("_before")))
        .select(*values, F.explode(F.sequence(F.lit(1), F.col("_take"))).alias("_i"))
        .drop("_i")
    )
