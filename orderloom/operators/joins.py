"""Joins that survive a hot key on the many side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def fill_missing_keys(right: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``right`` plus one all-NULL row for every key it lacks.

    An inner join against the result equals a left join against ``right``.
    The difference is physical: a left outer join can only be split on its left
    side, an inner join on both, so one key holding a large share of ``right``
    no longer ends up in one task. The keys of ``right`` are made distinct
    before the anti join, hot ones collapse map-side.
    """
    known = right.select(on).distinct()
    missing = keys.filter(F.col(on).isNotNull()).join(known, on, "left_anti")
    return right.unionByName(missing, allowMissingColumns=True)


def left_join_details(left: DataFrame, on: str, *details: DataFrame) -> DataFrame:
    """Left join of several one-to-many tables on the same key, fan-out kept.

    Rows of ``left`` with a NULL key match nothing and bypass the shuffle.
    """
    keys = left.select(on).distinct()
    joined = left.filter(F.col(on).isNotNull())
    for right in details:
        joined = joined.join(fill_missing_keys(right, keys, on), on, "inner")
    unkeyed = left.filter(F.col(on).isNull())
    return joined.unionByName(unkeyed, allowMissingColumns=True)
