"""Run time as an argument or from the session clock."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


def moment(at: datetime | None = None) -> Column:
    """Wall-clock timestamp in UTC: ``at`` if given, else the query's start time."""
    if at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if at.tzinfo:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
