"""Daily KPI brief: newest day beside the day before."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schemas
from ..functions.clock import moment
from ..functions.kpis import zero_if_null

# (payload name, KPI column, higher is better)
_KPIS = [
    ("orders", "total_orders", True),
    ("gmv", "gmv", True),
    ("aov", "aov", True),
    ("review", "avg_review_score", True),
    ("delay", "delayed_order_pct", False),
]


def brief_kpis(daily: DataFrame) -> DataFrame:
    """One row with the newest day's KPIs and those of the day before, 0 for a missing value.

    Only two rows survive the top-2, so the window that pairs them is tiny.
    """
    newest = daily.orderBy(F.desc("kpi_date")).limit(2)
    w = Window.orderBy(F.desc("kpi_date"))
    paired = newest.select(
        F.col("kpi_date"),
        F.row_number().over(w).alias("_rn"),
        *[
            column
            for name, source, _ in _KPIS
            for column in (
                zero_if_null(source).alias(f"{name}_latest"),
                zero_if_null(F.lead(source).over(w)).alias(f"{name}_prev"),
            )
        ],
    )
    return paired.filter(F.col("_rn") == 1).drop("_rn")


def require_brief(kpis: DataFrame) -> DataFrame:
    """The same row; an error when there is no KPI day at all."""
    if kpis.isEmpty():
        raise ValueError("no daily KPI rows for the brief")
    return kpis


def _payload() -> Column:
    fields = [F.col("kpi_date").cast("string").alias("kpi_date")]
    fields += [F.col(f"{name}_{when}") for name, _, _ in _KPIS for when in ("latest", "prev")]
    return F.to_json(F.struct(*fields))


def brief_json(kpis: DataFrame) -> DataFrame:
    return kpis.select("kpi_date", _payload().alias("kpi_json"))


def _verdict(name: str, higher_is_better: bool) -> Column:
    change = F.col(f"{name}_latest") - F.col(f"{name}_prev")
    gain = change if higher_is_better else -change
    return F.when(gain > 0, "improved").when(gain < 0, "needs attention").otherwise("unchanged")


def brief_movements(kpis: DataFrame) -> DataFrame:
    """One row per KPI: change and whether it improved or needs attention."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("kpi"),
                F.col(f"{name}_latest").alias("latest"),
                F.col(f"{name}_prev").alias("previous"),
                (F.col(f"{name}_latest") - F.col(f"{name}_prev")).alias("change"),
                _verdict(name, better).alias("verdict"),
            )
            for name, _, better in _KPIS
        ]
    )
    return kpis.select("kpi_date", F.inline(rows))


def _summary() -> Column:
    def names(verdict: str) -> Column:
        listed = F.concat_ws(
            ", ", *[F.when(_verdict(name, better) == verdict, F.lit(name)) for name, _, better in _KPIS]
        )
        return F.when(listed != "", listed).otherwise("none")

    return F.concat(F.lit("Improved: "), names("improved"), F.lit(". Needs attention: "), names("needs attention"), F.lit("."))


def client_daily_brief(
    daily: DataFrame,
    run_id: str | None = None,
    channel: str = "automated_pipeline",
    today: date | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """The brief row to append; clock and run id can be given for repeatable runs."""
    row = brief_kpis(daily).select(
        (F.lit(today) if today else F.current_date()).cast("date").alias("brief_date"),
        moment(now).alias("generated_at"),
        _payload().alias("kpi_json"),
        _summary().alias("ai_summary"),
        F.lit(channel).alias("channel"),
        (F.lit(run_id) if run_id else F.expr("uuid()")).alias("run_id"),
    )
    return schemas.conform(row, schemas.OUTPUT["client_daily_brief"])


def with_variant(briefs: DataFrame) -> DataFrame:
    """Brief rows whose payload is a VARIANT column ``kpi`` in place of its text."""
    return briefs.select(*[F.parse_json("kpi_json").alias("kpi") if c == "kpi_json" else F.col(c) for c in briefs.columns])


def variant_fields(briefs: DataFrame) -> DataFrame:
    """The payload's fields with their types, read out of the VARIANT column; NULL for a missing one."""
    fields = [F.try_variant_get("kpi", "$.kpi_date", "date").alias("kpi_date")]
    fields += [
        F.try_variant_get("kpi", f"$.{name}_{when}", "double").alias(f"{name}_{when}")
        for name, _, _ in _KPIS
        for when in ("latest", "prev")
    ]
    return briefs.select(*[c for c in briefs.columns if c != "kpi"], *fields)
