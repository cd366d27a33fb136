"""Registered queries: every operator over the given parquet tables, and its check statement."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import STATEMENTS  # noqa: E402
from orderloom import schemas, session  # noqa: E402
from orderloom.functions import metrics  # noqa: E402
from orderloom.operators import changes, quantiles  # noqa: E402
from orderloom.plans import (  # noqa: E402
    boosting,
    brief,
    dashboard,
    features,
    marts,
    models,
    registry,
    splits,
    staging,
)
from orderloom.sources import csv_tables, sinks, star_tables  # noqa: E402
from orderloom.streaming import changes as change_streams, ledger, orders as order_streams  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_TS = datetime(2024, 1, 1)
STATE = "NATION_3"
# Model sizes of the registered queries but the validations, which have the library's, the full ones.
TREES, DEPTH = 5, 4
BOOSTED = boosting.Settings(trees=5, depth=3, rate=0.3, bins=16)
# Least number of files of one version of an arriving table, and the rows of a file at most.
FILES, FILE_ROWS = 2, 250_000

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double and small integers as bigint, the types both engines share."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            columns.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    """For sums of fractions, whose last bits depend on the order of addition.

    Percentage errors are rounded to 6 digits: their floor of 1e-8 makes exact
    halves at the ninth digit common.
    """
    return df.withColumn(column, F.round(F.col(column).cast("double"), digits))


def _two_runs(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Both runs with version and time; versions compare against the order of the times."""
    runs = [("v9", RUN_TS, older), ("v10", RUN_TS + timedelta(days=1), newer)]
    first, second = (
        df.withColumns({"model_version": F.lit(v), "scored_at": F.lit(at).cast("timestamp_ntz")}) for v, at, df in runs
    )
    return first.unionByName(second)


class Tables:
    """The intermediate frames that queries share, as lazy plans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.configure(spark)
        session.size_shuffles(spark, *star_tables.files(sf_dir))
        self.sf_dir = sf_dir
        self.stg = star_tables.typed_tables(spark, sf_dir)

    @property
    def raw(self) -> dict[str, DataFrame]:
        return star_tables.raw_tables(self.spark, self.sf_dir)

    @property
    def fct(self) -> DataFrame:
        return marts.fct_orders(self.stg)

    @property
    def daily(self) -> DataFrame:
        return marts.daily_kpi(self.fct)

    @property
    def exec(self) -> DataFrame:
        return marts.exec_dashboard(self.fct)

    @property
    def demand_base(self) -> DataFrame:
        return features.demand_base(self.fct, self.stg["order_items"], self.stg["products"])

    @property
    def demand_train(self) -> DataFrame:
        return features.demand_features_train(self.demand_base)

    @property
    def demand_scoring(self) -> DataFrame:
        return features.demand_features_scoring(self.demand_base)

    @cached_property
    def demand_base_stored(self) -> DataFrame:
        """For queries that read it several times: the joins and sums over all orders are done once."""
        return sinks.stored(self.demand_base, "demand-base")

    @cached_property
    def demand_train_stored(self) -> DataFrame:
        return sinks.stored(features.demand_features_train(self.demand_base_stored), "demand-train")

    @property
    def demand_scoring_stored(self) -> DataFrame:
        return features.demand_features_scoring(self.demand_base_stored)

    @property
    def delay_train(self) -> DataFrame:
        s = self.stg
        return features.delay_features_train(self.fct, s["order_items"], s["sellers"], s["payments"])

    @property
    def delay_scoring(self) -> DataFrame:
        return features.delay_features_scoring(self.delay_train)

    @property
    def risk(self) -> DataFrame:
        """A score made of the order id, so that the dashboard can be checked without a model."""
        score = (F.col("order_id").cast("bigint") * 7 % 101).cast("double") / 100
        return self.delay_scoring.select(
            "order_id", "order_purchase_ts", "customer_state", "seller_state", "payment_type", score.alias("delay_risk_score")
        )

    @property
    def forecast(self) -> DataFrame:
        return self.demand_scoring.select(
            "forecast_date",
            "customer_state",
            "product_category_name",
            F.col("lag_7_orders").cast("double").alias("predicted_orders_7d"),
        )

    @property
    def risk_runs(self) -> DataFrame:
        """Two scoring runs; the older one has other scores."""
        half = (F.col("delay_risk_score") / 2).alias("delay_risk_score")
        names = [c for c in self.risk.columns if c != "delay_risk_score"]
        return _two_runs(self.risk.select(*names, half), self.risk)

    @property
    def forecast_runs(self) -> DataFrame:
        more = (F.col("predicted_orders_7d") + 1).alias("predicted_orders_7d")
        names = [c for c in self.forecast.columns if c != "predicted_orders_7d"]
        return _two_runs(self.forecast.select(*names, more), self.forecast)

    # ------------------------------------------------------------------- drift inputs

    def _by_period(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows before and from 1998 on; a row without a time belongs to the later period."""
        early = F.coalesce(F.col("order_purchase_ts") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))
        return rows.filter(early), rows.filter(~early)

    @property
    def payment_periods(self) -> tuple[DataFrame, DataFrame]:
        when = self.stg["orders"].select("order_id", "order_purchase_ts")
        return self._by_period(self.stg["payments"].join(when, "order_id"))

    @cached_property
    def drift(self) -> DataFrame:
        return sinks.stored(registry.drift_score(*self.payment_periods), "drift")

    @property
    def audit(self) -> DataFrame:
        when = self.stg["orders"].select("order_id", "order_purchase_ts")
        prices = self._by_period(self.stg["order_items"].join(when, "order_id"))
        days = self._by_period(
            when.withColumn("day", F.datediff("order_purchase_ts", F.lit("1995-01-01").cast("date")))
        )
        rows = registry.drift_audit(self.drift, RUN_TS)
        rows = rows.unionByName(registry.drift_audit(registry.drift_score(*prices, "price"), RUN_TS, "item_price"))
        return rows.unionByName(registry.drift_audit(registry.drift_score(*days, "day"), RUN_TS, "purchase_day"))

    # ---------------------------------------------------------------- registry inputs

    @cached_property
    def monthly_scores(self) -> DataFrame:
        """A score per model type and month, taken from the data and stored once."""
        naive = models.naive_forecast(self.demand_train)
        forecast = naive.groupBy(F.date_format("kpi_date", "yyyy-MM").alias("month")).agg(
            F.round(metrics.mape("target_orders_next_7d", "prediction"), 6).alias("metric_value")
        )
        on_time = (
            self.fct.filter(F.col("order_date").isNotNull())
            .groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
            .agg(F.round(1 - F.avg(F.col("is_delayed").cast("double")), 6).alias("metric_value"))
        )
        scores = forecast.select(F.lit("forecast").alias("model_type"), "*").unionByName(
            on_time.select(F.lit("delay_risk").alias("model_type"), "*")
        )
        return sinks.stored(scores, "monthly-scores")

    @property
    def registry(self) -> DataFrame:
        scores = self.monthly_scores
        rows = scores.filter(F.col("month") < scores.agg(F.max("month")).scalar()).select(
            "model_type",
            F.concat_ws("-", "model_type", "month").alias("model_resource_name"),
            F.when(F.col("model_type") == "forecast", "MAPE").otherwise("ROC_AUC").alias("metric_name"),
            "metric_value",
            F.col("month").endswith("-06").alias("is_champion"),
            F.lit(0.0).alias("drift_score"),
            F.concat("month", F.lit("-01")).cast("timestamp_ntz").alias("updated_at"),
        )
        return schemas.conform(rows, schemas.OUTPUT["model_registry"])

    @property
    def challengers(self) -> DataFrame:
        newest = self.monthly_scores.groupBy("model_type").agg(F.max(F.struct("month", "metric_value")).alias("n"))
        return newest.select(
            "model_type",
            F.concat_ws("-", "model_type", "n.month").alias("model_resource_name"),
            F.col("n.metric_value").alias("metric_value"),
        )

    # ------------------------------------------------------------------- written inputs

    def path(self, name: str) -> str:
        return session.scratch_path(self.spark, name)

    def csv_dir(self) -> str:
        directory = self.path("csv")
        for table, df in self.raw.items():
            csv_tables.write_csv(df, f"{directory}/{csv_tables.FILES[table]}")
        return directory

    def raw_order_files(self, files: int) -> str:
        directory = self.path("arriving")
        self.raw["orders"].repartition(files, "order_id").write.parquet(directory)
        return directory

    @property
    def order_text(self) -> DataFrame:
        """Readable orders as text rows."""
        ts = {
            "order_purchase_ts": "order_purchase_timestamp",
            "order_approved_ts": "order_approved_at",
            "order_delivered_carrier_ts": "order_delivered_carrier_date",
            "order_delivered_customer_ts": "order_delivered_customer_date",
            "order_estimated_delivery_ts": "order_estimated_delivery_date",
        }
        return self.stg["orders"].select(
            "order_id", "customer_id", "order_status", *[F.col(c).cast("string").alias(n) for c, n in ts.items()]
        )

    def order_lines(self, files: int) -> str:
        """Orders as lines of text; some are cut short, some too long, some have a quote that never ends."""
        key = F.col("order_id").cast("bigint")
        columns = schemas.RAW["orders"].names
        whole = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in columns])
        line = (
            F.when(key % 17 == 0, F.concat_ws(",", "order_id", "customer_id"))
            .when(key % 19 == 0, F.concat_ws(",", "order_id", "customer_id", "order_status", *[F.lit(x) for x in "abcdef"]))
            .when(key % 23 == 0, F.concat_ws(",", "order_id", "customer_id", F.lit('"open')))
            .otherwise(whole)
        )
        directory = self.path("csv-lines")
        lines = self.raw["orders"].select(line.alias(",".join(columns))).repartition(files)
        lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(directory)
        return directory

    def typed_text(self, table: str) -> DataFrame:
        """A typed detail table as text rows."""
        names = schemas.RAW[table].names
        known = self.stg[table]
        return known.select(
            *[(F.col(n).cast("string") if n in known.columns else F.lit(None).cast("string")).alias(n) for n in names]
        )

    def change_stream(self, name: str, versions: list[DataFrame]) -> DataFrame:
        """Change rows that arrive version by version, each in one micro-batch.

        A version is as many files as the largest one needs, so that no task writes or reads
        a large share of it.
        """
        directory = self.path(f"arriving-{name}")
        files = max(FILES, *[-(-rows.count() // FILE_ROWS) for rows in versions])
        for version, rows in enumerate(versions, 1):
            if "action" not in rows.columns:
                rows = rows.withColumns({"action": F.lit("INSERT"), "is_update": F.lit(False)})
            change_streams.publish(rows.repartition(files), directory, version)
        return change_streams.read_feed(self.spark, directory, schemas.RAW[name], files)

    def briefs(self, rows: DataFrame) -> DataFrame:
        """One brief row per KPI day."""
        return rows.select(
            F.col("kpi_date").alias("brief_date"),
            F.col("kpi_date").cast("timestamp_ntz").alias("generated_at"),
            F.to_json(F.struct("total_orders")).alias("kpi_json"),
            F.lit("").alias("ai_summary"),
            F.lit("automated_pipeline").alias("channel"),
            F.concat(F.lit("run-"), F.col("kpi_date").cast("string")).alias("run_id"),
        )


# ------------------------------------------------------------------ multi-step queries


def _rejects(rejected: DataFrame) -> DataFrame:
    """Rejects with their place; the generated part of the file's name differs from run to run."""
    written = F.col("file_name").rlike("^part-[0-9]+-.*[.]csv$").alias("in_written_file")
    return rejected.select("first_field", "line", "reason", written, "block_start")


def _csv_rejects(t: Tables) -> DataFrame:
    return _rejects(csv_tables.rejected_rows(csv_tables.parse_csv(t.spark, "orders", t.order_lines(4)), "orders"))


def _full_refresh(t: Tables) -> DataFrame:
    path = t.path("daily-kpi")
    daily = t.daily
    sinks.full_refresh(daily.filter(F.col("total_orders") > 1), path)
    return sinks.full_refresh(daily, path)


def _append(t: Tables) -> DataFrame:
    path, schema = t.path("briefs"), schemas.OUTPUT["client_daily_brief"]
    briefs = t.briefs(t.daily)
    early = F.col("brief_date") < F.lit("1998-01-01").cast("date")
    sinks.append(briefs.filter(early), path, schema)
    return sinks.append(briefs.filter(~early), path, schema)


def _registry_promote(t: Tables) -> DataFrame:
    path = t.path("registry")
    sinks.full_refresh(t.registry, path)
    old = sinks.read_latest_or_empty(t.spark, path, "model_registry")
    sinks.full_refresh(registry.promote(old, t.challengers, t.drift, RUN_TS), path)
    return _rounded(sinks.read_latest_or_empty(t.spark, path, "model_registry"), "drift_score", 9)


def _score_to_beat(t: Tables) -> DataFrame:
    """With champions of one type only, so that the other one shows its default."""
    known = t.registry.filter("model_type = 'forecast'")
    return registry.decide(known, t.challengers, t.drift).select("model_type", "metric_to_beat")


def _brief_json(t: Tables) -> DataFrame:
    """The payload read back into typed columns."""
    row = brief.brief_kpis(t.daily)
    fields = ", ".join(f"{c} {'date' if c == 'kpi_date' else 'double'}" for c in row.columns)
    return brief.brief_json(row).select(F.from_json("kpi_json", fields).alias("k")).select("k.*")


def _client_brief(t: Tables) -> DataFrame:
    """The stored row with fixed clock and run id, its payload read back in part."""
    row = brief.client_daily_brief(t.daily, run_id="run-1", today=date(2024, 1, 1), now=RUN_TS)
    payload = F.from_json("kpi_json", "kpi_date date, orders_latest double, gmv_latest double")
    return row.withColumn("k", payload).select("brief_date", "generated_at", "channel", "run_id", "ai_summary", "k.*")


def _brief_variant(t: Tables) -> DataFrame:
    """The payload stored as VARIANT and its fields read back with their types."""
    row = brief.client_daily_brief(t.daily, run_id="run-1", today=date(2024, 1, 1), now=RUN_TS)
    kept = sinks.stored(brief.with_variant(row), "brief-variant")
    return brief.variant_fields(kept).drop("ai_summary")


def _heatmap_grid(t: Tables) -> DataFrame:
    grid = dashboard.risk_heatmap_grid(t.risk_runs)
    return grid.select("customer_state", *[F.round(c, 12).alias(c) for c in grid.columns[1:]])


def _loaded_columns(t: Tables) -> DataFrame:
    """Every column of all eight loads in long form: filled rows, distinct values, least and greatest."""
    tables = csv_tables.load_raw(t.spark, t.csv_dir())
    found = None
    for name, df in tables.items():
        for c in df.columns:
            # Values first: counted by hash, where least and greatest of all rows would sort them.
            values = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            rows = values.agg(
                F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
                F.count("value").alias("distinct_values"),
                F.min("value").alias("least"),
                F.max("value").alias("greatest"),
            ).select(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), "*")
            found = rows if found is None else found.unionByName(rows)
    return found


def _time_series_folds(t: Tables) -> DataFrame:
    indexed = sinks.stored(splits.time_index(sinks.stored(t.demand_train, "demand-train")), "time-index")
    return splits.time_series_folds(indexed, splits.time_fold_plan(indexed.count())).withColumns(
        {c: F.col(c).cast("double") for c in ("train_target", "validation_target")}
    )


def _fold_mean(t: Tables) -> DataFrame:
    indexed = sinks.stored(models.naive_forecast(splits.time_index(sinks.stored(t.demand_train, "demand-train"))), "time-index")
    folds = splits.time_fold_plan(indexed.count())
    i = F.col("row_index")
    fold = F.lit(None)
    for f in folds:
        fold = F.when((i >= f.start) & (i < f.end), f.fold).otherwise(fold)
    scores = (
        indexed.withColumn("fold", fold)
        .filter(F.col("fold").isNotNull())
        .groupBy("fold")
        .agg(metrics.mape("target_orders_next_7d", "prediction").alias("score"))
    )
    return _rounded(metrics.fold_mean(scores), "metric_value", 6)


def _auc(t: Tables) -> DataFrame:
    o = t.spark.read.parquet(f"{t.sf_dir}/orders.parquet").select(
        (F.col("o_totalprice") - F.col("o_totalprice") % 1000).alias("s"), (F.col("o_orderstatus") == "F").alias("y")
    )
    return _rounded(metrics.roc_auc(o, "s", "y"), "roc_auc", 12)


def _psi_histogram(t: Tables) -> DataFrame:
    baseline, current = t.payment_periods
    cuts = quantiles.decile_cuts(baseline, "payment_value")
    e = quantiles.histogram(baseline, "payment_value", cuts).withColumnRenamed("n", "baseline_rows")
    a = quantiles.histogram(current, "payment_value", cuts).withColumnRenamed("n", "current_rows")
    return e.join(a, "bin", "full").select(
        F.col("bin"),
        F.coalesce("baseline_rows", F.lit(0)).alias("baseline_rows"),
        F.coalesce("current_rows", F.lit(0)).alias("current_rows"),
    )


def _change_feed(t: Tables) -> DataFrame:
    key = F.col("order_id").cast("bigint")
    rows = t.stg["orders"].select("order_id", "customer_id", "order_status", "order_purchase_ts")
    new = rows.filter(key % 13 != 0).withColumn(
        "order_status", F.when(key % 7 == 0, "X").otherwise(F.col("order_status"))
    )
    return changes.change_feed(rows.filter(key % 11 != 0), new, "order_id")


def _stream_staging(t: Tables) -> DataFrame:
    out = t.path("stg-orders")
    raw = order_streams.arriving_orders(t.spark, t.raw_order_files(4))
    order_streams.stream_staging(raw, out, t.path("stream-state")).awaitTermination()
    return t.spark.read.schema(schemas.STAGING["orders"]).parquet(out)


def _stream_text(t: Tables, output: str) -> DataFrame:
    """Text that arrives in three batches; readable rows or rejects."""
    paths = {"good": t.path("orders-good"), "rejects": t.path("orders-rejects")}
    arriving = order_streams.arriving_text(t.spark, "orders", t.order_lines(3), files_per_batch=1)
    order_streams.stream_text("orders", arriving, checkpoint=t.path("stream-state"), **paths).awaitTermination()
    found = t.spark.read.parquet(paths[output]).drop("batch_id")
    return found if output == "good" else _rejects(found)


def _feed_consumed(t: Tables) -> DataFrame:
    """A table with copies and NULLs that follows two versions of a feed."""
    key = F.col("order_id").cast("bigint")
    rows = t.stg["orders"].select("order_id", "customer_id", "order_status", "order_purchase_ts")
    rows = rows.withColumn("order_status", F.when(key % 9 != 0, F.col("order_status")))
    rows = rows.unionByName(rows.filter(key % 5 == 0))
    middle = rows.filter(key % 11 != 0)
    new = rows.filter(key % 13 != 0).withColumn("order_status", F.when(key % 7 != 0, F.col("order_status")))
    feed, path = t.path("feed"), t.path("followed")
    change_streams.publish(changes.change_feed(rows, middle, "order_id"), feed, 1)
    change_streams.publish(changes.change_feed(middle, new, "order_id"), feed, 2)
    change_streams.start_table(rows, path)
    arriving = change_streams.read_feed(t.spark, feed, rows.schema)
    change_streams.follow(arriving, path, rows.schema, t.path("stream-state")).awaitTermination()
    return change_streams.current_table(t.spark, path, rows.schema)


def _ledger_kpis(t: Tables, orders: DataFrame, details: dict[str, DataFrame]) -> DataFrame:
    kpis = t.path("kpis")
    ledger.stream_ledger(orders, details, t.path("ledger"), kpis, t.path("stream-state")).awaitTermination()
    return ledger.current_kpis(t.spark, kpis)


def _halves(rows: DataFrame) -> list[DataFrame]:
    late = F.crc32(F.col("order_id").cast("binary")) % 2 == 0
    return [rows.filter(~late), rows.filter(late)]


def _daily_incremental(t: Tables) -> DataFrame:
    """Orders and details in two batches, cut alike."""
    streams = {n: t.change_stream(n, _halves(t.typed_text(n))) for n in ("order_items", "payments", "reviews")}
    return _ledger_kpis(t, t.change_stream("orders", _halves(t.order_text)), streams)


def _daily_corrected(t: Tables) -> DataFrame:
    """Orders that move to another day, change, arrive again or are cancelled, and payments that
    come two batches after their order or are corrected."""
    key = F.col("order_id").cast("bigint")
    final = t.order_text
    purchase, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    first = final.withColumns({
        "order_purchase_timestamp": F.when(
            key % 7 == 0, (purchase.cast("timestamp_ntz") - F.expr("interval 40 days")).cast("string")
        ).otherwise(purchase),
        "order_delivered_customer_date": F.when(key % 5 != 0, delivered),
    })
    cancelled = changes.change_feed(final, final.filter(key % 13 != 0), "order_id")
    again = final.filter((key % 11 == 0) & (key % 13 != 0))
    again = again.withColumns({"action": F.lit("INSERT"), "is_update": F.lit(False)})
    orders = [first, changes.change_feed(first, final, "order_id"), cancelled.unionByName(again)]
    payments = t.typed_text("payments")
    value = F.col("payment_value")
    wrong = payments.withColumn(
        "payment_value", F.when(key % 17 == 0, (value.cast("decimal(18,2)") + 1).cast("string")).otherwise(value)
    )
    early, second = key % 3 == 0, F.col("payment_sequential") == "2"
    corrected = changes.change_feed(wrong.filter(early & ~second), payments.filter(early & ~second), "order_id")
    late = payments.filter(~early & ~second).withColumns({"action": F.lit("INSERT"), "is_update": F.lit(False)})
    streams = {
        "order_items": t.change_stream("order_items", [t.typed_text("order_items")]),
        "payments": t.change_stream("payments", [wrong.filter(early & ~second), payments.filter(second), late.unionByName(corrected)]),
        "reviews": t.change_stream("reviews", _halves(t.typed_text("reviews"))),
    }
    return _ledger_kpis(t, t.change_stream("orders", orders), streams)


def _forecast_cv(t: Tables) -> DataFrame:
    """Sizes of the folds, whether the score is a usable error, and whether the model beats guessing 0.

    With the library's number and depth of trees.
    """
    scores = models.train_forecast(t.demand_train_stored)[1]
    score = F.col("score")
    return scores.select(
        "fold", "train_rows", "validation_rows", (score > 0).alias("is_error"), (score < 1).alias("better_than_nothing")
    )


def _delay_cv(t: Tables) -> DataFrame:
    """With the library's number and depth of trees, as the final model has them."""
    scores = models.train_delay(t.delay_train)[1]
    return scores.select("fold", ((F.col("score") > 0.5) & (F.col("score") <= 1)).alias("better_than_chance"))


def _forecast_scores(t: Tables) -> DataFrame:
    """Keys, version and whether the forecast is a possible number of orders."""
    model, _ = models.train_forecast(t.demand_train_stored, TREES, DEPTH)
    most = t.demand_train_stored.agg(F.max("target_orders_next_7d")).scalar()
    scores = models.score_demand(model, t.demand_scoring_stored, "v1", RUN_TS)
    possible = (F.col("predicted_orders_7d") >= 0) & (F.col("predicted_orders_7d") <= most)
    return scores.withColumn("predicted_orders_7d", possible).withColumnRenamed("predicted_orders_7d", "is_possible")


def _delay_scores(t: Tables) -> DataFrame:
    model, _ = models.train_delay(t.delay_train, TREES, DEPTH)
    scores = models.score_delay(model, t.delay_scoring, "v1", RUN_TS)
    share = F.col("delay_risk_score").between(0, 1)
    return scores.withColumn("delay_risk_score", share).withColumnRenamed("delay_risk_score", "is_share")


def _model_roundtrip(t: Tables) -> DataFrame:
    """Predictions that a stored model makes differently from the one that was stored."""
    path, train = t.path("model"), t.demand_train_stored
    model, _ = models.train_forecast(train, TREES, DEPTH)
    models.save_model(model, path, train)
    scoring = sinks.stored(t.demand_scoring_stored, "demand-scoring")
    return models.differing_predictions(model, models.load_model(t.spark, path, scoring), scoring)


def _boosted_tree(t: Tables) -> DataFrame:
    """The splits and leaves of one second-order tree; from 1, so that the gradients are whole numbers."""
    sizes = boosting.Settings(trees=1, depth=2, rate=1.0, rows=1.0, columns=1.0, bins=16, base=1.0)
    train = sinks.stored(t.demand_train, "demand-train")
    model = boosting.train(train, models.DEMAND_FEATURES, models.DEMAND_TARGET, sizes)
    nodes = t.spark.createDataFrame(boosting.splits_of(model), "node long, feature string, bin long, value double")
    return _rounded(nodes, "value", 6)


def _boosted_forecast(t: Tables) -> DataFrame:
    """A boosted model of the last time fold beside the naive forecast."""
    indexed = sinks.stored(splits.time_index(sinks.stored(t.demand_train, "demand-train")), "time-index")
    fold = splits.time_fold_plan(indexed.count())[-1]
    part, held_out = splits.time_fold_rows(indexed, fold)
    model = boosting.train(part, models.DEMAND_FEATURES, models.DEMAND_TARGET, BOOSTED)
    both = models.naive_forecast(boosting.predict(model, held_out, "boosted"))
    own, naive = (metrics.mape(models.DEMAND_TARGET, c) for c in ("boosted", "prediction"))
    return both.agg(F.count("*").alias("validation_rows"), (own < naive).alias("better_than_naive"))


def _stg(table: str) -> Callable[[Tables], DataFrame]:
    return lambda t: staging.stage(table, t.raw[table])


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "raw_csv_load_columns": _loaded_columns,
    "raw_csv_load": lambda t: csv_tables.load_raw(t.spark, t.csv_dir())["order_items"],
    "csv_rejects": _csv_rejects,
    "table_counts": lambda t: staging.table_counts(csv_tables.load_raw(t.spark, t.csv_dir())),
    "full_refresh_roundtrip": _full_refresh,
    "append_roundtrip": _append,
    **{f"stg_{table}": _stg(table) for table in schemas.STAGING},
    "cast_failures": lambda t: staging.cast_failures(t.raw),
    "orders_with_customer": lambda t: marts.orders_with_customer(t.stg["orders"], t.stg["customers"]),
    "customer_geo": lambda t: marts.customer_geo(t.stg["customers"], t.stg["geolocation"]),
    "item_totals": lambda t: marts.item_totals(t.stg["order_items"]),
    "payment_totals": lambda t: marts.payment_totals(t.stg["payments"]),
    "review_scores": lambda t: marts.review_scores(t.stg["reviews"]),
    "geo_dedup": lambda t: marts.geo_dedup(t.stg["geolocation"]),
    "fct_orders": lambda t: t.fct,
    "daily_kpi": lambda t: t.daily,
    "geo_kpi": lambda t: marts.geo_kpi(t.fct),
    "customer_repeat_metrics": lambda t: marts.customer_repeat_metrics(t.fct),
    "exec_dashboard": lambda t: t.exec,
    "demand_base": lambda t: t.demand_base,
    "demand_features_train": lambda t: t.demand_train,
    "demand_features_scoring": lambda t: t.demand_scoring,
    "delay_features_train": lambda t: t.delay_train,
    "delay_features_scoring": lambda t: t.delay_scoring,
    "drift_samples": lambda t: features.drift_sample(t.stg["payments"]),
    "drift_samples_capped": lambda t: features.drift_sample(t.stg["payments"], cap=1000),
    "demand_matrix": lambda t: models.demand_matrix(t.demand_train),
    "delay_matrix": lambda t: models.delay_matrix(t.delay_train),
    "time_index": lambda t: splits.time_index(sinks.stored(t.demand_train, "demand-train")).select(
        "kpi_date", "customer_state", "product_category_name", "row_index"
    ),
    "time_series_folds": _time_series_folds,
    "stratified_folds": lambda t: splits.stratified_folds(t.delay_train),
    "fold_class_check": lambda t: splits.fold_class_counts(splits.stratified_folds(t.delay_train)),
    "metric_mape": lambda t: models.naive_forecast(t.demand_train)
    .groupBy("customer_state")
    .agg(F.round(metrics.mape("target_orders_next_7d", "prediction"), 6).alias("mape")),
    "metric_fold_mean": _fold_mean,
    "metric_auc": _auc,
    "delay_matrix_encoded": lambda t: models.matrix_cells(models.delay_matrix_encoded(t.delay_train)),
    "forecast_cv": _forecast_cv,
    "delay_cv": _delay_cv,
    "model_roundtrip": _model_roundtrip,
    "demand_forecast_daily": _forecast_scores,
    "boosted_tree": _boosted_tree,
    "boosted_forecast": _boosted_forecast,
    "delay_risk_scores": _delay_scores,
    "psi_cuts": lambda t: _rounded(
        quantiles.decile_cuts(t.payment_periods[0], "payment_value").select(F.explode("cuts").alias("cut")), "cut", 6
    ),
    "psi_histogram": _psi_histogram,
    "drift_psi": lambda t: _rounded(t.drift.select("psi_score"), "psi_score", 12),
    "drift_flag": lambda t: t.audit.select("feature_name", "drift_flag"),
    "drift_audit": lambda t: _rounded(t.audit, "psi_score", 9),
    "drift_flag_count": lambda t: dashboard.drift_flag_count(t.audit),
    "registry_champions": lambda t: registry.champions(t.registry),
    "champion_rows": lambda t: dashboard.champion_rows(t.registry, "forecast"),
    "drift_flagged": lambda t: _rounded(dashboard.drift_flagged(t.audit), "psi_score", 9),
    "score_to_beat": _score_to_beat,
    "registry_promote": _registry_promote,
    "registry_result": lambda t: registry.resulting_champions(t.registry, t.challengers, t.drift),
    "brief_kpis": lambda t: brief.brief_kpis(t.daily),
    "brief_json": _brief_json,
    "brief_variant": _brief_variant,
    "brief_movements": lambda t: brief.brief_movements(brief.brief_kpis(t.daily)),
    "client_daily_brief": _client_brief,
    "latest_brief": lambda t: dashboard.latest_brief(t.briefs(t.daily)),
    "exec_window": lambda t: dashboard.in_window(t.exec),
    "latest_day_flag": lambda t: dashboard.latest_day_flag(t.exec),
    "latest_delay_pct": lambda t: dashboard.latest_delay_pct(t.exec),
    "exec_dod_pct": lambda t: dashboard.exec_dod_pct(t.exec),
    "fct_gmv_dod": lambda t: dashboard.fct_gmv_dod(t.fct),
    "headline_kpis": lambda t: dashboard.headline_kpis(t.fct),
    "top10_states": lambda t: dashboard.top_states(t.exec),
    "national_strip": lambda t: dashboard.national_strip(t.daily),
    "geo_city_min_volume": lambda t: dashboard.city_min_volume(marts.geo_kpi(t.fct)),
    "risk_buckets": lambda t: dashboard.risk_buckets(t.risk),
    "risk_heatmap": lambda t: _rounded(dashboard.risk_heatmap(t.risk_runs), "avg_risk", 12),
    "risk_heatmap_grid": _heatmap_grid,
    "forecast_by_state": lambda t: dashboard.forecast_by_state(t.forecast, STATE),
    "actual_vs_forecast": lambda t: dashboard.actual_vs_forecast(t.daily, t.forecast_runs, STATE),
    "orders_change_feed": _change_feed,
    "orders_stream_staging": _stream_staging,
    "orders_stream_text": lambda t: _stream_text(t, "good"),
    "orders_stream_rejects": lambda t: _stream_text(t, "rejects"),
    "orders_feed_consumed": _feed_consumed,
    "daily_kpi_incremental": _daily_incremental,
    "daily_kpi_corrected": _daily_corrected,
}


def _query(build: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(Tables(spark, sf_dir)))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Day by state KPIs with the previous day beside them, on the smallest tables."""
    return queries()["exec_dashboard"](spark, SMOKE_DIR)


def _optional(module: str):
    """The module, or None where it or a package above it is not there."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as error:
        if error.name and f"{module}.".startswith(f"{error.name}."):
            return None
        raise


def _text_modules() -> tuple:
    """The text operators and their pipeline, which is nothing without them."""
    text = _optional("orderloom.llm.queries")
    return text, _optional("corpus_pipeline") if text else None


def queries() -> dict[str, Query]:
    found = {name: _query(build) for name, build in _QUERIES.items()}
    text, pipeline = _text_modules()
    if text:
        found |= text.queries()
    if pipeline:
        found["pipeline"] = pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(STATEMENTS)
    text, pipeline = _text_modules()
    if text:
        found |= text.oracle_sql()
    if pipeline and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found
