"""Structured Streaming jobs over raw rows that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.staging import stage
from ..sources import csv_tables


def arriving_orders(spark: SparkSession, directory: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.RAW["orders"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


def stream_staging(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the staged form of arriving raw orders to a table; stops when caught up."""
    return (
        stage("orders", raw)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arriving_text(spark: SparkSession, table: str, directory: str, files_per_batch: int | None = None) -> DataFrame:
    """Delimited text files of a table as they arrive, each row with its place and reject text."""
    return csv_tables.parse_csv(spark, table, directory, stream=True, files_per_batch=files_per_batch)


def stream_text(table: str, parsed: DataFrame, good: str, rejects: str, checkpoint: str) -> StreamingQuery:
    """Stage the readable rows of arriving text and keep the others apart; stops when caught up.

    A micro-batch is parsed once and goes to both tables, into a partition of its own that
    a repeated batch replaces.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for rows, path in (
                (stage(table, csv_tables.good_rows(batch)), good),
                (csv_tables.rejected_rows(batch, table), rejects),
            ):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        parsed.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
