"""A change feed as files, and a table that follows it.

The position up to which the feed has been read is the checkpoint of a streaming query: it
moves on only when the batch's new table has been written. The table is written whole for
each batch, to ``as_of=<batch>``; a repeated batch starts from the table before it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import session
from ..operators.changes import apply_changes

_CHANGE = "action string, is_update boolean, version long"


def publish(feed: DataFrame, directory: str, version: int) -> None:
    """Add the changes of one version to a feed; publishing it again replaces it as long as nobody read it."""
    feed.write.mode("overwrite").parquet(f"{directory}/version={version}")


def read_feed(spark: SparkSession, directory: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """The feed as a stream: the table's columns with ``action``, ``is_update`` and ``version``."""
    reader = spark.readStream.schema(StructType([*schema.fields, *session.struct(_CHANGE).fields]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


def start_table(df: DataFrame, path: str) -> None:
    """The snapshot that the first changes apply to."""
    df.write.parquet(f"{path}/as_of=start")


def _as_of(spark: SparkSession, path: str, before: int | None = None) -> str:
    """Folder of the newest table, or of the newest one before a batch."""
    batches = [int(n[6:]) for n in session.children(spark, path) if n.startswith("as_of=") and n != "as_of=start"]
    known = [b for b in batches if before is None or b < before]
    return f"{path}/as_of={max(known) if known else 'start'}"


def current_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(_as_of(spark, path))


def apply_batch(batch: DataFrame, batch_id: int, path: str, schema: StructType) -> None:
    """The table with one batch of changes; doing it twice changes nothing."""
    spark = batch.sparkSession
    before = _as_of(spark, path, batch_id)
    table = apply_changes(spark.read.schema(schema).parquet(before), batch)
    table.write.mode("overwrite").parquet(f"{path}/as_of={batch_id}")
    # The batch before this one may still be repeated with its own base; older tables are not needed.
    for name in session.children(spark, path):
        if name.startswith("as_of=") and name != "as_of=start" and int(name[6:]) < batch_id - 1:
            session.remove(spark, f"{path}/{name}")


def follow(feed: DataFrame, path: str, schema: StructType, checkpoint: str) -> StreamingQuery:
    """Apply a feed to a table up to its end.

    A table that was brought forward with another checkpoint is refused, since changes
    would be applied twice.
    """
    spark = feed.sparkSession
    if not _as_of(spark, path).endswith("=start") and not session.path_exists(spark, f"{checkpoint}/commits"):
        raise ValueError(f"{path} was made with another checkpoint; start with a new table")
    return (
        feed.writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, path, schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
