"""Table sinks on parquet: full refresh, append, and intermediate results.

A refreshed table is written by Spark to a new folder, named by the time; readers take the
newest folder that Spark has marked as complete. A write that breaks off leaves the old
table in place. One writer per table is assumed, as with any plain overwrite.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas, session

#: Refreshes of a table that stay: the newest, and the one before for readers that have begun.
KEPT = 2


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: several readers, one computation,
    and a lost executor repeats no upstream work."""
    path = session.scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _complete(spark: SparkSession, path: str) -> list[str]:
    """Folders of the finished refreshes of a table, the newest last."""
    folders = [f"{path}/{name}" for name in session.children(spark, path) if name.isdigit()]
    return [f for f in folders if session.path_exists(spark, f"{f}/_SUCCESS")]


def full_refresh(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table and return it as stored. ``df`` may read the table that it replaces.

    Partitioned tables are rebalanced on the partition column first: each value
    gets few files, and one that holds much of the data is split over several
    writers instead of going to one.
    """
    spark, folder = df.sparkSession, f"{path}/{time.time_ns():020d}"
    writer = df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(folder)
    for old in _complete(spark, path)[:-KEPT]:
        session.remove(spark, old)
    return spark.read.schema(df.schema).parquet(folder)


def append(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Append rows that match the declared schema and return the table."""
    schemas.conform(df, schema).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def is_stored(spark: SparkSession, path: str) -> bool:
    return bool(_complete(spark, path))


def read_latest(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The newest refresh of a table, as declared."""
    folders = _complete(spark, path)
    if not folders:
        raise FileNotFoundError(f"nothing is stored in {path}")
    return spark.read.schema(schema).parquet(folders[-1])


def read_latest_or_empty(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Like :func:`read_latest`, with a typed empty table before the first write."""
    if not is_stored(spark, path):
        return schemas.empty_table(spark, name)
    return read_latest(spark, path, schemas.OUTPUT[name])
