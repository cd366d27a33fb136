"""Delimited text files to all-text raw tables, unreadable rows kept apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas, session
from ..functions.casts import null_if_marker

REJECT = "_corrupt_record"
SOURCE_FILE, SOURCE_BLOCK = "_source_file", "_source_block"

FILES = {table: f"{table}.csv" for table in schemas.RAW}


def prefixed_files(prefix: str, suffix: str = "_dataset.csv") -> dict[str, str]:
    """File names of a published set such as ``<prefix>_orders_dataset.csv``."""
    named = {"payments": "order_payments", "reviews": "order_reviews"}
    return {table: f"{prefix}_{named.get(table, table)}{suffix}" for table in schemas.RAW}


# A file whose quoted fields hold line breaks cannot be split among tasks, so that
# is switched on for free text only; a table arrives as many files at scale.
MULTI_LINE = {"reviews"}


def parse_csv(
    spark: SparkSession,
    table: str,
    path: str,
    multi_line: bool | None = None,
    stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Every row of the file: declared text columns, the reject column and the row's place.

    A row with the wrong number of fields keeps its text in the reject column. The place is
    the file and where its part of the file that one task reads begins. The parser must see
    all fields to notice a bad row, whatever columns a query uses, so its own column
    pruning is off; prune after landing the table. ``stream`` reads files as they arrive.
    """
    schema = T.StructType([*schemas.RAW[table].fields, T.StructField(REJECT, T.StringType(), True)])
    reader = spark.readStream if stream else spark.read
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", table in MULTI_LINE if multi_line is None else multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .option("columnPruning", False)
        .option("enforceSchema", True)
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_name").alias(SOURCE_FILE),
            F.col("_metadata.file_block_start").alias(SOURCE_BLOCK),
        )
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    columns = [c for c in parsed.columns if c not in (REJECT, SOURCE_FILE, SOURCE_BLOCK)]
    return parsed.filter(F.col(REJECT).isNull()).select(*[null_if_marker(c).alias(c) for c in columns])


def _reason(width: int) -> Column:
    """What is wrong with a rejected line, read from its text."""
    # Whole quoted fields, with doubled quotes inside them, count as one plain character.
    bare = F.regexp_replace(REJECT, r'"(?:[^"]|"")*"', "q")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (
        F.when(bare.contains('"'), "broken quote")
        .when(fields < width, "too few fields")
        .when(fields > width, "too many fields")
        .otherwise("unreadable")
    )


def rejected_rows(parsed: DataFrame, table: str) -> DataFrame:
    """Rows that did not load: their text, what is wrong with it and where it stands.

    The first column is kept beside the text: the reader refuses queries on the reject column
    alone.
    """
    first = parsed.columns[0]
    return parsed.filter(F.col(REJECT).isNotNull()).select(
        F.col(first).alias("first_field"),
        F.col(REJECT).alias("line"),
        _reason(len(schemas.RAW[table])).alias("reason"),
        F.col(SOURCE_FILE).alias("file_name"),
        F.col(SOURCE_BLOCK).alias("block_start"),
    )


def land(
    spark: SparkSession,
    directory: str,
    landed: str,
    files: dict[str, str] | None = None,
    multi_line: bool | None = None,
) -> dict[str, DataFrame]:
    """Parse the files once and store them by table, rejects included.

    Later reads of the stored tables prune columns and count rejects without
    parsing the text again.
    """
    stored = {}
    for table, name in (files or FILES).items():
        path = f"{landed}/{table}"
        parse_csv(spark, table, f"{directory}/{name}", multi_line).write.mode("overwrite").parquet(path)
        stored[table] = spark.read.parquet(path)
    return stored


def load_raw(
    spark: SparkSession,
    directory: str,
    landed: str | None = None,
    files: dict[str, str] | None = None,
    multi_line: bool | None = None,
) -> dict[str, DataFrame]:
    """The eight raw tables of a directory; bad rows are left out and the rest loads."""
    stored = land(spark, directory, landed or session.scratch_path(spark, "landed"), files, multi_line)
    return {table: good_rows(parsed) for table, parsed in stored.items()}


def rejects_by_table(landed: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows of all landed tables."""
    parts = [
        rejected_rows(parsed, table).select(F.lit(table).alias("table_name"), "*")
        for table, parsed in landed.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a text table in the format :func:`parse_csv` reads; NULL becomes an empty field."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )
