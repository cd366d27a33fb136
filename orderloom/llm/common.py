"""What the text operators share: session settings, stored intermediate tables, batch reading."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import session
from ..sources.sinks import stored

__all__ = ["BitMap", "bit_map", "chunk_of", "prepare", "read_table", "slices", "stored", "text_of", "unused_name"]

#: One Arrow batch holds at most so many rows or about so many bytes, whichever comes first.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings of the operators: bounded Arrow batches for very long texts."""
    session.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def chunk_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


#: Bits of a map of hashes: 16 MB, whatever the size of the input.
MAP_BITS = 27
_MAP_ROW = 15  # Spark's bit map aggregate fills 2**15 bits a row


class BitMap:
    """Low bits of hashes as a map. It tells for certain what is not in a set; what is not may look as if it was.

    It travels compressed, since most maps are nearly empty, and unfolds where it is asked.
    """

    def __init__(self, bits: np.ndarray):
        self._packed, self._bits = zlib.compress(bits.tobytes(), 1), None

    @staticmethod
    def union(maps: list[BitMap]) -> BitMap:
        return BitMap(np.bitwise_or.reduce([m.bits for m in maps]))

    def __getstate__(self) -> dict:
        return {"_packed": self._packed, "_bits": None}

    @property
    def bits(self) -> np.ndarray:
        if self._bits is None:
            self._bits = np.frombuffer(zlib.decompress(self._packed), np.uint8)
        return self._bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which unsigned 64-bit hashes may be in the set."""
        at = hashes & np.uint64((1 << MAP_BITS) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_map(hashes: DataFrame) -> BitMap:
    """The map of all hashes of a one-column table, made by Spark in rows of 4 KB."""
    bit = F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = hashes.groupBy(F.shiftright(bit, _MAP_ROW).alias("row")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit((1 << _MAP_ROW) - 1))).alias("bits")
    )
    found = np.zeros((1 << (MAP_BITS - _MAP_ROW), 1 << (_MAP_ROW - 3)), np.uint8)
    for r in rows.collect():
        found[r["row"]] = np.frombuffer(r["bits"], np.uint8)
    return BitMap(found)


def unused_name(df: DataFrame, name: str) -> str:
    """The name, or with underscores in front as long as the frame has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def strings(column: pa.Array) -> pa.Array:
    """A text column of a batch as large strings, null as empty."""
    return column.cast(pa.large_string()).fill_null("")


def slices(batch: pa.RecordBatch, sizes: pa.Array, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``limit`` units of size, at least one row each; a null size is 0.

    After the last part the worker gives back what Arrow keeps of freed memory: it stays for
    the stages that follow, and each executor has a worker per core.
    """
    size = sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for low, high in zip(starts, np.append(starts[1:], len(size))):
        yield batch.slice(low, high - low)
    pa.default_memory_pool().release_unused()
