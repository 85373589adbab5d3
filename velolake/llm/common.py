"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velolake.session import stored

# The white space of the contracts, as a character class of regular expressions.
SPACE = r"\x20\x09-\x0D"

# Rows that a bucket of a two-level window or a group of a map function is to hold.
BUCKET_ROWS = 4096

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def with_row(df: DataFrame, name: str) -> DataFrame:
    """`df` stored once in the shared folder, with `_row`: a number of its own for each row."""
    return stored(df.withColumn("_row", F.monotonically_increasing_id()), name)


def running_total(df: DataFrame, name: str, value: Column, *order: Column) -> DataFrame:
    """`df` with `name`: the sum of `value` over all rows before this one in the given order.

    The rows stay spread over the partitions of a range sort; only one number per partition
    is summed in one place.
    """
    ranged = df.withColumn(name, value.cast("long")).orderBy(*order)
    rows = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), name).withColumn(
        "_part", F.shiftright("_at", _ROW_BITS))
    parts = rows.groupBy("_part").agg(F.sum(name).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_before") + F.coalesce(F.sum(name).over(within), F.lit(0))
    return rows.join(parts, "_part").withColumn(name, total).drop("_part", "_at", "_before")


def bucket_bits(rows: int, per_bucket: int = BUCKET_ROWS) -> int:
    """Leading bits of a hash that leave about `per_bucket` rows to a bucket."""
    return max(1, (max(rows, 1) // per_bucket).bit_length())


def text_chunks(array: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about `most` bytes of text, at least one row each.

    Yields first row, end row, the bytes of these rows and their offsets in them; null counts as
    empty. A longer text is a run of its own.
    """
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()).fill_null(b"")
    if not len(array):
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(array):
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), len(array))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


# One random odd-free 64-bit number per byte value, and the odd base of the powers.
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0x5851F42D4C957F2D)


def powers(count: int) -> np.ndarray:
    """1, BASE, BASE**2, ... modulo 2**64."""
    out = np.full(max(count, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)
