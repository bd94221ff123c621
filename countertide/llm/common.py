"""What the corpus operators share: tables, size-checked broadcasts, slices of Arrow batches."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a narrow table (keys and a few numbers) is broadcast; beyond it the join is shuffled.
BROADCAST_ROWS = 200_000
#: Bytes of text that a Python worker holds as arrays at a time; a single longer text makes a slice of its own.
SLICE_BYTES = 3 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(frozen: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written narrow table, marked for broadcast if counting shows that it is small enough.

    Beyond ``rows`` it is returned as it is. A join with it then shuffles two plain inputs, and the adaptive skew
    join can split a hot key of the other side.
    """
    return F.broadcast(frozen) if frozen.count() <= rows else frozen


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Consecutive parts of a batch, each with about ``limit`` bytes in ``column`` or a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if row > first and held + size > limit:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if len(sizes) > first:
        yield batch.slice(first)


def quoted(*names: str) -> list:
    """Column references that also hold for names with dots."""
    return [F.col(f"`{n}`") for n in names]
