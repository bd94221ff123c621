"""Stable places within classes, counted by blocks: the step that a counting sort is made of.

Rows lie in blocks of bounded size and have an order inside their block. A histogram of (class, block) gives how many
rows of a class lie in earlier blocks; the rest is counted inside the block. Neither a class nor a block is ever
gathered in one task: a class may hold all rows, as its places are found block by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block at most.
BLOCK_ROWS = 1 << 18
#: Written rows carry their task's number above these bits and their place in the task below.
TASK_BITS = 40


def block_bits(rows: int, partitions: int) -> int:
    """Bits of a place inside a block, so that blocks are bounded and there are some for each partition."""
    return max(0, min(BLOCK_ROWS, rows // (2 * partitions)).bit_length() - 1)


def places_in_class(rows: DataFrame, kind: Column, place: str, bits: int, out: str) -> DataFrame:
    """``rows`` with ``out``: the number of rows of the same ``kind`` with a smaller ``place``.

    ``place`` holds distinct non-negative longs; rows that agree above its lowest ``bits`` are a block.
    """
    dealt = rows.withColumns({"_kind": kind, "_block": F.shiftright(place, bits)})
    counts = dealt.groupBy("_kind", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_kind").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_kind", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_kind", "_block").orderBy(place)
    counted = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    return counted.join(before, ["_kind", "_block"]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_kind", "_block", "_before", "_inside")
