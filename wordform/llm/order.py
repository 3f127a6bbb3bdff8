"""Positions in a global order without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordform.llm.common import written

#: ``monotonically_increasing_id`` holds the partition above so many bits.
ROW_BITS = 33
ROW_MASK = (1 << ROW_BITS) - 1


def numbered(df: DataFrame, *order, out: str = "rank") -> DataFrame:
    """``df`` with a column ``out``: 1, 2, 3... in the given order. Rows are
    range-partitioned and written in order; a row's number is that within its
    slice plus the sizes of the slices before, which are as few as partitions."""
    at = "_at"
    rows = written(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "ordered")
    slices = rows.groupBy(F.shiftright(at, ROW_BITS).alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")
    slices = slices.select("_slice", before.alias("_before"))
    numbers = rows.join(F.broadcast(slices), F.shiftright(at, ROW_BITS) == F.col("_slice"))
    return numbers.select(*df.columns, (F.col("_before") + F.col(at).bitwiseAND(F.lit(ROW_MASK)) + 1).alias(out))
