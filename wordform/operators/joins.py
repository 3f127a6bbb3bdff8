"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only up to this many rows and bytes; beyond either the
# planner's shuffle join (with AQE skew handling) is used instead.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
#: Bytes of a row besides its strings, per column.
COLUMN_BYTES = 16


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a table, added up by Spark in one aggregate."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in strings), F.lit(COLUMN_BYTES * len(df.columns)))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n, total or 0


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast if its rows and bytes prove it small.

    The sizes are added up by a Spark job, so ``df`` should be a written
    table; nothing but two numbers reaches the driver.
    """
    n, size = table_size(df)
    if n <= max_rows and size <= MAX_BROADCAST_BYTES:
        return F.broadcast(df), True
    return df, False


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` for a join that broadcasts it if it is small. What Spark's own size
    statistics (file sizes, for a list read from files) put below its threshold for
    automatic broadcasts needs no job to be measured; the rest is measured."""
    spark = df.sparkSession
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return df
    return bounded_broadcast(df.distinct(), max_rows)[0]
