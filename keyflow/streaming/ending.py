"""The end of a bounded input on a stream (R-1): a last watermark that closes every window.

A watermark trails the newest row, so when a bounded input ends, the windows and
buffered rows beyond the last watermark would stay in state for ever.
:func:`end_input` lands one row at a time after any other; :func:`until_end` lets it
move the watermark and takes it out again.  The watermark then lies beyond every
row, so append mode emits all that is left, once.

After the end a stream is finished: rows that come later are late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows from this time on only say that the input has ended.
END = "9999-01-01 00:00:00"


def end_input(spark: SparkSession, landing: str, schema: T.StructType, ts: str) -> None:
    """Land the end of a file stream: one row of nulls whose ``ts`` is the end of time."""
    nulls = [F.lit(END).cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*nulls).coalesce(1).write.mode("append").parquet(landing)


def until_end(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """``stream`` with a watermark of ``delay`` behind ``ts``, without the row that ends it.

    The filter reads the event time, so it stays behind the watermark in the plan.
    """
    real = F.coalesce(F.col(ts) < F.lit(END).cast("timestamp"), F.lit(True))
    return stream.withWatermark(ts, delay).filter(real)
