"""Per-key running state, one output row per input row (O-46..O-48).

Batch forms are skew-safe running sums (:mod:`keyflow.operators.scan`); the
streaming forms with keyed state live in :mod:`keyflow.streaming.stateful`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.functions.formats import counter_text
from keyflow.functions.numeric import exact_decimal, parity
from keyflow.operators.scan import running_sums


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: str = "cnt",
                  rows_per_chunk: int | None = None) -> DataFrame:
    """Events seen so far for the row's key, this row included."""
    return running_sums(df, keys, order, {count: F.lit(1)}, rows_per_chunk=rows_per_chunk)


def running_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    average: str = "avg_value", scale: int | None = None, precision: int = 28,
                    rows_per_chunk: int | None = None) -> DataFrame:
    """Running mean of ``value`` per key.

    The running total is an exact decimal sum, independent of how the sequence is
    chunked (see :func:`keyflow.functions.exact_decimal`: ``scale`` is needed for
    floating columns, and a value with more decimals raises).  The mean is
    ``double(total) / count``; a null value counts as a row and adds nothing, and
    the mean is null until a value came.
    """
    out = running_sums(df, keys, order,
                       {"_kf_cnt": F.lit(1), "_kf_tot": exact_decimal(df, value, scale, precision)},
                       rows_per_chunk=rows_per_chunk)
    return (out.withColumn(average, F.col("_kf_tot").cast("double") / F.col("_kf_cnt"))
               .drop("_kf_cnt", "_kf_tot"))


def parity_counter(df: DataFrame, value: str, order: Sequence[str] | None = None,
                   rows_per_chunk: int | None = None) -> DataFrame:
    """Key ``value % 2``; per-key running count and the counter message.

    Only two keys exist, so the chunked scan is what keeps this parallel.
    """
    keyed = df.withColumn("parity", parity(value))
    counted = running_count(keyed, ["parity"], list(order or [value]), "cnt",
                            rows_per_chunk=rows_per_chunk)
    return counted.withColumn("message", counter_text("parity", value, "cnt"))
