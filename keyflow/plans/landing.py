"""The test tables as arriving files: what the registered stream queries read.

A stream query needs files that arrive one after the other.  These helpers land a
table in slices of its order and run the query after each slice from one checkpoint
(a stop and a restart every time).  They belong to the registered queries; a user's
stream reads the files that its producers write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def slice_bounds(df: DataFrame, col: str, n_slices: int) -> list:
    """``n_slices - 1`` cut points of ``col`` at approximate quantiles (a bounded list)."""
    if n_slices <= 1:
        return []
    fractions = [i / n_slices for i in range(1, n_slices)]
    cuts = df.select(F.percentile_approx(col, fractions, 10_000).alias("q")).first()["q"]
    return sorted(set(cuts))


def slice_filter(col: str, bounds: list, i: int):
    """Rows of slice ``i``: ``bounds[i-1] <= col < bounds[i]`` (open at both ends); nulls are in the first."""
    cond = F.lit(True)
    if i > 0:
        cond = cond & (F.col(col) >= F.lit(bounds[i - 1]))
    if i < len(bounds):
        cond = cond & (F.col(col) < F.lit(bounds[i]))
    return F.coalesce(cond, F.lit(i == 0))


def run_in_slices(spark: SparkSession, table: DataFrame, order_col: str, n_slices: int,
                  landing: str, start: Callable[[], StreamingQuery]) -> None:
    """Land ``table`` in time-ordered slices, running the stream once after each.

    Every run restarts from the same checkpoint, so state and offsets carry
    over - a stop/resume cycle per slice.  Slices are filters on the order
    column, pushed down to the scan; their union is the whole table.
    """
    bounds = slice_bounds(table, order_col, n_slices)
    for i in range(len(bounds) + 1):
        table.filter(slice_filter(order_col, bounds, i)).write.mode("append").parquet(landing)
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))


def slice_number(df: DataFrame, us: str, n_slices: int):
    """Column: the slice of a row by its arrival in microseconds, ``n_slices`` equal parts of the whole span."""
    low, high = df.agg(F.min(us), F.max(us)).first()
    return F.least(F.lit(n_slices - 1), F.expr(f"({us} - {low}L) * {n_slices} div ({high}L - {low}L + 1)")).cast("int")


def land_slices(spark: SparkSession, rows: DataFrame, slice_col: str, n_slices: int, landing: str,
                start: Callable[[], StreamingQuery]) -> None:
    """Land the rows of slice 0, 1, ... and run the stream to its end after each."""
    for i in range(n_slices):
        rows.filter(F.col(slice_col) == i).drop(slice_col).write.mode("append").parquet(landing)
        finish(start())


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
