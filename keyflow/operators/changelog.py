"""Retract changelog of a continuously updated grouped sum (O-54).

For each input row in order: the key's first row emits ``+ total``; later
rows emit ``- old total`` then ``+ new total``; a row that leaves the total
unchanged emits nothing.  Folding the changelog (+ adds, - removes) gives the
grouped sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.functions.numeric import exact_decimal
from keyflow.operators.scan import running_sums


def retract_changelog(df: DataFrame, key: str, order: Sequence[str], value: str,
                      total: str = "total", scale: int | None = None, precision: int = 28,
                      rows_per_chunk: int | None = None) -> DataFrame:
    """Columns: key, *order, ``op`` ('+'/'-'), ``seq`` (0 retract, 1 add), ``total`` (double).

    Totals are exact decimal running sums cast to double (``scale`` is needed for
    floating columns, and a value with more decimals raises); rows without a value
    emit nothing.
    """
    df = df.filter(F.col(value).isNotNull())
    run = running_sums(df.select(key, *order, exact_decimal(df, value, scale, precision).alias("_kf_v")), [key], order,
                       {"_kf_n": F.lit(1), "_kf_new": F.col("_kf_v")}, rows_per_chunk=rows_per_chunk)
    first = F.col("_kf_n") == 1
    changed = F.col("_kf_v") != 0
    old = F.col("_kf_new") - F.col("_kf_v")
    retract = F.when(~first & changed, F.struct(F.lit("-").alias("op"), F.lit(0).alias("seq"),
                                                old.cast("double").alias("t")))
    add = F.when(first | changed, F.struct(F.lit("+").alias("op"), F.lit(1).alias("seq"),
                                           F.col("_kf_new").cast("double").alias("t")))
    rows = run.select(key, *order, F.explode(F.array(retract, add)).alias("_kf_e"))
    return (rows.filter(F.col("_kf_e").isNotNull())
                .select(key, *order, F.col("_kf_e.op").alias("op"), F.col("_kf_e.seq").alias("seq"),
                        F.col("_kf_e.t").alias(total)))


def fold_changelog(changes: DataFrame, key: str, total: str = "total") -> DataFrame:
    """Sum of (+ total) minus (- total) per key: equals the final grouped sum."""
    signed = F.when(F.col("op") == "+", F.col(total)).otherwise(-F.col(total))
    return changes.groupBy(key).agg(F.sum(signed).alias(total))
