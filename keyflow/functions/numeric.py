"""Numeric maps and predicates of the counter programs (widened to bigint)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def doubled(v: str | Column) -> Column:
    """``v * 2`` on a long: Java ints would wrap, Spark ANSI would raise; we widen."""
    return _c(v).cast("bigint") * 2


def is_even(v: str | Column) -> Column:
    return _c(v) % 2 == 0


def parity(v: str | Column) -> Column:
    """``v % 2``; the sign follows the dividend, as in Java."""
    return _c(v) % 2


def failure_point(v: str | Column) -> Column:
    """Values the guarded map refuses: positive multiples of ten."""
    return (_c(v) % 10 == 0) & (_c(v) > 0)


def guarded_double_strict(v: str | Column) -> Column:
    """Raise on a failure point (the job fails, as the reference's map throws)."""
    return F.when(failure_point(v), F.raise_error(F.concat(
        F.lit("Simulated failure at count: "), _c(v).cast("string")))).otherwise(doubled(v))


def guarded_double(df: DataFrame, v: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine form: every row kept; failure points get ``doubled`` null and a flag."""
    bad = failure_point(v)
    return df.select(*[F.col(k) for k in keep], F.col(v),
                     F.when(~bad, doubled(v)).alias("doubled"),
                     bad.alias("quarantined"))


def exact_decimal(df: DataFrame, value: str, scale: int | None = None, precision: int = 28) -> Column:
    """``value`` as a decimal, for sums that do not depend on their order; nothing is rounded.

    Decimal and integer columns bring their own scale.  For a floating column the
    caller states how many decimals its values have; a value with more raises.
    """
    kind, v = df.schema[value].dataType, F.col(value)
    if isinstance(kind, T.DecimalType):
        return v
    if isinstance(kind, T.IntegralType):
        return v.cast(f"decimal({precision},0)")
    if scale is None:
        raise ValueError(f"state the scale (number of decimals) of the {kind.simpleString()} column {value!r}")
    exact = T.DecimalType(precision, scale)
    dec = v.cast(exact)
    return F.when(v.isNull() | (dec.cast(kind) == v), dec).otherwise(
        F.raise_error(F.concat(F.lit(f"{value} has more than {scale} decimals: "), v.cast("string"))).cast(exact))
