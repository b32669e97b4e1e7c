"""Skew-safe keyed scans: running sums and next-row lookups per key.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task.  When one key holds a third of all rows (or there are only two
keys, as in the parity counter) that task holds a third of the data.

The scans here cut each key's ordered sequence into *chunks*:

1. cut points are tuples of the whole order, of any types: quantiles of a small
   sample (``OVERSAMPLE`` tuples a chunk), so every chunk ``(key, bucket)`` holds
   about ``rows_per_chunk`` rows at most, however the rows spread over keys.
   Text orders are cut like numbers, and rows that share the leading column (one
   hot timestamp) are cut by the following ones.  The sample places the cuts only;
   every row takes part in every result;
2. the window runs per ``(key, bucket)`` (one shuffle, balanced);
3. a summary with one row per ``(key, bucket)`` - the chunk's total, or its
   first row - comes from a column-pruned second read of the input, reduced
   map-side before its shuffle, and gives each chunk the offset of all
   earlier chunks of its key (prefix sums) or the first row of the following
   chunk (for ``lead``);
4. the summary is joined back on ``(key, bucket)``.  The big side is already
   hash-partitioned on those columns by step 2, so only the summary moves.

An input of at most ``rows_per_chunk`` rows is one chunk: its window needs no
summary.  Buckets are computed from data values against fixed cut points, so
recomputation after a lost executor assigns the same rows to the same chunk.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ROWS_PER_CHUNK = 4_000_000
# Session setting that overrides the default (e.g. per cluster memory size).
ROWS_PER_CHUNK_CONF = "spark.keyflow.scan.rowsPerChunk"
CHUNK = "_kf_chunk"
#: Sampled order tuples per chunk, and the most chunks: their product bounds what
#: reaches the driver.  Beyond MAX_CHUNKS x rows_per_chunk rows chunks grow.
OVERSAMPLE, MAX_CHUNKS = 64, 8_192


def _is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType))


def _cut_points(df: DataFrame, order: Sequence[str], rows: int, chunks: int) -> list[tuple]:
    """At most ``chunks - 1`` order tuples that cut the rows into about equal parts (times as microseconds)."""
    share = min(1.0, OVERSAMPLE * chunks / rows)
    plain = [F.unix_micros(F.col(c).cast("timestamp")) if _is_time(df.schema[c].dataType) else F.col(c) for c in order]
    seen = [tuple(r) for r in df.select(*plain).sample(fraction=share, seed=11).collect()]
    seen.sort(key=lambda r: tuple((v is not None, v) for v in r))
    at = sorted({math.ceil(i * len(seen) / chunks) for i in range(1, chunks)})
    return list(dict.fromkeys(seen[i] for i in at if i < len(seen)))


def _constant(value, kind: T.DataType) -> Column:
    if value is not None and _is_time(kind):
        return F.timestamp_micros(F.lit(value)).cast(kind)
    return F.lit(bytes(value) if isinstance(value, bytearray) else value).cast(kind)


def _bucket(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> Column:
    """Number of cut points at or before the row's order tuple (binary search in a constant array)."""
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])
    kinds = [df.schema[c].dataType for c in order]
    points = F.sort_array(F.array(*[
        F.struct(*[_constant(v, t).alias(f"c{i}") for i, (v, t) in enumerate(zip(p, kinds, strict=True))]) for p in cuts]))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    # an index beyond the array gives null, which is not at or before the row
    return F.aggregate(steps, F.lit(0),
                       lambda at, step: F.when(F.get(points, at + step - 1) <= row, at + step).otherwise(at))


def add_chunks(df: DataFrame, order: str | Sequence[str], rows_per_chunk: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_kf_chunk`` (bucket of the order tuple) when the input needs more than one chunk.

    Returns the frame and whether chunks were added.  One job counts the rows, a
    second samples order tuples; at most ``OVERSAMPLE * MAX_CHUNKS`` of them reach
    the driver.
    """
    order = [order] if isinstance(order, str) else list(order)
    rows_per_chunk = rows_per_chunk or int(
        df.sparkSession.conf.get(ROWS_PER_CHUNK_CONF, str(DEFAULT_ROWS_PER_CHUNK)))
    rows = df.count()
    chunks = min(math.ceil(rows / rows_per_chunk), MAX_CHUNKS)
    if chunks <= 1:
        return df, False
    cuts = _cut_points(df, order, rows, chunks)
    return df.withColumn(CHUNK, _bucket(df, order, cuts) if cuts else F.lit(0)), True


KEY = "_kf_key"


def _with_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Pack the keys into one struct column (never null; struct equality treats null
    fields as equal), so the window, the summary and the join all use the same
    plain equi-key ``(_kf_key, _kf_chunk)`` and the big side's partitioning is
    reused by a sort-merge join (a null-safe condition on the raw keys would make
    Spark join on coalesce/isnull expressions and re-shuffle the big side)."""
    if not keys:
        return df, []
    return df.withColumn(KEY, F.struct(*[F.col(k) for k in keys])), [KEY]


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 measures: dict[str, Column], rows_per_chunk: int | None = None) -> DataFrame:
    """Append inclusive running sums of ``measures`` per key in ``order``.

    ``order`` must be a total order within each key (add a tie-breaker).  Use
    ``F.lit(1)`` as a measure for a running count and decimals for exact sums.
    """
    keys, order = list(keys), list(order)
    base_cols = list(df.columns)
    mcol = {name: f"_kf_m_{name}" for name in measures}
    src = df.select("*", *[m.alias(mcol[name]) for name, m in measures.items()])
    src, chunked = add_chunks(src, order, rows_per_chunk)
    if not chunked:
        w = (Window.partitionBy(*keys).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return src.select(*base_cols, *[F.sum(mcol[n]).over(w).alias(n) for n in measures])

    src, kcol = _with_key(src, keys)
    w = (Window.partitionBy(*kcol, CHUNK).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = src.select(*base_cols, *kcol, CHUNK,
                       *[F.sum(mcol[n]).over(w).alias(f"_kf_l_{n}") for n in measures])
    # Chunk totals: a second, column-pruned read of the input (keys, order
    # column, measures), aggregated map-side before a shuffle of one row per
    # chunk.  Cheaper than sharing the wide exchange above, which would need
    # a sort and a window on the summary side too.
    summary = src.groupBy(*kcol, CHUNK).agg(
        *[F.sum(mcol[n]).alias(f"_kf_t_{n}") for n in measures])
    wk = (Window.partitionBy(*kcol).orderBy(CHUNK)
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = summary.select(*kcol, CHUNK,
                             *[F.sum(f"_kf_t_{n}").over(wk).alias(f"_kf_o_{n}") for n in measures])
    joined = local.join(offsets, [*kcol, CHUNK], "inner")

    def total(n: str) -> Column:
        # nulls add nothing; the sum is null only while no value was seen at all, as in the plain window
        here, before = F.col(f"_kf_l_{n}"), F.col(f"_kf_o_{n}")
        return F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)

    return joined.select(*base_cols, *[total(n).alias(n) for n in measures])


def next_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                prefix: str = "next_", rows_per_chunk: int | None = None) -> DataFrame:
    """Append ``prefix + c`` = value of ``c`` on the next row of the same key (``lead``).

    Also appends ``prefix + "exists"`` (boolean), so a null value on an
    existing next row is not mistaken for the end of the key.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    base_cols = list(df.columns)
    src, chunked = add_chunks(df, order, rows_per_chunk)
    if not chunked:
        w = Window.partitionBy(*keys).orderBy(*order)
        return src.select(*base_cols, *[F.lead(c).over(w).alias(prefix + c) for c in cols],
                          F.lead(F.lit(True)).over(w).isNotNull().alias(prefix + "exists"))

    src, kcol = _with_key(src, keys)
    w = Window.partitionBy(*kcol, CHUNK).orderBy(*order)
    local = src.select(*base_cols, *kcol, CHUNK, *[F.lead(c).over(w).alias(f"_kf_n_{c}") for c in cols],
                       F.lead(F.lit(True)).over(w).isNotNull().alias("_kf_has"))
    # First row of each chunk: a column-pruned second read, reduced map-side
    # by min_by before a shuffle of one row per chunk.
    firsts = src.groupBy(*kcol, CHUNK).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(o) for o in order]))
        .alias("_kf_first"))
    wk = Window.partitionBy(*kcol).orderBy(CHUNK)
    following = firsts.select(*kcol, CHUNK, F.lead("_kf_first").over(wk).alias("_kf_nf"))
    joined = local.join(following, [*kcol, CHUNK], "inner")
    has = F.col("_kf_has")
    return joined.select(*base_cols,
                         *[F.when(has, F.col(f"_kf_n_{c}")).otherwise(F.col("_kf_nf")[c]).alias(prefix + c)
                           for c in cols],
                         (has | F.col("_kf_nf").isNotNull()).alias(prefix + "exists"))
