"""Shared helpers of the training-data operators.

Tables are read with Spark's readers only (any path a cluster can open), stage
results that are used more than once are written to a fresh folder below
``spark.checkpoint.dir``, and text reaches Python workers as Arrow batches of
bounded size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.session import shared_path

#: Bounds of one Arrow batch sent to a Python worker (rows, bytes).  Both sides hold several copies of a batch.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
              "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint directory and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of recomputing them.
    """
    path = shared_path(df.sparkSession, "llm", name, fresh=True)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def added(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` beside what lies in the folder ``path`` and read the whole folder: one scan, however often it was added to."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> pa.Array:
    """An Arrow text column with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library than glibc
    _trim = None


def release() -> None:
    """What Arrow and the C library keep for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, by a worker that gives free memory back before and after.

    Spark uses a worker again for other steps, and idle ones stay beside them, so what one step
    no longer needs would add to what the next one takes.
    """
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from run(batches)
        release()
    return tidied


def with_columns(df: DataFrame, source: list[str], added: T.StructType,
                 make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]) -> DataFrame:
    """Append columns that a Python worker computes from Arrow batches.

    ``make`` runs once per task and returns the function from a batch of the
    ``source`` columns to the arrays of ``added``; all other columns pass
    through.  A column of ``df`` with the name of an added one is replaced.
    """
    names = [f.name for f in added.fields]
    kept = [c for c in df.columns if c not in names]
    fields = [df.schema[c] for c in kept] + list(added.fields)
    # source columns that are replaced travel under private names, the others once
    private = [c for c in source if c not in kept]
    feed = df.select(*[F.col(f"`{c}`") for c in kept],
                     *[F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(private)])
    places = [([*kept, *private]).index(c) for c in source]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            inputs = pa.RecordBatch.from_arrays([batch.column(i) for i in places], list(source))
            columns = [batch.column(i) for i in range(len(kept))] + step(inputs)
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])
            del batch, inputs, columns  # not held while the next one is read
            release()

    return feed.mapInArrow(tidy(run), T.StructType(fields))


def bit_table(keys: DataFrame, key: str, width: int) -> np.ndarray:
    """A table of 2**width bits with the places of all keys (long) set; its size is fixed."""
    place = F.shiftrightunsigned(F.col(key), 64 - width) + 1  # the first bits of a 64-bit hash
    pages = keys.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("page")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    bits = np.zeros(1 << (width - 3), np.uint8)
    for row in pages.toLocalIterator():  # pages of 4096 bytes, numbered from 1
        bits[(row.page - 1) * 4096:row.page * 4096] = np.frombuffer(row.bits, np.uint8)
    return bits


def hit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.view(np.uint64) >> np.uint64(62 - len(bits).bit_length())
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


#: Most bits of a table in :func:`marked_in` (8 MB): 2 to this power.
MOST_BITS = 26


def marked_in(df: DataFrame, key: str, sets: list[DataFrame], most_bits: int = MOST_BITS) -> DataFrame:
    """Append ``_kf_marks``: bit i tells whether the row's key (a 64-bit hash) may be in ``sets[i]``.

    A key of a set is marked for sure, another one seldom (a bit table of bounded size), so rows
    without a mark are decided where they lie and only marked ones need an exact join.
    """
    widths = [min(most_bits, max(16, (16 * s.count()).bit_length())) for s in sets]
    tables = df.sparkSession.sparkContext.broadcast([bit_table(s, s.columns[0], w) for s, w in zip(sets, widths, strict=True)])

    @F.arrow_udf("int")
    def marks(keys: pa.Array) -> pa.Array:
        keys = keys.to_numpy(zero_copy_only=False)
        return pa.array(sum(hit(t, keys).astype(np.int32) << i for i, t in enumerate(tables.value)), pa.int32())

    # nondeterministic: neither doubled nor moved by the optimizer
    return df.withColumn("_kf_marks", marks.asNondeterministic()(F.col(key)))


#: Rows of one chunk in :func:`numbered`: 2 to this power.
CHUNK_BITS = 16


def numbered(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Append each row's place among the rows of its (null-safe) key, gapless from 0, in reading order.

    A key's rows are numbered in chunks of at most 2**CHUNK_BITS rows, to which
    the sizes of the key's earlier chunks are added, so no key is gathered whole.
    """
    key = F.struct(*[F.col(f"`{k}`") for k in keys])  # struct equality takes nulls as equal
    rows = saved(df.withColumn("_kf_row", F.monotonically_increasing_id()), "numbered").withColumns(
        {"_kf_key": key, "_kf_chunk": F.shiftright("_kf_row", CHUNK_BITS)})
    sizes = rows.groupBy("_kf_key", "_kf_chunk").agg(F.count(F.lit(1)).alias("_kf_n"))
    before = Window.partitionBy("_kf_key").orderBy("_kf_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_kf_key", "_kf_chunk", F.coalesce(F.sum("_kf_n").over(before), F.lit(0)).alias("_kf_start"))
    within = Window.partitionBy("_kf_key", "_kf_chunk").orderBy("_kf_row")
    placed = rows.withColumn("_kf_at", F.row_number().over(within) - 1)
    return (placed.join(starts, ["_kf_key", "_kf_chunk"])
                  .withColumn(number, (F.col("_kf_start") + F.col("_kf_at")).cast("long"))
                  .select(*[f"`{c}`" for c in df.columns if c != number], number))


#: Rows of one range in :func:`in_order`; a group in :func:`running_starts` has 2 to the power of GROUP_BITS ranges.
ROWS_PER_RANGE, GROUP_BITS = 1 << 20, 12


def running_starts(df: DataFrame, order: str, group: Column, size: str, start: str) -> DataFrame:
    """Append ``start``: the sum of ``size`` over all rows with a smaller ``order``.

    For tables with one row per file or range.  ``group`` (never falling as ``order``
    rises) cuts them into groups, so the one task that adds up groups sees a row per group.
    """
    rows = df.withColumn("_kf_group", group)
    before = Window.orderBy("_kf_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (rows.groupBy("_kf_group").agg(F.sum(size).alias("_kf_sum"))
                  .select("_kf_group", F.coalesce(F.sum("_kf_sum").over(before), F.lit(0)).alias("_kf_base")))
    within = Window.partitionBy("_kf_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_kf_within", F.coalesce(F.sum(size).over(within), F.lit(0))).join(groups, "_kf_group")
                .withColumn(start, (F.col("_kf_base") + F.col("_kf_within")).cast("long"))
                .drop("_kf_group", "_kf_within", "_kf_base"))


def in_order(df: DataFrame, order: list[Column], number: str, rows: int) -> DataFrame:
    """Append each row's place in the order of the whole table, from 1; ``rows`` is its number of rows.

    Rows are dealt by ranges of the order, sorted and written; each range's rows
    are counted and the sizes of the earlier ranges added.
    """
    ranges = max(1, -(-rows // ROWS_PER_RANGE))
    sorted_ = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = saved(sorted_.withColumn("_kf_at", F.monotonically_increasing_id()), "in-order")
    placed = placed.withColumns({"_kf_range": F.shiftright("_kf_at", 33), "_kf_at": F.col("_kf_at") % (1 << 33)})
    sizes = placed.groupBy("_kf_range").agg(F.count(F.lit(1)).alias("_kf_n"))
    starts = running_starts(sizes, "_kf_range", F.shiftright("_kf_range", GROUP_BITS), "_kf_n", "_kf_start")
    return (placed.join(starts.select("_kf_range", "_kf_start"), "_kf_range")
                  .withColumn(number, (F.col("_kf_start") + F.col("_kf_at") + 1).cast("long"))
                  .drop("_kf_range", "_kf_at", "_kf_start"))
