"""Batch readers for the parquet tables, with explicit schemas.

Schemas are never inferred: every table is read with the schema below, so a
scan reads only the columns a query selects (``ReadSchema`` in ``explain``)
and filters reach the parquet reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _I, _S, _D, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


SCHEMAS: dict[str, T.StructType] = {
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())), ("label", _I)),
}

TABLES = tuple(SCHEMAS)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one table with its fixed schema (``spread``: see :func:`spread_rows`)."""
    df = spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))
    return spread_rows(df) if spread else df


def spread_rows(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin rows when the scan yields fewer splits than the cluster has cores.

    A small file stored as one row group is read by one task; CPU-heavy
    per-row work after it (tokenizing, regex parsing) would then run on one
    core.  On large inputs the scan already has thousands of splits and the
    frame is returned unchanged - no extra shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def page_log_lines(events: DataFrame) -> DataFrame:
    """``ts|user|page`` text lines derived from events, with the arrival time.

    The page-view programs read such lines from a socket; here each event is
    one line (page = event_type) and ``arrival`` is the event timestamp.
    """
    line = F.concat_ws("|", F.col("ts").cast("string"), F.col("user_id").cast("string"),
                       F.col("event_type"))
    return events.select(F.col("event_id"), line.alias("line"), F.col("ts").alias("arrival"))


def behavior_lines(events: DataFrame) -> DataFrame:
    """CSV behaviour records ``user,item,type,ts_ms`` derived from events.

    Every event yields one well-formed record and one malformed record whose
    fourth field is the JSON ``props`` text (not a number), so the parser's
    reject path sees as many rows as its accept path.
    """
    good = F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_id").cast("string"),
                       F.col("event_type"),
                       F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    bad = F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_id").cast("string"),
                      F.col("event_type"), F.col("props"))
    return events.select(F.col("event_id"),
                         F.posexplode(F.array(good, bad)).alias("variant", "line"))
