"""SQL surface (O-31..O-33, O-44): a declared table and a grouped-sum query.

The reference declares an ``Orders`` table and asks for
``SUM(amount * price)`` per product.  Here the table is a temporary view
over parquet; the query is plain Spark SQL, so Catalyst prunes the scan to
the three columns it reads and aggregates partially before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyflow.sources.tables import load

SALES_SQL = """
SELECT product_id, CAST(SUM({amount} * {price}) AS DOUBLE) AS total_sales
FROM {view}
GROUP BY product_id
"""


def _exact(df: DataFrame, column: str, scale: int | None) -> str:
    """SQL text of a column as a decimal of its own or the stated scale; a value with more decimals raises."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DecimalType, T.IntegralType)):
        return column
    if scale is None:
        raise ValueError(f"state the scale (number of decimals) of the {kind.simpleString()} column {column!r}")
    dec = f"DECIMAL(18,{scale})"
    return (f"CASE WHEN {column} IS NULL OR CAST(CAST({column} AS {dec}) AS {kind.simpleString()}) = {column} "
            f"THEN CAST({column} AS {dec}) "
            f"ELSE CAST(raise_error('{column} has more than {scale} decimals: ' || {column}) AS {dec}) END")


def declare_sales_view(spark: SparkSession, lineitem: DataFrame, view: str) -> str:
    """The DDL part over any lineitem-shaped frame, batch or streaming."""
    lineitem.createOrReplaceTempView(f"{view}_lineitem")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW {view} AS
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS order_id,
               l_partkey AS product_id,
               l_quantity AS amount,
               l_extendedprice AS price,
               current_timestamp() AS proc_time
        FROM {view}_lineitem
    """)
    return view


def register_sales_view(spark: SparkSession, sf_dir: str, view: str = "kf_sales_orders") -> str:
    """Declare the sales table over lineitem: order line = sale of a part.

    ``proc_time`` is the processing-time attribute (``PROCTIME()``); the
    aggregate never reads it, and column pruning drops it.  The base table is
    a temp view over the parquet scan (spread over the cores when it comes as
    a single split; see :func:`keyflow.sources.tables.spread_rows`).
    """
    return declare_sales_view(spark, load(spark, sf_dir, "lineitem", spread=True), view)


def sales_per_product(spark: SparkSession, view: str, scale: int | None = None) -> DataFrame:
    """``SELECT product_id, SUM(amount * price) AS total_sales ... GROUP BY product_id``.

    Decimal columns are summed as they are.  For floating columns ``scale`` states
    their decimals: they are summed exactly, and a value with more raises.
    """
    table = spark.table(view)
    return spark.sql(SALES_SQL.format(view=view, amount=_exact(table, "amount", scale), price=_exact(table, "price", scale)))
