"""Tolerant parsers for delimited log lines.  Rejected rows are kept, not lost.

Java's ``String.split`` drops trailing empty fields; Spark's ``split`` keeps
them, so trailing delimiters are trimmed first.  Patterns end with ``\\z``
(true end of input): ``$`` would also match before a final newline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_TEXT = r"^[+-]?[0-9]+\z"   # what Long.parseLong accepts (ASCII digits)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_fields(line: str | Column, delimiter: str) -> Column:
    """Split on a literal one-character delimiter, dropping trailing empty fields."""
    d = "\\" + delimiter if delimiter in r"\^$.|?*+()[]{}" else delimiter
    return F.split(F.regexp_replace(_c(line), f"(?:{d})+\\z", ""), d)


def parse_page_log(df: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """``ts|user|page`` lines → (page, keep...).  Lines with < 3 fields emit nothing (O-19)."""
    parts = split_fields(line, "|")
    return (df.select(*[F.col(k) for k in keep], parts.alias("_parts"))
              .filter(F.size("_parts") >= 3)
              .select(*[F.col(k) for k in keep], F.col("_parts").getItem(2).alias("page")))


BEHAVIOR_FIELDS = ("user_id", "item_id", "behavior_type", "ts_ms")


def parse_behavior(df: DataFrame, line: str = "line", keep: tuple[str, ...] = (),
                   with_reason: bool = True) -> DataFrame:
    """``user,item,type,ts_ms`` CSV records → typed columns plus ``reject_reason``.

    A record is accepted when it has exactly four fields (after trailing empty
    fields are dropped) and the fourth is a decimal integer that fits a long,
    the checks ``Long.parseLong`` makes.  Rejected records keep their line and
    get a reason; use :func:`accepted` / :func:`rejected` to split them.
    """
    src = df.select(*[F.col(k) for k in keep], F.col(line).alias("_kf_line"))
    parts = split_fields(F.col("_kf_line"), ",")
    # one-element explode: a filter on the reason stays above it, so the line is split once and not in every expression
    src = src.select("*", F.explode(F.array(parts)).alias("_kf_parts")).withColumn("_kf_ts_text", F.col("_kf_parts").getItem(3))
    well_sized = F.size("_kf_parts") == 4
    numeric = F.coalesce(F.col("_kf_ts_text").rlike(INTEGER_TEXT), F.lit(False))
    ts_ms = F.when(well_sized & numeric, F.expr("try_cast(_kf_ts_text AS BIGINT)"))
    reason = (F.when(F.col("_kf_line").isNull(), F.lit("null_line"))
               .when(~well_sized, F.lit("field_count"))
               .when(~numeric, F.lit("bad_number"))
               .when(ts_ms.isNull(), F.lit("out_of_range")))
    ok = reason.isNull()
    cols = [F.col(k) for k in keep] + [F.col("_kf_line").alias(line)]
    for i, name in enumerate(BEHAVIOR_FIELDS[:3]):
        cols.append(F.when(ok, F.col("_kf_parts").getItem(i)).alias(name))
    cols.append(F.when(ok, ts_ms).alias("ts_ms"))
    if with_reason:
        cols.append(reason.alias("reject_reason"))
    return src.select(*cols)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


BEHAVIOR_JSON_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType()), T.StructField("itemId", T.StringType()),
    T.StructField("behaviorType", T.StringType()), T.StructField("timestamp", T.LongType()),
])


def parse_behavior_json(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON behaviour records (the variant the program's comments describe) → typed columns.

    Records that are not JSON objects or lack a field get ``reject_reason``.
    """
    parsed = F.from_json(F.col(value), BEHAVIOR_JSON_SCHEMA, {"mode": "PERMISSIVE"})
    src = df.select(*[F.col(k) for k in keep], F.col(value), parsed.alias("_kf_j"))
    j = F.col("_kf_j")
    complete = (j.isNotNull() & j["userId"].isNotNull() & j["itemId"].isNotNull()
                & j["behaviorType"].isNotNull() & j["timestamp"].isNotNull())
    return src.select(*[F.col(k) for k in keep], F.col(value),
                      F.when(complete, j["userId"]).alias("user_id"),
                      F.when(complete, j["itemId"]).alias("item_id"),
                      F.when(complete, j["behaviorType"]).alias("behavior_type"),
                      F.when(complete, j["timestamp"]).alias("ts_ms"),
                      F.when(~complete | j.isNull(), F.lit("malformed_json")).alias("reject_reason"))
