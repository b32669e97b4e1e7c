"""Edge cases: empty inputs, nulls, single items, text-file streams."""

import datetime as dt

from pyspark.sql import functions as F

from keyflow.functions import parse_page_log
from keyflow.operators import (cooccurrence, fraud_pairs, next_in_key, retract_changelog,
                               rolling_cooccurrence, running_sums, word_count)
from keyflow.session import shared_path
from keyflow.sources import text_stream


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "key string, t long, v double")
    assert running_sums(empty, ["key"], ["t"], {"n": F.lit(1)}, rows_per_chunk=1).count() == 0
    assert next_in_key(empty, ["key"], ["t"], ["v"], rows_per_chunk=1).count() == 0
    assert retract_changelog(empty, "key", ["t"], "v", scale=2).count() == 0
    assert word_count(spark.createDataFrame([], "text string")).count() == 0
    cards = spark.createDataFrame([], "card string, amount double, location string, ts timestamp_ntz")
    assert fraud_pairs(cards).count() == 0


def test_cooccurrence_single_item_and_nulls(spark):
    one = spark.createDataFrame([("u", "A"), ("v", "A"), ("u", None)], "u string, item string")
    assert cooccurrence(one, "u", "item").count() == 0
    two = spark.createDataFrame([("u", "A"), ("u", None), ("u", "B"), (None, "A"), (None, "B")],
                                "u string, item string")
    got = {(r.item_a, r.item_b): r.cnt for r in cooccurrence(two, "u", "item").collect()}
    assert got == {("A", "B"): 2}   # the null user is one user, as a group key


def test_rolling_cooccurrence_single_user_single_item(spark):
    df = spark.createDataFrame([(i, "u", "A") for i in range(5)], "seq long, u string, item string")
    assert rolling_cooccurrence(df, "u", "item", ["seq"]).count() == 0


def test_text_file_stream_into_page_parser(spark):
    base = shared_path(spark, "tests", "text", fresh=True)
    spark.createDataFrame([("1|u|/a",), ("bad",), ("2|v|/b|x",)], "value string") \
        .coalesce(1).write.text(f"{base}/in")
    lines = text_stream(spark, f"{base}/in").withColumnRenamed("value", "line")
    pages = parse_page_log(lines, "line", keep=("arrival",))
    q = (pages.writeStream.format("memory").queryName("kf_text_pages")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.page for r in spark.sql("SELECT page FROM kf_text_pages").collect())
    assert got == ["/a", "/b"]
    assert all(isinstance(r.arrival, dt.datetime) for r in spark.sql("SELECT * FROM kf_text_pages").collect())
