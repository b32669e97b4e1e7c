"""Running state (A9, A10, A11), skew-safe scans, patterns (A12, C5), changelog (C7, A16)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keyflow.operators import (fold_changelog, fraud_pairs, next_in_key, parity_counter,
                               retract_changelog, running_average, running_count, running_sums)

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_running_count_fixture_a9(spark):
    rows = [(1, "user1"), (2, "user2"), (3, "user1"), (4, "user3"), (5, "user2"), (6, "user1")]
    df = spark.createDataFrame(rows, "seq long, user_id string")
    got = [(r.user_id, r.cnt) for r in running_count(df, ["user_id"], ["seq"]).orderBy("seq").collect()]
    assert got == [("user1", 1), ("user2", 1), ("user1", 2), ("user3", 1), ("user2", 2), ("user1", 3)]


def test_running_average_fixture_a10(spark):
    rows = [(1, "s1", 10.5), (2, "s1", 11.2), (3, "s2", 22.1), (4, "s1", 12.8), (5, "s2", 23.4)]
    df = spark.createDataFrame(rows, "seq long, sensor string, reading double")
    got = [r.avg_value for r in running_average(df, ["sensor"], ["seq"], "reading", scale=1).orderBy("seq").collect()]
    assert got == pytest.approx([10.5, 10.85, 22.1, 11.5, 22.75], abs=1e-9)


def test_parity_counter_fixture_a11(spark):
    df = spark.range(0, 40).withColumnRenamed("id", "v")
    for r in parity_counter(df, "v").collect():
        assert r.cnt == r.v // 2 + 1
        assert r.message == f"Key: {r.v % 2}, Value: {r.v}, CountForThisKey: {r.cnt}"


@pytest.mark.parametrize("rows_per_chunk", [7, 50, 10_000])
def test_chunked_running_sums_equal_plain_window(spark, rows_per_chunk):
    # one hot key holding most rows, a few cold keys, a null key and ties in time
    df = spark.range(0, 600).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 9, F.lit(None))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).alias("key"),
        (F.col("id") / 4).cast("long").alias("t"), F.col("id").alias("seq"),
        (F.col("id") % 13).cast("decimal(10,2)").alias("v"))
    got = running_sums(df, ["key"], ["t", "seq"], {"n": F.lit(1), "s": F.col("v")},
                       rows_per_chunk=rows_per_chunk)
    w = Window.partitionBy("key").orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.count(F.lit(1)).over(w).alias("n"), F.sum("v").over(w).alias("s"))
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("rows_per_chunk", [5, 10_000])
def test_chunked_next_in_key_equals_lead(spark, rows_per_chunk):
    df = spark.range(0, 300).select(
        F.when(F.col("id") % 5 < 4, F.lit(1)).otherwise(F.col("id") % 2).alias("key"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") * 10).alias("x"))
    got = next_in_key(df, ["key"], ["t"], ["x", "t"], rows_per_chunk=rows_per_chunk)
    w = Window.partitionBy("key").orderBy("t")
    want = df.select("*", F.lead("x").over(w).alias("next_x"), F.lead("t").over(w).alias("next_t"),
                     F.lead(F.lit(True)).over(w).isNotNull().alias("next_exists"))
    assert _rows(got) == _rows(want)


def _txn(spark, rows):
    return spark.createDataFrame(
        [(c, a, loc, T0 + dt.timedelta(milliseconds=ms), i) for i, (c, a, loc, ms) in enumerate(rows)],
        "card string, amount double, location string, ts timestamp_ntz, seq long")


def test_fraud_pairs_fixture_a12(spark):
    minute = 60_000
    df = _txn(spark, [("card1", 10.0, "New York", 0), ("card1", 15.0, "London", minute),
                      ("card2", 20.0, "Paris", 0), ("card1", 5.0, "Tokyo", 2 * minute),
                      ("card2", 100.0, "Paris", 3 * minute)])
    got = fraud_pairs(df, order=["ts", "seq"]).orderBy("first_ts").collect()
    assert [(r.card, r.first_amount, r.first_location, r.second_amount, r.second_location) for r in got] == [
        ("card1", 10.0, "New York", 15.0, "London"), ("card1", 15.0, "London", 5.0, "Tokyo")]
    millis = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert got[0].alert == (f"Potential Fraud Detected for Card: card1 - Transaction 1: 10.0 at New York "
                            f"(Time: {millis}) - Transaction 2: 15.0 at London (Time: {millis + minute})")


@pytest.mark.parametrize("rows_per_chunk", [2, 10_000])
def test_fraud_pairs_fixture_c5(spark, rows_per_chunk):
    five = 5 * 60_000
    df = _txn(spark, [
        ("a", 1.0, "x", 0), ("a", 99.0, "y", 1000), ("a", 2.0, "z", 2000),      # large in between
        ("b", 1.0, "x", 0), ("b", 2.0, "y", five),                              # exactly 5 min
        ("c", 1.0, "x", 0), ("c", 2.0, "y", five - 1),                          # 5 min - 1 ms
        ("d", 1.0, "x", 0), ("d", 2.0, "x", 1000)])                             # same place
    got = fraud_pairs(df, order=["ts", "seq"], rows_per_chunk=rows_per_chunk).collect()
    assert [r.card for r in got] == ["c"]


def test_changelog_fixture_c7_and_fold(spark):
    df = spark.createDataFrame([("p", 1, 10.0), ("p", 2, 5.0), ("p", 3, 0.0), ("q", 1, 2.5)],
                               "product string, seq int, sale double")
    out = retract_changelog(df, "product", ["seq"], "sale", scale=1)
    got = [(r.product, r.seq, r.op, r.total) for r in out.orderBy("product", "seq", F.col("op").desc()).collect()]
    assert got == [("p", 1, "+", 10.0), ("p", 2, "-", 10.0), ("p", 2, "+", 15.0), ("q", 1, "+", 2.5)]
    folded = {r.product: r.total for r in fold_changelog(out, "product").collect()}
    assert folded == {"p": 15.0, "q": 2.5}


@pytest.mark.parametrize("rows_per_chunk", [3, 10_000])
def test_changelog_folds_to_grouped_sum(spark, rows_per_chunk):
    df = spark.range(0, 200).select((F.col("id") % 4).alias("product"), F.col("id").alias("seq"),
                                    ((F.col("id") * 37) % 101 / 4).alias("sale"))
    out = retract_changelog(df, "product", ["seq"], "sale", scale=2, rows_per_chunk=rows_per_chunk)
    folded = {r.product: r.total for r in fold_changelog(out, "product").collect()}
    want = {r.product: r.s for r in df.groupBy("product").agg(F.sum("sale").alias("s")).collect()}
    assert folded == pytest.approx(want)


@pytest.mark.parametrize("order", [["t"], ["hot", "t"], ["hot", "d", "t"]])
@pytest.mark.parametrize("rows_per_chunk", [1, 7, 10_000])
def test_text_orders_and_one_hot_timestamp_are_cut_too(spark, rows_per_chunk, order):
    """A text order, all rows at one time, a null and a decimal in the order: equal to the plain window at any chunk size."""
    df = spark.range(0, 200).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 2).cast("string"))).alias("key"),
        F.lit(T0).cast("timestamp_ntz").alias("hot"), F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("decimal(8,3)")).alias("d"),
        F.concat(F.lit("same prefix é"), F.lpad((F.col("id") * 37 % 200).cast("string"), 4, "0")).alias("t"), F.col("id").alias("v"))
    w = Window.partitionBy("key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    got = running_sums(df, ["key"], order, {"s": F.col("v")}, rows_per_chunk=rows_per_chunk)
    assert _rows(got) == _rows(df.select("*", F.sum("v").over(w).alias("s")))
    lead = Window.partitionBy("key").orderBy(*order)
    nxt = next_in_key(df, ["key"], order, ["v"], rows_per_chunk=rows_per_chunk)
    assert _rows(nxt) == _rows(df.select("*", F.lead("v").over(lead).alias("next_v"), F.lead("v").over(lead).isNotNull().alias("next_exists")))


def test_one_hot_timestamp_gives_bounded_chunks(spark):
    from keyflow.operators.scan import CHUNK, add_chunks
    df = spark.range(20_000).select(F.lit("hot").alias("key"), F.lit(T0).alias("ts"), F.col("id"))
    chunked, did = add_chunks(df, ["ts", "id"], 1_000)
    assert did and chunked.groupBy("key", CHUNK).count().agg(F.max("count")).first()[0] <= 1_600


def test_small_amounts_are_summed_and_not_rounded(spark):
    df = spark.createDataFrame([("s", i, 0.00004) for i in range(5)], "k string, t int, v double")
    assert [r.avg_value for r in running_average(df, ["k"], ["t"], "v", scale=5).collect()] == [0.00004] * 5
    log = retract_changelog(df, "k", ["t"], "v", scale=5)
    assert {r.total for r in log.collect()} == {0.00004, 0.00008, 0.00012, 0.00016, 0.0002}


def test_a_value_with_more_decimals_than_stated_raises(spark):
    from keyflow.operators import sales_per_product
    df = spark.createDataFrame([("s", 1, 0.00004)], "k string, t int, v double")
    for run in (lambda: running_average(df, ["k"], ["t"], "v", scale=4), lambda: retract_changelog(df, "k", ["t"], "v", scale=4)):
        with pytest.raises(Exception, match="more than 4 decimals"):
            run().collect()
    with pytest.raises(ValueError, match="state the scale"):
        running_average(df, ["k"], ["t"], "v")
    df.select(F.lit(1).alias("product_id"), F.col("v").alias("amount"), F.lit(2.5).alias("price")).createOrReplaceTempView("kf_small")
    assert sales_per_product(spark, "kf_small", scale=5).first().total_sales == 0.0001
    with pytest.raises(Exception, match="more than 2 decimals"):
        sales_per_product(spark, "kf_small", scale=2).collect()


def test_decimal_and_integer_columns_bring_their_scale(spark):
    df = spark.createDataFrame([("s", 1, 3), ("s", 2, 4)], "k string, t int, v int")
    assert [r.avg_value for r in running_average(df, ["k"], ["t"], "v").orderBy("t").collect()] == [3.0, 3.5]
    dec = df.withColumn("v", (F.col("v") / 1000).cast("decimal(12,6)"))
    assert [r.avg_value for r in running_average(dec, ["k"], ["t"], "v").orderBy("t").collect()] == [0.003, 0.0035]
