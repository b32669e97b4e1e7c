"""Window operators (fixtures A7, A8, C3, C4)."""

import datetime as dt

from pyspark.sql import functions as F

from keyflow.operators import page_alerts, page_views, window_count, window_sum

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)  # a multiple of 5 s


def disordered_events(spark):
    """15 events, names cycling A/B/C, time T0 + c s - (c % 3) * 2 s."""
    return spark.range(15).select(
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 3 + 1).cast("int")).alias("name"),
        (F.lit(T0) + F.make_dt_interval(secs=(F.col("id") - (F.col("id") % 3) * 2).cast("decimal(10,6)"))).alias("ts"))


def test_event_time_counts_fixture_a7(spark):
    counts = window_count(disordered_events(spark), "ts", ["name"], "5 seconds")
    got = {((r.window_start - T0).total_seconds(), r.name): r.cnt for r in counts.collect()}
    expected = {(-5, "B"): 1, (-5, "C"): 1, (0, "A"): 2, (0, "B"): 1, (0, "C"): 2,
                (5, "A"): 2, (5, "B"): 2, (5, "C"): 1, (10, "A"): 1, (10, "B"): 1, (10, "C"): 1}
    assert got == expected
    assert sum(got.values()) == 15


def test_arrival_window_sum_fixture_a8(spark):
    df = spark.range(12).select(F.lit("key").alias("key"), F.lit(1).alias("n"),
                                (F.lit(T0) + F.make_dt_interval(secs=F.col("id").cast("decimal(10,6)"))).alias("arrival"))
    got = sorted((r.window_start, r.total) for r in window_sum(df, "arrival", ["key"], "n", "5 seconds").collect())
    assert [t for _, t in got] == [5, 5, 2]


def test_threshold_fixture_c3(spark):
    rows = [("/hot", T0)] * 101 + [("/warm", T0)] * 100
    df = spark.createDataFrame(rows, "page string, arrival timestamp_ntz")
    alerts = page_alerts(df, "arrival", "5 seconds", 100).collect()
    assert [(r.page, r.cnt) for r in alerts] == [("/hot", 101)]
    assert alerts[0].alert.endswith("/hot 访问量异常: 101")


def test_sliding_fixture_c4(spark):
    df = spark.createDataFrame([("/a", T0 + dt.timedelta(seconds=7))], "page string, arrival timestamp_ntz")
    got = sorted(((r.window_start - T0).total_seconds(), (r.window_end - T0).total_seconds())
                 for r in page_views(df).collect())
    assert got == [(0, 10), (5, 15)]


def test_generated_disorder_source_matches_fixture(spark):
    from generators import disordered_events as gen
    counts = window_count(gen(spark, base=T0), "ts", ["name"], "5 seconds")
    assert counts.count() == 11
    assert sum(r.cnt for r in counts.collect()) == 15


def test_generated_orders_ranges(spark):
    from generators import generated_orders
    df = generated_orders(spark, 500)
    stats = df.agg(F.min("amount"), F.max("amount"), F.min("price"), F.max("price"),
                   F.countDistinct("product_id"), F.min(F.length("order_id"))).first()
    assert stats[0] >= 1 and stats[1] <= 5 and stats[2] >= 10 and stats[3] <= 100
    assert stats[4] == 3 and stats[5] == 10
    df.createOrReplaceTempView("kf_generated_orders")
    totals = spark.sql("SELECT product_id, SUM(amount * price) AS total_sales FROM kf_generated_orders "
                       "GROUP BY product_id").count()
    assert totals == 3
