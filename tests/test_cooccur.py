"""Co-occurrence totals (A14, C6), blocked Gram paths vs brute force, rolling form, top-k."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from keyflow.operators import cooccurrence, related_items, rolling_cooccurrence

VIEWS = [("user1", "itemA"), ("user2", "itemB"), ("user1", "itemC"), ("user3", "itemA"),
         ("user2", "itemC"), ("user1", "itemB"), ("user3", "itemD")]


def views_df(spark, rows=VIEWS):
    return spark.createDataFrame([(i, u, it) for i, (u, it) in enumerate(rows)],
                                 "seq long, user_id string, item string")


def brute_force(rows):
    """The per-event pairing: each new view pairs with every earlier view of the user."""
    hist, out = {}, Counter()
    for u, it in rows:
        for prev in hist.get(u, []):
            if prev != it:
                out[tuple(sorted((prev, it)))] += 1
        hist.setdefault(u, []).append(it)
    return dict(out)


def as_dict(df):
    return {(r.item_a, r.item_b): r.cnt for r in df.collect()}


def test_totals_fixture_a14(spark):
    got = as_dict(cooccurrence(views_df(spark), "user_id", "item"))
    assert got == {("itemA", "itemB"): 1, ("itemA", "itemC"): 1, ("itemA", "itemD"): 1,
                   ("itemB", "itemC"): 2}


def test_repeats_count_and_no_self_pairs_fixture_c6(spark):
    df = views_df(spark, [("u", "A"), ("u", "A"), ("u", "B")])
    assert as_dict(cooccurrence(df, "user_id", "item")) == {("A", "B"): 2}


@pytest.mark.parametrize("block", [3, 7, 512])
def test_blocks_of_items_equal_per_event_pairing(spark, block):
    # a hot user with many repeated views, a dense cluster and sparse users
    rows = [("hot", f"i{(k * 7) % 23}") for k in range(300)]
    rows += [(f"u{k % 40}", f"i{(k * 5 + k // 40) % 23}") for k in range(400)]
    rows += [(f"s{k}", f"i{k % 23}") for k in range(30)]
    got = as_dict(cooccurrence(views_df(spark, rows), "user_id", "item", block=block))
    assert got == brute_force(rows)


def test_weights(spark):
    df = spark.createDataFrame([("u1", "A", 2), ("u1", "B", 3), ("u2", "B", 1), ("u2", "C", 4)],
                               "u string, item string, n long")
    assert as_dict(cooccurrence(df, "u", "item", weight="n")) == {("A", "B"): 6, ("B", "C"): 4}


def test_counts_beyond_double_precision_stay_exact(spark):
    n = 3_037_000_499  # n * n is beyond 2**53
    df = spark.createDataFrame([("u", "A", n), ("u", "B", n)], "u string, item string, n long")
    assert as_dict(cooccurrence(df, "u", "item", weight="n")) == {("A", "B"): n * n}


def test_large_catalogue_and_a_user_with_a_third_of_the_rows(spark):
    """100,000 items; the hot user's pairs are dealt over all tasks in blocks of items."""
    hot = spark.range(20_000).select(F.lit("hot").alias("u"), F.concat(F.lit("i"), (F.col("id") * 7 % 1500).cast("string")).alias("item"))
    cold = spark.range(40_000).select(F.concat(F.lit("u"), (F.col("id") % 10_000).cast("string")).alias("u"),
                                      F.concat(F.lit("i"), (F.col("id") * 99_991 % 100_000).cast("string")).alias("item"))
    views = hot.unionByName(cold)
    got = cooccurrence(views, "u", "item", block=256).agg(F.count(F.lit(1)), F.sum("cnt")).first()
    n = views.groupBy("u", "item").count()
    per_user = n.groupBy("u").agg(F.sum("count").alias("s"), F.sum(F.col("count") * F.col("count")).alias("q"))
    want = per_user.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0]
    assert got[1] == want and got[0] >= 1500 * 1499 // 2


@pytest.mark.parametrize("dense_max", [64, 0])
def test_rolling_fixture_a14(spark, dense_max):
    out = rolling_cooccurrence(views_df(spark), "user_id", "item", ["seq"], dense_max=dense_max)
    got = [(r.seq, r.item_a, r.item_b, r.inc, r.cnt) for r in out.orderBy("seq", "item_a", "item_b").collect()]
    assert got == [(2, "itemA", "itemC", 1, 1), (4, "itemB", "itemC", 1, 1),
                   (5, "itemA", "itemB", 1, 1), (5, "itemB", "itemC", 1, 2), (6, "itemA", "itemD", 1, 1)]


@pytest.mark.parametrize("dense_max", [64, 0])
@pytest.mark.parametrize("rows_per_chunk", [4, 10_000])
def test_rolling_final_totals_equal_totals(spark, rows_per_chunk, dense_max):
    rows = [(f"u{k % 6}", f"i{(k * 3) % 5}") for k in range(90)]
    out = rolling_cooccurrence(views_df(spark, rows), "user_id", "item", ["seq"],
                               dense_max=dense_max, rows_per_chunk=rows_per_chunk)
    final = {(r.item_a, r.item_b): r.cnt for r in
             out.groupBy("item_a", "item_b").agg(F.max("cnt").alias("cnt")).collect()}
    assert final == brute_force(rows)
    incs = {(r.item_a, r.item_b): r.s for r in out.groupBy("item_a", "item_b").agg(F.sum("inc").alias("s")).collect()}
    assert incs == final


def test_related_items_top_k(spark):
    pairs = spark.createDataFrame([("A", "B", 5), ("A", "C", 5), ("A", "D", 1), ("B", "C", 2)],
                                  "item_a string, item_b string, cnt long")
    got = [(r.item, r.related, r.rank) for r in related_items(pairs, k=2).orderBy("item", "rank").collect()]
    assert got == [("A", "B", 1), ("A", "C", 2), ("B", "A", 1), ("B", "C", 2), ("C", "A", 1),
                   ("C", "B", 2), ("D", "A", 1)]
