"""Property: chunked running sums and lead equal the plain window for any keys, ties and chunk size."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from keyflow.operators import next_in_key, running_sums

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]),      # key (hot, cold, null)
              st.integers(min_value=-5, max_value=40),      # order value with many ties
              st.integers(min_value=-100, max_value=100)),  # measure
    min_size=1, max_size=120)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=8, deadline=None)
@given(rows=rows_strategy, rows_per_chunk=st.integers(min_value=1, max_value=30))
def test_running_sums_property(spark, rows, rows_per_chunk):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)],
                               "key string, t long, seq long, v long")
    got = running_sums(df, ["key"], ["t", "seq"], {"s": F.col("v"), "n": F.lit(1)},
                       rows_per_chunk=rows_per_chunk)
    w = Window.partitionBy("key").orderBy("t", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"))
    assert _rows(got) == _rows(want)


@settings(max_examples=6, deadline=None)
@given(rows=rows_strategy, rows_per_chunk=st.integers(min_value=1, max_value=30))
def test_next_in_key_property(spark, rows, rows_per_chunk):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)],
                               "key string, t long, seq long, v long")
    got = next_in_key(df, ["key"], ["t", "seq"], ["v"], rows_per_chunk=rows_per_chunk)
    w = Window.partitionBy("key").orderBy("t", "seq")
    want = df.select("*", F.lead("v").over(w).alias("next_v"),
                     F.lead(F.lit(True)).over(w).isNotNull().alias("next_exists"))
    assert _rows(got) == _rows(want)
