"""Item co-occurrence (O-45, O-49) and related items (X-1).

Co-occurrence of items a < b is C[a, b] = sum over users of n(u, a) * n(u, b),
where n counts a user's views of an item: every pair of views of different
items by one user counts once, repeats included, as the reference's
per-event pairing counts it.

The whole computation stays in the JVM and in integers:

* views are pre-aggregated to (user, item, n) before any shuffle, and a user's
  items are gathered in one sorted array, so repeats never multiply rows;
* pairs a < b are generated from that array and summed per pair within the task
  before the shuffle of the totals;
* a user with more than ``BLOCK`` items is cut into blocks of items.  The pairs of
  blocks are dealt over all tasks, so a user with a third of all views is not one
  task's work; a pair of blocks yields at most BLOCK x BLOCK pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.operators.scan import running_sums

#: Items of a block of one user.
BLOCK = 512


def cooccurrence(df: DataFrame, user: str, item: str, weight: str | None = None, block: int = BLOCK) -> DataFrame:
    """Totals per unordered item pair: columns ``item_a < item_b``, ``cnt`` (bigint).

    Each row is one view; ``weight`` (a count column) lets callers pass views
    already pre-aggregated upstream.  Pairs of the same item are excluded; pairs
    that never co-occur are absent; rows without an item are ignored; a null user
    is one user.
    """
    views = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    counts = (df.filter(F.col(item).isNotNull())
                .groupBy(F.col(user).alias("_u"), F.col(item).alias("item"))
                .agg(views.cast("bigint").alias("n")))
    baskets = counts.groupBy("_u").agg(F.sort_array(F.collect_list(F.struct("item", "n"))).alias("items"))
    small = baskets.filter(F.size("items").between(2, block)).select(F.col("items").alias("left"), F.col("items").alias("right"),
                                                                     F.lit(True).alias("same"))
    cells = (F.size("items") - 1) / block
    blocks = F.transform(F.sequence(F.lit(0), F.floor(cells).cast("int")),
                         lambda i: F.struct(i.alias("i"), F.slice("items", i * block + 1, block).alias("part")))
    large = (baskets.filter(F.size("items") > block).select("_u", blocks.alias("parts"))
                    .select("_u", "parts", F.explode("parts").alias("a"))
                    .select("_u", "a", F.explode(F.filter("parts", lambda p: p["i"] >= F.col("a.i"))).alias("b"))
                    .repartition("_u", "a.i", "b.i")
                    .select(F.col("a.part").alias("left"), F.col("b.part").alias("right"),
                            (F.col("a.i") == F.col("b.i")).alias("same")))
    each = (small.unionByName(large).select("right", "same", F.posexplode("left").alias("at", "a"))
                 # both sides are sorted: within one block the partners of an item follow it
                 .select("a", F.explode(F.when(F.col("same"), F.slice("right", F.col("at") + 2, block))
                                         .otherwise(F.col("right"))).alias("b")))
    return (each.groupBy(F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"))
                .agg(F.sum(F.col("a.n") * F.col("b.n")).alias("cnt")))


def related_items(pairs: DataFrame, k: int = 3) -> DataFrame:
    """Top-``k`` partners per item by co-occurrence (ties: smaller partner first).

    Each item has at most (catalogue size - 1) partners, so a per-item
    window is bounded by the catalogue, not by the number of views.
    """
    # both orientations of each pair from one pass over ``pairs`` (a union
    # would evaluate the co-occurrence twice)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("item_a").alias("item"), F.col("item_b").alias("related"), F.col("cnt")),
        F.struct(F.col("item_b").alias("item"), F.col("item_a").alias("related"), F.col("cnt")),
    )).alias("_e")).select("_e.item", "_e.related", "_e.cnt")
    w = Window.partitionBy("item").orderBy(F.col("cnt").desc(), F.col("related"))
    return (both.withColumn("rank", F.row_number().over(w))
                .filter(F.col("rank") <= k))


def rolling_cooccurrence(df: DataFrame, user: str, item: str, order: Sequence[str],
                         domain: Sequence | None = None, dense_max: int = 64,
                         rows_per_chunk: int | None = None) -> DataFrame:
    """Running pair totals as views arrive (the stateful per-user item history).

    For each view (user u, item x) and each other item y the user viewed
    before, the pair (min(x, y), max(x, y)) gains ``inc`` = number of those
    earlier views of y; ``cnt`` is the pair's running total after the view.
    One row per (view, earlier item) - the reference prints ``inc`` rows that
    count up to the same ``cnt``.

    Earlier views per item come from running counts:

    * small catalogues (``domain`` given or probed, at most ``dense_max``
      items): one running sum per catalogue item over the user's views;
    * otherwise: each view is joined with its own user's distinct items and a
      running count runs per (user, other item) - rows grow with the output,
      and no catalogue reaches the driver.

    Both running sums are skew-safe chunked scans, so a hot user or a hot
    pair is split across tasks.
    """
    order = list(order)
    if domain is None:
        probe = [r[0] for r in df.select(item).distinct().limit(dense_max + 1).collect()]
        if len(probe) <= dense_max:
            domain = probe
    views = df.select(user, item, *order)
    if domain is not None and len(domain) <= dense_max:
        domain = sorted(v for v in set(domain) if v is not None)
        measures = {f"_kf_v{j}": (F.col(item) == F.lit(v)).cast("int") for j, v in enumerate(domain)}
        seen = running_sums(views, [user], order, measures, rows_per_chunk=rows_per_chunk)
        earlier = F.array(*[
            F.struct(F.lit(v).alias("other"),
                     (F.col(f"_kf_v{j}") - (F.col(item) == F.lit(v)).cast("int")).alias("inc"))
            for j, v in enumerate(domain)])
        per_other = seen.select(user, item, *order, F.explode(earlier).alias("_kf_e")).select(
            user, item, *order, F.col("_kf_e.other").alias("_kf_other"), F.col("_kf_e.inc").alias("inc"))
    else:
        items = views.select(F.col(user).alias("_kf_u"), F.col(item).alias("_kf_other")).distinct()
        expanded = views.join(items, views[user] == items["_kf_u"]).drop("_kf_u")
        # rows of other items count 0 for themselves, so the inclusive count is "earlier views"
        per_other = running_sums(expanded, [user, "_kf_other"], order,
                                 {"inc": (F.col(item) == F.col("_kf_other")).cast("int")},
                                 rows_per_chunk=rows_per_chunk)
    incs = (per_other.filter((F.col("inc") > 0) & (F.col("_kf_other") != F.col(item)))
                     .select(user, item, *order,
                             F.least(F.col(item), F.col("_kf_other")).alias("item_a"),
                             F.greatest(F.col(item), F.col("_kf_other")).alias("item_b"),
                             F.col("inc").cast("bigint").alias("inc")))
    return running_sums(incs, ["item_a", "item_b"], order, {"cnt": F.col("inc")},
                        rows_per_chunk=rows_per_chunk)
