"""Mixing sources to target weights by the cube method (operator 6).

Sources get target totals: weights share ``budget`` times all sizes, a target
stops at ``most`` times its source's size, and the excess is shared again by
weight until no target is above (water filling).  A source whose target is t
times its size takes every document floor(t) times; the rest is an inclusion
probability p = t - floor(t), which the cube method turns into whole copies.

Flight: the vector of probabilities moves inside the unit cube along the null
space of two constraints, the total of sizes and the number of documents, until
at most two documents of a block stay fractional.  A move uses three documents
with direction (s2 - s3, s3 - s1, s1 - s2) and goes either way with the chances
that keep every probability on average.  Blocks of a source fly on their own;
what they leave fractional meets in larger blocks until a source's rest fits in
one.  Landing: in a source's last block ``LANDING`` documents stay out of the flight; of the 0/1 choices for
them and the flight's rest, the one nearest to the size total, then to the
document total, is taken.

Equal rows (same id, source and size) are gathered first: m of them take
floor(m p) copies for sure and one fractional copy flies.  Everything is seeded
by the rows' own values, so reruns agree whatever the partitioning.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; an empty text takes nothing; with a total of 0 all targets are 0;
an empty table gives an empty result; repeated rows share their copies.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import marked_in, numbered, saved, table

# Fixed values of the contract: weights in the order of sources, and the budget.
WEIGHTS = (3, 1, 2)
BUDGET = Fraction(3, 2)
MOST = 2
#: Documents that fly in one task.
BLOCK_ROWS = 20_000
#: Documents kept for the landing besides the (at most two) that the flight leaves.
LANDING = 12
EPS = 1e-9


def word_count(text: Column) -> Column:
    """Number of words between the characters 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: Fraction = BUDGET, most: int = MOST) -> DataFrame:
    """(source, source_size, n_docs, target) of every source; ``sizes`` has (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                         F.count(F.lit(1)).alias("n_docs"))
    ordered = saved(totals.orderBy(F.col("source").asc_nulls_last())
                          .withColumn("_row", F.monotonically_increasing_id()), "sources")
    # place in the order: rows of the range partitions before, plus the row's own
    part = F.shiftright("_row", 33)
    counts = ordered.groupBy(part.alias("p")).count().collect()  # one row for each partition of the sort
    offset, before = F.lit(0), 0
    for p, n in sorted((r["p"], r["count"]) for r in counts):
        offset = F.when(part == p, F.lit(before)).otherwise(offset)
        before += n
    place = (offset + F.col("_row").bitwiseAND((1 << 33) - 1)).cast("long")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    ordered = ordered.withColumn("weight", weight.cast("long"))

    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    level, capped = Fraction(0), -1
    while True:  # each round caps at least one more source, or ends
        above = F.lit(level.numerator).cast("decimal(38,0)") * F.col("weight") > (
            F.lit(most * level.denominator).cast("decimal(38,0)") * F.col("source_size"))
        r = ordered.agg(F.count_if(above).alias("n"), F.sum(F.when(above, F.col("source_size"))).alias("size"),
                        F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if r["n"] == capped or not r["weight"]:
            break
        capped = r["n"]
        level = (budget * total - most * (r["size"] or 0)) / r["weight"]
    share = F.col("weight") * F.lit(float(level))
    target = F.least(share, (F.col("source_size") * most).cast("double"))
    return ordered.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities until at most two are fractional; totals of ``size`` and of documents stay."""
    p = p.astype(float)
    draws = iter(rng.random(3 * len(p) + 3).tolist())
    values, sizes = p.tolist(), size.tolist()
    pool: list[int] = []
    waiting = iter([i for i, v in enumerate(values) if EPS < v < 1 - EPS])
    while True:
        while len(pool) < 3 and (i := next(waiting, None)) is not None:
            pool.append(i)
        if len(pool) == 3:
            a, b, c = (sizes[i] for i in pool)
            move = [b - c, c - a, a - b]
            if not any(move):
                move = [1, -1, 0]
        elif len(pool) == 2 and sizes[pool[0]] == sizes[pool[1]]:
            move = [1, -1]
        else:
            break
        ahead = min(((1 - values[i]) if m > 0 else values[i]) / abs(m)
                    for i, m in zip(pool, move, strict=True) if m)
        back = min((values[i] if m > 0 else (1 - values[i])) / abs(m)
                   for i, m in zip(pool, move, strict=True) if m)
        step = ahead if next(draws) * (ahead + back) < back else -back
        for i, m in zip(pool, move, strict=True):
            values[i] += step * m
            if values[i] < EPS:
                values[i] = 0.0
            elif values[i] > 1 - EPS:
                values[i] = 1.0
        pool = [i for i in pool if 0.0 < values[i] < 1.0]
    return np.array([0.0 if v <= EPS else 1.0 if v >= 1 - EPS else v for v in values])


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whole numbers for the few that are left: nearest size total, then nearest number of documents."""
    left = np.flatnonzero((p > 0) & (p < 1))
    bits = np.arange(1 << len(left))
    take = (bits[:, None] >> np.arange(len(left)) & 1).astype(float)
    off = take - p[left]
    best = np.lexsort((bits, np.round(np.abs(off.sum(1)), 6), np.round(np.abs(off @ size[left]), 6)))[0]
    out = p.copy()
    out[left] = take[best]
    return out


_UNIT = T.StructType([T.StructField("unit", T.StringType()), T.StructField("source", T.StringType()),
                      T.StructField("size", T.LongType()), T.StructField("p", T.DoubleType()),
                      T.StructField("last", T.BooleanType())])


def _fly(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("unit", kind="stable").reset_index(drop=True)
    last = bool(pdf["last"].iloc[0])
    kept = LANDING if last else 0
    p, size = pdf["p"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
    seed = [int(pdf["unit"].iloc[0][:12], 16), len(pdf)]
    p[kept:] = flight(p[kept:], size[kept:], np.random.default_rng(seed))
    if last:
        p = landing(p, size)
    return pdf.assign(p=p)[["unit", "source", "size", "p", "last"]]


def cube_sample(units: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(unit, taken) with taken 0 or 1 for units (unit: hex key, source, size, p) with 0 < p < 1."""
    done: list[DataFrame] = []
    names = ["unit", "source", "size", "p"]
    left = units.select(*names)
    while True:
        counts = left.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("blocks"))
        blocked = (left.alias("u").join(counts.alias("c"), F.col("u.source").eqNullSafe(F.col("c.source")))
                       .select("u.*", (F.col("blocks") == 1).alias("last"),
                               F.pmod(F.xxhash64("unit", F.lit(len(done))), "blocks").alias("_block")))
        flown = saved(blocked.groupBy("source", "_block").applyInPandas(_fly, _UNIT), "flight")
        fractional = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.filter(~fractional).select("unit", F.col("p").cast("int").alias("taken")))
        left = flown.filter(fractional).select(*names)
        if left.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def plan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights=WEIGHTS, budget: Fraction = BUDGET, most: int = MOST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for all equal (doc_id, source, size): rows, target, base copies of each, extras among them."""
    sizes = saved(df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                            F.col(f"`{source}`").cast("string").alias("source"),
                            word_count(F.col(f"`{text}`")).alias("size"))
                    .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    targets = source_targets(sizes.select("source", (F.col("size") * F.col("rows")).alias("size")),
                             weights, budget, most)
    ratio = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(F.lit(0.0))
    unit = F.sha2(F.concat_ws("|", F.coalesce(F.col("s.doc_id").cast("string"), F.lit("-")),
                              F.hex(F.coalesce(F.col("s.source"), F.lit(""))),
                              F.col("s.source").isNull().cast("string"), F.col("s.size").cast("string")), 256)
    joined = (sizes.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
                   .select("s.*", "t.source_size", "t.target", unit.alias("unit"), ratio.alias("ratio")))
    whole = F.floor(F.col("ratio"))
    extra = F.col("rows") * (F.col("ratio") - whole)
    sure = F.floor(extra)
    planned = joined.withColumns({"base": whole.cast("int"), "sure": sure.cast("long"), "p": extra - sure})
    inside = (F.col("p") > EPS) & (F.col("p") < 1 - EPS) & (F.col("size") > 0)
    flown = cube_sample(planned.filter(inside).select("unit", "source", "size", "p"), block_rows)
    extras = F.col("sure") + F.coalesce("taken", (F.col("p") >= 1 - EPS).cast("int"))
    return planned.join(flown, "unit", "left").select(
        "doc_id", "source", "size", "rows", "source_size", "target", "base", extras.alias("extras"))


def mixed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df`` that the mix takes, each as often as it takes it; columns as in ``df``.

    A bit table for each number of copies tells most rows theirs where they lie: each row is
    in one of them for sure, so a single mark decides.  Rows with several marks, and rows that
    equal others, meet the plan in an exact join.
    """
    of = saved(plan(df, doc_id, text, source, **options), "plan").select(
        F.col("doc_id").alias("_kf_id"), F.col("source").alias("_kf_source"), F.col("size").alias("_kf_size"),
        F.col("rows").alias("_kf_rows"), F.col("base").alias("_kf_base"), F.col("extras").alias("_kf_extras"))
    key = F.xxhash64("_kf_id", "_kf_source", "_kf_size")
    alone = F.when(F.col("_kf_rows") == 1, F.col("_kf_base") + F.col("_kf_extras"))  # the copies of a row without equals
    times = range(options.get("most", MOST) + 1)
    hashed = df.withColumn("_kf_hash", F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{source}`").cast("string"),
                                                  word_count(F.col(f"`{text}`"))))
    marked = marked_in(hashed, "_kf_hash", [of.filter(alone.isNull() | (alone == n)).select(key.alias("key")) for n in times])
    sure = F.element_at(F.create_map(*[F.lit(x) for n in times for x in (1 << n, n)]), F.col("_kf_marks"))
    marked = marked.withColumn("_kf_sure", sure).drop("_kf_hash", "_kf_marks")
    rows = marked.filter("_kf_sure is null").alias("d").join(
        of.alias("p"), F.col(f"d.`{doc_id}`").cast("long").eqNullSafe(F.col("p._kf_id"))
        & F.col(f"d.`{source}`").cast("string").eqNullSafe(F.col("p._kf_source"))
        & (word_count(F.col(f"d.`{text}`")) == F.col("p._kf_size")))
    single = rows.filter(F.col("_kf_rows") == 1).withColumn("_kf_nth", F.lit(0).cast("long"))
    if not of.filter(F.col("_kf_rows") > 1).isEmpty():
        several = numbered(rows.filter(F.col("_kf_rows") > 1), ["_kf_id", "_kf_source", "_kf_size"], "_kf_nth")
        single = single.unionByName(several)
    copies = F.col("_kf_base") + (F.col("_kf_nth") < F.col("_kf_extras")).cast("int")
    names = [f"`{c}`" for c in df.columns]
    taken = (single.withColumn("_kf_copies", copies.cast("int")).select(*names, "_kf_copies")
                   .unionAll(marked.select(*names, F.col("_kf_sure").alias("_kf_copies")))  # null: not sure
                   .filter(F.col("_kf_copies") > 0))
    return (taken.withColumn("_kf_copy", F.explode(F.sequence(F.lit(1), F.col("_kf_copies"))))
                 .select(*names))


def op6_mixing(spark, sf_dir):
    """The mix of all documents: size, target of the source, and words taken."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    each = plan(docs).withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.col("base") + (F.col("_nth") <= F.col("extras")).cast("int")
    return each.select("doc_id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"),
                       (copies * F.col("size")).cast("long").alias("taken"))
