"""Exact top-k search with multi-resolution segment statistics (operator 5).

A vector is cut into 1, 2, 4, ... segments, each described by its mean and its
deviation from it.  For a query q and a candidate x,
``|q - x|^2 >= sum over segments of len * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2)``,
which bounds the inner product ``(|q|^2 + |x|^2 - |q - x|^2) / 2`` from above.
Candidates whose bound lies below a query's k-th best score so far are left out,
coarse level first, down to segments of two components; each level looks at the
survivors of the one before, and the last survivors' scores are computed exactly.

Candidates are packed into blocks of ``BLOCK`` vectors, queries into blocks of
``QUERY_BLOCK``; every pair of blocks is one unit of work.  A first pass pairs each
query block with one candidate block; the k-th best scores found there are the
scores to beat in all other blocks.  A pair of blocks whose envelopes (the ranges of
their vectors' coarse statistics) already bound all scores below these is left out as
a whole.  The k best of each query are merged over the candidate blocks.  The number
of pairs is queries times rows, as for any exact answer, but neither side is
broadcast or gathered.  ``survivors`` reports how many candidates each level leaves.

Defined cases: a vector that is null, or holds a null or non-finite component,
takes no part, nor does a row without id or an empty vector; every row is a
candidate of its own, so rows that repeat an id, or id and vector, are met one by
one, and a query meets all rows but itself; vectors of different lengths are not
compared; ties go to the smaller id; fewer candidates than k give fewer rows.
Scores beyond the range of a long are cut to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import saved, table

K = 5
BLOCK, QUERY_BLOCK = 4096, 512
SCALE = 256.0


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def scaled(vector: Column, scale: float = SCALE) -> Column:
    """floor(scale * x), x as double; kept as doubles, which hold whole numbers of any size here."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))


def levels(length: int) -> list[int]:
    """Numbers of segments, coarse to fine."""
    out, n = [], 1
    while n <= max(1, length // 2):
        out.append(n)
        n *= 2
    return out


def segment_statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, means, deviations) of ``segments`` segments of each row."""
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    lengths = np.diff(edges)
    means = np.add.reduceat(vectors, edges[:-1], axis=1) / lengths
    squares = np.add.reduceat(vectors * vectors, edges[:-1], axis=1) / lengths
    return lengths, means, np.sqrt(np.maximum(squares - means * means, 0))


def features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations, scaled so that their squared distances bound the vectors' from below."""
    lengths, means, deviations = segment_statistics(vectors, segments)
    root = np.sqrt(lengths)
    return np.concatenate([means * root, deviations * root], 1)


def bounds(q: np.ndarray, x: np.ndarray, segments: int) -> np.ndarray:
    """Upper bounds of all inner products, from the lower bounds of the distances."""
    a, b = features(q, segments), features(x, segments)
    nq, nx = (q * q).sum(1), (x * x).sum(1)
    distance = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return (nq[:, None] + nx[None, :] - distance) / 2 + slack(nq[:, None], nx[None, :])


def slack(nq, nx):
    """Room for rounding."""
    return 1e-6 * (nq + nx + 1)


def envelope_bound(q: np.ndarray, x: np.ndarray) -> float:
    """An upper bound of all inner products of two blocks, from the ranges of their coarsest statistics and norms."""
    a, b = features(q, 1), features(x, 1)
    gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
    nq, nx = (q * q).sum(1).max(), (x * x).sum(1).max()
    return min((nq + nx - (gap * gap).sum()) / 2, np.sqrt(nq * nx)) + slack(nq, nx)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole inner products of one query with some candidates."""
    top = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if top * top * len(q) < 2.0**53:
        return (x @ q).astype(np.int64)
    values = [sum(int(a) * int(b) for a, b in zip(q, row, strict=True)) for row in x]
    return np.array([max(-2**63, min(2**63 - 1, v)) for v in values], np.int64)


def best_of_block(q_rows: np.ndarray, q: np.ndarray, x_rows: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int,
                  floor: np.ndarray, left: np.ndarray | None = None):
    """The k best candidates of each query within one block: (query index, candidate index, score).

    ``floor`` has the scores to beat (-inf: none yet); ``left`` adds up the candidates left after each level.
    """
    if not len(q) or not len(x) or envelope_bound(q, x) < floor.min():
        return
    steps = levels(q.shape[1])
    upper = bounds(q, x, 1)
    alive = q_rows[:, None] != x_rows[None, :]
    upper[~alive] = -np.inf
    floor = floor.copy()
    open_ = np.flatnonzero(~np.isfinite(floor))
    if len(open_):  # no score to beat yet: the exact scores of the k most promising candidates
        probe = np.argpartition(-upper[open_], min(4 * k, len(x)) - 1, axis=1)[:, :4 * k]
        for i, some in zip(open_.tolist(), probe, strict=True):
            mine = some[alive[i, some]]
            if len(mine) >= k:
                floor[i] = np.sort(exact_scores(q[i], x[mine]))[-k]
    alive &= upper >= floor[:, None]
    finer = [(features(q, n), features(x, n)) for n in steps[1:]]
    nq, nx = (q * q).sum(1), (x * x).sum(1)
    for i in range(len(q)):
        some = np.flatnonzero(alive[i])
        counts = [len(some)]
        for a, b in finer:
            gap = b[some] - a[i]
            some = some[(nq[i] + nx[some] - (gap * gap).sum(1)) / 2 + slack(nq[i], nx[some]) >= floor[i]]
            counts.append(len(some))
        if left is not None:
            left += counts
        if len(some):
            scores = exact_scores(q[i], x[some])
            order = np.lexsort((x_ids[some], -scores.astype(object) if scores.min() == -2**63 else -scores))[:k]
            for j in order:
                yield i, some[j], scores[j]


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(n, block, blocks, rows, ids, vectors): rows (row, id, vector) of one length, packed into blocks of about ``size``."""
    counts = rows.groupBy(F.size("vector").alias("n")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias("blocks"))
    spread = rows.withColumn("n", F.size("vector")).join(counts, "n").withColumn(
        "block", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    return saved(spread.groupBy("n", "block").agg(F.first("blocks").alias("blocks"), F.collect_list("row").alias("rows"),
                                                  F.collect_list("id").alias("ids"),
                                                  F.flatten(F.collect_list("vector")).alias("vectors")), name)


_FOUND = "q_row long, query_id long, vec_id long, score long"


def _searched(units: DataFrame, k: int) -> DataFrame:
    """The k best of each unit (n, q_rows, q_ids, q_vectors, floors, rows, ids, vectors)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n = batch.column(0)[r].as_py()
                q_rows, q_ids, q, floors, x_rows, x_ids, x = (
                    batch.column(i)[r].values.to_numpy(zero_copy_only=False) for i in range(1, 8))
                found = list(best_of_block(q_rows, q.reshape(-1, n), x_rows, x_ids, x.reshape(-1, n), k, floors))
                i, j, s = (np.array([f[c] for f in found], np.int64) for c in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(q_rows[i]), pa.array(q_ids[i]), pa.array(x_ids[j]), pa.array(s)],
                                                 ["q_row", "query_id", "vec_id", "score"])

    return units.select("n", "q_rows", "q_ids", "q_vectors", "floors", "rows", "ids", "vectors").mapInArrow(run, _FOUND)


def top_k(df: DataFrame, queries: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K,
          scale: float = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for which ``queries`` holds."""
    vector = F.col(f"`{embedding}`")
    rows = saved(df.filter(F.col(f"`{vec_id}`").isNotNull() & usable(vector))
                   .select(F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").cast("long").alias("id"),
                           scaled(vector, scale).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")), "vectors")
    candidates = blocks(rows.select("row", "id", "vector"), BLOCK, "candidates")
    asked = blocks(rows.filter("asks").select("row", "id", "vector"), QUERY_BLOCK, "queries").select(
        "n", F.col("block").alias("q_block"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    counts = candidates.groupBy("n").agg(F.max("blocks").alias("x_blocks"))
    asked = asked.join(counts, "n").withColumn("first", F.pmod("q_block", "x_blocks").cast("int"))
    # each query block goes to every candidate block of its length: an equi-join on (n, block)
    none = F.transform("q_rows", lambda _: F.lit(float("-inf")))
    begun = saved(_searched(asked.withColumn("floors", none).withColumn("block", F.col("first")).join(
        candidates.select("n", "block", "rows", "ids", "vectors"), ["n", "block"]), k), "first-block")
    place = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc("vec_id"))
    beat = begun.withColumn("at", F.row_number().over(place)).filter(F.col("at") == k).select("q_row", F.col("score").cast("double").alias("floor"))
    of_block = (asked.select("n", "q_block", F.posexplode("q_rows").alias("at", "q_row")).join(beat, "q_row", "left")
                     .groupBy("n", "q_block").agg(F.transform(
                         F.array_sort(F.collect_list(F.struct("at", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))),
                         lambda e: e["floor"]).alias("floors")))
    others = F.filter(F.sequence(F.lit(0), F.col("x_blocks") - 1), lambda b: b != F.col("first"))
    sent = asked.join(of_block, ["n", "q_block"]).withColumn("block", F.explode(others))
    found = begun.unionByName(_searched(sent.join(candidates.select("n", "block", "rows", "ids", "vectors"), ["n", "block"]), k))
    return (found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
                 .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def survivors(q: np.ndarray, x: np.ndarray, k: int = K) -> list[float]:
    """Share of all pairs left after each level, with each query's true k-th best score to beat."""
    scores = q @ x.T
    floor = np.sort(scores, axis=1)[:, -k]
    left = np.zeros(len(levels(q.shape[1])), np.int64)
    for _ in best_of_block(np.full(len(q), -1), q, np.arange(len(x)), np.arange(len(x)), x, k, floor.astype(float), left):
        pass
    return (left / (len(q) * len(x))).tolist()


def op5_topk(spark, sf_dir):
    """The 5 best inner products of every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
