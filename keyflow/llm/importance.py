"""Importance resampling towards a target distribution (operator 12).

1. ``bucket_counts``: words come from the UTF-8 bytes of whole texts; one 256-byte
   table lower-cases A-Z and blanks every separator, ``bytes.split`` cuts the
   words, and chained ``zlib.crc32`` seeds extend n-grams to ``longest`` words
   (the CRC of ``a b`` is that of `` b`` seeded with that of ``a``).  Counters per
   batch add up in the task; a task sends at most ``buckets`` rows.
2. ``gains``: the logarithm of each bucket's smoothed target frequency over its
   raw one, in thousandths.  Bounded by ``buckets``, so it travels to every task.
3. ``weighted``: a document's weight is the sum of the gains of its features.
4. ``resampled``: Gumbel noise seeded by the document's id turns the highest scores
   into a draw without replacement, proportional to the weights' exponentials.
   Places in the order of all eligible rows come from ranges (see ``in_order``),
   never from one task.

Defined cases: a null or empty text has no words (weight 0, not eligible); a null
id draws the noise of the empty id and follows other ids on ties; rows equal in
score and id follow by features, then as read; extra columns pass through,
except those with the name of an added one; with an empty target or empty source
counts are 0 and the smoothing decides; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import in_order, saved, table, utf8, with_columns

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of characters beyond ASCII, blanks the rest.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Parameters of the registered query.
LONGEST, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10


def words(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(LETTERS).split()


def features(found: list[bytes], longest: int) -> list[int]:
    """CRC-32 of every run of 1 to ``longest`` words, joined by one blank."""
    level = [zlib.crc32(w) for w in found]
    out = list(level)
    for n in range(1, longest):
        level = [zlib.crc32(w, zlib.crc32(b" ", seed)) for seed, w in zip(level, found[n:], strict=False)]
        out += level
    return out


def bucket_counts(df: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows per bucket; at most ``buckets`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            counts: Counter[int] = Counter()
            for row in utf8(batch.column(0)):
                counts.update(features(words(row.as_buffer().to_pybytes()), longest))
            place = np.fromiter(counts.keys(), np.int64, len(counts)) % buckets
            np.add.at(total, place, np.fromiter(counts.values(), np.int64, len(counts)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    parts = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of (target frequency / raw frequency)) per bucket, both smoothed by one."""
    n, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000.0 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))))
                     for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(df: DataFrame, gain: np.ndarray, text: str = "text", longest: int = LONGEST) -> DataFrame:
    """Append n_words, n_features and weight (all long)."""
    shared = df.sparkSession.sparkContext.broadcast(gain)
    added = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])

    def make():
        gain = shared.value

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            sizes, counts, weights = [], [], []
            for row in utf8(batch.column(0)):
                found = words(row.as_buffer().to_pybytes())
                crcs = np.array(features(found, longest), np.int64)
                sizes.append(len(found))
                counts.append(len(crcs))
                weights.append(int(gain[crcs % len(gain)].sum()))
            return [pa.array(c, pa.int64()) for c in (sizes, counts, weights)]
        return step

    return with_columns(df, [text], added, make)


def resampled(df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
              longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS,
              percent: int = PERCENT) -> DataFrame:
    """Append n_words, n_features, weight, score and rank (of the drawn rows, from 1; else null); the text goes."""
    gain = gains(bucket_counts(df, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))),
                                     256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    rows = weighted(df, gain, text, longest).drop(text)
    rows = saved(rows.withColumn("score", (F.col("weight") + noise).cast("long"))
                     .withColumn("_kf_row", F.monotonically_increasing_id()), "weighted")
    eligible = rows.filter(F.col("n_words") >= least_words)
    n = eligible.count()
    order = [F.col("score").desc(), F.col(f"`{doc_id}`").asc_nulls_last(), F.col("n_features"), F.col("_kf_row")]
    places = in_order(eligible.select("score", f"`{doc_id}`", "n_features", "_kf_row"), order, "rank", n)
    drawn = places.filter(F.col("rank") <= n * percent // 100).select("_kf_row", "rank")
    return rows.drop("rank").join(drawn, "_kf_row", "left").drop("_kf_row")


def op12_importance(spark, sf_dir):
    """Draw a tenth of the documents, by their likeness to the benchmark texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = resampled(docs, table(spark, sf_dir, "benchmark").select("text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = """
WITH RECURSIVE shifts(n, step, c) AS (
  SELECT n, 0, CAST(n AS BIGINT) FROM range(256) AS r(n)
  UNION ALL
  SELECT n, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM shifts WHERE step < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS tab FROM shifts WHERE step = 8
), docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
), doc_words AS (
  SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM docs
), bench_words AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM benchmark
), spelled AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM doc_words UNION SELECT w FROM bench_words)
), crcs(w, h, i, c) AS (
  SELECT w, h, 0, CAST(4294967295 AS BIGINT) FROM spelled
  UNION ALL
  SELECT w, h, i + 1,
         xor(c >> 8, tab[xor(c & 255, (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16
                                      + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1) + 1])
  FROM crcs, crc_table WHERE 2 * i < length(h)
), buckets AS (
  SELECT w, xor(c, 4294967295) % 10000 AS b FROM crcs WHERE 2 * i = length(h)
), s AS (
  SELECT b, count(*) AS s FROM doc_words JOIN buckets USING (w) GROUP BY b
), t AS (
  SELECT b, count(*) AS t FROM bench_words JOIN buckets USING (w) GROUP BY b
), g AS (
  SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM doc_words) + 10000 AS DOUBLE)
           / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM bench_words) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT b FROM buckets) LEFT JOIN s USING (b) LEFT JOIN t USING (b)
), per_doc AS (
  SELECT r, CAST(count(*) AS BIGINT) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM doc_words JOIN buckets USING (w) JOIN g USING (b) GROUP BY r
), hashed AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM docs LEFT JOIN per_doc USING (r)
), scored AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(x, 1, 8)) AS BIGINT) + 0.5::DOUBLE)
         / 4294967296))) AS BIGINT) AS score
  FROM hashed
), ranked AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20
                  ORDER BY score DESC, doc_id ASC NULLS LAST) END AS place,
         (SELECT count(*) FROM scored WHERE n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM ranked
"""
