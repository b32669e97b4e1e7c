"""Document fingerprints (operator 8), DataFrame functions only.

SimHash: every word's 64-bit hash votes on 64 signed bits with the word's weight
(its length, from 1 to 7); a bit of the fingerprint is set if more than half of
the weight has it set.  Votes of 4096 words at a time are counted in 16-bit
lanes packed four to a long, so a word costs 16 additions inside the partial
aggregate and only one row per 4096 words is shuffled.

:func:`near_links` finds all fingerprints within a Hamming radius with permuted
block tables: the 64 bits are cut into ``radius + 2`` blocks; two fingerprints
within the radius agree on at least two whole blocks, so a table for each pair
of blocks, keyed by their bits, holds them together.  Large buckets are split by
chunks of the bits outside their key.  The query reports, for every document,
the number of other fingerprints within 3 bits and the least id within them.

Defined cases: a null text is an empty text; a text without words has
fingerprint 0; equal texts have equal fingerprints, whatever their rows; rows
without id come last and, like rows that share an id, are ordered by a hash of
their text; the only row's next document is itself; an empty table gives an
empty result; added columns replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import added, saved, table
from keyflow.session import shared_path

BITS, LANES, LANE_BITS = 64, 16, 16
#: Words counted in one set of lanes; at weight 7 a lane stays below 2**15.
PART_WORDS, MOST_WEIGHT = 4096, 7
#: Documents of one stretch of the id order.
STRETCH_ROWS = 2000
#: Fingerprints of one bucket of a block table that are compared with each other; larger buckets are split.
BUCKET_ROWS = 64


def _words(text: Column) -> Column:
    return F.split(text, r"[\x20\x09-\x0D]+")


def _weight(word: Column) -> Column:
    n = F.octet_length(word)
    return F.when(n > 0, F.least(F.lit(MOST_WEIGHT), F.greatest(F.lit(1), n - 2))).otherwise(F.lit(0)).cast("long")


def _lane(hashed: Column, j: int) -> Column:
    """Four bits of the hash, spread over the four 16-bit lanes of a long."""
    four = F.shiftrightunsigned(hashed, 4 * j).bitwiseAND(15)
    return (four * F.lit(1 + (1 << 15) + (1 << 30) + (1 << 45))).bitwiseAND(F.lit(0x0001000100010001))


def fingerprints(df: DataFrame, keys: list[str], text: str, out: str = "fingerprint") -> DataFrame:
    """(keys..., fingerprint as long) of every row; ``keys`` name a row and have fixed width."""
    words = df.select(*keys, F.posexplode(_words(F.coalesce(F.col(text), F.lit("")))).alias("_pos", "_word"))
    votes = words.select(*keys, F.floor(F.col("_pos") / PART_WORDS).alias("_part"),
                         F.xxhash64("_word").alias("_hash"), _weight(F.col("_word")).alias("_weight"))
    lanes = votes.groupBy(*keys, "_part").agg(
        F.sum("_weight").alias("_total"),
        *[F.sum(_lane(F.col("_hash"), j) * F.col("_weight")).alias(f"_l{j}") for j in range(LANES)])
    mask = (1 << LANE_BITS) - 1
    counted = lanes.groupBy(*keys).agg(
        F.sum("_total").alias("_total"),
        *[F.sum(F.shiftrightunsigned(f"_l{b // 4}", LANE_BITS * (b % 4)).bitwiseAND(mask)).alias(f"_b{b}")
          for b in range(BITS)])
    bits = F.lit(0).cast("long")
    for b in range(BITS):
        bits = bits.bitwiseOR(F.when(F.col(f"_b{b}") * 2 > F.col("_total"), F.shiftleft(F.lit(1).cast("long"), b))
                              .otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, bits.alias(out))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits."""
    return 1.0 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / F.lit(float(BITS))


def as_hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _chunks(width: int, parts: int) -> list[tuple[int, int]]:
    """(low bit, bits) of ``parts`` chunks of about one length, from the lowest on."""
    edges = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _bits(value: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << n) - 1))


def _without(value: Column, width: int, taken: list[tuple[int, int]]) -> Column:
    """The bits of ``value`` outside the chunks ``taken``, moved together."""
    out, at, low = F.lit(0).cast("long"), 0, 0
    for start, n in [*sorted(taken), (width, 0)]:
        if start > low:
            out = out.bitwiseOR(F.shiftleft(_bits(value, low, start - low), at))
            at += start - low
        low = start + n
    return out


def _tables(value: Column, key: list[Column], width: int, parts: int, together: int) -> tuple[Column, int]:
    """A row for every choice of ``together`` of the ``parts`` chunks: (t, key, rest), and the bits of the longest rest."""
    chunks, structs, longest = _chunks(width, parts), [], 0
    for t, some in enumerate(combinations(range(parts), together)):
        taken = [chunks[i] for i in some]
        longest = max(longest, width - sum(n for _, n in taken))
        structs.append(F.struct(F.lit(t).alias("t"), F.xxhash64(*key, F.lit(t), *[_bits(value, *c) for c in taken]).alias("key"),
                                _without(value, width, taken).alias("rest")))
    return F.explode(F.array(*structs)), longest


def _first_choice(x: Column, t: Column, width: int, parts: int, together: int) -> Column:
    """Whether table ``t`` is the first one in which two values with the difference ``x`` meet."""
    chunks, equal = _chunks(width, parts), []
    for some in combinations(range(parts), together):
        mask = 0
        for i in some:
            mask |= ((1 << chunks[i][1]) - 1) << chunks[i][0]
        equal.append(x.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)) == 0)
    first = F.lit(-1)
    for number in reversed(range(len(equal))):
        first = F.when(equal[number], number).otherwise(first)
    return first == t


def near_links(df: DataFrame, fingerprint: str = "fingerprint", least: str = "least", radius: int = 3,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(f, other, other_least): every two different fingerprints (long) within ``radius`` bits, in both directions.

    ``df`` has one row for each fingerprint, ``least`` goes with it.
    """
    return reduce(DataFrame.unionAll, _links_by_level(df, fingerprint, least, radius, bucket_rows))


def _links_by_level(df: DataFrame, fingerprint: str, least: str, radius: int, bucket_rows: int) -> Iterator[DataFrame]:
    """The links of :func:`near_links`, those of one level of splitting at a time.

    The rows of a block table are met in their buckets only up to ``bucket_rows``; a
    larger bucket is split: the bits outside its key are cut into ``radius + 1`` chunks, of which
    any two fingerprints within the radius share one, and this is repeated until no
    bucket is larger, or all bits are used.  Two fingerprints meet once: in the
    first table, and the first chunk of each split, that they share.
    """
    rows = df.select(F.col(fingerprint).alias("f"), F.col(least).alias("least")).filter("f is not null")
    parts, together, width = radius + 2, 2, BITS
    now = rows.withColumns({"v0": F.col("f"), "key": F.lit(0).cast("long")})
    cuts: list[tuple[int, int, int]] = []  # how each level cut the bits v<level>, of which it took choice t<level>
    while True:
        level = len(cuts)
        cuts.append((width, parts, together))
        path = [f"{c}{i}" for i in range(level) for c in "vt"]
        tables, left = _tables(F.col(f"v{level}"), [F.col("key")], width, parts, together)
        dealt = now.select("f", "least", *path, f"v{level}", tables.alias("k")).select(
            "f", "least", *path, f"v{level}", F.col("k.t").alias(f"t{level}"), "k.key", "k.rest")
        counts = saved(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "block-counts")  # most are alone
        last = left <= parts
        small = dealt.join(counts.filter(F.lit(last) | (F.col("n") <= bucket_rows)).select("key"), "key", "left_semi")
        a = small.select("key", "f", *path, f"v{level}", f"t{level}")
        b = small.select("key", F.col("f").alias("other"), F.col("least").alias("other_least"),
                         *[F.col(f"v{i}").alias(f"w{i}") for i in range(level + 1)])
        met = a.join(b, "key").filter((F.col("f") != F.col("other")) & (F.bit_count(F.col("f").bitwiseXOR(F.col("other"))) <= radius))
        for i, cut in enumerate(cuts):
            met = met.filter(_first_choice(F.col(f"v{i}").bitwiseXOR(F.col(f"w{i}")), F.col(f"t{i}"), *cut))
        yield met.select("f", "other", "other_least")
        large = counts.filter(F.col("n") > bucket_rows)
        if last or large.isEmpty():
            return
        now = saved(dealt.join(large.select("key"), "key", "left_semi").withColumnRenamed("rest", f"v{level + 1}"), "blocks")
        parts, together, width = radius + 1, 1, left


def near_pairs(df: DataFrame, fingerprint: str = "fingerprint", radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b, distance): all pairs a < b of different fingerprints (long) within ``radius`` bits.

    Equal fingerprints count once; their rows are found by joining back.
    """
    distinct = df.select(F.col(fingerprint).alias("f")).distinct().withColumn("least", F.lit(0))
    return near_links(distinct, "f", "least", radius, bucket_rows).filter("f < other").select(
        F.col("f").alias("a"), F.col("other").alias("b"), F.bit_count(F.col("f").bitwiseXOR(F.col("other"))).alias("distance"))


def neighbours(df: DataFrame, fingerprint: str, doc_id: str, radius: int = 3) -> DataFrame:
    """(f, n_near, near_least) of every fingerprint: how many others lie within ``radius`` bits, and the least id of a
    document within it, its own ones included.  Links are added up as they are met, never kept, each level of splitting
    by a query of its own: the driver holds the stages of one level at a time, however many levels the buckets need."""
    own = saved(df.groupBy(F.col(fingerprint).alias("f")).agg(F.min(doc_id).alias("least")), "fingerprints")
    path = shared_path(df.sparkSession, "llm", "near-sums", fresh=True)
    for met in _links_by_level(own, "f", "least", radius, BUCKET_ROWS):
        sums = added(met.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.min("other_least").alias("m")), path)
    near = sums.groupBy("f").agg(F.sum("n").alias("n"), F.min("m").alias("m"))
    return own.join(near, "f", "left").select("f", F.coalesce("n", F.lit(0)).cast("long").alias("n_near"),
                                              F.least("least", "m").alias("near_least"))


def with_next(df: DataFrame, doc_id: str, text: str, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """(row, next_row, doc_id, text, next_text): each row with its successor in descending id order, the first after the last.

    Rows are dealt to stretches of the order at quantiles of the id (as many as
    there are ``stretch_rows``), so one shuffle brings neighbours together; only
    the first row of each stretch is fetched by the stretch before it.
    """
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                     F.monotonically_increasing_id().alias("row"))
    n = rows.count()
    parts = max(1, math.ceil(n / stretch_rows))
    cuts = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        cuts = rows.select(F.percentile_approx(F.col("doc_id").cast("double"), at, 20 * parts)).first()[0] or []
    splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
    ids = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    dealt = rows.withColumns({"_id": ids, "tie": F.xxhash64("text")})
    if len(splits) > 2:
        dealt = Bucketizer(splits=splits, inputCol="_id", outputCol="_cut").transform(dealt)
    else:
        dealt = dealt.withColumn("_cut", F.lit(0))
    # ascending numbers in descending order of ids; rows without id after all others, by their hash
    stretch = F.when(F.col("doc_id").isNotNull(), F.lit(len(splits)) - F.col("_cut").cast("int")).otherwise(
        F.lit(len(splits) + 200) - F.shiftright("tie", 57).cast("int"))
    dealt = dealt.select("row", "doc_id", "text", "tie", stretch.cast("int").alias("stretch"))
    order = [F.desc_nulls_last("doc_id"), F.desc("tie"), F.asc("row")]
    within = Window.partitionBy("stretch").orderBy(*order)
    placed = dealt.select("*", F.lead("row").over(within).alias("next_row"),
                          F.lead("text").over(within).alias("next_text"))
    first = dealt.groupBy("stretch").agg(F.max(F.struct(F.col("doc_id"), F.col("tie"), (-F.col("row")).alias("back"))).alias("m"))
    heads = saved(first.select("stretch", (-F.col("m.back")).alias("head")), "heads")  # a row for each stretch
    after = heads.select("stretch", F.lead("head").over(Window.orderBy("stretch")).alias("to"),
                         F.first("head").over(Window.orderBy("stretch")).alias("front"))
    after = after.select("stretch", F.coalesce("to", "front").alias("head_row"))
    texts = dealt.select(F.col("row").alias("head_row"), F.col("text").alias("head_text"))
    fetched = saved(after.join(texts, "head_row"), "next-heads")
    joined = placed.join(fetched, "stretch")
    last = F.col("next_row").isNull()
    return joined.select("row", F.coalesce("next_row", "head_row").alias("next_row"), "doc_id", "text",
                         F.when(last, F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"))


def op8_simhash(spark, sf_dir):
    """Fingerprints of every document and of its edited text, their likeness, and the fingerprints near its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next_text"), half))
    both = with_next(docs, "doc_id", "text").select("row", "next_row", "doc_id", n.cast("long").alias("n_chars"),
                                                    "text", edited.alias("edited"))
    digest = F.sha2("edited", 256)
    parts = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long").alias(f"sha{i}") for i in range(4)]
    texts = both.select("row", "next_row", "doc_id", "n_chars", *parts, F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("v"))
    keys = ["row", "next_row", "doc_id", "n_chars", "sha0", "sha1", "sha2", "sha3"]
    prints = fingerprints(texts.select(*keys, "v.which", F.col("v.t").alias("t")), [*keys, "which"], "t", "f")
    wide = saved(prints.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("f"))).alias("f"),
                                           F.max(F.when(F.col("which") == 1, F.col("f"))).alias("e")), "prints")
    nexts = wide.select(F.col("row").alias("next_row"), F.col("f").alias("g"))
    sha = F.concat(*[as_hex(f"sha{i}") for i in range(4)])
    near = saved(neighbours(wide, "f", "doc_id"), "near")
    return wide.join(nexts, "next_row").join(near, "f").select(
        "doc_id", "n_chars", sha.alias("edited_sha256"), as_hex("f").alias("fingerprint"),
        as_hex("e").alias("edited_fingerprint"), likeness("f", "e").alias("near_edited"),
        likeness("f", "g").alias("near_next"), "n_near", "near_least")
