"""Phrase collocation mining with Misra-Gries summaries (operator 13).

N-grams travel as 64-bit hashes of (language, words), dealt into hash partitions.

1. Words, then pairs, then runs of three and four: every task counts the n-grams of
   its texts in chunks and sends, for each hash partition, the mass and a packed
   list of (hash, count).  A partition first adds up its mass, which fixes its
   summary's capacity: more than ``SHARP`` times mass / threshold, so that a merged
   Misra-Gries summary (add counters; beyond the capacity subtract the (capacity +
   1)-th largest) undercounts by less than threshold / ``SHARP``: it keeps every
   frequent n-gram and few others.  ``partitions`` follows from the size of the texts,
   so a summary's size is bounded.
2. A run is counted only if all its shorter runs survived, as a frequent run's do.
   Survivors are set in a bit table of fixed size (``FILTER_BITS``), which every
   task gets; a false hit costs a count, never a result.
3. A second pass over the texts counts exactly the n-grams that the table lets
   through, and totals the words of each language.  Counts travel packed, dealt by
   hash; a partition adds them up and keeps the frequent ones.
4. Phrases inside longer ones, cuts, scores and ranks are joins and aggregates
   over the table of frequent phrases.  Single words, which very many phrases
   may start or end with, are salted in the join.

Two different n-grams of one task share a hash with a probability of about 2**-64.

Defined cases: null text is empty, null language is ``und``; an n-gram never
crosses a separator or a text's end; repeated rows count repeatedly; extra
columns are ignored; an empty table gives an empty result; equal scores are
ordered by count and phrase, so results do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import saved, table

#: Lower-cases A-Z; the tab becomes a blank, other separators become line feeds.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256))

#: Longest phrase; least count; share (percent) of a longer phrase that absorbs a shorter; phrases a language.
LONGEST, LEAST, ABSORBED, TOP = 4, 30, 80, 2000
#: Bits of the survivors' table (16 MB), whatever the size of the corpus.
FILTER_BITS = 27
#: Counters of one partition's summary, about; n-grams that a task counts at once; copies of a word in a join.
COUNTERS, CHUNK, SALTS = 1 << 19, 1 << 22, 16
#: N-grams whose exact counts a task holds before it sends them.
HELD = 1 << 19
#: Capacity of a summary: so many times mass / threshold.
SHARP = 8

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, in order."""
    h = (a * MULTIPLIER) ^ b
    h ^= h >> np.uint64(32)
    h *= MULTIPLIER
    return h ^ (h >> np.uint64(29))


class Texts:
    """The word occurrences of a batch: word number, language number and piece of each."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = texts.buffers()
        plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(LETTERS))
        texts = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, plain], 0, texts.offset)
        tokens = pc.split_pattern(pc.replace_substring(texts, b"\n", b" \n "), b" ")
        coded = tokens.flatten().dictionary_encode()
        self.words: list[bytes] = coded.dictionary.to_pylist()
        word = coded.indices.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
        cut = np.array([w == b"\n" for w in self.words], bool)[word] if len(word) else np.zeros(0, bool)
        kept = ~cut & np.array([w != b"" for w in self.words], bool)[word] if len(word) else cut
        self.word, self.piece = word[kept], (np.cumsum(cut) + row)[kept]
        langs = langs.cast(pa.string()).fill_null("und").dictionary_encode()
        self.langs: list[str] = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[row[kept]]
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], np.uint64)[self.word]
        self.seeds = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in self.langs], np.uint64)[self.lang]

    def runs(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first word's place, hash) of all runs of 1 to ``longest`` words within pieces."""
        at, level = np.arange(len(self.word)), mixed(self.seeds, self.hashes) if len(self.word) else self.hashes
        for n in range(1, longest + 1):
            if n > 1:
                whole = at + n <= len(self.word)
                whole[whole] = self.piece[at[whole]] == self.piece[at[whole] + n - 1]
                at = at[whole]
                level = mixed(level[whole], self.hashes[at + n - 1]) if len(at) else level[:0]
            yield n, at, level

    def promising(self, longest: int, survived: np.ndarray | None, known: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The runs whose shorter runs survived; the table has those of up to ``known`` words."""
        before = None
        for n, at, level in self.runs(longest):
            if before is not None:
                ok = before[at] & before[at + 1]  # both runs of n - 1 words
                at, level = at[ok], level[ok]
            yield n, at, level
            before = np.zeros(len(self.word) + 1, bool)
            before[at] = hit(survived, level) if n <= known else True

    def phrase(self, at: int, n: int) -> str:
        return b" ".join([self.words[w] for w in self.word[at:at + n].tolist()]).decode("utf-8", "replace")


def hit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


class Summary:
    """A Misra-Gries summary of (hash, count) lists, mergeable: at most ``capacity`` counters."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held >= max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        self.keys, self.counts = added(keys, counts)
        if len(self.keys) > self.capacity:
            cut = np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1]
            self.error += int(cut)
            left = self.counts > cut
            self.keys, self.counts = self.keys[left], self.counts[left] - cut

    def frequent(self, least: int) -> np.ndarray:
        """Hashes of all n-grams that may have ``least`` occurrences."""
        self.merge()
        return self.keys[self.counts + self.error >= least]


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def partitions(df: DataFrame, text: str, least: int) -> int:
    """Hash partitions so that a summary has about ``COUNTERS`` counters: words are at most half of the bytes."""
    size = df.agg(F.sum(F.octet_length(f"`{text}`")).alias("n")).first().n or 0
    return max(8, -(-(SHARP * size // 2 // least) // COUNTERS))


def survivors(feed: DataFrame, lengths: range, parts: int, least: int, survived) -> DataFrame:
    """(place): bits of all n-grams of these lengths that may be frequent."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = survived.value if survived is not None else None
        waiting, held = [], 0

        def packed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            part = (keys % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            keys, counts, part = keys[order], counts[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            mass = [(p, 0, int(counts[a:b].sum()), None, None) for p, a, b in rows]
            lists = [(p, 1, 0, keys[a:b].astype("<u8").tobytes(), counts[a:b].astype("<u4").tobytes()) for p, a, b in rows]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*mass, *lists, strict=True), kinds, strict=True)],
                                              ["part", "kind", "mass", "keys", "counts"])

        for batch in batches:
            for n, _, level in Texts(batch.column(0), batch.column(1)).promising(lengths.stop - 1, bits, lengths.start - 1):
                if n in lengths and len(level):
                    waiting.append(level)
                    held += len(level)
            if held >= CHUNK:
                yield packed()
                waiting, held = [], 0
        if held:
            yield packed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def kept() -> pa.RecordBatch:
            keys = summary.frequent(least)
            return pa.RecordBatch.from_arrays([pa.array((keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64))], ["place"])

        for batch in batches:  # of each part first the masses, then the lists
            for p, kind, m, keys, counts in zip(*batch.columns, strict=True):
                if p.as_py() != part:
                    if summary is not None:
                        yield kept()
                    part, mass, summary = p.as_py(), 0, None
                if kind.as_py() == 0:
                    mass += m.as_py()
                    continue
                summary = summary or Summary(SHARP * mass // least + 1)
                summary.add(np.frombuffer(keys.as_buffer(), "<u8"), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))
        if summary is not None:
            yield kept()

    counted = feed.mapInArrow(count, "part int, kind int, mass long, keys binary, counts binary")
    dealt = counted.repartition(parts, "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(merge, "place long")


def bit_table(places: DataFrame, before: np.ndarray | None) -> np.ndarray:
    """The survivors' table as bytes; its size is fixed, whatever the number of survivors."""
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8) if before is None else before.copy()
    pages = places.groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("page")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits"))
    for row in pages.toLocalIterator():  # pages of 4096 bytes, numbered from 1
        bits[(row.page - 1) * 4096:row.page * 4096] |= np.frombuffer(row.bits, np.uint8)
    return bits


def exact_counts(feed: DataFrame, longest: int, least: int, survived, parts: int) -> DataFrame:
    """(lang, n, phrase, f) of the n-grams in the table with ``least`` occurrences, and (lang, 0, null, words) of each language."""
    names = ["lang", "n", "phrase", "f"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = survived.value
        totals: dict[str, int] = {}
        found: dict[int, list] = {}

        def packed() -> pa.RecordBatch:
            dealt: dict[int, list] = {}
            for key, row in found.items():
                dealt.setdefault(key % parts, []).append(row)
            for lang, words in totals.items():
                dealt.setdefault(xxhash.xxh3_64_intdigest(lang) % parts, []).append([lang, 0, None, words])
            lists = [[[r[i] for r in rows] for rows in dealt.values()] for i in range(4)]
            return pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), *(
                pa.array(x, pa.list_(k)) for x, k in zip(lists, kinds, strict=True))], ["part", *names])

        for batch in batches:
            texts = Texts(batch.column(0), batch.column(1))
            for lang, n in enumerate(np.bincount(texts.lang, minlength=len(texts.langs)).tolist()):
                totals[texts.langs[lang]] = totals.get(texts.langs[lang], 0) + n
            for n, at, level in texts.promising(longest, bits, longest):
                ok = hit(bits, level)
                keys, first, counts = np.unique(level[ok], return_index=True, return_counts=True)
                for key, a, c in zip(keys.tolist(), at[ok][first].tolist(), counts.tolist(), strict=True):
                    if (row := found.get(key)) is not None:
                        row[3] += c
                    else:
                        found[key] = [texts.langs[texts.lang[a]], n, texts.phrase(a, n), c]
            if len(found) >= HELD:
                yield packed()
                found, totals = {}, {}
        if found or totals:
            yield packed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, {}

        def kept() -> pa.RecordBatch:
            rows = [(*k, f) for k, f in sums.items() if f >= least or k[1] == 0]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)],
                                              names)

        for batch in batches:
            for p, *lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    if sums:
                        yield kept()
                    part, sums = p, {}
                for *key, f in zip(*lists, strict=True):
                    key = tuple(key)
                    sums[key] = sums.get(key, 0) + f
        if sums:
            yield kept()

    counted = feed.mapInArrow(count, "part int, lang array<string>, n array<int>, phrase array<string>, f array<long>")
    return counted.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, "lang string, n int, phrase string, f long")


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                     least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, f) of all runs of 1 to ``longest`` words with ``least`` occurrences; (lang, words) of all languages."""
    feed = df.select(F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string"))
    context, parts = df.sparkSession.sparkContext, partitions(df, text, least)
    bits, shared = None, None
    for lengths in [range(1, 2), range(2, 3), range(3, longest + 1)]:
        if lengths.start <= longest:
            bits = bit_table(survivors(feed, range(lengths.start, min(lengths.stop, longest + 1)), parts, least, shared), bits)
            shared = context.broadcast(bits)
    counted = saved(exact_counts(feed, longest, least, shared, parts), "phrases")
    return counted.filter("n > 0"), counted.filter("n = 0").select("lang", F.col("f").alias("words"))


def _words(column: str, start: str, length: str) -> str:
    return f"array_join(slice({column}, {start}, {length}), ' ')"


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 absorbed: int = ABSORBED, top: int = TOP) -> DataFrame:
    """Each language's best phrases: (lang, rank, phrase, a, l, r, n, score)."""
    frequent, totals = frequent_phrases(df, text, lang, longest, least)
    candidates = frequent.filter("n > 1").withColumn("w", F.split("phrase", " "))
    inner = F.expr("flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), i -> "
                   + _words("w", "i", "m") + ")))")
    longer = (candidates.filter("n > 2").select("lang", F.explode(inner).alias("phrase"), "f")
                        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    own = saved(candidates.join(longer, ["lang", "phrase"], "left")
                .filter(f"longer is null or cast(longer as decimal(20,0)) * 100 < cast(f as decimal(20,0)) * {absorbed}")
                .select("lang", "phrase", "n", F.col("f").alias("a")), "phrases-own")
    # every cut's two parts; single words are dealt over SALTS copies, since a third of the phrases may share one
    halves = F.expr("flatten(transform(sequence(1, n - 1), k -> array("
                    f"named_struct('k', k, 'side', 0, 'part', {_words('w', '1', 'k')}, 'size', k), "
                    f"named_struct('k', k, 'side', 1, 'part', {_words('w', 'k + 1', 'n - k')}, 'size', n - k))))")
    cuts = (own.withColumn("w", F.split("phrase", " ")).select("lang", "phrase", "a", F.explode(halves).alias("h"))
               .select("lang", "phrase", "a", "h.k", "h.side", "h.part",
                       F.when(F.col("h.size") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).alias("salt")))
    copies = F.when(F.col("n") == 1, F.expr(f"sequence(0L, {SALTS - 1}L)")).otherwise(F.expr("array(0L)"))
    parts = frequent.filter(f"n < {longest}").select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"),
                                                     F.explode(copies).alias("salt"))
    met = (cuts.join(parts, ["lang", "part", "salt"]).groupBy("lang", "phrase", "a", "k")
               .agg(F.max(F.when(F.col("side") == 0, F.col("of_part"))).alias("l"),
                    F.max(F.when(F.col("side") == 1, F.col("of_part"))).alias("r")))
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)")
    best = (met.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a")
               .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
               .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best_first = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # a language's first phrases are among the first of its SALTS parts
    share = Window.partitionBy("lang", "_share").orderBy(*best_first)
    best = (best.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
                .withColumn("_place", F.row_number().over(share)).filter(F.col("_place") <= top).drop("_share", "_place"))
    place = Window.partitionBy("lang").orderBy(*best_first)
    ranked = best.withColumn("rank", F.row_number().over(place).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


def op13_phrases(spark, sf_dir):
    """The best phrases of two to four words of every language."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM split, range(1, 5) AS r(m) WHERE len(w) >= m)
), f AS (
  SELECT lang, CAST(m AS BIGINT) AS m, phrase, count(*) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, f AS longer
  FROM (SELECT lang, m, k, w, f, unnest(range(1, m - k + 2)) AS i FROM c, range(2, 4) AS r(k) WHERE k < m)
), own AS (
  SELECT lang, phrase, w, m, f AS a FROM c
  WHERE NOT EXISTS (SELECT 1 FROM inside AS x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.longer >= 80 * c.f)
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS rest
  FROM own, range(1, 4) AS r(k) WHERE k < m
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = head AND x.m = k
            JOIN f AS y ON y.lang = cuts.lang AND y.phrase = rest AND y.m = array_length(string_split(cuts.phrase, ' ')) - k
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
