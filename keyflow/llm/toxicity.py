"""Toxicity scores from class-conditional Kneser-Ney models (operator 10).

Each class (ordinary 0, toxic 1) has an interpolated Kneser-Ney model of word pairs:

    p_c(w | v) = (1 - L(v)) max(n_c(vw) - 1, 0) / K_c(v) + L(v) p_c(w)
    p_c(w)     = (1 - M)    max(N_c(.w) - E_c, 0) / K_c    + M    p(w)
    p(w)       = (N(.w) + 1/2) / (sum of N + 1/2 over all words)

``n_c`` are the class's pair counts, ``N_c(.w)`` its continuation counts (how many
different words precede w), ``N(.w)`` the smaller of both classes' ones: the shared
backoff, which smooths a rare expression alike in either class.  Pairs are discounted
by 1, so a pair that a class has seen once leaves its mass to the word, and need not
be kept; E comes from the continuations' counts of counts, n1 / (n1 + 2 n2).
``K_c(v)`` is what the discounted counts of a context sum to, and ``L(v)`` the larger
of the two classes' backoff shares 1 - K_c(v) / n_c(v) (1 where a class has no kept
pair of v; the end of a text counts as a continuation, and a first word has none);
M likewise.  So a pair that neither class has seen says what
its word says, and a word that neither has seen says nothing.

Toxic documents are mostly ordinary prose: their model is the ordinary one with a
share ALPHA of the toxic one, ALPHA being one word of an average toxic training text.
A pair's evidence is log(1 - ALPHA + ALPHA p_1 / p_0); a document's evidence is the
sum over its words divided by their number (the length-normalised difference of the
log-likelihoods).  It is kept in two parts, what the words say and what the pairs add,
and a logistic curve over both maps it to 0..1: pairs of rare words, which copies of
training texts share, thus get the weight that they earn on texts not counted.

How it runs:

1. A bit table of fixed size of the labelled ids picks the training texts; only these
   are moved to their labels.  Their pairs (48-bit hashes of words) are counted per task,
   sent packed by partitions of the second word, and added up there: a word's
   continuations are complete in one partition, and only pairs seen twice leave it.
2. Evidence is stored per word and, for pairs, as what the pair adds to its word.  The
   most frequent entries, at most ``HOT_WORDS`` and ``HOT_PAIRS``, go to every task.
   All others, however many, are asked for: a bit table tells which words and pairs
   of a text are among them, a task gathers these by hash, and requests and entries
   meet exactly, packed by ranges of the hash.
3. One pass over all texts sums the evidence of the frequent entries and sends the
   others; nothing is sampled, and no task holds the vocabulary.

``FIT_ROWS`` training rows at most, chosen by hash (a fifth of all at most), are not
counted; the logistic curve (three numbers) is fitted on their evidence.

Training rows have a label and crc32(doc_id as text) mod 4 other than 2 (those
are held out).  Labels, language, source and id are no inputs of a score.

Defined cases: a null text is empty; an empty text has evidence 0; a null id is
not a training row and counts as held out; null labels are ignored; of several
labels for one id the highest counts; repeated rows are counted and scored one
by one, equal texts alike; if the counted rows hold one class only, every score is
the share of toxic rows (0 without training rows); an empty table gives an empty
result; added columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import bit_table, hit, marked_in, saved, table, tidy, utf8
from keyflow.llm.wordhash import LETTERS, M1, hashed_words, mix, pieces

#: Most words and pairs whose evidence goes to every task; the others are joined.
HOT_WORDS, HOT_PAIRS = 1 << 18, 1 << 20
#: Bits of the tables of training ids (2 MB) and of joined entries (16 MB).
MARK_BITS, REST_BITS = 24, 27
#: Word pairs, and bytes of text, that a task works on at once.  A byte of text takes tens of bytes while its words are
#: hashed, a pair while it is sorted and packed, and a worker keeps much of what it once took.
CHUNK_PAIRS, CHUNK_BYTES = 1 << 20, 1 << 20
#: Bytes of all texts for one partition of counts.
PART_BYTES = 24_000_000
#: Most rows that the logistic curve is fitted on.
FIT_ROWS = 20_000
#: A document counts as toxic from this score on.
THRESHOLD = 0.3
HELD_OUT = 2


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return (F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4).cast("int")


# -- training -----------------------------------------------------------------

def training_marks(labels: DataFrame, fit_rows: int) -> DataFrame:
    """(id, place, toxic, fit) of the training rows' ids, written once."""
    marks = (labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max("toxic").cast("int").alias("toxic")).filter(fold("id") != HELD_OUT))
    share = min(0.2, fit_rows / max(1, marks.count()))
    fit = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000)
    return saved(marks.withColumns({"place": F.xxhash64("id"), "fit": fit}), "toxic-marks")


def training_rows(docs: DataFrame, marks: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(text, toxic) of the marked rows; a bit table keeps all other texts out of the shuffle."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(marks, "place", MARK_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(hit(bits.value, batch.column(1).to_numpy(zero_copy_only=False))))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(2)], ["id", "text"])

    texts = docs.filter(F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{doc_id}`").cast("long")).alias("place"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # the texts are streamed past the marks of their partition
    return texts.mapInArrow(tidy(run), "id long, text string").join(marks.select("id", "toxic").hint("shuffle_hash"), "id").select("text", "toxic")


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first, context): 48-bit hashes, where each text's words begin, and the word before (0 for a first word)."""
    words, first = hashed_words(data, offsets, LETTERS)
    words = words >> np.uint64(16)
    context = np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words
    context[first[:-1][first[:-1] < len(words)]] = 0
    return words, first, context


def pair_hash(context: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(context * M1 + words)


def joined(held: list[tuple]) -> list[np.ndarray]:
    """The columns of all pieces; ``held`` is emptied, so that only one copy stays."""
    columns = [list(x) for x in zip(*held, strict=True)]
    held.clear()
    return [np.concatenate(columns.pop(0)) for _ in range(len(columns))]


def summed(held: list[tuple]) -> tuple:
    """Different pairs of the pieces (v, w, n0, n1) in order of (w, v), and the sums of their counts; ``held`` is emptied."""
    v, w, *n = joined(held)
    order = np.lexsort((v, w))
    v, w = v[order], w[order]
    start = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])]))
    return v[start], w[start], *(np.add.reduceat(x[order], start, dtype=np.int64) for x in n)


def pair_counts(rows: DataFrame, parts: int) -> DataFrame:
    """Counts of the rows (text, toxic), written once.

    Rows with ``v`` are pairs with two occurrences in a class: (v, w, n0, n1), and c0, c1
    of w.  Rows without are words: (w, n0, n1, c0, c1), occurrences and continuation counts.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def packed() -> pa.RecordBatch:
            v, w, n0, n1 = summed(held)
            part = (w % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            v, w, n0, n1 = v[order], w[order], n0[order], n1[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            out = []
            for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b > a:  # a word once, then its contexts: 6 bytes each
                    new = np.flatnonzero(np.concatenate([[True], w[a + 1:b] != w[a:b - 1]]))
                    out.append((p, w[a:b][new].tobytes(), np.diff(np.append(new, b - a)).astype("<u4").tobytes(),
                                v[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
                                n0[a:b].astype("<u4").tobytes(), n1[a:b].astype("<u4").tobytes()))
            kinds = [pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                              ["part", "words", "runs", "contexts", "n0", "n1"])

        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            for a, b, data, offsets in pieces(utf8(batch.column(0)), CHUNK_BYTES):
                words, first, context = text_words(data, offsets)
                if len(words):
                    of = np.repeat(toxic[a:b], np.diff(first))
                    held.append((context, words, 1 - of, of))
                    n += len(words)
                if n >= CHUNK_PAIRS:
                    yield packed()
                    n = 0
        if n:
            yield packed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def total() -> pa.RecordBatch:
            v, w, n0, n1 = summed(held)
            start = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            words = [w[start], *(np.add.reduceat(x, start) for x in (n0, n1, (n0 > 0).astype(np.int64), (n1 > 0).astype(np.int64)))]
            kept_ = ((n0 > 1) | (n1 > 1)) & (v > 0)
            runs = np.diff(np.append(start, len(w)))
            columns = [pa.chunked_array([x, y]).combine_chunks() for x, y in zip(
                [pa.nulls(len(start), pa.int64()), *(pa.array(x.astype(np.int64)) for x in words)],
                [pa.array(x[kept_].astype(np.int64)) for x in (v, w, n0, n1, *(np.repeat(c, runs) for c in words[3:]))], strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["v", "w", "n0", "n1", "c0", "c1"])

        for batch in batches:
            for p, words, runs, contexts, n0, n1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    if held:
                        yield total()
                    part = p
                v = np.zeros((len(contexts) // 6, 8), np.uint8)
                v[:, :6] = np.frombuffer(contexts, np.uint8).reshape(-1, 6)
                held.append((v.reshape(-1).view(np.uint64), np.repeat(np.frombuffer(words, np.uint64), np.frombuffer(runs, "<u4")),
                             np.frombuffer(n0, "<u4"), np.frombuffer(n1, "<u4")))
        if held:
            yield total()

    sent = rows.select("text", "toxic").mapInArrow(tidy(count), "part int, words binary, runs binary, contexts binary, n0 binary, n1 binary")
    added = sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(tidy(add), "v long, w long, n0 long, n1 long, c0 long, c1 long")
    return saved(added, "toxic-counts")


def discounts(ones_and_twos: dict, name: str) -> list[float]:
    """n1 / (n1 + 2 n2) of both classes; 1/2 where a class has neither."""
    out = []
    for c in (0, 1):
        one, two = ones_and_twos[f"{name}{c}_1"] or 0, ones_and_twos[f"{name}{c}_2"] or 0
        out.append(one / (one + 2 * two) if one else 0.5)
    return out


def _of_counts(column: str, name: str) -> list[Column]:
    return [F.sum((F.col(f"{column}{c}") == k).cast("long")).alias(f"{name}{c}_{k}") for c in (0, 1) for k in (1, 2)]


def kept(n: str, d: float) -> Column:
    return F.greatest(F.col(n) - F.lit(d), F.lit(0.0))


def evidence(counts: DataFrame, alpha: float) -> tuple[DataFrame, DataFrame]:
    """(word, n, e) and (pair, n, e): a word's evidence, and what a pair adds to that of its second word."""
    words = counts.filter("v is null").select("w", "n0", "n1", "c0", "c1", F.least("c0", "c1").alias("both"))
    e = discounts(words.agg(*_of_counts("c", "c")).first().asDict(), "c")
    total = words.agg(F.sum("c0"), F.sum("c1"), F.sum(kept("c0", e[0])), F.sum(kept("c1", e[1])), F.sum(F.col("both") + 0.5)).first()
    lent = max(1 - total[2 + c] / total[c] for c in (0, 1))
    shared = F.lit(lent) * (F.col("both") + 0.5) / F.lit(total[4])
    p = [(F.lit((1 - lent) / max(total[2 + c], 1e-12)) * kept(f"c{c}", e[c]) + shared).alias(f"p{c}") for c in (0, 1)]
    words = words.select("w", "n0", "n1", *p)
    log = lambda ratio: F.log(F.lit(1 - alpha) + F.lit(alpha) * ratio)
    pairs = counts.filter("v is not null").withColumn("both", F.least("c0", "c1")).select("v", "w", "n0", "n1", *p)
    contexts = (pairs.groupBy("v").agg(*[F.sum(kept(f"n{c}", 1.0)).alias(f"k{c}") for c in (0, 1)]).filter("k0 > 0 and k1 > 0")
                     .join(words.select(F.col("w").alias("v"), F.col("n0").alias("m0"), F.col("n1").alias("m1")), "v")
                     .select("v", "k0", "k1", F.greatest(1 - F.col("k0") / F.col("m0"), 1 - F.col("k1") / F.col("m1")).alias("lent")))
    q = [(1 - F.col("lent")) * kept(f"n{c}", 1.0) / F.col(f"k{c}") + F.col("lent") * F.col(f"p{c}") for c in (0, 1)]
    met = pairs.join(contexts, "v")
    hashed = met.select("v", "w", (F.col("n0") + F.col("n1")).alias("n"), (log(q[1] / q[0]) - log(F.col("p1") / F.col("p0"))).alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, w = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(pair_hash(v, w).view(np.int64)), batch.column(2), batch.column(3)], ["pair", "n", "e"])

    return (words.select(F.col("w").alias("word"), (F.col("n0") + F.col("n1")).alias("n"), log(F.col("p1") / F.col("p0")).alias("e")),
            hashed.mapInArrow(tidy(run), "pair long, n long, e double"))


# -- scoring ------------------------------------------------------------------

def hot_from(entries: DataFrame, most: int) -> int:
    """The least count from which on at most ``most`` entries lie."""
    at, seen = 1 << 62, 0
    for row in entries.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().orderBy(F.desc("n")).toLocalIterator():
        seen += row["count"]
        if seen > most:
            break
        at = row["n"]
    return at


def collected(entries: DataFrame, key: str, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (in order) and evidence of the entries with ``least`` occurrences."""
    rows = entries.filter(F.col("n") >= least).select(key, F.col("e").cast("double")).toArrow()
    keys = rows.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows.column(1).to_numpy()[order]


def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The values of the keys asked for, 0 for those that are not there."""
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0.0)


#: What travels by parts of the hashes: entries of words and pairs, requests for them, and the texts' own sums.
WORDS, PAIRS, TEXTS = 0, 1, 4
_PACKED = "part int, kind int, h binary, runs binary, keys binary, x binary, y binary"
_NAMES = ["part", "kind", "h", "runs", "keys", "x", "y"]


def to_planes(h: np.ndarray) -> bytes:
    """Hashes in order as differences, whose bytes of one rank lie together: leading zeros shrink to nothing."""
    return np.ascontiguousarray(np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64), dtype=np.uint64)


def part_cuts(h: np.ndarray, parts: int) -> np.ndarray:
    """Where each part, a range of the hashes, begins and ends among hashes in order."""
    part = (h >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def dealt_entries(entries: DataFrame, key: str, kind: int, parts: int) -> DataFrame:
    """Entries (key, e) packed by parts of the hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def sent() -> pa.RecordBatch:
            h, e = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(h)
            h, e = h[order], e[order]
            cuts = part_cuts(h, parts).tolist()
            return packed([(p, kind, to_planes(h[a:b]), b"", b"", e[a:b].tobytes(), b"")
                           for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a])

        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False)))
            n += batch.num_rows
            if n >= CHUNK_PAIRS:
                yield sent()
                held, n = [], 0
        if n:
            yield sent()

    return entries.select(key, F.col("e").cast("double")).mapInArrow(tidy(run), _PACKED)


def text_evidence(docs: DataFrame, text: str, words: DataFrame, pairs: DataFrame, parts: int = 8) -> DataFrame:
    """(key, of_words, of_pairs) of every different text with words (``key``: its hash): the parts of its evidence.

    What is not in the tables that go to every task is asked for: requests and entries
    meet by ``parts`` of the hash, and what a text gets there is added to its own sums.
    """
    spark = docs.sparkSession
    from_word, from_pair = hot_from(words, HOT_WORDS), hot_from(pairs, HOT_PAIRS)
    rare_words = words.filter(F.col("n") < from_word).select(F.shiftleft("word", 16).alias("h"), "e")
    rare_pairs = pairs.filter(F.col("n") < from_pair).select(F.col("pair").alias("h"), "e")
    rest = rare_words.unionByName(rare_pairs)
    given = spark.sparkContext.broadcast((*collected(words, "word", from_word), *collected(pairs, "pair", from_pair),
                                          None if rest.isEmpty() else bit_table(rest, "h", REST_BITS)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_keys, word_e, pair_keys, pair_e, bits = given.value
        asked, held, number = {WORDS: [], PAIRS: []}, 0, 0

        def sent() -> Iterator[pa.RecordBatch]:
            for kind, some in asked.items():
                if not some:
                    continue
                h, key = joined(some)
                order = np.lexsort((key, h))
                h, key = h[order], key[order]
                del order
                new = np.concatenate([[True], h[1:] != h[:-1]])  # a hash once, then its texts, each once with its times
                start = np.flatnonzero(new | np.concatenate([[True], key[1:] != key[:-1]]))
                times, group = np.diff(np.append(start, len(h))), np.flatnonzero(new[start])
                key, h, ends = key[start], h[start[group]], np.append(group, len(start))
                cuts = part_cuts(h, parts).tolist()
                yield packed([(p, kind + 2, to_planes(h[a:b]), np.diff(ends[a:b + 1]).astype("<u4").tobytes(), key[ends[a]:ends[b]].tobytes(),
                               times[ends[a]:ends[b]].astype("<u4").tobytes(), b"")
                              for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a])

        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in pieces(utf8(batch.column(0)), CHUNK_BYTES):
                found, first, context = text_words(data, offsets)
                n = np.diff(first)
                if not len(found):
                    continue
                some, sums = np.flatnonzero(n), []
                for kind, h, k, e in ((WORDS, found << np.uint64(16), word_keys << np.uint64(16), word_e),
                                      (PAIRS, pair_hash(context, found), pair_keys, pair_e)):
                    different, back = np.unique(h, return_inverse=True)
                    sums.append(np.add.reduceat(looked_up(k, e, different)[back], first[:-1][some]).tobytes())
                    if bits is not None:
                        there = hit(bits, different)[back]
                        if there.any():
                            asked[kind].append((h[there], np.repeat(keys[a:b], n)[there]))
                            held += int(there.sum())
                number += 1  # the texts' own sums lie in any part
                yield packed([(number % parts, TEXTS, b"", n[some].astype("<u4").tobytes(), keys[a:b][some].tobytes(), *sums)])
                if held >= CHUNK_PAIRS:
                    yield from sent()
                    held = 0
        if held:
            yield from sent()

    def summed_up(held: list[tuple]) -> list[np.ndarray]:
        key, *columns = joined(held)
        different, back = np.unique(key, return_inverse=True)
        return [different, *(np.bincount(back, x, len(different)) for x in columns)]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, entries, tables, held, n_held = None, {}, {}, [], 0

        def sent() -> pa.RecordBatch:
            key, n, of_words, of_pairs = summed_up(held)
            cuts = part_cuts(key, parts).tolist()
            return packed([(p, TEXTS, to_planes(key[a:b]), n[a:b].tobytes(), b"", of_words[a:b].tobytes(), of_pairs[a:b].tobytes())
                           for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a])

        for batch in batches:
            for p, kind, h, runs, keys, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:  # a part's entries come first
                    part, entries, tables = p, {WORDS: [], PAIRS: []}, {}
                keys, n = np.frombuffer(keys, np.uint64), np.frombuffer(runs, "<u4")
                if kind == TEXTS:
                    held.append((keys, n.astype(float), np.frombuffer(x), np.frombuffer(y)))
                elif kind in entries:
                    entries[kind].append((from_planes(h), np.frombuffer(x)))
                    continue
                elif entries[kind - 2]:
                    if kind not in tables:
                        at, e = (np.concatenate(c) for c in zip(*entries[kind - 2], strict=True))
                        order = np.argsort(at)
                        tables[kind] = at[order], e[order]
                    value, none = np.repeat(looked_up(*tables[kind], from_planes(h)), n) * np.frombuffer(x, "<u4"), np.zeros(len(keys))
                    held.append((keys, none, value, none) if kind == WORDS + 2 else (keys, none, none, value))
                n_held += len(keys)
                if held and n_held >= CHUNK_PAIRS // 2:
                    yield sent()
                    n_held = 0
        if held:
            yield sent()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def total() -> pa.RecordBatch:
            key, n, of_words, of_pairs = summed_up(held)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(of_words / n), pa.array(of_pairs / n)],
                                              ["key", "of_words", "of_pairs"])

        for batch in batches:
            for p, h, n, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 5, 6)), strict=True):
                if p != part:
                    if held:
                        yield total()
                    part, held = p, []
                held.append((from_planes(h), *(np.frombuffer(c) for c in (n, x, y))))
        if held:
            yield total()

    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = texts.mapInArrow(tidy(ask), _PACKED).unionAll(dealt_entries(rare_words, "h", WORDS, parts)).unionAll(
        dealt_entries(rare_pairs, "h", PAIRS, parts))
    answers = rows.repartition(parts, "part").sortWithinPartitions("part", "kind").mapInArrow(tidy(answer), _PACKED)
    # equal texts have equal evidence: their sums and their words grow alike
    return answers.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(tidy(add), "key long, of_words double, of_pairs double")


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes (one per column) and offset of a logistic curve: Newton steps with a small ridge."""
    scale = np.where(x.std(0) > 0, x.std(0), 1.0)
    design = np.concatenate([x / scale, np.ones((len(x), 1))], 1)
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(design.T @ (design * w[:, None]) + 1e-3 * np.eye(len(beta)),
                               design.T @ (y - p) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.append(beta[:-1] / scale, beta[-1])


def spread(mean: Column, alpha: float) -> Column:
    """asinh(evidence / ALPHA), which spreads the few strong documents and the many near 0 alike."""
    return F.asinh(mean / alpha)


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           score: str = "score", predicted: str = "predicted", threshold: float = THRESHOLD,
           fit_rows: int = FIT_ROWS) -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    docs = docs.drop(score, predicted)
    marks = training_marks(labels, fit_rows)
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    counted = training_rows(docs, marks.filter("not fit"), doc_id, text)
    parts = max(8, -(-size // PART_BYTES))
    counts = pair_counts(counted, parts)
    spoken = counts.filter("v is null").agg(F.sum("n0"), F.sum("n1")).first()
    ids = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("key"))
    marked = ids.join(marks, "id")
    sizes = {r.toxic: r["count"] for r in marked.filter("not fit").groupBy("toxic").count().collect()}
    rows = [sizes.get(c, 0) for c in (0, 1)]
    if not spoken[0] or not spoken[1]:
        constant = docs.withColumn(score, F.lit(rows[1] / max(1, sum(rows))))
        return constant.withColumn(predicted, (F.col(score) >= threshold).cast("int"))
    alpha = min(0.5, rows[1] / spoken[1])
    tables = evidence(counts, alpha)
    means = saved(text_evidence(docs, text, *(saved(x, "toxic-tables") for x in tables), parts), "toxic-means")
    parts = ["of_words", "of_pairs"]
    points = (marked.filter("fit").select("key", "toxic").join(means, "key", "left")
              .select(*[spread(F.coalesce(c, F.lit(0.0)), alpha).alias(c) for c in parts], "toxic").limit(2 * fit_rows).toPandas())
    y = points["toxic"].to_numpy(float)
    slopes = fit_curve(points[parts].to_numpy(float), y) if 0 < y.sum() < len(y) else np.array([1.0, 0.0, -2.0])
    x = F.lit(float(slopes[2]))
    for c, slope in zip(parts, slopes, strict=False):
        x = x + spread(F.coalesce(f"_kf_{c}", F.lit(0.0)), alpha) * float(slope)
    x = F.greatest(F.least(x, F.lit(40.0)), F.lit(-40.0))
    given = means.select(F.col("key").alias("_kf_key"), *[F.col(c).alias(f"_kf_{c}") for c in parts])
    out = docs.withColumn("_kf_key", F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))).join(
        given.hint("shuffle_hash"), "_kf_key", "left")
    out = out.withColumn(score, 1 / (1 + F.exp(-x))).drop("_kf_key", *[f"_kf_{c}" for c in parts])
    return out.withColumn(predicted, (F.col(score) >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score lies below ``threshold``.

    Every row is scored, by id and text alone.  A bit table of the rejected texts passes most
    others where they lie; the rows that it marks meet the rejected texts in an exact join.
    """
    key = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), key.alias("_kf_text"))
    marked = scored(rows, labels, score="_kf_score", predicted="_kf_predicted", threshold=threshold, fit_rows=fit_rows)
    rejected = saved(marked.filter("_kf_predicted = 1").select("_kf_text").distinct(), "rejected")
    rows = marked_in(docs.withColumn("_kf_text", key), "_kf_text", [rejected])
    kept = rows.filter("_kf_marks = 0").unionByName(rows.filter("_kf_marks > 0").join(rejected, "_kf_text", "left_anti"))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def op10_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(True))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")
