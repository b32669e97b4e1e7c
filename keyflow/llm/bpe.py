"""Byte-level BPE encoding and decoding (operator 1).

A text is cut into pre-tokens, each pre-token's bytes become a doubly linked
list of symbols, and a priority queue holds the adjacent pairs that have a
merge rank.  The lowest (rank, position) is popped; an entry whose symbols have
changed since it was pushed is stale and skipped.  Decoding concatenates the
vocabulary strings and maps their characters back to bytes.

The vocabulary file is a parameter.  It is read on the driver and shipped as a
broadcast (its size is that of the vocabulary and does not grow with the data).

Defined cases: a null text is an empty text; an empty text has no ids; a null
id list decodes to an empty text; ids outside the vocabulary are skipped;
bytes that are not UTF-8 decode to U+FFFD; rows are neither merged nor
reordered, so repeated rows and ties stay; added columns replace columns of the
same name, all others pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import table, utf8, with_columns

# Fixed value: the pre-token pattern of the public byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranges(first: str) -> str:
    """Character ranges of the fast pattern: code points below U+0250 of a general category."""
    codes = [c for c in range(0x250) if unicodedata.category(chr(c))[0] == first]
    runs: list[list[int]] = []
    for c in codes:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


# The same cut for texts of Latin letters and common punctuation, with the faster built-in matcher.
_L, _N = _ranges("L"), _ranges("N")
FAST = re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
NOT_FAST = re.compile("[\x1c-\x1f\u0250-\u200f\u2028-\u209f\u20c0-\U0010ffff]")

#: Pre-tokens whose ids a worker keeps; the store is emptied when it is full.
CACHE_WORDS = 400_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks, ids and strings read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        self.byte_ids = [ids[c] for c in byte_chars()]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        self.strings: dict[int, bytes] = {}
        for text, i in [*ids.items(), *self.added.items()]:
            known = all(c in to_byte for c in text)
            self.strings[i] = bytes(to_byte[c] for c in text) if known else text.encode()


def merge_symbols(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the merges to a symbol list: lowest rank first, leftmost among equals."""
    n = len(symbols)
    if n < 2:
        return symbols
    queue = []
    for i in range(n - 1):
        found = pairs.get((symbols[i], symbols[i + 1]))
        if found is not None:
            queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    if not queue:
        return symbols
    heapq.heapify(queue)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pop, push = heapq.heappop, heapq.heappush
    while queue:
        _, i, left, right, merged = pop(queue)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # stale: one of the two symbols was merged meanwhile
        symbols[i] = merged
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = pairs.get((merged, symbols[k]))
            if found is not None:
                push(queue, (found[0], i, merged, symbols[k], found[1]))
        h = before[i]
        if h >= 0:
            found = pairs.get((symbols[h], merged))
            if found is not None:
                push(queue, (found[0], h, symbols[h], merged, found[1]))
    return [s for s in symbols if s >= 0]


class Encoder:
    """Encodes texts; one per task.  Ids are kept as the bytes of 32-bit integers, so words join without Python lists."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.vocabulary = vocabulary
        self.words = regex.compile(PATTERN).findall
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words
        parts = sorted(map(regex.escape, vocabulary.added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(parts) + ")") if parts else None

    def word(self, word: str) -> bytes:
        byte_ids = self.vocabulary.byte_ids
        ids = array("i", merge_symbols([byte_ids[b] for b in word.encode()], self.vocabulary.pairs)).tobytes()
        if len(word) <= 64:
            if len(self.cache) >= self.cache_words:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def ordinary(self, text: str) -> bytes:
        words = self.words(text) if NOT_FAST.search(text) else FAST.findall(text)
        found = list(map(self.cache.get, words))
        if None in found:
            get, word = self.cache.get, self.word
            found = [ids if ids is not None else get(w) or word(w) for ids, w in zip(found, words, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit integers."""
        added = self.vocabulary.added
        if self.special is None or not any(s in text for s in added):
            return self.ordinary(text)
        return b"".join(array("i", [added[part]]).tobytes() if part in added else self.ordinary(part)
                        for part in self.special.split(text))


class Decoder:
    """Joins vocabulary strings: all strings lie in one array, from which the ids' pieces are gathered."""

    def __init__(self, strings: dict[int, bytes]):
        self.size = max(strings, default=-1) + 1
        rows = [strings.get(i, b"") for i in range(self.size)]
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.data = np.frombuffer(b"".join(rows), np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ``ids[ends[i]:ends[i + 1]]``."""
        known = (ids >= 0) & (ids < self.size)
        ids = np.where(known, ids, 0)
        lengths = np.where(known, self.lengths[ids], 0) if self.size else np.zeros(len(ids), np.int64)
        reach = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(reach[-1]) + np.repeat(self.starts[ids] - reach[:-1], lengths)
        data = self.data[place].tobytes()
        cuts = reach[ends].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids",
           digest: str | None = None) -> DataFrame:
    """Append ``ids`` (array of int): the whole text's token ids, in order.

    With ``digest`` also append the SHA-256 (lower-case hex) of the ids as
    little-endian unsigned 32-bit integers.
    """
    vocabulary = Vocabulary(vocabulary_path)
    vocabulary.strings = {}  # only decode needs them
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        encoder = Encoder(shared.value)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [encoder.encode(t.as_py()) for t in utf8(batch.column(0))]
            ends = np.cumsum([0, *map(len, rows)]) // 4
            values = pa.array(np.frombuffer(b"".join(rows), "<i4"))
            out = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)]
            if digest:
                out.append(pa.array([hashlib.sha256(r).hexdigest() for r in rows], pa.string()))
            return out
        return step

    kind = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), True)),
                         *([T.StructField(digest, T.StringType())] if digest else [])])
    return with_columns(df, [text], kind, make)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append ``decoded`` (string): the vocabulary strings of ``ids``, joined; null ids inside a list are skipped."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path).strings)

    def make():
        decoder = Decoder(shared.value)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(0).fill_null([]) if batch.column(0).null_count else batch.column(0)
            values = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            texts, a = [], 0
            while a < len(lengths):  # about 2 million ids at a time
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + (1 << 21), "right")) - 1)
                texts += decoder.decode(values[ends[a]:ends[b]], ends[a:b + 1] - ends[a])
                a = b
            return [pa.array(texts, pa.string())]
        return step

    return with_columns(df, [ids], T.StructType([T.StructField(decoded, T.StringType())]), make)


def op1_bpe(spark, sf_dir):
    """Encode every document and decode the ids again; digests of both."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode(encode(docs, path, digest="ids_sha256").drop("text"), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
