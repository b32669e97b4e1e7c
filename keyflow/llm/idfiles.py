"""Token ids in binary files: canonical length-limited Huffman codes (operator 11).

1. ``encoded``: a tokenizer's ids of every whole text, an end id appended.
2. ``id_counts``: counts of the ids over all rows, added up per task; at most one
   row per id of the vocabulary reaches the driver.  ``code_lengths`` turns them
   into code lengths of at most ``limit`` bits (package-merge), which fix the code.
3. ``write_ids``: rows in ascending order of their id are coded into files, one
   or more per range of ids.  A file is a row of independent blocks; a block has
   its number of ids, the bit offset of every ``EVERY``-th id (checkpoints), the
   bits and a CRC-32.  A footer lists the blocks and the rows.
4. ``read_ids``: files are read block by block.  All stretches between checkpoints
   of a block are decoded side by side, one table look-up per id;
   ``IdFile.ids`` reads any range of a file from the checkpoint before it.

File: ``MAGIC``, header (vocabulary size, longest code: u32 each; code length of
every id, one byte each, deflated, after its size as u32), blocks, footer
(deflated), size of the footer (u64), ``MAGIC``.  All integers little-endian.

Defined cases: a null or empty text is the end id alone; rows with a null id come
first; rows with equal ids follow each other by the hash of their ids, equal rows
as read; extra columns are ignored; an empty table gives no file and no rows; a
vocabulary with one used id gives it a code of one bit.  Damaged files raise.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import GROUP_BITS, running_starts, saved, table, utf8
from keyflow.session import shared_path

MAGIC = b"KFIDS001"
#: Ids of a block, and of a stretch between two checkpoints.
BLOCK, EVERY = 1 << 18, 1 << 7
#: Longest code in bits, unless the vocabulary needs more.
LIMIT = 16
#: Ids of one range of rows (and so, about, of a file).
IDS_PER_FILE = 1 << 22
#: Stems whose ids a Python process remembers, and half the number of words.
REMEMBERED = 1 << 19


# -- tokenizing ---------------------------------------------------------------

#: The normalizer and pre-tokenizer for which words may be encoded one by one.
BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: Punctuation that may end a word; letters below this character need no normalizing.
ENDS, PLAIN = ".,;:!?", "\u0250"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TextEncoder:
    """Ids of whole texts, as the tokenizers library gives them.

    A vocabulary whose pipeline is ``BY_WORD`` drops white space, and none of its
    rules reaches across it: a text's ids are those of its words, and words met before
    are not encoded again.  Of those met first, a word with punctuation after its last
    letter is two pieces, ASCII capitals become small, and a word of small letters
    below ``PLAIN`` is one piece for the library's BPE model, which no rule before it
    would change.  All else, and every text of other vocabularies, takes the library's
    whole pipeline.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(definition)
        self.by_word = all(parts[k] == v for k, v in BY_WORD.items())
        self.bytes = byte_characters()
        self.stems: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())  # the words met, and where their ids are in ``ids``
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: pa.Array) -> None:
        pieces = [self.piece(w) for w in words.to_pylist()]
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(pieces), "<u4")])
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def piece(self, word: str) -> bytes:
        """A word's ids."""
        body = word.rstrip(ENDS)
        if len(body) < len(word) and body and body[-1].isalpha() and body[-1].lower().isalpha():
            return self.stem(body) + self.stem(word[len(body):])
        return self.stem(word)

    def stem(self, word: str) -> bytes:
        if word.isascii() and "<|" not in word:
            word = word.lower()
        if (found := self.stems.get(word)) is None:
            if len(self.stems) >= REMEMBERED:
                self.stems = {}
            if word.isalpha() and max(word) < PLAIN and word == word.lower():
                plain = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes)
                found = array("I", [t.id for t in self.tokenizer.model.tokenize(plain)]).tobytes()
            else:
                found = self.library(word)
            self.stems[word] = found
        return found

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids end (from 0)."""
        if not self.by_word:
            pieces = [self.library(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(pieces), "<u4"), np.cumsum([0, *map(len, pieces)]) // 4
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        if len(self.words) + len(coded.dictionary) > 2 * REMEMBERED:
            self._forget()
        met = pc.index_in(coded.dictionary, value_set=self.words)
        new = met.is_null()
        place = met.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(met.null_count)
        self._learn(coded.dictionary.filter(new))
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.ends[at + 1] - self.ends[at]
        reach = np.concatenate([[0], np.cumsum(sizes)])
        gather = np.repeat(self.ends[at] - reach[:-1], sizes)
        gather += np.arange(reach[-1])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
        return self.ids[gather], reach[ends]


#: The encoder of this Python process, kept for its next task.
_ENCODER: dict[str, TextEncoder] = {}


def encoder_of(definition: str) -> TextEncoder:
    if definition not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[definition] = TextEncoder(definition)
    return _ENCODER[definition]


def encoded(df: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
            size: int | None = None) -> DataFrame:
    """(id, src, ids): each row's ids with the end id, as packed little-endian integers (see ``width``).

    ``src`` is the row's place as read.  The result is written, so texts are encoded once.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = df.sparkSession.sparkContext.broadcast(file.read())
    kind = width(size or vocabulary_size(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition.value)
        for batch in batches:
            ids, ends = encoder.encode(utf8(batch.column(2)))
            rows = [np.append(ids[a:b], end_id).astype(kind).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["id", "src", "ids"])

    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("src"),
                       F.col(f"`{text}`").alias("text"))
    return saved(source.mapInArrow(run, "id long, src long, ids binary"), "ids", compression="zstd")


def vocabulary_size(tokenizer_path: str) -> int:
    """Number of ids a tokenizer file can give (the largest id and one)."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()) + 1


def width(size: int) -> str:
    """The packed form of ids below ``size``."""
    return "<u2" if size <= 1 << 16 else "<u4"


def id_counts(coded: DataFrame, size: int) -> np.ndarray:
    """Occurrences of every id below ``size`` over all rows."""
    kind = width(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    for row in coded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row.id] = row.n
    return counts


# -- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the best prefix code with no code over ``limit`` bits (0: unused), by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    used = used[np.argsort(counts[used], kind="stable")]
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    coins = np.asarray(counts)[used].astype(np.int64)
    levels, row = [], coins[:0]
    for _ in range(limit):
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([coins, pairs])
        order = np.argsort(both, kind="stable")  # of equal weights coins come first
        row = both[order]
        levels.append(order < len(coins))
    taken = 2 * len(used) - 2
    for is_coin in reversed(levels):
        n = int(is_coin[:taken].sum())
        lengths[used[:n]] += 1  # the lightest coins are taken at every level
        taken = 2 * (taken - n)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes by id, the decoding table (``id << 5 | length`` by the next bits) and its number of bits."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    bits = int(lengths.max(initial=0))
    spans = np.int64(1) << (bits - lengths[used].astype(np.int64))
    starts = np.cumsum(spans) - spans
    codes = np.zeros(len(lengths), np.uint64)
    codes[used] = starts >> (bits - lengths[used].astype(np.int64))
    entries = np.zeros(1 << bits, np.uint32)
    filled = np.repeat((used.astype(np.uint32) << 5) | lengths[used], spans)
    entries[:len(filled)] = filled
    return codes, entries, bits


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int = EVERY) -> tuple[np.ndarray, bytes]:
    """Checkpoints (bit offset of every ``every``-th id) and the bits, first bit highest."""
    size = lengths[ids].astype(np.int64)
    if len(ids) and size.min() == 0:
        raise ValueError("an id without a code: the counts are of other rows")
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    word, room = starts >> 5, 32 - (starts & 31) - size
    value = codes[ids]
    high = np.where(room >= 0, value << np.maximum(room, 0).astype(np.uint64), value >> np.maximum(-room, 0).astype(np.uint64))
    low = np.where(room < 0, (value << np.where(room < 0, 32 + room, 0).astype(np.uint64)) & np.uint64(0xFFFFFFFF), np.uint64(0))
    # codes fill separate bits of a word, so the sums are exact
    words = np.bincount(word, high, total // 32 + 2) + np.bincount(word + 1, low, total // 32 + 2)
    return starts[::every].astype("<u4"), words.astype(">u4").tobytes()[:(total + 7) // 8]


def unpack(data: bytes, checkpoints: np.ndarray, n: int, entries: np.ndarray, bits: int, every: int = EVERY) -> np.ndarray:
    """The ids of a block: all stretches side by side, one look-up per id."""
    if not n:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at, last = checkpoints.astype(np.int64), len(window) - 1
    out = np.empty((min(every, n), len(at)), np.uint32)
    mask, room = np.uint32((1 << bits) - 1), 32 - bits
    tail = n - (len(at) - 1) * every
    for step in range(len(out)):
        got = entries[(window[np.minimum(at >> 3, last)] >> (room - (at & 7)).astype(np.uint32)) & mask]
        out[step] = got >> 5
        at += got & 31
        if step == tail - 1:
            end = int(at[-1])
    if not (at[:-1] == checkpoints[1:]).all() or (end + 7) // 8 != len(data):
        raise ValueError("bits do not meet the checkpoints")
    return out.T.reshape(-1)[:n]


# -- files --------------------------------------------------------------------

class IdWriter:
    """Writes rows of ids to one file."""

    def __init__(self, out: BinaryIO, lengths: np.ndarray, codes: np.ndarray, block: int = BLOCK, every: int = EVERY):
        self.out, self.lengths, self.codes, self.block, self.every = out, lengths, codes, block, every
        head = zlib.compress(lengths.tobytes())
        self.at, self.total = 0, 0
        self._put(MAGIC + struct.pack("<IIII", len(lengths), block, every, len(head)) + head)
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.blocks: list[int] = []
        self.rows: list[int | None] = []
        self.sizes: list[int] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, row_id: int | None, ids: np.ndarray) -> None:
        self.rows.append(row_id)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.block * self.block
            for a in range(0, whole, self.block):
                self._block(ids[a:a + self.block])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        checkpoints, data = pack(ids, self.codes, self.lengths, self.every)
        body = checkpoints.tobytes() + data
        self.blocks.append(self.at)
        self._put(struct.pack("<III", len(ids), len(data), zlib.crc32(body)) + body)
        self.total += len(ids)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        nulls = np.array([r is None for r in self.rows], np.uint8)
        rows = np.array([r or 0 for r in self.rows], "<i8")
        footer = zlib.compress(struct.pack("<QQ", len(self.blocks), len(rows)) + np.array(self.blocks, "<u8").tobytes()
                               + rows.tobytes() + nulls.tobytes() + np.array(self.sizes, "<u8").tobytes(), 1)
        self._put(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.out.close()


class IdFile:
    """Reads one file: rows in order, or any range of ids."""

    def __init__(self, source, name: str):
        self.source, self.name = source, name
        total = source.size()
        if total < 24 + 16 or self._get(0, 8) != MAGIC or self._get(total - 8, 8) != MAGIC:
            raise ValueError(f"{name}: not a whole file of ids")
        size, self.block, self.every, head = struct.unpack("<IIII", self._get(8, 16))
        self.lengths = np.frombuffer(zlib.decompress(self._get(24, head)), np.uint8)
        if len(self.lengths) != size:
            raise ValueError(f"{name}: bad header")
        _, self.entries, self.bits = canonical(self.lengths)
        (foot,) = struct.unpack("<Q", self._get(total - 16, 8))
        data = zlib.decompress(self._get(total - 16 - foot, foot))
        blocks, rows = struct.unpack("<QQ", data[:16])
        self.blocks = np.frombuffer(data, "<u8", blocks, 16)
        self.rows = np.frombuffer(data, "<i8", rows, 16 + 8 * blocks)
        self.nulls = np.frombuffer(data, np.uint8, rows, 16 + 8 * (blocks + rows)).astype(bool)
        self.sizes = np.frombuffer(data, "<u8", rows, 16 + 8 * (blocks + rows) + rows).astype(np.int64)

    def _get(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _parts(self, number: int) -> tuple[int, np.ndarray, bytes]:
        at = int(self.blocks[number])
        n, size, check = struct.unpack("<III", self._get(at, 12))
        points = -(-n // self.every)
        body = self._get(at + 12, 4 * points + size)
        if len(body) != 4 * points + size or zlib.crc32(body) != check:
            raise ValueError(f"{self.name}: block {number} is damaged")
        return n, np.frombuffer(body, "<u4", points), body[4 * points:]

    def read_block(self, number: int) -> np.ndarray:
        n, points, data = self._parts(number)
        return unpack(data, points, n, self.entries, self.bits, self.every)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive) of the file, decoded from the checkpoint before ``start``."""
        out = []
        while start < stop:
            number, inside = divmod(start, self.block)
            n, points, data = self._parts(number)
            first = inside // self.every
            last = -(-min(n, stop - number * self.block) // self.every)
            begin = int(points[first]) >> 3
            end = (int(points[last]) + 7) // 8 if last < len(points) else len(data)
            some = unpack(data[begin:end], points[first:last].astype(np.int64) - 8 * begin,
                          min(n, last * self.every) - first * self.every, self.entries, self.bits, self.every)
            some = some[inside - first * self.every:stop - number * self.block - first * self.every]
            out.append(some)
            start += len(some)
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def __iter__(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """(row id, ids before it in the file, its ids in pieces) of every row."""
        number, held, used, at = -1, np.zeros(0, np.uint32), 0, 0
        for row, null, size in zip(self.rows.tolist(), self.nulls.tolist(), self.sizes.tolist(), strict=True):
            pieces, missing = [], size
            while missing:
                if used == len(held):
                    number += 1
                    held, used = self.read_block(number), 0
                pieces.append(held[used:used + missing])
                used += len(pieces[-1])
                missing -= len(pieces[-1])
            yield (None if null else row), at, pieces
            at += size


def write_ids(coded: DataFrame, size: int, lengths: np.ndarray, folder: str | None = None,
              ids_per_file: int = IDS_PER_FILE, total: int | None = None) -> DataFrame:
    """Write rows (id, src, ids) in ascending order of id; returns the manifest (file, path, rows, ids, start).

    ``file`` numbers the files in order, ``start`` is the number of ids in the files before.
    """
    spark = coded.sparkSession
    folder = (folder or shared_path(spark, "llm", "idfiles", fresh=True)).rstrip("/")
    kind, shared = width(size), spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        codes, _, _ = canonical(shared.value)
        part, done, writer, name = TaskContext.get().partitionId(), [], None, ""

        def finished() -> None:
            writer.close()
            done.append(((part << 32) + len(done), name, len(writer.rows), writer.total))

        for batch in batches:
            for row_id, ids in zip(*batch.columns, strict=True):
                if writer is None:
                    name = f"{part:08d}-{len(done):04d}-{uuid.uuid4().hex}.ids"  # a task run again writes other files
                    writer = IdWriter(system.open_output_stream(f"{base}/{name}"), shared.value, codes)
                writer.add(row_id.as_py(), np.frombuffer(ids.as_buffer(), kind))
                if writer.total >= 4 * ids_per_file:  # a range fuller than sampled
                    finished()
                    writer = None
        if writer is not None:
            finished()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["file", "name", "rows", "ids"])

    total = int(total if total is not None else 0)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("ids"), F.col("src")]
    ordered = coded.repartitionByRange(max(1, -(-total // ids_per_file)), *order).sortWithinPartitions(*order)
    manifest = saved(ordered.select("id", "ids").mapInArrow(run, "file long, name string, rows long, ids long"), "idfiles-manifest")
    group = F.shiftright("file", 32 + GROUP_BITS)
    return running_starts(manifest, "file", group, "ids", "start").select(
        "file", F.concat(F.lit(folder + "/"), "name").alias("path"), "rows", "ids", "start")


def read_ids(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if asked, ids: array of int) of every row in the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def some(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base, expected in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inner = fs.FileSystem.from_uri(path)
                rows, held, seen = [], 0, 0
                with system.open_input_file(inner) as source:
                    for row_id, at, pieces in IdFile(source, path):
                        check = 0
                        for piece in pieces:
                            check = zlib.crc32(piece.astype("<u4").tobytes(), check)
                        n = sum(map(len, pieces))
                        row = (row_id, base + at, n, check)
                        rows.append((*row, np.concatenate([p.astype(np.int32) for p in pieces]) if pieces else []) if ids else row)
                        held, seen = held + n * ids, seen + 1
                        if len(rows) >= 5000 or held >= 2_000_000:
                            yield some(rows)
                            rows, held = [], 0
                if seen != expected:
                    raise ValueError(f"{path}: {seen} rows, the manifest has {expected}")
                if rows:
                    yield some(rows)

    files = max(1, manifest.count())
    return manifest.select("path", "start", "rows").repartition(files).mapInArrow(run, schema)


def op11_idfiles(spark, sf_dir):
    """Encode every document, write the ids as Huffman-coded files and read them back."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    size = vocabulary_size(path)
    coded = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path, end_id=1, size=size)
    counts = id_counts(coded, size)
    manifest = write_ids(coded, size, code_lengths(counts), total=int(counts.sum()))
    return read_ids(manifest, ids=False)
