"""WARC archives compressed with Zstandard (operator 4).

Writer: one record per row, one Zstandard frame per record, records rolled into
archives of bounded size.  A leading skippable frame (magic 0x184D2A5D) holds the
archive's dictionary, trained on a bounded sample of the archive's first records
(``SAMPLE_BYTES``).  Of records whose payload is equal and has at least
``min_bytes`` bytes, the one with the largest id is a response, the others are
revisits that name it and carry HTTP headers only.

Reader: loads the dictionary from the skippable frame (plain or itself
compressed), decodes frame by frame, and checks the version line, the required
headers, Content-Length against the block, the HTTP length and the SHA-1 digest
against the payload, and the closing line breaks.  What does not fit raises
``ValueError`` with the archive's name and offset.

Archives lie below ``spark.checkpoint.dir``, opened with the file system that
the address names.  A task writes under fresh names and returns them; only names
in the written manifest are read, so files of lost or repeated tasks are ignored.

Defined cases: a null payload is an empty one; empty payloads are responses;
several rows with the largest id and the same payload are all responses; a null
id is never the largest, so such a row revisits an equal payload that has an id,
and is a response otherwise; line breaks in an address are percent-encoded; a
null address is written as ``about:blank``; an empty table writes nothing.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import saved, table
from keyflow.session import shared_path

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC, DICTIONARY_MAGIC = b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Payload bytes of one archive, bytes of the dictionary and of the sample it is trained on.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 32_000_000, 16_384, 1_000_000
CHUNK = 1 << 18


def record_plan(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which records revisit which."""
    payload = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))
    rows = df.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                     payload.alias("payload"), F.sha1(payload).alias("digest"))
    # digests that occur more than once, combined before the shuffle; the payloads are shuffled by the join only
    several = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
                   .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1 and first is not null").select("digest", "first"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(several, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record."""
    address = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {date}", f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary trained on the samples; none where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes records to one archive; the dictionary is trained once the sample is full."""

    def __init__(self, out: BinaryIO, level: int = 3):
        self.out, self.level = out, level
        self.waiting: list[bytes] = []
        self.held, self.records, self.frames = 0, 0, None

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.frames:
            self.out.write(self.frames.compress(data))
            return
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES:
            self.start()

    def start(self) -> None:
        share = max(1, SAMPLE_BYTES // max(1, len(self.waiting)))
        made = dictionary([w[:share] for w in self.waiting])
        content = made.as_bytes() if made else b""
        self.out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self.frames = zstandard.ZstdCompressor(level=self.level, dict_data=made, write_content_size=True)
        for data in self.waiting:
            self.out.write(self.frames.compress(data))
        self.waiting = []

    def close(self) -> None:
        if not self.frames:
            self.start()


def frames(source: BinaryIO, name: str) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every frame after the dictionary."""
    head = source.read(8)
    if not head:
        return
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
        raise ValueError(f"{name}: no dictionary frame at 0")
    size = struct.unpack("<I", head[4:])[0]
    content = source.read(size)
    if len(content) != size:
        raise ValueError(f"{name}: dictionary frame cut off")
    if content[:4] == FRAME_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    if content and content[:4] != DICTIONARY_MAGIC:
        raise ValueError(f"{name}: no Zstandard dictionary in the leading frame")
    made = zstandard.ZstdCompressionDict(content) if content else None
    decompressor = zstandard.ZstdDecompressor(dict_data=made)
    offset, rest = 8 + size, b""
    while rest := rest or source.read(CHUNK):
        frame, out, used = decompressor.decompressobj(), [], 0
        try:
            while not frame.eof:
                if not rest and not (rest := source.read(CHUNK)):
                    raise ValueError(f"{name}: frame at {offset} cut off")
                out.append(frame.decompress(rest))
                used += len(rest)
                rest = b""
        except zstandard.ZstdError as error:
            raise ValueError(f"{name}: frame at {offset}: {error}") from error
        rest = frame.unused_data
        used -= len(rest)
        yield offset, b"".join(out)
        offset += used


def parsed(data: bytes, where: str) -> tuple:
    """(page_id, payload or None, payload_bytes, payload_digest, record_type, refers_to) of one record, checked."""
    end = data.find(b"\r\n\r\n")
    lines = data[:end].split(b"\r\n") if end >= 0 else [b""]
    if lines[0] != VERSION:
        raise ValueError(f"{where}: not a {VERSION.decode()} record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"{where}: bad header line")
        headers[name.strip().lower().decode()] = value.strip().decode()
    if missing := [h for h in REQUIRED if h not in headers]:
        raise ValueError(f"{where}: no {missing[0]}")
    if not headers["content-length"].isdigit():
        raise ValueError(f"{where}: bad Content-Length")
    length = int(headers["content-length"])
    block = data[end + 4:end + 4 + length]
    if len(block) != length or data[end + 4 + length:] != b"\r\n\r\n":
        raise ValueError(f"{where}: Content-Length {length} does not fit the record")
    http_end = block.find(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in block[:max(0, http_end)].split(b"\r\n")[1:])}
    if http_end < 0 or not http.get(b"content-length", b"").isdigit():
        raise ValueError(f"{where}: bad HTTP headers")
    size, kind = int(http[b"content-length"]), headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    page_id = headers["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    refers = headers.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
    payload = block[http_end + 4:]
    if kind == "response":
        if len(payload) != size:
            raise ValueError(f"{where}: the payload has {len(payload)} bytes, not {size}")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{where}: the payload's digest does not fit")
    elif kind != "revisit" or payload or not refers:
        raise ValueError(f"{where}: bad {kind} record")
    return (int(page_id) if page_id else None, payload if kind == "response" else None, size, digest, kind,
            int(refers) if refers else None)


def write_archives(df: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Write the rows' records; returns the manifest (path, records), written itself."""
    folder = folder or shared_path(df.sparkSession, "llm", "warc", fresh=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        done, writer, path, held = [], None, "", 0
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, payload, digest, refers_to = (v.as_py() for v in row)
                if writer is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    writer, held = ArchiveWriter(system.open_output_stream(path)), 0
                writer.add(record(page_id, url, payload, digest, refers_to, date))
                held += len(payload)
                if held >= archive_bytes:
                    writer.close()
                    writer.out.close()
                    done.append((path, writer.records))
                    writer = None
        if writer is not None:
            writer.close()
            writer.out.close()
            done.append((path, writer.records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["path", "records"])

    name = F.element_at(F.split("path", "/"), -1)  # a name, to be opened below the same folder
    written = record_plan(df, **columns).mapInArrow(run, "path string, records long")
    return saved(written.select(F.concat(F.lit(folder.rstrip("/") + "/"), name).alias("path"), "records"), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, payload, payload_bytes, payload_digest, record_type, refers_to) of every record in the archives."""
    schema = ("page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long")
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in schema.split(", ")]

    def some(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with system.open_input_stream(inner) as source:
                    for offset, data in frames(source, path):
                        row = parsed(data, f"{path} at {offset}")
                        rows.append(row if payloads else (row[0], None, *row[2:]))
                        held += len(row[1] or b"") if payloads else 0
                        if len(rows) >= 5000 or held >= 8_000_000:
                            yield some(rows)
                            rows, held = [], 0
                if rows:
                    yield some(rows)

    archives = max(1, manifest.count())
    return manifest.select("path").repartition(archives).mapInArrow(run, schema)


def op4_warc(spark, sf_dir):
    """Write a record for every page, then read the archives back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return read_archives(write_archives(pages), payloads=False).drop("payload")


OP4_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), m AS (
  SELECT payload_digest, max(page_id) AS latest, count(*) AS n FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM latest AND latest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""
