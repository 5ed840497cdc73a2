"""Zstandard WARC archives: one frame per record, dictionary in a leading skippable frame.

An archive is one binary value, so that it can come from ``binaryFile`` (``read_files``) or from
a Parquet table of (archive, content), which any store that Spark reaches can hold. Both are read
by the same parser. Writing: ``write_archives`` packs the rows of each task into archives of about
``archive_bytes``; ``export_files`` writes them as ``.warc.zst`` files into a mounted folder.

The reader loads the dictionary from the leading skippable frame (raw or itself compressed; an
archive without one is read without), finds every frame's end from its block headers, decodes one
frame at a time and checks: one record per frame, version line, header lines, Content-Length
against the block, the closing blank lines, payload and block digests. A record that fails is
returned with ``error`` set and the next frame is read; after a frame whose own structure is
broken the rest of that archive is one error row, as its frame borders are lost.

Defined cases: a null payload is an empty one; a null URL or id leaves its header out and reads
back as null; control characters in a URL are percent-encoded in the header, so a URL cannot add header
lines. Of equal payloads, those with the smallest id are responses, the others revisits; null ids
rank behind all others. Empty tables give no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import attach
from facetry.session import materialize, ship_package

SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_SAMPLES = 512
SAMPLE_CHARS = 8192

RECORD = (
    "archive string, record_id string, record_type string, uri string, page_id long, "
    "refers_to long, payload binary, payload_bytes long, payload_digest string, error string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- one record ----------------------------------------------------------------------------


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one response or revisit record."""
    digest = sha1_base32(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        f"Content-Length: {len(payload)}".encode() + END
    )
    block = http if revisit else http + payload
    lines = [
        "WARC-Type: " + ("revisit" if revisit else "response"),
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest} {revisit}')}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + _header_value(url))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines.append("WARC-Profile: " + REVISIT_PROFILE)
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + block + END


def _headers(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        fields[name.decode("ascii").lower()] = value.strip().decode()
    return fields


def parse_record(data: bytes) -> dict:
    """Validate one record; ValueError says what is wrong."""
    head, gap, rest = data.partition(END)
    version, newline, head = head.partition(b"\r\n")
    if not gap or not newline or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError("no WARC version line and headers")
    fields = _headers(head)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"no header {sorted(missing)[0]}")
    if not re.fullmatch(r"\d+", fields["content-length"]):
        raise ValueError("Content-Length is not a number")
    length = int(fields["content-length"])
    if len(rest) != length + len(END) or not rest.endswith(END):
        raise ValueError(f"Content-Length {length}, but {len(rest) - len(END)} bytes before the closing blank lines")
    block = rest[:length]
    if fields.get("warc-block-digest", sha := "sha1:" + sha1_base32(block)) != sha:
        raise ValueError("block digest differs")
    http, gap, payload = block.partition(END)
    inner = _headers(http.partition(b"\r\n")[2]) if gap else {}
    size = int(inner.get("content-length", len(payload)))
    digest = fields.get("warc-payload-digest", "")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != size:
            raise ValueError("payload length differs from the HTTP header")
        if digest != "sha1:" + sha1_base32(payload):
            raise ValueError("payload digest differs")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "record_id": fields["warc-record-id"],
        "record_type": kind,
        "uri": fields.get("warc-target-uri"),
        "page_id": number("x-page-id"),
        "refers_to": number("x-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest.removeprefix("sha1:"),
        "error": None,
    }


# ---- one archive ---------------------------------------------------------------------------


def leading_frame(dictionary: bytes) -> bytes:
    if not dictionary:
        return b""
    return SKIPPABLE_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary


def frame_end(data: memoryview, start: int) -> int:
    """Where the Zstandard frame that begins at ``start`` ends, from its block headers."""
    if int.from_bytes(data[start : start + 4], "little") != FRAME_MAGIC:
        raise ValueError("no Zstandard frame")
    window = bytes(data[start : start + 18])
    at = start + zstandard.frame_header_size(window)
    checksum = zstandard.get_frame_parameters(window).has_checksum
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("frame is cut off")
        word = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(word & 1), word >> 1 & 3, word >> 3
        if kind == 3:
            raise ValueError("reserved block type")
        at += 3 + (1 if kind == 1 else size)
    at += 4 * checksum
    if at > len(data):
        raise ValueError("frame is cut off")
    return at


def read_dictionary(data: memoryview) -> tuple[bytes, int]:
    """The dictionary of the leading skippable frame (empty without one) and where records begin."""
    if len(data) < 8 or int.from_bytes(data[:4], "little") != SKIPPABLE_MAGIC:
        return b"", 0
    end = 8 + int.from_bytes(data[4:8], "little")
    if end > len(data):
        raise ValueError("the dictionary frame is cut off")
    dictionary = bytes(data[8:end])
    if dictionary[:4] == FRAME_MAGIC.to_bytes(4, "little"):
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    return dictionary, end


def read_archive(content: bytes) -> Iterator[dict]:
    """Every record of one archive, in order; see the module's text for damaged ones."""
    data = memoryview(content)
    blank = dict.fromkeys(
        ("record_id", "record_type", "uri", "page_id", "refers_to", "payload", "payload_bytes", "payload_digest")
    )
    try:
        dictionary, at = read_dictionary(data)
        used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        decoder = zstandard.ZstdDecompressor(dict_data=used)
    except (ValueError, zstandard.ZstdError) as error:
        yield blank | {"error": f"dictionary: {error}"}
        return
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as error:
            yield blank | {"error": f"byte {at}: {error}"}
            return
        try:
            yield parse_record(decoder.decompressobj().decompress(data[at:end]))
        except (ValueError, zstandard.ZstdError) as error:
            yield blank | {"error": f"byte {at}: {error}"}
        at = end


# ---- tables --------------------------------------------------------------------------------


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary; too few or too small samples serve as a raw one themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def write_archives(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = 16 << 20,
    dictionary_bytes: int = 64 << 10,
    level: int = 3,
) -> DataFrame:
    """``(archive, content)``. Payloads under ``min_bytes`` are never written as revisits.

    The dictionary comes from a sample of bounded size: the first ``SAMPLE_CHARS`` characters of
    about ``DICTIONARY_SAMPLES`` pages, drawn by a hash of the id.
    """
    spark = pages.sparkSession
    ship_package(spark)
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("id"), F.col(url).alias("url"), body.alias("html"), F.sha2(body, 256).alias("sha")
    )
    slim = rows.select("id", "sha", F.octet_length("html").alias("size"))
    shared = materialize(
        slim.where(F.col("size") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    total = slim.count()
    draw = F.pmod(F.xxhash64("id", F.lit("dictionary")), F.lit(1 << 30)) < (DICTIONARY_SAMPLES << 30) // max(1, total)
    drawn = rows.where(draw).select(F.substring("html", 1, SAMPLE_CHARS).alias("s")).limit(4 * DICTIONARY_SAMPLES)
    sample = sorted(r["s"].encode() for r in drawn.collect())
    dictionary = train_dictionary([s for s in sample if s], dictionary_bytes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=level, dict_data=used, write_checksum=True)
        lead, task, made = leading_frame(dictionary), TaskContext.get().partitionId(), 0
        parts, size = [lead], len(lead)

        def done() -> pa.RecordBatch:
            name = f"part-{task:05d}-{made:05d}.warc.zst"
            return pa.record_batch([pa.array([name]), pa.array([b"".join(parts)], pa.binary())], ["archive", "content"])

        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "html", "first")]
            for own, link, text, first in zip(*[c.to_pylist() for c in columns], strict=True):
                revisit = first is not None and own != first
                frame = coder.compress(make_record(own, link, text.encode(), first if revisit else None, revisit))
                parts.append(frame)
                size += len(frame)
                if size >= archive_bytes:
                    yield done()
                    parts, size, made = [lead], len(lead), made + 1
        if len(parts) > 1:
            yield done()

    marked = attach(rows, shared, ["sha"], "n", total).select("id", "url", "html", "first")
    return marked.mapInArrow(pack, "archive string, content binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records (schema ``RECORD``) of a table with columns archive and content."""
    ship_package(archives.sparkSession)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD.split(", ")])
        for batch in batches:
            for name, content in zip(
                batch.column("archive").to_pylist(), batch.column("content"), strict=True
            ):
                held, size = [], 0
                for record in read_archive(content.as_py() or b""):
                    held.append({"archive": name} | record)
                    size += len(record["payload"] or b"")
                    if size > 4 << 20 or len(held) >= 4096:
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in held], schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in held], schema)

    return archives.select("archive", "content").mapInArrow(unpack, RECORD)


def read_files(spark, path: str) -> DataFrame:
    """Records of the ``.warc.zst`` files under ``path`` (any store Spark reads; up to 2 GB a file)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return read_archives(files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content"))


def export_files(archives: DataFrame, folder: str) -> int:
    """Write each archive as a file into a folder mounted on every executor; number of files.

    A file appears under its name only when complete, so a task that runs again replaces it.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                with tempfile.NamedTemporaryFile(dir=folder, suffix=".part", delete=False) as out:
                    out.write(content.as_py())
                os.replace(out.name, os.path.join(folder, name))
                n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], ["n"])

    return archives.select("archive", "content").mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
