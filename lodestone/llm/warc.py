"""WARC archives compressed with Zstandard: one frame per record, after a frame with the dictionary.

Writing: each task writes archives of bounded size into the shared folder, under names
of its own, and returns their paths; only the paths of tasks that succeeded are in the
written list, so a lost executor leaves at most a file that nobody reads. Reading: one
archive per task; the dictionary comes from the leading skippable frame, records are
decoded frame by frame in bounded memory, and headers, lengths and digests are checked.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import common
from lodestone.session import Workspace

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

LEVEL = 3
DICTIONARY_BYTES = 1 << 15
# The dictionary is trained on the beginnings of a bounded sample of payloads.
TRAIN_PAGES, TRAIN_BYTES = 300, 4096
ARCHIVE_BYTES = 64 << 20
# Archives are read one per task, up to this many tasks.
MOST_TASKS = 50_000
READ_BYTES = 1 << 16
DATE = "2000-01-01T00:00:00Z"


class Damaged(ValueError):
    """An archive that breaks the format."""


# --- records -------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, payload_bytes: int, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "") or "urn:unknown"
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header, HTTP header and payload of one record; raises ``Damaged``."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise Damaged("not a WARC record")
    header = _fields(lines[1:])
    if missing := [k for k in REQUIRED if k not in header]:
        raise Damaged(f"no {', '.join(missing)}")
    if not header["Content-Length"].isdigit() or len(rest) != int(header["Content-Length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise Damaged(f"{len(rest) - 4} bytes in a block of {header['Content-Length']}")
    top, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    http = _fields(top.split(b"\r\n")[1:])
    if not gap or not http.get("Content-Length", "").isdigit():
        raise Damaged("no HTTP header")
    if header["WARC-Type"] == "response":
        if len(payload) != int(http["Content-Length"]):
            raise Damaged(f"{len(payload)} bytes in a payload of {http['Content-Length']}")
        if header.get("WARC-Payload-Digest") != "sha1:" + digest(payload):
            raise Damaged("the payload has another digest")
    elif header["WARC-Type"] != "revisit" or payload or "WARC-Refers-To" not in header:
        raise Damaged(f"a {header['WARC-Type']} record that can't be")
    return header, http, payload


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise Damaged("a header line without a name")
        out[name] = value.strip()
    return out


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- archives ------------------------------------------------------------------------------


def opening(dictionary: bytes) -> bytes:
    """The skippable frame that holds the dictionary."""
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def records(stream) -> Iterator[bytes]:
    """The records of an archive, from a file object; each frame is decoded by itself."""
    start = stream.read(8)
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != SKIPPABLE:
        raise Damaged("no dictionary frame")
    size = struct.unpack("<I", start[4:])[0]
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise Damaged("the dictionary is cut off")
    if dictionary[:4] == struct.pack("<I", FRAME):  # it may be compressed itself
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decoder = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    rest = stream.read(READ_BYTES)
    while rest:
        frame, parts = decoder.decompressobj(), []
        if len(rest) >= 4 and rest[:4] != struct.pack("<I", FRAME):
            raise Damaged("not a Zstandard frame")
        while True:
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as err:
                raise Damaged(str(err)) from err
            if frame.eof:
                break
            rest = stream.read(READ_BYTES)
            if not rest:
                raise Damaged("a frame is cut off")
        rest = frame.unused_data
        if len(rest) < 4:
            rest += stream.read(READ_BYTES)
        yield b"".join(parts)


def trained(pages: DataFrame, html: str = "html") -> bytes:
    """A dictionary for the payloads, from the sample named above; none where they are too few to train on."""
    some = pages.where(common.share_of(pages.count(), TRAIN_PAGES, html) & (F.length(html) > 0))
    sample = some.select(F.substring(html, 1, TRAIN_BYTES).alias("t"), F.xxhash64(html).alias("h"))
    texts = [r.t.encode() for r in sample.orderBy("h").limit(TRAIN_PAGES).collect()]
    heads = [record(i, "http://example.org/", t, len(t), digest(t), None, False) for i, t in enumerate(texts)]
    if sum(map(len, heads)) < 10 * DICTIONARY_BYTES or len(heads) < 20:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, heads).as_bytes()


def written(pages: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Writes archives of the rows (page_id, url, html, sha1, payload_bytes, refers_to) below ``folder``; returns path, records, bytes of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)
        path, out, count, size = "", None, 0, 0
        done = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(base, recursive=True)
                    path, count, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(path, compression=None)
                    out.write(opening(dictionary))
                payload = (row["html"] or "").encode()
                sha1 = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                data = record(row["page_id"], row["url"], payload, row["payload_bytes"], sha1, row["refers_to"], row["refers_to"] is not None)
                out.write(encoder.compress(data))
                count, size = count + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return pages.select("page_id", "url", "html", "sha1", "payload_bytes", "refers_to").mapInArrow(run, "path string, records long, bytes long")


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives listed in ``path``, each checked; ``payload`` is null if not asked for."""

    def number(urn: str) -> int | None:
        text = urn.removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = fs.FileSystem.from_uri(folder)[0]
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, held, seen = [], 0, 0
                with system.open_input_stream(path, compression=None) as stream:
                    for data in records(stream):
                        header, http, payload = parsed(data)
                        kind = header["WARC-Type"]
                        refers = number(header["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((number(header["WARC-Record-ID"]), header.get("WARC-Target-URI"), kind, int(http["Content-Length"]), header["WARC-Payload-Digest"].removeprefix("sha1:"), refers, payload if payloads else None))
                        held, seen = held + len(payload) * payloads, seen + 1
                        if held > 16 << 20 or len(rows) == 10_000:
                            yield _batch(rows)
                            rows, held = [], 0
                if seen != expected:
                    raise Damaged(f"{seen} of {expected} records in {path}")
                yield _batch(rows)

    # A given number of partitions: adaptive execution would merge so few paths into one task.
    tasks = max(1, min(archives.count(), MOST_TASKS))
    return archives.select("path", "records").repartition(tasks).mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def archived(pages: DataFrame, html: str = "html", least_bytes: int = 0) -> tuple[DataFrame, str]:
    """Writes a record per row of ``pages`` (page_id, url, html); returns the list of archives and their folder.

    Of rows with equal payloads of at least ``least_bytes`` bytes the largest page_id is
    the response, and rows with smaller ids revisit it; rows that repeat that id are
    responses too. A null payload is an empty one. A row without page_id is always a
    response, and no row refers to it. A null url is written as urn:unknown. No rows give
    no archive. Other columns are not read.
    """
    ws = Workspace(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"))
    rows = rows.withColumns({"sha1": F.sha1(F.col("html").cast("binary")), "payload_bytes": F.octet_length("html").cast("long")})
    same = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1", "payload_bytes").agg(F.max("page_id").alias("last"), F.min("page_id").alias("_least"))
    same = ws.table("same", same.where("_least < last").drop("_least"))  # unequal ids only: what can be revisited
    linked = rows.join(same, ["sha1", "payload_bytes"], "left")
    linked = linked.withColumn("refers_to", F.when(F.col("page_id") < F.col("last"), F.col("last")))
    folder = f"{ws.path}/archives"
    return ws.table("list", written(linked, folder, trained(rows))), folder
