"""WARC records in ZIP-packaged archives: written by tasks, read back by ranges.

An archive is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, a gzip
member per record, and ``indexes/index.tsv``, a line per record with its place.  The reader takes
the ZIP's own directory (ZIP64 too), finds both members and reads records by their ranges; nothing
is unpacked to disk.
"""

from __future__ import annotations

import hashlib
import math
import os
import struct
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_clashing, scratch_path, written

MIN_REVISIT_BYTES = 100
ROLL_BYTES = 64 << 20            # an archive is closed once its records pass this size
BATCH_BYTES = 8 << 20            # payload bytes in a batch of records read back
RECORDS_A_TASK = 4000           # records that a task reads back
ADDED = ("payload_bytes", "payload_digest", "record_type", "refers_to")
DATA, INDEX = "archive/data.warc.gz", "indexes/index.tsv"


# ---- ZIP

def _local(name: bytes, size: int, crc: int) -> bytes:
    """Local header of a stored member; sizes in a ZIP64 field, so any size fits."""
    extra = struct.pack("<HHQQ", 1, 16, size, size)
    return struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra)) + name + extra


def _directory(members: list, at: int) -> bytes:
    """Central directory with ZIP64 fields, its ZIP64 end record and locator, and the end record."""
    out = b""
    for name, size, crc, begin in members:
        extra = struct.pack("<HHQQQ", 1, 24, size, size, begin)
        out += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF,
                           len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, len(members), len(members), len(out), at)
    locator = struct.pack("<IIQI", 0x07064B50, 0, at + len(out), 1)
    end = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return out + end64 + locator + end


def members(read, size: int) -> dict[str, tuple[int, int]]:
    """(first byte, length) of each stored member of a ZIP file; ``read(begin, n)`` returns bytes."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no ZIP end record")
    n, dir_size, dir_at = struct.unpack_from("<H", tail, end + 10)[0], *struct.unpack_from("<II", tail, end + 12)
    if 0xFFFF == n or 0xFFFFFFFF in (dir_size, dir_at):
        back = end - 20
        if back < 0 or tail[back: back + 4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        at64 = struct.unpack_from("<Q", tail, back + 8)[0]
        n, dir_size, dir_at = struct.unpack_from("<QQQ", read(at64, 56), 32)
    directory, at, found = read(dir_at, dir_size), 0, {}
    for _ in range(n):
        if directory[at: at + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
        begin, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46: at + 46 + n_name].decode("utf-8")
        extra = directory[at + 46 + n_name: at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_note
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:                      # holds only the values that do not fit above, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                begin = next(wide) if begin == 0xFFFFFFFF else begin
            extra = extra[4 + width:]
        if method == 0:
            n_name, n_extra = struct.unpack_from("<HH", read(begin, 30), 26)
            found[name] = (begin + 30 + n_name + n_extra, packed)
    return found


# ---- files: any store that Arrow knows by its URI; a plain path is a shared mount

def _store(uri: str):
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


# ---- records

def _field(value: str) -> str:
    """A header value in one line: control characters, which no address may hold, are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record(kind: str, uri: str | None, payload: bytes, digest: str, page_id, refers_to) -> bytes:
    """A WARC/1.1 record; a revisit carries the digest and size of its payload, but not the payload.

    A null address has no header field and reads back as null."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if kind == "revisit" else http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            *([] if uri is None else [("WARC-Target-URI", _field(uri))]), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict, bytes]:
    """Header fields and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


class _Archive:
    """An archive being filled; its packed records (ROLL_BYTES and one record at most) stay in
    memory until their size and checksum are known, then the file is written in one stream."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        self.body, self.index, self.crc, self.n, self.at = [], [], 0, 0, 0

    def add(self, raw: bytes):
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        z = packer.compress(raw) + packer.flush()
        self.index.append(f"{self.at}\t{len(z)}\n")
        self.body.append(z)
        self.crc = zlib.crc32(z, self.crc)
        self.at += len(z)
        self.n += 1

    def close(self):
        index = "".join(self.index).encode()
        first = _local(DATA.encode(), self.at, self.crc)
        second_at = len(first) + self.at
        second = _local(INDEX.encode(), len(index), zlib.crc32(index))
        directory = _directory([(DATA.encode(), self.at, self.crc, 0), (INDEX.encode(), len(index), zlib.crc32(index), second_at)],
                               second_at + len(second) + len(index))
        fs, path = _store(self.uri)
        fs.create_dir(os.path.dirname(path), recursive=True)
        with fs.open_output_stream(path) as f:
            for part in (first, *self.body, second, index, directory):
                f.write(part)
        return self.uri, self.n


def _write(folder: str):
    def run(batches):
        archive = _Archive(folder)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = batch.slice(lo, 64).to_pylist()
                for r in rows:
                    payload = (r["html"] or "").encode("utf-8")
                    archive.add(record(r["record_type"], r["url"], payload, r["payload_digest"], r["page_id"], r["refers_to"]))
                    if archive.at > ROLL_BYTES:
                        yield _listed([archive.close()])
                        archive = _Archive(folder)
        if archive.n:
            yield _listed([archive.close()])
    return run


def _listed(found):
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found]), pa.array([x[1] for x in found], pa.int64())], names=["archive", "records"])


def with_roles(pages: DataFrame) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to.

    Only digests that occur twice or more (payloads of at least MIN_REVISIT_BYTES) are joined
    back; sizes and digests are taken where the page is read.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    p = drop_clashing(pages, *ADDED).withColumns({"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": F.sha2(body, 256)})
    large = p.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
    first = (large.groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
             .where("_n > 1 and _first is not null").drop("_n"))
    p = p.join(written(first, "warc-first"), "payload_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (p.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_first"))


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the written list of
    archives (archive, records).

    Of records with equal payloads of at least MIN_REVISIT_BYTES, that with the smallest page_id
    is the response and the others are revisits that refer to it.  Null html is an empty payload.
    A null page_id is a revisit if a page with an id has its payload.  Rows that share the smallest
    page_id are all responses.  An empty table writes nothing.  Other columns are not stored.

    Every attempt of a task writes files of its own, and only the list, committed by Spark, says
    which count: a lost executor leaves files that nothing reads.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = with_roles(pages.select("page_id", "url", "html")).select("page_id", "url", "html", "payload_digest", "record_type", "refers_to")
    return written(rows.mapInArrow(_write(folder), "archive string, records long"), "warc-list")


_PLACES = "archive string, first long, places array<long>"


def _locate(batches):
    """Record ranges from each archive's directory and index, in blocks of bounded size."""
    for batch in batches:
        for uri in batch.column("archive").to_pylist():
            fs, path = _store(uri)
            with fs.open_input_file(path) as f:
                read = lambda at, n: f.read_at(n, at)
                found = members(read, f.size())
                data_at, _ = found[DATA]
                at, left = found[INDEX]
                rest, block = b"", []
                while left or rest:
                    part = read(at, min(left, 1 << 20))
                    at, left = at + len(part), left - len(part)
                    lines, _, rest = (rest + part).rpartition(b"\n")
                    for line in lines.split(b"\n"):
                        begin, size = map(int, line.split(b"\t"))
                        block += [data_at + begin, size]
                        if len(block) >= 2000:
                            yield _block(uri, block)
                            block = []
                if block:
                    yield _block(uri, block)


def _block(uri, block):
    return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([block[0]], pa.int64()), pa.array([block], pa.list_(pa.int64()))],
                                      names=["archive", "first", "places"])


_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _read(with_payload: bool):
    def page(urn):
        x = urn[len("<urn:page:"):-1]
        return int(x) if x else None

    def run(batches):
        for batch in batches:
            for uri, places in zip(batch.column("archive").to_pylist(), batch.column("places").to_pylist()):
                fs, path = _store(uri)
                rows, size = [], 0
                with fs.open_input_file(path) as f:
                    for at, n in zip(places[::2], places[1::2]):
                        fields, payload = parse(zlib.decompress(f.read_at(n, at), 31))
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].partition(":")[2]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} in {uri} does not have its digest")
                        refers = fields.get("WARC-Refers-To")
                        rows.append((page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, page(refers) if refers else None,
                                     len(payload) if kind == "response" else int(fields["X-Payload-Length"]), digest,
                                     payload if with_payload and kind == "response" else None))
                        size += len(payload)
                        if size > BATCH_BYTES:
                            yield _records(rows)
                            rows, size = [], 0
                if rows:
                    yield _records(rows)
    return run


def _records(rows):
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``archives`` (archive): page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for revisits).

    One stage reads directories and indexes and hands out blocks of 1,000 ranges; after a shuffle
    of those, a second reads the ranges, so one large archive is read by many tasks.  With the
    column records, the number of tasks follows the number of records; the blocks themselves are
    too small for Spark to tell.  A response's digest is checked against its payload.
    """
    places = archives.select("archive").mapInArrow(_locate, _PLACES)
    if "records" in archives.columns:
        records = archives.agg(F.sum("records")).first()[0] or 0
        places = places.repartition(max(1, math.ceil(records / RECORDS_A_TASK)), "archive", "first")
    else:
        places = places.repartition("archive", "first")
    return places.mapInArrow(_read(with_payload), _RECORD)


def op6_warc_zip_archives(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    back = read_archives(write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
