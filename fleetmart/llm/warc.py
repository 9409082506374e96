"""WARC records in ZIP-packaged archives: deduplicating writer, range-reading reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import struct
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm.common import map_batches, possible, stored
from fleetmart.operators.scale import scratch_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode("ascii")


# Records.


def record(
    page_id: int | None, url: str, payload: bytes | None, size: int, digest: str, refers_to: int | None
) -> bytes:
    """One gzip member: a response with its payload, or without one a revisit, headers alone."""
    kind = "revisit" if payload is None else "response"
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode("ascii")
    block = http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    raw = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0)


def parse_record(member: bytes) -> dict:
    """Headers of a record's gzip member, and its block."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(
        line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if ": " in line
    )
    return {"headers": fields, "block": rest[: int(fields["Content-Length"])]}


# The ZIP package: a directory at its end, stored members that can be read by range.


def _at_end(source, size: int) -> tuple[int, int, int]:
    """Entries, size and offset of the central directory, from the end records."""
    tail_at = max(0, size - (22 + 65535 + 20))
    tail = source.read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no ZIP directory")
    entries, length, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = tail.rfind(b"PK\x06\x07", 0, at)
        if locator >= 0:
            record_at = struct.unpack("<Q", tail[locator + 8 : locator + 16])[0]
            whole = source.read_at(56, record_at)
            if whole[:4] != b"PK\x06\x06":
                raise ValueError("bad ZIP64 directory record")
            entries, length, offset = struct.unpack("<QQQ", whole[32:56])
    return entries, length, offset


def members(source, size: int) -> dict[str, tuple[int, int]]:
    """Name to (offset, length) of the data of each stored member, ZIP64 fields included."""
    entries, length, offset = _at_end(source, size)
    directory, at, found = source.read_at(length, offset), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("bad ZIP directory entry")
        method = struct.unpack("<H", directory[at + 10 : at + 12])[0]
        packed, plain = struct.unpack("<II", directory[at + 20 : at + 28])
        name_n, extra_n, note_n = struct.unpack("<HHH", directory[at + 28 : at + 34])
        header = struct.unpack("<I", directory[at + 42 : at + 46])[0]
        name = directory[at + 46 : at + 46 + name_n].decode("utf-8")
        extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # the wide fields, in this order, each only if its narrow one is full
                wide = io.BytesIO(extra[4 : 4 + n])
                if plain == 0xFFFFFFFF:
                    plain = struct.unpack("<Q", wide.read(8))[0]
                if packed == 0xFFFFFFFF:
                    packed = struct.unpack("<Q", wide.read(8))[0]
                if header == 0xFFFFFFFF:
                    header = struct.unpack("<Q", wide.read(8))[0]
            extra = extra[4 + n :]
        if method == 0:
            local = source.read_at(30, header)
            local_name, local_extra = struct.unpack("<HH", local[26:30])
            found[name] = (header + 30 + local_name + local_extra, packed)
        at += 46 + name_n + extra_n + note_n
    return found


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; file:/a, file:///a and /a are the same."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


class _Archive:
    """One package being written: records stream into its archive member."""

    def __init__(self, folder: str, zip64: bool):
        self.system, base = _folder(folder)
        self.system.create_dir(base, recursive=True)
        self.path = f"{base}/{uuid.uuid4().hex}.wacz"
        self.sink = self.system.open_output_stream(self.path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=zip64)
        self.size, self.rows = 0, []

    def add(self, member: bytes) -> None:
        self.member.write(member)
        self.rows.append(f"{self.size} {len(member)}")
        self.size += len(member)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.rows))
        self.zip.close()
        self.sink.close()
        return self.path, self.system.get_file_info(self.path).size, len(self.rows)


def write_archives(
    pages: DataFrame, folder: str, *, min_bytes: int = 0, archive_bytes: int = 32 << 20
) -> DataFrame:
    """Write a WARC record per row (page_id, url, html); returns (path, bytes, records).

    Of records with equal payloads of at least ``min_bytes`` bytes, that with the smallest
    page_id is a response and the others are revisits of it; smaller ones are all
    responses. Null html is an empty payload, a null url an empty one. Rows with a null
    page_id refer to the smallest id of their payload, and are responses where it has
    none; rows that repeat page_id and payload are all of the same kind.

    Payload digests meet in a group without the payloads, of which a map-side minimum is
    kept, so a payload that a third of all pages share costs a row per task. Revisits are
    written from the digests. Responses are written where their pages are read: all pages
    whose id is surely no revisit's by a bitmap, and those that it lets through wrongly, whose
    payloads alone are shuffled. Packages hold about ``archive_bytes``, are written under
    names of their own, and count only if their task succeeded: the returned rows are
    stored before anything reads them, and a file that a lost task left is never read.
    """
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.encode("html", "utf-8")))
    named = stored(
        plain.select("page_id", "url", "sha1", F.octet_length("html").cast("long").alias("size")), "digests"
    )
    firsts = named.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    # Only payloads that occur again need looking up.
    again = firsts.where("n > 1 and first_id is not null").select("sha1", "first_id")
    repeats = stored(
        named.where(F.col("size") >= min_bytes)
        .join(again, "sha1")
        .where("page_id is null or page_id <> first_id"),
        "revisits",
    )
    pair = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha1") == F.col("_sha1"))

    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"))

    ids = repeats.select("page_id")
    wrong = stored(
        possible(named, "page_id", ids).join(pairs(repeats), pair, "left_anti").select("page_id", "sha1"),
        "let-through",
    )
    sure = possible(plain, "page_id", ids, inverse=True)
    rest = possible(plain, "page_id", wrong.select("page_id")).join(pairs(wrong), pair, "left_semi")
    responses = sure.unionByName(rest).select(
        "page_id", "url", "html", F.octet_length("html").cast("long").alias("size"), "sha1",
        F.lit(None).cast("long").alias("first_id"),
    )
    rows = responses.unionByName(
        repeats.select("page_id", "url", F.lit(None).cast("string").alias("html"), "size", "sha1", "first_id")
    )

    def write(batches):
        out, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = _Archive(folder, zip64=True)
                url = " ".join(row["url"].split())
                out.add(
                    record(
                        row["page_id"], url,
                        None if row["html"] is None else row["html"].encode("utf-8"),
                        row["size"], payload_digest(row["sha1"]), row["first_id"],
                    )
                )
                if out.size >= archive_bytes:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], type=t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["path", "bytes", "records"],
        )

    return stored(map_batches(rows, write, "path string, bytes long, records long"), "archives")


def _runs(source, start: int, index: str, run_bytes: int):
    """The records named by the lines of an index, read in runs."""
    spans = [tuple(map(int, line.split())) for line in index.split("\n")]
    k = 0
    while k < len(spans):
        first, stop = spans[k][0], k + 1
        while stop < len(spans) and sum(spans[stop]) - first <= run_bytes:
            stop += 1
        data = source.read_at(sum(spans[stop - 1]) - first, start + first)
        yield from (data[at - first : at - first + size] for at, size in spans[k:stop])
        k = stop


def read_archives(archives: DataFrame, folder: str, *, run_bytes: int = 1 << 20) -> DataFrame:
    """One row per record of the packages in ``archives`` (path, bytes), read by range.

    Each package's end records and central directory (ZIP64 ones too) give the places of
    the stored archive and its index; each index line the range of one record. Records that
    lie side by side are read in runs of about ``run_bytes``. Nothing is extracted. Returns page_id, url, payload_bytes and payload_digest (both of the full
    payload), record_type, refers_to, and payload (null for revisits). A response whose
    payload contradicts its digest raises an error.
    """
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, _ = _folder(folder)
                with system.open_input_file(row["path"]) as source:
                    found = members(source, row["bytes"])
                    start, _ = found[ARCHIVE]
                    at, length = found[INDEX]
                    index = source.read_at(length, at).decode("ascii")
                    out, held = [], 0
                    for raw in _runs(source, start, index, run_bytes):
                        got = parse_record(raw)
                        fields = got["headers"]
                        head, _, body = got["block"].partition(b"\r\n\r\n")
                        http = dict(
                            x.split(": ", 1) for x in head.decode("ascii").split("\r\n")[1:]
                        )
                        number = lambda x: int(y) if (y := x.removeprefix("<urn:page:")[:-1]) else None
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind = fields["WARC-Type"]
                        if kind == "response" and digest != payload_digest(hashlib.sha1(body).hexdigest()):
                            raise ValueError(f"payload differs from its digest in {row['path']}")
                        refers = fields.get("WARC-Refers-To")
                        out.append(
                            (
                                number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI", ""),
                                int(http["Content-Length"]), digest, kind,
                                number(refers) if refers else None,
                                body if kind == "response" else None,
                            )
                        )
                        held += len(body)
                        if len(out) == 256 or held >= run_bytes:
                            yield _rows(out)
                            out, held = [], 0
                    if out:
                        yield _rows(out)

    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def _rows(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)], names=names
        )

    # A package is one row; rows are spread over the tasks by their path.
    spark = archives.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return map_batches(
        archives.select("path", "bytes").repartition(parts, "path"),
        read,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long, payload binary",
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for packages below spark.checkpoint.dir."""
    return f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
