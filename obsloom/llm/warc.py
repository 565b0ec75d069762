"""WARC archives: written from pages, normalised to one gzip member per record with an index, and read back.

Archives are written by Spark's text writer, a row per record and the record's end as the line separator, each file as
one gzip stream from its first record to its last. Such a file can only be read from the start. ``normalise``
inflates every file once, as the stream of lines that Spark's text reader makes of it in any store, cuts it at
the records' own lengths, and writes every record again as a gzip member of its own. Where each member starts
and how long it is goes to a Parquet table beside the archives, so that ``read_records`` gets any records,
all of them in parallel, without inflating others.

A task writes archives under a new name; they count once the index names them, and Spark commits the index
with the task. What a lost task has written is never read.

Payloads that many pages share are stored once: the page with the largest id is the response, the others
revisit it. Digests with more than a thousandth of the pages (at most a thousand) are looked up by broadcast, so
that their pages do not meet in one task.

Defined results: a null payload is empty; a null URL is written without target. White space, control characters and ``<>``
in a URL are percent-encoded where they would end the header line. A page without an id is a response of its own,
and no page revisits it. All rows that repeat the largest id of a payload are responses. Payloads under ``least_bytes`` are
all responses. A record that is cut off, or has no length, stops the run with the file's name, as does a payload that
does not have the digest that its record states. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsloom.llm.common import mapped, stored
from obsloom.registered.common import scratch

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

INDEX = "archive string, offset long, length long, record_type string, record_id string, target_uri string, payload_digest string"
RECORD = "record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string"


# Writing.


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base32: each five hexadecimal digits are four of base 32."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*digits)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def header_safe(url: Column) -> Column:
    """A URL that stays on its line."""
    safe = url
    for character in [*map(chr, range(0x21)), "<", ">", "\x7f"]:
        safe = F.replace(safe, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return F.when(url.rlike(r"[\x00-\x20<>\x7f]"), safe).otherwise(url)


def with_heads(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (``id``, ``html``) with ``bytes``, ``digest`` and ``head``: the page that it revisits, or null."""
    pages = pages.withColumn("digest", sha1_base32(F.col("html"))).withColumn("bytes", F.octet_length("html").cast("long"))
    heads = pages.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("id").alias("head"), F.count("*").alias("n"))
    heads = stored(heads.where("n > 1 and head is not null"))
    thousandth = pages.count() / 1000
    hot = heads.where(F.col("n") > thousandth).select(F.col("digest").alias("__hot"), F.col("head").alias("__hot_head"))
    rest = heads.where(F.col("n") <= thousandth).select(F.col("digest").alias("__rest"), F.col("head").alias("__rest_head"))
    rows = pages.join(F.broadcast(hot), F.col("digest") == F.col("__hot"), "left")
    # Pages that are done spread over all tasks.
    key = F.when(F.col("__hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id()))
    rows = rows.withColumn("__key", key).join(rest, F.col("__key") == F.col("__rest"), "left")
    head = F.coalesce("__hot_head", "__rest_head")
    return rows.select(*pages.columns, F.when(head != F.col("id"), head).alias("head"))


def records(pages: DataFrame, date: str) -> DataFrame:
    """Column ``value``: the WARC record of every page (``id``, ``url``, ``html``, ``bytes``, ``digest``, ``head``), but for its end."""
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    again = F.col("head").isNotNull()
    length = F.octet_length("http") + F.when(again, F.lit(0)).otherwise(F.col("bytes"))
    lines = [
        F.concat(F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), named("id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), header_safe(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), named("head"), F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}"))),
        F.concat(F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "), length.cast("string")),
    ]
    # concat_ws leaves out what is null.
    value = F.concat(F.concat_ws("\r\n", *lines), F.lit(END), F.col("http"), F.when(again, "").otherwise(F.col("html")))
    return pages.withColumn("http", http).select(value.alias("value"))


def write_archives(values: DataFrame, folder: str) -> None:
    """Files with one gzip stream each."""
    values.write.mode("error").option("compression", "gzip").option("lineSep", END).text(folder)


# Normalising.


def file_system(uri: str):
    """The file system of a URI as Hadoop names it, and the path there."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme == "file":
        uri = "file:///" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Cutter:
    """Cuts a stream, given in pieces, at its records; holds one record and one piece."""

    def __init__(self, name: str) -> None:
        self.name, self.held, self.need, self.body = name, bytearray(), 0, 0

    def feed(self, data: bytes):
        """Records that end in what has come so far, as (header, block) without the end."""
        self.held += data
        at = 0
        while True:
            if not self.need:
                end = self.held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self.body = end + 4 - at
                self.need = self.body + self.length(bytes(self.held[at:end])) + 4
            if len(self.held) - at < self.need:
                break
            record = bytes(self.held[at : at + self.need - 4])
            if self.held[at + self.need - 4 : at + self.need] != b"\r\n\r\n":
                raise ValueError(f"{self.name}: a record does not end where its length says")
            yield record[: self.body - 4], record[self.body :]
            at, self.need = at + self.need, 0
        del self.held[:at]

    def length(self, header: bytes) -> int:
        if not header.startswith(b"WARC/"):
            raise ValueError(f"{self.name}: no record starts with {header[:40]!r}")
        value = fields(header).get("content-length", "")
        if not value.isdigit():
            raise ValueError(f"{self.name}: a record without a length")
        return int(value)

    def close(self) -> None:
        if self.held.strip(b"\r\n"):
            raise ValueError(f"{self.name}: ends within a record")


def fields(header: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    pairs = (line.partition(":") for line in header.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def member(record: bytes, level: int) -> bytes:
    """A record as a gzip member; equal records give equal bytes."""
    packed = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packed.compress(record) + packed.flush()


class Archive:
    """An archive being written, with one member per record after a first one that describes it."""

    def __init__(self, system, folder: str, level: int) -> None:
        self.name, self.level, self.at = f"{uuid.uuid4().hex}.warc.gz", level, 0
        self.out = system.open_output_stream(f"{folder}/{self.name}", compression=None)
        about = f"software: obsloom\r\nformat: {VERSION}\r\n"
        self.add(
            f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{self.name}>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(about)}".encode(),
            about.encode(),
        )

    def add(self, header: bytes, block: bytes) -> tuple[int, int]:
        """Offset and length of the new member."""
        packed = member(header + b"\r\n\r\n" + block + b"\r\n\r\n", self.level)
        self.out.write(packed)
        self.at += len(packed)
        return self.at - len(packed), len(packed)


def by_file(batches):
    """(file, bytes) of every run of lines of one file, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("file").dictionary_encode()
        codes = names.indices.to_numpy()
        cuts = [0, *([i + 1 for i in (codes[1:] != codes[:-1]).nonzero()[0]]), len(codes)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield names.dictionary[int(codes[a])].as_py(), b"\n".join(batch.column("line").slice(a, b - a).to_pylist()) + b"\n"


def normalise(spark: SparkSession, source: str, folder: str, level: int = 6, roll_bytes: int = 1 << 30, rows: int = 4096) -> DataFrame:
    """Rewrite the gzipped archives of ``source`` into ``folder``; the index of their records, read from ``<folder>/index``.

    Takes files of one gzip stream and of many members alike. A file is read by one task, in bounded memory. A new archive
    starts with every file, and after ``roll_bytes``.
    """
    lines = spark.read.option("lineSep", "\n").text(source).select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"))

    def run(batches):
        system, place = file_system(f"{folder}/archives")
        system.create_dir(place, recursive=True)
        cutter = archive = None
        found: list[tuple] = []

        def index():
            columns = list(zip(*found, strict=True)) or [[]] * 7
            found.clear()
            types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["archive", "offset", "length", "record_type", "record_id", "target_uri", "payload_digest"],
            )

        def ended():
            if cutter is not None:
                cutter.close()
            if archive is not None:
                archive.out.close()

        for name, data in by_file(batches):
            if cutter is None or cutter.name != name:
                ended()
                cutter, archive = Cutter(name), None
            for header, block in cutter.feed(data):
                if archive is not None and archive.at >= roll_bytes:
                    archive.out.close()
                    archive = None
                if archive is None:
                    archive = Archive(system, place, level)
                of = fields(header)
                at, n = archive.add(header, block)
                digest = of.get("warc-payload-digest")
                found.append((archive.name, at, n, of.get("warc-type"), of.get("warc-record-id"), of.get("warc-target-uri"), digest))
                if len(found) >= rows:
                    yield index()
        ended()
        yield index()

    return stored(mapped(lines, run, INDEX), folder=f"{folder}/index")


# Reading.


def payload_of(block: bytes, content_type: str) -> tuple[bytes, int]:
    """The payload, and how long it is in full: a revisit has only the head of its answer, with the length."""
    if not content_type.startswith("application/http"):
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    stated = fields(head).get("content-length", "")
    return body, int(stated) if stated.isdigit() else len(body)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Members:
    """Reads members of archives at given places, some megabytes at a time where they follow each other."""

    def __init__(self, folder: str, ahead: int = 4 << 20) -> None:
        self.system, self.place = file_system(f"{folder}/archives")
        self.ahead, self.name, self.file, self.start, self.data = ahead, None, None, 0, b""

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.file, self.name, self.start, self.data = self.system.open_input_file(f"{self.place}/{name}"), name, 0, b""
        at = offset - self.start
        if at < 0 or at + length > len(self.data):
            size = min(max(length, self.ahead), self.file.size() - offset)
            self.start, self.data, at = offset, self.file.read_at(size, offset), 0
        return zlib.decompress(self.data[at : at + length], 31)


def read_records(index: DataFrame, folder: str, payloads: bool = True, piece_bytes: int = 8 << 20) -> DataFrame:
    """The records that ``index`` names (all of it or any rows): ``RECORD``, and their ``payload`` if asked for.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for revisits as well. The stored payloads are
    compared with their digests.
    """

    def run(batches):
        members = Members(folder)
        names = [f.split()[0] for f in RECORD.split(", ")]
        types = [pa.string()] * 4 + [pa.int64(), pa.string()]

        def made(rows, bodies):
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            if payloads:
                arrays.append(pa.array(bodies, pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=[*names, *(["payload"] if payloads else [])])

        for batch in batches:
            rows, bodies, size = [], [], 0
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                header, _, block = members.read(name, offset, length).partition(b"\r\n\r\n")
                of = fields(header)
                payload, full = payload_of(block[:-4], of.get("content-type", ""))
                digest = of.get("warc-payload-digest")
                if of.get("warc-type") == "revisit":
                    payload, digest = b"", digest and digest.removeprefix("sha1:")
                else:
                    actual = digest_of(payload)
                    if digest and digest.startswith("sha1:") and digest != f"sha1:{actual}":
                        raise ValueError(f"{name} at {offset}: the payload is not the one of {digest}")
                    digest, full = actual, len(payload)
                rows.append((of.get("warc-type"), of.get("warc-record-id"), of.get("warc-target-uri"), of.get("warc-refers-to"), full, digest))
                bodies.append(payload if payloads else b"")
                size += len(payload)
                if size >= piece_bytes:
                    yield made(rows, bodies)
                    rows, bodies, size = [], [], 0
            yield made(rows, bodies)

    return mapped(index.select("archive", "offset", "length"), run, RECORD + (", payload binary" if payloads else ""))


def archive_pages(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least_bytes: int = 0,
    folder: str | None = None,
) -> tuple[DataFrame, str]:
    """Write ``pages`` as archives and normalise them: the index, and the folder that it belongs to."""
    spark = pages.sparkSession
    folder = folder or scratch(spark)
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    write_archives(records(with_heads(rows, least_bytes), date), f"{folder}/streams")
    return normalise(spark, f"{folder}/streams", folder), folder


def page_ids(records: DataFrame, page_id: str = "page_id", kind: str = "long") -> DataFrame:
    """Records of ``archive_pages`` with the page's id in place of their own, and likewise ``refers_to``."""
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)
    rest = [c for c in records.columns if c not in ("record_id", "refers_to")]
    return records.select(number("record_id").alias(page_id), *rest, number("refers_to").alias("refers_to"))
