"""WARC archives as a Spark data source, written and read by tasks.

``register(spark)`` adds the format ``warc``. Writing makes one gzip file per task, each record a gzip
member of its own that states its length in an extra field, so a reader can step over it. Files get their
final names when the job commits; what failed tasks left is removed.

Reading plans one partition per file. In every record the headers are decoded first. Equality and IN
predicates on ``record_type``, ``record_id``, ``target_uri``, ``payload_digest`` and ``refers_to`` are
pushed down to the headers, and the payload of a record that they reject is never decoded; with the
option ``payload=false`` no payload is. Foreign members without the length field and plain ``.warc`` files
are read too (the former must be inflated to find their end, but are not kept).
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage

from .store import new_path, small_batches, table, written

SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, payload_length long, payload_ok boolean, payload binary, file string, offset long"
PUSHED = ("record_type", "record_id", "target_uri", "payload_digest", "refers_to")
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "date": "warc-date"}
BATCH_BYTES = 4 << 20


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else fs.FileSystem.from_uri("/" + path)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def record(row) -> bytes:
    """The bytes of one record (not compressed). A revisit's block has the HTTP headers only."""
    payload = bytes(row["payload"] or b"")
    length = len(payload) if row["payload_length"] is None else row["payload_length"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + (payload if row["record_type"] == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_clean(row['record_id'])}>", f"WARC-Date: {row['date']}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    lines.append(f"WARC-Payload-Digest: sha1:{row['payload_digest'] or sha1_base32(payload)}")
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <{_clean(row['refers_to'])}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that states its own and its inflated length in the extra field ``sl``."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    total = 10 + 2 + 12 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _headers(text: bytes) -> dict[str, str]:
    found = {}
    for line in text.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


class _Members:
    """Records of a gzip file: offset, a way to get the first bytes, and one to get all."""

    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size

    def __iter__(self):
        at = 0
        while at + 18 <= self.size:
            self.stream.seek(at)
            head = self.stream.read(24)
            if head[:2] != b"\x1f\x8b":
                raise ValueError(f"no gzip member at {at}")
            if head[3] == 4 and head[12:14] == b"sl":
                total = struct.unpack("<I", head[16:20])[0]
                body = self.stream.read(min(4096, total - 24))
                unpack = zlib.decompressobj(-15)
                first = unpack.decompress(body, 16384)

                def rest(unpack=unpack, total=total, read=len(body)):
                    tail = unpack.decompress(unpack.unconsumed_tail) if unpack.unconsumed_tail else b""
                    return tail + unpack.decompress(self.stream.read(max(0, total - 24 - read - 8))) + unpack.flush()

                yield at, first, rest
                at += total
            else:
                self.stream.seek(at)
                unpack, parts, used = zlib.decompressobj(31), [], 0
                while not unpack.eof and (chunk := self.stream.read(1 << 16)):
                    parts.append(unpack.decompress(chunk))
                    used += len(chunk)
                whole = b"".join(parts)
                yield at, whole, lambda: b""
                at += used - len(unpack.unused_data)


class _Plain:
    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size

    def __iter__(self):
        at = 0
        while at < self.size:
            self.stream.seek(at)
            first = b""
            while b"\r\n\r\n" not in first and (chunk := self.stream.read(4096)):
                first += chunk
            end = first.find(b"\r\n\r\n")
            if end < 0:
                return
            total = end + 4 + int(_headers(first[:end]).get("content-length", 0)) + 4
            yield at, first[:total], lambda n=total - len(first): self.stream.read(max(0, n))
            at += total


@dataclass
class _File(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in PUSHED:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, path = _open(self.path)
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        found = system.get_file_info(path)
        files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        return [_File(scheme + f.path) for f in sorted(files, key=lambda f: f.path) if f.is_file and f.path.endswith((".warc", ".warc.gz")) and not f.base_name.startswith(("_", "."))] or [_File("")]

    def _row(self, path: str, at: int, first: bytes, rest):
        end = first.find(b"\r\n\r\n")
        if end < 0:
            first, rest = first + rest(), lambda: b""
            end = first.find(b"\r\n\r\n")
        head = _headers(first[:end])
        own = {k: head.get(h) for k, h in HEADERS.items()}
        for k in ("record_id", "refers_to"):
            own[k] = own[k].strip("<>") if own[k] else own[k]
        own["payload_digest"] = own["payload_digest"].partition(":")[2] if own["payload_digest"] else None
        if any(own[k] not in values for k, values in self.wanted.items()):
            return None
        length, http = int(head.get("content-length", 0)), head.get("content-type", "").startswith("application/http")
        block, payload, ok = first[end + 4 :], None, None
        split = block.find(b"\r\n\r\n") if http else -4
        if self.payload and own["record_type"] != "revisit" or http and split < 0:
            block = (block + rest())[:length]
            split = block.find(b"\r\n\r\n") if http else -4
        size = int(_headers(block[:split]).get("content-length", max(0, length - split - 4))) if http else length
        if self.payload and own["record_type"] != "revisit":
            payload = block[split + 4 :]
            ok = own["payload_digest"] is None or sha1_base32(payload) == own["payload_digest"]
        return (*(own[k] for k in ("record_id", "record_type", "target_uri", "date", "payload_digest", "refers_to")), size, ok, payload, posixpath.basename(path), at)

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}.get(c.split()[1], pa.string())) for n, c in zip(names, SCHEMA.split(", "), strict=True)])
        if not partition.path:
            return
        system, path = _open(partition.path)
        rows, size = [], 0
        with system.open_input_file(path) as stream:
            records = _Members if path.endswith(".gz") else _Plain
            for at, first, rest in records(stream, stream.size()):
                row = self._row(path, at, first, rest)
                if row is not None:
                    rows.append(row)
                    size += 500 + len(row[8] or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)


@dataclass
class _Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceWriter):
    """Rows need record_id, record_type, target_uri, date, payload_digest, refers_to, payload_length and payload.

    Tasks write hidden files of this job; its end names those of the tasks that counted, and deletes all others.
    """

    def __init__(self, options):
        self.path, self.job = options["path"], uuid.uuid4().hex

    def write(self, iterator) -> WriterCommitMessage:
        system, folder = _open(self.path)
        system.create_dir(folder, recursive=True)
        name, n = f"{self.job}-{uuid.uuid4().hex}.warc.gz", 0
        stream = system.open_output_stream(f"{folder}/_{name}", compression=None, buffer_size=1 << 20)
        with stream:
            for row in iterator:
                stream.write(member(record(row)))
                n += 1
        return _Written(name if n else "")

    def _clear(self) -> None:
        from pyarrow import fs

        system, folder = _open(self.path)
        for file in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if file.base_name.startswith(f"_{self.job}-"):
                system.delete_file(file.path)

    def commit(self, messages) -> None:
        system, folder = _open(self.path)
        for m in messages:
            if m is not None and m.name:
                system.move(f"{folder}/_{m.name}", f"{folder}/{m.name}")
        self._clear()

    def abort(self, messages) -> None:
        self._clear()


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records of pages: of equal payloads of at least ``least_bytes`` the one with the largest id is the
    response, the others revisit it. A null html is an empty payload; a null url has no target; a page with
    a null id revisits its response but is never revisited. Equal rows are records of their own. No rows give
    no records. Ids are whole numbers, or texts of them; any other id is an error under ANSI mode. Other columns are ignored.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("target_uri"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("payload_length", F.length("payload").cast("long"))
    owners = rows.filter(F.col("payload_length") >= least_bytes).groupBy("sha").agg(F.max("id").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1 and owner is not null").select("sha", "owner")
    rows = rows.join(written(owners, "owners"), "sha", "left")
    again = F.coalesce(F.col("owner") != F.col("id"), F.col("owner").isNotNull())
    named = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    return rows.select(
        named(F.coalesce(F.col("id").cast("string"), F.lit("null"))).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit(date).alias("date"), "sha", F.when(again, named(F.col("owner"))).alias("refers_to"), "payload_length", F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, **options) -> None:
    """Write one record per page under ``path``."""
    import pandas as pd

    small_batches(pages.sparkSession)
    register(pages.sparkSession)
    base32 = F.pandas_udf(lambda s: pd.Series([base64.b32encode(bytes.fromhex(x)).decode() for x in s], dtype=object), "string")
    page_records(pages, **options).withColumn("payload_digest", base32("sha")).drop("sha").write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back; the payloads of responses are checked against their digests."""
    path = new_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    rows = read_warc(spark, path)
    size = F.coalesce(F.length("payload").cast("long"), "payload_length")
    return rows.select(number("record_id").alias("page_id"), size.alias("payload_bytes"), "payload_digest", "record_type", number(F.col("refers_to")).alias("refers_to"), "payload_ok")


ORACLE_OP8 = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as sha from pages),
b as (select sha, (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + bits[5 * i + 1:5 * i + 5]::bit::int, 1), '' order by i) from range(32) t(i)) as b32
  from (select sha, from_hex(sha)::bit::varchar as bits from p group by sha)),
g as (select sha, max(page_id) as owner from p group by sha)
select page_id, strlen(html)::bigint as payload_bytes, b32 as payload_digest, case when page_id = owner then 'response' else 'revisit' end as record_type,
  case when page_id <> owner then owner end as refers_to, case when page_id = owner then true end as payload_ok
from p join g using (sha) join b using (sha)
"""
