r"""WARC archives as a PySpark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: one gzip member per record, one archive per task, moved to its final
name when the whole write commits. Rows need the columns of ``SCHEMA``; the
writer fills the digest and length headers from the payload (or, for a revisit,
takes them from the row).

Reading: the driver lists the archives and packs them into partitions by size.
Predicates on ``record_type`` and on the header columns are pushed down: each
record's headers are parsed first, and the payload of a record that they rule
out is passed over without being decoded or kept.

A revisit record stands for a payload that another record holds. It keeps the
HTTP header of the original, whose Content-Length is the full payload's size.

Files are reached through ``pyarrow.fs``, by URI.

Defined cases: a null payload is empty; a null id is written as an empty
record id and read back as null; empty tables give a folder without archives
and read back as no rows; a payload may hold any bytes; ids and addresses with line
breaks or other control characters, or with blanks or angle brackets at an end,
are written percent-encoded under a header that says so, and read back as they
were.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary")
HEADERS = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest")
PARTITION_BYTES = 64 << 20
CHUNK = 1 << 20
ID_PREFIX = "urn:record:"
DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date, so that reruns agree


def filesystem(path: str):
    """The file system and the path in it; a bare path is a local one."""
    if re.match(r"file:/", path):
        path = "file://" + re.sub(r"^file:/+", "/", path)
    elif "://" not in path:
        path = "file://" + os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest_of(sha: str) -> str:
    """A SHA-1 in base32; one in hex is turned into it."""
    return base64.b32encode(bytes.fromhex(sha)).decode() if len(sha) == 40 else sha


ENCODED = "X-Percent-Encoded"  # header: names of the headers whose values are percent-encoded
_AWKWARD = re.compile(r"[\x00-\x1f\x7f]|^[\s<]|[\s>]$")


def _header_values(row: dict, names: dict[str, str]) -> tuple[dict[str, str], list[str]]:
    """Header values by column, and the headers that had to be percent-encoded."""
    values, encoded = {}, []
    for column, header in names.items():
        value = row.get(column) or ""
        if _AWKWARD.search(value):
            value = urllib.parse.quote(value, safe="")
            encoded.append(header.lower())
        values[column] = value
    return values, encoded


def encode_record(row: dict) -> bytes:
    """One uncompressed record: headers, then the HTTP header and, unless a revisit, the payload."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    length = row.get("payload_bytes") if revisit else len(payload)
    sha = digest_of(row["payload_digest"]) if revisit else digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length or 0}\r\n\r\n".encode()
    block = http if revisit else http + payload
    value, encoded = _header_values(row, {"record_type": "WARC-Type", "record_id": "WARC-Record-ID",
                                          "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To"})
    head = ["WARC/1.1", f"WARC-Type: {value['record_type']}", f"WARC-Record-ID: <{value['record_id']}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {value['target_uri']}",
            f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if revisit:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                     f"WARC-Refers-To: <{value['refers_to']}>"]
    if encoded:
        head.append(f"{ENCODED}: {' '.join(encoded)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Members:
    """The bytes of a file of gzip members, or of a plain file, as one stream that can skip."""

    def __init__(self, stream):
        self.stream, self.ready, self.inflate = stream, bytearray(), None
        first = stream.read(CHUNK)
        self.packed = first[:2] == b"\x1f\x8b"
        self.feed(first)

    def feed(self, data: bytes) -> None:
        if not self.packed:
            self.ready += data
            return
        while data:
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            self.ready += self.inflate.decompress(data)
            data = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = None

    def more(self) -> bool:
        data = self.stream.read(CHUNK)
        if data:
            self.feed(data)
        return bool(data)

    def until(self, mark: bytes) -> bytes | None:
        """Everything before ``mark``, which is passed; None at the end of the file."""
        at = 0
        while (end := self.ready.find(mark, at)) < 0:
            at = max(0, len(self.ready) - len(mark))
            if not self.more():
                return None
        out = bytes(self.ready[:end])
        del self.ready[:end + len(mark)]
        return out

    def take(self, n: int, keep: bool) -> bytes:
        out = bytearray()
        while n:
            if not self.ready and not self.more():
                raise EOFError("a record is cut off")
            part = min(n, len(self.ready))
            if keep:
                out += self.ready[:part]
            del self.ready[:part]
            n -= part
        return bytes(out)


def _plain(value: str | None) -> str | None:
    return value.removeprefix("<").removesuffix(">") or None if value is not None else None


def decode_records(stream, wanted, want_payload: bool = True):
    """Rows of an archive whose headers pass ``wanted``; the others' blocks are skipped."""
    data = _Members(stream)
    while (head := data.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        for name in fields.get(ENCODED.lower(), "").split():
            value = fields.get(name, "")
            fields[name] = f"<{urllib.parse.unquote(value[1:-1])}>" if value[:1] == "<" else urllib.parse.unquote(value)
        row = {"record_type": fields["warc-type"], "record_id": _plain(fields.get("warc-record-id")),
               "target_uri": fields.get("warc-target-uri"), "refers_to": _plain(fields.get("warc-refers-to")),
               "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None}
        length, keep = int(fields["content-length"]), wanted(row)
        if not keep:
            data.take(length + 4, False)
            continue
        if fields.get("content-type", "").startswith("application/http"):
            http = data.until(b"\r\n\r\n")
            size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
            rest = length - len(http) - 4
            row["payload_bytes"] = int(size[1]) if size else rest
        else:
            rest = row["payload_bytes"] = length
        body = data.take(rest, want_payload)
        row["payload"] = None if row["record_type"] == "revisit" or not want_payload else body
        data.take(4, False)
        yield row


class WarcPartition(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.names, self.tests = options["path"], schema.fieldNames(), []
        self.schema = schema

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                value = getattr(f, "value", None)
                self.tests.append((type(f).__name__, column, tuple(value) if isinstance(f, In) else value))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            x = row[column]
            if x is None or not {"EqualTo": lambda: x == value, "In": lambda: x in value,
                                 "IsNotNull": lambda: True,
                                 "StringStartsWith": lambda: x.startswith(value)}[kind]():
                return False
        return True

    def partitions(self):
        fs, path = filesystem(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True)) \
            if fs.get_file_info(path).type == pafs.FileType.Directory else [fs.get_file_info(path)]
        files = sorted((f.size, f.path) for f in found if f.is_file and f.size
                       and not os.path.basename(f.path).startswith(("_", ".")))
        groups, held = [[]], 0
        for size, name in files:
            if groups[-1] and held + size > PARTITION_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(name)
            held += size
        return [WarcPartition(g) for g in groups]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(self.schema)
        fs, _ = filesystem(self.path)
        rows, held = [], 0
        for name in partition.paths:
            with fs.open_input_stream(name, compression=None) as stream:
                for row in decode_records(stream, self.wanted, "payload" in self.names):
                    rows.append({n: row.get(n) for n in self.names})
                    held += len(rows[-1].get("payload") or b"") + 200
                    if held > 4 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.level = options["path"], int(options.get("level", "2"))
        self.overwrite = overwrite

    def write(self, iterator):
        fs, path = filesystem(self.path)
        name, out, count = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(f"{path}/_tmp", recursive=True)
                    out = fs.open_output_stream(f"{path}/_tmp/{name}", compression=None)
                pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
                out.write(pack.compress(encode_record(row)) + pack.flush())
                count += 1
        if out is not None:
            out.close()
        return WarcCommit(name if count else "", count)

    def commit(self, messages):
        fs, path = filesystem(self.path)
        fs.create_dir(path, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(path)):
                if f.is_file:
                    fs.delete_file(f.path)
        for m in messages:
            if m and m.name:
                fs.move(f"{path}/_tmp/{m.name}", f"{path}/{m.name}")
        self.abort(messages)

    def abort(self, messages):
        fs, path = filesystem(self.path)
        if fs.get_file_info(f"{path}/_tmp").type == pafs.FileType.Directory:
            fs.delete_dir(f"{path}/_tmp")


class WarcCommit(WriterCommitMessage):
    def __init__(self, name: str, count: int):
        self.name, self.count = name, count


class WarcDataSource(DataSource):
    """Options: ``path``, and for writing ``level``, the gzip level."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, uri_col: str | None = None,
                  min_bytes: int = 0) -> DataFrame:
    """Rows to write: of equal payloads the one with the largest id is the response.

    The others revisit it and lose their payload. Payloads under ``min_bytes``
    are all responses. Rows that share the largest id are all responses, and so
    is a row whose group has null ids only.
    """
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    named = pages.select(F.col(id_col).alias("id"),
                         (F.col(uri_col) if uri_col else F.lit(None)).cast("string").alias("target_uri"),
                         body.alias("payload")).withColumn("sha", F.sha1("payload"))
    copies = (named.groupBy("sha").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
              .filter((F.col("n") > 1) & F.col("keeper").isNotNull())
              .select(F.col("sha").alias("_sha"), "keeper"))
    out = named.join(copies, F.col("sha") == F.col("_sha"), "left")
    n_bytes = F.octet_length("payload").cast("long")
    revisit = (F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
               & (n_bytes >= min_bytes))


    def name(c: str):
        return F.concat(F.lit(ID_PREFIX), F.col(c).cast("string"))
    return out.select(
        name("id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(revisit, name("keeper")).alias("refers_to"),
        F.when(revisit, F.col("sha")).alias("payload_digest"),
        n_bytes.alias("payload_bytes"), F.when(~revisit, F.col("payload")).alias("payload"))


def write_warc(rows: DataFrame, path: str) -> None:
    """Append rows of ``SCHEMA`` as archives below ``path``."""
    register(rows.sparkSession)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    rows.select(names).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").load(path)
