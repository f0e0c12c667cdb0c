"""WARC records in ZIP packages: written by Spark's text sink, read back by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdx`` (a line with offset and length per record), both stored
without further compression. Each write task streams one package; Spark's committer
makes retries and lost executors harmless, on any file system it knows.

The sink ends every row with a separator byte. It is set to 0x1F, with which every
gzip member starts, so a row is a record without its first byte; an empty member
ends the archive, and the last separator is the ZIP comment.

The reader finds the end record, the ZIP64 records if any, and the central
directory in the tail of a package, reads the index member, deals the records out
and range-reads them; nothing is extracted. Executors open packages through
``pyarrow.fs``, which knows local and mounted paths, HDFS, S3 and GCS.

Defined results: a null payload is empty; of equal payloads (SHA-1) the one with
the smallest id is the response and others revisit it, if they have at least
``least`` bytes; repeated rows with the smallest id are responses all; rows without
an id are responses if no row with the payload has an id; ids may be any text (line
breaks and spaces are escaped), null and empty ids stay apart; a null or odd url is
left out or escaped; very long payloads are records like others; other columns,
whatever their names, are not read; empty tables give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import attach, hot_keys, mark_possible, read
from hourgrid.session import checkpoint_dir, materialize

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
SEPARATOR = "\x1f"
#: Records read as one range, what a range may hold, and the ranges of a task.
RANGE_RECORDS, RANGE_BYTES, TASK_RANGES = 512, 4 << 20, 16
_STAMP = (0, 0x21)  # 1980-01-01: packages of equal records are equal
_BIG = 0xFFFFFFFF


def digest32(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _name(page_id: str | None) -> str:
    """An id as a URN: any text, on one line; null has a name of its own."""
    return "urn:nopage" if page_id is None else "urn:page:" + quote(page_id, safe="")


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header (with the payload's length) and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_name(page_id)}>", "WARC-Date: 1980-01-01T00:00:00Z"]
    if url:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_name(refers_to)}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    page_id: str | None
    url: str | None
    payload: bytes | None  # None: a revisit
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: str | None


def parse(raw: bytes) -> Record:
    """Read a record and check its payload against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    plain = lambda x: unquote(fields[x][10:-1]) if fields.get(x, "<urn:nopage>") != "<urn:nopage>" else None
    return Record(plain("WARC-Record-ID"), fields.get("WARC-Target-URI"), payload if kind == "response" else None, size, digest, kind,
                  plain("WARC-Refers-To"))


def _extra64(*numbers: int) -> bytes:
    return struct.pack(f"<HH{len(numbers)}Q", 1, 8 * len(numbers), *numbers)


def _local(name: str, crc: int, size: int, later: bool) -> bytes:
    """Local header; ``later``: CRC and sizes (64 bits) follow the data."""
    extra = _extra64(0, 0) if later else b""
    sizes = (_BIG, _BIG) if later else (size, size)
    return struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0x808 if later else 0x800, 0, *_STAMP, crc, *sizes, len(name), len(extra)) + name.encode() + extra


def _directory(members: list[tuple[str, int, int, int, bool]], at: int, zip64: bool) -> bytes:
    """Central directory and end records for (name, crc, size, offset, later); the comment is one byte, not included."""
    out = b""
    for name, crc, size, offset, later in members:
        big = zip64 or size >= _BIG or offset >= _BIG
        extra = _extra64(size, size, offset) if big else b""
        shown = (_BIG, _BIG) if big else (size, size)
        out += struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0x808 if later else 0x800, 0, *_STAMP, crc, *shown, len(name), len(extra), 0, 0, 0, 0,
                           _BIG if big else offset) + name.encode() + extra
    size, n = len(out), len(members)
    if zip64 or at >= _BIG:
        out += struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, at)
        out += struct.pack("<4sIQI", b"PK\6\7", 0, at + size, 1)
        at = _BIG
    return out + struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, n, n, size, at, 1)


def package(records, zip64: bool = False):
    """Yield the rows of a package, each to be followed by the separator, for (line head, record bytes)."""
    head = _local(DATA, 0, 0, True)
    yield head
    start = len(head)
    crc, size, lines = 0, 0, []
    for key, raw in records:
        member = _gzip(raw)
        lines.append(f"{key} {size} {len(member)}\n")
        size += len(member)
        crc = zlib.crc32(member, crc)
        yield member[1:]
    last = _gzip(b"")
    size += len(last)
    crc = zlib.crc32(last, crc)
    index = "".join(lines).encode()
    tail = struct.pack("<4sI2Q", b"PK\7\10", crc, size, size)
    at = start + size + len(tail)
    tail += _local(INDEX, zlib.crc32(index), len(index), False) + index
    members = [(DATA, crc, size, 0, True), (INDEX, zlib.crc32(index), len(index), at, False)]
    yield last[1:] + tail + _directory(members, start + size + len(tail), zip64)


class Member(NamedTuple):
    size: int
    offset: int  # of the local header


def directory(read_at: Callable[[int, int], bytes], size: int) -> dict[str, Member]:
    """Stored members of a ZIP package by name, from its end and central directory records."""
    reach = min(size, (1 << 16) + 22 + 20)
    tail = read_at(size - reach, reach)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)  # inside the comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<H2I", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == b"PK\6\7":
        end64 = read_at(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<3Q", end64, 32)
    data, at, out = read_at(start, length), 0, {}
    for _ in range(count):
        if data[at:at + 4] != b"PK\1\2":
            raise ValueError("central directory is damaged")
        method, = struct.unpack_from("<H", data, at + 10)
        packed, plain, n, m, k = struct.unpack_from("<2I3H", data, at + 20)
        offset, = struct.unpack_from("<I", data, at + 42)
        name, extra = data[at + 46:at + 46 + n].decode(), data[at + 46 + n:at + 46 + n + m]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<2H", extra)
            if kind == 1:
                big = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                plain = next(big) if plain == _BIG else plain
                packed = next(big) if packed == _BIG else packed
                offset = next(big) if offset == _BIG else offset
            extra = extra[4 + width:]
        if method == 0:
            out[name] = Member(packed, offset)
        at += 46 + n + m + k
    return out


def data_offset(read_at: Callable[[int, int], bytes], member: Member) -> int:
    """Where the data of a stored member begin."""
    head = read_at(member.offset, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError("no local header")
    return member.offset + 30 + sum(struct.unpack_from("<2H", head, 26))


def _opened(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
        return fs.LocalFileSystem().open_input_file(path)
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least: int = 0, zip64: bool = False) -> None:
    """Write a record per row; payloads of at least ``least`` bytes are stored once."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", digest32(F.col("payload")))
    long = rows.where(F.octet_length("payload") >= least)
    first = materialize(long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n"))
                        .where("_n > 1").select("digest", "first", "_n", F.lit(True).alias("_again")), "warc-repeated")
    # most payloads occur once: their rows are told by their digests alone and stay where they are
    marked = mark_possible(rows, F.xxhash64("digest"), first, F.xxhash64("digest"), "_maybe")
    some = attach(marked.where("_maybe").drop("_maybe"), first.drop("_n"), ["digest"], hot_keys(first, ["digest"], "_n"))
    once = marked.where("NOT _maybe").select(*rows.columns, F.lit(None).cast(first.schema["first"].dataType).alias("first"), F.lit(None).cast("boolean").alias("_again"))
    placed = once.union(some.select(*once.columns))
    again = F.coalesce(F.col("_again"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    placed = placed.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest",
                           F.when(again, "revisit").otherwise("response").alias("kind"),
                           F.when(again, F.col("first")).cast("string").alias("refers_to"))

    def run(batches):
        def records():
            for batch in batches:
                for row in zip(*(batch.column(i) for i in range(6))):
                    page_id, url, body, digest, kind, refers_to = (x.as_py() for x in row)
                    yield f"{_name(page_id)} {kind}", record(page_id, url, body, digest, kind, refers_to)

        found = records()
        head = next(found, None)
        if head is not None:

            def all_records():
                yield head
                yield from found

            for raw in package(all_records(), zip64):
                yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["value"])

    placed.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("lineSep", SEPARATOR).text(folder)


def read_packages(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record: page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")

    def index(batches):
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _opened(path) as f:
                    def read_at(at, n, f=f):
                        f.seek(at)
                        return f.read(n)

                    members = directory(read_at, size)
                    base = data_offset(read_at, members[DATA])
                    lines = read_at(data_offset(read_at, members[INDEX]), members[INDEX].size).decode().splitlines()
                starts, sizes = [], []
                for line in lines:
                    at, n = map(int, line.rsplit(" ", 2)[1:])
                    if starts and (len(starts) >= RANGE_RECORDS or base + at + n - starts[0] > RANGE_BYTES):
                        yield _range(path, starts, sizes)
                        starts, sizes = [], []
                    starts.append(base + at)
                    sizes.append(n)
                if starts:
                    yield _range(path, starts, sizes)

    ranges = files.mapInArrow(index, "path string, starts array<long>, sizes array<long>")
    ranges = materialize(ranges, "warc-ranges")
    schema = "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def fetch(batches):
        for batch in batches:
            for path, starts, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with _opened(path) as f:
                    f.seek(starts[0])
                    data = f.read(starts[-1] + sizes[-1] - starts[0])
                found = [parse(zlib.decompress(data[a - starts[0]:a - starts[0] + n], 31)) for a, n in zip(starts, sizes)]
                cols = list(zip(*found))
                if not with_payload:
                    cols[2] = [None] * len(found)
                kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(Record._fields))

    # a range is a short row that stands for megabytes: tasks are cut by their number, not by their bytes
    tasks = max(1, -(-ranges.count() // TASK_RANGES))
    return ranges.repartition(tasks, F.col("path"), F.col("starts")[0]).mapInArrow(fetch, schema)


def _range(path: str, starts: list[int], sizes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([starts], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))], names=["path", "starts", "sizes"])


def op10_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/packages-{uuid.uuid4().hex}"
    write_packages(pages, folder)
    kind = pages.schema["page_id"].dataType
    return read_packages(spark, folder, with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
