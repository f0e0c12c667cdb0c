import base64
import glob
import gzip
import hashlib
import io
import os
import zipfile
import zlib

import pytest

from hourgrid.llm import warc
from tests.llm.util import compare

ROWS = [(1, "http://a/é b\nx", "hello\x00\r\n\r\nü"), (2, None, "hello\x00\r\n\r\nü"), (3, "u", None), (4, "u", ""), (None, "v", "hello\x00\r\n\r\nü"),
        (7, "x", "z" * 300_000), (7, "x", "z" * 300_000), (None, "q", "only")]


def _b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("zip64", [False, True])
def test_round_trip(spark, tmp_path, zip64):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "'y' AS digest", "1 AS first")
    folder = str(tmp_path / "p")
    warc.write_packages(df, folder, zip64=zip64)
    rows = warc.read_packages(spark, folder).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload if r.payload is None else bytes(r.payload)) for r in rows), key=str)
    want = []
    for page_id, _, html in ROWS:
        data = (html or "").encode()
        same = [i for i, _, h in ROWS if (h or "") == (html or "") and i is not None]
        first = min(same, default=None)
        again = page_id != first
        want.append((None if page_id is None else str(page_id), len(data), _b32(data), "revisit" if again else "response", str(first) if again else None, None if again else data))
    assert got == sorted(want, key=str)
    # another reader finds the same archives, and a plain one can read the records in a row
    n = 0
    for path in glob.glob(f"{folder}/part-*"):
        if os.path.getsize(path):
            package = zipfile.ZipFile(path)
            assert package.testzip() is None and package.namelist() == [warc.DATA, warc.INDEX]
            n += gzip.decompress(package.read(warc.DATA)).count(b"WARC/1.1\r\n")
    assert n == len(ROWS)


def test_least_bytes(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write_packages(df, str(tmp_path / "p"), least=20)
    kinds = [(r.page_id, r.record_type) for r in warc.read_packages(spark, str(tmp_path / "p"), with_payload=False).collect()]
    assert all(k == "response" for _, k in kinds) and len(kinds) == len(ROWS)  # the long copies share the smallest id


def test_reads_directories_of_other_writers():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\5\6 inside" + b"x" * 40
        z.writestr("archive/data.warc.gz", b"abc" * 100)
        z.writestr(zipfile.ZipInfo("packed"), b"x" * 1000, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as f:
            f.write(b"0123456789")
    data = buffer.getvalue()
    at = lambda a, n: data[a:a + n]
    members = warc.directory(at, len(data))
    assert set(members) == {"archive/data.warc.gz", "big"}  # only stored members
    for name, body in (("archive/data.warc.gz", b"abc" * 100), ("big", b"0123456789")):
        start = warc.data_offset(at, members[name])
        assert at(start, members[name].size) == body
    with pytest.raises(ValueError):
        warc.directory(lambda a, n: b"x" * n, 100)


def test_zip64_offsets_beyond_four_gigabytes():
    far = 5 << 30
    members = [("archive/data.warc.gz", 1, far, 0, True), ("indexes/index.cdx", 2, 10, far + 100, False)]
    tail = warc._directory(members, far + 500, False) + b"\x1f"
    start = far + 500
    read_at = lambda a, n: tail[a - start:a - start + n]
    sparse = lambda a, n: b"\0" * max(0, min(n, start - a)) + read_at(max(a, start), n - max(0, start - a))
    assert warc.directory(sparse, start + len(tail)) == {"archive/data.warc.gz": (far, 0), "indexes/index.cdx": (10, far + 100)}


def test_a_damaged_payload_is_noticed():
    raw = warc.record("1", "http://a", b"body", _b32(b"body"), "response", None)
    assert warc.parse(raw).payload == b"body"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"\r\n\r\nbody", b"\r\n\r\nbady"))
    assert zlib.decompress(warc._gzip(raw), 31) == raw


def test_query_matches_sql(spark):
    compare(spark, "/root/testdata/sf0.01", "op10_zip_archives")


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_packages(df, str(tmp_path / "p"))
    assert warc.read_packages(spark, str(tmp_path / "p")).count() == 0
