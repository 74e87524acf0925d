"""WARC records in ZIP packages: directories, ranges, and the round trip of pages."""

import gzip
import hashlib
import io
import json
import zipfile

import pytest
from llm_texts import prose

from linguamart.llm import warczip


def zipped(members, comment=b"", before=b""):
    out = io.BytesIO()
    out.write(before)
    with zipfile.ZipFile(out, "a") as z:
        for name, data, method in members:
            z.writestr(zipfile.ZipInfo(name), data, method)
        z.comment = comment
    return out.getvalue()


MEMBERS = [(f"archive/é{i}.warc", prose(3 + i, i).encode(), zipfile.ZIP_STORED) for i in range(5)]


def found(data):
    file = io.BytesIO(data)
    names = warczip.central_directory(file, len(data))
    out = {}
    for name, entry in names.items():
        at, size = warczip.stored_member(file, entry, name)
        out[name] = data[at:at + size]
    return out


@pytest.mark.parametrize("comment", [b"", b"note", b"PK\x05\x06 in a comment" + b"x" * 60_000])
@pytest.mark.parametrize("before", [b"", b"a program that unpacks itself"])
@pytest.mark.parametrize("wide", [False, True])
def test_directory(monkeypatch, comment, before, wide):
    """Plain and ZIP64 forms, with comments and with bytes before the archive."""
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    data = zipped(MEMBERS, comment, before)
    assert (b"PK\x06\x06" in data) == wide
    assert found(data) == {name: text for name, text, _ in MEMBERS}


def test_directory_refuses():
    with pytest.raises(ValueError, match="no end"):
        warczip.central_directory(io.BytesIO(b"x" * 100), 100)
    with pytest.raises(ValueError, match="no end"):
        warczip.central_directory(io.BytesIO(b""), 0)
    with pytest.raises(ValueError, match="stored"):
        found(zipped([("a", b"b" * 100, zipfile.ZIP_DEFLATED)]))
    cut = zipped(MEMBERS)
    with pytest.raises(ValueError):
        found(cut[:-30])
    assert found(zipped([])) == {}


PAGES = "page_id long, url string, html string, payload string, digest int, size string, place long, part int, path string, record_id int"


def pages_frame(spark, rows, folder=None, parts=3):
    """Pages with columns of clashing names, from files, as the writer asks for."""
    made = spark.createDataFrame([(*r, "p", 1, "s", 2, 3, "q", 4) for r in rows], PAGES)
    if folder is None:
        return made
    made.repartition(parts).write.parquet(f"{folder}/pages")
    return spark.read.parquet(f"{folder}/pages")


def odd_pages():
    long = "<p>" + prose(60_000, 5) + "</p>"
    same = "<html>" + prose(40, 6) + "</html>"
    rows = [(i, f"http://h{i % 3}.org/{i}", same) for i in range(20, 60)]
    rows += [(1, None, None), (2, "", ""), (3, "no address here\r\nX: y", "short"), (4, "http://é.org/ü?a b", "short"), (5, "http://a.org/long", long)]
    rows += [(6, "http://a.org/z", "é" * 50), (7, "http://a.org/z", "é" * 50), (8, "http://a.org/z", "é" * 49), (9, "http://a.org/z", "é" * 49)]
    rows += [(None, "http://n.org", prose(30, 9)), (None, "http://n.org", prose(30, 9)), (10, "http://r.org", prose(30, 10)), (10, "http://r.org", prose(30, 10))]
    rows += [(None, "x", same), (-5, "WARC/1.1\r\n\r\n", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" * 9)]
    return rows


def wanted(rows):
    firsts = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    out = []
    for i in order:
        page_id, _, html = rows[i]
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        if len(data) >= 100 and digest in firsts:
            out.append((page_id, len(data), digest, "revisit", firsts[digest]))
        else:
            firsts.setdefault(digest, page_id)
            out.append((page_id, len(data), digest, "response", None))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 7])
def test_pages(spark, tmp_path, parts):
    rows = odd_pages()
    got = warczip.archive_pages(pages_frame(spark, rows, tmp_path, parts)).drop("target_uri").collect()
    assert sorted((tuple(r) for r in got), key=str) == wanted(rows)


def test_nothing(spark):
    assert warczip.archive_pages(pages_frame(spark, [])).count() == 0


def test_packages_and_ranges(spark, tmp_path):
    """Small packages and short spans: payloads come back byte by byte, and other programs can open the packages."""
    rows = odd_pages()
    packages = warczip.write_packages(pages_frame(spark, rows, tmp_path), f"{tmp_path}/packages", package_bytes=2_000)
    assert packages.count() > 3
    got = warczip.read_records(packages, span_bytes=1).collect()
    assert len(got) == len(rows)
    texts = {bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert texts == {h or "" for _, _, h in rows}
    seen = 0
    for p in packages.collect():
        with zipfile.ZipFile(p["path"]) as z:
            assert all(x.compress_type == zipfile.ZIP_STORED for x in z.infolist()) and z.testzip() is None
            archive = z.read("archive/data.warc.gz")
            lines = z.read("indexes/index.cdxj").splitlines()
        assert len(lines) == p["records"] and lines == sorted(lines)
        for line in lines:
            known = json.loads(line.split(b" ", 2)[2])
            at = int(known["offset"])
            assert gzip.decompress(archive[at:at + int(known["length"])]).startswith(b"WARC/1.1\r\n")
            seen += 1
    assert seen == len(rows)
    one = got[0]
    with open(one["path"], "rb") as f:
        f.seek(one["offset"])
        assert one["record_id"].encode() in gzip.decompress(f.read(one["length"]))


def hand_made(text, record="r"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + text
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <{record}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_packages_of_others(spark, tmp_path):
    """Without an index the archive is read through; plain and gzipped members; a deflated one stops the job."""
    records = [hand_made(prose(50, i).encode(), f"r{i}") for i in range(4)]
    plain = zipped([("archive/a.warc", b"".join(records[:2]), zipfile.ZIP_STORED), ("archive/b.warc.gz", b"".join(map(gzip.compress, records[2:])), zipfile.ZIP_STORED)])
    (tmp_path / "a.wacz").write_bytes(plain)
    got = warczip.read_records(spark.createDataFrame([(str(tmp_path / "a.wacz"),)], "path string")).collect()
    assert {(r["record_id"], bytes(r["payload"])) for r in got} == {(f"r{i}", prose(50, i).encode()) for i in range(4)}
    (tmp_path / "b.wacz").write_bytes(zipped([("archive/a.warc", records[0], zipfile.ZIP_DEFLATED)]))
    with pytest.raises(Exception, match="only stored members"):
        warczip.read_records(spark.createDataFrame([(str(tmp_path / "b.wacz"),)], "path string")).collect()


def test_changed_payload_is_noticed(spark, tmp_path):
    record = warczip.warc_record("response", "r", "1970", b"HTTP/1.1 200 OK\r\n\r\nother", "application/http", [("WARC-Payload-Digest", "sha256:" + "0" * 64)])
    (tmp_path / "a.wacz").write_bytes(zipped([("archive/a.warc", record, zipfile.ZIP_STORED)]))
    with pytest.raises(Exception, match="not that of its digest"):
        warczip.read_records(spark.createDataFrame([(str(tmp_path / "a.wacz"),)], "path string")).collect()
