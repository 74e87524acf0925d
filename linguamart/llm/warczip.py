"""WARC records inside ZIP packages: tasks write packages to the shared folder and read single records by byte ranges.

A package holds three members, all stored and none compressed by the ZIP itself: ``archive/data.warc.gz`` (each record is
a gzip member of its own), ``indexes/index.cdxj`` (a line for each record, with its place in the archive) and
``datapackage.json``. The reader finds members by the central directory, plain or ZIP64, and never unpacks one.
"""

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .common import saved

#: A package is closed once it has that many bytes or records; a longer record still goes in whole.
PACKAGE_BYTES, PACKAGE_RECORDS = 128 << 20, 100_000
#: Neighbouring records are read in one range of about that many bytes.
SPAN_BYTES = 4 << 20
#: Payloads of at least so many bytes are stored once.
LEAST_BYTES = 100
LEVEL = 3
URN = "urn:linguamart"
ARCHIVE, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"

# Fixed values of the ZIP and WARC formats: signatures, sizes of fixed parts, marks of values kept in ZIP64 fields.
END, END_SIZE = b"PK\x05\x06", 22
LOCATOR, LOCATOR_SIZE = b"PK\x06\x07", 20
END64 = b"PK\x06\x06"
CENTRAL, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL2, FULL4, ZIP64_FIELD = 0xFFFF, 0xFFFFFFFF, 1
MOST_COMMENT = 65_535
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def file_system(uri):
    """(file system, path) of a folder or file that all executors reach."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


# --- writing ---------------------------------------------------------------------------------------------------------


def warc_record(kind, record_id, date, block, content_type, fields=()):
    """The bytes of one record. ``fields`` are more (name, value) pairs; those without a value are left out."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *fields, ("Content-Type", content_type), ("Content-Length", len(block))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head if value is not None)
    return b"".join([b"WARC/1.1\r\n", lines.encode(), b"\r\n", block, b"\r\n\r\n"])


class Package:
    """One package on its way to a file."""

    def __init__(self, folder, date):
        self.date, self.lines, self.bytes = date, [], 0
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        fs, inner = file_system(self.path)
        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.archive = self.zip.open(self._info(ARCHIVE), "w", force_zip64=True)
        self._put(warc_record("warcinfo", f"urn:uuid:{uuid.uuid4()}", date, b"format: WARC File Format 1.1\r\n", "application/warc-fields"))

    def _info(self, name):
        return zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))

    def _put(self, record):
        packed = zlib.compress(record, LEVEL, wbits=31)
        self.archive.write(packed)
        at, self.bytes = self.bytes, self.bytes + len(packed)
        return at, len(packed)

    def add(self, record_id, url, payload, size, digest, refers_to):
        """A response with its payload, or, where ``refers_to`` names another record, a revisit without."""
        revisit = refers_to is not None
        address = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)
        fields = [("WARC-Target-URI", address), ("WARC-Payload-Digest", f"sha256:{digest}")]
        if revisit:
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
        block = HTTP_HEAD.format(size).encode() + (b"" if revisit else payload)
        at, n = self._put(warc_record("revisit" if revisit else "response", record_id, self.date, block, "application/http;msgtype=response", fields))
        known = {"url": address or "", "mime": "warc/revisit" if revisit else "text/html", "digest": f"sha256:{digest}", "offset": str(at), "length": str(n), "filename": ARCHIVE.rsplit("/", 1)[1]}
        self.lines.append(f"{quote((address or '-').lower(), safe='/:?&=%#')} {re.sub('[^0-9]', '', self.date)[:14]} {json.dumps(known)}")

    def close(self):
        self.archive.close()
        self.zip.writestr(self._info(INDEX), "".join(f"{x}\n" for x in sorted(self.lines)).encode())
        named = [{"name": x.rsplit("/", 1)[1], "path": x} for x in (ARCHIVE, INDEX)]
        self.zip.writestr(self._info(PACKAGE), json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": named}))
        self.zip.close()
        self.out.close()
        return self.path, self.bytes, len(self.lines)


def write_packages(pages, folder=None, date="1970-01-01T00:00:00Z", least=LEAST_BYTES, package_bytes=PACKAGE_BYTES, id_col="page_id", url_col="url", html_col="html"):
    """Writes a record for each row of ``pages`` and returns (path, bytes, records) of the packages.

    Of rows with equal payloads of at least ``least`` bytes that with the smallest id becomes the response, the others
    revisit it; rows of one id (or of none: these come last) are told by their place. A null html is an empty payload;
    a row without an address has no target. White space and control characters of an address are percent-encoded.

    A package is named when a task begins it, and only those of tasks that ended are returned, from a written table: what
    a lost or repeated task leaves behind is never read. Rows meet what they revisit by (digest, input partition), so that
    no task gets more of a group of equal pages than one partition of the input holds. ``pages`` is read twice and has to
    come in the same partitions both times, as files do; a result of random steps should be written first.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "packages")
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long"), "place": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    own = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "place")
    parts = rows.where(F.col("size") >= least).groupBy("digest", "part").agg(F.min(own).alias("first"), F.count("*").alias("n"))
    firsts = parts.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1").select("digest", "first")
    known = parts.select("digest", "part").join(firsts, "digest")

    def urn(page_id, place):
        return F.concat(F.lit(f"{URN}:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), place.cast("string"))

    refers = F.when(F.col("first.place") != F.col("place"), urn(F.col("first.page_id"), F.col("first.place")))
    records = rows.join(known, ["digest", "part"], "left").select(
        urn(F.col("page_id"), F.col("place")).alias("record_id"), "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "size", "digest", refers.alias("refers_to"),
    )

    def run(batches):
        package, done = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                package = package or Package(folder, date)
                record_id, url, text, size, digest, refers_to = (batch.column(j)[i].as_py() for j in range(6))
                package.add(record_id, url, (text or "").encode(), size, digest, refers_to)
                if package.bytes >= package_bytes or len(package.lines) >= PACKAGE_RECORDS:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in done], k) for j, k in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])

    return saved(records.mapInArrow(run, "path string, bytes long, records long"), "packages_list")


# --- reading ---------------------------------------------------------------------------------------------------------


def central_directory(file, size):
    """{name: (offset of the local header, stored size, method)} of a ZIP file of ``size`` bytes, plain or ZIP64."""
    def at(place, n):
        file.seek(place)
        return file.read(n)

    tail_at = max(0, size - END_SIZE - MOST_COMMENT)
    tail = at(tail_at, size - tail_at)
    found = tail.rfind(END)
    while found >= 0 and (found + END_SIZE > len(tail) or found + END_SIZE + struct.unpack_from("<H", tail, found + 20)[0] != len(tail)):
        found = tail.rfind(END, 0, found)
    if found < 0:
        raise ValueError("no end of a central directory")
    end = tail_at + found
    disk, first_disk, _, number, length, start = struct.unpack_from("<4H2I", tail, found + 4)
    locator = at(end - LOCATOR_SIZE, LOCATOR_SIZE) if end >= LOCATOR_SIZE else b""
    if locator[:4] == LOCATOR:
        _, place, disks = struct.unpack_from("<IQI", locator, 4)
        record = at(place, 56)
        if record[:4] != END64:  # Data stand before the archive, and places count from its own start.
            place, record = end - LOCATOR_SIZE - 56, at(end - LOCATOR_SIZE - 56, 56)
        if record[:4] != END64 or disks > 1:
            raise ValueError("no ZIP64 end of a central directory in this file")
        disk, first_disk, _, number, length, start = struct.unpack_from("<2I4Q", record, 16)
        end = place
    elif FULL2 in (number, disk) or FULL4 in (length, start):
        raise ValueError("ZIP64 values without a ZIP64 end of the central directory")
    if disk or first_disk:
        raise ValueError("archives over several disks are not read")
    shift = end - length - start
    entries, names, place = at(start + shift, length), {}, 0
    for _ in range(number):
        if entries[place:place + 4] != CENTRAL:
            raise ValueError("a broken central directory")
        flags, method = struct.unpack_from("<2H", entries, place + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<2I3H", entries, place + 20)
        local = struct.unpack_from("<I", entries, place + 42)[0]
        name = entries[place + 46:place + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = entries[place + 46 + n_name:place + 46 + n_name + n_extra]
        while len(extra) >= 4:
            field, n = struct.unpack_from("<2H", extra)
            if field == ZIP64_FIELD:  # Only the values that are marked as full stand here, in this order.
                wide = list(struct.unpack_from(f"<{min(n, len(extra) - 4) // 8}Q", extra, 4))
                plain = wide.pop(0) if plain == FULL4 and wide else plain
                packed = wide.pop(0) if packed == FULL4 and wide else packed
                local = wide.pop(0) if local == FULL4 and wide else local
            extra = extra[4 + n:]
        names[name] = local + shift, packed, None if flags & 1 else method
        place += 46 + n_name + n_extra + n_comment
    return names


def stored_member(file, entry, name=""):
    """(first byte, size) of a stored member's data."""
    local, size, method = entry
    if method != 0:
        raise ValueError(f"{name or 'a member'} is compressed or encrypted; only stored members are read by range")
    file.seek(local)
    head = file.read(30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {name}")
    return local + 30 + sum(struct.unpack_from("<2H", head, 26)), size


def index_entries(file, names):
    """(first byte, length, member) of every record that the indexes of a package list, in the order of the file."""
    archives = {n.rsplit("/", 1)[1]: n for n in names if re.fullmatch(r"archive/.*\.warc(\.gz)?", n)}
    starts = {n: stored_member(file, names[n], n) for n in archives.values()}
    found = []
    indexes = [n for n in names if re.fullmatch(r"indexes/.*\.(cdxj?)(\.gz)?", n)]
    for name in indexes:
        place, size = stored_member(file, names[name], name)
        file.seek(place)
        data = file.read(size)
        for line in (zlib.decompress(data, wbits=31) if name.endswith(".gz") else data).splitlines():
            known = json.loads(line[line.index(b"{"):]) if b"{" in line else None
            if known:
                member = archives[known["filename"].rsplit("/", 1)[-1]]
                found.append((starts[member][0] + int(known["offset"]), int(known["length"]), member))
    if not indexes:
        for member, (place, size) in starts.items():
            found += [(place + a, n, member) for a, n in scan_member(file, place, size, member.endswith(".gz"))]
    return sorted(set(found))


def scan_member(file, place, size, packed, step=1 << 20):
    """(offset, length) of the records of an archive member that no index lists, by reading through it."""
    at = 0
    while at < size:
        file.seek(place + at)
        if packed:
            inner, n = zlib.decompressobj(wbits=31), 0
            while not inner.eof:
                data = file.read(min(step, size - at - n))
                if not data:
                    raise ValueError("an archive member ends inside a record")
                inner.decompress(data)
                n += len(data) - len(inner.unused_data)
        else:
            data = b""
            while b"\r\n\r\n" not in data:
                more = file.read(min(step, size - at - len(data)))
                if not more:
                    raise ValueError("an archive member ends inside a record")
                data += more
            head = data.index(b"\r\n\r\n") + 4
            n = head + int(re.search(rb"(?im)^content-length:\s*(\d+)", data[:head])[1]) + 4
        yield at, n
        at += n


SPANS = "path string, start long, lengths array<long>, members array<string>"


def locate(paths, span_bytes=SPAN_BYTES):
    """Runs of neighbouring records, of about ``span_bytes``, of the packages in column ``path``."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = file_system(path)
                spans, ends = [], None
                with fs.open_input_file(inner) as file:
                    for start, n, member in index_entries(file, central_directory(file, file.size())):
                        if start != ends or sum(spans[-1][2]) + n > span_bytes:
                            spans.append((path, start, [], []))
                        spans[-1][2].append(n)
                        spans[-1][3].append(member)
                        ends = start + n
                kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in spans], k) for j, k in enumerate(kinds)], names=[x.split()[0] for x in SPANS.split(", ")])

    return paths.select("path").mapInArrow(run, SPANS)


def parse_record(data):
    """(fields by lower-case name, block) of a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def parse_http(block):
    """(Content-Length or None, body) of a HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return (int(length[1]) if length else None), body


RECORDS = T.StructType([
    *(T.StructField(n, T.StringType()) for n in ("path", "record_id", "record_type", "url", "payload_digest")), T.StructField("payload_bytes", T.LongType()),
    T.StructField("refers_to_id", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()), T.StructField("payload", T.BinaryType()),
])


def read_records(paths, payload=True, span_bytes=SPAN_BYTES):
    """Response and revisit records of the packages in column ``path``, each read by its byte range.

    Directories and indexes are read by one task per package; the spans they give are then dealt out, so that a large
    package is read by many tasks. A response's payload is held against its digest; a payload that differs stops the job.
    A revisit has no payload, and the size and digest of the one it repeats. ``payload=False`` leaves payloads out.
    """
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, start, lengths, members = (batch.column(j)[i].as_py() for j in range(4))
                fs, inner = file_system(path)
                with fs.open_input_file(inner) as file:
                    file.seek(start)
                    data = file.read(sum(lengths))
                out, at = [], 0
                for n, member in zip(lengths, members):
                    fields, block = parse_record(zlib.decompress(data[at:at + n], wbits=31) if member.endswith(".gz") else data[at:at + n])
                    kind = fields.get("warc-type")
                    if kind in ("response", "revisit"):
                        size, body = parse_http(block)
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                        if kind == "response":
                            size, own = len(body), hashlib.sha256(body).hexdigest()
                            if re.fullmatch("[0-9a-f]{64}", digest) and own != digest:
                                raise ValueError(f"the payload at {start + at} of {path} is not that of its digest")
                            digest = own
                        ids = [(fields.get(k) or "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")]
                        out.append((path, ids[0], kind, fields.get("warc-target-uri"), digest, size, ids[1], start + at, n, body if payload and kind == "response" else None))
                    at += n
                kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], kinds[f.dataType]) for j, f in enumerate(RECORDS)], names=RECORDS.names)

    spans = locate(paths, span_bytes)
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spans.repartition(n, "path", "start").mapInArrow(run, RECORDS)


def archive_pages(pages, folder=None, **options):
    """Writes ``pages`` as packages, reads them back and returns what the records say: one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to (the page of the response that a revisit repeats) and
    the address as the record has it. A row without an id comes back without one; repeated rows each come back; an
    empty table gives no package and no row; columns besides the three are not looked at.
    """
    packages = write_packages(pages, folder, **options)
    records = read_records(packages, payload=False)

    def page(column):
        return F.nullif(F.regexp_extract(column, rf"^{URN}:(-?\d*):", 1), F.lit("")).cast("long")

    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to_id").alias("refers_to"), F.col("url").alias("target_uri"),
    )
