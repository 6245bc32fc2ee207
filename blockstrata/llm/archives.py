"""Web archives packed in ZIP files: written by tasks, read back by ranges.

A package holds two stored members: ``archive/data.warc.gz``, one gzip member
per record, and ``indexes/index.cdxj``, one line per record with its offset and
length. Packages lie in a folder that every executor reaches (any place that
pyarrow.fs opens); tables of Spark list them, so files of failed tasks are
never read.
"""

import base64
import hashlib
import json
import struct
import uuid
import zlib

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
MANIFEST = "package string, records long, bytes long"
PLACES = "package string, offset long, length long"
RECORDS = ("page_id long, record_type string, target_uri string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


class ZipWriter:
    """Stored members written in one pass, with ZIP64 sizes and directories."""

    def __init__(self, out):
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data):
        self.out.write(data)
        self.at += len(data)

    def begin(self, name):
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 0, 0, 33, 0, FULL32, FULL32, len(self.name), len(extra)))
        self._put(self.name + extra)

    def write(self, data):
        self._put(data)
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)

    def end(self):
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, self.size, self.size))
        self.entries.append((self.name, self.start, self.crc, self.size))

    def close(self):
        first = self.at
        for name, start, crc, size in self.entries:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x0808, 0, 0, 33, crc, FULL32, FULL32,
                                  len(name), len(extra), 0, 0, 0, 0, FULL32) + name + extra)
        last, n = self.at, len(self.entries)
        self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, last - first, first))
        self._put(struct.pack("<IIQI", 0x07064B50, 0, last, 1))
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


def directory(read, size):
    """Members of a ZIP file of ``size`` bytes: name -> (offset of data, length, method).

    ``read(offset, length)`` returns bytes. Only the directories and the local
    headers are read.
    """
    start = max(0, size - 22 - FULL16)
    tail = read(start, size - start)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    _, _, _, _, count, length, first, _ = struct.unpack_from("<IHHHHIIH", tail, at)
    if count == FULL16 or FULL32 in (length, first):
        sign, _, where, _ = struct.unpack("<IIQI", read(start + at - 20, 20))
        if sign != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        sign, _, _, _, _, _, _, count, length, first = struct.unpack("<IQHHIIQQQQ", read(where, 56))
        if sign != 0x06064B50:
            raise ValueError("no ZIP64 directory")
    entries, members, at = read(first, length), {}, 0
    for _ in range(count):
        (sign, _, _, _, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, local) = struct.unpack_from(
            "<IHHHHHHIIIHHHHHII", entries, at)
        if sign != 0x02014B50:
            raise ValueError("broken central directory")
        name = entries[at + 46:at + 46 + n_name].decode("utf-8")
        extra, at = entries[at + 46 + n_name:at + 46 + n_name + n_extra], at + 46 + n_name + n_extra + n_note
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                local = next(wide) if local == FULL32 else local
            extra = extra[4 + n:]
        sign, = struct.unpack("<I", read(local, 4))
        if sign != 0x04034B50:
            raise ValueError("broken local header")
        n_name, n_extra = struct.unpack("<HH", read(local + 26, 4))
        members[name] = (local + 30 + n_name + n_extra, packed, method)
    return members


def _gzip(data, level=6):
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(kind, page_id, url, digest, body, date, more=()):
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", *more,
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _http(length):
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _responses(date):
    def run(batches):
        for batch in batches:
            html = batch.column(2).cast(pa.binary()).to_pylist()
            records, digests, sizes = [], [], []
            for page_id, url, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), html):
                payload = payload or b""
                digest = _digest(payload)
                digests.append(digest)
                sizes.append(len(payload))
                records.append(_gzip(_record("response", page_id, url, digest, _http(len(payload)) + payload, date)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(digests, pa.string()),
                 pa.array(sizes, pa.int64()), pa.array(records, pa.binary())],
                names=["page_id", "url", "print", "digest", "size", "record"])
    return run


def _write(folder, date, package_bytes):
    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        done, package = [], None

        def finish():
            writer, stream, name, lines = package
            writer.end()
            writer.begin(INDEX)
            for line in sorted(lines):
                writer.write(line)
            writer.end()
            writer.close()
            stream.close()
            done.append((name, len(lines), writer.at))

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    name = f"{uuid.uuid4().hex}.wacz"
                    stream = system.open_output_stream(f"{root}/{name}")
                    package = ZipWriter(stream), stream, f"{folder}/{name}", []
                    package[0].begin(DATA)
                writer, record = package[0], row["record"]
                if row["first"] is not None:
                    more = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                            f"WARC-Refers-To: {_name(row['first'])}"]
                    record = _gzip(_record("revisit", row["page_id"], row["url"], row["digest"], _http(row["size"]), date, more))
                key = (row["url"] or "").replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D")
                entry = {"digest": f"sha1:{row['digest']}", "offset": writer.size, "length": len(record), "filename": DATA}
                package[3].append(f"{key} {''.join(filter(str.isdigit, date))} {json.dumps(entry)}\n".encode())
                writer.write(record)
                if writer.size >= package_bytes:
                    finish()
                    package = None
        if package is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.int64())], names=["package", "records", "bytes"])
    return run


def write_packages(pages, folder=None, least_bytes=0, date="2024-01-01T00:00:00Z", package_bytes=64_000_000):
    """Write a WARC record per row into ZIP packages; returns package, records, bytes.

    ``pages`` needs page_id, url, html; the payload is the html in UTF-8, null
    is empty. Of records with equal payloads of at least ``least_bytes`` bytes,
    that with the smallest page_id is a response and the others are revisits
    that name it; smaller ones are all responses. Rows that repeat the smallest
    page_id are responses too. A null page_id counts as larger than any; where
    a payload has no other id, its records are responses. Payloads are compared
    by SHA-256, counted within each task before they meet; bodies move once,
    compressed, by page_id. Each task fills packages of about
    ``package_bytes``. An empty table gives no packages.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/packages/{uuid.uuid4().hex}"
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha2(html, 256).alias("print"))
    prints = base.where(F.octet_length("html") >= least_bytes).select("page_id", "print")
    first = prints.groupBy("print").agg(F.min("page_id").alias("first")).where("first is not null")
    again = prints.distinct().join(first, "print").where("not (page_id <=> first)")
    rows = base.mapInArrow(_responses(date), "page_id long, url string, print string, digest string, size long, record binary")
    r, a = rows.alias("r"), again.alias("a")
    rows = r.join(a, F.expr("r.page_id <=> a.page_id AND r.print = a.print"), "left").select("r.*", "a.first")
    return cut_lineage(rows.mapInArrow(_write(folder, date, package_bytes), MANIFEST))


def _open(package):
    system, path = fs.FileSystem.from_uri(package)
    return system.open_input_file(path)


def _places(step):
    def run(frames):
        for frame in frames:
            for package in frame["package"]:
                with _open(package) as f:
                    members = directory(lambda at, n: f.read_at(n, at), f.size())
                    if any(m[2] for m in members.values()):
                        raise ValueError(f"{package}: members must be stored")
                    for name in [m for m in members if m.startswith("indexes/")]:
                        start, left, _ = members[name]
                        rest = b""
                        while left:
                            part = f.read_at(min(step, left), start)
                            start, left = start + len(part), left - len(part)
                            lines = (rest + part).split(b"\n")
                            rest = lines.pop()
                            found = [json.loads(line.split(b" ", 2)[2]) for line in lines]
                            yield pd.DataFrame({"package": package, "offset": [members[x["filename"]][0] + x["offset"] for x in found],
                                                "length": [x["length"] for x in found]})
    return run


def _parse(data, want_payload):
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (_digest(payload) != digest or len(payload) != size):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
    number = lambda urn: int(n) if (n := urn.removeprefix("<urn:page:").removesuffix(">")) else None
    return (number(fields["WARC-Record-ID"]), kind, fields["WARC-Target-URI"],
            number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None, size, digest,
            payload if want_payload and kind == "response" else None)


def _records(want_payload, batch_rows):
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        held, name = None, None
        for batch in batches:
            order = batch.to_pandas().sort_values(["package", "offset"])
            rows = []
            for package, offset, length in order.itertuples(index=False):
                if package != name:
                    if held:
                        held.close()
                    held, name = _open(package), package
                rows.append(_parse(held.read_at(length, offset), want_payload))
                if len(rows) >= batch_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if held:
            held.close()
    return run


def read_packages(packages, payload=True, step=4_000_000, batch_rows=500):
    """Records of ZIP packages, found by their directories and indexes.

    ``packages`` needs package (a path or URI). Returns page_id, record_type,
    target_uri, refers_to, payload_bytes, payload_digest, payload (null for
    revisits and unless ``payload``). One pass per package reads its
    directories and its index in ranges of ``step`` bytes; then ranges of about
    ``step`` bytes are dealt out to tasks, which read record by record and
    check each payload against its digest. A damaged package raises an error.
    """
    places = packages.select("package").repartition("package").mapInPandas(_places(step), PLACES)
    places = places.repartition("package", F.floor(F.col("offset") / step)).select("package", "offset", "length")
    return places.mapInArrow(_records(payload, batch_rows), RECORDS)
