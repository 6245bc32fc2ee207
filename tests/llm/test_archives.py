import base64
import gzip
import hashlib
import io
import random
import zipfile

import pytest

from blockstrata.llm import archives

SCHEMA = "page_id long, url string, html string, record string, package string, first long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 5) for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    out, first = [], {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    for page_id, url, html in rows:
        own = first.get(html or "")
        again = own is not None and own != page_id and len((html or "").encode()) >= least
        out.append((page_id, "revisit" if again else "response", own if again else None, len((html or "").encode()), digest(html)))
    return sorted(out, key=str)


ROWS = [(i, f"http://a.example/{i}", f"<p>{i % 7}é</p>") for i in range(60)] + [
    (100, None, None), (101, "http://b.example/ x\r\ny", ""), (102, "u", "<p>" + "long \r\n\r\n text " * 40_000), (103, "u", "a\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "n", "<p>0é</p>"), (None, "n", "only without id"), (104, "u", "same"), (104, "u", "same"), (105, "u", "same")]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    packages = archives.write_packages(table(spark, ROWS), least_bytes=least, package_bytes=500)
    assert packages.count() > 3
    got = archives.read_packages(packages, step=100).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got), key=str) == expected(ROWS, least)
    bodies = {(r["page_id"], bytes(r["payload"])) for r in got if r["record_type"] == "response"}
    assert bodies == {(p, (next(h for i, _, h in ROWS if i == p and digest(h) == d) or "").encode())
                      for p, kind, _, _, d in expected(ROWS, least) if kind == "response"}


def test_other_readers_open_the_packages(spark):
    package = archives.write_packages(table(spark, ROWS[:5])).first()["package"].removeprefix("file:")
    with zipfile.ZipFile(package) as z:
        assert z.testzip() is None and z.namelist() == [archives.DATA, archives.INDEX]
        assert gzip.decompress(z.read(archives.DATA)).count(b"WARC/1.1\r\n") >= 1
        assert z.read(archives.INDEX).splitlines() == sorted(z.read(archives.INDEX).splitlines())


@pytest.mark.parametrize("note", [b"", b"a note", b"PK\x05\x06 in a note"])
def test_directory_of_other_writers(note):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = note
        z.writestr("one", b"abc")
        z.writestr("two/é", b"x" * 1000)
    data = out.getvalue()
    members = archives.directory(lambda at, n: data[at:at + n], len(data))
    assert {k: data[at:at + n] for k, (at, n, _) in members.items()} == {"one": b"abc", "two/é": b"x" * 1000}


def test_offsets_past_four_gigabytes():
    gap, out = 5 << 30, io.BytesIO()
    writer = archives.ZipWriter(out)
    writer.begin("a")
    writer.write(b"first")
    writer.end()
    head = out.tell()
    writer.at += gap  # as if so many bytes lay between
    writer.begin("b")
    writer.write(b"second")
    writer.end()
    writer.close()
    data = out.getvalue()

    def read(at, n):
        places = range(at, at + n)
        return b"".join(data[p:p + 1] if p < head else b"\0" if p < head + gap else data[p - gap:p - gap + 1] for p in places)
    members = archives.directory(read, len(data) + gap)
    assert [read(*members[k][:2]) for k in "ab"] == [b"first", b"second"] and members["b"][0] > gap


def test_damage_is_an_error(spark):
    rng = random.Random(1)
    packages = archives.write_packages(table(spark, [(1, "u", "".join(rng.choice("abcdef") for _ in range(5000)))]))
    path = packages.first()["package"].removeprefix("file:")
    with open(path, "r+b") as f:
        f.seek(1000)
        f.write(b"damaged!")
    with pytest.raises(Exception):
        archives.read_packages(packages).collect()
    with pytest.raises(ValueError):
        archives.directory(lambda at, n: b"\0" * n, 500)


def test_empty_table(spark):
    packages = archives.write_packages(table(spark, []))
    assert packages.count() == 0 and archives.read_packages(packages).count() == 0
