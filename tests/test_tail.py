"""Lines of growing, rotated and renamed files, each seen once."""

import os

import pytest

from blockstrata.streaming.frames import log_tail
from blockstrata.streaming.tail import TailReader, tail_lines


@pytest.fixture()
def follow(spark, tmp_path):
    """Run the stream over what is new and give (file, line) of this run."""
    folder = tmp_path / "logs"
    folder.mkdir()

    def run(bytes_per_task=None):
        rows = []
        q = (tail_lines(spark, str(folder), bytes_per_task).writeStream.foreachBatch(lambda df, i: rows.extend(df.collect()))
             .option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r["file"], r["at"], r["line"]) for r in rows)
    return folder, run


def add(path, data):
    with open(path, "ab") as f:
        f.write(data)


def test_appended_lines_come_once(follow):
    folder, run = follow
    add(folder / "a.log", b"one\ntwo\nthr")
    add(folder / "_hidden", b"no\n")
    assert run() == [("a.log", 0, "one"), ("a.log", 4, "two")]
    assert run() == []
    add(folder / "a.log", b"ee\r\n\nfive")
    add(folder / "b.log", b"other\n")
    assert run() == [("a.log", 8, "three"), ("a.log", 15, ""), ("b.log", 0, "other")]
    add(folder / "a.log", b"\n")
    assert run() == [("a.log", 16, "five")]


def test_rotated_and_renamed_files(follow):
    folder, run = follow
    add(folder / "a.log", b"first\nsecond\n")
    assert len(run()) == 2
    add(folder / "a.log", b"third\n")
    os.rename(folder / "a.log", folder / "a.log.1")
    add(folder / "a.log", b"a new begin\n" * 10)  # longer than the old one
    got = run()
    assert [x for x in got if x[0] == "a.log.1"] == [("a.log.1", 13, "third")] and len([x for x in got if x[0] == "a.log"]) == 10
    (folder / "a.log").write_bytes(b"a new begin\n")  # shorter, with the same first line
    assert run() == [("a.log", 0, "a new begin")]


def test_parts_of_any_size_hold_each_line_once(tmp_path):
    path = tmp_path / "x.log"
    lines = [b"", b"a", b"bb" * 50, "é中".encode(), b"", b"c\r"] * 7
    path.write_bytes(b"\n".join(lines) + b"\nrest")
    want = [x.removesuffix(b"\r").decode() for x in lines]
    for size in (1, 2, 7, 64, 10 ** 6):
        reader = TailReader({"path": str(path), "bytesPerTask": str(size)})
        parts = reader.partitions({}, reader.latestOffset())
        rows = [r for p in parts for b in reader.read(p) for r in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        assert [t for _, t in sorted(rows)] == want and len({a for a, _ in rows}) == len(want)


def test_empty_and_missing_places(tmp_path):
    assert TailReader({"path": str(tmp_path)}).latestOffset() == {}
    assert TailReader({"path": str(tmp_path / "none")}).latestOffset() == {}


def test_log_fields_between_two_triggers(spark, tmp_path):
    path = tmp_path / "game.log"
    add(path, b"parse bAnyOff=1 spec=vox=1 struct=0 t=3\nother\n")
    seen = []
    for more in (b"parse bAnyOff=1 spec=vox=0 struct=1 t=4\n", b""):
        q = (log_tail(spark, str(path)).writeStream.foreachBatch(lambda df, i: seen.extend(r["spec"] for r in df.collect()))
             .option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start())
        q.awaitTermination()
        add(path, more)
    assert seen == [{"vox": 1, "struct": 0}, {"vox": 0, "struct": 1}]
