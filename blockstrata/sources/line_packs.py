"""Named texts in shared part files, written by tasks and put in force by one commit.

A pack is a folder of part files, an index beside each, and a manifest. Rows of
(name, line) are written in the order in which they come: every task writes the
lines of its partition to one part, whatever names they belong to, and an index
of its runs (name, offset, bytes, lines). The commit lists the parts in the order
of their partitions with the line number at which each begins its first name, so
a text that spans parts is read in order. Packed parts (.gz) hold each run as
gzip members of its own; offsets and bytes of their runs are those of the
members, so one run can be read alone from them as well. Parts of lost attempts are not listed
and never read. The folder may be in any store that pyarrow.fs opens and all
workers see.
"""

import json
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .voxel_files import store_of

MEMBER = 1 << 20  # bytes of text in a gzip member
RUNS = pa.schema([("name", pa.string()), ("offset", pa.int64()), ("bytes", pa.int64()), ("lines", pa.int64())])


@dataclass
class Written(WriterCommitMessage):
    """A part that a task has finished: its partition, file and ends."""
    partition: int
    file: str
    runs: int
    lines: int
    first: str
    last: str
    last_lines: int


def _runs_of(batches):
    """Name, number of lines and text of each stretch of equal names."""
    for batch in batches:
        lines = pc.binary_join_element_wise(batch.column("line").fill_null(""), "", "\n").cast(pa.large_binary())
        names = batch.column("name").dictionary_encode(null_encoding="encode")
        if not len(lines):
            continue
        ids, known = np.asarray(names.indices), names.dictionary.to_pylist()
        ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
        data, places = memoryview(lines.buffers()[2]), ends[cuts].tolist()
        cuts = cuts.tolist()
        for i, own in enumerate(ids[cuts[:-1]].tolist()):
            yield known[own], cuts[i + 1] - cuts[i], bytes(data[places[i]:places[i + 1]])


def _members(f, size):
    """Texts of the gzip members in the next ``size`` bytes; each holds whole lines."""
    data, texts, member = b"", [], None
    while size or data:
        if not data:
            data = f.read(min(size, MEMBER))
            if not data:
                break
            size -= len(data)
        member = member or zlib.decompressobj(wbits=31)
        texts.append(member.decompress(data))
        data = member.unused_data
        if member.eof:
            yield b"".join(texts)
            texts, member = [], None
    if member or size:
        raise EOFError("a part of a pack ends before its runs do")


def _blocks(f, size):
    """The next ``size`` bytes in blocks of whole lines."""
    rest = b""
    while size:
        data = f.read(min(size, MEMBER))
        if not data:
            raise EOFError("a part of a pack ends before its runs do")
        size -= len(data)
        whole, end, rest = (rest + data).rpartition(b"\n")
        if end:
            yield whole + end


def _line_batch(texts):
    """Rows (name, line_no, line) of texts given as name, number of the first line and bytes."""
    names, firsts, data = zip(*texts)
    counts = np.array([t.count(b"\n") for t in data], np.int64)
    data = b"".join(data)
    n = int(counts.sum())
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) - np.arange(n)
    offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32))
    lines = pa.StringArray.from_buffers(n, offsets, pa.py_buffer(data.replace(b"\n", b"")))
    lines.validate(full=True)
    numbers = np.arange(n) + np.repeat(np.array(firsts, np.int64) - (np.cumsum(counts) - counts), counts)
    owners = pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(names)), counts)))
    return pa.RecordBatch.from_arrays([owners, pa.array(numbers, pa.int64()), lines], names=["name", "line_no", "line"])


class PackWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.packed = str(options.get("packed", "false")).lower() == "true"

    def write(self, batches):
        partition, name = TaskContext.get().partitionId(), None
        file = f"part-{partition:05d}-{uuid.uuid4().hex}"
        store, place = store_of(self.folder)
        store.create_dir(place, recursive=True)
        runs, at, total = {c: [] for c in RUNS.names}, 0, 0
        held, size = [], 0  # texts of the run that are not yet packed
        with store.open_output_stream(f"{place}/{file}.{'gz' if self.packed else 'txt'}", compression=None) as out:
            def pack():
                nonlocal at, held, size
                if held:
                    data = zlib.compress(b"".join(held), 1, wbits=31) if self.packed else b"".join(held)
                    out.write(data)
                    runs["bytes"][-1] += len(data)
                    at, held, size = at + len(data), [], 0
            for own, lines, text in _runs_of(batches):
                if own != name or not runs["name"]:
                    pack()
                    for c, v in zip(RUNS.names, (own, at, 0, 0)):
                        runs[c].append(v)
                    name = own
                runs["lines"][-1] += lines
                total += lines
                held.append(text)
                size += len(text)
                if size > MEMBER:
                    pack()
            pack()
        with store.open_output_stream(f"{place}/{file}.runs") as out:
            pq.write_table(pa.table(runs, schema=RUNS), out)
        names = runs["name"] or [None]
        return Written(partition, file, len(runs["name"]), total, names[0], names[-1], (runs["lines"] or [0])[-1])

    def commit(self, messages):
        store, place = store_of(self.folder)
        parts, name, lines = [], None, 0
        for m in sorted((m for m in messages if m is not None and m.runs), key=lambda m: m.partition):
            base = lines if m.first == name and parts else 0
            parts.append({"file": m.file, "runs": m.runs, "lines": m.lines, "base": base})
            lines = m.last_lines + (base if m.runs == 1 else 0)
            name = m.last
        before = manifest(self.folder)
        fresh = f"{place}/manifest-{uuid.uuid4().hex}.json"
        with store.open_output_stream(fresh) as f:
            f.write(json.dumps({"parts": parts} | ({"packed": True} if self.packed else {})).encode())
        store.move(fresh, f"{place}/manifest.json")
        self._remove([p["file"] for p in before["parts"]] + [m.file for m in messages if m is not None and not m.runs])

    def abort(self, messages):
        self._remove([m.file for m in messages if m is not None])

    def _remove(self, files):
        store, place = store_of(self.folder)
        for file in files:
            for kind in ("txt", "gz", "runs"):
                if store.get_file_info(f"{place}/{file}.{kind}").is_file:
                    store.delete_file(f"{place}/{file}.{kind}")


def manifest(folder: str):
    """Parts in force; none where nothing was committed."""
    store, place = store_of(folder.rstrip("/"))
    if not store.get_file_info(f"{place}/manifest.json").is_file:
        return {"parts": []}
    with store.open_input_file(f"{place}/manifest.json") as f:
        return json.loads(f.read())


class Part(InputPartition):
    def __init__(self, file, base, packed=False):
        self.file, self.base, self.packed = file, base, packed


class PackReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.table = options["path"].rstrip("/"), options.get("table", "lines")

    def partitions(self):
        held = manifest(self.folder)
        return [Part(p["file"], p["base"], held.get("packed", False)) for p in held["parts"]] or [Part(None, 0)]

    def read(self, part):
        if part.file is None:
            return
        store, place = store_of(self.folder)
        kind = "gz" if part.packed else "txt"
        with store.open_input_file(f"{place}/{part.file}.runs") as f:
            runs = pq.read_table(f).to_pylist()
        if self.table == "index":
            for i, r in enumerate(runs):
                yield (r["name"], f"{part.file}.{kind}", r["offset"], r["bytes"], part.base if i == 0 else 0, r["lines"])
            return
        with store.open_input_stream(f"{place}/{part.file}.{kind}", compression=None, buffer_size=MEMBER) as f:
            held, size = [], 0
            for i, r in enumerate(runs):
                at = part.base if i == 0 else 0
                for text in (_members if part.packed else _blocks)(f, r["bytes"]):
                    held.append((r["name"], at, text))
                    at, size = at + text.count(b"\n"), size + len(text)
                    if size > 4 * MEMBER:
                        yield _line_batch(held)
                        held, size = [], 0
            if held:
                yield _line_batch(held)


class LinePack(DataSource):
    @classmethod
    def name(cls):
        return "linepack"

    def schema(self):
        return ("name string, file string, offset bigint, bytes bigint, first_line bigint, lines bigint" if self.options.get("table") == "index"
                else "name string, line_no bigint, line string")

    def reader(self, schema):
        return PackReader(self.options)

    def writer(self, schema, overwrite):
        return PackWriter(self.options)


def _known(spark):
    """Make the source known. Spark looks it up in the active session, which a
    thread has only after a call such as createDataFrame."""
    spark.createDataFrame([], "name string")
    spark.dataSource.register(LinePack)


def write_lines(rows: DataFrame, folder: str, name: str, *order, lines=None, packed=False):
    """Write the ``line`` of each row under its ``name``, in the given order.

    Rows are dealt by ranges of name and order, so a text of any length goes to
    as many tasks as it needs and many short ones share a task. Short rows that
    stand for several lines are given with ``lines``, which turns rows in order
    to lines in order without a shuffle. A folder's former content is replaced
    when all is written. ``packed`` parts are compressed."""
    spark = rows.sparkSession
    _known(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a stated number is not merged again
    dealt = rows.repartitionByRange(parts, name, *order).sortWithinPartitions(name, *order)
    ((lines(dealt) if lines else dealt)
     .select(F.col(name).cast("string").alias("name"), F.col("line").cast("string").alias("line"))
     .write.format("linepack").option("path", folder).option("packed", str(packed).lower()).mode("overwrite").save())


def scan_lines(spark, folder: str, table="lines") -> DataFrame:
    """Lines of a pack (name, line_no, line), or its ``index`` of runs."""
    _known(spark)
    return spark.read.format("linepack").option("path", folder).option("table", table).load()
