"""Lines appended to growing files, as a streaming source with byte offsets.

``spark.readStream.format("linetail").option("path", p).load()`` follows a file
or all files of a folder: rows of file, at (byte where the line begins) and
line. An offset of the stream says for each file how far its whole lines have
been read and how its first line reads. A file that has become shorter, or
begins with another line, is new and read from its begin; one that was renamed
goes on where it was. A line without its end is left for later. Files may be in
any store that pyarrow.fs opens and all workers see.
"""

import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.voxel_files import store_of

STEP = 1 << 20


def last_end(f, size):
    """Byte after the last line end before ``size``; 0 without one."""
    hi = size
    while hi > 0:
        lo = max(0, hi - STEP)
        f.seek(lo)
        found = f.read(hi - lo).rfind(b"\n")
        if found >= 0:
            return lo + found + 1
        hi = lo
    return 0


def first_line(f, size):
    """Fingerprint of the first line, of which ``size`` bytes at most are read."""
    f.seek(0)
    mark, read = 0, 0
    while read < size:
        part = f.read(min(STEP, size - read))
        cut = part.find(b"\n")
        mark = zlib.crc32(part if cut < 0 else part[:cut], mark)
        if cut >= 0 or not part:
            break
        read += len(part)
    return mark


class Part(InputPartition):
    """Lines of a file that begin from ``lo`` on and before ``hi``; ``end`` is where whole lines end."""

    def __init__(self, path, lo, hi, end):
        self.path, self.lo, self.hi, self.end = path, lo, hi, end


class TailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.bytes_per_task = int(options.get("bytesPerTask", "32000000"))

    def initialOffset(self):
        return {}

    def latestOffset(self):
        store, path = store_of(self.path)
        found = store.get_file_info(path)
        folder = found.type == fs.FileType.Directory
        files = [f for f in store.get_file_info(fs.FileSelector(path)) if f.is_file] if folder else [found] if found.is_file else []
        out = {}
        for info in files:
            if info.base_name[0] in "._":
                continue
            with store.open_input_file(info.path) as f:
                end = last_end(f, info.size)
                if end:
                    out[info.base_name] = [end, first_line(f, end)]
        return out

    def partitions(self, start, end):
        begins = {}
        for name, (stop, mark) in end.items():
            read, same = start.get(name, (0, None))
            if same != mark or read > stop:
                moved = [n for n, m in start.values() if m == mark and n <= stop]
                stays = [n for k, (n, m) in start.items() if m == mark and end.get(k, (0, None))[1] == mark]
                read = max(moved) if moved and not stays else 0
            begins[name] = read
        store, path = store_of(self.path)
        folder = store.get_file_info(path).type == fs.FileType.Directory
        parts = []
        for name, lo in sorted(begins.items()):
            stop, own = end[name][0], f"{self.path.rstrip('/')}/{name}" if folder else self.path
            while lo < stop:
                hi = min(stop, lo + self.bytes_per_task)
                parts.append(Part(own, lo, hi, stop))
                lo = hi
        return parts

    def read(self, part):
        name = part.path.rsplit("/", 1)[-1]
        store, path = store_of(part.path)
        with store.open_input_file(path) as f:
            at = part.lo
            if at:  # a line that has begun before belongs to the part before
                f.seek(at - 1)
                while True:
                    piece = f.read(min(STEP, part.end - at + 1))
                    cut = piece.find(b"\n")
                    if cut >= 0 or not piece:
                        at += cut
                        break
                    at += len(piece)
            f.seek(at)
            rest = b""
            begin = at
            while begin < part.hi:
                piece = f.read(min(STEP, part.end - at))
                at += len(piece)
                lines = (rest + piece).split(b"\n")
                rest = lines.pop()
                starts = []
                for line in lines:
                    if begin >= part.hi:
                        break
                    starts.append(begin)
                    begin += len(line) + 1
                if starts:
                    texts = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines[:len(starts)]]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(starts)), pa.array(starts, pa.int64()), pa.array(texts)], names=["file", "at", "line"])
                if not piece:
                    break

    def commit(self, end):
        pass


class LineTail(DataSource):
    @classmethod
    def name(cls):
        return "linetail"

    def schema(self):
        return "file string, at bigint, line string"

    def streamReader(self, schema):
        return TailReader(self.options)


def tail_lines(spark, path: str, bytes_per_task=None):
    """Stream of the lines of a file or of the files of a folder, each once."""
    spark.dataSource.register(LineTail)
    reader = spark.readStream.format("linetail").option("path", path)
    return (reader.option("bytesPerTask", str(bytes_per_task)) if bytes_per_task else reader).load()
