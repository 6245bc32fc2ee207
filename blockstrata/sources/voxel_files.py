"""Binary voxel files as a Spark data source.

A scan has two steps. ``chunk_index`` reads the chunk table of each file once,
as rows of file, cx, cz, voxels and the place of their words. ``chunk_words``
takes any part of such an index, deals it by bytes and reads runs of
neighbouring chunks with one request each; chunks that were filtered out of the
index are never read, whatever the session's settings are.

``spark.read.format("voxelfile").option("path", p)`` with the option ``table``
gives ``index``, ``palette`` (the block states) or ``header`` (the counts that
each header states) of a file or of all ``.bin`` files in a folder. Files may be
in any store that pyarrow.fs opens and all workers see.
"""

import os
import struct

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import fixed_values as V
from ..session import cut_lineage

# fixed values: layout of header and chunk table rows, little-endian
HEADER = struct.Struct("<8sIB3sQQQQQQ")
CHUNK = struct.Struct("<iiHHIQ")
DIMS = [name for name, _ in V.DIMENSION_DIRS]


def read_header(f):
    magic, version, dim, _, chunks, voxels, states, pal_at, tab_at, vox_at = HEADER.unpack(f.read(HEADER.size))
    if magic != V.VOXEL_FILE_MAGIC:
        raise ValueError("not a voxel file")
    if version != V.VOXEL_FILE_VERSION:
        raise ValueError(f"voxel file version {version}")
    return {"dim": DIMS[dim], "chunks": chunks, "voxels": voxels, "states": states,
            "palette_at": pal_at, "table_at": tab_at, "voxels_at": vox_at}


def read_palette(f, head):
    f.seek(head["palette_at"])
    n, = struct.unpack("<I", f.read(4))
    if n != head["states"]:
        raise ValueError("palette count differs from header")
    for i in range(n):
        a, b = struct.unpack("<HH", f.read(4))
        yield i, f.read(a).decode(), f.read(b).decode()


def read_chunk_table(f, head):
    """(cx, cz, voxels, place, global numbers of its states) of each chunk, the table read in one request."""
    f.seek(head["table_at"])
    data, at = f.read(max(0, head["voxels_at"] - head["table_at"])) if head["voxels_at"] > head["table_at"] else f.read(), 0
    for _ in range(head["chunks"]):
        cx, cz, states, _, n, place = CHUNK.unpack_from(data, at)
        at += CHUNK.size
        yield cx, cz, n, place, np.frombuffer(data, "<u4", states, at)
        at += 4 * states


def store_of(path):
    """File system and path within it of a plain path or a URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


class File(InputPartition):
    def __init__(self, path):
        self.path = path


INDEX = "path string, file string, dim string, cx int, cz int, n int, place bigint, states array<int>"


class VoxelReader(DataSourceReader):
    """Header, palette or chunk table of each file; one task a file, which reads only that table."""

    def __init__(self, options):
        self.path, self.table = options["path"], options.get("table", "index")

    def partitions(self):
        store, path = store_of(self.path)
        found = store.get_file_info(path)
        if found.type != fs.FileType.Directory:
            return [File(self.path)]
        files = [f.base_name for f in store.get_file_info(fs.FileSelector(path)) if f.is_file and f.path.endswith(".bin")]
        return [File(f"{self.path.rstrip('/')}/{name}") for name in sorted(files)] or [File(None)]

    def read(self, part):
        if part.path is None:
            return
        name = part.path.rsplit("/", 1)[-1]
        store, path = store_of(part.path)
        with store.open_input_file(path) as f:
            head = read_header(f)
            if self.table == "header":
                yield (name, head["dim"], head["chunks"], head["voxels"], head["states"])
            elif self.table == "palette":
                for state in read_palette(f, head):
                    yield (name, *state)
            else:
                for cx, cz, n, at, to_global in read_chunk_table(f, head):
                    yield (part.path, name, head["dim"], cx, cz, n, at, to_global.tolist())


class VoxelFile(DataSource):
    @classmethod
    def name(cls):
        return "voxelfile"

    def schema(self):
        return {"header": "file string, dim string, chunks bigint, voxels bigint, states bigint",
                "palette": "file string, palette_id int, name string, properties string"}.get(self.options.get("table"), INDEX)

    def reader(self, schema):
        return VoxelReader(self.options)


def _table(spark, path, table):
    spark.dataSource.register(VoxelFile)
    return spark.read.format("voxelfile").option("path", path).option("table", table).load()


def chunk_index(spark, path: str) -> DataFrame:
    """Chunk table of a file or folder: path, file, dim, cx, cz, n (voxels), place, states."""
    return _table(spark, path, "index")


def _words(batches):
    for batch in batches:
        rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("path", "place", "n", "file", "dim", "cx", "cz", "states"))))
        begin = 0
        while begin < len(rows):
            end = begin + 1
            while end < len(rows) and rows[end][0] == rows[begin][0] and rows[end][1] == rows[end - 1][1] + 4 * rows[end - 1][2]:
                end += 1
            store, path = store_of(rows[begin][0])
            with store.open_input_file(path) as f:
                for _, place, n, file, dim, cx, cz, states in rows[begin:end]:
                    if place != f.tell():
                        f.seek(place)
                    words = np.frombuffer(f.read(4 * n), "<u4")
                    to_global = np.array(states, dtype="i4")[(words >> 17) & V.MAX_LOCAL_INDEX] if n else np.zeros(0, "i4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * n, pa.string()), pa.array([dim] * n, pa.string()), pa.array(np.full(n, cx, "i4")),
                         pa.array(np.full(n, cz, "i4")), pa.array(words.astype("i8")), pa.array(to_global)],
                        names=["file", "dim", "cx", "cz", "word", "palette_id"])
            begin = end


def chunk_words(index: DataFrame, bytes_per_task=32_000_000) -> DataFrame:
    """Words of the chunks of an index: file, dim, cx, cz, word, palette_id.

    Chunks are dealt in the order of their place to tasks of about
    ``bytes_per_task`` bytes, whatever files they lie in."""
    index = cut_lineage(index)
    size = index.agg(F.sum(F.col("n").cast("bigint") * 4)).first()[0] or 0
    dealt = index.repartitionByRange(int(size // bytes_per_task) + 1, "path", "place")
    return dealt.mapInArrow(_words, "file string, dim string, cx int, cz int, word bigint, palette_id int")


def header_counts(spark, path: str):
    """Counts that the headers state: file, dim, chunks, voxels, states."""
    return _table(spark, path, "header")


def scan_voxel_file(spark, path: str, cx=None, cz=None):
    """Voxels without air, with their block state, of one file or folder; of
    the chunks cx[0]..cx[1], cz[0]..cz[1] where given. The join with the block
    states is the planner's: it broadcasts them only below its size limit."""
    from ..operators.voxels import voxel_word_fields, world_coords
    index = chunk_index(spark, path)
    for name, span in (("cx", cx), ("cz", cz)):
        if span is not None:
            index = index.filter(F.col(name).between(*span))
    voxels = world_coords(voxel_word_fields(chunk_words(index))).select("file", "dim", "cx", "cz", "x", "y", "z", "palette_id")
    solid = _table(spark, path, "palette").filter(~F.col("name").isin(V.AIR_NAMES))
    return voxels.join(cut_lineage(solid), ["file", "palette_id"])
