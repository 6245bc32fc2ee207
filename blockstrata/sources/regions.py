"""Saved worlds: region archives to sections to voxels, and world records.

Archives are sliced into one row per stored chunk first, so decoding spreads
over all tasks however few or large the files are. Only bytes are read in
Python; unpacking the block numbers is done by column expressions.
"""

import gzip
import struct

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from . import nbt

SLOTS = "dim string, rx int, rz int, cx int, cz int, ctype int, payload binary, error string"
SECTIONS = ("dim string, cx int, cz int, sy int, palette array<struct<name:string,properties:string>>, "
            "longs array<bigint>, biomes array<int>, error string")


def region_files(spark: SparkSession, root: str) -> DataFrame:
    """Archive files of every dimension of a save: dim, path, content. A
    dimension that was never visited has no folder and gives no rows."""
    out = spark.createDataFrame([], "dim string, path string, content binary")
    for dim, folder in V.DIMENSION_DIRS:
        try:
            files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.mca")
                     .option("recursiveFileLookup", "false").load("/".join(p for p in (root, folder, "region") if p)))
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            continue
        out = out.unionByName(files.select(F.lit(dim).alias("dim"), "path", "content"))
    return out


def _slots(frames):
    for frame in frames:
        rows = []
        for dim, path, content in zip(frame["dim"], frame["path"], frame["content"]):
            rx, rz = (int(v) for v in path.rsplit("/", 1)[-1].split(".")[1:3])
            if len(content) < 4096:
                rows.append((dim, rx, rz, None, None, None, None, "short header"))
                continue
            for slot, entry in enumerate(struct.unpack(">1024I", content[:4096])):
                if entry >> 8 == 0:
                    continue
                at = (entry >> 8) * 4096
                cx, cz = rx * 32 + slot % 32, rz * 32 + slot // 32
                head = content[at:at + 5]
                if len(head) < 5:
                    rows.append((dim, rx, rz, cx, cz, None, None, "truncated chunk header"))
                    continue
                size = int.from_bytes(head[:4], "big")
                rows.append((dim, rx, rz, cx, cz, head[4], content[at + 5:at + 4 + size], None))
        out = pd.DataFrame(rows, columns=["dim", "rx", "rz", "cx", "cz", "ctype", "payload", "error"])
        yield out.astype({c: "Int32" for c in ("rx", "rz", "cx", "cz", "ctype")})


def scan_region_archives(files: DataFrame) -> DataFrame:
    """One row per stored chunk, errors kept as rows of their own."""
    return files.filter(F.col("path").rlike(r"\.-?[0-9]+\.-?[0-9]+\.mca$")).mapInPandas(_slots, SLOTS)


def _key(props):
    return ";".join(f"{k}={props[k]}" for k in sorted(props or {}))


def _sections(frames):
    for frame in frames:
        rows = []
        for dim, cx, cz, ctype, payload in zip(*[frame[c] for c in ("dim", "cx", "cz", "ctype", "payload")]):
            try:
                root = nbt.read(nbt.inflate(payload, ctype))
                level = root.get("Level", root)
                biomes = level.get("Biomes")
                biomes = [int(b) & 255 for b in biomes] if biomes is not None and len(biomes) in (256, 1024) else None
                for s in level.get("Sections", []):
                    palette = [{"name": p["Name"], "properties": _key(p.get("Properties"))} for p in s.get("Palette", [])]
                    longs = s.get("BlockStates")
                    rows.append((dim, cx, cz, int(s["Y"]), palette, None if longs is None else longs.tolist(), biomes, None))
                    biomes = None
            except Exception as exc:
                rows.append((dim, cx, cz, None, None, None, None, repr(exc)))
        out = pd.DataFrame(rows, columns=["dim", "cx", "cz", "sy", "palette", "longs", "biomes", "error"])
        yield out.astype({c: "Int32" for c in ("cx", "cz", "sy")})


def decode_chunks(slots: DataFrame, tasks=None) -> DataFrame:
    """Section rows of every chunk; a chunk's biome list goes with its first
    section. A chunk that cannot be read becomes a row with ``error``."""
    good = slots.filter("payload IS NOT NULL")
    spread = good.repartition(tasks, "dim", "cx", "cz") if tasks else good.repartition("dim", "cx", "cz")
    return spread.mapInPandas(_sections, SECTIONS)


def unpack_sections(sections: DataFrame) -> DataFrame:
    """Voxels without air. Each long holds floor(64 / bits) whole numbers;
    missing longs read as zero, which also covers sections of one state that
    store none."""
    n = F.size("palette")
    s = sections.filter("error IS NULL AND size(palette) > 0 AND (longs IS NOT NULL OR size(palette) = 1)") \
        .withColumn("bits", F.greatest(F.lit(4), F.length(F.bin(n - 1)))) \
        .withColumn("per", F.floor(F.lit(64) / F.col("bits")).cast("int"))
    need = F.ceil(F.lit(4096) / F.col("per")).cast("int")
    have = F.coalesce("longs", F.array().cast("array<bigint>"))
    padded = F.slice(F.concat(have, F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(0), need - F.size(have)))), 1, need)
    words = s.select("dim", "cx", "cz", "sy", "palette", "bits", "per", F.posexplode(padded).alias("word_no", "word"))
    parts = words.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("per") - 1))) \
        .withColumn("i", F.col("word_no") * F.col("per") + F.col("k")).filter("i < 4096") \
        .withColumn("state", F.get("palette", F.expr("CAST(shiftrightunsigned(word, k * bits) & (shiftleft(1L, bits) - 1) AS INT)")))
    return parts.filter(~F.col("state.name").isin(V.AIR_NAMES)).select(
        "dim", (F.col("cx") * 16 + F.col("i") % 16).alias("x"),
        (F.col("sy") * 16 + F.floor(F.col("i") / 256)).cast("int").alias("y"),
        (F.col("cz") * 16 + F.floor(F.col("i") / 16).cast("int") % 16).alias("z"), "state.name", "state.properties")


WORLD = """path string, level_name string, game_type int, game_type_name string, difficulty int, hardcore boolean,
 data_version int, version_name string, spawn struct<x:int,y:int,z:int>, seed bigint, last_played_ms bigint,
 time bigint, day_time bigint, was_modded boolean, initialized boolean, error string"""


def _worlds(frames):
    for frame in frames:
        rows = []
        for path, content in zip(frame["path"], frame["content"]):
            try:
                d = nbt.read(gzip.decompress(content))["Data"]
                flag = lambda k: bool(d[k]) if k in d else None
                rows.append((path, d.get("LevelName"), d.get("GameType"), V.GAME_TYPES.get(d.get("GameType"), "unknown"),
                             d.get("Difficulty"), flag("hardcore"), d.get("DataVersion"), d.get("Version", {}).get("Name"),
                             {"x": d.get("SpawnX"), "y": d.get("SpawnY"), "z": d.get("SpawnZ")},
                             d.get("WorldGenSettings", {}).get("seed"), d.get("LastPlayed"), d.get("Time"), d.get("DayTime"),
                             flag("WasModded"), flag("initialized"), None))
            except Exception as exc:
                rows.append((path,) + (None,) * 14 + (repr(exc),))
        names = [p.strip().split(" ")[0] for p in WORLD.replace("x:int,y:int,z:int", "").replace("\n", " ").split(",")]
        yield pd.DataFrame(rows, columns=names).astype(
            {**{c: "Int32" for c in ("game_type", "difficulty", "data_version")},
             **{c: "Int64" for c in ("seed", "last_played_ms", "time", "day_time")},
             **{c: "boolean" for c in ("hardcore", "was_modded", "initialized")}})


def scan_worlds(files: DataFrame) -> DataFrame:
    """One typed row per world record file (path, content)."""
    return files.mapInPandas(_worlds, WORLD)
