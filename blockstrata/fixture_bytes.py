"""Bytes of source files for checks, made in tasks from derived tables."""

import gzip
import os
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .session import shared_folder
from .sources.voxel_files import CHUNK, HEADER


def scratch(spark, name):
    """Path of a new folder for files of this session, in the shared folder."""
    return f"{shared_folder(spark).removeprefix('file:')}/{name}-{uuid.uuid4().hex}"


def nbt_bytes(value, name=""):
    """Tagged binary text of nested dicts, lists, texts, ints and arrays."""
    def text(t):
        b = t.encode()
        return struct.pack(">H", len(b)) + b

    def tag(v):
        kinds = {dict: 10, list: 9, str: 8, int: 3, bool: 1}
        if isinstance(v, np.ndarray):
            return {np.dtype("i4"): 11, np.dtype("i8"): 12}[v.dtype]
        return kinds.get(type(v), 4)

    def body(v):
        t = tag(v)
        if t == 10:
            return b"".join(bytes([tag(x)]) + text(k) + body(x) for k, x in v.items()) + b"\0"
        if t == 9:
            return bytes([tag(v[0]) if v else 0]) + struct.pack(">i", len(v)) + b"".join(map(body, v))
        if t in (11, 12):
            return struct.pack(">i", v.size) + v.astype(v.dtype.newbyteorder(">")).tobytes()
        return text(v) if t == 8 else struct.pack({1: ">b", 3: ">i", 4: ">q"}[t], v)

    return b"\x0a" + text(name) + body(value)


def pack_numbers(values, bits):
    """Longs that each hold floor(64 / bits) whole numbers, low bits first."""
    per = 64 // bits
    padded = np.zeros(-(-len(values) // per) * per, np.uint64)
    padded[:len(values)] = values
    shifts = (np.arange(per) * bits).astype(np.uint64)
    return np.bitwise_or.reduce(padded.reshape(-1, per) << shifts, axis=1).view(np.int64)


def _chunk(key, rows):
    sections = []
    for sy, part in rows.groupby(rows["y"] // 16):
        states = [("minecraft:air", "")] + sorted(set(zip(part["name"], part["properties"])))
        number = {s: i for i, s in enumerate(states)}
        cells = np.zeros(4096, np.int64)
        at = (part["y"] % 16) * 256 + (part["z"] % 16) * 16 + part["x"] % 16
        cells[at] = [number[s] for s in zip(part["name"], part["properties"])]
        palette = [{"Name": n, **({"Properties": dict(kv.split("=") for kv in p.split(";"))} if p else {})} for n, p in states]
        bits = max(4, (len(states) - 1).bit_length())
        sections.append({"Y": int(sy), "Palette": palette, "BlockStates": pack_numbers(cells, bits)})
    doc = {"Level": {"Sections": sections, "Biomes": np.arange(1024, dtype="i4") % 7}}
    dim, cx, cz = key
    return pd.DataFrame({"dim": [dim], "cx": [cx], "cz": [cz], "ctype": [2], "payload": [zlib.compress(nbt_bytes(doc))]})


def chunk_payloads(named):
    """Compressed chunk documents of named voxels (dim, x, y, z, name, properties)."""
    from .operators.voxels import with_chunk
    return with_chunk(named).groupBy("dim", "cx", "cz").applyInPandas(
        _chunk, "dim string, cx int, cz int, ctype int, payload binary")


def _region(key, rows):
    dim, rx, rz = key
    table, blob = [0] * 1024, b""
    for cx, cz, ctype, payload in zip(rows["cx"], rows["cz"], rows["ctype"], rows["payload"]):
        data = struct.pack(">IB", len(payload) + 1, ctype) + payload
        table[(cz % 32) * 32 + cx % 32] = ((len(blob) // 4096 + 2) << 8) | -(-len(data) // 4096)
        blob += data + b"\0" * (-len(data) % 4096)
    content = struct.pack(">1024I", *table) + b"\0" * 4096 + blob
    return pd.DataFrame({"dim": [dim], "path": [f"/save/region/r.{rx}.{rz}.mca"], "content": [content]})


def region_archives(payloads):
    from .operators.voxels import floor_div
    return payloads.groupBy("dim", floor_div(F.col("cx"), 32).alias("rx"), floor_div(F.col("cz"), 32).alias("rz")) \
        .applyInPandas(_region, "dim string, path string, content binary")


def voxel_file_bytes(chunks, states, dim=0):
    """One voxel file. chunks: (cx, cz, local_to_global, words)."""
    palette = struct.pack("<I", len(states)) + b"".join(
        struct.pack("<HH", len(n.encode()), len(p.encode())) + n.encode() + p.encode() for n, p in states)
    table_at = HEADER.size + len(palette)
    at = table_at + sum(CHUNK.size + 4 * len(g) for _, _, g, _ in chunks)
    head = HEADER.pack(b"MC2WV2\0\0", 2, dim, b"\0\0\0", len(chunks), sum(len(w) for *_, w in chunks),
                       len(states), HEADER.size, table_at, at)
    table, body = b"", b""
    for cx, cz, to_global, words in chunks:
        table += CHUNK.pack(cx, cz, len(to_global), 0, len(words), at + len(body)) + np.asarray(to_global, "<u4").tobytes()
        body += np.asarray(words, "<u4").tobytes()
    return head + palette + table + body


def write_voxel_files(packed, states, folder):
    """One file per region, written by its task; gives the paths. packed: cx,
    cz, word, local_to_global; states: (name, properties) by palette id."""
    def write(key, rows):
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/r_{key[0]}_{key[1]}.bin"
        chunks = [(cx, cz, part["local_to_global"].iloc[0], part["word"].to_numpy()) for (cx, cz), part in rows.groupby(["cx", "cz"])]
        with open(path, "wb") as f:
            f.write(voxel_file_bytes(chunks, states))
        return pd.DataFrame({"path": [path]})

    from .operators.voxels import floor_div
    return packed.groupBy(floor_div(F.col("cx"), 32), floor_div(F.col("cz"), 32)).applyInPandas(write, "path string")


def png_bytes(lines, width, depth, colour, step, kinds=(0, 1, 2, 3, 4)):
    """PNG of raw lines, each filtered with the next kind in turn."""
    raw, above = [], np.zeros(width * step, np.int64)
    for y, line in enumerate(lines):
        cur = np.frombuffer(line, np.uint8).astype(np.int64)
        left, corner = np.concatenate([np.zeros(step, np.int64), cur[:-step]]), np.concatenate([np.zeros(step, np.int64), above[:-step]])
        p = left + above - corner
        near = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left,
                        np.where(abs(p - above) <= abs(p - corner), above, corner))
        kind = kinds[y % len(kinds)]
        guess = [np.zeros_like(cur), left, above, (left + above) >> 1, near][kind]
        raw.append(bytes([kind]) + ((cur - guess) & 255).astype(np.uint8).tobytes())
        above = cur

    def part(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", width, len(lines), depth, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(b"".join(raw))) + part(b"IEND", b"")


def _height_png(key, rows):
    grid = rows.pivot(index="row", columns="col", values="v").to_numpy().astype(">u2")
    data = png_bytes([r.tobytes() for r in grid], grid.shape[1], 16, 0, 2)
    return pd.DataFrame({"path": [f"/tiles/{key[0]}.png"], "content": [data]})


def height_pngs(samples):
    return samples.groupBy("tile").applyInPandas(_height_png, "path string, content binary")


def write_pictures(pixels, folder):
    """One 8-bit colour PNG per image, written by its task; gives the paths."""
    def write(key, rows):
        os.makedirs(folder, exist_ok=True)
        rows = rows.sort_values(["px_row", "px_col"])
        height = rows["px_row"].max() + 1
        grid = rows[["r", "g", "b"]].to_numpy().astype(np.uint8).reshape(height, -1)
        path = f"{folder}/{key[0]}.png"
        with open(path, "wb") as f:
            f.write(png_bytes([r.tobytes() for r in grid], grid.shape[1] // 3, 8, 2, 3))
        return pd.DataFrame({"path": [path]})
    return pixels.groupBy("image_id").applyInPandas(write, "path string")


def _world_record(frames):
    for f in frames:
        docs = [gzip.compress(nbt_bytes({"Data": {
            "LevelName": n, "GameType": int(k % 5), "Difficulty": 2, "hardcore": bool(k % 2), "DataVersion": 2586,
            "Version": {"Name": "1.16.5", "Id": 2586}, "SpawnX": int(k), "SpawnY": 64, "SpawnZ": int(-k),
            "WorldGenSettings": {"seed": np.int64(k * 1_000_003)}, "LastPlayed": np.int64(k), "Time": np.int64(k * 20),
            "DayTime": np.int64(k % 24000), "WasModded": True, "initialized": True}})) if k % 10 else b"broken"
            for n, k in zip(f["name"], f["k"])]
        yield pd.DataFrame({"path": f["name"], "content": docs})


def world_records(named_keys):
    return named_keys.mapInPandas(_world_record, "path string, content binary")
