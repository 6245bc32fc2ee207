"""Height images, pictures and raw rasters."""

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW_BYTES = 256  # bytes of an array operation below which plain numbers are faster
STRIP = 1 << 16  # samples of an image that go on at once
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}  # fixed values: colour type to samples per pixel


def png16_samples(data: bytes) -> np.ndarray:
    """First channel of a 16-bit PNG as a height x width array."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    width, height, depth, colour = struct.unpack(">IIBB", data[16:26])
    if depth != 16 or colour not in CHANNELS:
        raise ValueError(f"depth {depth}, colour type {colour}")
    at, packed = 8, []
    while at + 8 <= len(data):
        size, = struct.unpack(">I", data[at:at + 4])
        if data[at + 4:at + 8] == b"IDAT":
            packed.append(data[at + 8:at + 8 + size])
        at += size + 12
    step = 2 * CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * step)
    kinds, lines = raw[:, 0], raw[:, 1:].reshape(height, width, step).astype(np.int16)
    if height and kinds.max() > 4:
        raise ValueError(f"row filter {kinds.max()}")
    full = unfiltered(kinds, lines)
    return full[:, :, 0].astype(np.int64) * 256 + full[:, :, 1]


def _unfiltered_row(kind, line, above):
    """Bytes (width x bytes of a pixel) of one row with filter 1, 3 or 4. ``above`` has one pixel of zeros before the row."""
    if kind == 1:
        return np.cumsum(line, axis=0, dtype=np.int64) & 255
    out = np.empty_like(line)
    for c in range(line.shape[1]):
        left, corner, done = 0, 0, []
        for v, up in zip(line[:, c].tolist(), above[1:, c].tolist()):
            if kind == 3:
                left = (v + ((left + up) >> 1)) & 255
            else:
                a, b, d = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
                left = (v + (left if a <= b and a <= d else up if b <= d else corner)) & 255
            corner = up
            done.append(left)
        out[:, c] = done
    return out


def unfiltered(kinds, lines):
    """Bytes of an image from its filtered rows (height x width x bytes of a pixel).

    Long runs of rows that look left (filters 1, 3 and 4) are undone along
    anti-diagonals: all pixels whose left, upper and upper left neighbours are
    known form one array operation, so a run of rows takes width + rows steps.
    Where such an operation would hold few bytes, rows are undone one by one.
    """
    height, width, step = lines.shape
    out = np.zeros((height + 1, width + 1, step), np.int16)  # a row and a column of zeros go before
    y = 0
    while y < height:
        if kinds[y] in (0, 2):
            out[y + 1, 1:] = (lines[y] + (out[y, 1:] if kinds[y] == 2 else 0)) & 255
            y += 1
            continue
        end = y + 1
        while end < height and kinds[end] not in (0, 2):
            end += 1
        if (end - y) * step < FEW_BYTES:
            for r in range(y, end):
                out[r + 1, 1:] = _unfiltered_row(kinds[r], lines[r], out[r])
            y = end
            continue
        rows = np.arange(y, end)
        for d in range(width + len(rows) - 1):
            r = rows[max(0, d - width + 1):d + 1]
            x = d - (r - y)
            left, up, corner = out[r + 1, x], out[r, x + 1], out[r, x]
            far = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
            paeth = np.where((far[0] <= far[1]) & (far[0] <= far[2]), left, np.where(far[1] <= far[2], up, corner))
            kind = kinds[r][:, None]
            out[r + 1, x + 1] = (lines[r, x] + np.where(kind == 1, left, np.where(kind == 3, (left + up) >> 1, paeth))) & 255
        y = end
    return out[1:, 1:]


def _samples(frames):
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            v = png16_samples(content)
            tile = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            rows = max(1, STRIP // max(1, v.shape[1]))
            for at in range(0, len(v), rows):
                strip = v[at:at + rows]
                row, col = np.indices(strip.shape)
                yield pd.DataFrame({"tile": tile, "row": row.ravel() + at, "col": col.ravel(), "v": strip.ravel()})


def scan_heightmap_images(files: DataFrame) -> DataFrame:
    """Samples of 16-bit height PNGs (path, content): tile, row, col, v."""
    return files.mapInPandas(_samples, "tile string, row int, col int, v int")


def _pixels(frames):
    for frame in frames:
        for image in frame["image"]:
            n = image["nChannels"]
            px = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], n)
            row, col = np.indices(px.shape[:2])
            b, g, r = (px[:, :, 0],) * 3 if n == 1 else (px[:, :, 0], px[:, :, 1], px[:, :, 2])
            yield pd.DataFrame({"origin": image["origin"], "px_row": row.ravel(), "px_col": col.ravel(),
                                "r": r.ravel().astype("i4"), "g": g.ravel().astype("i4"), "b": b.ravel().astype("i4")})


def image_to_pixels(images: DataFrame, crop=None, step=1) -> DataFrame:
    """Pixel rows of ``spark.read.format("image")``, optionally cropped to
    (x0, y0, x1, y1) and thinned; pictures that cannot be read are left out."""
    px = images.filter("image.height > 0").select("image").mapInPandas(
        _pixels, "origin string, px_row int, px_col int, r int, g int, b int")
    if crop:
        px = px.filter(F.col("px_col").between(crop[0], crop[2] - 1) & F.col("px_row").between(crop[1], crop[3] - 1))
    return px.filter((F.col("px_row") % step == 0) & (F.col("px_col") % step == 0))


def _hex16(v):
    """Two hex bytes of a 16-bit number, low byte first; others are an error."""
    whole = v.cast("bigint")
    fits = F.when(whole.between(0, 65535), whole).otherwise(F.raise_error(
        F.concat(F.lit("not a 16-bit number: "), whole.cast("string"))).cast("bigint"))
    h = F.lpad(F.hex(fits), 4, "0")
    return F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2))


def pack_u16_tiles(samples: DataFrame, rows=64) -> DataFrame:
    """Little-endian rasters of strips of ``rows`` rows of each tile: tile, row0
    (the strip's first row), width, height, raster. A tile of any height is
    packed by as many tasks as it has strips."""
    lines = samples.groupBy("tile", "row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "v"))), lambda e: _hex16(e["v"])), "").alias("h"),
        F.count(F.lit(1)).alias("w"))
    strip = (F.floor(F.col("row") / rows) * rows).cast("int").alias("row0")
    return lines.groupBy("tile", strip).agg(
        F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "h"))), lambda e: e["h"]), "")).alias("raster"),
        F.max("w").cast("int").alias("width"), F.count(F.lit(1)).cast("int").alias("height"))


def write_u16_tiles(samples: DataFrame, folder: str):
    """Packed strips as a table of tile, row0, width, height, raster, in order."""
    packed = pack_u16_tiles(samples).repartitionByRange("tile", "row0").sortWithinPartitions("tile", "row0")
    packed.write.mode("overwrite").parquet(folder)


def scan_u16_tiles(rasters: DataFrame) -> DataFrame:
    """Samples of packed strips, or of whole tiles without ``row0``; a raster of
    the wrong length is refused."""
    if "row0" not in rasters.columns:
        rasters = rasters.withColumn("row0", F.lit(0))
    size = F.col("width") * F.col("height")
    checked = rasters.withColumn("raster", F.when(F.length("raster") == size * 2, F.col("raster")).otherwise(
        F.raise_error(F.lit("raster length does not match its resolution")).cast("binary")))
    one = checked.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("height") - 1))) \
        .withColumn("line", F.expr("substring(raster, i * width * 2 + 1, width * 2)"))
    cells = one.select("tile", (F.col("row0") + F.col("i")).alias("row"), "line", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("col"))
    return cells.select("tile", "row", "col", _number16_at("line", "col", 2, 0).alias("v"))


def _number16_at(binary, index, width, offset):
    return F.expr(f"CAST(conv(hex(concat(substring({binary}, {index} * {width} + {offset} + 2, 1), "
                  f"substring({binary}, {index} * {width} + {offset} + 1, 1))), 16, 10) AS INT)")


def pack_instances(named: DataFrame, cell=512) -> DataFrame:
    """Six-byte records (x and z in the cell, y) per cell, name and chunk. A
    chunk bounds the record count, however full its cell is."""
    from ..operators.voxels import floor_div, with_chunk
    p = with_chunk(named).withColumn("cell_x", floor_div(F.col("x"), cell)).withColumn("cell_z", floor_div(F.col("z"), cell))
    rec = F.struct("y", (F.col("z") - F.col("cell_z") * cell).alias("lz"), (F.col("x") - F.col("cell_x") * cell).alias("lx"))
    g = p.groupBy("cell_x", "cell_z", "name", "cx", "cz").agg(F.array_sort(F.collect_list(rec)).alias("recs"))
    text = F.transform("recs", lambda e: F.concat(_hex16(e["lx"]), _hex16(e["lz"]), _hex16(e["y"])))
    return g.select("cell_x", "cell_z", "name", "cx", "cz", F.size("recs").alias("n"), F.unhex(F.array_join(text, "")).alias("records"))


def unpack_instances(packed: DataFrame, z_offset_cm=0.0) -> DataFrame:
    """Centred engine positions, relative to the cell, of packed records."""
    each = packed.withColumn("i", F.explode(F.sequence(F.lit(0), F.floor(F.length("records") / 6).cast("int") - 1)))
    lx, lz, y = (_number16_at("records", "i", 6, o) for o in (0, 2, 4))
    return each.select("cell_x", "cell_z", "name", (lx * 100.0 + 50.0).alias("ux"), (lz * 100.0 + 50.0).alias("uy"),
                       (y * 100.0 + 50.0 + z_offset_cm).alias("uz"))
