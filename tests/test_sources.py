import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockstrata import fixture_bytes as B
from blockstrata.functions import rules
from blockstrata.operators import census as C
from blockstrata.operators import voxels as X
from blockstrata.sources import images as I
from blockstrata.sources import regions as G
from blockstrata.sources.text import obj_line_census
from blockstrata.sources.voxel_files import read_header, scan_voxel_file
from blockstrata.streaming import frames as T


@pytest.mark.parametrize("states", [9, 17, 33, 65, 129, 257, 4000])
def test_packed_numbers_round_trip(spark, states):
    rng = random.Random(states)
    numbers = [rng.randrange(1, states) for _ in range(4096)]
    bits = max(4, (states - 1).bit_length())
    longs = B.pack_numbers(np.array(numbers), bits).tolist()
    palette = [("minecraft:air", "")] + [(f"b{i}", "") for i in range(1, states)]
    df = spark.createDataFrame([("overworld", -1, 2, 3, palette, longs, None, None)], G.SECTIONS)
    got = {(r["x"], r["y"], r["z"]): r["name"] for r in G.unpack_sections(df).collect()}
    want = {(-16 + i % 16, 48 + i // 256, 32 + i // 16 % 16): f"b{n}" for i, n in enumerate(numbers)}
    assert got == want


def test_uniform_and_short_sections(spark):
    rows = [("overworld", 0, 0, 0, [("stone", "")], None, None, None),
            ("overworld", 1, 0, 0, [("stone", ""), ("dirt", "")], None, None, None),
            ("overworld", 2, 0, 0, [("stone", ""), ("dirt", "")], [1], None, None)]
    got = G.unpack_sections(spark.createDataFrame(rows, G.SECTIONS)).groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in got} == {"stone": 4096 + 4095, "dirt": 1}


def test_bad_archives_become_rows(spark):
    slot = struct.pack(">I", (2 << 8) | 1) + b"\0" * 4092
    files = spark.createDataFrame([
        ("overworld", "/r.0.0.mca", bytearray(b"x")), ("overworld", "/r.-1.2.mca", bytearray(slot + b"\0" * 4096)),
        ("overworld", "/r.3.3.mca", bytearray(slot + b"\0" * 4096 + struct.pack(">IB", 4, 9) + b"abc")),
        ("overworld", "/notes.mca", bytearray(b""))], "dim string, path string, content binary")
    slots = G.scan_region_archives(files)
    assert {r["error"] for r in slots.collect()} == {"short header", "truncated chunk header", None}
    assert "unknown compression 9" in G.decode_chunks(slots).first()["error"]


def test_voxel_file_and_its_header(spark, tmp_path):
    states = [("minecraft:air", ""), ("minecraft:stone", ""), ("minecraft:oak_log", "axis=y")]
    words = [5 | 3 << 4 | 300 << 8 | 1 << 17, 0 | 15 << 4 | 7 << 8 | 0 << 17]
    path = tmp_path / "world.bin"
    path.write_bytes(B.voxel_file_bytes([(-2, 4, [1, 2], words), (0, 0, [0], [0])], states, dim=1))
    got = sorted((r["dim"], r["x"], r["y"], r["z"], r["name"], r["properties"]) for r in scan_voxel_file(spark, str(path)).collect())
    assert got == [("nether", -32, 7, 79, "minecraft:stone", ""), ("nether", -27, 300, 67, "minecraft:oak_log", "axis=y")]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    near = scan_voxel_file(spark, str(path)).filter("cx >= -1").count()
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert near == 0
    path.write_bytes(b"wrong" + b"\0" * 64)
    with open(path, "rb") as f, pytest.raises(ValueError):
        read_header(f)


@pytest.mark.parametrize("colour,channels", [(0, 1), (2, 3), (4, 2), (6, 4)])
def test_height_image_filters(colour, channels):
    rng = np.random.default_rng(colour)
    v = rng.integers(0, 65536, (11, 9, channels))
    data = B.png_bytes([r.astype(">u2").tobytes() for r in v], 9, 16, colour, 2 * channels)
    assert (I.png16_samples(data) == v[:, :, 0]).all()


def test_raster_of_wrong_length_is_refused(spark):
    df = spark.createDataFrame([("a", bytearray(b"\1\2\3"), 2, 1)], "tile string, raster binary, width int, height int")
    with pytest.raises(Exception, match="raster length"):
        I.scan_u16_tiles(df).collect()


def test_word_overflow_is_flagged(spark):
    df = spark.createDataFrame([(1, 2, 511, 32767), (1, 2, 512, 0), (0, 0, 0, 32768)], "dx int, dz int, y int, local_index int")
    rows = X.pack_voxel_word(df).collect()
    assert [r["overflow"] for r in rows] == [False, True, True]
    assert rows[0]["word"] == 1 | 2 << 4 | 511 << 8 | 32767 << 17


def test_bucket_counts(spark):
    named = [(0, 0, "stone")] * 10 + [(0, 0, "dirt")] + [(600, 0, "stone")] * 3
    b = C.cell_buckets(spark.createDataFrame(named, "x int, z int, name string"))
    s = C.bucket_summary(b).first()
    assert (s["groups"], s["cells"], s["instances"], s["components"]) == (3, 2, 14, 3)
    big = spark.createDataFrame([(0, 0, "a", 1_200_000)], "cell_x int, cell_z int, name string, n long")
    assert C.bucket_summary(big).first()["components"] == 3


ALPHA = {"stone": "opaque", "glass": "transparent", "water": "transparent", "oak_leaves": "masked", "glass_pane": "masked",
         "iron_bars": "masked", "grass": "masked"}


def test_alpha_modes_and_labels(spark):
    names = spark.createDataFrame([("minecraft:" + n,) for n in ALPHA], "name string")
    got = {r[0]: r[1] for r in names.select(rules.strip_ns(F.col("name")), rules.alpha_mode(F.col("name"))).collect()}
    assert got == ALPHA
    labels = {"bedrock": "BEDROCK", "grass_block": "TERRAIN", "oak_wood": "STRUCTURE", "oak_log": "VEGETATION", "mystery": "TERRAIN"}
    df = spark.createDataFrame([("minecraft:" + n, v) for n, v in labels.items()], "name string, want string")
    assert df.filter(rules.semantic_label(F.col("name")) != F.col("want")).count() == 0


def test_obj_census_counts_negative_zero_and_cr(spark):
    lines = ["v 0 0 0", "vn -0.000 0.000 1.000", "vn 0.000 -0.500 1.000", "usemtl a", "f 1/1/1 2/2/2 3/3/3 4/4/4", "f 1/1/1 2/2/2 3/3/3\r"]
    r = obj_line_census(spark.createDataFrame([("a", t) for t in lines], "file string, line string")).first()
    assert (r["n_v"], r["n_vn"], r["n_f"], r["triangles"], r["negative_zeros"], r["cr"]) == (1, 2, 2, 3, 1, 1)


def test_stream_and_batch_windows_agree(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"s{i % 3}", 1_700_000_000 + i // 30, float(rng.randrange(1, 90))) for i in range(3000)]
    df = spark.createDataFrame(rows, "session string, sec long, ms double").withColumn("ts", F.timestamp_seconds("sec"))
    for i in range(3):
        df.filter(F.col("sec").between(1_700_000_000 + i * 34, 1_700_000_033 + i * 34)).coalesce(1) \
            .write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = T.stream_frame_time_windows(stream, "session", 1, "1 minute", ring=8).writeStream.format("memory").queryName("frames") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r["key"], r["start"]): (r["n"], r["min_ms"], r["max_ms"]) for r in spark.table("frames").collect()}
    batch = T.frame_time_windows(df, "session", "1 second", ring=8).collect()
    want = {(r["session"], r["start"]): (r["n"], r["min_ms"], r["max_ms"]) for r in batch}
    assert got and all(want[k][0] == v[0] for k, v in got.items())


def test_broken_payload_is_reported(spark):
    df = spark.createDataFrame([("overworld", 0, 0, 0, 0, 2, bytearray(zlib.compress(b"\x0a\0\0\x63")), None)], G.SLOTS)
    assert G.decode_chunks(df).first()["error"].startswith("error(")


def test_range_reads_open_only_their_regions(spark, tmp_path):
    from blockstrata.sources import text
    rows = [("end", x, 1, z, 3) for x in range(-600, 600, 40) for z in range(-600, 600, 40)]
    text.write_voxels(spark.createDataFrame(rows, "dim string, x int, y int, z int, palette_id int"), str(tmp_path / "t"))
    got = text.scan_bounded(spark, str(tmp_path / "t"), (-50, 70), (-10, 600), "end")
    assert sorted((r["x"], r["z"]) for r in got.collect()) == [(x, z) for _, x, _, z, _ in rows if -50 <= x <= 70 and -10 <= z <= 600]
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    parts, pushed = [next(line for line in plan.splitlines() if line.startswith(k)) for k in ("PartitionFilters", "PushedFilters")]
    assert "rx" in parts and "rz" in parts and "dim" in parts and "cx" in pushed and "cz" in pushed


def test_missing_dimensions_are_empty(spark, tmp_path):
    from blockstrata.sources import regions
    (tmp_path / "region").mkdir()
    (tmp_path / "region" / "r.0.0.mca").write_bytes(b"\0" * 8192)
    assert [(r["dim"], len(r["content"])) for r in regions.region_files(spark, str(tmp_path)).collect()] == [("overworld", 8192)]


def test_packing_refuses_large_numbers(spark):
    import pytest

    from blockstrata.sources import images
    for v in (-2, 70_000):
        with pytest.raises(Exception, match="16-bit"):
            images.pack_u16_tiles(spark.createDataFrame([("t", 0, 0, v)], "tile string, row int, col int, v int")).collect()


def test_chunk_bounds_reach_the_reader(spark, tmp_path):
    from blockstrata.sources import text
    rows = [("end", x, 1, z, 3) for x in range(-600, 600, 40) for z in range(-600, 600, 40)]
    text.write_voxels(spark.createDataFrame(rows, "dim string, x int, y int, z int, palette_id int"), str(tmp_path / "t"))
    got = X.prune_chunks(spark.read.parquet(str(tmp_path / "t")), (-41, 70), (-1, 600))
    want = [(x, z) for _, x, _, z, _ in rows if x // 16 * 16 <= 70 and x // 16 * 16 + 15 >= -41 and z // 16 * 16 <= 600 and z // 16 * 16 + 15 >= -1]
    assert sorted((r["x"], r["z"]) for r in got.collect()) == want
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    parts, pushed = [next(line for line in plan.splitlines() if line.startswith(k)) for k in ("PartitionFilters", "PushedFilters")]
    assert all(f"GreaterThanOrEqual({c},{v})" in pushed for c, v in (("cx", -3), ("cz", -1))) and "rx" in parts and "rz" in parts


def test_only_wanted_chunks_are_read(spark, tmp_path, monkeypatch):
    from blockstrata.sources import voxel_files as VF
    states = [("minecraft:air", ""), ("minecraft:stone", "")]
    chunks = [(cx, cz, [0, 1], [1 << 17 | cx & 15] * 3) for cx in range(4) for cz in range(3)]
    path = tmp_path / "w.bin"
    path.write_bytes(B.voxel_file_bytes(chunks, states, dim=0))
    index = VF.chunk_index(spark, str(tmp_path))
    assert sorted((r["cx"], r["cz"], r["n"], r["states"]) for r in index.collect()) == [(a, b, 3, [0, 1]) for a in range(4) for b in range(3)]
    for size in (4, 12, 10 ** 9):
        words = VF.chunk_words(index.where("cx > 1 AND cz = 2"), size)
        assert sorted((r["cx"], r["cz"], r["palette_id"]) for r in words.collect()) == [(2, 2, 1)] * 3 + [(3, 2, 1)] * 3
    assert VF.chunk_words(index.where("cx > 9")).count() == 0
    assert VF.scan_voxel_file(spark, str(tmp_path), cx=(1, 1), cz=(0, 1)).count() == 6
    reads = []
    with open(path, "rb") as f:
        head = read_header(f)

        class Counted:
            seek = f.seek

            def read(self, n=-1):
                reads.append(n)
                return f.read(n)
        assert len(list(VF.read_chunk_table(Counted(), head))) == 12
    assert len(reads) == 1


def test_large_paeth_image_is_read_fast():
    import time
    rng = np.random.default_rng(5)
    lines = rng.integers(0, 256, (2017, 2017, 2)).astype(np.int16)
    kinds = rng.choice([3, 4, 4, 4, 1], 2017)
    start = time.time()
    got = I.unfiltered(kinds, lines)
    assert time.time() - start < 6
    above = np.zeros((2018, 2), np.int64)
    for y in range(3):  # the first rows pixel by pixel
        row = np.zeros((2018, 2), np.int64)
        for x in range(2017):
            for c in range(2):
                a, b, d = row[x, c], above[x + 1, c], above[x, c]
                far = abs(b - d), abs(a - d), abs(a + b - 2 * d)
                guess = {1: a, 3: (a + b) >> 1, 4: a if far[0] <= far[1] and far[0] <= far[2] else b if far[1] <= far[2] else d}[int(kinds[y])]
                row[x + 1, c] = (lines[y, x, c] + guess) & 255
        assert (got[y] == row[1:]).all()
        above = row


def test_pictures_of_other_sizes_do_not_match(spark):
    from blockstrata.operators import pixels as P
    left = [(1, y, x, 10, 20, 30) for y in range(3) for x in range(3)]
    right = [(1, y, x, 10, 20 + 9 * (x == 1), 31) for y in range(2) for x in range(4)]
    table = "pair int, px_row int, px_col int, r int, g int, b int"
    r = P.image_diff(spark.createDataFrame(left, table), spark.createDataFrame(right, table)).first()
    assert (r["unmatched"], r["max"], r["changed"], r["over_8"], r["total"]) == (3 + 2, 9, 6, 2, 11)
