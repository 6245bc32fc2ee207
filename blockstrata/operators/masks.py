"""Voxels packed to bit words, and neighbours found by shifts.

A word is a 64-bit number for 16 x 1 x 4 cells: bit (z & 3) * 16 + (x & 15) of
word (x >> 4, y, z >> 2), four rows of a stored section. A table of words has
one row per word that holds a voxel. Neighbours inside a word are shifts of its
bits; those in the six words around it come by one grouping, for which every
word sends each of them the bits that touch it.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAGS = ["xm", "xp", "ym", "yp", "zm", "zp"]
KEY = ["wx", "y", "wz"]
ROWS = [0xFFFF << 16 * k for k in range(4)]


def _long(bits):
    """A literal of 64 bits, the last one the sign."""
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("bigint")


def _each_row(bits):
    return _long(sum(bits << 16 * k for k in range(4)))


def word_key(x="x", z="z"):
    """Columns that name the word of a cell; y belongs to the name as it is."""
    return [F.shiftright(x, 4).alias("wx"), F.shiftright(z, 2).alias("wz")]


def place(x="x", z="z") -> Column:
    """Bit of a cell in its word."""
    x, z = F.col(x), F.col(z)
    return (z.bitwiseAND(3) * 16 + x.bitwiseAND(15)).cast("int")


def packed_words(cells: DataFrame) -> DataFrame:
    """wx, y, wz, own: the words that hold a cell. Cells with a null coordinate have none."""
    named = cells.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL").select("y", *word_key(), place().alias("bit"))
    return named.groupBy(*KEY).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("own"))


def neighbour_words(cells: DataFrame) -> DataFrame:
    """Words with a mask per direction: the bits of the cells whose neighbour there is occupied."""
    m = F.col("own")

    def up(n):
        return F.shiftleft(m, n)

    def down(n):
        return F.shiftrightunsigned(m, n)

    def sent(wx=0, y=0, wz=0, **masks):
        names = {"wx": F.col("wx") + wx, "y": F.col("y") + y, "wz": F.col("wz") + wz}
        none = F.lit(None).cast("bigint")
        return F.struct(*[names[k].alias(k) for k in KEY], *[masks.get(f, none).alias(f) for f in ["own", *FLAGS]])
    parts = F.array(
        sent(own=m, xm=up(1).bitwiseAND(_each_row(0xFFFE)), xp=down(1).bitwiseAND(_each_row(0x7FFF)), zm=up(16), zp=down(16)),
        sent(wx=1, xm=down(15).bitwiseAND(_each_row(1))), sent(wx=-1, xp=up(15).bitwiseAND(_each_row(0x8000))),
        sent(wz=1, zm=down(48)), sent(wz=-1, zp=up(48)), sent(y=1, ym=m), sent(y=-1, yp=m))
    # Edges without a bit touch nothing.
    parts = F.filter(parts, lambda p: p["own"].isNotNull() | reduce(
        lambda a, b: a | b, [F.coalesce(p[f], F.lit(0)) != 0 for f in FLAGS]))
    met = packed_words(cells).select(F.explode(parts).alias("p")).select("p.*").groupBy(*KEY).agg(
        F.bit_or("own").alias("own"), *[F.coalesce(F.bit_or(f), F.lit(0)).alias(f) for f in FLAGS])
    return met.where("own IS NOT NULL")


def is_set(mask, bit="bit") -> Column:
    return F.shiftrightunsigned(mask, 0).bitwiseAND(F.expr(f"shiftleft(1L, {bit})")) != 0


def cells_of(words: DataFrame, *columns, mask="own") -> DataFrame:
    """One row per bit of a mask: x, y, z, and ``columns``, which may use ``bit``."""
    bits = words.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(63)))).where(is_set(mask))
    return bits.select((F.col("wx") * 16 + F.col("bit").bitwiseAND(15)).alias("x"), "y",
                       (F.col("wz") * 4 + F.shiftright("bit", 4)).alias("z"), *columns)


def with_flags(voxels: DataFrame, occupied: DataFrame = None) -> DataFrame:
    """Add xm, xp, ym, yp, zm, zp: is that neighbour occupied, by ``occupied`` or else by the voxels themselves?"""
    words = neighbour_words(voxels if occupied is None else occupied).drop("own")
    placed = voxels.withColumns({"wx": word_key()[0], "wz": word_key()[1], "bit": place()})
    met = placed.join(words, KEY, "left")
    flags = [F.coalesce(is_set(f), F.lit(False)).alias(f) for f in FLAGS]
    return met.select(*[met[c] for c in voxels.columns], *flags)


def open_faces() -> Column:
    """Faces of a word's cells whose neighbour is empty."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col("own").bitwiseAND(F.bitwise_not(f))) for f in FLAGS])
