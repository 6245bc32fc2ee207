"""A block world derived from the given tables.

The SQL below is read by Spark and by the reference database alike. The world
grows with the data: each run of 16384 order keys fills one more 128 x 128
square, 64 squares to a row.
"""

from pyspark.sql import DataFrame, SparkSession

PALETTE = """
SELECT * FROM (VALUES
 (0,'minecraft:grass_block','snowy=false'),(1,'minecraft:dirt',''),
 (2,'minecraft:bedrock',''),(3,'minecraft:sand',''),(4,'minecraft:stone',''),
 (5,'minecraft:water','level=0'),(6,'minecraft:lava','level=0'),
 (7,'minecraft:oak_leaves','distance=1;persistent=false'),
 (8,'minecraft:oak_log','axis=y'),(9,'minecraft:white_concrete',''),
 (10,'minecraft:quartz_block',''),
 (11,'minecraft:oak_stairs','facing=east;waterlogged=true'),
 (12,'minecraft:glass_pane','waterlogged=false'),(13,'minecraft:iron_bars',''),
 (14,'minecraft:oak_fence','waterlogged=false'),(15,'minecraft:torch',''),
 (16,'minecraft:lime_wool',''),(17,'minecraft:pink_terracotta',''),
 (18,'minecraft:red_stained_glass',''),(19,'minecraft:cobblestone',''),
 (20,'minecraft:air',''),(21,'minecraft:gravel',''),
 (22,'minecraft:dandelion',''),(23,'modpack:unknown_thing','')
) AS p(palette_id, name, properties)"""

VOXELS = """
SELECT x, y, z, min(palette_id) AS palette_id FROM (
  SELECT CAST(l_partkey % 128 - 64 + 128 * (FLOOR(l_orderkey / 16384) % 64) AS INT) AS x,
         CAST(CAST(l_quantity AS INT) % 8 AS INT) AS y,
         CAST(l_orderkey % 128 - 64 + 128 * FLOOR(l_orderkey / 1048576) AS INT) AS z,
         CAST((l_suppkey * 7 + l_linenumber) % 24 AS INT) AS palette_id
  FROM {lineitem}) AS raw
GROUP BY x, y, z"""

# block names made of a leading and a closing part, one per part row
NAME_HEADS = """
white orange light_blue lime pink gray light_gray cyan red black oak birch
spruce dark_oak stone smooth_stone end_stone red_nether_brick quartz sandstone
blue nether soul packed polished_andesite glass iron crimson warped mossy
""".split()
NAME_TAILS = """
_wool _carpet _bed _stained_glass _stained_glass_pane _concrete
_concrete_powder _terracotta _wool_slab _leaves _log _wood _planks _sapling
_stairs _slab _fence _fence_gate _door _trapdoor _wall _button _sign
_pressure_plate _block _bricks _brick_slab _lantern _torch _ore _ice _tulip
_rail _water _sand _dirt _bars _pane _shroomlight _thing
""".split()
PROPERTY_TEXTS = ["", "waterlogged=true", "facing=east;waterlogged=true",
                  "axis=y", "half=top;waterlogged=false"]


def _pick(values, index):
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE CAST({index} AS INT) {whens} END"


BLOCKS = f"""
SELECT p_partkey AS block_id,
       concat('minecraft:', {_pick(NAME_HEADS, f"p_partkey % {len(NAME_HEADS)}")},
              {_pick(NAME_TAILS, f"FLOOR(p_partkey / {len(NAME_HEADS)}) % {len(NAME_TAILS)}")}) AS name,
       {_pick(PROPERTY_TEXTS, f"p_partkey % {len(PROPERTY_TEXTS)}")} AS properties
FROM {{part}}"""

PIXELS = """
SELECT image_id, CAST(FLOOR(i / 8) AS INT) AS px_row, CAST(i % 8 AS INT) AS px_col,
       CAST(FLOOR(abs(v) * 1000) AS INT) % 256 AS r,
       CAST(FLOOR(abs(v) * 3000) AS INT) % 256 AS g,
       CAST(FLOOR(abs(v) * 7000) AS INT) % 256 AS b
FROM ({exploded}) AS e"""
PIXEL_SOURCE = {
    "spark": """SELECT vec_id AS image_id, i, CAST(v AS DOUBLE) AS v
                FROM {embeddings} LATERAL VIEW posexplode(embedding) p AS i, v""",
    "duckdb": """SELECT vec_id AS image_id, unnest(range(len(embedding))) AS i,
                 CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings""",
}

FRAMES = "SELECT user_id AS session_id, ts, value AS ms FROM {events}"
PARENTS = """
SELECT c_custkey AS node,
       CASE WHEN c_custkey = 0 THEN NULL ELSE CAST(FLOOR(c_custkey / 2) AS BIGINT) END AS parent
FROM {customer}"""
EXTENTS = """
SELECT s_suppkey AS extent_id, CAST(90 + (s_suppkey * 37) % 700 AS INT) AS width,
       CAST(90 + (s_suppkey * 53) % 1000 AS INT) AS depth FROM {supplier}"""
KV_LOG = """
SELECT event_id AS line_no, user_id AS source_id,
       concat('parse bAnyOff=1 spec=vox=', CAST(event_id % 2 AS STRING),
              ' struct=', CAST(user_id % 2 AS STRING), ' t=', CAST(value AS STRING)) AS line
FROM {events}"""


class World:
    """Tables of one data folder and the block world derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, text: str, *tables) -> DataFrame:
        return self.spark.sql(text, **{t: self.table(t) for t in tables})

    def palette(self):
        return self.spark.sql(PALETTE)

    def voxels(self):
        return self._sql(VOXELS, "lineitem")

    def blocks(self):
        return self._sql(BLOCKS, "part")

    def pixels(self):
        return self._sql(PIXELS.replace("{exploded}", PIXEL_SOURCE["spark"]), "embeddings")

    def frames(self):
        return self._sql(FRAMES, "events")

    def parents(self):
        return self._sql(PARENTS, "customer")

    def extents(self):
        return self._sql(EXTENTS, "supplier")

    def kv_log(self):
        return self._sql(KV_LOG, "events")

    def solid(self):
        """Non-air voxels with the classes of their block state."""
        from .operators.voxels import solid_voxels
        if self._stored is not None:
            return self._stored
        return solid_voxels(self.voxels(), self.palette())

    def stored_solid(self):
        """The same as a stored table, for plans that read it several times;
        later calls of solid() read it too."""
        from .session import cut_lineage
        if self._stored is None:
            self._stored = cut_lineage(self.solid())
        return self._stored

    def chunk_table(self):
        """Folder of all voxels, air included, as a table laid out by chunk."""
        from pyspark.sql import functions as F
        from .fixture_bytes import scratch
        from .sources.text import write_voxels
        folder = scratch(self.spark, "chunks")
        write_voxels(self.voxels().withColumn("dim", F.lit("overworld")), folder)
        return folder

    def dim_solid(self):
        """The same, spread over three dimensions chunk by chunk."""
        from pyspark.sql import functions as F
        return self.solid().withColumn("dim", F.expr(DIM))


DIM = """CASE ((CAST(FLOOR(x / 16) AS INT) + CAST(FLOOR(z / 16) AS INT)) % 3 + 3) % 3
 WHEN 0 THEN 'overworld' WHEN 1 THEN 'nether' ELSE 'end' END"""
