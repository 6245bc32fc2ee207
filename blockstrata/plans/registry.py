"""Registry of named queries with the SQL text that states the same result."""

from ..fixtures import (BLOCKS, EXTENTS, FRAMES, KV_LOG, PALETTE, PARENTS,
                        PIXEL_SOURCE, PIXELS, VOXELS, World)
from . import rule_sql as R

QUERIES, ORACLES = {}, {}


def _plain(text):
    for name in ("lineitem", "part", "events", "customer", "supplier"):
        text = text.replace("{" + name + "}", name)
    return text.strip()


# views in the order in which they build on each other
VIEWS = {
    "palette": PALETTE.strip(),
    "voxels": _plain(VOXELS),
    "blocks": _plain(BLOCKS),
    "pixels": PIXELS.replace("{exploded}", PIXEL_SOURCE["duckdb"]).strip(),
    "frames": _plain(FRAMES),
    "parents": _plain(PARENTS),
    "extents": _plain(EXTENTS),
    "kv_log": _plain(KV_LOG),
    "labels_of": f"""SELECT palette_id, name, properties,
        CASE WHEN list_contains(string_split(properties, ';'), 'waterlogged=true')
              AND label <> 'WATER' THEN 'PROP' ELSE label END AS label, role, family
        FROM (SELECT *, {R.semantic_label('name')} AS label, {R.role('name')} AS role,
              {R.atlas_family('name')} AS family FROM palette)""",
    "solid": """SELECT x, y, z, palette_id, name, properties, label, role, family
        FROM voxels JOIN labels_of USING (palette_id)
        WHERE name NOT IN ('minecraft:air','minecraft:cave_air','minecraft:void_air')""",
    "columns": "SELECT x, z, max(y) + 1 AS height FROM solid GROUP BY x, z",
    "grid": """SELECT gx.x, gz.z FROM
        (SELECT unnest(range(min(x), max(x) + 1))::INT AS x FROM solid) gx,
        (SELECT unnest(range(min(z), max(z) + 1))::INT AS z FROM solid) gz""",
}
_NEEDS = {
    "labels_of": ["palette"], "solid": ["voxels", "labels_of"],
    "columns": ["solid"], "grid": ["solid"],
}


def with_views(sql, views, extra=()):
    """Put the named views, what they need and extra ones before a query."""
    wanted, queue = set(), list(views)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += _NEEDS.get(name, [])
    parts = [f"{n} AS ({t})" for n, t in VIEWS.items() if n in wanted]
    parts += [f"{n} AS ({t})" for n, t in extra]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + sql if parts else sql


def query(name, sql=None, views=(), extra=()):
    """Register fn(world) under a name, with the SQL that must agree with it."""
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(World(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, views, extra)
        return fn
    return register
