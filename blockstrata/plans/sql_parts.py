"""Shared SQL texts for checking grid, stencil and component operators."""

from ..functions import fixed_values as V
from ..operators.stencils import gaussian_weights
from . import rule_sql as R

ROW, COL = "PARTITION BY z ORDER BY x", "PARTITION BY x ORDER BY z"
ALL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
OBJECTS = R.quoted(V.OBJECT_LABELS)

SURFACE = ("surface", f"""SELECT x, z, max(y) + 1 AS height, arg_max(label, y) AS label FROM solid
  WHERE label NOT IN ({R.quoted(V.NEVER_GROUND_LABELS)}) GROUP BY x, z""")
HM = ("hm", """SELECT x, z, height, TRUE AS valid FROM surface
  UNION ALL SELECT h.x, h.z, arg_min(s.height, ((h.x - s.x) * (h.x - s.x) + (h.z - s.z) * (h.z - s.z), s.x, s.z)), FALSE
  FROM (SELECT * FROM grid ANTI JOIN surface USING (x, z)) h, surface s GROUP BY h.x, h.z""")
TOPS = ("tops", """SELECT g.x, g.z, coalesce(c.top, -1) AS top, coalesce(top_role, 'empty') AS top_role,
  coalesce(terrain_top, -1) AS terrain_top FROM grid g LEFT JOIN (
   SELECT x, z, max(y) AS top, arg_max(role, y) AS top_role, max(y) FILTER (role = 'terrain') AS terrain_top
   FROM solid GROUP BY x, z) c USING (x, z)""")
SPREAD = ("spreads", """SELECT t.x, t.z, any_value(t.top) AS top, any_value(t.top_role) AS top_role,
   any_value(t.terrain_top) AS terrain_top, max(abs(coalesce(n.top, -99) - t.top)) AS spread,
   bool_or(n.top IS NULL) AS edge
  FROM tops t, range(-2, 3) a(dx), range(-2, 3) b(dz)
  LEFT JOIN tops n ON n.x = t.x + dx AND n.z = t.z + dz GROUP BY t.x, t.z""")
TERRAIN = ("terrain", """SELECT x, z, top, top_role, terrain_top, spread, edge, CASE WHEN top_role = 'structure' AND spread <= 1
   AND terrain_top >= 0 AND top > terrain_top AND top <= terrain_top + 2 THEN top ELSE terrain_top END AS terrain_h
  FROM spreads""")
KEY = "((CAST({x} AS BIGINT) + 33554432) * 137438953472 + (CAST({z} AS BIGINT) + 33554432) * 2048 + {y} + 1024)"


def key(x="x", y="y", z="z"):
    return KEY.format(x=x, y=y, z=z)


def blur(v, line, weights):
    r = len(weights) // 2
    terms = [f"{v} * {weights[r]!r}::DOUBLE"]
    for k in range(1, r + 1):
        terms.append(f"coalesce(lag({v}, {k}) OVER ({line}), first_value({v}) OVER ({line} {ALL})) * {weights[r - k]!r}::DOUBLE")
        terms.append(f"coalesce(lead({v}, {k}) OVER ({line}), last_value({v}) OVER ({line} {ALL})) * {weights[r + k]!r}::DOUBLE")
    return " + ".join(terms)


def gauss(src, value, sigma, out, col="smooth"):
    w = gaussian_weights(sigma)
    return [(out + "_x", f"SELECT *, {blur(value, ROW, w)} AS {col}_row FROM {src}"),
            (out, f"SELECT * EXCLUDE ({col}_row), {blur(col + '_row', COL, w)} AS {col} FROM {out}_x")]


def grad(v, line):
    lag, lead = f"lag({v}) OVER ({line})", f"lead({v}) OVER ({line})"
    return (f"CASE WHEN {lag} IS NULL AND {lead} IS NULL THEN 0.0::DOUBLE WHEN {lag} IS NULL THEN {lead} - {v} "
            f"WHEN {lead} IS NULL THEN {v} - {lag} ELSE ({lead} - {lag}) / 2.0::DOUBLE END")


def diffusion(src, value, sigma, out):
    """Three sweeps; the last view is named ``out`` and holds ``diffused``."""
    views = [(f"{out}_0", f"SELECT *, CAST({value} AS DOUBLE) AS diffused FROM {src}")]
    s = repr(sigma) + "::DOUBLE"
    for i in range(3):
        views += [
            (f"{out}_{i}a", f"SELECT *, {grad('diffused', ROW)} AS dx, {grad('diffused', COL)} AS dz FROM {out}_{i}"),
            (f"{out}_{i}b", f"SELECT *, dx / (1.0 + (dx / {s}) * (dx / {s})) AS fx, dz / (1.0 + (dz / {s}) * (dz / {s})) AS fz FROM {out}_{i}a"),
            (f"{out}_{i + 1}" if i < 2 else out,
             f"SELECT * EXCLUDE (diffused, dx, dz, fx, fz), diffused + 0.2::DOUBLE * (({grad('fx', ROW)}) + ({grad('fz', COL)})) AS diffused FROM {out}_{i}b")]
    return views


def components(cells, out, offsets, prefix):
    """Views that close the neighbour relation; smallest key names a component."""
    steps = " UNION ALL ".join(f"SELECT {a} AS dx, {b} AS dy, {c} AS dz" for a, b, c in offsets)
    return [
        (prefix + "_n", f"SELECT DISTINCT x, y, z, {key()} AS k FROM {cells}"),
        (prefix + "_h", f"""SELECT a.k AS a, b.k AS b FROM {prefix}_n a, ({steps}) s, {prefix}_n b
          WHERE b.x = a.x + dx AND b.y = a.y + dy AND b.z = a.z + dz"""),
        (prefix + "_e", f"SELECT a, b FROM {prefix}_h UNION ALL SELECT b, a FROM {prefix}_h"),
        (prefix + "_r", f"""SELECT k, k AS r FROM {prefix}_n
          UNION SELECT e.b, q.r FROM {prefix}_r q JOIN {prefix}_e e ON e.a = q.k WHERE q.r < e.b"""),
        (out, f"SELECT x, y, z, component FROM {prefix}_n JOIN (SELECT k, min(r) AS component FROM {prefix}_r GROUP BY k) USING (k)"),
    ]
