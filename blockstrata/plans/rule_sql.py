"""The name rules as SQL text, for checking the column expressions."""

from ..functions import fixed_values as V


def quoted(words):
    return ", ".join(f"'{w}'" for w in words)


def has_any(col, tokens):
    return f"regexp_matches({col}, '({'|'.join(tokens)})')"


def ends_any(col, suffixes):
    return f"regexp_matches({col}, '({'|'.join(suffixes)})$')"


def bare(name):
    return f"regexp_replace({name}, '^[^:]*:', '')"


def first_token(col, rules, default):
    whens = " ".join(f"WHEN contains({col}, '{t}') THEN '{k}'" for t, k in rules)
    return f"CASE {whens} ELSE '{default}' END"


def lookup(col, table):
    return f"CASE {col} " + " ".join(
        f"WHEN '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else str(v))
        for k, v in table.items()) + " END"


def semantic_label(name):
    n = bare(name)
    return f"""CASE WHEN {name} IN ({quoted(V.AIR_NAMES)}) THEN 'AIR'
      WHEN {n} IN ({quoted(V.LABEL_BY_NAME)}) THEN {lookup(n, V.LABEL_BY_NAME)}
      WHEN {n} IN ({quoted(V.LABEL_LAVA_NAMES)}) THEN 'LAVA'
      WHEN {n} IN ({quoted(V.LABEL_WATER_NAMES)}) OR {ends_any(n, ['_water'])} THEN 'WATER'
      WHEN {n} IN ({quoted(V.LABEL_PROP_NAMES)}) OR {has_any(n, V.LABEL_PROP_TOKENS)} THEN 'PROP'
      WHEN {has_any(n, V.LABEL_GLASS_TOKENS)} THEN 'GLASS'
      WHEN {has_any(n, V.LABEL_VEGETATION_TOKENS)} AND NOT contains({n}, 'wood') THEN 'VEGETATION'
      WHEN {has_any(n, V.LABEL_STRUCTURE_TOKENS)} THEN 'STRUCTURE'
      ELSE 'TERRAIN' END"""


def role(name):
    n = bare(name)
    return f"""CASE WHEN {n} IN ({quoted(V.ROLE_WATER_NAMES)}) THEN 'water'
      WHEN {n} IN ({quoted(V.ROLE_VEGETATION_NAMES)}) OR {ends_any(n, V.ROLE_VEGETATION_SUFFIXES)} THEN 'vegetation'
      WHEN {n} IN ({quoted(V.ROLE_DETAIL_NAMES)}) OR {ends_any(n, V.ROLE_DETAIL_SUFFIXES)} THEN 'detail'
      WHEN {n} IN ({quoted(V.ROLE_STRUCTURE_NAMES)}) OR {ends_any(n, V.ROLE_STRUCTURE_SUFFIXES)} THEN 'structure'
      WHEN {n} IN ({quoted(V.ROLE_TERRAIN_NAMES)}) OR {ends_any(n, V.ROLE_TERRAIN_SUFFIXES)} THEN 'terrain'
      ELSE 'structure' END"""


def material_family(name):
    return first_token(bare(name), V.FAMILY_RULES, "other")


def colour_variant(name):
    n = bare(name)
    dyes = "|".join(V.DYES)
    rest = (f"regexp_replace(regexp_extract({n}, '^({dyes})_(.*)$', 2), "
            "'(_wall|_slab|_stairs)$', '')")
    full = f"({lookup(rest, V.VARIANT_FAMILY)} || '_' || regexp_extract({n}, '^({dyes})_(.*)$', 1))"
    return (f"CASE WHEN NOT {has_any(n, V.VARIANT_EXCLUDED_TOKENS)} "
            f"AND {full} IN ({quoted(V.VARIANT_RGB)}) THEN {full} END")


def family_key(name):
    return f"coalesce({colour_variant(name)}, {material_family(name)})"


def atlas_family(name):
    return (f"CASE WHEN {bare(name)} IN ({quoted(V.ATLAS_WATER_NAMES)}) THEN 'water' "
            f"ELSE {family_key(name)} END")


def alpha_mode(name):
    n = bare(name)
    return f"""CASE
      WHEN contains({n}, 'glass_pane') OR {ends_any(n, ['_pane'])} THEN 'masked'
      WHEN {n} IN ({quoted(V.CUTOUT_FIRST_NAMES)}) OR {n} IN ({quoted(V.MASKED_NAMES)})
        OR {ends_any(n, V.MASKED_SUFFIXES)} OR {has_any(n, V.MASKED_TOKENS)} THEN 'masked'
      WHEN {n} IN ({quoted(V.TRANSPARENT_NAMES)}) OR {ends_any(n, V.TRANSPARENT_SUFFIXES)}
        OR {has_any(n, V.TRANSPARENT_TOKENS)} THEN 'transparent'
      ELSE 'opaque' END"""


def emissive_colour(name):
    n = bare(name)
    return f"""coalesce({lookup(n, V.EMISSIVE_COLOURS)},
      CASE WHEN {ends_any(n, ['_lantern'])} THEN
        CASE WHEN contains({n}, 'soul') THEN '{V.EMISSIVE_SOUL}' ELSE '{V.EMISSIVE_WARM}' END END)"""


def rgb(table, key):
    return lookup(key, {k: r * 65536 + g * 256 + b for k, (r, g, b) in table.items()})


def block_rgb_steps(name):
    """SQL of the packed colour of each step, first non-null step wins."""
    n = bare(name)

    def cut(s):
        return f"CASE WHEN {ends_any(n, [s])} THEN regexp_replace({n}, '{s}$', '') END"

    tables = {"leaf": V.LEAF_RGB, "log": V.LOG_RGB}
    oak = V.LEAF_RGB["oak"]
    return {
        "block": rgb(V.BLOCK_RGB, n),
        "dye": "coalesce(" + ", ".join(rgb(V.DYE_RGB, cut(s)) for s in V.DYED_SUFFIXES) + ")",
        "species": "coalesce(" + ", ".join(
            [rgb(tables[t], cut(s)) for s, t in V.SPECIES_SUFFIXES]
            + [f"CASE WHEN {ends_any(n, ['_sapling'])} THEN "
               f"{oak[0] * 65536 + oak[1] * 256 + oak[2]} END"]) + ")",
        "strip": "coalesce(" + ", ".join(
            f"{rgb(V.BLOCK_RGB, cut(s))}, {rgb(V.BLOCK_RGB, '(' + cut(s) + ') || ' + chr(39) + 's' + chr(39))}"
            for s in V.STRIPPED_SUFFIXES) + ")",
        "family": f"coalesce({rgb(V.FAMILY_RGB, material_family(name))}, "
                  f"{rgb(V.FAMILY_RGB, chr(39) + 'other' + chr(39))})",
    }
