"""Name rules: one block name in, one class out.

Every rule is a column expression. Rules are meant to run on the palette, one
row per block state, and reach the voxels through a join on ``palette_id``.
"""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def any_token(col: Column, tokens) -> Column:
    return col.rlike("(" + "|".join(tokens) + ")")


def any_suffix(col: Column, suffixes) -> Column:
    return col.rlike("(" + "|".join(suffixes) + ")$")


def literal_map(table: dict) -> Column:
    """String map written as one text literal, which folds to a constant."""
    text = ",".join(f"{k}={v}" for k, v in table.items())
    return F.str_to_map(F.lit(text), F.lit(","), F.lit("="))


def first_token(col: Column, rules, default: str) -> Column:
    """Class of the first rule whose token occurs in the name. The name is
    worked out once for all tokens."""
    tokens, kinds = (F.split(F.lit(" ".join(part)), " ") for part in zip(*rules))

    def kind(name):
        hit = F.get(F.filter(tokens, lambda t: F.contains(name, t)), 0)
        return F.coalesce(F.get(kinds, F.array_position(tokens, hit) - 1), F.lit(default))

    return F.get(F.transform(F.array(col), kind), 0)


def strip_ns(name: Column) -> Column:
    return F.regexp_replace(name, "^[^:]*:", "")


def sanitize(name: Column) -> Column:
    body = F.regexp_replace(F.replace(name, F.lit("minecraft:"), F.lit("")),
                            "[^A-Za-z0-9_]", "_")
    return F.concat(F.lit("MC_"), F.when(body == "", "Unnamed").otherwise(body))


def props_key(props: Column) -> Column:
    """Canonical ``k=v;k=v`` text of a property map, keys in order."""
    pairs = F.transform(F.array_sort(F.map_entries(props)),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.coalesce(F.array_join(pairs, ";"), F.lit(""))


def parse_properties(text: Column) -> Column:
    """Inverse of props_key; parts without ``=`` are ignored."""
    parts = F.filter(F.split(text, ";"), lambda p: F.contains(p, F.lit("=")))
    return F.map_from_entries(F.transform(
        parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"),
                                  F.regexp_replace(p, "^[^=]*=", "").alias("value"))))


def semantic_label(name: Column) -> Column:
    n = strip_ns(name)
    exact = F.when(name.isin(V.AIR_NAMES), "AIR")
    for label in V.LABELS:
        names = [k for k, v in V.LABEL_BY_NAME.items() if v == label]
        if names:
            exact = exact.when(n.isin(names), label)
    return (exact
            .when(n.isin(V.LABEL_LAVA_NAMES), "LAVA")
            .when(n.isin(V.LABEL_WATER_NAMES) | n.endswith(V.LABEL_WATER_SUFFIX), "WATER")
            .when(n.isin(V.LABEL_PROP_NAMES) | any_token(n, V.LABEL_PROP_TOKENS), "PROP")
            .when(any_token(n, V.LABEL_GLASS_TOKENS), "GLASS")
            .when(any_token(n, V.LABEL_VEGETATION_TOKENS)
                  & ~n.contains(V.LABEL_WOOD_TOKEN), "VEGETATION")
            .when(any_token(n, V.LABEL_STRUCTURE_TOKENS), "STRUCTURE")
            .otherwise("TERRAIN"))


def waterlogged_override(label: Column, properties: Column) -> Column:
    wet = F.array_contains(F.split(properties, ";"), "waterlogged=true")
    return F.when(wet & (label != "WATER"), "PROP").otherwise(label)


def role(name: Column) -> Column:
    n = strip_ns(name)

    def is_one(names, suffixes):
        return n.isin(names) | any_suffix(n, suffixes)

    return (F.when(n.isin(V.ROLE_WATER_NAMES), "water")
            .when(is_one(V.ROLE_VEGETATION_NAMES, V.ROLE_VEGETATION_SUFFIXES), "vegetation")
            .when(is_one(V.ROLE_DETAIL_NAMES, V.ROLE_DETAIL_SUFFIXES), "detail")
            .when(is_one(V.ROLE_STRUCTURE_NAMES, V.ROLE_STRUCTURE_SUFFIXES), "structure")
            .when(is_one(V.ROLE_TERRAIN_NAMES, V.ROLE_TERRAIN_SUFFIXES), "terrain")
            .otherwise("structure"))


def role_is_mapped(name: Column) -> Column:
    """False for names that are structure only because nothing else fits."""
    n = strip_ns(name)
    return (role(name) != "structure") | n.isin(V.ROLE_STRUCTURE_NAMES) \
        | any_suffix(n, V.ROLE_STRUCTURE_SUFFIXES)


def material_family(name: Column) -> Column:
    return first_token(strip_ns(name), V.FAMILY_RULES, "other")


def colour_variant(name: Column) -> Column:
    """Baked dye variant such as ``fabric_lime``, or null."""
    n = strip_ns(name)
    pattern = "^(" + "|".join(V.DYES) + ")_(.*)$"
    dye = F.regexp_extract(n, pattern, 1)
    bare = F.regexp_replace(F.regexp_extract(n, pattern, 2), "(_wall|_slab|_stairs)$", "")
    variant = F.concat(literal_map(V.VARIANT_FAMILY)[bare], F.lit("_"), dye)
    return F.when(~any_token(n, V.VARIANT_EXCLUDED_TOKENS)
                  & variant.isin(list(V.VARIANT_RGB)), variant)


def family_key(name: Column) -> Column:
    return F.coalesce(colour_variant(name), material_family(name))


def atlas_family(name: Column) -> Column:
    return F.when(strip_ns(name).isin(V.ATLAS_WATER_NAMES), "water") \
        .otherwise(family_key(name))


def base_family(slot: Column) -> Column:
    head = F.regexp_replace(slot, "_(" + "|".join(V.DYES) + ")$", "")
    return F.when(slot.isin(V.ATLAS_FAMILIES), slot) \
        .when(head.isin(V.ATLAS_FAMILIES), head).otherwise(slot)


def detail_kind(name: Column) -> Column:
    return first_token(strip_ns(name), V.DETAIL_KIND_RULES, "trim")


def man_made(name: Column) -> Column:
    return any_token(F.lower(name), V.MAN_MADE_TOKENS)


def natural(name: Column) -> Column:
    return any_token(F.lower(name), V.NATURAL_TOKENS)


def alpha_mode(name: Column) -> Column:
    n = strip_ns(name)
    masked = (n.contains("glass_pane") | n.endswith("_pane")
              | n.isin(V.CUTOUT_FIRST_NAMES) | n.isin(V.MASKED_NAMES)
              | any_suffix(n, V.MASKED_SUFFIXES) | any_token(n, V.MASKED_TOKENS))
    clear = (n.isin(V.TRANSPARENT_NAMES) | any_suffix(n, V.TRANSPARENT_SUFFIXES)
             | any_token(n, V.TRANSPARENT_TOKENS))
    return F.when(masked, "masked").when(clear, "transparent").otherwise("opaque")


def emissive_colour(name: Column) -> Column:
    """Glow colour, or null for blocks that do not glow."""
    n = strip_ns(name)
    lamp = F.when(n.endswith(V.EMISSIVE_SUFFIX),
                  F.when(n.contains("soul"), V.EMISSIVE_SOUL).otherwise(V.EMISSIVE_WARM))
    return F.coalesce(literal_map(V.EMISSIVE_COLOURS)[n], lamp)


def shape_hint(name: Column) -> Column:
    return F.when(any_token(strip_ns(name), V.NON_CUBE_TOKENS), "non_cube")


def _rgb(table: dict, key: Column) -> Column:
    packed = {k: r * 65536 + g * 256 + b for k, (r, g, b) in table.items()}
    return literal_map(packed)[key].cast("int")


def block_rgb(name: Column) -> Column:
    """Map colour with the step that resolved it: struct(r, g, b, source)."""
    n = strip_ns(name)

    def without(suffix):
        return F.when(n.endswith(suffix), F.regexp_replace(n, suffix + "$", ""))

    dyed = F.coalesce(*[_rgb(V.DYE_RGB, without(s)) for s in V.DYED_SUFFIXES])
    tables = {"leaf": V.LEAF_RGB, "log": V.LOG_RGB}
    species = F.coalesce(*[_rgb(tables[t], without(s)) for s, t in V.SPECIES_SUFFIXES],
                         F.when(n.endswith("_sapling"), _rgb(V.LEAF_RGB, F.lit("oak"))))
    stripped = F.coalesce(*chain.from_iterable(
        (_rgb(V.BLOCK_RGB, without(s)),
         _rgb(V.BLOCK_RGB, F.concat(without(s), F.lit("s"))))
        for s in V.STRIPPED_SUFFIXES))
    family = F.coalesce(_rgb(V.FAMILY_RGB, material_family(name)),
                        _rgb(V.FAMILY_RGB, F.lit("other")))
    own = _rgb(V.BLOCK_RGB, n)
    packed = F.coalesce(own, dyed, species, stripped, family)
    source = (F.when(own.isNotNull(), "block").when(dyed.isNotNull(), "dye")
              .when(species.isNotNull(), "species")
              .when(stripped.isNotNull(), "strip").otherwise("family"))
    return F.struct(F.shiftright(packed, 16).alias("r"),
                    F.shiftright(packed, 8).bitwiseAND(255).alias("g"),
                    packed.bitwiseAND(255).alias("b"), source.alias("source"))
