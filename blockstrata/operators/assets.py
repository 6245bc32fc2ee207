"""Block models: inheritance, texture aliases, variants and the manifest.

models: node, parent, textures (map). Every step is a join on model names;
nothing is walked one model at a time.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..session import cut_lineage
from .census import n_rows

def nearest_wins(child, parent):
    return F.map_zip_with(child, parent, lambda k, c, p: F.coalesce(c, p))


def parent_chain(models: DataFrame, levels=None) -> DataFrame:
    """Textures of each model with those of its ancestors behind them.

    Chains double in length per join: after k rounds a row spans 2^k levels,
    until no row has a parent left. A model whose chain runs into a cycle has
    one when the rows span more levels than there are models; it ends there,
    with a depth beyond their number. With ``levels`` spans of its binary parts
    are put together instead, so no model sees an ancestor beyond that guard.
    Common parents are hot keys, so the joins are salted.
    """
    empty = F.create_map().cast("map<string,string>")
    span = cut_lineage(models.select("node", F.col("parent").alias("up"), F.coalesce("textures", empty).alias("textures"),
                                     F.lit(1).alias("depth")))
    if levels is None:
        size, most = 1, span.count()
        while size <= most and not span.filter("up IS NOT NULL").isEmpty():
            span, size = cut_lineage(_stack(span, span)), size * 2
        return span
    total, size = None, 1
    while size <= levels:
        if levels & size:
            total = span if total is None else _stack(total, span)
        size *= 2
        if size <= levels:
            span = cut_lineage(_stack(span, span))
    return total


def _stack(low: DataFrame, high: DataFrame) -> DataFrame:
    top = high.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("textures").alias("_t"), F.col("depth").alias("_d"))
    rooted = low.filter("up IS NULL")
    linked = _salted_left(low.filter("up IS NOT NULL"), top)
    merged = linked.select("node", F.col("_up").alias("up"),
                           F.when(F.col("_t").isNull(), F.col("textures")).otherwise(nearest_wins(F.col("textures"), F.col("_t"))).alias("textures"),
                           (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"))
    return merged.unionByName(rooted)


def _salted_left(low: DataFrame, top: DataFrame, salts=8) -> DataFrame:
    left = low.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    right = top.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Stored maps of texts pack so well that the planner would take this side for small and send it to everyone.
    return left.join(right.hint("merge"), ["up", "_salt"], "left").drop("_salt")


def texture_deref(raw, textures):
    """Follow ``#name`` aliases through a texture map, as often as it has
    entries; null when an alias is unknown or runs in a circle."""
    def step(ref, _):
        return F.when(F.startswith(ref, F.lit("#")), F.trim(textures[F.substr(ref, F.lit(2))])).otherwise(ref)

    end = F.aggregate(F.sequence(F.lit(0), F.size(textures)), F.trim(raw), step)
    return F.when(~F.startswith(end, F.lit("#")) & (end != ""), end)


def texture_file(ref):
    """File of a texture reference in the block namespace, else null."""
    bare = rules.strip_ns(ref)
    name = F.when(F.startswith(bare, F.lit("block/")), F.regexp_replace(bare, "^block/", "")) \
        .when(~F.contains(bare, F.lit("/")), bare)
    return F.when(~F.contains(bare, F.lit("#")), F.concat(name, F.lit(".png")))


def variant_rank(variants: DataFrame, preferred: DataFrame) -> DataFrame:
    """Representative variant of each block: the commonest state, else the
    unnamed one, else false or zero values, short keys, key order."""
    low = F.lower("variant")
    off = F.contains(low, F.lit("=false")) | F.contains(low, F.lit("=0"))
    exact = (F.col("variant") == F.col("properties")) & (F.col("properties") != "")
    kind = F.when(exact, 0).when(F.col("variant") == "", 1).when(off, 2).otherwise(3)
    order = F.struct(kind.alias("kind"), F.length("variant"), "variant")
    joined = variants.join(preferred, "name", "left")
    return joined.groupBy("name").agg(F.min_by(F.struct("variant", "model"), order).alias("b")) \
        .select("name", "b.variant", "b.model")


def element_face_priority(elements: DataFrame) -> DataFrame:
    """Face of each direction: the model's own elements before its parents',
    whole cubes before parts, earlier elements before later ones."""
    order = F.struct(F.col("depth"), (~F.col("is_full")).cast("int").alias("part"), F.col("pos"))
    return elements.groupBy("node", "direction").agg(F.min_by("texture", order).alias("texture"))


def texture_fallback(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Top, side and bottom file per block with the step that found them.

    blocks: name, short, top, side, bottom (from model faces, may be null) and
    particle (from textures without faces). files: one column ``file``.
    """
    named = {"own": "", "f_top": "_top", "f_side": "_side", "f_bottom": "_bottom"}
    out = blocks
    for col, end in named.items():
        hit = files.select(F.col("file").alias(col))
        out = out.join(hit, F.concat("short", F.lit(end + ".png")) == hit[col], "left")
    any_face = F.coalesce("top", "side", "bottom")
    guess = F.coalesce("f_top", "f_side", "f_bottom").isNotNull()
    own_png = F.concat("short", F.lit(".png"))
    g_top = F.coalesce("f_top", own_png)
    g_side = F.coalesce("f_side", g_top)
    source = (F.when(any_face.isNotNull(), "model").when(F.col("particle").isNotNull(), "model-textures")
              .when(F.col("own").isNotNull(), "heuristic").when(guess, "heuristic").otherwise("placeholder"))

    def pick(face, guessed):
        return (F.when(any_face.isNotNull(), F.coalesce(face, any_face)).when(F.col("particle").isNotNull(), F.col("particle"))
                .when(F.col("own").isNotNull(), F.col("own")).when(guess, guessed).otherwise(own_png))

    return out.select("name", source.alias("source"),
                      pick(F.coalesce("top", "bottom"), g_top).alias("top_tex"), pick(F.col("side"), g_side).alias("side_tex"),
                      pick(F.coalesce("bottom", "top"), F.coalesce("f_bottom", g_top)).alias("bottom_tex"))


def with_looks(manifest: DataFrame, animated_files: DataFrame) -> DataFrame:
    """Add alpha mode, glow, shape hint and whether a texture is animated."""
    name = F.col("name")
    tall = manifest.select("name", F.explode(F.array("top_tex", "side_tex", "bottom_tex")).alias("file"))
    moving = tall.join(animated_files, "file", "left_semi").select("name").distinct().withColumn("animated", F.lit(True))
    return (manifest.withColumn("alpha_mode", rules.alpha_mode(name)).withColumn("emissive_colour", rules.emissive_colour(name))
            .withColumn("emissive", F.col("emissive_colour").isNotNull()).withColumn("shape_hint", rules.shape_hint(name))
            .withColumn("is_placeholder", F.col("source") == "placeholder")
            .join(moving, "name", "left").withColumn("animated", F.coalesce("animated", F.lit(False))))


def manifest_report(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        n_rows("entries"), *[F.count_if(F.col("alpha_mode") == m).alias(m) for m in ("opaque", "masked", "transparent")],
        F.count_if("emissive").alias("emissive"), F.count_if("is_placeholder").alias("placeholder"),
        F.count_if(F.col("shape_hint").isNotNull()).alias("non_cube"), F.count_if("animated").alias("animated"),
        F.count_if(F.col("source") == "model").alias("from_model"), F.count_if(F.col("source") == "heuristic").alias("from_heuristic"))
