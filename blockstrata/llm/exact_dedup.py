"""Exact duplicates by recipes of content-defined chunks, in DataFrame functions only."""

from pyspark.sql import functions as F

from ..session import cut_lineage

NO_MARKS = "cast(array() as array<struct<place: int, number: bigint>>)"
WHITE = " \t\n\x0b\x0c\r"


def chunk_pattern(least=512, most=4096):
    """Pattern whose successive matches cut a text into chunks.

    A chunk ends at the first sentence end after ``least`` code points, so the
    text alone places the cuts; without one it ends after ``most`` code points
    or with the text.
    """
    return rf"(?s)(?:.{{{least},{most}}}?(?<=[.!?;:|。！？؟।])|.{{1,{most}}})"


def _chunk_hash(chunk, bits):
    full = F.xxhash64(chunk)
    return full if bits >= 64 else F.shiftrightunsigned(full, 64 - bits)


def exact_duplicates(docs, least=512, most=4096, hash_bits=64):
    """Groups of rows whose texts are equal without white space (20, 09-0D hex).

    ``docs`` needs doc_id and text. Returns one row per input row: doc_id,
    keep_id, group_size, kept, text_sha256.

    Each text becomes its recipe, the ordered list of its chunks' identifiers;
    equal recipes make a group. An identifier is a 64-bit hash that is verified
    against all chunks: every different chunk moves once, after merging within
    each task, and hashes held by several chunks are numbered apart by content.
    Texts themselves never move; groups are built on recipes, so a hot group
    shrinks within each task and its join is split by the planner's skew
    handling.

    Of a group the row with the most code points stays, then the smallest
    doc_id. Null text counts as empty; all such rows form one group. A null
    doc_id loses ties; in a group where it wins, keep_id is null and kept is
    true for rows with a null id. Repeated rows with the id that stays are all
    kept. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).alias("points"),
                        F.translate(text, WHITE, "").alias("plain"))
    cut = F.expr(f"regexp_extract_all(plain, r'{chunk_pattern(least, most)}', 0)")
    recipes = cut_lineage(plain.select(
        "doc_id", "points", F.sha2("plain", 256).alias("text_sha256"),
        F.transform(cut, lambda c: _chunk_hash(c, hash_bits)).alias("recipe")))

    chunks = plain.select(F.sha2("plain", 256).alias("text_sha256"), F.posexplode(cut).alias("place", "chunk")).withColumn("hash", _chunk_hash(F.col("chunk"), hash_bits))
    store = chunks.select("hash", "chunk").distinct()
    shared = cut_lineage(store.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"))
    if shared.isEmpty():
        named = recipes.withColumn("marks", F.expr(NO_MARKS))
    else:
        named = _tell_apart(recipes, chunks, shared)

    best = named.groupBy("recipe", "marks").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("best"))
    return named.join(best, ["recipe", "marks"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        F.expr("doc_id <=> best.doc_id").alias("kept"), "text_sha256")


def _tell_apart(recipes, chunks, shared):
    """Recipes with marks: place and number of each chunk whose hash is shared.

    The number counts the different chunks of that hash that sort before it.
    """
    held = chunks.join(shared.select("hash"), "hash")
    distinct = held.select("hash", "chunk").distinct()
    number = distinct.alias("x").join(distinct.alias("y"), F.expr("x.hash = y.hash AND y.chunk < x.chunk"), "left")
    number = number.groupBy("x.hash", "x.chunk").agg(F.count("y.chunk").alias("number"))
    marks = held.join(number, ["hash", "chunk"]).groupBy("text_sha256").agg(
        F.sort_array(F.collect_set(F.struct("place", "number"))).alias("marks"))
    return recipes.join(marks, "text_sha256", "left").withColumn("marks", F.coalesce("marks", F.expr(NO_MARKS)))
