"""Checks over listings, manifests, counts and reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .census import n_rows


def stale_outputs(listing: DataFrame, manifest: DataFrame, name: str) -> DataFrame:
    """Files that look like tiles of this name but are not in the manifest."""
    pattern = f"^{name}_[0-9]{{2}}_[0-9]{{2}}[.]png$"
    return listing.filter(F.col("file").rlike(pattern)).distinct() \
        .join(manifest, "file", "left_anti")


def prefix_census(labels: DataFrame) -> DataFrame:
    return labels.groupBy(F.substring_index("label", "_", 1).alias("prefix")).agg(n_rows())


def listing_rollup(lines: DataFrame, prefixes) -> DataFrame:
    """Lines that mention each required text, per container and overall."""
    flags = [F.count_if(F.contains(F.lower("line"), F.lit(p.lower()))).alias(f"c{i}")
             for i, p in enumerate(prefixes)]
    counts = lines.rollup("source").agg(*flags)
    pairs = F.array(*[F.struct(F.lit(p).alias("prefix"), F.col(f"c{i}").alias("n"))
                      for i, p in enumerate(prefixes)])
    return counts.select("source", F.explode(pairs).alias("e")) \
        .select("source", "e.prefix", "e.n", (F.col("e.n") > 0).alias("present"))


def reconcile_counts(measured: DataFrame, recorded: DataFrame, key, values) -> DataFrame:
    """Rows of both tables side by side with differences per value; a key that
    only one side has shows in ``state``."""
    a = measured.select(key, *[F.col(v).alias("m_" + v) for v in values], F.lit(True).alias("_m"))
    b = recorded.select(key, *[F.col(v).alias("r_" + v) for v in values], F.lit(True).alias("_r"))
    both = a.join(b, key, "full")
    diffs = [(F.col("m_" + v) - F.col("r_" + v)).alias("diff_" + v) for v in values]
    same = None
    for v in values:
        eq = F.col("m_" + v) == F.col("r_" + v)
        same = eq if same is None else same & eq
    state = (F.when(F.col("_m").isNull(), "not_measured").when(F.col("_r").isNull(), "not_recorded")
             .when(same, "ok").otherwise("mismatch"))
    return both.select(key, *diffs, state.alias("state"))


def manifest_constraints(manifest: DataFrame, files: DataFrame, used: DataFrame, golden: DataFrame) -> DataFrame:
    """Violations of the manifest's rules: (name, rule, severity). One pass
    flags all row rules; the others are grouped counts and anti-joins."""
    required = ["name", "top_tex", "side_tex", "bottom_tex", "alpha_mode", "emissive"]
    checks = [F.when(F.col(c).isNull(), F.struct(F.lit("missing_" + c).alias("rule"), F.lit("error").alias("severity"))) for c in required]
    checks.append(F.when(~F.col("alpha_mode").isin("opaque", "masked", "transparent"),
                         F.struct(F.lit("bad_alpha_mode").alias("rule"), F.lit("error").alias("severity"))))
    checks.append(F.when(F.col("emissive") & F.col("emissive_colour").isNull(),
                         F.struct(F.lit("glow_without_colour").alias("rule"), F.lit("warning").alias("severity"))))
    for c in ("top_tex", "side_tex", "bottom_tex"):
        checks.append(F.when(~F.col(c).endswith(".png"),
                             F.struct(F.lit("not_png_" + c).alias("rule"), F.lit("error").alias("severity"))))
    rows = manifest.select("name", F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("c")).select("name", "c.*")

    def named(df, rule, severity="error"):
        return df.select("name", F.lit(rule).alias("rule"), F.lit(severity).alias("severity"))

    repeated = manifest.groupBy("name").agg(n_rows()).filter("n > 1")
    tall = manifest.select("name", F.explode(F.array("top_tex", "side_tex", "bottom_tex")).alias("file")).filter("file IS NOT NULL")
    lost = tall.join(files, "file", "left_anti").select("name").distinct()
    uncovered = used.join(manifest, "name", "left_anti")
    wrong = golden.join(manifest, "name").filter(
        (F.col("top_tex") != F.col("want_top")) | (F.col("side_tex") != F.col("want_side")) | (F.col("bottom_tex") != F.col("want_bottom")))
    return (rows.unionByName(named(repeated, "repeated_name")).unionByName(named(lost, "missing_file"))
            .unionByName(named(uncovered, "uncovered")).unionByName(named(wrong, "golden")))


def family_name_consistency(pairs: DataFrame, rule) -> DataFrame:
    """Distinct (name, family) pairs that the family rule does not give."""
    names = pairs.select("name").distinct().withColumn("want", rule(F.col("name")))
    return pairs.groupBy("name", "family").agg(n_rows()).join(names, "name").filter(~F.col("family").eqNullSafe(F.col("want")))


def degenerate_output_check(report: DataFrame) -> DataFrame:
    """Problems of a finished run: tiles, triangles, nan and objects counts."""
    problems = F.filter(F.array(
        F.when(F.col("tiles") == 0, F.lit("no tiles")), F.when(F.col("nan") > 0, F.lit("nan heights")),
        F.when(F.col("triangles") == 0, F.lit("no triangles")), F.when(F.col("objects") == 0, F.lit("no objects"))),
        lambda p: p.isNotNull())
    return report.withColumn("problems", F.array_join(problems, "; ")).withColumn("ok", F.size(problems) == 0)


def table_stamp(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a table: rows and sum of row hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(n_rows("rows"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))


def deterministic_rerun(first: DataFrame, second: DataFrame) -> DataFrame:
    """Do two runs give the same table, and is no column a time?"""
    timed = any(t in ("timestamp", "timestamp_ntz", "date") for _, t in first.dtypes)
    a, b = table_stamp(first), table_stamp(second)
    return a.select(F.col("rows").alias("first_rows"), (F.col("rows") == b.select("rows").scalar()).alias("same_rows"),
                    (F.col("digest") == b.select("digest").scalar()).alias("same_digest"), F.lit(not timed).alias("no_time_columns"))


def input_stamp(current: DataFrame, stored: DataFrame) -> DataFrame:
    """May a derived table be reused? Only if every input has the same stamp."""
    both = current.select("input", F.col("stamp").alias("now")).join(stored.select("input", F.col("stamp").alias("then")), "input", "full")
    return both.select("input", F.col("now").eqNullSafe(F.col("then")).alias("reusable"))


def offset_contiguity(chunks: DataFrame, width=4) -> DataFrame:
    """Chunks of a file whose voxels do not start where the ones before end.
    Chunks are numbered in file order, which the table states as ``seq``."""
    from pyspark.sql import Window
    w = Window.partitionBy("file").orderBy("seq")
    want = F.lag(F.col("voxel_offset") + F.col("voxel_count") * width).over(w)
    return chunks.withColumn("gap", F.col("voxel_offset") - want).withColumn("ok", want.isNull() | (F.col("gap") == 0))
