"""Mixtures of sources at target weights by subset sums over document lengths."""

import numpy as np
import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
PLAN = "source string, size long, copies long, extra long, n long"


def source_targets(sizes, weights, most=3):
    """source, source_size, target: words each source is to give.

    ``sizes``: source, source_size. Sources in code point order, null last,
    take ``weights`` in turn and share the sum of all sizes. No target passes
    ``most`` times its source's size; what is over goes to the others by
    weight. One row per source passes through one task here.
    """
    weighed = sizes.withColumn("turn", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = weighed.withColumn("weight", F.get(cycle, F.pmod("turn", F.lit(len(weights)))))
    everything = W.partitionBy()
    weighed = weighed.withColumn("ceiling", F.lit(float(most)) * F.col("source_size"))
    # Sources reach their ceilings in the order of ceiling / weight, as the share per weight rises.
    order = W.orderBy(F.col("ceiling") / F.col("weight"), "turn")
    weighed = (weighed.withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
               .withColumn("below", F.coalesce(F.sum("ceiling").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
               .withColumn("left", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))))
    full = F.col("weight") * (F.col("total") - F.col("below")) >= F.col("ceiling") * F.col("left")
    weighed = weighed.withColumn("full", full)
    rest = (F.col("total") - F.sum(F.when(F.col("full"), F.col("ceiling")).otherwise(0.0)).over(everything))
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("ceiling")).otherwise(F.col("weight") * rest / open_weight)
    return weighed.select("source", "source_size", target.alias("target"))


def fit_budget(lengths, counts, budget, window, most=1):
    """How many documents of each length to take so that the words sum to ``budget``.

    Lengths from the longest down take their share of the budget, each rounded
    so that the running sum stays on course, until about ``window`` words are
    left open. A bounded knapsack over the counts still free then finds the sum
    nearest to what is left. Only where that sum is not exact are documents
    taken again, each up to ``most`` times.
    """
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    total = int((lengths * counts).sum())
    budget = min(max(int(budget), 0), total)
    taken = np.zeros(len(lengths), dtype=np.int64)
    rough = max(budget - window, 0)
    done = seen = 0
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        size, n = int(lengths[i]), int(counts[i])
        if size <= 0 or not total:
            continue
        seen += size * n
        want = seen * rough // total - done
        taken[i] = min(max(want // size, 0), n)
        done += size * int(taken[i])
    left = budget - done
    limit = left + int(lengths.max(initial=0))
    mask = (1 << (limit + 1)) - 1
    reach, steps = 1, []
    for again in range(most):
        for i in order[::-1]:
            free, size, unit = int(counts[i] - (0 if again else taken[i])), int(lengths[i]), 1
            while free > 0 and 0 < size * unit <= limit and not reach >> left & 1:
                unit = min(unit, free)
                steps.append((i, unit, reach))
                reach |= reach << size * unit & mask
                free, unit = free - unit, unit * 2
    best = next(d for k in range(limit + 1) for d in (left - k, left + k) if d >= 0 and reach >> d & 1)
    for i, unit, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += unit
            best -= int(lengths[i]) * unit
    return taken


def _fit(window, most):
    def run(group):
        target, size = float(group["target"].iloc[0]), int(group["source_size"].iloc[0])
        group = group.sort_values("size")
        copies = int(target // size) if size else 0
        extra = fit_budget(group["size"], group["n"], round(target - copies * size), window, max(1, most - copies))
        n = group["n"].to_numpy()
        return pd.DataFrame({"source": group["source"], "size": group["size"], "copies": copies + extra // n, "extra": extra % n, "n": n})
    return run


def mix_sources(docs, weights=(5, 2, 1), most=3, seed=7, window=50_000, bucket_rows=5_000):
    """Words that a mixture of all sources takes from each document.

    ``docs`` needs doc_id, text and source. Returns one row per input row:
    doc_id, size, source_size, target, taken. Targets: see source_targets.

    Documents are counted by source and exact length. A source gives whole
    copies of itself as often as its target holds, at most ``most``; for the
    rest a bounded knapsack over the counts of lengths (see fit_budget) says
    how many documents of each length to take once more (where only that meets
    the target, several times more, never beyond ``most`` in all). Its input is one row
    per different length, so it grows at most with the square root of the
    words. Among documents of one source and length a seeded hash of doc_id
    decides; where only some are taken, they are ranked within hash buckets of
    about ``bucket_rows`` rows, so no group of equal lengths meets in one task.

    Null or wordless text has size 0 and takes 0. Null is a source of its own.
    Rows that agree in source, length and doc_id are told apart by their rank,
    which of them is taken does not matter. Same input, same result. An empty
    table gives no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    slim = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size")))
    lengths = slim.groupBy("source", "size").agg(F.count("*").alias("n"))
    sums = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = cut_lineage(source_targets(sums, weights, most))
    same = lengths.source.eqNullSafe(targets.source)
    plan = lengths.join(targets, same).select(lengths.source, "size", "n", "source_size", "target")
    plan = cut_lineage(plan.groupBy("source").applyInPandas(_fit(window, most), PLAN))

    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("key")
    told = plan.join(targets, plan.source.eqNullSafe(targets.source)).select(
        F.coalesce(F.concat(F.lit("="), plan.source), F.lit("null")).alias("key"), "size", "copies", "extra", "n", "source_size", "target")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / float(2 ** 53)
    placed = slim.select("doc_id", key, "size").join(told, ["key", "size"])
    placed = cut_lineage(placed.withColumn("bucket", F.floor(draw * F.ceil(F.col("n") / bucket_rows))))
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    whole = placed.where(~some).withColumn("taken", F.col("size") * (F.col("copies") + F.when(F.col("extra") > 0, 1).otherwise(0)))
    part = placed.where(some)
    keys = ["key", "size", "bucket"]
    counts = part.groupBy(*keys).agg(F.count("*").alias("here"))
    ahead = W.partitionBy("key", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    # A stored table has no layout of its own, so the join deals rows out by bucket too.
    counts = cut_lineage(counts.select(*keys, F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("before")))
    part = part.join(counts, keys)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id"))
    once = (F.col("before") + rank <= F.col("extra")).cast("long")
    part = part.withColumn("once", once).withColumn("taken", F.col("size") * (F.col("copies") + F.col("once")))
    columns = ["doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")]
    return whole.select(*columns).unionByName(part.select(*columns))
